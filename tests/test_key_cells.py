"""How keys are dealt to the tasks that hash their segments."""

import random

from pyspark.sql import functions as F

from offerscope.operators import boilerplate as B
from offerscope.operators import key_clusters as K
from offerscope.session import materialize


def test_no_task_gets_many_cells(spark):
    """Cells of nearly full size, larger ones and small ones: a task holds two full ones at most."""
    draw, rows = random.Random(7), []
    for firm in range(60):
        n = 90 if firm < 50 else 900 if firm < 53 else 3
        rows += [(f"f{firm}", "".join(draw.choices("abcdefgh ", k=draw.randint(60, 66))), 1) for _ in range(n)]
    keys = spark.createDataFrame(rows, "firm string, key string, n_docs long").select("*", F.length("key").alias("l"))
    keys = keys.select("*", *[K._bag("key", classes).alias(name) for name, classes in K.BAGS.items()])
    keys = materialize(keys.withColumn("id", F.monotonically_increasing_id()), "keys")
    letters = 6000
    longer, shorter, parts = K._cells(keys, 0.88, letters, 4)
    longer = materialize(longer.repartition(parts, "cell").withColumn("task", F.spark_partition_id()), "longer")
    shorter = materialize(shorter.repartition(parts, "cell").withColumn("task", F.spark_partition_id()), "shorter")
    loads = [r["n"] for r in longer.groupBy("task").agg(F.sum("l").alias("n")).collect()]
    assert sum(loads) > 30 * letters and max(loads) <= 2.2 * letters
    # a key that has its like in a cell meets it there: of a firm and band each share has all shorter keys
    shares = longer.select("of", "cell").distinct().groupBy("of").count()
    copies = shorter.select("of", "cell", "id").distinct().groupBy("of", "id").count().withColumnRenamed("count", "copies")
    assert copies.join(shares, "of").filter("copies < count").isEmpty()


def test_report_counts_keys_of_crowded_cells(spark, monkeypatch):
    """The report is the same however few letters a cell takes."""
    draw, texts = random.Random(3), []
    words = ["notre", "groupe", "recrute", "partout", "des", "personnes", "motivees", "avec", "plaisir", "demain"]
    common = [" ".join(draw.choices(words, k=12)).capitalize() + "." for _ in range(15)]
    for k in range(60):
        lines = draw.sample(common, 5)
        texts.append((k, "\n".join(line[: -1 - k % 3] + "." for line in lines), f"f{k % 3}"))
    offers = spark.createDataFrame(texts, "id int, text string, firm string")
    segmented = B.segment_offers(offers, "id", "text", "firm")
    wanted = sorted(map(tuple, B.boilerplate_report(segmented).collect()))
    drops = sorted(map(tuple, B.learn_boilerplate(segmented).collect()))
    assert wanted and drops
    was = K.similar_pairs
    monkeypatch.setattr(K, "similar_pairs", lambda keys, threshold: was(keys, threshold, 150))
    assert sorted(map(tuple, B.boilerplate_report(segmented).collect())) == wanted
    assert sorted(map(tuple, B.learn_boilerplate(segmented).collect())) == drops
