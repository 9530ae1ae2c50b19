"""Results that do not depend on size, limits, null or repeated ids, or padding."""

import pytest
from pyspark.sql import functions as F

from offerscope.operators import annotation as A
from offerscope.operators import boilerplate as B
from offerscope.operators import sampling as S
from offerscope.operators.joins import lookup_join
from offerscope.session import materialize


def frame(spark):
    rows = [(None, "A", "alpha. w."), (7, "A\t", "alpha. x."), (7, " A", "beta. alpha."), (8, "B", "alpha. z."), (9, None, "alpha.")]
    return spark.createDataFrame(rows, "id int, firm string, text string")


@pytest.mark.parametrize("limits", [(B.BROADCAST_BYTES, B.FIRM_ARRAY_BYTES), (0, 0), (B.BROADCAST_BYTES, 0)])
def test_removal_with_null_and_repeated_ids(spark, monkeypatch, limits):
    monkeypatch.setattr(B, "BROADCAST_BYTES", limits[0])
    monkeypatch.setattr(B, "FIRM_ARRAY_BYTES", limits[1])
    segmented = B.segment_offers(frame(spark), "id", "text", "firm")
    drops = B.learn_boilerplate(segmented, sim_threshold=1.0)
    assert sorted(map(tuple, drops.collect())) == [("A", "alpha")]
    clean = [r["description_clean"] for r in B.remove_boilerplate(segmented, drops).collect()]
    assert sorted(clean) == ["alpha.", "alpha. z.", "beta.", "w.", "x."]


def test_all_keys_of_a_large_firm_count(spark):
    keys = spark.range(6000).select(F.lit("f").alias("firm"), F.concat(F.lit("k"), F.md5(F.col("id").cast("string"))).alias("text"))
    twice = keys.unionByName(keys).withColumn("id", F.monotonically_increasing_id())
    segmented = B.segment_offers(twice, "id", "text", "firm", collapse_digits=False)
    assert B.learn_boilerplate(segmented, share_threshold=0.0, sim_threshold=1.0).count() == 6000


def test_whole_texts_are_annotated(spark, tmp_path):
    table = spark.createDataFrame([("1", "x " * 6000 + "target"), ("2", "other")], "id string, text string")
    made, failed = A.run_annotation(table, "id", "text", A.keyword_annotator({"quality": ["target"]}), str(tmp_path / "s"), ["quality"])
    assert {r["id"]: r["quality"] for r in made.collect()} == {"1": 1, "2": 0} and failed.count() == 0


def test_a_wave_reads_its_own_folder(spark, tmp_path):
    table = spark.range(40).select(F.col("id").cast("string").alias("id"), F.lit("target").alias("text"))
    made, _ = A.run_annotation(
        table, "id", "text", A.keyword_annotator({"quality": ["target"]}), str(tmp_path / "s"), ["quality"], parallel_calls=1, checkpoint_every=2
    )
    assert made.filter("quality = 1").count() == 40


def test_lookup_with_a_map_column(spark):
    big = spark.range(20).select((F.col("id") % 3).alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    small = materialize(spark.createDataFrame([(0, "x"), (1, "y")], "k long, v string"), "small")
    assert lookup_join(big, small, ["k"], limit=0).count() == lookup_join(big, small, ["k"]).count() == 14


def test_split_keeps_rows_with_null_labels_and_ids(spark):
    rows = [(k if k else None, None if k % 10 == 0 else k % 2) for k in range(100)]
    split = S.split_train_valid_test(spark.createDataFrame(rows, "id int, label int"), "id", ["label"], rare_below=5)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(counts.values()) == 100 and None not in counts and min(counts.values()) >= 10
    assert S.sample_fraction(spark.createDataFrame(rows, "id int, label int"), 1.0, "id").count() == 100
    assert S.dense_row_id(spark.createDataFrame(rows, "id int, label int"), "id").count() == 100
