"""What the physical plans must and must not hold."""

from pyspark.sql import functions as F

from offerscope.operators import boilerplate as B
from offerscope.operators import groups as G
from offerscope.operators import joins
from offerscope.operators import sampling as S
from offerscope.operators.scoring import apply_thresholds
from offerscope.session import materialize

SF_DIR = "/root/testdata/sf0.01"


def plan(frame):
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return frame._jdf.queryExecution().explainString(mode)


def operators(frame):
    """Operator names of the tree at the head of the formatted plan."""
    return plan(frame).split("\n\n")[0]


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_removal_is_narrow(spark):
    segmented = B.segment_offers(documents(spark), "doc_id", "text", "source", keep_row=True)
    result = B.remove_boilerplate(segmented, B.learn_boilerplate(segmented, sim_threshold=1.0))
    tree = operators(result)
    # The one exchange left gathers the drop table for its broadcast.
    assert "BroadcastHashJoin" in tree and "SortMergeJoin" not in tree
    assert tree.count("Exchange") == 2 and "BroadcastExchange" in tree


def test_learning_reads_what_it_needs_and_shuffles_once(spark):
    segmented = B.segment_offers(documents(spark), "doc_id", "text", "source", keep_row=True)
    frequency = B.key_document_frequency(segmented)
    assert operators(frequency).count("Exchange") == 1
    assert "ReadSchema: struct<text:string,source:string>" in plan(frequency)


def test_ranking_cuts_before_the_shuffle(spark):
    frequency = spark.createDataFrame([("f", "k", 2)], "firm string, key string, n_docs long")
    assert operators(B.top_keys(frequency, 200)).count("WindowGroupLimit") == 4


def test_groups_combine_before_the_shuffle(spark):
    frame = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select(F.col("label").cast("string").alias("k"), "embedding")
    for result in (G.centroids(frame, ["k"], "embedding"), G.within_group_coherence(frame, ["k"], "embedding")):
        assert operators(result).count("ObjectHashAggregate") == 2
        assert operators(result).count("Exchange") == 1


def test_samples_are_filters(spark):
    sample = S.sample_fraction(documents(spark).select("doc_id", "lang"), 0.1, "doc_id")
    assert "Exchange" not in operators(sample) and "Sort" not in operators(sample)
    frame = documents(spark).withColumn("code", F.lit("H1206"))
    drawn = S.stratified_sample(frame, 50, "doc_id", "text", "code")
    assert "Exchange" not in operators(drawn) and "Sort" not in operators(drawn)


def test_scoring_is_narrow(spark):
    frame = documents(spark).select("doc_id", F.lit(0.4).alias("proba_a"))
    assert "Exchange" not in operators(apply_thresholds(frame, ["a"], {"a": 0.5}))


def test_large_lookups_are_salted(spark):
    small = materialize(spark.range(3).withColumnRenamed("id", "k"), "small")
    big = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    assert "BroadcastHashJoin" in operators(joins.lookup_join(big, small, ["k"]))
    far = joins.lookup_join(big, small, ["k"], limit=0)
    assert "_salt" in plan(far) and "explode" in plan(far)
