"""What the driver holds: tables are broadcast up to a low bound where many follow one another."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from offerscope.llm import common, near_text, near_vectors
from offerscope.session import materialize

HELD = 4 * 1024 * 1024


@pytest.fixture
def limits(monkeypatch):
    """The limit of every measured join, by the module that asks for it."""
    seen = []
    for module in (common, near_text, near_vectors, corpus_pipeline):
        was = module.measured_join

        def join(big, small, on, how, salt_by, limit=common.BROADCAST_BYTES, *more, was=was, **named):
            seen.append((tuple(big.columns), limit))
            return was(big, small, on, how, salt_by, limit, *more, **named)

        monkeypatch.setattr(module, "measured_join", join)
    return seen


def texts(spark):
    base = [" ".join(f"w{k}x{n}" for n in range(60)) for k in range(6)]
    rows = [(10 * k + j, text + f" end{j}") for k, text in enumerate(base) for j in range(3)]
    return spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")


def test_near_texts_broadcast_small_tables_only(spark, limits):
    found = near_text.similar_documents(texts(spark))
    got = {r["doc_id"]: r["component_id"] for r in found.collect()}
    assert got == {10 * k + j: 10 * k for k in range(6) for j in range(3)} | {900: 900, 901: 901}
    assert limits and max(limit for _, limit in limits) <= HELD


def test_a_join_with_few_matches_drops_rows_before_they_are_shuffled(spark):
    small = materialize(spark.range(0, 3000, 1000).select(F.col("id").alias("k"), F.lit(1).alias("x")), "few")
    big = materialize(spark.range(20000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("k"), F.col("id").alias("n")), "big")
    exact = sorted(r["n"] for r in big.join(small, "k").collect())
    for few in (False, True):
        for limit in (HELD, -1):
            for how in ("inner", "left_semi"):
                joined = common.measured_join(big, small, ["k"], how, "n", limit, few_match=few)
                assert sorted(r["n"] for r in joined.collect()) == exact
    with pytest.raises(ValueError):
        common.measured_join(big, small, ["k"], "left", "n", -1, few_match=True)


def test_the_stage_of_near_copies_broadcasts_small_tables_only(spark, limits):
    docs = materialize(texts(spark), "documents")
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(0, 60, 10), 900, 901]
    # the documents themselves are not shuffled before their copies take 16 MB
    assert max(limit for columns, limit in limits if "text" not in columns) <= HELD


def test_near_vectors_broadcast_small_tables_only(spark, limits):
    rows = [(k, [1.0 + k // 3, 1.0, 0.001 * k] if k % 3 else None) for k in range(12)]
    rows += [(20 + k, [0.0, 0.0, float(k + 1)]) for k in range(3)]
    found = near_vectors.similar_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    parts = {r["vec_id"]: r["component_id"] for r in found.collect()}
    assert all(parts[k] == k for k in range(0, 12, 3)) and [parts[k] for k in (20, 21, 22)] == [20] * 3
    assert limits and max(limit for _, limit in limits) <= HELD
