"""The filter of keys before a shuffled join."""

import pytest
from pyspark.sql import functions as F

from offerscope.operators import boilerplate as B
from offerscope.operators import joins
from offerscope.session import materialize


def test_no_row_with_a_match_is_lost_and_few_others_stay(spark):
    # names that the filter's own columns might take, and a key of two columns with nulls
    big = spark.range(20_000).select(
        F.col("id").alias("_place"), F.when(F.col("id") % 10 != 0, F.col("id").cast("string")).alias("k"), (F.col("id") % 3).alias("_chunk"), F.lit("x").alias("a.b")
    )
    keys = materialize(big.filter("_place % 7 = 0").select("k", "_chunk"), "keys")
    matches = {r["_place"] for r in big.join(keys.filter("k is not null"), ["k", "_chunk"], "left_semi").collect()}
    before = None
    for bits in (1 << 16, 1 << 18, 1 << 22):
        kept = joins.probable_rows(big, keys, ["k", "_chunk"], bits)
        assert kept.columns == big.columns
        rows = [r["_place"] for r in kept.collect()]
        assert len(set(rows)) == len(rows) and matches <= set(rows)
        wrong = len([r for r in rows if r % 7 and r % 10])
        assert wrong <= 2 * 20_000 * keys.count() / bits + 20
        assert before is None or wrong <= before + 20
        before = wrong
    assert joins.probable_rows(big, keys.limit(0), ["k", "_chunk"]).count() == 0
    assert joins.probable_rows(big.limit(0), keys, ["k", "_chunk"]).count() == 0


def test_bits_follow_the_keys_up_to_a_bound():
    assert [joins.key_filter_bits(n) for n in (0, 1, 10_000, 1_000_000, 10**12)] == [1 << 16, 1 << 16, 1 << 17, 1 << 23, joins.MAX_BITS]


def test_a_full_filter_is_still_right(spark, monkeypatch):
    monkeypatch.setattr(joins, "MAX_BITS", 64 * joins.WORDS)
    big = spark.range(1000).select((F.col("id") % 700).alias("k"), "id")
    small = materialize(spark.range(0, 300_000, 3).select(F.col("id").alias("k"), F.lit("v").alias("v")), "small")
    for how in ("inner", "left_semi"):
        one = joins.lookup_join(big, small, ["k"], how)
        two = joins.lookup_join(big, small, ["k"], how, limit=0, few_match=True)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    with pytest.raises(ValueError, match="left"):
        joins.lookup_join(big, small, ["k"], "left", limit=0, few_match=True)


def test_removal_is_the_same_by_the_wide_path(spark):
    rows = [(i if i % 5 else None, f"f{i % 3}" if i % 7 else "", f"Bonjour à tous. Mission {i}. Merci {i % 4}. Bonjour à tous.") for i in range(200)]
    frame = spark.createDataFrame(rows, "id int, firm string, text string")
    segmented = B.segment_offers(frame, "id", "text", "firm", collapse_digits=False)
    for share in (0.1, 0.9, 1.0):
        drops = B.learn_boilerplate(segmented, share_threshold=share, sim_threshold=1.0)
        narrow = B.remove_boilerplate(segmented, drops)
        wide = B.remove_boilerplate(segmented, drops, limit=0)
        assert sorted(map(str, narrow.collect())) == sorted(map(str, wide.collect()))
