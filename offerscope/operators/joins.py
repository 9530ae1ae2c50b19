"""Joins with a table that is usually small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
# A key filter has so many bits per key, up to so many in all (32 MB), in arrays of words.
BITS_PER_KEY = 8
MAX_BITS = 1 << 28
WORDS = 1024


def table_bytes(df: DataFrame) -> int:
    """Size of a materialised table as rows, from one aggregate."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns),
        F.lit(0),
    )
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return table_bytes(df) <= limit


def key_filter_bits(n_keys: int) -> int:
    """Bits of a filter for so many keys: a power of two, at least one array of words."""
    wanted = max(64 * WORDS, min(MAX_BITS, BITS_PER_KEY * n_keys))
    return 1 << (wanted - 1).bit_length()


def probable_rows(big: DataFrame, keys: DataFrame, on: list[str], bits: int | None = None) -> DataFrame:
    """The rows of ``big`` whose key may be in ``keys``: all whose key is, and of the
    others a share of about ``keys / bits``.

    A Bloom filter with one hash: words of 64 bits come from partial aggregates, and
    arrays of them are broadcast, at most 32 MB for any number of keys. Nothing of ``big``
    is shuffled. Names and types of ``on`` must be equal on both sides.
    """
    bits = bits or key_filter_bits(keys.count())
    place = F.pmod(F.xxhash64(*on), F.lit(bits))
    bit = F.pmod("_filter_place", F.lit(64)).cast("int")
    words = (
        keys.select(place.alias("_filter_place"))
        .groupBy(F.shiftright("_filter_place", 6).alias("_filter_word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_filter_bits"))
    )
    chunk = (F.col("_filter_word") / WORDS).cast("long").alias("_filter_chunk")
    every = F.coalesce("_filter_bits", F.lit(0).cast("long"))
    filled = (
        keys.sparkSession.range(bits // 64)
        .withColumnRenamed("id", "_filter_word")
        .join(words, "_filter_word", "left")
        .groupBy(chunk)
        .agg(F.array_sort(F.collect_list(F.struct("_filter_word", every.alias("_filter_bits")))).alias("_filter_words"))
        .select("_filter_chunk", F.col("_filter_words._filter_bits").alias("_filter_words"))
    )
    word = F.get("_filter_words", F.pmod(F.shiftright("_filter_place", 6), F.lit(WORDS)).cast("int"))
    return (
        big.withColumn("_filter_place", place)
        .withColumn("_filter_chunk", F.shiftright("_filter_place", 6 + (WORDS - 1).bit_length()))
        .join(F.broadcast(filled), "_filter_chunk")
        .filter(F.getbit(word, bit) == 1)
        .select(*[F.col(f"`{name}`") for name in big.columns])
    )


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
    few_match: bool = False,
) -> DataFrame:
    """Join ``big`` with ``small``, one row per key, which must be materialised.

    A measured-small table is broadcast. Beyond the limit both sides are
    shuffled on the key plus a salt: the big side draws its salt from the row's
    content (columns with maps, which have no hash, aside), the small side is repeated once per salt, so a key that holds a
    third of the rows spreads over ``salts`` tasks. With ``few_match``, for joins that keep
    matches only, rows of the big side are first dropped where their key is surely not in
    the small one (``probable_rows``).
    """
    if fits_broadcast(small, limit):
        return big.join(F.broadcast(small), on, how)
    if few_match:
        if how not in ("inner", "left_semi"):
            raise ValueError(f"rows without a match stay in a join of kind {how}")
        big = probable_rows(big, small, on)
    hashed = [name for name, kind in big.dtypes if "map<" not in kind and "variant" not in kind]
    drawn = F.xxhash64(*hashed) if hashed else F.monotonically_increasing_id()
    salt = F.pmod(drawn, F.lit(salts)).cast("int")
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("_salt", salt).join(repeated, [*on, "_salt"], how).drop("_salt")
