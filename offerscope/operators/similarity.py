"""Cosine similarity over all pairs of a table's vectors."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerscope.functions import vectors as V
from offerscope.session import materialize

BLOCK_ROWS = 2048
CHUNK_ROWS = 512


def _units(df: DataFrame, vector_col: str, *keys: str) -> DataFrame:
    """Unit vectors; zero vectors have no direction and are left out."""
    return df.filter(V.squared_norm(F.col(vector_col)) > 0).select(
        *keys, V.unit_or_zero(F.col(vector_col)).alias("u")
    )


def _array_column(column) -> np.ndarray:
    """A list column of an Arrow batch as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def pair_statistics(df: DataFrame, vector_col: str) -> DataFrame:
    """``n_rows, n_pairs, mean_cos, std_cos`` over all pairs, without pairs.

    With s the sum of the n unit vectors and G the sum of their outer products,
    the mean is (|s|^2 - n) / (n (n - 1)) and the mean square is
    (|G|^2 - n) / (n (n - 1)). Every task adds up its own G, one row per
    dimension; a trailing 1 in each vector makes s and n part of G.
    """

    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                u = _array_column(batch.column(0))
                u = np.hstack([u, np.ones((len(u), 1))])
                total = u.T @ u if total is None else total + u.T @ u
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(total)), pa.int32()),
                    pa.array(list(total), pa.list_(pa.float64())),
                ],
                names=["i", "part"],
            )

    rows = _units(df, vector_col).mapInArrow(partial, "i int, part array<double>")
    gram = rows.groupBy("i").agg(
        vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("g")
    )
    size = F.size("g")
    inner = F.col("i") < size - 1
    sums = gram.agg(
        F.sum(F.when(inner, V.squared_norm(F.slice("g", F.lit(1), size - 1)))).alias("g2"),
        F.sum(F.when(inner, F.pow(F.element_at("g", -1), 2))).alias("s2"),
        F.max(F.when(~inner, F.element_at("g", -1))).alias("n"),
    )
    pairs = F.col("n") * (F.col("n") - 1)
    moments = sums.select(
        "n",
        ((F.col("s2") - F.col("n")) / pairs).alias("mean"),
        ((F.col("g2") - F.col("n")) / pairs).alias("square"),
    )
    return moments.select(
        F.col("n").cast("long").alias("n_rows"),
        (pairs / 2).cast("long").alias("n_pairs"),
        F.col("mean").alias("mean_cos"),
        F.sqrt(F.greatest(F.col("square") - F.col("mean") * F.col("mean"), F.lit(0.0))).alias(
            "std_cos"
        ),
    )


def _block_matrices(units: DataFrame, key_col: str, block_rows: int) -> DataFrame:
    """Unit vectors packed into one binary row per block of about ``block_rows``.

    Blocks go by the unique key, not by the vector: copies of one vector spread
    over all blocks.
    """
    blocks = max(1, math.ceil(units.count() / block_rows))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        matrix = np.stack(group["u"].to_numpy())
        return pd.DataFrame(
            {
                "block": [group["block"].iloc[0]],
                "dims": [matrix.shape[1]],
                "matrix": [matrix.astype(np.float64).tobytes()],
            }
        )

    return (
        units.select("u", F.pmod(F.xxhash64(key_col), F.lit(blocks)).cast("int").alias("block"))
        .groupBy("block")
        .applyInPandas(pack, "block int, dims int, matrix binary")
    )


def _block_pairs(packed: DataFrame) -> DataFrame:
    """A row per pair of blocks. Tasks read both from the stored table, whose size keeps
    the product from a broadcast beyond small tables, so blocks are not shuffled."""
    left, right = (packed.select(*[F.col(c).alias(f"{c}_{end}") for c in packed.columns]) for end in ("i", "j"))
    # a pair of blocks is met where the sum of their numbers says, so partitions share the work
    even = (F.col("block_i") + F.col("block_j")) % 2 == 0
    once = (even & (F.col("block_i") <= F.col("block_j"))) | (~even & (F.col("block_i") > F.col("block_j")))
    return left.join(right, once)


def _similarities(row: dict):
    """Chunks of cosines for one pair of blocks, each pair of rows once."""
    ends = sorted("ij", key=lambda end: row[f"block_{end}"])
    left, right = (np.frombuffer(row[f"matrix_{e}"], dtype=np.float64).reshape(-1, row[f"dims_{e}"]) for e in ends)
    same = row["block_i"] == row["block_j"]
    for start in range(0, len(left), CHUNK_ROWS):
        cosines = left[start : start + CHUNK_ROWS] @ right.T
        if same:
            rows = np.arange(start, start + len(cosines))
            yield cosines[np.arange(len(right))[None, :] > rows[:, None]]
        else:
            yield cosines.ravel()


def _all_similarities(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            yield from _similarities(batch.slice(at, 1).to_pylist()[0])


def pair_histogram(
    df: DataFrame, key_col: str, vector_col: str, bins: int = 300, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``bin, lower, n_pairs``: all pairs' cosines in equal bins from the least
    to the greatest; the last bin is closed.

    Rows are hashed to blocks, and each pair of blocks is one matrix product that
    gives back its range, then its counts. Pairs of rows are never stored, and each
    task gives one range and one list of counts; the shuffle carries every vector once.
    """
    spark = df.sparkSession
    packed = _block_matrices(_units(df, vector_col, key_col), key_col, block_rows)
    pairs = _block_pairs(materialize(packed, "vector-blocks"))

    def extent(batches):
        ends = [(c.min(), c.max()) for c in _all_similarities(batches) if c.size]
        if ends:
            lo, hi = min(e[0] for e in ends), max(e[1] for e in ends)
            yield pa.RecordBatch.from_pydict({"lo": pa.array([lo], pa.float64()), "hi": pa.array([hi], pa.float64())})

    ends = pairs.mapInArrow(extent, "lo double, hi double").agg(F.min("lo"), F.max("hi")).first()
    numbers = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    if ends[0] is None:
        return numbers.select("bin", F.lit(None).cast("double").alias("lower"), F.lit(0).cast("long").alias("n_pairs"))
    lo, width = _bin_grid(ends[0], ends[1], bins)

    def count(batches):
        total = np.zeros(bins, dtype=np.int64)
        for cosines in _all_similarities(batches):
            place = np.minimum(np.floor((cosines - lo) / width).astype(np.int64), bins - 1)
            total += np.bincount(place, minlength=bins)
        held = np.nonzero(total)[0]
        yield pa.RecordBatch.from_pydict({"bin": pa.array(held, pa.int32()), "n": pa.array(total[held], pa.int64())})

    counts = pairs.mapInArrow(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    return _all_bins(numbers, counts, lo, width, "n_pairs")


def _bin_grid(lo: float, hi: float, bins: int) -> tuple[float, float]:
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    return lo, (hi - lo) / bins


def _all_bins(numbers: DataFrame, counts: DataFrame, lo: float, width: float, name: str) -> DataFrame:
    """Empty bins included; there are ``bins`` rows on both sides."""
    return numbers.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
        F.coalesce("n", F.lit(0)).cast("long").alias(name),
    )


def column_histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """``bin, lower, n``: values in equal bins; nulls and NaN are left out."""
    values = df.select(F.nanvl(F.col(col).cast("double"), F.lit(None)).alias("v")).filter(
        F.col("v").isNotNull()
    )
    ends = values.agg(F.min("v"), F.max("v")).first()
    numbers = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if ends[0] is None:
        return numbers.select("bin", F.lit(None).cast("double").alias("lower"), F.lit(0).cast("long").alias("n"))
    lo, width = _bin_grid(ends[0], ends[1], bins)
    place = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    return _all_bins(numbers, counts, lo, width, "n")
