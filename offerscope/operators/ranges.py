"""Exact order statistics without a single-task sort.

Approximate quantiles of the column cut it into ranges of similar size. Totals
per range are few; only values inside one range are ever ordered together.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerscope.session import materialize

RANGES = 512
RELATIVE_ERROR = 0.001


def add_range(df: DataFrame, col: str, out_col: str = "_range", ranges: int = RANGES) -> DataFrame:
    """Adds the number of the value range that holds ``col``."""
    bounds = df.approxQuantile(col, [i / ranges for i in range(1, ranges)], RELATIVE_ERROR)
    inner = sorted({b for b in bounds if math.isfinite(b)}) or [0.0]
    cutter = Bucketizer(
        splits=[-math.inf, *inner, math.inf],
        inputCol="_value",
        outputCol=out_col,
        handleInvalid="keep",
    )
    return cutter.transform(df.withColumn("_value", F.col(col).cast("double"))).drop("_value")


def value_table(df: DataFrame, col: str) -> DataFrame:
    """``v, n``: the distinct values of a column with their counts, materialised.

    Everything below reads this table, so the input is computed once. Nulls are
    left out.
    """
    values = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    return materialize(values.groupBy("v").agg(F.count("*").alias("n")), "values")


def exact_quantiles(values: DataFrame, probabilities: list[float]) -> list[float | None]:
    """Quantiles of a ``value_table`` with linear interpolation."""
    ranged = add_range(values, "v")
    totals = ranged.groupBy("_range").agg(F.sum("n").alias("n")).orderBy("_range").collect()
    rows = sum(t["n"] for t in totals)
    if rows == 0:
        return [None] * len(probabilities)

    ranks = sorted(
        {r for p in probabilities for r in (math.floor(p * (rows - 1)), math.ceil(p * (rows - 1)))}
    )
    wanted: dict[float, list[int]] = {}
    before: dict[float, int] = {}
    seen = 0
    for total in totals:
        before[total["_range"]] = seen
        inside = [r for r in ranks if seen <= r < seen + total["n"]]
        if inside:
            wanted[total["_range"]] = inside
        seen += total["n"]

    order = Window.partitionBy("_range").orderBy("v")
    placed = ranged.filter(F.col("_range").isin(list(wanted))).withColumn(
        "upto", F.sum("n").over(order)
    )
    hit = F.lit(False)
    for name, inside in wanted.items():
        for rank in inside:
            place = rank - before[name]
            hit = hit | (
                (F.col("_range") == name)
                & (F.col("upto") > place)
                & (F.col("upto") - F.col("n") <= place)
            )
    at_rank: dict[int, float] = {}
    for row in placed.filter(hit).collect():
        for rank in wanted[row["_range"]]:
            if row["upto"] - row["n"] <= rank - before[row["_range"]] < row["upto"]:
                at_rank[rank] = row["v"]

    found = []
    for p in probabilities:
        place = p * (rows - 1)
        low, high = at_rank[math.floor(place)], at_rank[math.ceil(place)]
        found.append(low + (high - low) * (place - math.floor(place)))
    return found


def moments(values: DataFrame, sample: bool = True) -> DataFrame:
    """``count, mean, std, min, max`` of a ``value_table``."""
    mean = values.agg(F.sum(F.col("v") * F.col("n")) / F.sum("n")).first()[0]
    squares = F.sum(F.pow(F.col("v") - F.lit(mean).cast("double"), 2) * F.col("n"))
    degrees = F.sum("n") - (1 if sample else 0)
    return values.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.lit(mean).cast("double").alias("mean"),
        F.when(degrees > 0, F.sqrt(squares / degrees)).alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )


def describe(values: DataFrame, probabilities: list[float]) -> DataFrame:
    """``moments`` with ``p<percent>`` columns before the maximum."""
    quantiles = [
        F.lit(q).cast("double").alias(f"p{round(p * 100)}")
        for p, q in zip(probabilities, exact_quantiles(values, probabilities))
    ]
    return moments(values).select("count", "mean", "std", "min", *quantiles, "max")
