"""Reports on binary labels, text lengths and strata.

Labels stay wide while rows are counted (one pass, one row of sums per task) and
become rows only afterwards.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerscope.operators.ranges import describe, value_table

LENGTH_LIMITS = [256, 512, 768, 1024, 2048, 4096, 8192]
TOKEN_PERCENTILES = [0.50, 0.75, 0.90, 0.95, 0.99]
WEIGHT_RANGE = (1.0, 10.0)


def stacked(df: DataFrame, fields: dict[str, dict], key: str = "label") -> DataFrame:
    """One row per entry of ``fields`` (entry -> column name -> expression)."""
    rows = [
        F.struct(F.lit(name).alias(key), *[c.alias(n) for n, c in columns.items()])
        for name, columns in fields.items()
    ]
    return df.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def coerce_labels(df: DataFrame, labels: list[str]) -> DataFrame:
    """Rows with every label, labels rounded half to even and cut to 0 and 1."""
    kept = df.dropna(subset=labels)
    rounded = {
        label: F.least(F.greatest(F.bround(F.col(label).cast("double")), F.lit(0.0)), F.lit(1.0)).cast("int")
        for label in labels
    }
    return kept.withColumns(rounded)


def label_prevalence(df: DataFrame, labels: list[str], by: str | None = None) -> DataFrame:
    """``label, n_positive, prevalence``; per value of ``by`` when given."""
    keys = [by] if by else []
    sums = df.groupBy(*keys).agg(
        *[F.sum(F.col(label)).cast("long").alias(f"s_{label}") for label in labels],
        *[F.avg(F.col(label)).alias(f"m_{label}") for label in labels],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.col(f"s_{label}").alias("n_positive"),
                F.col(f"m_{label}").alias("prevalence"),
            )
            for label in labels
        ]
    )
    return (
        sums.select(*keys, F.explode(rows).alias("r"))
        .select(*keys, "r.*")
        .orderBy(*keys, F.col("prevalence").desc(), "label")
    )


def label_table(df: DataFrame, labels: list[str]) -> DataFrame:
    """``label, n_1, pct_1, n_0, pct_0`` over rows with every label set; no rows
    when there are none."""
    sums = df.dropna(subset=labels).agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(label)).cast("long").alias(f"s_{label}") for label in labels],
    ).filter(F.col("n") > 0)
    n = F.col("n")
    return stacked(
        sums,
        {
            label: {
                "n_1": F.col(f"s_{label}"),
                "pct_1": F.col(f"s_{label}") / n * 100,
                "n_0": n - F.col(f"s_{label}"),
                "pct_0": (n - F.col(f"s_{label}")) / n * 100,
            }
            for label in labels
        },
    )


def rows_without_positive(df: DataFrame, labels: list[str]) -> DataFrame:
    total = sum((F.col(label) for label in labels), F.lit(0))
    return df.dropna(subset=labels).agg(
        F.count("*").alias("n_rows"),
        F.count_if(total == 0).alias("n_zero"),
        (F.count_if(total == 0) / F.count("*") * 100).alias("pct_zero"),
    )


def cooccurrence(df: DataFrame, labels: list[str], top: int | None = 5) -> DataFrame:
    """``label_a, label_b, n_both``, most frequent first, ties in label order."""
    pairs = list(combinations(labels, 2))
    complete = df.dropna(subset=labels)
    sums = complete.agg(
        *[
            F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    rows = stacked(
        sums,
        {
            f"p{i}": {
                "place": F.lit(i),
                "label_a": F.lit(a),
                "label_b": F.lit(b),
                "n_both": F.col(f"p{i}"),
            }
            for i, (a, b) in enumerate(pairs)
        },
        key="pair",
    ).orderBy(F.col("n_both").desc(), "place")
    if top is not None:
        rows = rows.limit(top)
    return rows.select("label_a", "label_b", "n_both")


def domain_rates(df: DataFrame, labels: list[str], domain_col: str) -> DataFrame:
    """Complete rows per domain and the mean positive rate over labels, in %."""
    rate = sum((F.avg(F.col(label)) for label in labels), F.lit(0.0)) / len(labels) * 100
    return df.dropna(subset=labels).groupBy(domain_col).agg(
        F.count("*").alias("n_offers"), rate.alias("mean_positive_pct")
    )


def annotation_counts(df: DataFrame, id_col: str, labels: list[str]) -> DataFrame:
    """``n_rows, n_annotated, n_unlabelled`` of a table after the label join."""
    first = F.col(labels[0])
    return df.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct(F.when(first.isNotNull(), F.col(id_col))).alias("n_annotated"),
        F.count_if(first.isNull()).alias("n_unlabelled"),
    )


def class_weights(df: DataFrame, labels: list[str]) -> DataFrame:
    """``label, pos_weight``: negatives per positive, between 1 and 10."""
    low, high = WEIGHT_RANGE
    sums = df.agg(
        F.count("*").alias("n"), *[F.sum(F.col(label)).cast("double").alias(f"s_{label}") for label in labels]
    )

    def weight(label: str) -> Column:
        positive = F.coalesce(F.col(f"s_{label}"), F.lit(0.0))
        ratio = (F.col("n") - positive) / F.greatest(positive, F.lit(1.0))
        return F.least(F.greatest(ratio, F.lit(low)), F.lit(high))

    return stacked(sums, {label: {"pos_weight": weight(label)} for label in labels})


# Stated for annotators: junior and experienced exclude each other, and a very
# experienced profile is an experienced one.
LABEL_RULES = {
    "junior_and_experienced": lambda c: (c("junior_offer") == 1) & (c("experienced_offer") == 1),
    "very_experienced_without_experienced": lambda c: (c("very_experienced_offer") == 1)
    & (c("experienced_offer") == 0),
}


def rule_violations(df: DataFrame, column_of=None) -> DataFrame:
    """``label, n_violations`` per rule. ``column_of`` maps a label name to its
    column when the table names it otherwise."""
    column = column_of or F.col
    sums = df.agg(*[F.count_if(rule(column)).alias(name) for name, rule in LABEL_RULES.items()])
    return stacked(sums, {name: {"n_violations": F.col(name)} for name in LABEL_RULES}, key="rule")


# --- text lengths -----------------------------------------------------------------


def token_summary(df: DataFrame, tokens_col: str, max_length: int = 8192) -> DataFrame:
    """Count, mean, std, min, percentiles, max, and what ``max_length`` cuts. The
    texts are counted once; the rest reads the distinct counts."""
    values = value_table(df, tokens_col)
    over = F.sum(F.when(F.col("v") > max_length, F.col("n")).otherwise(0))
    cut = values.agg(
        over.alias("n_truncated"), (over / F.sum("n") * 100).alias("pct_truncated")
    ).first()
    summary = describe(values, TOKEN_PERCENTILES)
    return (
        summary.withColumns({c: F.col(c).cast("int") for c in ("min", "max")})
        .withColumn("max_length", F.lit(max_length))
        .withColumn("n_truncated", F.lit(cut["n_truncated"]).cast("long"))
        .withColumn("pct_truncated", F.lit(cut["pct_truncated"]).cast("double"))
    )


def length_coverage(df: DataFrame, tokens_col: str, limits: list[int] | None = None) -> DataFrame:
    """``max_length, pct``: percentage of texts within each limit, in one pass."""
    limits = limits or LENGTH_LIMITS
    shares = df.agg(
        *[
            (F.count_if(F.col(tokens_col) <= limit) / F.count("*") * 100).alias(f"u{limit}")
            for limit in limits
        ]
    )
    rows = stacked(
        shares,
        {str(limit): {"max_length": F.lit(limit), "pct": F.col(f"u{limit}")} for limit in limits},
        key="_limit",
    )
    return rows.select("max_length", "pct")
