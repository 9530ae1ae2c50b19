"""Firm, occupation and firm-by-occupation summaries of offer vectors."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerscope.functions import text as X
from offerscope.functions import vectors as V
from offerscope.operators.ranges import describe, exact_quantiles, moments, value_table


def _with_keys(df: DataFrame, keys: list[str], drop_empty: bool) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
        if drop_empty:
            df = df.filter(F.col(key) != "")
    return df


def centroids(
    offers: DataFrame,
    keys: list[str],
    vector_col: str,
    code_col: str | None = None,
    drop_empty: bool = False,
) -> DataFrame:
    """Mean vector and ``n_offers`` per group; null keys are left out.

    ``code_col`` names the key that must be a valid occupation code. An empty
    key is a group unless ``drop_empty``. Sums are combined before the shuffle,
    so a very large group costs one row per task.
    """
    rows = _with_keys(offers, keys, drop_empty)
    if code_col is not None:
        rows = rows.filter(X.is_occupation_code(F.col(code_col)))
    vector = array_to_vector(V.as_doubles(F.col(vector_col)))
    return (
        rows.groupBy(*keys)
        .agg(Summarizer.mean(vector).alias("_mean"), F.count("*").alias("n_offers"))
        .select(*keys, vector_to_array("_mean").alias("centroid"), "n_offers")
    )


def within_group_coherence(
    offers: DataFrame, keys: list[str], vector_col: str, min_obs: int = 2
) -> DataFrame:
    """Mean cosine over all pairs inside each group, without forming pairs.

    With unit vectors and their sum s, the mean over pairs is
    (|s|^2 - n) / (n (n - 1)). Zero vectors stay zero and count in n.
    """
    rows = _with_keys(offers, keys, drop_empty=False)
    unit = array_to_vector(V.unit_or_zero(F.col(vector_col)))
    n = F.col("n_obs").cast("double")
    return (
        rows.groupBy(*keys)
        .agg(Summarizer.sum(unit).alias("_sum"), F.count("*").alias("n_obs"))
        .filter(F.col("n_obs") >= min_obs)
        .withColumn("_s2", V.squared_norm(vector_to_array("_sum")))
        .select(
            *keys,
            F.when(F.col("n_obs") >= 2, (F.col("_s2") - n) / (n * (n - 1))).alias("mean_within_cos"),
            "n_obs",
        )
    )


def coherence_summary(coherence: DataFrame) -> DataFrame:
    """Mean, population std and median of the groups' coherence."""
    values = value_table(coherence, "mean_within_cos")
    median = exact_quantiles(values, [0.5])[0]
    return moments(values, sample=False).select(
        F.col("count").alias("n_groups"),
        F.col("mean").alias("mean_cos"),
        F.col("std").alias("std_cos"),
        F.lit(median).cast("double").alias("median_cos"),
    )


def group_size_summary(coherence: DataFrame) -> DataFrame:
    summary = describe(value_table(coherence, "n_obs"), [0.25, 0.5, 0.75])
    return summary.withColumns({c: F.col(c).cast("long") for c in ("min", "max")})


def coherent_groups(coherence: DataFrame, above: float = 0.95) -> DataFrame:
    return coherence.filter(F.col("mean_within_cos") > above).orderBy(
        F.col("mean_within_cos").desc()
    )


def top_k_similar(centroid_table: DataFrame, key_col: str, target: str, k: int = 10) -> DataFrame:
    """The ``k`` groups most similar to ``target``, without ``target`` itself.

    The target's vector is one row; it enters the expression as a literal, so the
    comparison is a scan that ends in a top-k.
    """
    row = centroid_table.filter(F.col(key_col) == target).select("centroid").first()
    if row is None:
        raise ValueError(f"{target} is not among the values of {key_col}")
    similarity = V.cosine_to(F.col("centroid"), row["centroid"])
    return (
        centroid_table.filter(F.col(key_col) != target)
        .select(key_col, similarity.alias("cosine_similarity"))
        .orderBy(F.col("cosine_similarity").desc_nulls_last(), key_col)
        .limit(k)
    )


def first_names(offers: DataFrame, key_col: str, name_col: str, id_col: str) -> DataFrame:
    """The first name, by offer id, that goes with each key."""
    named = offers.filter(F.col(key_col).isNotNull() & F.col(name_col).isNotNull())
    return named.groupBy(key_col).agg(F.min_by(name_col, id_col).alias(name_col))


def top_k_similar_firms(
    centroid_table: DataFrame,
    offers: DataFrame,
    target: str,
    k: int = 10,
    key_col: str = "SIREN",
    name_col: str = "entreprise_nom",
    id_col: str = "offer_id",
) -> DataFrame:
    """``top_k_similar`` with the firms' names; names are sought for k firms only."""
    nearest = top_k_similar(centroid_table, key_col, target, k)
    names = first_names(
        offers.join(F.broadcast(nearest.select(key_col)), key_col, "left_semi"),
        key_col,
        name_col,
        id_col,
    )
    return nearest.join(names, key_col, "left").select(key_col, name_col, "cosine_similarity")


def largest_groups(groups: DataFrame, key_col: str, size_col: str, n: int = 30) -> DataFrame:
    return groups.orderBy(F.col(size_col).desc(), key_col).limit(n)


def value_counts(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), col).limit(n)
