"""Queries over offer vectors, centroids and similarities."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerscope.functions import vectors as V
from offerscope.operators import groups as G
from offerscope.operators import pca as P
from offerscope.operators import similarity as S
from offerscope.operators.scoring import embed_by_words, embed_texts
from offerscope.plans.inputs import VECTORS, documents, vectors
from offerscope.plans.registry import query
from offerscope.sources.tables import load_table


def _long(frame: DataFrame, keys: list[str], vector_col: str) -> DataFrame:
    """One row per vector entry, dimensions from 1."""
    return frame.select(*keys, F.posexplode(vector_col).alias("dim", "value")).select(
        *keys, (F.col("dim") + 1).cast("long").alias("dim"), F.round("value", 6).alias("value")
    )


def _means(keys: str) -> str:
    """CTEs ``entries``, ``means`` (key, dim, value, n) and ``centroids`` (key, emb)."""
    return f"""{VECTORS},
entries AS (SELECT {keys}, unnest(emb) AS v, generate_subscripts(emb, 1) AS dim FROM vectors),
means AS (SELECT {keys}, dim, avg(v) AS value, count(*) AS n_offers FROM entries GROUP BY {keys}, dim),
centroids AS (SELECT {keys}, list(value ORDER BY dim) AS emb, any_value(n_offers) AS n_offers FROM means GROUP BY {keys})"""


def _coherence(keys: str) -> str:
    """CTE ``coherence`` (key, mean_within_cos, n_obs) from all pairs' sums."""
    return f"""{VECTORS},
entries AS (SELECT {keys}, unnest(emb) / sqrt(list_dot_product(emb, emb)) AS v, generate_subscripts(emb, 1) AS dim FROM vectors),
sums AS (SELECT {keys}, dim, sum(v) AS s, count(*) AS n FROM entries GROUP BY {keys}, dim),
coherence AS (
  SELECT {keys}, (sum(s * s) - any_value(n)) / (any_value(n) * CAST(any_value(n) - 1 AS DOUBLE)) AS mean_within_cos,
         any_value(n) AS n_obs
  FROM sums WHERE n >= 2 GROUP BY {keys})"""


# --- centroids ----------------------------------------------------------------------------


@query("""SELECT vec_id, dim, round(v / sqrt(n2), 6) AS value FROM (
            SELECT vec_id, unnest(emb) AS v, generate_subscripts(emb, 1) AS dim, list_dot_product(emb, emb) AS n2
            FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS emb FROM embeddings))""")
def unit_vectors(spark, sf_dir):
    table = load_table(spark, f"{sf_dir}/embeddings.parquet")
    unit = table.select("vec_id", V.unit_or_nan(F.col("embedding")).alias("u"))
    return _long(unit, ["vec_id"], "u")


@query(f"WITH {_means('firm')} SELECT firm, n_offers, dim, round(value, 6) AS value FROM means")
def centroids_firm(spark, sf_dir):
    return _long(G.centroids(vectors(spark, sf_dir), ["firm"], "embedding"), ["firm", "n_offers"], "centroid")


@query(f"WITH {_means('occ')} SELECT occ, n_offers, dim, round(value, 6) AS value FROM means")
def centroids_occ(spark, sf_dir):
    table = G.centroids(vectors(spark, sf_dir), ["occ"], "embedding", code_col="occ")
    return _long(table, ["occ", "n_offers"], "centroid")


@query(f"WITH {_means('firm, occ')} SELECT firm, occ, n_offers, dim, round(value, 6) AS value FROM means WHERE firm <> ''")
def centroids_firm_occ(spark, sf_dir):
    table = G.centroids(vectors(spark, sf_dir), ["firm", "occ"], "embedding", "occ", drop_empty=True)
    return _long(table, ["firm", "occ", "n_offers"], "centroid")


_NEAREST = """near AS (
  SELECT a.{k}, round(list_dot_product(a.emb, t.emb)
           / sqrt(list_dot_product(a.emb, a.emb) * list_dot_product(t.emb, t.emb)), 6) AS cosine_similarity
  FROM centroids a JOIN centroids t ON t.{k} = '{target}' AND a.{k} <> t.{k}
  ORDER BY 2 DESC, 1 LIMIT 10)"""


@query(f"WITH {_means('occ')}, {_NEAREST.format(k='occ', target='D1000')} SELECT occ, cosine_similarity FROM near")
def topk_occ(spark, sf_dir):
    table = G.centroids(vectors(spark, sf_dir), ["occ"], "embedding", code_col="occ")
    nearest = G.top_k_similar(table, "occ", "D1000", 10)
    return nearest.withColumn("cosine_similarity", F.round("cosine_similarity", 6))


@query(
    f"""WITH {_means('firm')}, {_NEAREST.format(k='firm', target='src3')},
        names AS (SELECT firm, arg_min(firm_name, vec_id) AS firm_name FROM vectors GROUP BY firm)
        SELECT firm, firm_name, cosine_similarity FROM near LEFT JOIN names USING (firm)"""
)
def topk_firm(spark, sf_dir):
    table = vectors(spark, sf_dir)
    nearest = G.top_k_similar_firms(
        G.centroids(table, ["firm"], "embedding"), table, "src3", 10, "firm", "firm_name", "vec_id"
    )
    return nearest.withColumn("cosine_similarity", F.round("cosine_similarity", 6))


@query(f"WITH {VECTORS} SELECT firm, arg_min(firm_name, vec_id) AS firm_name FROM vectors GROUP BY firm")
def firm_names(spark, sf_dir):
    return G.first_names(vectors(spark, sf_dir), "firm", "firm_name", "vec_id")


@query(f"WITH {VECTORS} SELECT occ, count(*) AS n_offers FROM vectors GROUP BY occ ORDER BY 2 DESC, 1 LIMIT 5")
def top_groups(spark, sf_dir):
    table = G.centroids(vectors(spark, sf_dir), ["occ"], "embedding", code_col="occ")
    return G.largest_groups(table, "occ", "n_offers", 5).select("occ", "n_offers")


# --- coherence -------------------------------------------------------------------------------


def _rounded(frame: DataFrame) -> DataFrame:
    return frame.withColumn("mean_within_cos", F.round("mean_within_cos", 6))


@query(f"WITH {_coherence('firm')} SELECT firm, round(mean_within_cos, 6) AS mean_within_cos, n_obs FROM coherence")
def within_firm(spark, sf_dir):
    return _rounded(G.within_group_coherence(vectors(spark, sf_dir), ["firm"], "embedding"))


@query(f"WITH {_coherence('occ')} SELECT occ, round(mean_within_cos, 6) AS mean_within_cos, n_obs FROM coherence")
def within_occ(spark, sf_dir):
    return _rounded(G.within_group_coherence(vectors(spark, sf_dir), ["occ"], "embedding"))


@query(
    f"""WITH {_coherence('firm, occ')} SELECT firm, occ, round(mean_within_cos, 6) AS mean_within_cos, n_obs
        FROM coherence WHERE n_obs >= 3"""
)
def within_firm_occ(spark, sf_dir):
    return _rounded(
        G.within_group_coherence(vectors(spark, sf_dir), ["firm", "occ"], "embedding", min_obs=3)
    )


@query(
    f"""WITH {_coherence('firm, occ')}
        SELECT count(*) AS n_groups, round(avg(mean_within_cos), 6) AS mean_cos,
               round(stddev_pop(mean_within_cos), 6) AS std_cos, round(quantile_cont(mean_within_cos, 0.5), 6) AS median_cos
        FROM coherence WHERE n_obs >= 3"""
)
def coherence_summary(spark, sf_dir):
    groups = G.within_group_coherence(vectors(spark, sf_dir), ["firm", "occ"], "embedding", 3)
    summary = G.coherence_summary(groups)
    return summary.withColumns({c: F.round(c, 6) for c in ("mean_cos", "std_cos", "median_cos")})


@query(
    f"""WITH {_coherence('firm, occ')}
        SELECT count(*) AS count, round(avg(n_obs), 6) AS mean, round(stddev_samp(n_obs), 6) AS std, min(n_obs) AS min,
               round(quantile_cont(n_obs, 0.25), 6) AS p25, round(quantile_cont(n_obs, 0.5), 6) AS p50,
               round(quantile_cont(n_obs, 0.75), 6) AS p75, max(n_obs) AS max
        FROM coherence WHERE n_obs >= 3"""
)
def group_size_summary(spark, sf_dir):
    groups = G.within_group_coherence(vectors(spark, sf_dir), ["firm", "occ"], "embedding", 3)
    summary = G.group_size_summary(groups)
    return summary.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


@query(
    f"""WITH {_coherence('occ')} SELECT occ, round(mean_within_cos, 6) AS mean_within_cos, n_obs FROM coherence
        WHERE mean_within_cos > -0.01 ORDER BY 2 DESC"""
)
def coherent_groups(spark, sf_dir):
    groups = G.within_group_coherence(vectors(spark, sf_dir), ["occ"], "embedding")
    return _rounded(G.coherent_groups(groups, above=-0.01))


@query(
    f"""WITH {_coherence('firm, occ')},
        e AS (SELECT min(mean_within_cos) AS lo, (max(mean_within_cos) - min(mean_within_cos)) / 80 AS w FROM coherence),
        c AS (SELECT CAST(least(floor((mean_within_cos - lo) / w), 79) AS INTEGER) AS bin, count(*) AS n FROM coherence, e GROUP BY 1)
        SELECT CAST(b.i AS INTEGER) AS bin, round(lo + b.i * w, 6) AS lower, coalesce(c.n, 0) AS n
        FROM e, range(80) b(i) LEFT JOIN c ON c.bin = b.i"""
)
def coherence_histogram(spark, sf_dir):
    groups = G.within_group_coherence(vectors(spark, sf_dir), ["firm", "occ"], "embedding")
    return S.column_histogram(groups, "mean_within_cos", 80).withColumn("lower", F.round("lower", 6))


# --- all pairs -------------------------------------------------------------------------------

_ALL_PAIRS = """units AS (
  SELECT row_number() OVER () AS i, list_transform(emb, lambda x: x / sqrt(list_dot_product(emb, emb))) AS u FROM {source}),
cosines AS (SELECT list_dot_product(a.u, b.u) AS c FROM units a JOIN units b ON a.i < b.i)"""
_EMBEDDED = "embedded AS (SELECT CAST(embedding AS DOUBLE[]) AS emb FROM embeddings)"
_PAIR_STATS = """SELECT (SELECT count(*) FROM units) AS n_rows, count(*) AS n_pairs, round(avg(c), 6) AS mean_cos,
       round(stddev_pop(c), 6) AS std_cos FROM cosines"""
_PAIR_BINS = """e AS (SELECT min(c) AS lo, (max(c) - min(c)) / {bins} AS w FROM cosines),
h AS (SELECT CAST(least(floor((c - lo) / w), {bins} - 1) AS INTEGER) AS bin, count(*) AS n FROM cosines, e GROUP BY 1)
SELECT CAST(b.i AS INTEGER) AS bin, round(lo + b.i * w, 6) AS lower, coalesce(h.n, 0) AS n_pairs
FROM e, range({bins}) b(i) LEFT JOIN h ON h.bin = b.i"""


def _rounded_stats(frame: DataFrame) -> DataFrame:
    return frame.withColumns({c: F.round(c, 6) for c in ("mean_cos", "std_cos")})


@query(f"WITH {_EMBEDDED}, {_ALL_PAIRS.format(source='embedded')} {_PAIR_STATS}")
def pair_stats(spark, sf_dir):
    return _rounded_stats(S.pair_statistics(load_table(spark, f"{sf_dir}/embeddings.parquet"), "embedding"))


@query(f"WITH {_means('firm')}, {_ALL_PAIRS.format(source='centroids')} {_PAIR_STATS}")
def pair_stats_firm(spark, sf_dir):
    table = G.centroids(vectors(spark, sf_dir), ["firm"], "embedding")
    return _rounded_stats(S.pair_statistics(table, "centroid"))


@query(f"WITH {_means('occ')}, {_ALL_PAIRS.format(source='centroids')} {_PAIR_STATS}")
def pair_stats_occ(spark, sf_dir):
    table = G.centroids(vectors(spark, sf_dir), ["occ"], "embedding", code_col="occ")
    return _rounded_stats(S.pair_statistics(table, "centroid"))


@query(f"WITH {_EMBEDDED}, {_ALL_PAIRS.format(source='embedded')}, {_PAIR_BINS.format(bins=300)}")
def pair_histogram(spark, sf_dir):
    table = load_table(spark, f"{sf_dir}/embeddings.parquet")
    return S.pair_histogram(table, "vec_id", "embedding", 300).withColumn("lower", F.round("lower", 6))


@query(f"WITH {_means('firm')}, {_ALL_PAIRS.format(source='centroids')}, {_PAIR_BINS.format(bins=300)}")
def pair_histogram_firm(spark, sf_dir):
    table = G.centroids(vectors(spark, sf_dir), ["firm"], "embedding")
    return S.pair_histogram(table, "firm", "centroid", 300).withColumn("lower", F.round("lower", 6))


@query(f"WITH {_means('occ')}, {_ALL_PAIRS.format(source='centroids')}, {_PAIR_BINS.format(bins=300)}")
def pair_histogram_occ(spark, sf_dir):
    table = G.centroids(vectors(spark, sf_dir), ["occ"], "embedding", code_col="occ")
    return S.pair_histogram(table, "occ", "centroid", 300).withColumn("lower", F.round("lower", 6))


def make_space_model():
    """A stand-in for a caller's model: characters and spaces."""

    def predict(texts):
        return np.array([[len(t) + 1, t.count(" ")] for t in texts], dtype=np.float32)

    return predict


# --- components and embeddings -----------------------------------------------------------------


@query()
def pca_variance(spark, sf_dir):
    table = load_table(spark, f"{sf_dir}/embeddings.parquet")
    shares = P.explained_variance(table, "embedding")
    return shares.withColumns({c: F.round(c, 6) for c in ("explained", "cumulative")})


@query()
def pca_projection(spark, sf_dir):
    table = load_table(spark, f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return P.reduce_vectors(table, "embedding").select("vec_id", "embedding_pca")


@query(
    """WITH entries AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings),
       means AS (SELECT dim, avg(v) AS m FROM entries GROUP BY dim)
       SELECT vec_id, round(sum((v - m) * (v - m)), 6) AS squared_length FROM entries JOIN means USING (dim) GROUP BY vec_id"""
)
def pca_lengths(spark, sf_dir):
    """With all components, projection keeps every length from the mean."""
    table = load_table(spark, f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    basis = P.fit_components(table, "embedding")
    turned = P.project(table, "embedding", basis, 64, "turned", "array<double>")
    return turned.select("vec_id", F.round(V.squared_norm(F.col("turned")), 6).alias("squared_length"))


@query(
    """WITH entries AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings),
       covariances AS (SELECT a.dim AS i, b.dim AS j, covar_samp(a.v, b.v) AS c FROM entries a JOIN entries b USING (vec_id) GROUP BY 1, 2)
       SELECT count(DISTINCT i) AS n_components, round(sum(c) FILTER (i = j), 6) AS total, round(sum(c * c), 6) AS squares
       FROM covariances"""
)
def pca_spectrum(spark, sf_dir):
    """The variances of the projected columns add up to the trace of the covariance
    matrix, and their squares to its squared norm only if the basis diagonalises it."""
    table = load_table(spark, f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    turned = P.project(table, "embedding", P.fit_components(table, "embedding"), 64, "turned", "array<double>")
    parts = turned.select(F.posexplode("turned").alias("i", "x")).groupBy("i").agg(F.var_samp("x").alias("variance"))
    return parts.agg(
        F.count("*").alias("n_components"), F.round(F.sum("variance"), 6).alias("total"),
        F.round(F.sum(F.col("variance") * F.col("variance")), 6).alias("squares"),
    )


@query()
def centroid_map_2d(spark, sf_dir):
    table = G.centroids(vectors(spark, sf_dir), ["occ"], "embedding", code_col="occ")
    return P.centroid_map(table, "occ").withColumns({c: F.round(c, 6) for c in ("x", "y")})


@query(
    f"""SELECT doc_id, round(CAST(CAST(a / sqrt(a * a + b * b) AS FLOAT) AS DOUBLE), 5) AS x,
               round(CAST(CAST(b / sqrt(a * a + b * b) AS FLOAT) AS DOUBLE), 5) AS y
        FROM (SELECT doc_id, length(text) + 1 AS a, length(text) - length(replace(text, ' ', '')) AS b FROM documents)"""
)
def embedding_by_model(spark, sf_dir):
    """Unit vectors from a caller's model."""
    embedded = embed_texts(documents(spark, sf_dir), "text", make_space_model)
    entries = [F.round(F.col("embedding")[i].cast("double"), 5).alias(n) for i, n in enumerate("xy")]
    return embedded.select("doc_id", *entries)


@query(r"SELECT doc_id, CASE WHEN regexp_matches(text, '[\p{L}\p{N}]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS length FROM documents")
def embedding_lengths(spark, sf_dir):
    """Every text with a word has a vector of length one."""
    embedded = embed_by_words(documents(spark, sf_dir), "text")
    return embedded.select("doc_id", F.round(V.norm(F.col("embedding")), 4).alias("length"))


@query()
def embedding_default(spark, sf_dir):
    return embed_by_words(documents(spark, sf_dir), "text").select("doc_id", "embedding")
