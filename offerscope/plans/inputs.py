"""The shared test tables in the roles of this library, for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerscope.sources.tables import load_table, spread


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(load_table(spark, f"{sf_dir}/documents.parquet"), "doc_id")


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an occupation code: the language's letter and the length.
    Lengths of other than four digits make it invalid."""
    code = F.concat(F.upper(F.substring("lang", 1, 1)), F.col("n_chars").cast("string"))
    return documents(spark, sf_dir).withColumn("occ", code)


OFFERS = """offers AS (
  SELECT *, upper(substr(lang, 1, 1)) || CAST(n_chars AS VARCHAR) AS occ FROM documents)"""
DOMAIN = "CASE WHEN regexp_matches(occ, '^[A-Z][0-9]{4}$') THEN substr(occ, 1, 1) ELSE 'UNKNOWN' END"


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with firm, firm name and occupation."""
    firms = load_table(spark, f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("vec_id"),
        F.col("source").alias("firm"),
        F.concat_ws(" ", "source", "lang").alias("firm_name"),
    )
    occupation = F.concat(F.char(F.lit(65) + F.col("label")), F.lit("1000"))
    embedded = load_table(spark, f"{sf_dir}/embeddings.parquet").withColumn("occ", occupation)
    return embedded.join(firms, "vec_id")


VECTORS = """vectors AS (
  SELECT e.vec_id, d.source AS firm, d.source || ' ' || d.lang AS firm_name,
         chr(65 + e.label) || '1000' AS occ, CAST(e.embedding AS DOUBLE[]) AS emb
  FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, with its labels where it has some."""
    marks = load_table(spark, f"{sf_dir}/labels.parquet")
    return offers(spark, sf_dir).join(marks, "doc_id", "left")


LABELLED = """labelled AS (
  SELECT o.*, l.quality, l.toxic FROM offers o LEFT JOIN labels l USING (doc_id))"""

LABELS = ["quality", "toxic"]
PAIRS = {"quality": ("quality", "proba_quality"), "toxic": ("toxic", "proba_toxic")}


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a derived score per label; many scores tie."""
    sizes = load_table(spark, f"{sf_dir}/documents.parquet").select("doc_id", "n_chars")
    scores = {
        f"proba_{label}": F.pmod(F.col("doc_id") * factor + F.col("n_chars"), F.lit(1000)) / 1000.0
        for label, factor in (("quality", 7919), ("toxic", 104729))
    }
    marks = load_table(spark, f"{sf_dir}/labels.parquet")
    return marks.join(sizes, "doc_id").withColumns(scores).drop("n_chars")


SCORED = """scored AS (
  SELECT l.doc_id, l.quality, l.toxic,
         ((l.doc_id * 7919 + d.n_chars) % 1000) / CAST(1000 AS DOUBLE) AS proba_quality,
         ((l.doc_id * 104729 + d.n_chars) % 1000) / CAST(1000 AS DOUBLE) AS proba_toxic
  FROM labels l JOIN documents d USING (doc_id))"""
LONG_SCORES = """long_scores AS (
  SELECT 'quality' AS label, quality AS y, proba_quality AS score FROM scored
  UNION ALL SELECT 'toxic', toxic, proba_toxic FROM scored)"""
