"""Tables, annotation records and small JSON artefacts."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    return name.rsplit(".", 1)[-1] if "." in name else ""


def load_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A ``.parquet`` or ``.csv`` table. Without a schema CSV columns are text."""
    kind = _suffix(path)
    if kind not in ("parquet", "csv"):
        raise ValueError(f"expected a .parquet or .csv path: {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.format(kind).load(path)


def save_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    kind = _suffix(path)
    if kind not in ("parquet", "csv"):
        raise ValueError(f"expected a .parquet or .csv path: {path}")
    writer = df.write.mode(mode)
    if kind == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(kind).save(path)


def save_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per value of ``split``; reading one of them skips the others."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def load_splits(
    spark: SparkSession, path: str, schema: T.StructType | str, names: list[str] | DataFrame | None = None
) -> DataFrame:
    """The table that ``save_splits`` wrote, ``split`` last, or only some of its splits:
    those in ``names``, or in the column ``split`` of a small table, which Spark reads
    first. Folders of other splits are not opened. An unknown name gives no rows."""
    split = T.StructField("split", T.StringType())
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    rest = [field for field in schema.fields if field.name != "split"]
    table = spark.read.schema(T.StructType([*rest, split])).parquet(path)
    if names is None:
        return table
    if isinstance(names, DataFrame):
        return table.join(F.broadcast(names.select("split").filter(F.col("split").isNotNull())), "split", "left_semi").select(
            *[field.name for field in rest], "split"
        )
    return table.filter(F.col("split").isin(names))


def spread(df: DataFrame, key_col: str) -> DataFrame:
    """Rows over all cores when the input is too small to fill them.

    A file with one row group is read by one task however large the cluster. A
    large table has more splits than cores and passes through unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key_col)


# --- annotation records -------------------------------------------------------------


def record_schema(labels: list[str]) -> T.StructType:
    return T.StructType(
        [T.StructField("id", T.StringType()), T.StructField("seq", T.LongType())]
        + [T.StructField(label, T.IntegerType()) for label in labels]
    )


def read_annotations(spark: SparkSession, path: str, labels: list[str]) -> DataFrame:
    """``id`` and labels from JSON lines, the latest line of an id.

    Lines in commits (``append_annotations``, ``annotate_store``) are ordered by their
    ``seq`` and come after all others; those by ``seq`` where they have one, then by file
    time, file, and place in the file. Blank and broken lines, lines that say an offer
    failed, and what unfinished appends left are skipped; a label that a line leaves out
    is null.
    """
    order = F.struct(
        F.contains(F.col("_metadata.file_path"), F.lit("/commit=")).alias("committed"),
        F.coalesce("seq", F.lit(-1)).alias("seq"),
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    lines = _record_lines(spark, readable_records(spark, path), labels)
    return (
        lines.filter(F.col("_failed").isNull() | ~F.col("_failed"))
        .select("id", F.struct(*labels).alias("record"), order.alias("order"))
        .filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.max_by("record", "order").alias("record"))
        .select("id", "record.*")
    )


def _record_lines(spark: SparkSession, paths: list[str], labels: list[str]) -> DataFrame:
    schema = record_schema(labels).add("_failed", T.BooleanType())
    if not paths:
        empty = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("file_modification_time", T.TimestampType()),
                              T.StructField("file_block_start", T.LongType())])
        return spark.createDataFrame([], schema.add("_metadata", empty))
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(paths)


def append_annotations(annotations: DataFrame, path: str, labels: list[str], seq: int | None = None) -> int:
    """Adds records as one commit, which is read whole or, until Spark's job committer has
    marked it complete, not at all. Returns its number, by default the next one; of an id
    that several commits hold, the highest number stands."""
    spark = annotations.sparkSession
    seq = next_commit(spark, path) if seq is None else seq
    rows = annotations.select("id", F.lit(seq).cast("long").alias("seq"), *labels)
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").json(commit_path(path, seq, "all"))
    return seq


def append_as_tasks_end(records: DataFrame, path: str, last_seq: int) -> str:
    """Adds records that are slow to come by: what a task made is in the store as soon as
    the task has ended, and stays if the job is lost. Rows carry ``seq``, at most
    ``last_seq``. A task that is repeated writes the same file again. Returns the folder.
    """
    folder = commit_path(path, last_seq, "each")
    records.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").json(folder)
    return folder


def commit_path(path: str, seq: int, kind: str) -> str:
    """``commit=<number>-<kind>-<unique>``: of kind ``all`` only complete ones count, of
    kind ``each`` every file does. Writers that run at once never share a folder."""
    return f"{path.rstrip('/')}/commit={seq:012d}-{kind}-{uuid.uuid4().hex}"


def next_commit(spark: SparkSession, path: str) -> int:
    """One more than the highest number of any commit, from the names of folders alone."""
    numbers = [re.match(r"commit=(\d+)-", name) for name, _ in _listed(spark, path)]
    return max((int(n[1]) + 1 for n in numbers if n), default=0)


def readable_records(spark: SparkSession, path: str) -> list[str]:
    """What of a store may be read: all of it, or all but the unfinished commits."""
    listed = _listed(spark, path)
    unfinished = {
        name for name, place in listed
        if re.match(r"commit=\d+-all-", name) and not path_exists(spark, f"{place}/_SUCCESS")
    }
    if not unfinished:
        return [path]
    return [place for name, place in listed if name not in unfinished and not name.startswith(("_", "."))]


def _listed(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Names and paths right under a folder; nothing for a file or where nothing is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place) or system.getFileStatus(place).isFile():
        return []
    return [(s.getPath().getName(), s.getPath().toString()) for s in system.listStatus(place)]


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


# --- artefacts ------------------------------------------------------------------------


def write_artefact(spark: SparkSession, value, path: str) -> None:
    """A small value (labels, thresholds, metrics, settings) as JSON text."""
    text = json.dumps(value, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_artefact(spark: SparkSession, path: str):
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def table_as_mapping(df: DataFrame, key_col: str, value_col: str) -> dict:
    """A table with one row per label as a mapping for ``write_artefact``."""
    return {row[key_col]: row[value_col] for row in df.select(key_col, value_col).collect()}
