"""Ads that keep arriving: label or score each one once, across restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def arriving_offers(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def once_each(arrivals: DataFrame, id_col: str, event_col: str | None = None, keep_for: str = "30 days") -> DataFrame:
    """Arrivals whose id did not arrive before; all that have none.

    Seen ids are in the state store under the query's checkpoint, spread by id, so no
    batch reads an earlier result. With ``event_col``, a timestamp, an id is forgotten
    ``keep_for`` after it came, and arrivals older than that are left out as late;
    without it all ids are kept.
    """
    if event_col is None:
        named = arrivals.filter(F.col(id_col).isNotNull()).dropDuplicates([id_col])
        return named.unionByName(arrivals.filter(F.col(id_col).isNull()))
    # one branch: with two, the one without rows would hold the watermark back
    key = F.coalesce(F.concat(F.lit("id "), F.col(id_col).cast("string")), F.concat(F.lit("row "), F.uuid()))
    keyed = arrivals.withColumn("_arrival", key).withWatermark(event_col, keep_for)
    return keyed.dropDuplicatesWithinWatermark(["_arrival"]).drop("_arrival")


def process_arrivals(
    arrivals: DataFrame,
    id_col: str,
    transform: Callable[[DataFrame], DataFrame],
    store_path: str,
    checkpoint_path: str,
    event_col: str | None = None,
    keep_for: str = "30 days",
) -> StreamingQuery:
    """Starts a query that takes what has arrived, applies ``transform`` to ads
    that did not arrive before, appends the result, and ends.

    The checkpoint remembers which files were read and, by batch, which ids. Each
    batch is written to a folder of its own by overwriting, so a batch that is repeated
    after a failure, with the state it had before, replaces its first attempt. Rows
    without an id are all taken.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{store_path}/batch={batch_id}")

    return (
        once_each(arrivals, id_col, event_col, keep_for)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def read_results(spark: SparkSession, store_path: str) -> DataFrame:
    return spark.read.parquet(store_path).drop("batch")


def clean_arrivals(drop_keys: DataFrame, text_col: str, firm_col: str, id_col: str):
    """A transform for ``process_arrivals`` that adds ``description_clean``."""
    from offerscope.operators.boilerplate import remove_boilerplate, segment_offers

    def transform(batch: DataFrame) -> DataFrame:
        segmented = segment_offers(batch, id_col, text_col, firm_col, keep_row=True)
        return remove_boilerplate(segmented, drop_keys)

    return transform
