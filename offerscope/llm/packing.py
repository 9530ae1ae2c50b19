"""Packing documents into token sequences of a fixed length.

Sum-of-squares packing: open sequences are counted per residual gap, and a piece
goes where the sum of the squared counts becomes smallest. Pieces come in
decreasing length, and a new sequence is opened only where no open one has room;
with these two rules it uses fewer sequences than in arrival order.

Results for special input: a null or empty text is one piece of the end id alone;
a document that is longer than a sequence is cut into full pieces and a rest, and
nothing else is cut; equal lengths are taken by row; repeated rows are packed each;
an empty table gives no rows. Other columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerscope.llm.common import plain
from offerscope.llm.tokens import encoder, slices
from offerscope.session import scratch_path

#: Pieces that are packed in one task; more pieces are packed in more groups.
GROUP_PIECES = 50_000


def cut_pieces(
    documents: DataFrame, tokenizer: str, id_col: str, text_col: str, length: int, end_id: int, plain_controls: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids``: the token ids of each document and then
    ``end_id``, cut every ``length`` ids. ``ids`` are little-endian unsigned 32 bits."""
    held = documents.select(plain(id_col).alias("doc_id"), plain(text_col).alias("text"))
    tail = end_id.to_bytes(4, "little")
    kind = held.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
         T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, plain_controls).encode
        step = 4 * length
        for batch in batches:
            for some in slices(batch, "text"):
                rows, number, starts, parts = [], [], [], []
                for row, ids in enumerate(encode(some.column("text").to_pylist())):
                    ids += tail
                    for k, start in enumerate(range(0, len(ids), step)):
                        rows.append(row)
                        number.append(k)
                        starts.append(start // 4)
                        parts.append(ids[start : start + step])
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array(number, pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array([len(x) // 4 for x in parts], pa.int64()),
                        pa.array(parts, pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    return held.mapInArrow(cut, schema)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each of ``lengths``, which must not increase.

    ``open_at[g]`` holds the open sequences with ``g`` ids of room. Taking one of
    them for a piece of ``n`` changes the sum of squares by ``1 - 2 count[g]`` and,
    unless it is full then, by ``1 + 2 count[g - n]``.
    """
    count = np.zeros(size + 1, dtype=np.int64)
    open_at: list[list[int]] = [[] for _ in range(size + 1)]
    sequence = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    used = 0
    for i, n in enumerate(lengths.tolist()):
        gaps = count[n:]
        gap = size
        if n < size:
            change = np.where(gaps > 0, 2 * (count[: size + 1 - n] - gaps) + 2, np.iinfo(np.int64).max)
            if gaps[0]:
                change[0] = 1 - 2 * gaps[0]
            best = int(change.argmin())
            if gaps[best]:
                gap = n + best
        if gap < size:
            where = open_at[gap].pop()
            count[gap] -= 1
        else:
            where, used = used, used + 1
        sequence[i], offset[i] = where, size - gap
        if gap > n:
            open_at[gap - n].append(where)
            count[gap - n] += 1
    return sequence, offset


def place_pieces(pieces: DataFrame, length: int, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``uid, sequence_id, offset`` for rows of ``uid, length``. Groups of about
    ``group_pieces`` rows are packed side by side; a group leaves a sequence or two
    that are not full."""
    total = pieces.count()
    groups = max(1, math.ceil(total / group_pieces))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "uid"], ascending=[False, True])
        sequence, offset = sum_of_squares(frame["length"].to_numpy(), length)
        return pd.DataFrame(
            {"uid": frame["uid"].to_numpy(), "sequence_id": sequence * groups + int(frame["part"].iloc[0]), "offset": offset}
        )

    part = F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int")
    return (
        pieces.select("uid", "length", part.alias("part"))
        .groupBy("part")
        .applyInPandas(pack, "uid long, sequence_id long, offset long")
    )


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 2048,
    end_id: int = 0,
    group_pieces: int = GROUP_PIECES,
    plain_controls: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The pieces with their ``ids``, and their places: ``sequence_id`` and ``offset``;
    both stored, with one row per piece and ``uid`` in common.

    Texts are tokenised once, where they lie; only lengths are shuffled to be placed.
    """
    spark = documents.sparkSession
    pieces = cut_pieces(documents, tokenizer, id_col, text_col, length, end_id, plain_controls)
    path, placed = scratch_path(spark, "pieces"), scratch_path(spark, "places")
    pieces.withColumn("uid", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    pieces = spark.read.parquet(path)
    place_pieces(pieces.select("uid", "length"), length, group_pieces).write.parquet(placed)
    return pieces, spark.read.parquet(placed)


def sequences(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed sequences. This moves all ids, once."""
    parts = pieces.select("uid", "ids").join(places, "uid").groupBy("sequence_id")
    parts = parts.agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return parts.select("sequence_id", joined.alias("ids"))


def digest(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """The columns of the registered query: of the ids only their checksum is shuffled."""
    narrow = pieces.select("uid", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return narrow.join(places, "uid").drop("uid")
