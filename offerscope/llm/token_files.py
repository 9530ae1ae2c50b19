"""Token ids in binary files of which readers decompress only what they need.

A file is a run of independent zstandard frames, each of a fixed number of ids and
with its own content checksum; then a skippable frame with the documents of the
file; then the seek table of the zstandard seekable format: sizes and checksum of
each frame, and a footer. Ids are little-endian unsigned 16- or 32-bit integers.
Files follow one another in ascending document order.

Results for special input: a null or empty text is the end id alone; equal ids
follow one another in the order of their rows; null ids come first; an empty table gives
no files and no rows. Other columns are not used.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerscope.llm import files
from offerscope.llm.common import plain
from offerscope.llm.tokens import encoder, slices
from offerscope.session import scratch_path

FRAME_IDS = 65_536
BATCH_TEXTS = 1024
#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE, DOCUMENTS = 0x184D2A5E, 0x8F92EAB1, 0x184D2A50
_FOOTER, _ENTRY, _HEAD, _DOCUMENT = "<IBI", "<III", "<II", "<?qq"


class FileWriter:
    """Writes one file; ``close`` returns the number of ids."""

    def __init__(self, stream, width: int, frame_ids: int = FRAME_IDS, level: int = 1):
        self.stream, self.width, self.frame = stream, width, frame_ids * width
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True).compress
        self.rest, self.entries, self.documents, self.ids = bytearray(), [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids`` as little-endian unsigned 32-bit integers."""
        count = len(ids) // 4
        self.documents.append(struct.pack(_DOCUMENT, doc_id is not None, doc_id or 0, count))
        self.ids += count
        if self.width == 2:
            numbers = np.frombuffer(ids, "<u4")
            if count and numbers.max() > 0xFFFF:
                raise ValueError("an id does not fit 16 bits")
            ids = numbers.astype("<u2").tobytes()
        self.rest += ids
        if len(self.rest) >= self.frame:
            whole = len(self.rest) // self.frame * self.frame
            for at in range(0, whole, self.frame):
                self._frame(bytes(self.rest[at : at + self.frame]))
            del self.rest[:whole]

    def _frame(self, raw: bytes) -> None:
        data = self.compress(raw)
        self.entries.append(struct.pack(_ENTRY, len(data), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.stream.write(data)

    def close(self) -> int:
        if self.rest:
            self._frame(bytes(self.rest))
        index = struct.pack("<BQ", self.width, len(self.documents)) + self.compress(b"".join(self.documents))
        table = b"".join(self.entries) + struct.pack(_FOOTER, len(self.entries), 0x80, SEEKABLE)
        self.stream.write(struct.pack(_HEAD, DOCUMENTS, len(index)) + index)
        self.stream.write(struct.pack(_HEAD, SKIPPABLE, len(table)) + table)
        self.stream.close()
        return self.ids


class FileReader:
    """Reads documents of one file by their place in it."""

    def __init__(self, file):
        self.file, self.inflate = file, zstandard.ZstdDecompressor()
        size = file.size()
        frames, _, magic = struct.unpack(_FOOTER, self._at(size - struct.calcsize(_FOOTER), struct.calcsize(_FOOTER)))
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end of the file")
        table = struct.calcsize(_FOOTER) + frames * struct.calcsize(_ENTRY)
        self.entries = list(struct.iter_unpack(_ENTRY, self._at(size - table, frames * struct.calcsize(_ENTRY))))
        self.starts, self.froms = [0], [0]
        for packed, raw, _ in self.entries:
            self.starts.append(self.starts[-1] + packed)
            self.froms.append(self.froms[-1] + raw)
        begin = self.starts[-1]
        _, length = struct.unpack(_HEAD, self._at(begin, struct.calcsize(_HEAD)))
        index = self._at(begin + struct.calcsize(_HEAD), length)
        self.width, count = struct.unpack_from("<BQ", index)
        raw = self.inflate.decompress(index[9:], max_output_size=max(1, count * struct.calcsize(_DOCUMENT))) if count else b""
        self.documents, start = [], 0
        for known, doc_id, ids in struct.iter_unpack(_DOCUMENT, raw):
            self.documents.append((doc_id if known else None, start, ids))
            start += ids
        self.held = (-1, b"")

    def _at(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        return self.file.read(length)

    def _frame(self, number: int) -> bytes:
        if self.held[0] != number:
            packed, raw, check = self.entries[number]
            data = self.inflate.decompress(self._at(self.starts[number], packed), max_output_size=raw)
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {number} is damaged")
            self.held = (number, data)
        return self.held[1]

    def ids(self, start: int, count: int) -> bytes:
        """``count`` ids from ``start`` as little-endian unsigned 32-bit integers."""
        begin, end = start * self.width, (start + count) * self.width
        size = self.entries[0][1] if self.entries else 1  # all frames but the last are as long
        parts = []
        for number in range(begin // size, -(-end // size) if end else 0):
            frame = self._frame(number)
            at = self.froms[number]
            parts.append(frame[max(0, begin - at) : end - at])
        data = b"".join(parts)
        return data if self.width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def write_token_files(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    width: int = 2,
    plain_controls: bool = False,
) -> DataFrame:
    """Write the documents in ascending order of their long ids; returns the table of
    the files: ``part, file, n_docs, n_ids, start`` (ids in the files before).

    One shuffle by ranges of ids; the row number breaks ties, so one id that many rows
    share is spread as well. Each task writes a file.
    """
    spark = documents.sparkSession
    held = documents.select(
        plain(id_col).cast("long").alias("doc_id"),
        plain(text_col).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    tail = end_id.to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, writer, part, count = encoder(tokenizer, plain_controls).encode, None, TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in slices(batch, "text"):
                if writer is None:
                    stream, name = files.new_file(folder, part, ".ids.zst")
                    writer = FileWriter(stream, width)
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), encode(some.column("text").to_pylist())):
                    writer.add(doc_id, ids + tail)
                    count += 1
        if writer is not None:
            total = writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [name], "n_docs": [count], "n_ids": [total]}
            )

    schema = "part int, file string, n_docs long, n_ids long"
    sorted_ = held.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    path = scratch_path(spark, "token-files")
    sorted_.select("doc_id", "text").mapInArrow(write, schema).write.parquet(path)
    rows, start, known = spark.read.parquet(path).orderBy("part").collect(), 0, []  # one row per file
    for row in rows:
        known.append((*row, start))
        start += row["n_ids"]
    return spark.createDataFrame(known, schema + ", start long")


def read_token_files(spark: SparkSession, table: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the files of ``table``; with ``doc_ids`` only
    those documents, of which alone the frames are decompressed."""
    wanted = None if doc_ids is None else set(doc_ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_file(row["file"]) as file:
                    reader = FileReader(file)
                    chosen = [d for d in reader.documents if wanted is None or d[0] in wanted]
                    for at in range(0, len(chosen), BATCH_TEXTS):
                        some = chosen[at : at + BATCH_TEXTS]
                        yield pa.RecordBatch.from_pydict(
                            {
                                "doc_id": pa.array([d[0] for d in some], pa.int64()),
                                "start": pa.array([row["start"] + d[1] for d in some], pa.int64()),
                                "n_tokens": pa.array([d[2] for d in some], pa.int64()),
                                "ids": pa.array([reader.ids(d[1], d[2]) for d in some], pa.binary()),
                            }
                        )

    count = max(1, table.count())
    tasks = table.select("file", "start").repartitionByRange(min(count, 10_000), "start")
    return tasks.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def digest(read: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

