"""WARC archives: a writer, and a reader that splits files at any byte.

A file is a run of gzip members with one record each. A reading task gets a byte
range and owns the records whose member starts inside it. It looks for the gzip
magic, and takes a place for a member if its first bytes decode to a WARC header,
the member decodes to its end, and what follows is another such member or the end
of the file; from then on members follow one another. Magic bytes inside compressed
data fail these tests. Where only the last test fails, the member may lie inside a
larger one or before a damaged one: the range then looks backward for a member around
it. An archive that lies uncompressed inside a record, as several members, is the one
input for which a range could start wrongly.

Damage: the first range starts at byte 0, and a task that has come to its end tests the
member that follows, so that every stretch that does not decode is met by the one task
that knows where it starts. It is an error, or by ``damaged="list"`` one row of type
``damaged`` with its file and place; records before and behind it are read. A whole
record that lies uncompressed in a damaged one counts as a record.

Results for special input: a null payload is empty; a null address is the record's
own name; of equal payloads that are long enough, all rows with the largest page id
are responses and the others revisit it, rows without an id included; if no row has an id, all
are responses; an empty table gives no files and no rows. Other columns are not
used.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerscope.llm import files
from offerscope.llm.common import BROADCAST_BYTES, measured_join, plain
from offerscope.session import materialize, scratch_path

#: Fixed values of the formats.
VERSION, END = b"WARC/1.1\r\n", b"\r\n\r\n"
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this many bytes are always stored.
LEAST_REVISIT = 1000
SPLIT_BYTES = 64 * 1024 * 1024
FILE_BYTES = 1024 * 1024 * 1024
READ_BYTES = 1024 * 1024
BATCH_ROWS = 256
HEADER_BYTES, MEMBER_BYTES = 4 * 1024, 16 * 1024

_DATE = "2000-01-01T00:00:00Z"


def page_name(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record(page_id: int | None, url: str | None, payload: bytes, original: int | None, original_url: str | None) -> bytes:
    """One gzip member. A revisit keeps the response's head, with the payload's length,
    and the digest, but no payload."""
    revisit = original is not None
    uri = lambda x, other: urllib.parse.quote(x, safe=":/?#[]@!$&'()*+,;=%") if x else other
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_name(page_id)} {url} {digest}')}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {uri(url, page_name(page_id))}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To-Target-URI: {uri(original_url, page_name(original))}",
            f"WARC-Refers-To-Page-ID: {original}",
        ]
    head = VERSION + "\r\n".join(lines).encode() + END
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(head + block + END) + packer.flush()


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = LEAST_REVISIT,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Write a record per row and return the table of files: ``file, bytes, records``.

    Only lengths and digests are shuffled, with partial aggregation. What the equal
    payloads refer to is joined by broadcast, or over salts beyond ``limit`` bytes,
    so that payloads are written where they lie.
    """
    held = pages.select(
        plain(id_col).cast("long").alias("page_id"),
        plain(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(plain(payload_col).cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    keyed = held.withColumn("key", F.when(F.length("payload") >= least, F.sha2("payload", 256)))
    equal = (
        keyed.filter("key is not null")
        .groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"), F.max("page_id").alias("original"),
            F.max_by(F.struct("url"), F.struct("page_id", "url")).alias("source"),
        )
        .filter("n > 1 and original is not null")
    )
    equal = materialize(equal.select("key", "original", F.col("source.url").alias("original_url")), "equal")
    rows = measured_join(keyed.withColumn("salt", F.xxhash64("page_id", "url")), equal, ["key"], "left", "salt", limit)
    own = F.coalesce(F.col("page_id") == F.col("original"), F.lit(False))
    rows = rows.select("page_id", "url", "payload", F.when(~own, F.col("original")).alias("original"), "original_url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, name, size, count, done = None, "", 0, 0, []
        part = TaskContext.get().partitionId()
        for batch in batches:
            rows = (row for at in range(0, batch.num_rows, BATCH_ROWS) for row in batch.slice(at, BATCH_ROWS).to_pylist())
            for row in rows:
                if stream is None:
                    (stream, name), size, count = files.new_file(folder, part, ".warc.gz"), 0, 0
                data = record(row["page_id"], row["url"], row["payload"], row["original"], row["original_url"])
                stream.write(data)
                size, count = size + len(data), count + 1
                if size >= FILE_BYTES:
                    stream.close()
                    done.append((name, size, count))
                    stream = None
        if stream is not None:
            stream.close()
            done.append((name, size, count))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*done), (pa.string(), pa.int64(), pa.int64()))],
                ["file", "bytes", "records"],
            )

    schema = "file string, bytes long, records long"
    path = scratch_path(pages.sparkSession, "archives")
    rows.mapInArrow(write, schema).write.parquet(path)
    return pages.sparkSession.read.schema(schema).parquet(path)


class Members:
    """The gzip members that start in ``[start, end)`` of a file, decoded."""

    def __init__(self, file, start: int, end: int):
        self.file, self.start, self.end, self.size = file, start, end, file.size()
        self.held, self.from_ = b"", 0

    def _read(self, place: int, length: int) -> bytes:
        """At most ``length`` bytes from ``place``; the file is read in larger blocks."""
        length = min(length, self.size - place)
        at = place - self.from_
        if at < 0 or at + length > len(self.held):
            self.file.seek(place)
            self.held, self.from_, at = self.file.read(max(length, READ_BYTES)), place, 0
        return self.held[at : at + length]

    def header(self, place: int) -> bool:
        """Whether a member with a WARC header begins there."""
        data = self._read(place, HEADER_BYTES)
        if not data.startswith(MAGIC):
            return False
        try:
            return zlib.decompressobj(31).decompress(data, len(VERSION)).startswith(b"WARC/")
        except zlib.error:
            return False

    def member(self, place: int) -> tuple[bytes, int] | None:
        """The member's content and the place behind it; None if it does not decode."""
        inflate, parts, at = zlib.decompressobj(31), [], place
        try:
            while not inflate.eof:
                data = self._read(at, MEMBER_BYTES)
                if not data:
                    return None
                parts.append(inflate.decompress(data))
                at += len(data)
        except zlib.error:
            return None
        return b"".join(parts), at - len(inflate.unused_data)

    def whole(self, place: int) -> tuple[bytes, int] | None:
        """The member there if it has a WARC header and decodes to its end."""
        return self.member(place) if self.header(place) else None

    def _magic(self, start: int, end: int) -> Iterator[int]:
        """Places in ``[start, end)`` where a member with a WARC header seems to begin."""
        for place in range(start, end, READ_BYTES):
            length = min(READ_BYTES, end - place)
            data = self._read(place, length + len(MAGIC) - 1)
            at = data.find(MAGIC)
            while 0 <= at < length:
                if self.header(place + at):
                    yield place + at
                at = data.find(MAGIC, at + 1)

    def _end_around(self, place: int) -> int | None:
        """The end of a member that starts before ``place`` and goes on behind it; None if
        there is none or a member ends right there."""
        end = place
        while end > 0:
            start = max(0, end - READ_BYTES)
            for at in reversed(list(self._magic(start, end))):
                found = self.member(at)
                if found and found[1] >= place:
                    return found[1] if found[1] > place else None
            end = start
        return None

    def first(self) -> int | None:
        """Where the first whole member of the range starts. At byte 0 there must be one."""
        if self.start == 0:
            return 0 if min(self.end, self.size) > 0 else None
        for at in self._magic(self.start, self.end):
            found = self.member(at)
            if not found:
                continue
            if found[1] == self.size or self.header(found[1]):
                return at
            around = self._end_around(at)
            if around is None:
                return at
            if around < self.end and self.whole(around):
                return around
            return self._next_whole(around)
        return None

    def _next_whole(self, place: int) -> int | None:
        return next((at for at in self._magic(place, self.end) if self.member(at)), None)

    def records(self) -> Iterator[tuple[int, bytes | None]]:
        """Place and content of each member; the content is None where a damaged stretch
        starts."""
        place = self.first()
        while place is not None and place < self.end:
            found = self.whole(place)
            if found:
                yield place, found[0]
                place = found[1]
                if self.end <= place < self.size and not self.whole(place):
                    yield place, None
            else:
                yield place, None
                place = self._next_whole(place + 1)

    def __iter__(self) -> Iterator[bytes]:
        for place, data in self.records():
            if data is None:
                raise ValueError(f"a damaged record at byte {place}")
            yield data


def parse(data: bytes) -> dict:
    """Headers and payload of a record. The digest of a stored payload must be right."""
    head, _, block = data.partition(END)
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode()] = value.strip().decode()
    block = block[: int(fields["content-length"])]
    http, _, payload = block.partition(END)
    length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if fields["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    number = lambda key: int(fields[key]) if fields.get(key) else None
    return {
        "record_type": fields["warc-type"],
        "uri": fields["warc-target-uri"],
        "page_id": number("warc-page-id"),
        "refers_to": number("warc-refers-to-page-id"),
        "payload_digest": digest,
        "payload_bytes": int(length[1]) if length else len(payload),
        "payload": payload if fields["warc-type"] == "response" else None,
    }


def read_warc(
    spark: SparkSession, archives: DataFrame, split_bytes: int = SPLIT_BYTES, damaged: str = "raise"
) -> DataFrame:
    """A row per record of the files in ``archives`` (``file, bytes``), with its file and
    the byte it starts at. A file longer than ``split_bytes`` is read by several tasks.
    ``damaged``: ``raise``, or ``list`` for a row per damaged stretch."""
    if damaged not in ("raise", "list"):
        raise ValueError(f"damaged must be raise or list, not {damaged}")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    ranges = archives.select("file", "bytes", F.explode(starts).alias("start"))
    ranges = ranges.select("file", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end"))
    tasks = max(1, ranges.count())
    kinds = {
        "record_type": pa.string(), "uri": pa.string(), "page_id": pa.int64(), "refers_to": pa.int64(),
        "payload_digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary(),
        "file": pa.string(), "place": pa.int64(),
    }

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in rows], kind) for k, kind in kinds.items()], list(kinds))

    def row_of(file: str, place: int, data: bytes | None) -> dict:
        row = {"record_type": "damaged"}
        try:
            if data is None:
                raise ValueError("it does not decode")
            row = parse(data)
        except (KeyError, ValueError) as error:
            if damaged == "raise":
                raise ValueError(f"a damaged record at byte {place} of {file}: {error}") from error
        return row | {"file": file, "place": place}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for task in batch.to_pylist():
                with files.open_file(task["file"]) as file:
                    for place, data in Members(file, task["start"], task["end"]).records():
                        rows.append(row_of(task["file"], place, data))
                        held += len(data or b"")
                        if held >= 4 * READ_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
        if rows:
            yield batch_of(rows)

    schema = (
        "record_type string, uri string, page_id long, refers_to long, payload_digest string, payload_bytes long, "
        "payload binary, file string, place long"
    )
    return ranges.repartition(min(tasks, 100_000), "file", "start").mapInArrow(read, schema)


def digest(records: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
