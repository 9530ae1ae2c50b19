"""Resharding a table of files with the fewest bytes moved.

Old shards are lines of files; a minimum-cost flow from old sizes to new capacities
says how many bytes of each old shard stay and how many go where. The flow is laid
over the lines as byte intervals, so most files have one destination. A file is
rewritten only if some of its rows leave; files that stay whole are read where they
are. What cutting between rows leaves uneven is evened out with single rows beside
the cuts.

Results for special input: a null text has size 1 like an empty one; rows of a null
key share an old shard; repeated rows are placed each; a column of the table may have
any name; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerscope.llm.common import BROADCAST_BYTES, free_name, measured_join, plain
from offerscope.session import scratch_path

#: Rows on either side of a cut that may be placed singly.
NEAR_CUT = 64


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


@dataclass
class Layout:
    """A table in a folder with one subfolder per shard; ``old`` and ``size`` are the
    columns that hold a row's shard and size."""

    folder: str
    old: str
    size: str
    schema: T.StructType


def lay_out(table: DataFrame, shard: Column, text_col: str, folder: str) -> Layout:
    """Write ``table`` with one folder per shard; rows without a shard go to shard -1."""
    old = free_name(table, "old_shard")
    size = free_name(table, "row_bytes")
    sized = table.withColumn(size, size_of(plain(text_col))).withColumn(old, F.coalesce(shard.cast("int"), F.lit(-1)))
    sized.write.partitionBy(old).parquet(folder)
    return Layout(folder, old, size, sized.schema)


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> list[dict[int, int]]:
    """Flow from each source to sinks that sends all supply at the least total of
    ``cost(i, j)`` per byte: successive shortest paths with potentials. The graph has
    a node per shard, whatever the size of the data."""
    if sum(supply) > sum(capacity):
        raise ValueError("the capacities do not hold the supply")
    n, m = len(supply), len(capacity)
    flow: list[dict[int, int]] = [{} for _ in range(n)]
    left, room = list(supply), list(capacity)
    potential = [0] * (n + m)
    while any(left):
        # Dijkstra from all sources that have supply left, over residual edges
        distance = [None] * (n + m)
        before = [-1] * (n + m)
        heap = []
        for i in range(n):
            if left[i]:
                distance[i] = 0
                heap.append((0, i))
        heapq.heapify(heap)
        while heap:
            d, x = heapq.heappop(heap)
            if d > distance[x]:
                continue
            if x < n:
                steps = ((n + j, cost(x, j)) for j in range(m))
            else:
                steps = ((i, -cost(i, x - n)) for i in range(n) if flow[i].get(x - n))
            for y, weight in steps:
                reached = d + weight + potential[x] - potential[y]
                if distance[y] is None or reached < distance[y]:
                    distance[y], before[y] = reached, x
                    heapq.heappush(heap, (reached, y))
        far = max(d for d in distance if d is not None)
        for x in range(n + m):
            potential[x] += far if distance[x] is None else distance[x]
        end = min((x for x in range(n, n + m) if room[x - n] and distance[x] is not None), key=lambda x: potential[x])
        path = [end]
        while before[path[-1]] >= 0:
            path.append(before[path[-1]])
        path.reverse()
        amount = min(left[path[0]], room[end - n])
        for x, y in zip(path, path[1:]):
            if x >= n:
                amount = min(amount, flow[y][x - n])
        left[path[0]] -= amount
        room[end - n] -= amount
        for x, y in zip(path, path[1:]):
            if x < n:
                flow[x][y - n] = flow[x].get(y - n, 0) + amount
            else:
                flow[y][x - n] -= amount
    return [{j: amount for j, amount in sorted(row.items()) if amount} for row in flow]


@dataclass
class Segment:
    """Consecutive rows of a file that go to one shard."""

    file: str
    first: int
    last: int  # exclusive
    old: int
    shard: int


def _intervals(files: list, flow: dict[int, int], stay: int) -> list[tuple[str, int, int]]:
    """The byte intervals ``file, end, shard`` of one old shard's line; ``end`` counts in
    the file. What stays comes first."""
    order = sorted(flow.items(), key=lambda x: (x[0] != stay, x[0]))
    out, k, rest = [], 0, order[0][1] if order else 0
    for row in files:
        at = 0
        while at < row["size"]:
            while rest == 0:
                k += 1
                rest = order[k][1]
            step = min(rest, row["size"] - at)
            at, rest = at + step, rest - step
            out.append((row["file"], at, order[k][0]))
    return out


def plan(rows: DataFrame, old: str, size: str, capacity: list[int] | None, shards: int, cost=None) -> tuple[list[Segment], list[int]]:
    """The segments of all files, and the shards' capacities. Driver memory: a row per
    file, and a bounded number of rows per cut."""
    file, at = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    held = rows.select(file.alias("file"), plain(old).alias("old"), plain(size).alias("size"), at.alias("at"))
    listed = held.groupBy("file", "old").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    listed = sorted(listed.collect(), key=lambda r: (r["old"], r["file"]))
    total = sum(r["size"] for r in listed)
    if capacity is None:
        capacity = [total // shards + (j < total % shards) for j in range(shards)]
    lines: dict[int, list] = {}
    for row in listed:
        lines.setdefault(row["old"], []).append(row)
    known = list(lines)
    away = cost or (lambda i, j: int(known[i] != j))
    flow = min_cost_flow([sum(r["size"] for r in lines[i]) for i in known], capacity, away)

    cuts: dict[str, list[tuple[int, int]]] = {}
    for k, i in enumerate(known):
        for name, end, shard in _intervals(lines[i], flow[k], i):
            cuts.setdefault(name, []).append((end, shard))
    cut_files = sorted(name for name, ends in cuts.items() if len(ends) > 1)
    places, near = _at_rows(held, cut_files, cuts)

    segments, got = [], [0] * len(capacity)
    for row in listed:
        name, first, bytes_ = row["file"], 0, 0
        for k, (end, shard) in enumerate(cuts[name]):
            last, upto = (row["rows"], row["size"]) if k == len(cuts[name]) - 1 else places[name, end]
            if last > first:
                segments.append(Segment(name, first, last, row["old"], shard))
            got[shard] += upto - bytes_
            first, bytes_ = last, upto
    return _evened(segments, near, [g - c for g, c in zip(got, capacity)]), capacity


def _at_rows(held: DataFrame, names: list[str], cuts: dict) -> tuple[dict, dict]:
    """Where cuts fall between rows: ``(file, byte) -> (rows, bytes) before``; and the
    sizes of the rows near cuts. A row goes to the side on which its middle lies."""
    if not names:
        return {}, {}
    spark = held.sparkSession
    wanted = [(name, end) for name in names for end, _ in cuts[name][:-1]]
    line = Window.partitionBy("file").orderBy("at")
    lines = held.join(F.broadcast(spark.createDataFrame([(n,) for n in names], "file string")), "file")
    lines = lines.withColumn("middle", 2 * F.sum("size").over(line) - F.col("size"))
    joined = lines.join(F.broadcast(spark.createDataFrame(wanted, "file string, cut long")), "file")
    before = F.col("middle") <= 2 * F.col("cut")
    found = joined.groupBy("file", "cut").agg(
        F.count_if(before).alias("rows"), F.sum(F.when(before, F.col("size")).otherwise(0)).alias("bytes")
    )
    found = found.collect()
    places = {(r["file"], r["cut"]): (r["rows"], r["bytes"]) for r in found}
    edges = spark.createDataFrame([(r["file"], r["rows"]) for r in found], "file string, edge long").distinct()
    beside = lines.join(F.broadcast(edges), "file").filter(F.abs(F.col("at") - F.col("edge")) <= NEAR_CUT)
    near = {(r["file"], r["at"]): r["size"] for r in beside.select("file", "at", "size").distinct().collect()}
    return places, near


def _evened(segments: list[Segment], near: dict, over: list[int]) -> list[Segment]:
    """Gives single rows beside cuts to shards that got too little. Every step moves the
    row that lessens the largest difference most; it ends when none does."""
    by_file: dict[str, list[Segment]] = {}
    for segment in segments:
        by_file.setdefault(segment.file, []).append(segment)
    pool: dict[int, list[tuple[int, str, int]]] = {}
    for (name, at), size in near.items():
        segment = by_file[name][bisect.bisect_right(by_file[name], at, key=lambda s: s.first) - 1]
        pool.setdefault(segment.shard, []).append((size, name, at))
    for rows in pool.values():
        rows.sort()
    moved: dict[tuple[str, int], int] = {}
    while pool:
        giver = max(pool, key=lambda j: over[j])
        taker = min(range(len(over)), key=lambda j: over[j])
        rows, most = pool[giver], over[giver] - over[taker]
        if not rows:
            del pool[giver]
            continue
        k = bisect.bisect_left(rows, (most // 2, "", 0))
        k = min((x for x in (k - 1, k) if 0 <= x < len(rows)), key=lambda x: abs(2 * rows[x][0] - most))
        size, name, at = rows[k]
        if size >= most:
            break
        del rows[k]
        over[giver] -= size
        over[taker] += size
        moved[name, at] = taker
    places: dict[str, list[int]] = {}
    for name, at in sorted(moved):
        places.setdefault(name, []).append(at)
    out = []
    for segment in segments:
        name, first = segment.file, segment.first
        at_file = places.get(name, [])
        for at in at_file[bisect.bisect_left(at_file, first) : bisect.bisect_left(at_file, segment.last)]:
            if at > first:
                out.append(Segment(name, first, at, segment.old, segment.shard))
            out.append(Segment(name, at, at + 1, segment.old, moved[name, at]))
            first = at + 1
        if segment.last > first:
            out.append(Segment(segment.file, first, segment.last, segment.old, segment.shard))
    return out


def reshard(
    spark: SparkSession,
    layout: Layout,
    shards: int,
    new_folder: str,
    capacity: list[int] | None = None,
    cost=None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """All rows of a layout with ``shard`` (0 to ``shards`` - 1) and
    ``slot`` (gapless within the shard). Only files of which rows leave their shard are
    written again, into ``new_folder``; a row that stays in such a file is written too."""
    rows = spark.read.schema(layout.schema).parquet(layout.folder)
    shard, slot = free_name(rows, "shard"), free_name(rows, "slot")
    segments, _ = plan(rows, layout.old, layout.size, capacity, shards, cost)
    whole = {s.file for s in segments if s.shard == s.old} - {s.file for s in segments if s.shard != s.old}
    base, table = [0] * shards, {}
    for s in segments:
        table.setdefault(s.file, []).append((s.file, s.first, s.last, s.shard, base[s.shard] - s.first))
        base[s.shard] += s.last - s.first

    def placed(names: list[str]) -> DataFrame:
        own = [t for name in names for t in table[name]]
        known = spark.createDataFrame(own, "_file string, _first long, _last long, _shard int, _base long")
        some = spark.read.option("basePath", layout.folder).schema(rows.schema).parquet(*names)
        some = some.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
        bound = sum(len(t[0]) + 64 for t in own)
        some = measured_join(some, known, ["_file"], "inner", "_at", limit, at_most=bound)
        some = some.filter("_at >= _first and _at < _last")
        return some.select(
            *[plain(c) for c in rows.columns], F.col("_shard").alias(shard), (F.col("_base") + F.col("_at")).alias(slot)
        )

    away = sorted({s.file for s in segments} - whole)
    parts = [placed(sorted(whole))] if whole else []
    if away:
        placed(away).write.partitionBy(shard).parquet(new_folder)
        new = spark.read.parquet(new_folder).withColumn(shard, plain(shard).cast("int"))
        parts.append(new.select(*[plain(c) for c in rows.columns], plain(shard), plain(slot)))
    if not parts:
        return rows.select("*", F.lit(0).alias(shard), F.lit(0).cast("long").alias(slot)).limit(0)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def digest(rows: DataFrame, size: str, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """The columns of the registered query."""
    return rows.select(
        "doc_id", plain(size).alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"), plain(shard).alias("shard"), plain(slot).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
