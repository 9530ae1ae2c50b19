"""Merkle manifest of a dataset, with retained hash states.

Rows are leaves, ordered within trees (one per language, say); the trees' roots are the
leaves of a last tree, whose root stands for the dataset. A node is the SHA-256 of its
up to eight children's digests as hex text. A parent keeps a copy of its hash state
from before each child's slot, so that a changed child is folded in by resuming there
with the replacement and the siblings to its right alone.

Work is cut into blocks of four levels, 4,096 nodes: a task builds one block from its
nodes, its top goes up to the next round, and the siblings above a block come down to
it as one row. Texts are hashed where they lie; only digests are shuffled, and a tree
with most of the rows spreads over its blocks. The driver holds a row per partition.

Results for special input: a null in any column is the part ``-``; a null id sorts
first and is never tampered with; rows of one tree and id sort by their digest, and
equal rows are leaves of their own; a null tree is a tree, the first; a tree of one
leaf has that leaf as its root, and a lone tree's root is the dataset's; an empty table
gives no rows; other columns are not used, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerscope.llm.common import plain
from offerscope.llm.streams import fields, mapped, rows_of, runs
from offerscope.session import materialize

#: Children of a node, and levels of a block, as powers of two and of the first.
FAN_BITS, LEVELS = 3, 4
FAN = 1 << FAN_BITS
BLOCK_BITS = FAN_BITS * LEVELS
BLOCK = 1 << BLOCK_BITS

PATH = T.ArrayType(T.StructType().add("left", "string").add("right", "string"))


def leaf(columns: list[Column]) -> Column:
    """The digest of a row: of its columns' byte counts and values, ``-`` for a null."""
    texts = [column.cast("string") for column in columns]
    parts = [
        F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
        for text in texts
    ]
    return F.sha2(F.concat(*parts), 256)


class Parent:
    """A node of up to eight children, given as hex text."""

    def __init__(self, children: list[bytes]):
        state, self.children = hashlib.sha256(), children
        self.states = []  # before each child's slot
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()
        self.rights = [b"".join(children[slot + 1 :]) for slot in range(len(children))]

    def left(self, slot: int) -> bytes:
        return b"".join(self.children[:slot])

    def fold(self, slot: int, child: bytes) -> bytes:
        """The node's digest with another child in that slot."""
        return resume(self.states[slot], child, self.rights[slot])


def resume(state, child: bytes, right: bytes) -> bytes:
    state = state.copy()
    state.update(child)
    state.update(right)
    return state.hexdigest().encode()


def parents_of(nodes: list[bytes], whole: bool) -> list[list[Parent]]:
    """The levels above a block's nodes: until one remains if the block is the whole
    tree, else all of a block's levels."""
    levels: list[list[Parent]] = []
    while len(nodes) > 1 if whole else len(levels) < LEVELS:
        levels.append([Parent(nodes[at : at + FAN]) for at in range(0, len(nodes), FAN)])
        nodes = [parent.digest for parent in levels[-1]]
    return levels


def _is_whole(block: int, count: int) -> bool:
    """A first block that is not full is all of its tree; a full one has a block's levels
    in any case."""
    return block == 0 and count < BLOCK


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (``tree, hash`` and more) with ``at``: the place among the rows of the tree by
    ``order`` and ``hash``, from 0. One shuffle by ranges; a tree may reach over many of
    them. Driver memory: a row per range.
    """
    by = ["tree", *order, "hash"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part, tree, run, place, first = TaskContext.get().partitionId(), None, 0, 0, True
        for row in rows_of(batches):
            if place and row[0] != tree:
                run, first = 0, False
            tree = row[0]
            yield (*row, part, place, run, first)
            place += 1
            run += 1

    ordered = rows.select("tree", *[c for c in rows.columns if c != "tree"]).repartitionByRange(*by).sortWithinPartitions(*by)
    numbers = fields("part int, place long, run long, first boolean")
    placed = materialize(mapped(ordered, [*ordered.schema.fields, *numbers], number), "ranked")
    parts = placed.groupBy("part").agg(
        F.min_by(F.struct("tree"), "place").alias("head"),
        F.max_by(F.struct("tree"), "place").alias("tail"),
        F.max_by("run", "place").alias("last"),
        F.count(F.lit(1)).alias("n"),
    )
    offsets, open_tree, before = [], None, 0
    for part in sorted(parts.collect(), key=lambda row: row["part"]):  # a row per range
        goes_on = open_tree is not None and open_tree == part["head"]
        offsets.append((part["part"], before if goes_on else 0))
        same = part["head"] == part["tail"] and part["last"] == part["n"] - 1
        before = part["last"] + 1 + (before if goes_on and same else 0)
        open_tree = part["tail"]
    known = placed.sparkSession.createDataFrame(offsets, "part int, offset long")
    placed = placed.join(F.broadcast(known), "part", "left")
    at = F.col("run") + F.when(F.col("first"), F.col("offset")).otherwise(0)
    return placed.withColumn("at", at).drop("part", "place", "run", "first", "offset")


def _tops(nodes: DataFrame) -> DataFrame:
    """The top of each block: ``tree, at, hash`` of the next round."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for rows in runs(batches, 2):
            block = rows[0][1]
            hashes = [row[3].encode() for row in rows]
            levels = parents_of(hashes, _is_whole(block, len(hashes)))
            yield rows[0][0], block, (levels[-1][0].digest if levels else hashes[0]).decode()

    held = nodes.select("tree", F.shiftright("at", BLOCK_BITS).alias("block"), "at", "hash")
    held = held.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
    return mapped(held, [nodes.schema["tree"], *fields("at long, hash string")], make)


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of each round (``tree, at, hash``), from the given ones up to the trees' roots."""
    found = [nodes]
    while True:
        found.append(materialize(_tops(found[-1]), "nodes"))
        if not found[-1].agg(F.max("at")).first()[0]:
            return found


def _below(
    nodes: DataFrame, paths: DataFrame, extra: list[str], out: list[T.StructField], make: Callable[..., tuple]
) -> DataFrame:
    """Rows made from each node with its place in its block and what lies above that.

    ``paths`` has a row per block (``tree, at, path, subroot, root``), which arrives ahead of
    the block's nodes; states of the levels above are made once per block.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for rows in runs(batches, 2):
            above, nodes_ = rows[0], rows[1:]
            path, subroot, root = above[4:7]
            hashes = [row[3].encode() for row in nodes_]
            levels = parents_of(hashes, _is_whole(above[1], len(hashes)))
            upper = [(hashlib.sha256(p["left"].encode()), p["right"].encode()) for p in path]
            for place, row in enumerate(nodes_):
                way = [(level[place >> FAN_BITS * (k + 1)], place >> FAN_BITS * k & FAN - 1) for k, level in enumerate(levels)]
                yield make(row, way, path, upper, subroot, root)

    block = F.shiftright("at", BLOCK_BITS).alias("block")
    lower = nodes.select("tree", block, "at", "hash", F.lit(None).cast(PATH).alias("path"), *[F.lit(None).cast("string").alias(c) for c in ("subroot", "root")], *extra)
    nothing = [F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in extra]
    heads = paths.select("tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), F.lit("").alias("hash"), "path", "subroot", "root", *nothing)
    both = heads.unionByName(lower).repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
    return mapped(both, out, walk)


def _siblings(way: list[tuple[Parent, int]], path: list[dict]) -> list[dict]:
    """What stands beside a node on each level above it, in its block and over it."""
    return [{"left": p.left(slot).decode(), "right": p.rights[slot].decode()} for p, slot in way] + list(path)


def _path_fields(nodes: DataFrame, tree: str) -> list[T.StructField]:
    held = T.StructField("tree", nodes.schema[tree].dataType)
    return [held, *fields("at long"), T.StructField("path", PATH), *fields("subroot string, root string")]


def paths_of_trees(tops: DataFrame) -> DataFrame:
    """``tree, at, path, subroot, root`` for each tree, given its root; ``path`` leads from there to
    the dataset's root."""
    named = tops.select(F.lit(0).alias("tree"), F.col("tree").alias("name"), "hash")
    levels = rounds(materialize(ranked(named, ["name"]), "subroots"))
    top = levels[-1].select("tree", "at", F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"), F.col("hash").alias("root"))
    paths = inner_paths(levels, top)

    def make(row, way, path, upper, subroot, root):
        return row[7], 0, _siblings(way, path), row[3], root

    return materialize(_below(levels[0], paths, ["name"], _path_fields(levels[0], "name"), make), "tree-paths")


def inner_paths(levels: list[DataFrame], paths: DataFrame) -> DataFrame:
    """From the paths of the trees' roots those of the blocks of the lowest round."""

    def make(row, way, path, upper, subroot, root):
        return row[0], row[2], _siblings(way, path), subroot, root

    for nodes in levels[-2:0:-1]:
        paths = materialize(_below(nodes, paths, [], _path_fields(nodes, "tree"), make), "paths")
    return paths


def proofs(leaves: DataFrame, order: list[str], replacement: str) -> DataFrame:
    """``leaves`` (``tree, hash``, the columns ``order`` and ``replacement``, a digest or null) with
    ``subroot, root, proof_sha256, folded_root``: the tree's and the dataset's root, the digest of all
    siblings from the leaf up, and the dataset's root with the leaf replaced.
    """
    levels = rounds(materialize(ranked(leaves, order), "leaves"))
    paths = inner_paths(levels, paths_of_trees(levels[-1]))
    extra = [*order, replacement]
    kept = len(extra)

    def make(row, way, path, upper, subroot, root):
        proof, now = hashlib.sha256(), (row[6 + kept] or row[3]).encode()
        for parent, slot in way:
            proof.update(parent.left(slot))
            proof.update(parent.rights[slot])
            now = parent.fold(slot, now)
        for step, (state, right) in zip(path, upper):
            proof.update(step["left"].encode())
            proof.update(right)
            now = resume(state, now, right)
        return row[0], row[3], *row[7:], subroot, root, proof.hexdigest(), now.decode()

    out = [levels[0].schema[c] for c in ("tree", "hash", *extra)]
    out += fields("subroot string, root string, proof_sha256 string, folded_root string")
    return _below(levels[0], paths, extra, out, make)


def tampered(id_: Column, text: Column) -> Column:
    """Whether a row's text is lower-cased before folding, which must show in the root."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 0, F.lit(False)) & text.isNotNull()


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def manifest(
    documents: DataFrame,
    id_col: str = "doc_id",
    tree_col: str = "lang",
    text_col: str = "text",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
) -> DataFrame:
    """``tree, hash, doc_id, replaced, subroot, root, proof_sha256, folded_root`` per document."""
    text = plain(text_col)
    lowered = F.translate(text, UPPER, UPPER.lower())
    whole = leaf([plain(c) for c in columns])
    other = leaf([lowered if c == text_col else plain(c) for c in columns])
    leaves = documents.select(
        plain(tree_col).alias("tree"),
        whole.alias("hash"),
        plain(id_col).alias("doc_id"),
        F.when(tampered(plain(id_col), text), other).alias("replaced"),
    )
    return proofs(materialize(leaves, "digests"), ["doc_id"], "replaced")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return found.select(
        "doc_id", F.col("hash").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
