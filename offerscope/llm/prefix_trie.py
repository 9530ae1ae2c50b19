"""Prefix trie of conversations: which beginnings they share, and what that saves.

A turn's id is the first 128 bits of the SHA-256 of its role and text, big-endian; a
conversation's key is its turns' ids in a row. Keys are sorted over the cluster by key
and conversation, so that a beginning that a third of all conversations share spreads
over many ranges. A task cuts its range into blocks of bounded size and holds each in
an adaptive radix tree: inner nodes of 4, 16, 48 or 256 children that grow as needed,
with compressed paths between them; only byte depths that are a whole number of turns
are nodes of the trie.

A node whose conversations lie within one block is complete there. Those on the paths
of a block's first and last key may go on in the next block: they are open, and rounds
add up the open nodes of neighbouring blocks until none is left. Ids that end in an open
node come as joined chunks, and are hashed in order as they pass. Memory: a block, the
open nodes of ``JOINED`` ranges (twice the longest key each), and a conversation's key,
24 bytes a turn.

Results for special input: a null role or text is an empty one; rows without a
conversation id are in no conversation; a null turn comes first, and turns of one number
go by role and text's digest; repeated rows are turns of their own; a conversation
without turns ends in the root; an empty table has no nodes, not even a root; other
columns are not used, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerscope.llm.common import measured_join, plain
from offerscope.llm.streams import fields, mapped, rows_of, runs
from offerscope.session import materialize

#: Bytes of a turn's id.
WIDTH = 16
#: What a block holds at most: bytes of keys and sizes, and conversations.
BLOCK_BYTES, BLOCK_ROWS = 16 * 1024 * 1024, 1 << 16
#: Ranges whose open nodes are added up in one task, as a power of two.
JOINED = 4
#: Conversations of a family, and the most turns they take from its first.
FAMILY, LEAD = 5, 9
EMPTY = hashlib.sha256(b"").hexdigest()


# --- adaptive radix tree --------------------------------------------------------------


class Sorted:
    """Up to 4 or 16 children, their bytes in order."""

    def __init__(self, room: int):
        self.room, self.bytes, self.children = room, bytearray(), []

    def get(self, byte: int):
        place = self.bytes.find(byte)
        return self.children[place] if place >= 0 else None

    def put(self, byte: int, child):
        """This layout, or a larger one that holds the child as well."""
        place = bisect_left(self.bytes, byte)
        if place < len(self.bytes) and self.bytes[place] == byte:
            self.children[place] = child
            return self
        if len(self.bytes) == self.room:
            larger = Sorted(16) if self.room == 4 else Indexed()
            for known, other in zip(self.bytes, self.children):
                larger.put(known, other)
            return larger.put(byte, child)
        self.bytes.insert(place, byte)
        self.children.insert(place, child)
        return self

    def all(self) -> list:
        return self.children


class Indexed:
    """Up to 48 children, found by a table of their slots."""

    def __init__(self):
        self.slots, self.children = bytearray(256), []

    def get(self, byte: int):
        slot = self.slots[byte]
        return self.children[slot - 1] if slot else None

    def put(self, byte: int, child):
        if self.slots[byte]:
            self.children[self.slots[byte] - 1] = child
            return self
        if len(self.children) == 48:
            larger = Direct()
            for known in range(256):
                if self.slots[known]:
                    larger.put(known, self.get(known))
            return larger.put(byte, child)
        self.children.append(child)
        self.slots[byte] = len(self.children)
        return self

    def all(self) -> list:
        return [self.children[slot - 1] for slot in self.slots if slot]


class Direct:
    """A place for each of 256 children."""

    def __init__(self):
        self.children = [None] * 256

    def get(self, byte: int):
        return self.children[byte]

    def put(self, byte: int, child):
        self.children[byte] = child
        return self

    def all(self) -> list:
        return [child for child in self.children if child is not None]


class Node:
    """A compressed path (with the byte that leads to it, the root's aside), the key that
    ends after it, and what branches there."""

    __slots__ = ("path", "value", "layout")

    def __init__(self, path: bytes, value: int | None = None):
        self.path, self.value, self.layout = path, value, None

    def get(self, byte: int):
        return None if self.layout is None else self.layout.get(byte)

    def put(self, child: Node) -> None:
        self.layout = (self.layout or Sorted(4)).put(child.path[0], child)

    def children(self) -> list[Node]:
        return [] if self.layout is None else self.layout.all()


def shared_length(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    differ = int.from_bytes(a[:size]) ^ int.from_bytes(b[:size])
    return size - (differ.bit_length() + 7) // 8


def insert(root: Node, key: bytes, value: int) -> None:
    """Adds a key; the root has an empty path."""
    node, parent, at = root, None, 0
    while True:
        if key.startswith(node.path, at):
            at += len(node.path)
            if at == len(key):
                node.value = value
                return
            child = node.get(key[at])
            if child is None:
                node.put(Node(key[at:], value))
                return
            node, parent = child, node
            continue
        shared = shared_length(node.path, key[at : at + len(node.path)])
        upper = Node(node.path[:shared])
        node.path = node.path[shared:]
        upper.put(node)
        parent.put(upper)
        if at + shared == len(key):
            upper.value = value
        else:
            upper.put(Node(key[at + shared :], value))
        return


class Part:
    """What lies below a point of the tree, down to the next turns' nodes."""

    __slots__ = ("low", "high", "count", "least", "tops", "leaves", "saved", "ends")

    def __init__(self):
        self.low, self.high, self.count, self.least = None, None, 0, None
        self.tops, self.leaves, self.saved, self.ends = [], 0, 0, None

    def add(self, other: Part) -> None:
        self.low = other.low if self.low is None else self.low
        self.high = other.high
        self.count += other.count
        self.least = other.least if self.least is None else min(self.least, other.least)
        self.tops += other.tops
        self.leaves += other.leaves
        self.saved += other.saved


def block_nodes(keys: list[tuple[bytes, list[int], list[int]]]) -> Iterator[tuple]:
    """The trie's nodes in a block, as rows of ``NODES`` after the block's number.

    ``keys``: distinct keys in order, sizes of their turns, ascending ids of their
    conversations. Complete nodes have what their subtree adds up to; open ones what
    their complete children do, and are told by the digest of their path.
    """
    root = Node(b"")
    for place, (key, _, _) in enumerate(keys):
        insert(root, key, place)
    last = len(keys) - 1
    made: list[list] = []  # per node: depth, part, parent's place in this list

    def close(part: Part, depth: int) -> Part:
        """The node at ``depth`` above ``part``, as the only thing below the next point."""
        is_open = part.low == 0 or part.high == last
        place = len(made)
        for top in part.tops:
            made[top][2] = place
        made.append([depth, part, None])
        above = Part()
        above.low, above.high, above.count, above.least = part.low, part.high, part.count, part.least
        above.tops = [place]
        if not is_open:
            above.leaves = part.leaves if part.tops else 1
            above.saved = part.saved + (part.count - 1) * (keys[part.low][1][depth - 1] if depth else 0)
        return above

    waiting: list[tuple[Node, int, Iterator[Node], Part]] = [(root, 0, iter(root.children()), Part())]
    while True:
        node, start, children, part = waiting[-1]
        child = next(children, None)
        if child is not None:
            waiting.append((child, start + len(node.path), iter(child.children()), Part()))
            continue
        waiting.pop()
        end = start + len(node.path)
        if node.value is not None:  # comes before the longer keys below
            ids = keys[node.value][2]
            part.low = node.value
            part.high = node.value if part.high is None else part.high
            part.count += len(ids)
            part.least = ids[0] if part.least is None else min(part.least, ids[0])
            part.ends = ids
        for depth in range(end // WIDTH, start // WIDTH, -1):
            part = close(part, depth)
        if not waiting:
            close(part, 0)
            break
        waiting[-1][3].add(part)

    names: dict[int, str] = {}
    for place, key in ((0, keys[0][0]), (last, keys[last][0])):
        state = hashlib.sha256()
        for depth in range(len(key) // WIDTH + 1):
            names[place << 40 | depth] = state.hexdigest()[:32]
            state.update(key[depth * WIDTH : (depth + 1) * WIDTH])

    def name(depth: int, part: Part) -> str | None:
        edge = 0 if part.low == 0 else last if part.high == last else None
        return None if edge is None else names[edge << 40 | depth]

    for depth, part, parent in made:
        key, sizes, _ = keys[part.low]
        turn = key[(depth - 1) * WIDTH : depth * WIDTH].hex() if depth else None
        path, size = name(depth, part), sizes[depth - 1] if depth else 0
        above = made[parent] if parent is not None else None
        parent_path = name(above[0], above[1]) if above else None
        ends = b"" if part.ends is None else ",".join(map(str, part.ends)).encode()
        if path is None:
            parent_id = None if parent_path else above[1].least
            saved = part.saved + (part.count - 1) * size
            yield (
                "complete", None, parent_path, None, None, turn, part.least, depth, parent_id, part.count,
                len(part.tops), part.leaves or 1, saved, size, hashlib.sha256(ends).hexdigest(), None,
            )
        else:
            whole = [top for top in part.tops if name(depth + 1, made[top][1]) is None]
            yield (
                "open", path, parent_path, part.low == 0, part.high == last, turn, part.least, depth, None, part.count,
                len(whole), part.leaves, part.saved, size, None, None,
            )
            if ends:
                yield ("ends", path, None, None, None, None, part.ends[0], depth, None, None, None, None, None, None, None, ends)


# --- over the cluster -------------------------------------------------------------------

NODES = (
    "part int, block long, kind string, path string, parent_path string, from_left boolean, to_right boolean, turn_id string, "
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "size long, ends_sha256 string, ends binary"
)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Nodes of a range's blocks; rows are ``key, conv_id, sizes`` in order."""
    part, block, keys, held, rows = TaskContext.get().partitionId(), 0, [], 0, 0
    for key, conv_id, sizes in rows_of(batches):
        if keys and (rows >= BLOCK_ROWS or held >= BLOCK_BYTES):
            for row in block_nodes(keys):
                yield (part, block, *row)
            block, keys, held, rows = block + 1, [], 0, 0
        if keys and keys[-1][0] == key:
            keys[-1][2].append(conv_id)
        else:
            keys.append((key, sizes, [conv_id]))
            held += len(key) + 8 * len(sizes)
        rows += 1
    if keys:
        for row in block_nodes(keys):
            yield (part, block, *row)


OPEN = [
    "part", "block", "path", "parent_path", "from_left", "to_right", "turn_id", "conv_id", "depth", "n_convs",
    "n_children", "n_leaves", "saved_tokens", "size",
]


def _joined(rows: DataFrame, last: bool) -> DataFrame:
    """Adds up the open nodes of ranges that follow each other. Those that no further
    range can share are complete; ``last``: there is no further one."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for group in runs(batches, 1):
            places = [row[1:3] for row in group]
            nodes: dict[str, dict] = {}
            for row in group:
                new = dict(zip(OPEN, row[1:]))
                new["from_left"] &= row[1:3] == places[0]
                new["to_right"] &= row[1:3] == places[-1]
                old = nodes.setdefault(new["path"], new)
                if old is not new:
                    old["conv_id"] = min(old["conv_id"], new["conv_id"])
                    for sum_ in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                        old[sum_] += new[sum_]
                    for either in ("from_left", "to_right"):
                        old[either] |= new[either]
            for node in sorted(nodes.values(), key=lambda node: -node["depth"]):
                node["part"], node["block"] = group[0][0], 0
                done = last or not (node["from_left"] or node["to_right"])
                if done:
                    node["n_leaves"] = node["n_leaves"] or 1
                    node["saved_tokens"] += (node["n_convs"] - 1) * node["size"]
                    above = nodes.get(node["parent_path"])
                    if above is not None:
                        above["n_children"] += 1
                        above["n_leaves"] += node["n_leaves"]
                        above["saved_tokens"] += node["saved_tokens"]
                yield (*(node[name] for name in OPEN), done)

    group = F.shiftright("part", JOINED).alias("_group")
    held = rows.select(group, *OPEN).repartition("_group").sortWithinPartitions("_group", "part", "block", "depth")
    return mapped(held, [*(rows.schema[name] for name in OPEN), *fields("done boolean")], add)


def _ends(rows: DataFrame) -> DataFrame:
    """``path, ends_sha256`` of open nodes, from joined ids that pass in order."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, state = None, None
        for path, _, ids in rows_of(batches):
            if path == now:
                state.update(b",")
            else:
                if now is not None:
                    yield now, state.hexdigest()
                now, state = path, hashlib.sha256()
            state.update(ids)
        if now is not None:
            yield now, state.hexdigest()

    held = rows.select("path", "conv_id", "ends").repartition("path").sortWithinPartitions("path", "conv_id")
    return mapped(held, fields("path string, ends_sha256 string"), read)


def trie(keyed: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, turn_id`` per node.

    ``keyed``: materialised, ``conv_id`` (not null, once each), ``key`` and ``sizes`` as ``keys`` makes
    them. ``turn_id`` is the id of the node's last turn, in hexadecimal.
    """
    ordered = keyed.select("key", "conv_id", "sizes").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    nodes = materialize(mapped(ordered, fields(NODES), _blocks), "trie-blocks")
    spine, waiting = None, nodes.filter("kind = 'open'")
    while True:
        top = waiting.agg(F.max("part")).first()[0]
        last = top is None or top < 1 << JOINED
        step = materialize(_joined(waiting, last), "trie-open")
        done = step.filter("done")
        spine = done if spine is None else spine.unionByName(done)
        if last:
            break
        waiting = step.filter("not done").drop("done")
    ends = _ends(nodes.filter("kind = 'ends'"))
    spine = spine.join(ends, "path", "left")  # a row per path on both sides
    spine = spine.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))).withColumn("parent_conv_id", F.lit(None).cast("long"))
    spine = materialize(spine, "trie-spine")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_id"]
    both = nodes.filter("kind = 'complete'").select("parent_path", *out).unionByName(spine.select("parent_path", *out))
    parents = materialize(spine.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("_above")), "trie-parents")
    both = measured_join(both, parents, ["parent_path"], "left", "conv_id")
    return both.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).select(*out)


def turn_id(role: Column, text: Column) -> Column:
    """The id of a turn in hexadecimal."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole, 256), 1, 2 * WIDTH)


def keys(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    regroup: bool = False,
) -> DataFrame:
    """``conv_id, key, sizes`` per conversation: its turns' ids joined, and the bytes of their texts.

    ``regroup`` rebuilds each conversation from the first turns of its family's first
    (families are runs of five ids) and its own after as many, crc32(id) % 9 of them.
    Texts are hashed where they lie; ids and sizes are shuffled once, by family.
    """
    conv = plain(conv_col).cast("long")
    role, text = (F.coalesce(plain(c), F.lit("")) for c in (role_col, text_col))
    turns = conversations.filter(conv.isNotNull()).select(
        conv.alias("conv_id"),
        (conv - conv % FAMILY).alias("family"),
        F.struct(plain(turn_col).alias("turn"), role.alias("role"), turn_id(role, text).alias("id"), F.octet_length(text).cast("long").alias("size")).alias("said"),
    )
    own = turns.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("said")).alias("turns"))
    if regroup:
        first = F.when(F.col("conv_id") == F.col("family"), F.slice("turns", 1, LEAD - 1))
        members = own.groupBy("family").agg(F.collect_list(F.struct("conv_id", "turns")).alias("members"), F.first(first, True).alias("lead"))
        members = members.select("lead", F.explode("members").alias("m")).select("m.*", "lead")
        taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LEAD).cast("int")
        lead = F.coalesce(F.slice("lead", F.lit(1), taken), F.slice("turns", 1, 0))
        rest = F.slice("turns", taken + 1, F.greatest(F.size("turns"), F.lit(1)))
        own = members.select("conv_id", F.concat(lead, rest).alias("turns"))
    return own.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("key"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )


def prefix_trie(conversations: DataFrame, **columns) -> DataFrame:
    """The trie of a table of turns; see ``keys`` and ``trie``."""
    return trie(materialize(keys(conversations, **columns), "conversation-keys"))
