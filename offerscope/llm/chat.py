"""Reply trees as chat conversations.

Every node of a tree names its parent. Self-joins that double their reach find the
root, depth and total score of every leaf in about log(depth) rounds; the branches
of a tree are ranked by score, and the chosen ones are opened from leaf to root by
the same joins, backwards. Each is formatted as one conversation.

Template: ``<s>``, then per turn ``<<SYS>>text<</SYS>>`` for system,
``[INST]text[/INST]`` for user, ``text</s>`` for assistant, and
``[ROLE]role[/ROLE]text[/TURN]`` for any other role. A control string inside a text
or role gets a backslash after its first character, and one that has backslashes
there already gets one more, so texts come back as they were.

Results for special input: a null text or role is an empty one; a node whose parent
is missing or null is a root; a node without an id is a branch of its own; of several
rows with one node id the first by parent, score, role and text counts; branches of
equal score rank by their leaf's id; nodes on or below a cycle are on no branch from
a root and in no conversation; a null tree id is one tree; an empty table gives no
rows. Other columns are not used.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerscope.llm.common import BROADCAST_BYTES, measured_join, plain
from offerscope.session import materialize

_REST = r"(/?s>|</?SYS>>|/?INST\]|/?ROLE\]|/TURN\])"
ESCAPE, UNESCAPE = r"([<\[])(\\*)" + _REST, r"([<\[])\\(\\*)" + _REST
CONTROL = r"<</?SYS>>|</?s>|\[/?INST\]|\[/?ROLE\]|\[/TURN\]"


def escape(text: str) -> str:
    return re.sub(ESCAPE, r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return re.sub(UNESCAPE, r"\1\2\3", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """The conversation, and the places of assistant texts in it: start, end, start, ..."""
    parts, spans, at = ["<s>"], [], 3
    for role, text in turns:
        text = escape(text)
        if role == "assistant":
            spans += [at, at + len(text)]
            part = text + "</s>"
        elif role == "user":
            part = f"[INST]{text}[/INST]"
        elif role == "system":
            part = f"<<SYS>>{text}<</SYS>>"
        else:
            part = f"[ROLE]{escape(role)}[/ROLE]{text}[/TURN]"
        parts.append(part)
        at += len(part)
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, role, at = [], None, 0
    for mark in re.finditer(CONTROL, formatted):
        text, control, at = unescape(formatted[at : mark.start()]), mark[0], mark.end()
        if control == "</s>":
            turns.append(("assistant", text))
        elif control == "[/INST]":
            turns.append(("user", text))
        elif control == "<</SYS>>":
            turns.append(("system", text))
        elif control == "[/ROLE]":
            role = text
        elif control == "[/TURN]":
            turns.append((role, text))
    return turns


def conversations(
    nodes: DataFrame,
    tree_col: str = "tree",
    node_col: str = "node",
    parent_col: str = "parent",
    role_col: str = "role",
    text_col: str = "text",
    score_col: str = "score",
    keep: int = 1,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``tree, rank, score, formatted, spans`` of the best ``keep`` branches of each tree.

    Only ids and scores are joined until the branches are chosen; a text moves when
    nodes are told apart and when its conversation is put together, which is one row.
    """
    held = nodes.select(
        plain(tree_col).alias("tree"),
        F.coalesce(plain(node_col).cast("string"), F.concat(F.lit("row:"), F.monotonically_increasing_id())).alias("node"),
        plain(parent_col).cast("string").alias("parent"),
        F.coalesce(plain(score_col).cast("double"), F.lit(0.0)).alias("score"),
        F.coalesce(plain(role_col), F.lit("")).alias("role"),
        F.coalesce(plain(text_col), F.lit("")).alias("text"),
    )
    first = F.min(F.struct("parent", "score", "role", "text")).alias("first")
    held = held.groupBy("tree", "node").agg(first).select(
        F.monotonically_increasing_id().alias("uid"), "tree", "node", "first.*"
    )
    held = materialize(held, "nodes")
    total = held.count()

    ids = held.select(
        "uid", "tree", "node", "parent", "score", F.coalesce(F.col("tree").cast("string"), F.lit("")).alias("key"),
        F.col("tree").isNull().alias("no_tree"),
    )
    parents = ids.select("key", "no_tree", F.col("node").alias("parent"), F.col("uid").alias("up"))
    jumps = measured_join(
        ids.select("uid", "key", "no_tree", "parent", "score"), materialize(parents, "parents"),
        ["key", "no_tree", "parent"], "left", "uid", limit,
    )
    jumps = jumps.select("uid", "up", F.col("score").alias("total"), F.lit(1).cast("long").alias("depth"))
    levels = [materialize(jumps, "jumps")]
    while (1 << (len(levels) - 1)) <= total and not levels[-1].filter("up is not null").isEmpty():
        now = levels[-1]
        ahead = now.select(F.col("uid").alias("up"), F.col("up").alias("up2"), F.col("total").alias("t2"), F.col("depth").alias("d2"))
        there = now.filter("up is null")  # at the root already: not joined again
        further = measured_join(now.filter("up is not null"), ahead, ["up"], "left", "uid", limit, at_most=64 * total)
        levels.append(
            materialize(
                there.select("uid", "up", "total", "depth").unionByName(further.select(
                    "uid", F.col("up2").alias("up"), (F.col("total") + F.coalesce("t2", F.lit(0.0))).alias("total"),
                    (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"),
                )),
                "jumps",
            )
        )
    inner = levels[0].select(F.col("up").alias("uid")).filter("uid is not null").distinct()
    leaves = levels[-1].filter("up is null").join(inner, "uid", "left_anti").join(ids.select("uid", "tree", "node"), "uid")
    best = Window.partitionBy("tree").orderBy(F.desc("total"), F.length("node"), "node")
    leaves = leaves.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep)
    leaves = materialize(leaves.select(F.col("uid").alias("leaf"), "tree", "rank", F.col("total").alias("score")), "leaves")

    members = leaves.select("leaf", F.col("leaf").alias("uid"), F.lit(0).cast("long").alias("back"))
    for number in range(len(levels) - 1, -1, -1):
        ahead = levels[number].select("uid", F.col("up").alias("next")).filter("next is not null")
        further = measured_join(members, ahead, ["uid"], "inner", "leaf", limit, at_most=64 * total)
        further = further.select("leaf", F.col("next").alias("uid"), (F.col("back") + (1 << number)).alias("back"))
        members = materialize(members.unionByName(further), "members")
    turns = members.join(held.select("uid", "role", "text"), "uid").groupBy("leaf").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("back")).alias("at"), "role", "text"))).alias("turns")
    )

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in batch["turns"]]
            yield pd.DataFrame(
                {"leaf": batch["leaf"], "formatted": [m[0] for m in made], "spans": [m[1] for m in made]}
            )

    made = turns.mapInPandas(put, "leaf long, formatted string, spans array<long>")
    return leaves.join(made, "leaf").select("tree", "rank", "score", "formatted", "spans")


def digest(made: DataFrame) -> DataFrame:
    """The columns of the registered query, read back from stored conversations."""
    kind = made.schema["tree"].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for tree, text, spans in zip(batch["tree"], batch["formatted"], batch["spans"]):
                turns = parse_turns(text)
                loss = "".join(unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2]))
                said = "".join(f"{role}\n{content}\n" for role, content in turns)
                sha = lambda x: hashlib.sha256(x.encode("utf-8")).hexdigest()
                rows.append((tree, len(turns), sha(said), len(loss), sha(loss), len(text)))
            yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return made.select("tree", "formatted", "spans").mapInPandas(read, schema)
