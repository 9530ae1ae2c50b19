"""Leader clustering of similar sentence keys, without a firm's keys meeting anywhere.

The rule takes a firm's keys by falling frequency (then by name): a key joins the first
earlier leader that is similar, else it leads a cluster of its own. Similar means a
normalised Levenshtein similarity of at least the threshold.

Similar pairs come from an equi-join that misses none. With at most ``d`` edits allowed
for a key of its length, the longer key of a pair is cut into ``d + 1`` segments. Of
these one is untouched such that exactly as many edits lie before it as segments do; so
it stands in the shorter key, shifted by no more than its number, and by no more than
``d`` less its number as seen from the end. Segments join substrings by firm, content
and a bucket of places, candidates are checked by ``levenshtein`` with that limit, and
leaders are settled in rounds over the few similar pairs.

Keys are shuffled, not their substrings: a key goes whole to the cells of its firm where
partners of its length are, and is cut there. A cell holds a bounded number of letters of
longer keys, and so does a task, whose segments are hashed in memory. Candidates are checked there, those first whose counts of letters allow the
edits, and only similar pairs leave a cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerscope.operators.joins import lookup_join
from offerscope.session import materialize

#: Letters of a segment at most, and of a piece in which substrings are looked up.
SEGMENT, PIECE = 7, 64
#: Letters of longer keys that are cut into segments in one cell, and half of what a task may
#: hold: their segments take about 30 bytes a letter in the hash table of the join.
CELL_LETTERS = 4_000_000
#: Cells of less than this share of it are dealt to tasks by hash, larger ones one by one.
SMALL_CELL = 8
#: Classes of letters that are counted modulo 16, eight to a column; others are in no class.
BAGS = {"bag": (" ", "e", "a", "t", "n", "o", "i", "r"), "bags": ("s", "h", "d", "lz", "ukq", "cmx", "pgjwv", "byf")}
#: Whether a join on cell and content may use rows that lie by cell.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def edits(length: Column, threshold: float) -> Column:
    """Edits that similar keys may have when the longer one has this length."""
    return F.floor((F.lit(1.0) - F.lit(float(threshold))) * length + F.lit(1e-9)).cast("int")


def similar(a: str, b: str, threshold: float) -> Column:
    """Whether two columns have a normalised Levenshtein similarity of at least the threshold."""
    longest = F.greatest(F.length(a), F.length(b))
    limit = f"cast(floor((1.0D - {float(threshold)!r}D) * greatest(length(`{a}`), length(`{b}`)) + 1e-9D) as int)"
    distance = F.expr(f"levenshtein(`{a}`, `{b}`, {limit})")  # -1 beyond the limit
    return (distance >= 0) & (F.lit(1.0) - distance / longest >= F.lit(float(threshold)))


def _segment(length: Column, threshold: float) -> Column:
    whole = F.floor(length / (edits(length, threshold) + 1)).cast("int")
    return F.least(whole, F.lit(SEGMENT))


def _width(length: Column) -> Column:
    """Places of a bucket: about as many as segments of a key of this length may shift."""
    fourfold = F.floor(F.log2(length) / 2 + F.lit(1e-9))
    return F.greatest(F.lit(8), F.pow(F.lit(4), fourfold) / 4).cast("int")


def _mark(text: str, place: Column) -> Column:
    return F.hash(F.expr(text), F.col("w"), F.floor(place / F.col("w")), F.col("of"))


def _bag(key: str, classes: tuple[str, ...]) -> Column:
    """Letters of each class, modulo 16, in eight bits each: a run of ones that enters at
    the low end and leaves at the high one, so counts differ in as many bits as they are
    apart on the ring."""
    counts = ["(" + " + ".join(f"length(`{key}`) - length(replace(`{key}`, '{letter}', ''))" for letter in x) + ") & 15" for x in classes]
    return F.expr(" | ".join(f"shiftleft(shiftright(shiftleft(255L, {c}), 8) & 255L, {8 * k})" for k, c in enumerate(counts)))


def _band(length: Column, threshold: float) -> Column:
    """The length on a scale where similar keys are about one apart at most."""
    return F.floor(F.log(length.cast("double")) / max(-math.log(threshold), 0.01)).cast("int")


def _slots(sizes: DataFrame, letters: int, least: int) -> tuple[DataFrame, int, int]:
    """Where cells are dealt to: ``firm, band, shares, slot`` of those that are not small, the
    first slot of small ones, and how many slots there are.

    A slot gets at most twice so many letters: the shares of a cell beyond them have a slot
    each, smaller cells lie in a row that is cut. ``sizes``: materialised ``firm, band, n``,
    the letters of each. The table has at most ``SMALL_CELL`` rows for so many letters.
    """
    large = sizes.filter(F.col("n") * SMALL_CELL >= letters)
    large = large.withColumn("shares", F.ceil(F.col("n") / letters).cast("int"))
    full = Window.orderBy(F.col("shares").desc(), "firm", "band").rowsBetween(Window.unboundedPreceding, -1)
    units = F.when(F.col("shares") > 1, F.col("shares") * F.lit(letters).cast("long")).otherwise(F.col("n"))
    before = F.coalesce(F.sum(units).over(full), F.lit(0).cast("long"))
    large = materialize(large.select("firm", "band", "shares", F.floor(before / letters).cast("int").alias("slot")), "key-cells")
    first = (large.agg(F.max(F.col("slot") + F.col("shares"))).first()[0]) or 0
    small = sizes.filter(F.col("n") * SMALL_CELL < letters).agg(F.sum("n")).first()[0] or 0
    return large, first, first + max(least, math.ceil(2 * small / letters))


def _cell_of_slot(spark: SparkSession, slots: int) -> DataFrame:
    """``slot, cell`` for each: a number that lands in a partition of the slot's own when rows are
    dealt to so many by its hash; where none was found, the slot's number."""
    tried = spark.range(0, 24 * slots, 1, 1).select(F.col("id").cast("int").alias("cell"))
    found = tried.groupBy(F.pmod(F.hash("cell"), F.lit(slots)).alias("slot")).agg(F.min("cell").alias("cell"))
    every = spark.range(0, slots, 1, 1).select(F.col("id").cast("int").alias("slot"))
    return materialize(every.join(found, "slot", "left").withColumn("cell", F.coalesce("cell", "slot")), "key-slots")


def _cells(keys: DataFrame, threshold: float, letters: int, least: int) -> tuple[DataFrame, DataFrame, int]:
    """The keys as longer and as shorter ones of a pair, with the ``cell`` where they meet, a
    number for a task of its own, and how many there are.

    A cell is a firm, a band of lengths of the shorter keys (together ``of``), and a share of
    the longer ones where these have more than so many letters; the shorter keys go to each share.
    """
    length = F.col("l")
    longest = F.floor((length + F.lit(1e-6)) / float(threshold)).cast("int")
    held = keys.select("firm", "id", "key", "n_docs", "l", *BAGS)
    longer = held.filter(edits(length, threshold) > 0)
    shortest = F.greatest(length - edits(length, threshold), F.lit(1))
    longer = longer.withColumn("band", F.explode(F.sequence(_band(shortest, threshold), _band(length, threshold))))
    shorter = held.filter((edits(longest, threshold) > 0) & (length > 0)).withColumn("band", _band(length, threshold))
    sizes = materialize(longer.groupBy("firm", "band").agg(F.sum("l").alias("n")), "key-bands")
    large, first, slots = _slots(sizes, letters, least)
    numbers = F.broadcast(_cell_of_slot(keys.sparkSession, slots))
    hashed = F.lit(first) + F.pmod(F.hash("firm", "band"), F.lit(slots - first))
    shares = F.coalesce("shares", F.lit(1))
    longer = longer.join(F.broadcast(large), ["firm", "band"], "left").withColumn("share", F.pmod(F.xxhash64("id"), shares).cast("int"))
    shorter = shorter.join(F.broadcast(large), ["firm", "band"], "left").withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1)))
    columns = ["cell", F.hash("firm", "band").alias("of"), "firm", "id", "key", "n_docs", "l", *BAGS]
    placed = [x.withColumn("slot", F.coalesce(F.col("slot") + F.col("share"), hashed)).join(numbers, "slot") for x in (longer, shorter)]
    return *(x.select(*columns) for x in placed), slots


def _segments(longer: DataFrame, threshold: float) -> DataFrame:
    """A row per segment of a key and bucket of places where its like may begin."""
    held = longer.withColumn("d", edits(F.col("l"), threshold))
    held = held.withColumn("q", _segment(F.col("l"), threshold)).withColumn("w", _width(F.col("l")))
    held = held.withColumn("at", F.expr(f"explode(transform(sequence(0, cast(floor(d * q / {PIECE}) as int)), k -> k * {PIECE}))"))
    held = held.withColumn("s", F.expr(f"substring(key, at + 1, {PIECE - 1} + q)"))
    inside = f"sequence(cast(ceil(at / q) as int), least(d, cast(floor((at + {PIECE - 1}) / q) as int)))"
    held = held.filter("ceil(at / q) <= d").select("cell", "of", "id", "l", *BAGS, "d", "q", "w", "at", "s", F.expr(f"explode({inside})").alias("i"))
    held = held.withColumn("p", F.col("i") * F.col("q"))
    low = F.floor(F.greatest(F.col("p") - F.col("i"), F.lit(0)) / F.col("w"))
    high = F.floor((F.col("p") + F.least(F.col("i"), F.col("d") - F.col("i"))) / F.col("w"))
    held = held.withColumn("bucket", F.explode(F.sequence(low, high)))
    mark = _mark("substring(s, p - at + 1, q)", F.col("bucket") * F.col("w"))
    return held.select("cell", mark.alias("h"), "id", "l", *BAGS, "d", "i", "p")


def _substrings(shorter: DataFrame, threshold: float) -> DataFrame:
    """A row per place of a key and kind of segment that a longer partner may have."""
    longest = F.floor((F.col("l") + F.lit(1e-6)) / float(threshold)).cast("int")
    kinds = F.transform(F.sequence(F.col("l"), longest), lambda l: F.struct(_segment(l, threshold).alias("q"), _width(l).alias("w")))
    held = shorter.select("cell", "of", "id", "l", *BAGS, "key", F.explode(F.array_distinct(kinds)).alias("kind"))
    held = held.select("cell", "of", "id", "l", *BAGS, "key", "kind.*").filter("l >= q")
    pieces = F.expr(
        f"transform(sequence(0, cast(floor((l - q) / {PIECE}) as int)), k -> struct(k * {PIECE} as at, substring(key, k * {PIECE} + 1, {PIECE - 1} + q) as s))"
    )
    held = held.select("cell", "of", "id", "l", *BAGS, "q", "w", F.explode(pieces).alias("x"))
    held = held.select("cell", "of", "id", "l", *BAGS, "q", "w", "x.*", F.expr(f"explode(sequence(0, least({PIECE - 1}, l - q - x.at)))").alias("j"))
    place = F.col("at") + F.col("j")
    mark = _mark("substring(s, j + 1, q)", place)
    return held.select(
        "cell", "of", mark.alias("h"), F.col("id").alias("id2"), F.col("l").alias("l2"), *[F.col(x).alias(f"{x}2") for x in BAGS], place.alias("p2")
    )


@contextmanager
def _joined_where_they_lie(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CO_PARTITION, "true")
    spark.conf.set(CO_PARTITION, "false")
    try:
        yield
    finally:
        spark.conf.set(CO_PARTITION, before)


def _found(keys: DataFrame, threshold: float, letters: int) -> DataFrame:
    spark = keys.sparkSession
    shift = F.col("p2") - F.col("p")
    near = (F.abs(shift) <= F.col("i")) & (F.abs(shift + F.col("l") - F.col("l2")) <= F.col("d") - F.col("i"))
    fits = (F.col("l2") <= F.col("l")) & (F.col("l") - F.col("l2") <= F.col("d")) & (F.col("id") != F.col("id2"))
    # a substitution changes two counts by one, another edit one
    apart = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(f"{x}2"))) for x in BAGS), F.lit(0))
    alike = apart <= 2 * F.col("d") - (F.col("l") - F.col("l2"))
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    *sides, parts = _cells(keys, threshold, letters, least)
    longer, shorter = (side.repartition(parts, "cell") for side in sides)
    # the segments are a sixth of the substrings: hashing them saves sorting both
    segments = _segments(longer, threshold).hint("shuffle_hash")
    pairs = segments.join(_substrings(shorter, threshold), ["cell", "h"]).filter(fits & near).filter(alike)
    pairs = pairs.select("cell", "of", "id", "id2").distinct()
    for side, key_id, end in ((longer, "id", "u"), (shorter, "id2", "v")):
        held = side.select("cell", "of", F.col("id").alias(key_id), *[F.col(c).alias(f"{c}_{end}") for c in ("firm", "key", "n_docs")])
        pairs = pairs.join(held, ["cell", "of", key_id])
    # a task's cells can be of several firms
    pairs = pairs.filter((F.col("firm_u") == F.col("firm_v")) & similar("key_u", "key_v", threshold))
    first = F.struct((-F.col("n_docs_u")).alias("n"), F.col("key_u").alias("k")) < F.struct((-F.col("n_docs_v")).alias("n"), F.col("key_v").alias("k"))
    a = F.when(first, F.col("id")).otherwise(F.col("id2"))
    b = F.when(first, F.col("id2")).otherwise(F.col("id"))
    return pairs.select(a.alias("a"), b.alias("b")).distinct()  # of equal length, each is the longer one once


def similar_pairs(keys: DataFrame, threshold: float, letters: int = CELL_LETTERS) -> DataFrame:
    """The materialised table ``a, b``: ids of similar keys of one firm, ``a`` before ``b``
    in the firm's order.

    ``keys``: materialised ``id, firm, key, l, n_docs`` and the counts of letters; keys of
    a firm differ.
    """
    with _joined_where_they_lie(keys.sparkSession):
        return materialize(_found(keys, threshold, letters), "key-pairs")


def followers(pairs: DataFrame) -> DataFrame:
    """``id`` of the keys that lead no cluster.

    In each round the keys without an open earlier partner lead, and their later
    partners follow; both leave with their pairs. Rounds go on while pairs remain, as
    many as the longest chain of keys that each wait for the one before.
    """
    open_, settled = pairs, None
    while not open_.isEmpty():
        waiting = open_.select(F.col("b").alias("id")).distinct()
        leads = open_.select(F.col("a").alias("id")).distinct().join(waiting, "id", "left_anti")
        follow = open_.join(leads.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct()
        follow = materialize(follow, "key-followers")
        settled = follow if settled is None else settled.unionByName(follow)
        for end in ("a", "b"):
            open_ = open_.join(follow.withColumnRenamed("id", end), end, "left_anti")
        open_ = materialize(open_, "key-pairs")
    return settled if settled is not None else pairs.select(F.col("b").alias("id"))


def _numbered(heads: DataFrame) -> DataFrame:
    """``heads`` (``firm, n_docs, key`` and more) with ``cluster_id``: the place in the firm's order, from 0.

    Keys are dealt out by ranges of that order, counted within a range, and moved on by
    what the firm has in the ranges before, so a large firm spreads.
    """
    order = [F.col("n_docs").desc(), F.col("key")]
    ranged = heads.repartitionByRange("firm", *order).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "cluster-heads")
    sizes = ranged.groupBy("firm", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("firm").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("firm", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("firm", "_part").orderBy(*order))
    counted = ranged.withColumn("_place", place).join(sizes, ["firm", "_part"])
    return counted.withColumn("cluster_id", (F.col("_before") + F.col("_place") - 1).cast("int")).drop("_part", "_place", "_before")


def cluster_keys(frequency: DataFrame, threshold: float) -> DataFrame:
    """``firm, key, n_docs, cluster_id, rep, n_members`` for the keys of each firm; clusters are
    numbered in the order of their leaders."""
    bags = [_bag("key", classes).alias(name) for name, classes in BAGS.items()]
    keys = frequency.select("firm", "key", "n_docs", F.length("key").alias("l"), *bags)
    keys = materialize(keys.withColumn("id", F.monotonically_increasing_id()), "keys")
    pairs = similar_pairs(keys, threshold)
    follow = materialize(followers(pairs), "key-followers")
    order = keys.select(F.col("id").alias("a"), F.struct((-F.col("n_docs")).alias("n"), F.col("key").alias("k")).alias("order"))
    led = pairs.join(follow.withColumnRenamed("id", "a"), "a", "left_anti").join(order, "a")
    led = led.groupBy("b").agg(F.min_by("a", "order").alias("lead"), F.min("order").alias("order"))
    led = materialize(led.select(F.col("b").alias("id"), "lead", F.col("order.k").alias("lead_key")), "key-leaders")
    # ids are unique: no salts
    heads = _numbered(lookup_join(keys, follow, ["id"], "left_anti", salts=1).select("firm", "n_docs", "key", "id"))
    sizes = led.groupBy(F.col("lead").alias("id")).agg((F.count("*") + 1).alias("n_members"))
    heads = lookup_join(heads, materialize(sizes, "cluster-sizes"), ["id"], "left", salts=1)
    heads = materialize(heads.withColumn("n_members", F.coalesce("n_members", F.lit(1))), "clusters")
    out = ["firm", "key", "n_docs", "cluster_id", "rep", "n_members"]
    leaders = heads.filter("n_members > 1").select(F.col("id").alias("lead"), "cluster_id", "n_members")
    members = lookup_join(keys, led, ["id"], salts=1, few_match=True).join(leaders, "lead")
    return heads.withColumn("rep", F.col("key")).select(*out).unionByName(members.withColumn("rep", F.col("lead_key")).select(*out))
