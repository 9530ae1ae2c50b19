"""Benchmark decontamination: which documents hold passages of benchmark items.

A prefix-filtered set join on built-in functions only. A window of an item is
contained in a document only if all its shingles are, so it is enough to look for
one of them, the necessary prefix at full containment; the rarest one is taken.
Where that shingle occurs, the place of the window is known; it must fit into the
document, and its words must be equal.

Results for special input: a null or empty text, or one without word characters,
has no words and is not hit; an item without words has no window; a null item id
marks hits but is not listed; ids that several items share are listed once;
repeated documents each get a row; an empty table gives no rows, empty benchmarks
no hits. Other columns are not used.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerscope.llm.common import BROADCAST_BYTES, free_name, measured_join, numbered, plain, table_bytes
from offerscope.session import materialize

#: What stands between words once A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; the fast built-in where all is ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(ascii_only, F.lower(text)).otherwise(mapped)


def words_of(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")


def shingles(words: Column, size: Column | int) -> Column:
    """Hashes of ``size`` (1 to 3) consecutive words, one per start; none where the
    words are fewer."""
    places = F.sequence(F.lit(1), F.size(words) - size + 1)
    first = lambda i: F.element_at(words, i)
    hashed = {
        1: lambda i: F.xxhash64(first(i)),
        2: lambda i: F.xxhash64(first(i), first(i + 1)),
        3: lambda i: F.xxhash64(first(i), first(i + 1), first(i + 2)),
    }
    return F.when(F.size(words) >= size, F.transform(places, hashed[size])).otherwise(
        F.array().cast("array<bigint>")
    )


def item_windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``item_id, words``: each run of ``size`` words of an item, or all of a shorter one."""
    held = items.select(plain(id_col).cast("string").alias("item_id"), words_of(plain(text_col)).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - size + 1))
    return (
        held.filter(F.size("all") > 0)
        .select("item_id", "all", F.explode(starts).alias("start"))
        .select("item_id", F.slice("all", F.col("start"), size).alias("words"))
        .distinct()
    )


def _hits_in_place(places, prefix: DataFrame, widths: list[int]) -> DataFrame:
    """``row, doc_id, n_words, span, window``: the hits of a benchmark that is broadcast,
    checked where the texts lie, and a row without a hit per document."""
    start = F.col("place") - F.col("at")
    fits = (start >= 0) & (start + F.size("words") <= F.size("text_words"))
    equal = F.slice("text_words", F.greatest(start, F.lit(0)) + 1, F.size("words")) == F.col("words")
    found = None
    for number, width in enumerate(widths):
        part = places(width).join(F.broadcast(prefix.filter(F.col("width") == width)), ["width", "token"], "left")
        part = part.withColumn("hit", F.coalesce(fits & equal, F.lit(False)))
        head = F.coalesce("place", F.lit(0)) == 0 if number == 0 else F.lit(False)
        part = part.filter(F.col("hit") | head).select(
            "row", "doc_id", F.size("text_words").alias("n_words"),
            F.when(F.col("hit"), F.struct(start.alias("start"), (start + F.size("words")).alias("end"))).alias("span"),
            F.when(F.col("hit"), F.struct("window", "words")).alias("window"),
        )
        found = part if found is None else found.unionByName(part)
    return found


def _hits_by_row(texts: DataFrame, prefix: DataFrame, distinct: DataFrame, widths: list[int], limit: int) -> DataFrame:
    """``row, span, window`` of the hits of a large benchmark. Only numbers are shuffled per
    shingle; a text moves once, to the starts that its shingles gave, and hits are compared
    word by word with their window."""
    found = None
    for width in widths:
        words = words_of(F.col("text"))
        part = texts.select(F.col("row"), words.alias("text_words")).select(
            "row", F.size("text_words").alias("n_words"), F.lit(width).alias("width"),
            F.posexplode(shingles(F.col("text_words"), width)).alias("place", "token"),
        )
        rare = prefix.filter(F.col("width") == width).select("width", "token", "at", "window", F.size("words").alias("length"))
        part = measured_join(part, materialize(rare, "rare"), ["width", "token"], "inner", "row", limit)
        part = part.withColumn("start", F.col("place") - F.col("at"))
        part = part.filter((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
        part = part.select("row", "start", "length", "window")
        found = part if found is None else found.unionByName(part)
    starts = found.groupBy("row").agg(F.collect_list(F.struct("start", "length", "window")).alias("starts"))
    here = texts.select("row", "text").join(materialize(starts, "starts"), "row")
    here = here.select("row", words_of(F.col("text")).alias("text_words"), "starts")
    here = here.select("row", "text_words", F.inline("starts"))
    here = here.select("row", "start", "window", F.slice("text_words", F.col("start") + 1, F.col("length")).alias("held_words"))
    here = here.filter(F.xxhash64("held_words") == F.col("window"))
    windows = materialize(distinct, "distinct")
    here = measured_join(here, windows, ["window"], "inner", "row", limit).filter("held_words = words")
    span = F.struct(F.col("start"), (F.col("start") + F.size("words")).alias("end"))
    return here.select("row", span.alias("span"), F.struct("window", "words").alias("window"))


def contamination(
    documents: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 10,
    limit: int = BROADCAST_BYTES,
    row_col: str | None = None,
) -> DataFrame:
    """Per row of ``documents``: its id as ``doc_id``, ``n_words``, ``n_hit`` (words
    inside an occurring window), ``items`` (sorted ids of items with occurring
    windows) and ``hits`` (start and end, exclusive, of each occurrence). With ``row_col``,
    a column that ``numbered`` made, also ``row``, the number there.

    Two passes over the texts. The first counts the shingles that windows have, over
    all documents; the second joins the documents' shingles with the rarest one of
    each window. Benchmark tables are broadcast when they measure at most ``limit``
    bytes; else numbers per shingle are joined over salts, and each text moves once.
    """
    windows = materialize(
        item_windows(items, item_id_col, item_text_col, size)
        .withColumn("window", F.xxhash64("words")),
        "windows",
    )
    owners = windows.select("window", "words", "item_id")
    distinct = windows.select("window", "words").distinct()
    width = F.least(F.lit(3), F.size("words"))
    by_width = F.when(width == 3, shingles(F.col("words"), 3)).when(
        width == 2, shingles(F.col("words"), 2)
    ).otherwise(shingles(F.col("words"), 1))
    tokens = materialize(
        distinct.withColumn("width", width).select("window", "words", "width", F.posexplode(by_width).alias("at", "token")),
        "tokens",
    )
    widths = sorted(row[0] for row in tokens.select("width").distinct().collect())  # at most 1, 2, 3

    keep_row = row_col is not None
    if not keep_row:
        row_col = free_name(documents, "row")
        documents = numbered(documents, row_col)
    held = documents.select(
        plain(row_col).alias("row"),
        plain(id_col).alias("doc_id"),
        words_of(plain(text_col)).alias("text_words"),
    )

    def places(width: int) -> DataFrame:
        return held.select(
            "row", "doc_id", "text_words", F.lit(width).alias("width"),
            F.posexplode_outer(shingles(F.col("text_words"), width)).alias("place", "token"),
        )

    counted = None
    for width in widths:
        found = places(width).select("width", "token", "row").filter("token is not null")
        wanted = tokens.filter(F.col("width") == width).select("width", "token").distinct()
        part = measured_join(found, materialize(wanted, "wanted"), ["width", "token"], "inner", "row", limit)
        part = part.groupBy("width", "token").agg(F.count(F.lit(1)).alias("n"))
        counted = part if counted is None else counted.unionByName(part)

    hit = "array<struct<start:int,end:int>>"
    named = (["row"] if keep_row else []) + ["doc_id"]
    if counted is None:  # no windows at all
        return held.select(
            *named, F.size("text_words").alias("n_words"), F.lit(0).cast("bigint").alias("n_hit"),
            F.array().cast("array<string>").alias("items"), F.array().cast(hit).alias("hits"),
        )

    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "token")
    prefix = materialize(
        tokens.join(counted, ["width", "token"], "left")
        .groupBy("window", "words", "width")
        .agg(F.min(rarity).alias("rarest"))
        .filter("rarest.n > 0")
        .select("window", "words", "width", "rarest.at", "rarest.token"),
        "prefix",
    )

    if table_bytes(prefix) <= limit:
        found = _hits_in_place(places, prefix, widths)
    else:
        texts = documents.select(plain(row_col).alias("row"), plain(text_col).alias("text"))
        head = held.select("row", "doc_id", F.size("text_words").alias("n_words"))
        found = head.join(_hits_by_row(texts, prefix, distinct, widths, limit), "row", "left")
    per_row = materialize(
        found.groupBy("row").agg(
            F.any_value("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.array_sort(F.collect_set("span")).alias("hits"),
            F.collect_set("window.window").alias("windows"),
        ),
        "hits",
    )
    listed = per_row.select("row", F.explode("windows").alias("window"))
    names = owners.select("window", "item_id").filter("item_id is not null").distinct()
    listed = measured_join(listed, materialize(names, "names"), ["window"], "inner", "row", limit)
    listed = listed.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda done, span: F.struct(
            (done["n"] + F.greatest(F.lit(0), span["end"] - F.greatest(done["end"], span["start"]))).cast("bigint").alias("n"),
            F.greatest(done["end"], span["end"]).alias("end"),
        ),
        lambda done: done["n"],
    )
    return per_row.join(listed, "row", "left").select(
        *named, F.col("n_words"), covered.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "hits",
    )


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return found.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.col("n_hit").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
