"""Language identification by compression.

Each language has a zstandard dictionary of raw content. A text belongs to the
language whose dictionary lets it shrink most; if the runner-up comes too close, the
answer is rejected. Long texts are compressed in pieces and the sizes added up, so that
all of a text counts, however long it is.

Results for special input: a null text, or one without any letter, is ``und`` with
score 0 and rejected; equal sizes go to the language with more training rows, then by
name; a text in one known language only is compared with nothing and scores 1; with no
training rows every text is ``und``; a language without a letter in its training texts
has nothing to learn from and is not among the names; repeated rows get equal answers;
an empty table gives no rows. Other columns are not used.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerscope.llm.common import plain
from offerscope.llm.files import worker_state

#: Bounds of the training sample: languages, texts of each, and bytes of a text and a dictionary.
LANGUAGES, SAMPLE_TEXTS = 200, 150
TEXT_BYTES, DICTIONARY_BYTES = (200, 4_000), 112 * 1024
#: Languages that such texts leave short are filled from texts of any length: texts of each
#: and pieces of a text that the first round reads, by how much the next one reads more,
#: characters of a piece, and the grains of a draw.
FIRST_ROUND, MORE, PIECE_CHARS, DRAWS = (4_096, 8), 32, 500, 1 << 20
#: Compression that finds matches of three bytes, which short words need.
SEARCH = {"strategy": zstandard.STRATEGY_LAZY, "window_log": 18, "hash_log": 17, "chain_log": 17, "search_log": 3, "min_match": 3}
#: Bytes of a text that are compressed at once. With the dictionary they fit the window, so each
#: part of a long text is measured against the dictionary and not against the text before it.
PIECE_BYTES = 64 * 1024
#: Goes before each piece: a block that would not shrink is stored as it is, and sizes would tell nothing.
CARRIER = b" " * 128
#: The runner-up must need at least this share more bytes.
MARGIN = 0.005
UNDETERMINED = "und"


def letters(text: str) -> bytes:
    """The words of a text in lower case, without digits and marks."""
    words = re.findall(r"[^\W\d_]+", text.lower())
    return f" {' '.join(words)} ".encode("utf-8", "surrogatepass")


@dataclass
class Languages:
    """Raw content per language, the most frequent language first."""

    names: list[str]
    contents: list[bytes]

    def compressors(self) -> list:
        """One compressor per language and worker process."""
        held = worker_state("languages")
        key = ("languages", hashlib.sha1(b"\0".join(self.contents)).digest())
        if key not in held:
            made = []
            for content in self.contents:
                dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                search = zstandard.ZstdCompressionParameters(
                    write_content_size=False, write_checksum=False, write_dict_id=False, **SEARCH
                )
                dictionary.precompute_compress(compression_params=search)
                made.append(zstandard.ZstdCompressor(compression_params=search, dict_data=dictionary))
            held[key] = made
        return held[key]

    def identify(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the answer is accepted."""
        if not self.names or not text or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, False
        data = letters(text)
        pieces = [CARRIER + data[at : at + PIECE_BYTES] for at in range(0, len(data), PIECE_BYTES)]
        sizes = [sum(len(c.compress(piece)) for piece in pieces) for c in self.compressors()]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.names[0], 1.0, True
        ahead = min(size for k, size in enumerate(sizes) if k != best) - sizes[best]
        return self.names[best], 1 - 2.0**-ahead, ahead >= MARGIN * sizes[best] and ahead > 0


def learn(documents: DataFrame, id_col: str, text_col: str, lang_col: str) -> Languages:
    """Dictionaries from documents whose crc32 of the id, modulo 3, is not 1: texts of
    ``TEXT_BYTES`` first, and of any other length where those do not fill a dictionary. The
    driver gets at most ``LANGUAGES * SAMPLE_TEXTS`` texts of at most ``TEXT_BYTES[1]``
    bytes, and in each round twice ``DICTIONARY_BYTES`` for a language that is short."""
    rows = documents.select(plain(id_col).alias("id"), plain(text_col).alias("text"), plain(lang_col).cast("string").alias("lang"))
    rows = rows.filter(F.coalesce(F.pmod(F.crc32(F.col("id").cast("string")), F.lit(3)) != 1, F.lit(False)))
    rows = rows.filter("lang is not null and text is not null")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "text")
    sample = rows.filter(F.octet_length("text").between(*TEXT_BYTES)).withColumn("rank", F.row_number().over(first))
    texts: dict[str, list[str]] = {}
    for row in sample.filter(F.col("rank") <= SAMPLE_TEXTS).orderBy("lang", "rank").collect():
        texts.setdefault(row["lang"], []).append(row["text"])
    contents: dict[str, list[bytes]] = {row["lang"]: [] for row in counts}
    for lang, held in contents.items():
        size = 0
        for text in dict.fromkeys(texts.get(lang, ())):
            data = letters(text)
            if size + len(data) <= DICTIONARY_BYTES:
                held.append(data)
                size += len(data)
    _fill(rows, {row["lang"]: row["n"] for row in counts}, contents)
    names = [lang for lang, held in contents.items() if held]
    return Languages(names, [b"".join(contents[lang]) for lang in names])


def _fill(rows: DataFrame, counts: dict[str, int], contents: dict[str, list[bytes]]) -> None:
    """Adds to the contents of languages that are short of ``DICTIONARY_BYTES`` from texts of
    any length, in pieces that lie evenly over a text. ``counts`` has the number of a
    language's texts.

    A round reads so many texts of a language, drawn by their hash, and so many pieces of
    each; where that is too little, the next one reads more and begins anew, until all
    dictionaries are full or all texts of their languages have been read whole."""
    begun = {lang: list(held) for lang, held in contents.items()}
    texts, pieces = FIRST_ROUND
    read: set[str] = set()
    longest = None
    while True:
        size = {lang: sum(map(len, held)) for lang, held in contents.items()}
        short = [lang for lang in contents if size[lang] + TEXT_BYTES[1] < DICTIONARY_BYTES and lang not in read]
        if not short:
            return
        if longest is None:
            longest = rows.filter(F.col("lang").isin(short)).agg(F.max(F.char_length("text"))).first()[0]
        draws = [(lang, min(DRAWS, -(-DRAWS * texts // counts[lang]))) for lang in short]
        some = _words(rows, rows.sparkSession.createDataFrame(draws, "lang string, draws long"), pieces)
        contents.update((lang, list(begun[lang])) for lang in short)
        known = {lang: set(contents[lang]) for lang in short}
        size = {lang: sum(map(len, contents[lang])) for lang in short}
        for row in some.orderBy("lang", "rank").select("lang", "words").collect():
            lang = row["lang"]
            data = letters(row["words"])
            if data not in known[lang] and size[lang] < DICTIONARY_BYTES:
                known[lang].add(data)
                contents[lang].append(data[: DICTIONARY_BYTES - size[lang]])
                size[lang] += len(contents[lang][-1])
        read.update(lang for lang in short if counts[lang] <= texts and longest <= pieces * PIECE_CHARS)
        texts, pieces = texts * MORE, pieces * MORE


def _words(rows: DataFrame, draws: DataFrame, most: int) -> DataFrame:
    """``lang, words, rank``: of each language in ``draws`` distinct texts, or up to ``most``
    pieces of a text longer than ``TEXT_BYTES[1]`` bytes, without digits and marks; together
    twice ``DICTIONARY_BYTES``, since what a dictionary holds already may come again."""
    some = rows.join(F.broadcast(draws), "lang").filter(F.pmod(F.xxhash64("text"), F.lit(DRAWS)) < F.col("draws"))
    whole = F.octet_length("text") <= TEXT_BYTES[1]
    total = F.when(whole, 1).otherwise(F.ceil(F.char_length("text") / PIECE_CHARS))
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0))
    some = some.select("lang", total.alias("total"), F.posexplode(F.when(whole, F.array("text")).otherwise(cut)).alias("at", "piece"))
    some = some.filter(F.pmod(F.col("at") * F.least("total", F.lit(most)), F.col("total")) < most)
    words = F.trim(F.regexp_replace("piece", r"[^\p{L}\p{Nl}\p{No}]+", " "))
    some = some.select("lang", words.alias("words")).filter(F.col("words").rlike(r"\p{L}")).distinct()
    first = Window.partitionBy("lang").orderBy(F.xxhash64("words"), "words")
    some = some.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= DICTIONARY_BYTES)
    before = F.sum(F.octet_length("words") + 2).over(first.rowsBetween(Window.unboundedPreceding, -1))
    return some.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < 2 * DICTIONARY_BYTES)


def identify(known: Languages, text: Column) -> Column:
    """``lang_pred, score, accepted`` of a text as a struct column."""

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def found(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([known.identify(text) for text in texts], columns=["lang_pred", "score", "accepted"])

    return found(text)
