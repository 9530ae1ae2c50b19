"""Column expressions over advertisement text.

Everything here stays in the JVM except ``strip_marks``, which calls Python for
the few rows whose characters have a longer compatibility form.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that count as white space in Unicode text.
SPACE_CHARS = (
    r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
SPACES = f"[{SPACE_CHARS}]+"

# Head and tail sizes of the shortened model text, and its joint.
WHOLE_TEXT_CHARS = 4500
HEAD_CHARS = 1800
TAIL_CHARS = 3200
HEAD_TAIL_JOINT = " [...] "
# Fixed value: an occupation code, a capital and four decimal digits of any script.
OCCUPATION_CODE = r"(?d)^[A-Z]\p{Nd}{4}$"
UNKNOWN_DOMAIN = "UNKNOWN"


def minimal_clean(text: Column) -> Column:
    """Null to empty, every run of white space to one space, no outer space."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))


def has_text(text: Column) -> Column:
    """True where ``minimal_clean`` leaves something; stops at the first sign."""
    return F.coalesce(text.rlike(f"[^{SPACE_CHARS}]"), F.lit(False))


def head_tail(
    clean: Column,
    whole: int = WHOLE_TEXT_CHARS,
    head: int = HEAD_CHARS,
    tail: int = TAIL_CHARS,
) -> Column:
    """Short texts whole; of longer ones the beginning and the end."""
    shortened = F.concat(
        F.substring(clean, 1, head), F.lit(HEAD_TAIL_JOINT), F.right(clean, F.lit(tail))
    )
    return F.when(F.length(clean) <= whole, clean).otherwise(shortened)


def truncate(text: Column, chars: int) -> Column:
    return F.substring(text, 1, chars)


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, f"^{SPACES}|{SPACES}$", "")


def normalised_name(name: Column) -> Column:
    return F.lower(stripped(name))


def is_occupation_code(code: Column) -> Column:
    return F.coalesce(code.rlike(OCCUPATION_CODE), F.lit(False))


def occupation_domain(code: Column) -> Column:
    """First letter of a valid code, otherwise ``UNKNOWN``."""
    code = stripped(code)
    return F.when(is_occupation_code(code), F.substring(code, 1, 1)).otherwise(
        F.lit(UNKNOWN_DOMAIN)
    )


# --- accents ---------------------------------------------------------------


def _unmarked(char: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def _accent_table() -> dict[str, str]:
    """Latin characters whose unmarked form is one other character."""
    blocks = [range(0xC0, 0x250), range(0x1E00, 0x1F00)]
    forms = {chr(cp): _unmarked(chr(cp)) for block in blocks for cp in block}
    return {char: form for char, form in forms.items() if len(form) == 1 and form != char}


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def fold_accents(text: Column) -> Column:
    """Accented Latin letters to their base letter, combining marks dropped.

    Plain ASCII rows, whose bytes are as many as their characters, skip the work.
    """
    # Characters beyond the replacements are deleted.
    marks = "".join(map(chr, range(0x300, 0x370)))
    marked, plain = "".join(_accent_table()) + marks, "".join(_accent_table().values())

    def folded(t: Column) -> Column:
        return F.when(
            F.octet_length(t) > F.char_length(t), F.translate(t, marked, plain)
        ).otherwise(t)

    return bind(text, folded)


@lru_cache(maxsize=1)
def _settled() -> str:
    """Characters that ``fold_accents`` turns into their unmarked form."""
    blocks = [range(0x370), range(0x1E00, 0x1F00), range(0x2010, 0x2040), [0x20AC]]
    return "".join(
        chr(cp)
        for block in blocks
        for cp in block
        if 0x300 <= cp <= 0x36F or chr(cp) in _accent_table() or _unmarked(chr(cp)) == chr(cp)
    )


def strip_marks(text: Column) -> Column:
    """Compatibility decomposition without combining marks, exactly.

    Rows made of ASCII and settled Latin characters never leave the JVM: the
    Python worker sees null for them.
    """

    @F.pandas_udf(T.StringType())
    def compatibility_form(texts: pd.Series) -> pd.Series:
        return texts.map(_unmarked, na_action="ignore")

    rare = F.length(F.translate(text, _settled(), "")) > 0
    return F.when(rare, compatibility_form(F.when(rare, text))).otherwise(fold_accents(text))


# --- titles ----------------------------------------------------------------


def clean_title(title: Column) -> Column:
    """Lower case, no accents, words only; null stays null."""
    plain = strip_marks(F.lower(title))
    words = F.regexp_replace(plain, rf"[^\p{{L}}\p{{N}}_{SPACE_CHARS}]", " ")
    return F.trim(F.regexp_replace(words, SPACES, " "))


def has_word(clean: Column, word: str) -> Column:
    """True where a cleaned title holds ``word``; null titles give false."""
    return F.coalesce(clean.rlike(rf"(?U)\b{re.escape(word)}\b"), F.lit(False))


# --- HTML, sentences, keys ---------------------------------------------------

# Our reading of "HTML to text that keeps lines", in order of application.
TAG_RULES = [
    (r"(?is)<script.*?</script>", ""),
    (r"(?is)<style.*?</style>", ""),
    (r"(?s)<!--.*?-->", ""),
    (r"(?i)<br\s*/?>|</(p|div|li|ul|ol|h[1-6]|tr|section|article)\s*>", "\n"),
    (r"<[^>]*>", " "),
]
ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&amp;", "&"),
]
BLANKS = "\t\x0b\f\r\u00a0"
SENTENCE_ENDS = ".!?…"


# Most rows pass the two rules below as they are; looking for the few that do not
# is much cheaper than a regular expression over all.


def _single_blanks(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " ")).otherwise(text)


def _single_line_ends(text: Column) -> Column:
    loose = [F.contains(text, F.lit(pair)) for pair in (" \n", "\n ", "\n\n")]
    return F.when(
        loose[0] | loose[1] | loose[2], F.regexp_replace(text, r" ?\n(?: ?\n)* ?", "\n")
    ).otherwise(text)


def _without_tags(text: Column) -> Column:
    def clean(t: Column) -> Column:
        stripped = t
        for pattern, replacement in TAG_RULES:
            stripped = F.regexp_replace(stripped, pattern, replacement)
        return F.when(F.contains(t, F.lit("<")), stripped).otherwise(t)

    return bind(text, clean)


def _without_entities(text: Column) -> Column:
    def clean(t: Column) -> Column:
        read = t
        for entity, char in ENTITIES:
            read = F.replace(read, F.lit(entity), F.lit(char))
        return F.when(F.contains(t, F.lit("&")), read).otherwise(t)

    return bind(text, clean)


def html_to_text(html: Column) -> Column:
    """Visible text with one line per block; null gives an empty string.

    Blanks become one space, blanks around and between line ends go. The tag and
    entity rules run only on rows that hold ``<`` or ``&``.
    """
    text = _without_entities(_without_tags(F.coalesce(html, F.lit(""))))
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.btrim(bind(bind(text, _single_blanks), _single_line_ends), F.lit(" \n"))


def raw_clean(html: Column) -> Column:
    return F.replace(html_to_text(html), F.lit("\n"), F.lit(" "))


def sentence_lines(text: Column) -> Column:
    """The text with exactly one sentence per line."""
    lines = html_to_text(text)
    for end in SENTENCE_ENDS:
        lines = F.replace(lines, F.lit(f"{end} "), F.lit(f"{end}\n"))
    return lines


def sentences_of(lines: Column) -> Column:
    """Sentences of ``sentence_lines``; an empty text gives one empty sentence."""
    return F.split(lines, "\n")


def sentence_keys_of(
    lines: Column,
    remove_accents: bool = True,
    collapse_digits: bool = True,
    max_tokens: int | None = None,
    lower: bool = True,
) -> Column:
    """The normal form of every sentence, in the order of ``sentences_of``.

    The rules work on single characters, so they run once over the whole text;
    line ends survive them and the split comes last.
    """
    keys = F.lower(lines) if lower else lines
    if remove_accents:
        keys = fold_accents(keys)
    if collapse_digits:
        keys = F.regexp_replace(keys, "[0-9]+", "0")
    keys = F.regexp_replace(keys, r"[^\p{L}\p{N}\n]+", " ")
    for blank in (" \n", "\n "):
        keys = F.replace(keys, F.lit(blank), F.lit("\n"))
    keys = F.split(F.trim(keys), "\n")
    if max_tokens is not None:
        keys = F.transform(
            keys, lambda k: F.array_join(F.slice(F.split(k, " "), 1, max_tokens), " ")
        )
    return keys


def word_count(text: Column) -> Column:
    """Default token count: the number of space-separated pieces."""
    return F.size(F.split(text, " "))


def token_counter(count):
    """A column function around a caller's ``text -> int`` tokenizer."""

    @F.pandas_udf(T.IntegerType())
    def counted(texts: pd.Series) -> pd.Series:
        return texts.map(count).astype("int32")

    return counted
