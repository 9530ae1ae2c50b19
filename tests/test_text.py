"""Text expressions on hand-made rows."""

import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from offerscope.functions import text as X
from offerscope.plans.flows import clean_titles


def values(spark, texts, *expressions):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = frame.select("i", *[e(F.col("t")).alias(f"c{n}") for n, e in enumerate(expressions)]).orderBy("i").collect()
    return [r["c0"] if len(expressions) == 1 else tuple(r[1:]) for r in rows]


def python_title(text):
    text = "".join(
        c for c in unicodedata.normalize("NFKD", text.strip().lower()) if not unicodedata.combining(c)
    )
    return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", re.sub("[/-]", " ", text))).strip()


TITLES = [
    "Stage - Développeur/se (H/F)", "", "  ", "stagiaire", "hostage", "e\u0301te\u0301 été",
    "cœur ﬁn ½ ²", "a\u00a0b\u2003c\u202fd", "Ingénieur·e d'études", "snake_case A/B-C", "İzmir", "Ⅷ ℡ 한국어", "x\u001cy",
]


def test_clean_title(spark):
    assert values(spark, [None, *TITLES], X.clean_title) == [None, *map(python_title, TITLES)]


def test_clean_title_on_any_text(spark):
    alphabet = st.characters(min_codepoint=1, max_codepoint=0x2FFF, exclude_categories=("Cn", "Cs", "Co"))

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text(alphabet, max_size=12), min_size=40, max_size=40))
    def check(texts):
        # Capital sigma and the like: lower-casing is compared elsewhere.
        texts = [t.lower() for t in texts if t.lower() == t.lower().lower() and "σ" not in t.lower()]
        marks = [t for t in texts if not any(unicodedata.category(c) == "Mn" and ord(c) > 0x370 for c in t)]
        assert values(spark, marks, X.strip_marks) == [X._unmarked(t) for t in marks]

    check()


def test_title_filter_keeps_null_titles_and_counts(spark):
    frame = spark.createDataFrame([(t,) for t in [None, *TITLES]], "t string")
    seen = Observation("titles")
    kept = clean_titles(frame, "t", seen=seen).collect()
    assert len(kept) == len(TITLES) and any(r["t"] is None for r in kept)
    assert seen.get == {"n_rows": len(TITLES) + 1, "n_removed": 1}


def test_minimal_clean(spark):
    texts = [None, "", "  a \u00a0\u2003\t b\u202f", "\u001ca\u0085b\n\n"]
    assert values(spark, texts, X.minimal_clean) == ["", "", "a b", "a b"]
    assert values(spark, texts, X.has_text) == [False, False, True, True]


def test_head_tail_edges(spark):
    texts = ["x" * 4500, "a" * 1800 + "b" * 2701 + "😀", "é" * 6000]
    whole, cut, long = values(spark, texts, X.head_tail)
    assert whole == texts[0]
    assert cut == texts[1][:1800] + " [...] " + texts[1][-3200:]
    assert len(long) == 1800 + 7 + 3200


def test_occupation_codes(spark):
    codes = ["H1206", " H1206 ", "\u00a0H1206\u00a0", "h1206", "H120", "H12065", "", None, "H1206\n", "H1206\r", "H\u0661\u0662\u0660\u0666"]
    found = values(spark, codes, X.is_occupation_code, X.occupation_domain)
    assert [v for v, _ in found] == [bool(c and re.match(r"^[A-Z]\d{4}$", c)) for c in codes]
    assert [d for _, d in found] == ["H", "H", "H"] + ["UNKNOWN"] * 5 + ["H"] * 3


def test_html_keeps_lines(spark):
    html = (
        "<script>var a='<p>';</script><style>p{}</style><!-- x\ny --><h1>Titre</h1><p>un<br/>deux&nbsp;&amp;lt;"
        "<li>a</li><LI>b</LI><b>c</b>  d"
    )
    assert values(spark, [html, None, "<p></p>"], X.html_to_text) == ["Titre\nun\ndeux &lt; a\nb\nc d", "", ""]


def test_sentences_and_keys_stay_aligned(spark):
    text = "Bonjour ! Été 2024...\n• --- \nPoste n° 12, à Lyon"
    lines = lambda t: X.sentences_of(X.sentence_lines(t))
    keys = lambda t: X.sentence_keys_of(X.sentence_lines(t))
    short = lambda t: X.sentence_keys_of(X.sentence_lines(t), False, False, 2)
    (found,) = values(spark, [text], lines, keys, short)
    assert found[0] == ["Bonjour !", "Été 2024...", "• ---", "Poste n° 12, à Lyon"]
    assert found[1] == ["bonjour", "ete 0", "", "poste n 0 a lyon"]
    assert found[2] == ["bonjour", "été 2024", "", "poste n"]
    assert values(spark, ["", None], lines, keys) == [([""], [""])] * 2


def test_token_counter(spark):
    assert values(spark, ["a b", ""], X.token_counter(lambda t: len(t) + 2)) == [5, 2]


def plain_lines(text):
    """The rules one after the other."""
    rules = [
        (r"(?is)<script.*?</script>", ""), (r"(?is)<style.*?</style>", ""), (r"(?s)<!--.*?-->", ""),
        (r"(?i)<br\s*/?>|</(p|div|li|ul|ol|h[1-6]|tr|section|article)\s*>", "\n"), (r"<[^>]*>", " "),
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;|&apos;", "'"), ("&amp;", "&"),
        ("[ \t\x0b\f\r\xa0]+", " "), (r" ?\n ?", "\n"), (r"\n+", "\n"), (r"^\s+|\s+$", ""), (r"([.!?…]+)\s+", "\\1\n"),
    ]
    for pattern, replacement in rules:
        text = re.sub(pattern, replacement, text, flags=re.ASCII)
    return text


def test_lines_follow_the_plain_rules(spark):
    pieces = ["a", "b", " ", "  ", "\n", " \n", "\n ", "\t", "\u00a0", "\r\n", ".", "!", "…", "?. ", "<p>", "</p>", "<br/>", "&nbsp;", "&amp;", "&lt;", "<!-- x -->"]

    @settings(max_examples=10, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(pieces), max_size=14).map("".join), min_size=60, max_size=60))
    def check(texts):
        assert values(spark, texts, X.sentence_lines) == [plain_lines(t) for t in texts]

    check()
