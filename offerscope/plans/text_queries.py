"""Queries over titles, texts and boilerplate."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from offerscope.functions import text as X
from offerscope.operators import boilerplate as B
from offerscope.operators import quality as Q
from offerscope.operators.entities import extract_entities, group_entities, term_entities
from offerscope.operators.groups import value_counts
from offerscope.operators.sampling import stratum_distribution
from offerscope.operators.similarity import column_histogram
from offerscope.plans.flows import clean_titles
from offerscope.plans.inputs import DOMAIN, OFFERS, documents, offers
from offerscope.plans.registry import query
from offerscope.session import scratch_path
from offerscope.sources.tables import load_table, save_table, spread


def _replaced(expression: str, rules: list[tuple[str, str]]) -> str:
    for pattern, replacement in rules:
        pattern, replacement = pattern.replace("'", "''"), replacement.replace("'", "''")
        expression = f"regexp_replace({expression}, '{pattern}', '{replacement}', 'g')"
    return expression


_SPACED = [(X.SPACES, " ")]
_CLEAN = f"trim({_replaced("coalesce(text, '')", _SPACED)})"


_HTML = [
    (r"(?is)<script.*?</script>", ""),
    (r"(?is)<style.*?</style>", ""),
    (r"(?s)<!--.*?-->", ""),
    (r"(?i)<br\s*/?>|</(p|div|li|ul|ol|h[1-6]|tr|section|article)\s*>", "\n"),
    (r"<[^>]*>", " "),
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;|&apos;", "'"),
    ("&amp;", "&"),
    (r"[ \t\x{0B}\f\r\x{A0}]+", " "),
    (r" ?\n ?", "\n"),
    (r"\n+", "\n"),
    (r"^\s+|\s+$", ""),
]


def _html(expression: str) -> str:
    return _replaced(f"coalesce({expression}, '')", _HTML)


_LINES = _replaced(_html("lower(text)"), [(r"([.!?…]+)\s+", "\\1\n")])
_KEY = "trim(" + _replaced("strip_accents(lower(sentence))", [("[0-9]+", "0"), (r"[^\p{L}\p{N}]+", " ")]) + ")"
# The firm: white space of any kind is stripped. Written out, so that it does not follow the code.
_SPACE = (
    r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)
_FIRM = f"regexp_replace(source, '^{_SPACE}|{_SPACE}$', '', 'g')"
# One row per sentence with its key.
_SENTENCES = f"""
lines AS (SELECT doc_id, {_FIRM} AS firm, string_split({_LINES}, chr(10)) AS parts FROM documents),
sentences AS (
  SELECT doc_id, firm, CAST(pos - 1 AS INTEGER) AS pos, sentence, {_KEY} AS key
  FROM (SELECT doc_id, firm, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS pos FROM lines)
  WHERE sentence <> '')"""
_FREQUENCY = f"""{_SENTENCES},
frequency AS (
  SELECT firm, key, count(DISTINCT doc_id) AS n_docs FROM sentences
  WHERE firm <> '' AND key <> '' GROUP BY firm, key),
sizes AS (SELECT {_FIRM} AS firm, count(*) AS n_offers FROM documents WHERE {_FIRM} <> '' GROUP BY 1)"""
_DROPS = f"""{_FREQUENCY},
drops AS (
  SELECT firm, key FROM frequency JOIN sizes USING (firm)
  WHERE n_docs >= greatest(2, ceil(CAST(0.1 AS DOUBLE) * n_offers)))"""


def _segmented(spark, sf_dir):
    return B.segment_offers(documents(spark, sf_dir), "doc_id", "text", "source")


# --- titles and model texts -----------------------------------------------------------


@query(
    f"""SELECT doc_id, trim({_replaced("strip_accents(lower(text))",
        [("[^" + r"\p{L}\p{N}_" + X.SPACE_CHARS + "]", " "), (X.SPACES, " ")])}) AS title_clean FROM documents"""
)
def title_clean(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", X.clean_title(F.col("text")).alias("title_clean"))


@query("SELECT p_partkey, p_name AS job_title_clean FROM part WHERE NOT regexp_matches(p_name, '(^| )gear( |$)')")
def title_filter(spark, sf_dir):
    parts = load_table(spark, f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    return clean_titles(parts, "p_name", word="gear").drop("p_name")


@query(f"SELECT doc_id, {_CLEAN} AS clean FROM documents")
def minimal_clean(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", X.minimal_clean(F.col("text")).alias("clean"))


@query(
    f"""SELECT doc_id, CASE WHEN length(c) <= 4500 THEN c
          ELSE substr(c, 1, 1800) || ' [...] ' || right(c, 3200) END AS model_text
        FROM (SELECT doc_id, {_CLEAN} AS c FROM documents)"""
)
def head_tail_text(spark, sf_dir):
    clean = documents(spark, sf_dir).select("doc_id", X.minimal_clean(F.col("text")).alias("clean"))
    return clean.select("doc_id", X.head_tail(F.col("clean")).alias("model_text"))


@query(
    f"""SELECT page_id, text, replace(text, chr(10), ' ') AS raw_clean
        FROM (SELECT page_id, {_html("html")} AS text FROM pages)"""
)
def html_text(spark, sf_dir):
    pages = spread(load_table(spark, f"{sf_dir}/pages.parquet"), "page_id").select(
        "page_id", X.html_to_text(F.col("html")).alias("text")
    )
    return pages.withColumn("raw_clean", F.replace("text", F.lit("\n"), F.lit(" ")))


# --- occupations, counts ---------------------------------------------------------------


@query(f"WITH {OFFERS} SELECT doc_id, occ, regexp_matches(occ, '^[A-Z][0-9]{{4}}$') AS valid, {DOMAIN} AS domain FROM offers")
def occupation_valid(spark, sf_dir):
    return offers(spark, sf_dir).select(
        "doc_id",
        "occ",
        X.is_occupation_code(F.col("occ")).alias("valid"),
        X.occupation_domain(F.col("occ")).alias("domain"),
    )


@query(
    f"""WITH {OFFERS} SELECT domain, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 6) AS pct
        FROM (SELECT {DOMAIN} AS domain FROM offers) GROUP BY domain"""
)
def domain_counts(spark, sf_dir):
    domains = offers(spark, sf_dir).select(X.occupation_domain(F.col("occ")).alias("domain"))
    return stratum_distribution(domains, "domain").withColumn("pct", F.round("pct", 6))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 20")
def firm_counts(spark, sf_dir):
    return value_counts(load_table(spark, f"{sf_dir}/documents.parquet"), "source", 20)


@query(f"SELECT doc_id, lang FROM documents WHERE lower({_FIRM}) = 'src3' AND contains(lower(text), 'the')")
def firm_phrase_filter(spark, sf_dir):
    held = documents(spark, sf_dir).filter(
        (X.normalised_name(F.col("source")) == "src3") & F.contains(F.lower("text"), F.lit("the"))
    )
    return held.select("doc_id", "lang")


@query(
    """WITH e AS (SELECT CAST(min(n_chars) AS DOUBLE) AS lo, (max(n_chars) - min(n_chars)) / CAST(400 AS DOUBLE) AS w FROM documents),
       c AS (SELECT CAST(least(floor((n_chars - lo) / w), 399) AS INTEGER) AS bin, count(*) AS n FROM documents, e GROUP BY 1)
       SELECT CAST(b.i AS INTEGER) AS bin, round(lo + b.i * w, 6) AS lower, coalesce(c.n, 0) AS n
       FROM e, range(400) b(i) LEFT JOIN c ON c.bin = b.i"""
)
def length_histogram(spark, sf_dir):
    table = load_table(spark, f"{sf_dir}/documents.parquet")
    return column_histogram(table, "n_chars", 400).withColumn("lower", F.round("lower", 6))


# --- lengths ------------------------------------------------------------------------------


_TOKENS = f"""tokens AS (
  SELECT len(string_split(c, ' ')) AS n FROM (SELECT {_CLEAN} AS c FROM documents) WHERE length(c) > 0)"""


def _tokens(spark, sf_dir):
    written = documents(spark, sf_dir).filter(X.has_text(F.col("text")))
    return written.select(X.word_count(X.minimal_clean(F.col("text"))).alias("n_tokens"))


@query(
    f"""WITH {_TOKENS} SELECT count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
          CAST(min(n) AS INTEGER) AS min, {", ".join(f"round(quantile_cont(n, 0.{p}), 6) AS p{p}" for p in (50, 75, 90, 95, 99))},
          CAST(max(n) AS INTEGER) AS max, 1024 AS max_length, count(*) FILTER (n > 1024) AS n_truncated,
          round(count(*) FILTER (n > 1024) / CAST(count(*) AS DOUBLE) * 100, 6) AS pct_truncated FROM tokens"""
)
def token_summary(spark, sf_dir):
    summary = Q.token_summary(_tokens(spark, sf_dir), "n_tokens", 1024)
    rounded = ("mean", "std", "p50", "p75", "p90", "p95", "p99", "pct_truncated")
    return summary.withColumns({c: F.round(c, 6) for c in rounded})


@query(
    f"""WITH {_TOKENS} SELECT m AS max_length, round(count(*) FILTER (n <= m) / CAST(count(*) AS DOUBLE) * 100, 6) AS pct
        FROM tokens, (SELECT unnest([256, 512, 768, 1024, 2048, 4096, 8192]) AS m) GROUP BY m"""
)
def length_coverage(spark, sf_dir):
    return Q.length_coverage(_tokens(spark, sf_dir), "n_tokens").withColumn("pct", F.round("pct", 6))


# --- sentences and boilerplate --------------------------------------------------------------


@query(f"WITH {_SENTENCES} SELECT doc_id, pos, sentence, key FROM sentences")
def sentence_keys(spark, sf_dir):
    pairs = _segmented(spark, sf_dir).select(
        F.col("offer_id").alias("doc_id"), F.posexplode(F.arrays_zip("sentences", "keys"))
    )
    return pairs.select(
        "doc_id", "pos", F.col("col.sentences").alias("sentence"), F.col("col.keys").alias("key")
    ).filter(F.col("sentence") != "")


@query(f"WITH {_FREQUENCY} SELECT firm, n_offers FROM sizes")
def firm_sizes(spark, sf_dir):
    table = load_table(spark, f"{sf_dir}/documents.parquet")
    return B.firm_sizes(table.select(F.trim("source").alias("firm")))


@query(f"WITH {_FREQUENCY} SELECT firm, key, n_docs FROM frequency")
def key_doc_freq(spark, sf_dir):
    return B.key_document_frequency(_segmented(spark, sf_dir))


@query(
    f"""WITH {_FREQUENCY} SELECT * FROM (SELECT firm, key, n_docs,
          CAST(row_number() OVER (PARTITION BY firm ORDER BY n_docs DESC, key) AS INTEGER) AS rank FROM frequency)
        WHERE rank <= 200"""
)
def key_topn_per_firm(spark, sf_dir):
    return B.top_keys(B.key_document_frequency(_segmented(spark, sf_dir)), 200)


@query(f"WITH {_DROPS} SELECT firm, key FROM drops")
def boilerplate_keys(spark, sf_dir):
    return B.learn_boilerplate(_segmented(spark, sf_dir), sim_threshold=1.0)


_REMOVED = f"""WITH {_DROPS},
    kept AS (
      SELECT doc_id, string_agg(sentence, ' ' ORDER BY pos) AS text
      FROM sentences ANTI JOIN drops USING (firm, key) GROUP BY doc_id)
    SELECT doc_id AS offer_id, {_CLEAN} AS description_clean
    FROM (SELECT d.doc_id, k.text FROM documents d LEFT JOIN kept k USING (doc_id))"""


@query(_REMOVED)
def boilerplate_removed(spark, sf_dir):
    segmented = _segmented(spark, sf_dir)
    return B.remove_boilerplate(segmented, B.learn_boilerplate(segmented, sim_threshold=1.0))


@query(_REMOVED)
def boilerplate_removed_wide(spark, sf_dir):
    """As with a drop table too large to broadcast: keys are filtered, then shuffled."""
    segmented = _segmented(spark, sf_dir)
    return B.remove_boilerplate(segmented, B.learn_boilerplate(segmented, sim_threshold=1.0), limit=0)


@query(
    f"""WITH {_DROPS},
       marked AS (SELECT s.*, d.key IS NOT NULL AS removed FROM sentences s LEFT JOIN drops d USING (firm, key)),
       agg AS (
         SELECT doc_id, count(*) FILTER (NOT removed) AS n_kept, count(*) FILTER (removed) AS n_removed,
                string_agg(sentence, ' ' ORDER BY pos) AS raw,
                string_agg(sentence, ' ' ORDER BY pos) FILTER (NOT removed) AS text
         FROM marked GROUP BY doc_id)
       SELECT doc_id AS offer_id, CAST(coalesce(n_kept, 0) AS INTEGER) AS n_kept,
              CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed,
              CAST(length(coalesce(raw, '')) AS INTEGER) AS raw_len,
              CAST(length({_CLEAN}) AS INTEGER) AS out_len, length({_CLEAN}) < 150 AS is_short
       FROM documents d LEFT JOIN agg USING (doc_id)""".replace("documents d LEFT", "(SELECT doc_id FROM documents) d LEFT")
)
def boilerplate_explain(spark, sf_dir):
    segmented = _segmented(spark, sf_dir)
    return B.explain_removal(segmented, B.learn_boilerplate(segmented, sim_threshold=1.0))


@query(
    f"""WITH {_DROPS} SELECT doc_id AS offer_id, pos, sentence, s.key, d.key IS NOT NULL AS removed
        FROM sentences s LEFT JOIN drops d USING (firm, key)"""
)
def boilerplate_trace(spark, sf_dir):
    segmented = _segmented(spark, sf_dir)
    return B.removed_sentences(segmented, B.learn_boilerplate(segmented, sim_threshold=1.0))


@query(
    f"""WITH {_SENTENCES},
       drawn AS (
         SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY {_FIRM} ORDER BY md5('0|' || doc_id)) AS r
                             FROM documents) WHERE r <= 40),
       sizes AS (SELECT {_FIRM} AS firm, count(*) AS n FROM documents JOIN drawn USING (doc_id) GROUP BY 1)
       SELECT firm, key FROM sentences JOIN drawn USING (doc_id) JOIN sizes USING (firm) WHERE key <> ''
       GROUP BY firm, key, n HAVING count(DISTINCT doc_id) >= greatest(2, ceil(CAST(0.1 AS DOUBLE) * n))"""
)
def boilerplate_keys_capped(spark, sf_dir):
    return B.learn_boilerplate(_segmented(spark, sf_dir), sim_threshold=1.0, max_offers_per_firm=40)


# Keys in frequency order; a key leads a cluster unless an earlier leader is
# similar. Rounds settle keys whose earlier neighbours are all settled.
_CLUSTERS = f"""{_FREQUENCY},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY firm ORDER BY n_docs DESC, key) AS rank, length(key) AS size FROM frequency),
edges AS MATERIALIZED (
  SELECT a.firm, a.rank AS earlier, b.rank AS later FROM ranked a JOIN ranked b
  ON a.firm = b.firm AND a.rank < b.rank AND least(a.size, b.size) >= CAST(0.88 AS DOUBLE) * greatest(a.size, b.size) - 0.000001
  WHERE 1 - levenshtein(a.key, b.key) / CAST(greatest(a.size, b.size) AS DOUBLE) >= CAST(0.88 AS DOUBLE)),
rounds AS (
  SELECT 0 AS round, firm, rank, CASE WHEN rank IN (SELECT later FROM edges e WHERE e.firm = r.firm) THEN NULL ELSE 1 END AS leads
  FROM ranked r WHERE EXISTS (SELECT 1 FROM edges e WHERE e.firm = r.firm AND r.rank IN (e.earlier, e.later))
  UNION ALL
  SELECT s.round + 1, s.firm, s.rank,
         CASE WHEN s.leads IS NOT NULL THEN s.leads WHEN n.some = 1 THEN 0 WHEN n.open = 0 THEN 1 END
  FROM rounds s LEFT JOIN (
    SELECT e.firm, e.later, max(p.leads) AS some, count(*) FILTER (p.leads IS NULL) AS open
    FROM edges e JOIN rounds p ON p.firm = e.firm AND p.rank = e.earlier GROUP BY e.firm, e.later) n
  ON n.firm = s.firm AND n.later = s.rank
  WHERE (SELECT count(*) FROM rounds WHERE leads IS NULL) > 0),
followers AS (
  SELECT e.firm, e.later AS rank, min(e.earlier) AS leader FROM edges e
  JOIN (SELECT * FROM rounds WHERE round = (SELECT max(round) FROM rounds)) s
  ON s.firm = e.firm AND s.rank = e.earlier AND s.leads = 1
  JOIN (SELECT * FROM rounds WHERE round = (SELECT max(round) FROM rounds)) t
  ON t.firm = e.firm AND t.rank = e.later AND t.leads = 0 GROUP BY e.firm, e.later),
members AS (
  SELECT r.firm, r.key, coalesce(f.leader, r.rank) AS leader FROM ranked r LEFT JOIN followers f ON f.firm = r.firm AND f.rank = r.rank),
clusters AS (
  SELECT firm, leader, count(DISTINCT doc_id) AS df_offers, count(DISTINCT key) AS n_members
  FROM members JOIN sentences USING (firm, key) GROUP BY firm, leader)"""


@query(
    f"""WITH RECURSIVE {_CLUSTERS} SELECT firm, key FROM members JOIN clusters USING (firm, leader) JOIN sizes USING (firm)
        WHERE df_offers >= greatest(2, ceil(CAST(0.1 AS DOUBLE) * n_offers))"""
)
def boilerplate_clustered(spark, sf_dir):
    return B.learn_boilerplate(_segmented(spark, sf_dir))


@query(
    f"""WITH RECURSIVE {_CLUSTERS}
        SELECT c.firm, CAST(row_number() OVER (PARTITION BY c.firm ORDER BY leader) - 1 AS INTEGER) AS cluster_id, df_offers,
               round(df_offers / CAST(n_offers AS DOUBLE), 6) AS share, n_members, key AS rep
        FROM clusters c JOIN sizes USING (firm) JOIN ranked r ON r.firm = c.firm AND r.rank = c.leader"""
)
def boilerplate_report(spark, sf_dir):
    return B.boilerplate_report(_segmented(spark, sf_dir)).withColumn("share", F.round("share", 6))


@query(
    f"""WITH {_SENTENCES}
       SELECT lower(firm) AS firm, count(*) AS n_occurrences, count(DISTINCT key) AS n_keys,
              array_to_string(list_slice(list_sort(list(DISTINCT key)), 1, 5), ' | ') AS examples
       FROM sentences WHERE contains(lower(sentence), 'license') GROUP BY 1"""
)
def phrase_lookup(spark, sf_dir):
    found = B.phrase_lookup(_segmented(spark, sf_dir), "license")
    return found.withColumn("examples", F.array_join("examples", " | "))


# --- entities -----------------------------------------------------------------------------

_TERMS = {"licence": {"license": 0.9, "licensed": 0.6}, "lien": {"this": 0.5, "dans": 0.4, "with": 0.8}}
_WORDS = r"""words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS text FROM documents),
terms AS (SELECT * FROM (VALUES ('licence', 'license', 0.9), ('licence', 'licensed', 0.6),
  ('lien', 'this', 0.5), ('lien', 'dans', 0.4), ('lien', 'with', 0.8)) t(label, text, score)),
found AS (SELECT doc_id, label, text, CAST(score AS DOUBLE) AS score FROM words JOIN terms USING (text) WHERE score >= 0.5)"""


@query(f"WITH {_WORDS} SELECT doc_id, label, text, score FROM found")
def entities_found(spark, sf_dir):
    return term_entities(documents(spark, sf_dir), "doc_id", "text", _TERMS)


@query(
    f"""WITH {_WORDS},
       labelled AS (SELECT doc_id, label, '"' || label || '":["' || string_agg(text, '","' ORDER BY text) || '"]' AS part
                    FROM found GROUP BY doc_id, label)
       SELECT doc_id, '{{' || string_agg(part, ',' ORDER BY label) || '}}' AS entities FROM labelled GROUP BY doc_id"""
)
def entities_grouped(spark, sf_dir):
    return group_entities(term_entities(documents(spark, sf_dir), "doc_id", "text", _TERMS), "doc_id")


def make_word_finder():
    def find(text: str, labels: list[str]) -> list[dict]:
        words = re.findall(r"[^\W_]+", text.lower())
        return [
            {"label": label, "text": word, "score": score}
            for word in words
            for label in labels
            for term, score in _TERMS[label].items()
            if term == word
        ]

    return find


@query(f"WITH {_WORDS} SELECT doc_id, label, text, score FROM found")
def entities_by_model(spark, sf_dir):
    """The same entities from a caller's extractor."""
    table = documents(spark, sf_dir)
    return extract_entities(table, "doc_id", "text", make_word_finder, list(_TERMS), 0.5)


def _pieces(text: str) -> int:
    return len(re.findall(r"[^\W_]+", text)) + 2


@query(
    r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}]+')) + 2 AS INTEGER) AS n_tokens FROM documents"
)
def tokens_by_caller(spark, sf_dir):
    """Counts from a caller's tokenizer, with two special tokens."""
    count = X.token_counter(_pieces)
    return documents(spark, sf_dir).select("doc_id", count(F.col("text")).alias("n_tokens"))


@query("SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 10 OFFSET 70")
def row_range(spark, sf_dir):
    """Rows 70 to 79, for a look at the table."""
    table = load_table(spark, f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source")
    return table.orderBy("doc_id").offset(70).limit(10)


# --- sources --------------------------------------------------------------------------------


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_round_trip(spark, sf_dir):
    """Documents written as CSV and read back."""
    table = documents(spark, sf_dir)
    path = scratch_path(spark, "documents") + ".csv"
    save_table(table, path)
    return load_table(spark, path, table.schema)
