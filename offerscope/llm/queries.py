"""The registered queries of the operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerscope.llm import (
    byte_pairs,
    chat,
    decontaminate,
    language,
    merkle,
    near_text,
    near_vectors,
    packing,
    prefix_trie,
    quality,
    resharding,
    token_files,
    warc,
)
from offerscope.session import materialize, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
win AS (
  SELECT item_id, list_slice(ws, s, s + 9) AS words
  FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS s FROM i WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT len(words) AS k FROM win),
occ AS (
  SELECT doc_id, s, k, list_slice(ws, s, s + k - 1) AS words
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM d, sizes WHERE len(ws) >= k)),
hit AS (SELECT occ.doc_id, s, k, item_id FROM occ JOIN win ON occ.words = win.words),
places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)"""
)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.digest(*packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary))


@query()
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    folder = scratch_path(spark, "ids")
    written = token_files.write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary)
    return token_files.digest(token_files.read_token_files(spark, written))


@query(
    r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(ws, i, i + 1) AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT u, v FROM shared JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
  WHERE 100 * shared.k >= 80 * (x.k + y.k - shared.k)),
reach(node, seen) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT link.v, seen FROM reach JOIN link ON link.u = reach.node)
SELECT d.doc_id, coalesce(n.k, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node) r USING (doc_id)"""
)
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return near_text.digest(near_text.similar_documents(documents, size=2))


@query(
    """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ok AS (
  SELECT vec_id, x, sqrt(list_sum(list_transform(x, lambda c: c * c))) AS len FROM e
  WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(x, lambda c: c <> 0)) > 0),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / (a.len * b.len) >= 0.9),
reach(node, seen) AS (
  SELECT vec_id, vec_id FROM e UNION SELECT link.v, seen FROM reach JOIN link ON link.u = reach.node),
n AS (SELECT u, count(*) AS k FROM link GROUP BY u)
SELECT e.vec_id, coalesce(n.k, 0) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM e LEFT JOIN n ON n.u = e.vec_id
JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) r ON r.node = e.vec_id"""
)
def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.digest(near_vectors.similar_vectors(table(spark, sf_dir, "embeddings")))


@query(
    """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS size FROM pages),
g AS (SELECT body, max(page_id) AS original FROM p WHERE size >= 1000 GROUP BY body)
SELECT p.page_id, size AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN g.original <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.original <> p.page_id THEN g.original END AS refers_to
FROM p LEFT JOIN g ON p.size >= 1000 AND g.body = p.body"""
)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_warc(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.digest(warc.read_warc(spark, archives))


OLD_SHARDS, NEW_SHARDS = 12, 16


@query()
def op4_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old layout has a shard per hash of the source, which makes one far too large."""
    folder, new_folder = scratch_path(spark, "old-shards"), scratch_path(spark, "new-shards")
    old = F.pmod(F.crc32(F.coalesce("source", F.lit(""))), F.lit(OLD_SHARDS))
    layout = resharding.lay_out(table(spark, sf_dir, "documents"), old, "text", folder)
    return resharding.digest(resharding.reshard(spark, layout, NEW_SHARDS, new_folder), layout.size)


@query(
    r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
f AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|</?SYS>>|/?INST\]|/?ROLE\]|/TURN\])', '\1\\\2\3', 'g')) AS chars,
         CASE role WHEN 'assistant' THEN 4 WHEN 'user' THEN 13 WHEN 'system' THEN 15
              ELSE 13 + 7 + length(role) END AS marks FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(chars + marks) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id"""
)
def op10_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row replies to the one before it in its conversation."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order))
    nodes = rows.select(
        F.col("conv_id").alias("tree"), "node", (F.col("node") - 1).alias("parent"), "role", "text",
        F.length("text").cast("double").alias("score"),
    )
    return chat.digest(materialize(chat.conversations(nodes), "conversations"))


#: A document is kept if its score is at least this.
QUALITY = 0.3


@query()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.train(documents, table(spark, sf_dir, "labels"), "doc_id", "text", "quality", ["n_chars"])
    scored = documents.select(
        "doc_id",
        F.coalesce(quality.remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        quality.score(model, F.col("text"), [F.col("n_chars")]).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= QUALITY).cast("int"))


@query()
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    known = language.learn(documents, "doc_id", "text", "lang")
    return documents.select(
        "doc_id",
        F.coalesce(quality.remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        language.identify(known, F.col("text")).alias("found"),
    ).select("doc_id", "held_out", "found.*")


def _crc32(number: str) -> str:
    """CRC-32 of a number's decimal text, in SQL."""
    bits = "list_reduce(list_prepend(xor(c, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    letters = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda l: CAST(ord(l) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {letters}), lambda c, b: {bits}), 4294967295)"


@query(
    f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, octet_length(encode(coalesce(text, ''))) AS size,
         sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, id) AS n FROM said),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS family, {_crc32('conv_id')} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS own, n, id, size FROM c JOIN t ON t.conv_id = family AND n <= h
  UNION ALL SELECT c.conv_id, 1, n, id, size FROM c JOIN t ON t.conv_id = c.conv_id AND n > h),
s AS (
  SELECT c.conv_id, coalesce(any_value(ids), []) AS ids, coalesce(any_value(sizes), []) AS sizes FROM c
  LEFT JOIN (SELECT conv_id, list(id ORDER BY own, n) AS ids, list(size ORDER BY own, n) AS sizes FROM r GROUP BY conv_id) USING (conv_id)
  GROUP BY c.conv_id),
m AS (SELECT conv_id, ids, sizes, unnest(range(0, len(ids) + 1)) AS depth FROM s),
node AS (
  SELECT list_slice(ids, 1, depth) AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(any_value(sizes[depth]), 0) AS size,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(ids) = depth) AS ends
  FROM m GROUP BY ALL),
kids AS (SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
below AS (
  SELECT list_slice(path, 1, up) AS path, sum(leaf) AS leaves, sum((n_convs - 1) * size) AS saved
  FROM (SELECT node.path, depth, n_convs, size, CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(0, depth + 1)) AS up
        FROM node LEFT JOIN kids ON kids.path = node.path) GROUP BY ALL)
SELECT node.conv_id, node.depth, above.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(node.ends, '')) AS ends_sha256
FROM node JOIN below ON below.path = node.path LEFT JOIN kids ON kids.path = node.path
LEFT JOIN node above ON node.depth > 0 AND above.depth = node.depth - 1 AND above.path = list_slice(node.path, 1, node.depth - 1)"""
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), regroup=True).drop("turn_id")


@query()
def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_pairs.encode_documents(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)
    return byte_pairs.digest(coded, vocabulary, public_tokenizers.PATTERN)


def _part(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row_no, doc_id, lang, {_leaf('text')} AS leaf,
         CASE WHEN text IS NOT NULL AND {_crc32('doc_id')} % 3 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf('text')} END AS other
  FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM d),
up(lang, level, place, n, h) AS (
  SELECT lang, 0, place, n, leaf FROM l
  UNION ALL SELECT lang, level + 1, place // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY place)) FROM up
  WHERE n > 1 GROUP BY lang, level, place // 8, n),
s AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM up WHERE n = 1),
top(level, place, n, h) AS (
  SELECT 0, place, n, h FROM s
  UNION ALL SELECT level + 1, place // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY place)) FROM top
  WHERE n > 1 GROUP BY level, place // 8, n),
f(row_no, lang, level, place, h, proof) AS (
  SELECT row_no, lang, 0, place, other, '' FROM l
  UNION ALL
  SELECT f.row_no, f.lang, f.level + 1, f.place // 8,
         sha256(string_agg(CASE WHEN up.place = f.place THEN f.h ELSE up.h END, '' ORDER BY up.place)),
         f.proof || coalesce(string_agg(up.h, '' ORDER BY up.place) FILTER (up.place <> f.place), '')
  FROM f JOIN up ON up.lang IS NOT DISTINCT FROM f.lang AND up.level = f.level AND up.place // 8 = f.place // 8 AND up.n > 1
  GROUP BY f.row_no, f.lang, f.level, f.place, f.h, f.proof),
g(row_no, level, place, h, proof) AS (
  SELECT e.row_no, 0, s.place, e.h, e.proof
  FROM (SELECT row_no, lang, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM f GROUP BY row_no, lang) e
  JOIN s ON s.lang IS NOT DISTINCT FROM e.lang
  UNION ALL
  SELECT g.row_no, g.level + 1, g.place // 8,
         sha256(string_agg(CASE WHEN top.place = g.place THEN g.h ELSE top.h END, '' ORDER BY top.place)),
         g.proof || coalesce(string_agg(top.h, '' ORDER BY top.place) FILTER (top.place <> g.place), '')
  FROM g JOIN top ON top.level = g.level AND top.place // 8 = g.place // 8 AND top.n > 1
  GROUP BY g.row_no, g.level, g.place, g.h, g.proof),
e AS (SELECT row_no, arg_max(h, level) AS folded_root, sha256(arg_max(proof, level)) AS proof_sha256 FROM g GROUP BY row_no)
SELECT doc_id, leaf, s.h AS subroot, top.h AS root, proof_sha256, folded_root, folded_root = top.h AS verified
FROM d JOIN e USING (row_no) JOIN s ON s.lang IS NOT DISTINCT FROM d.lang JOIN top ON top.n = 1"""
)
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(merkle.manifest(table(spark, sf_dir, "documents")))
