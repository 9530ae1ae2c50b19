"""The registered queries against SQL, brute force, round trips and held-out labels."""

import itertools
import json
import re
import zlib
from collections import Counter

import compare
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from offerscope.llm import decontaminate, language, near_text, quality
from offerscope.llm import queries as Q
from offerscope.session import materialize

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_equals_sql(spark, tables, name):
    assert compare.differences(Q.QUERIES[name](spark, SF_DIR), tables, Q.ORACLES[name]) == []


def _texts(spark, folder=SF_DIR):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return {row[0]: row[1] or "" for row in rows}


def _ids(texts, name, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return {k: [*tokenizer.encode(text, add_special_tokens=False).ids, end] for k, text in texts.items()}


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_holds_every_id_once_in_few_sequences(spark):
    ids = _ids(_texts(spark), "word_bpe_49k.json", 0)
    rows = Q.QUERIES["op3_packing"](spark, SF_DIR).collect()
    for row in rows:
        part = ids[row["doc_id"]][row["start"] : row["start"] + row["length"]]
        assert len(part) == row["length"] and _crc(part) == row["ids_crc32"]
        assert row["start"] == 2048 * row["piece"]
    assert sum(row["length"] for row in rows) == sum(map(len, ids.values()))
    places = {}
    for row in rows:
        places.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.02 * sum(map(len, ids.values())) / 2048 + 1


def test_resharding_is_even_and_keeps_every_row(spark):
    texts = _texts(spark)
    rows = Q.QUERIES["op4_resharding"](spark, SF_DIR).collect()
    assert Counter(row["doc_id"] for row in rows) == Counter(list(texts))
    for row in rows:
        data = texts[row["doc_id"]].encode()
        assert (row["size"], row["text_crc32"], row["law"]) == (len(data) + 1, zlib.crc32(data), "bytes")
    sizes = Counter()
    for row in rows:
        sizes[row["shard"]] += row["size"]
    assert sorted(sizes) == list(range(16))
    assert max(sizes.values()) - min(sizes.values()) <= 0.1 * sum(sizes.values()) / 16
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


def test_token_files_hold_every_id_in_order(spark):
    ids = _ids(_texts(spark), "byte_bpe_50k.json", 2)
    start = 0
    for row in Q.QUERIES["op8_token_files"](spark, SF_DIR).orderBy("doc_id").collect():
        own = ids.pop(row["doc_id"])
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(own), _crc(own))
        start += len(own)
    assert not ids


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = Q.QUERIES["op6_quality"](spark, folder)
    assert rows.count() == 1000
    rows = rows.join(labels, "doc_id").filter("held_out").collect()
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    good, bad = ([r["score"] for r in rows if r["quality"] == k] for k in (1, 0))
    assert np.mean([[a > b for b in bad] for a in good]) > 0.95
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93


def test_language_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = Q.QUERIES["op9_language"](spark, folder).join(truth, "doc_id").filter("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert np.mean([r["accepted"] for r in rows]) > 0.97


def test_pipeline_stages_filter_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, SF_DIR), name)
        if number < 4:
            assert docs.columns == columns
            assert 0 < docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before
    assert json.dumps(docs.columns)


def test_near_duplicate_stage_keeps_one_row_of_repeated_ones(spark):
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame(
        [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, "en", "s", 1), (3, "", "en", "s", 0), (4, None, "en", "s", 0), (None, "a b", "en", "s", 0)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs = materialize(docs, "docs")
    kept = corpus_pipeline.one_of_each_group(spark, docs, SF_DIR)
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3, 4]


def _held_out_text(spark, folder, lang, size):
    """Texts of one language that no dictionary was learned from, joined to ``size`` bytes."""
    rows = spark.read.parquet(f"{folder}/documents.parquet").filter(f"lang = '{lang}' and crc32(string(doc_id)) % 3 = 1")
    joined = " ".join(row["text"] or "" for row in rows.orderBy("doc_id").collect())
    while len(joined) < size:
        joined += " " + joined
    return joined[:size]


def test_every_part_of_a_long_text_counts_for_its_language(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = language.learn(docs, "doc_id", "text", "lang")
    own = {lang: _held_out_text(spark, folder, lang, 3_000_000) for lang in known.names}
    for lang, text in own.items():
        for size in (800_000, 3_000_000):
            found, _, accepted = known.identify(text[:size])
            assert (found, accepted) == (lang, True), (lang, size)
    assert known.identify(own["en"][:250_000] + " " + own["de"][:750_000])[0] == "de"


def test_near_duplicate_stage_groups_by_component_and_not_by_id(spark):
    """Unlike or empty texts under one id all stay; of copies without an id one does."""
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(9)) for x in "abcd")
    rows = [(1, a), (1, b), (2, ""), (2, None), (None, c), (None, c), (None, c), (None, d), (5, d), (4, d)]
    docs = materialize(spark.createDataFrame([(k, x, "en", "s", 1) for k, x in rows], "doc_id long, text string, lang string, source string, n_chars long"), "docs")
    kept = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, docs, SF_DIR).collect())
    assert kept == Counter([(1, a), (1, b), (2, ""), (2, None), (None, c), (4, d)])


def _resplit_after(spark, monkeypatch, module, name, before=False):
    """Reads are split otherwise from the (first) call of a function on."""
    original = getattr(module, name)

    def call(*args, **named):
        if before:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        found = original(*args, **named)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        return found

    monkeypatch.setattr(module, name, call)


@pytest.fixture
def many_files(spark):
    """A table of 24 files in one partition, and its texts; reads are put back in the end."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(24)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1g")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    spark.conf.set("spark.sql.files.maxPartitionNum", "1")
    yield materialize(docs, "many")
    for key in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum", "maxPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{key}")


def test_near_duplicates_when_reads_are_split_otherwise_in_between(spark, tables, many_files, monkeypatch):
    assert many_files.rdd.getNumPartitions() == 1
    spark.conf.unset("spark.sql.files.maxPartitionNum")
    _resplit_after(spark, monkeypatch, near_text, "_sets", before=True)
    found = near_text.digest(near_text.similar_documents(many_files, size=2))
    assert compare.differences(found, tables, Q.ORACLES["op2_near_duplicates"]) == []


@pytest.mark.parametrize(
    ("stage", "module", "name"),
    [("one_of_each_group", near_text, "similar_documents"), ("without_benchmarks", decontaminate, "contamination")],
)
def test_pipeline_stages_when_reads_are_split_otherwise_in_between(spark, many_files, monkeypatch, stage, module, name):
    run = getattr(corpus_pipeline, stage)
    right = sorted(r["doc_id"] for r in run(spark, many_files, SF_DIR).collect())
    assert 0 < len(right) < many_files.count()
    spark.conf.unset("spark.sql.files.maxPartitionNum")
    _resplit_after(spark, monkeypatch, module, name)
    assert sorted(r["doc_id"] for r in run(spark, many_files, SF_DIR).collect()) == right


def _kept_quality(spark, docs, texts):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model, made = quality.train(docs, labels, "doc_id", "text", "quality", ["n_chars"]), quality.features()
    kept = []
    for row in docs.select("doc_id", "text", "n_chars").collect():
        buckets, statistics = made.of(row["text"])
        if model.score(buckets, np.array([*statistics, row["n_chars"]], dtype=np.float64)) >= corpus_pipeline.QUALITY:
            kept.append(row["doc_id"])
    return kept


def _kept_language(spark, docs, texts):
    known = language.learn(docs, "doc_id", "text", "lang")
    return [k for k, text in texts.items() if known.identify(text)[2]]


def _kept_near_duplicates(spark, docs, texts):
    sets, part = {}, {k: k for k in texts}
    for k, text in texts.items():
        words = text.encode().lower().split()
        size = min(5, len(words))
        sets[k] = {tuple(words[at : at + size]) for at in range(len(words) - size + 1)} if words else set()
    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            old, new = max(part[a], part[b]), min(part[a], part[b])
            part = {k: new if x == old else x for k, x in part.items()}
    return [k for k, x in part.items() if k == x]


def _kept_decontamination(spark, docs, texts):
    def words(text):
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower) if w]

    windows = set()
    for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("text").collect():
        item = words(row["text"])
        windows |= {tuple(item[at : at + 10]) for at in range(max(1, len(item) - 9)) if item}

    def hit(text):
        own = words(text)
        return any(tuple(own[at : at + n]) in windows for n in {len(w) for w in windows} for at in range(len(own) - n + 1))

    return [k for k, text in texts.items() if not hit(text)]


@pytest.mark.parametrize(
    ("stage", "right"),
    [("quality", _kept_quality), ("language", _kept_language), ("near_duplicates", _kept_near_duplicates), ("decontamination", _kept_decontamination)],
)
def test_pipeline_stage_keeps_the_rows_of_brute_force(spark, stage, right):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF_DIR).select("doc_id").collect()
    expected = sorted(right(spark, docs, _texts(spark)))
    assert sorted(r[0] for r in kept) == expected and 0 < len(expected) < docs.count()


def test_pipeline_packs_all_ids_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = dict(corpus_pipeline.STAGES)["packing"](spark, docs, SF_DIR).collect()
    ids = _ids(_texts(spark), "word_bpe_49k.json", 0)
    right = [(k, at, _crc(own[at : at + 2048])) for k, own in ids.items() for at in range(0, len(own), 2048)]
    assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in rows) == sorted(right)
