"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import io
import itertools
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from offerscope.llm import (
    chat,
    common,
    decontaminate,
    language,
    near_text,
    near_vectors,
    packing,
    quality,
    resharding,
    token_files,
    warc,
)
from offerscope.llm.tokens import Encoder
from offerscope.session import materialize, scratch_path

DOCS = "doc_id long, text string, row long, cls string, `a.b` int, uid int"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def docs(spark, texts):
    rows = [(None if k is None else k, text, 7, "x", 1, 2) for k, text in texts]
    return materialize(spark.createDataFrame(rows, DOCS), "docs")


ODD = [(1, None), (2, ""), (3, "   "), (4, "a"), (4, "a"), (None, "b c"), (5, "long " * 30_000)]


# --- helpers ------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [0, 1 << 24])
def test_components_equal_union_find(spark, limit):
    random = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 60, (45, 2))] + [(k, k + 1) for k in range(100, 140)] + [(200, 300 + k) for k in range(30)]
    part = {}

    def find(x):
        while part.setdefault(x, x) != x:
            x = part[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        part[max(a, b)] = min(a, b)
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    found = common.connected_components(spark.createDataFrame(edges, "u long, v long"), limit).collect()
    assert sorted(map(tuple, found)) == sorted((x, find(x)) for x in nodes)
    assert common.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_stars_are_components_without_a_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(common, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    edges = spark.createDataFrame([(7, 1), (1, 9), (9, 1), (5, 4), (3, 3)], "u long, v long")
    assert sorted(map(tuple, common.connected_components(edges).collect())) == [(1, 1), (4, 4), (5, 4), (7, 1), (9, 1)]
    assert written == ["edges"]


@pytest.mark.parametrize("path", [WORDS, BYTES])
@settings(deadline=None)
@given(texts=st.lists(st.text(st.one_of(st.sampled_from(" \n\t\r'.,!a\xa0\x1c\x85́éßΣİx1١<|>"), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_cut_texts_encode_like_whole_ones(path, texts):
    made = _ENCODERS.setdefault(path, Encoder(path))
    texts = [*texts, "it's 'tis <|endoftext|> Über naïve", *(t * 3 for t in texts)]
    assert made.encode(texts) == made.whole(texts)


_ENCODERS = {}


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_words_met_again_outlast_a_full_cache(path, monkeypatch):
    from offerscope.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_WORDS", 20)
    encoder, learned = Encoder(path), []
    runs = encoder._runs
    monkeypatch.setattr(encoder, "_runs", lambda words: learned.extend(words) or runs(words))
    letters = "abcdefghij"
    for k in range(30):
        texts = [" ".join(["x often", *(f"w{letters[k // 10]}{letters[k % 10]}{x}" for x in letters)])]
        assert encoder.encode(texts) == encoder.whole(texts)
        assert len(encoder.words) + len(encoder.old) <= 80
    assert sum("often" in word for word in learned) == 1


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_white_space_at_the_ends_of_spans(path):
    texts = ["a  b", "a\n b", "a \n b", " a", "a ", "a\n", "  ", " ", "\n", "\n \n", "a \t\r b.", "a.\n\nB. \n", "", None, "x", "\nFoo.", "é. à!!"]
    texts += ["a\xa0 b", "a \u2003 b", "\x0b c", "<|endoftext|> a  b", "it's 'll. we'll", "a" * 60 + ". " + "b" * 60]
    encoder = Encoder(path)
    for some in (texts, texts[::-1], *([text] for text in texts)):
        assert encoder.encode(some) == encoder.whole([text or "" for text in some])
    assert encoder.encode([]) == []


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_lines_of_words_and_marks_are_cut_in_columns(path, monkeypatch):
    encoder, slow = Encoder(path), []
    parts = encoder._parts
    monkeypatch.setattr(encoder, "_parts", lambda span: slow.append(span) or parts(span))
    texts = ["One two.\nThree, four***\nfive", "Éa.\nß\nDer?!", "a" * 60 + ".\nb," + " c" * 50 + "...", "'\ns don't", "x\n\ny", "a.\u2003b c"]
    for some in (texts, texts[::-1], texts[:3], *([text] for text in texts)):
        assert encoder.encode(some) == encoder.whole(some)
    assert {span.strip(" ") for span in slow} <= {"'\ns", "don't", "x\n\ny", "a. b"}


def test_the_cache_takes_few_bytes_a_word():
    encoder = Encoder(BYTES)
    encoder.encode([" ".join(f"w{a}{b}{c}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij")])
    assert 1000 <= len(encoder.words) <= 1002
    assert encoder.words.nbytes + encoder.ids.nbytes < 40 * len(encoder.words)
    encoder.encode(["a" * 60 + " b" + "c" * 60])
    assert max(map(len, encoder.words.to_pylist())) <= 48


@pytest.mark.parametrize("limit", [1, 10, 25, 1000])
def test_texts_are_cut_into_runs_by_bytes(limit, monkeypatch):
    from offerscope.llm import tokens

    monkeypatch.setattr(tokens, "BATCH_BYTES", limit)
    for texts in ([], [None], ["", None, "x" * 30, "yy", None, "é" * 9, "z" * 9, ""], ["x" * 10] * 7):
        batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
        for whole in (batch, pa.RecordBatch.from_pydict({"text": pa.array(["head", *texts])}).slice(1)):
            runs = [some.column("text").to_pylist() for some in tokens.slices(whole, "text")]
            assert [text for run in runs for text in run] == texts and all(runs)
            assert all(len(run) == 1 or sum(len((text or "").encode()) for text in run) <= limit for run in runs)


def test_words_with_odd_space_are_found_by_one_pattern():
    import sys

    from offerscope.llm.tokens import ODD_SPACE

    letters = map(chr, range(sys.maxunicode + 1))
    odd = [c for c in letters if (c.isspace() or c in "\u180e\u200b\u2060\ufeff") and c not in " \n\t\r"]
    assert ODD_SPACE.findall("".join(map(chr, range(sys.maxunicode + 1)))) == odd


# --- WARC ------------------------------------------------------------------------------


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_added_tokens_have_the_ids_that_the_library_gives(path):
    from tokenizers import Tokenizer

    texts = ["one<|endoftext|>two three", "<|startoftext|> a <|endoftext|>", "plain one", "<|EndOfText|> <|endoftext |>", "x <|endoftext|>", None]
    for plain in (False, True):
        library = Tokenizer.from_file(path)
        library.encode_special_tokens = plain
        right = [library.encode(text or "", add_special_tokens=False).ids for text in texts]
        found = Encoder(path, plain).encode(texts) if plain else Encoder(path).encode(texts)
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == right


def test_warc_revisits_and_splits(spark):
    big, other = "é" * 700, "z" * 2000
    pages = [(1, "http://a/ü", big), (2, None, big), (3, "u", big), (3, "u", big), (None, "n", big), (4, "v", None), (5, "v", "é"), (6, "v", "é"), (7, "w\r\nx", other)]
    table = materialize(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", common.F.lit(1)), "pages")
    archives = warc.write_warc(table, scratch_path(spark, "warc"), limit=0)
    seen = None
    for split in (1 << 30, 300, 41):
        rows = sorted(map(tuple, warc.read_warc(spark, archives, split).select("page_id", "record_type", "refers_to", "payload_bytes").collect()), key=str)
        assert seen in (None, rows)
        seen = rows
    assert sorted(seen, key=str) == sorted(
        [(1, "revisit", 3, 1400), (2, "revisit", 3, 1400), (3, "response", None, 1400), (3, "response", None, 1400), (None, "revisit", 3, 1400),
         (4, "response", None, 0), (5, "response", None, 2), (6, "response", None, 2), (7, "response", None, 2000)], key=str)
    assert warc.read_warc(spark, warc.write_warc(table.limit(0), scratch_path(spark, "warc"))).count() == 0


def test_warc_reader_is_not_fooled_by_magic_in_payloads():
    inner = warc.record(9, "u", b"x" * 50, None, None)
    random = np.random.default_rng(0)
    bodies = [random.bytes(400) + inner + random.bytes(300) + warc.MAGIC * 20 for _ in range(6)]
    data = b"".join(warc.record(k, "u", body, None, None) for k, body in enumerate(bodies))
    for step in (97, 500, 10**6):
        ids = []
        for start in range(0, len(data), step):
            ids += [warc.parse(x)["page_id"] for x in warc.Members(_File(data), start, min(start + step, len(data)))]
        assert ids == list(range(6))


@pytest.mark.parametrize("hit", range(4))
def test_warc_damage_is_listed_and_whole_records_are_read(hit):
    random = np.random.default_rng(1)
    inner = warc.record(9, "u", b"x" * 50, None, None)
    parts = [warc.record(k, "u", random.bytes(300) + inner + random.bytes(200), None, None) for k in range(4)]
    starts = np.cumsum([0] + [len(x) for x in parts]).tolist()
    for at in (0, 1, 12, 60, 250, len(parts[hit]) - 5):
        data = bytearray(b"".join(parts))
        for place in (starts[hit] + at, starts[hit] + at + 1):
            data[place] ^= 0xFF
        for step in (1, 53, 97, 200, 450, 1000, 10**6) if at == 0 else (53, 200, 10**6):
            found = []
            for start in range(0, len(data), step):
                found += warc.Members(_File(bytes(data)), start, min(start + step, len(data))).records()
            ids = [(place, None if x is None else warc.parse(x)["page_id"]) for place, x in found]
            own = [(place, page) for place, page in ids if page != 9]
            assert own == [(starts[k], None if k == hit else k) for k in range(4)], (at, step)
    with pytest.raises(ValueError, match=f"byte {starts[hit]}"):
        list(warc.Members(_File(bytes(data)), 0, len(data)))


def test_warc_cut_off_files(spark, tmp_path):
    parts = [warc.record(k, "u", bytes([65 + k]) * 400, None, None) for k in range(3)]
    data = b"".join(parts)
    cases = {"whole": data, "cut": data[:-9], "tail": data + b"junk", "head": b"junk" + data, "none": b"", "junk": b"junk"}
    for name, content in cases.items():
        (tmp_path / name).write_bytes(content)
    table = spark.createDataFrame([(str(tmp_path / n), len(c)) for n, c in cases.items()], "file string, bytes long")
    right = {
        "whole": [0, 1, 2], "cut": [0, 1, "damaged"], "tail": [0, 1, 2, "damaged"], "head": ["damaged", 0, 1, 2],
        "none": [], "junk": ["damaged"],
    }
    for split in (150, 1 << 20):
        rows = warc.read_warc(spark, table, split, damaged="list").orderBy("file", "place").collect()
        seen = {name: [r.page_id if r.record_type != "damaged" else "damaged" for r in rows if r.file.endswith("/" + name)] for name in cases}
        assert seen == right
    with pytest.raises(Exception, match="a damaged record at byte"):
        warc.read_warc(spark, table).count()
    with pytest.raises(ValueError):
        warc.read_warc(spark, table, damaged="skip")


class _File(io.BytesIO):
    def size(self):
        return len(self.getvalue())


# --- near duplicates ----------------------------------------------------------------------


def _family(random, count):
    base = [f"w{random.integers(0, 10**6)}" for _ in range(60)]
    out = []
    for _ in range(count):
        words = list(base)
        for k in random.integers(0, 60, random.integers(0, 6)):
            words[k] = f"v{random.integers(0, 10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("limit,meet", [(0, 1024), (1 << 24, 3)])
def test_near_texts_equal_brute_force(spark, monkeypatch, limit, meet):
    monkeypatch.setattr(near_text, "MEET", meet)
    random = np.random.default_rng(1)
    texts = [t for size in (2, 3, 60) for t in _family(random, size)]
    texts += ["A b", "a B", "a b c", texts[0].upper()]
    rows = [*ODD, *((10 + k, t) for k, t in enumerate(texts))]
    found = near_text.similar_documents(docs(spark, rows), size=2, limit=limit).collect()
    made = near_text.Shingles(2)
    sets = [(k, set(made.of(t).tolist())) for k, t in rows]
    part = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            low, high = sorted((part[a], part[b]))
            part = [low if p == high else p for p in part]
    ids = {p: min((k for (k, _), q in zip(sets, part) if q == p and k is not None), default=None) for p in set(part)}
    expected = sorted(((k, len(s), ids[p]) for (k, s), p in zip(sets, part)), key=str)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == expected


def test_hashes_of_words_tell_them_apart_and_keep_nothing():
    import tracemalloc

    made = near_text.Shingles(2)
    words = [c * n for c in ("a", "b", "\0", "é") for n in range(1, 70)] + [f"{'x' * n}{k}" for n in (0, 5, 8, 60, 70) for k in range(100)]
    hashed = made._words(" \t".join(words).encode())
    assert len(hashed) == len(set(words)) == len(set(hashed.tolist()))
    assert made._words(("\n " + "\x0b".join(words[::-1]) + "\r").encode()).tolist() == hashed[::-1].tolist()
    assert len(made._words(b" \n")) == len(made._words(b"")) == 0
    text = " ".join(f"w{k}" for k in range(100_000))
    tracemalloc.start()
    made.of(text)
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 100_000


def test_near_texts_of_an_empty_table(spark):
    assert near_text.similar_documents(docs(spark, [])).count() == 0


@pytest.mark.parametrize("block,limit", [(1024, 1 << 24), (8, 0)])
def test_near_vectors_equal_brute_force(spark, block, limit):
    random = np.random.default_rng(2)
    vectors = [v / 3 + random.normal(0, 0.05, 16) for v in random.normal(0, 1, (12, 16)) for _ in range(5)]
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, [2 * x for x in rows[0][1]]), (102, rows[0][1]), (103, None), (104, [0.0] * 16), (104, []),
             (105, [float("nan")] * 16), (106, [None] + [1.0] * 15), (107, [1e-200] * 16), (108, [1e200] * 16), (109, [1.0] * 4), (None, [5.0] * 4)]
    table = materialize(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cls", common.F.lit(1)), "vectors")
    found = near_vectors.similar_vectors(table, block=block, limit=limit, miss=1e-9).collect()

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v) / np.abs(v).max()
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v in rows]
    part, links = list(range(len(rows))), [0] * len(rows)
    for a, b in itertools.combinations(range(len(rows)), 2):
        if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.9:
            links[a], links[b] = links[a] + 1, links[b] + 1
            low, high = sorted((part[a], part[b]))
            part = [low if p == high else p for p in part]
    ids = {p: min((k for (k, _), q in zip(rows, part) if q == p and k is not None), default=None) for p in set(part)}
    expected = sorted(((k, n, ids[p]) for (k, _), n, p in zip(rows, links, part)), key=str)
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=str) == expected
    assert near_vectors.similar_vectors(table.limit(0)).count() == 0


# --- decontamination ------------------------------------------------------------------------


def test_a_large_benchmark_shuffles_numbers_and_each_text_once(spark, monkeypatch, capsys):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    near = sorted(map(str, decontaminate.contamination(read("documents"), read("benchmark")).collect()))
    plans, real = [], decontaminate.materialize

    def spy(df, name):
        capsys.readouterr()
        df.explain("formatted")
        plans.append(capsys.readouterr().out)
        return real(df, name)

    monkeypatch.setattr(decontaminate, "materialize", spy)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        far = decontaminate.contamination(read("documents"), read("benchmark"), limit=0)
        assert sorted(map(str, far.collect())) == near
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [columns for plan in plans for columns in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]", plan)]
    assert moved and not any("text_words" in columns for columns in moved)
    assert sum(bool(re.search(r"\btext#", columns)) for columns in moved) == 1


@pytest.mark.parametrize("limit", [0, 1 << 24])
def test_decontamination_of_special_rows(spark, limit):
    long_item = " ".join(f"w{k}" for k in range(14))
    items = [(1, long_item), (2, "Short-ITEM x"), (2, "lone"), (None, "ghost word here"), (3, None), (4, "..."), (5, long_item)]
    items = spark.createDataFrame(items, "item_id long, text string")
    texts = [*ODD, (20, "z " + long_item + " z"), (21, " ".join(f"w{k}" for k in range(9))), (22, "short item  X, LONE; ghost word here"), (22, "lone lone"), (23, "x short item")]
    rows = decontaminate.contamination(docs(spark, texts), items, limit=limit).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows), key=str)
    assert got == sorted(
        [(1, 0, 0, ()), (2, 0, 0, ()), (3, 0, 0, ()), (4, 1, 0, ()), (4, 1, 0, ()), (None, 2, 0, ()), (5, 30_000, 0, ()),
         (20, 16, 14, ("1", "5")), (21, 9, 0, ()), (22, 7, 7, ("2",)), (22, 2, 2, ("2",)), (23, 3, 0, ())], key=str)
    assert decontaminate.contamination(docs(spark, []), items).count() == 0
    assert {r["n_hit"] for r in decontaminate.contamination(docs(spark, texts), items.limit(0)).collect()} == {0}


# --- tokens ----------------------------------------------------------------------------------


def test_sum_of_squares_packs_within_bounds():
    lengths = np.sort(np.random.default_rng(5).integers(1, 101, 3000))[::-1]
    sequence, offset = packing.sum_of_squares(lengths, 100)
    fill = np.zeros(sequence.max() + 1, int)
    for n, s, o in zip(lengths, sequence, offset):
        assert o == fill[s]
        fill[s] += n
    best_fit = []  # room of the sequences that best fit in the same order makes
    for n in lengths.tolist():
        k = min((k for k, room in enumerate(best_fit) if room >= n), key=best_fit.__getitem__, default=None)
        if k is None:
            best_fit.append(100 - n)
        else:
            best_fit[k] -= n
    assert fill.max() <= 100 and len(fill) <= len(best_fit) * 1.005


def test_packed_sequences_hold_the_ids(spark):
    pieces, places = packing.pack_documents(docs(spark, ODD), WORDS, length=16, group_pieces=500)
    made = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(pieces, places).collect()}
    rows = pieces.join(places, "uid").collect()
    assert sum(map(len, made.values())) == sum(len(r["ids"]) for r in rows)
    for r in rows:
        assert made[r["sequence_id"]][4 * r["offset"] :].startswith(bytes(r["ids"]))
    assert max(map(len, made.values())) <= 64
    assert packing.digest(*packing.pack_documents(docs(spark, []), WORDS)).count() == 0


def test_token_files_read_only_what_is_asked(spark):
    table = docs(spark, [*ODD, *((10 + k, f"text {k} " * k) for k in range(50))])
    written = token_files.write_token_files(table, scratch_path(spark, "ids"), BYTES)
    rows = token_files.read_token_files(spark, written).collect()
    assert len(rows) == table.count()
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == sorted((r["doc_id"] for r in rows), key=lambda k: (k is not None, k or 0))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(ordered, ordered[1:]))
    some = token_files.read_token_files(spark, written, [12, 40]).collect()
    assert sorted(map(tuple, some)) == sorted(tuple(r) for r in rows if r["doc_id"] in (12, 40))
    empty = token_files.write_token_files(docs(spark, []), scratch_path(spark, "ids"), BYTES)
    assert token_files.read_token_files(spark, empty).count() == 0


@settings(deadline=None)
@given(st.lists(st.lists(st.integers(0, 65_535), max_size=20), max_size=8), st.sampled_from([2, 4]))
def test_token_file_round_trip(documents, width):
    out = _Sink()
    writer = token_files.FileWriter(out, width, frame_ids=7)
    for k, ids in enumerate(documents):
        writer.add(None if k == 0 else k, np.array(ids, "<u4").tobytes())
    assert writer.close() == sum(map(len, documents))
    reader = token_files.FileReader(_File(out.data))
    assert [np.frombuffer(reader.ids(start, n), "<u4").tolist() for _, start, n in reader.documents] == documents
    assert [d[0] for d in reader.documents] == [None if k == 0 else k for k in range(len(documents))]


class _Sink:
    data = b""

    def write(self, data):
        self.data += data

    def close(self):
        pass


# --- resharding -------------------------------------------------------------------------------


def test_flow_moves_the_fewest_bytes():
    random = np.random.default_rng(4)
    for _ in range(20):
        supply = random.integers(0, 50, 5).tolist()
        capacity = [sum(supply) // 7 + (k < sum(supply) % 7) for k in range(7)]
        flow = resharding.min_cost_flow(supply, capacity, lambda i, j: int(i != j))
        assert [sum(row.values()) for row in flow] == supply
        assert all(sum(row.get(j, 0) for row in flow) <= capacity[j] for j in range(7))
        moved = sum(n for i, row in enumerate(flow) for j, n in row.items() if i != j)
        assert moved == sum(max(0, s - capacity[i]) for i, s in enumerate(supply))


def test_flow_with_other_costs():
    flow = resharding.min_cost_flow([4, 4], [4, 4], lambda i, j: [[1, 2], [1, 5]][i][j])
    assert flow == [{1: 4}, {0: 4}]


def test_resharding_of_special_rows(spark):
    table = docs(spark, ODD).withColumn("shard", common.F.lit("kept")).withColumn("old_shard", common.F.lit(3))
    folder = scratch_path(spark, "old")
    layout = resharding.lay_out(table, common.F.pmod("doc_id", common.F.lit(2)), "text", folder)
    out = resharding.reshard(spark, layout, 4, scratch_path(spark, "new"))
    rows = out.collect()
    assert sorted(((r["doc_id"], r["text"], r["shard"]) for r in rows), key=str) == sorted(((k, t, "kept") for k, t in ODD), key=str)
    shard, slot = out.columns[-2:]
    for k in range(4):
        own = sorted(r[slot] for r in rows if r[shard] == k)
        assert own == list(range(len(own)))
    folder = scratch_path(spark, "old")
    layout = resharding.lay_out(table.limit(0), common.F.lit(0), "text", folder)
    assert resharding.reshard(spark, layout, 4, scratch_path(spark, "new")).count() == 0


def test_resharding_moves_what_the_flow_must_and_rewrites_no_other_file(spark):
    random = np.random.default_rng(11)
    texts = [(k, "x" * int(n)) for k, n in enumerate(random.integers(1, 60, 1200))]
    table = spark.createDataFrame(texts, "doc_id long, text string").repartition(6, "doc_id")
    old = common.F.when(common.F.col("doc_id") % 10 < 6, 0).when(common.F.col("doc_id") % 10 < 9, 1).otherwise(2)
    layout = resharding.lay_out(table, old, "text", scratch_path(spark, "old"))
    held = spark.read.parquet(layout.folder).withColumn("file", common.F.col("_metadata.file_path")).toPandas()
    new_folder = scratch_path(spark, "new")
    out = resharding.reshard(spark, layout, 5, new_folder)
    rows = out.toPandas().merge(held[["doc_id", "file", layout.old, layout.size]], on="doc_id", suffixes=("", "_"))
    assert len(rows) == 1200 and rows.doc_id.is_unique
    total = rows[layout.size].sum()
    capacity = [total // 5 + (j < total % 5) for j in range(5)]
    least = sum(max(0, n - capacity[i]) for i, n in rows.groupby(layout.old)[layout.size].sum().items())
    gone = rows[rows["shard"] != rows[layout.old]]
    sizes = rows.groupby("shard")[layout.size].sum()
    assert sizes.max() - sizes.min() <= 61
    assert abs(gone[layout.size].sum() - least) <= 8 * 61
    touched, read = set(gone.file), out.inputFiles()
    path = lambda uri: uri.removeprefix("file:").replace("///", "/")
    assert {path(f) for f in read if path(new_folder) not in path(f)} == {path(f) for f in set(rows.file) - touched}
    rewritten = spark.read.parquet(new_folder).toPandas()
    assert set(rewritten.doc_id) == set(rows.doc_id[rows.file.isin(touched)])


# --- classifiers --------------------------------------------------------------------------------


def test_quality_of_special_rows(spark):
    texts = docs(spark, [*ODD, *((10 + k, ("good words stand here " if k % 2 else "### !!! ") * 8) for k in range(60))])
    labels = spark.createDataFrame([(10 + k, k % 2) for k in range(60)] + [(10, None), (None, 1)], "doc_id long, quality int")
    model = quality.train(texts, labels, "doc_id", "text", "quality", ["a.b"])
    score = quality.score(model, common.F.col("text"), [common.F.lit(None).cast("double")])
    rows = texts.select("doc_id", score.alias("score")).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 2 == 1) for r in rows if (r["doc_id"] or 0) >= 10)
    assert quality.train(texts, labels.limit(0), "doc_id", "text", "quality", ["a.b"]) is None
    none = texts.select(quality.score(None, common.F.col("text"), []).alias("score")).distinct().collect()
    assert [r["score"] for r in none] == [0.5]
    assert texts.limit(0).select(score).count() == 0


def test_quality_learns_from_a_bounded_draw_when_ids_repeat(spark):
    texts = docs(spark, [(10 + k % 8, f"{'good words' if k % 2 else '### !!!'} {k}") for k in range(400)] + [(17, "good words again")] * 300)
    labels = spark.createDataFrame([(10 + k, k % 2) for k in range(8)], "doc_id long, quality int")
    models = [quality.train(table, labels, "doc_id", "text", "quality", [], rows=30, limit=limit)
              for table, limit in ((texts, 1 << 24), (texts.repartition(7), 1 << 24), (texts.repartition(3), 0))]
    for model in models[1:]:
        assert (model.weights == models[0].weights).all() and (model.factors == models[0].factors).all()
    table = spark.createDataFrame([(k % 500, k % 2) for k in range(3000)], "a long, label int")
    some = quality.drawn(table, 100).collect()
    assert 90 <= len(some) <= 100 and len(set(some)) == len(some)
    assert sorted(quality.drawn(table.repartition(5), 100).collect()) == sorted(some)
    assert len(quality.drawn(table, 10**6).collect()) == 500


def test_factorisation_machine_equals_all_pairs():
    random = np.random.default_rng(8)
    edges = np.sort(random.normal(size=(2, quality.BINS - 1)))
    size = quality.BUCKETS + 2 * (quality.BINS + 1)
    model = quality.Model(edges, 0.3, random.normal(size=size).astype("f4") / 9, random.normal(size=(size, quality.RANK)).astype("f4") / 9)
    buckets, values = np.array([3, 50, 900]), np.array([0.1, np.nan])
    at = np.concatenate([buckets, model.places(values)])
    x = np.array([3**-0.5] * 3 + [1, 1])
    z = 0.3 + model.weights[at] @ x
    z += sum(model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j] for i, j in itertools.combinations(range(5), 2))
    assert abs(model.score(buckets, values) - 1 / (1 + np.exp(-z))) < 1e-5


def test_language_of_special_rows(spark):
    texts = docs(spark, [*ODD, (30, "12 345 !!"), *((40 + k, ("the cat and the dog " if k % 2 else "der hund und die katze ") * 15) for k in range(40))])
    texts = texts.withColumn("lang", common.F.when(common.F.col("doc_id") >= 40, common.F.when(common.F.col("doc_id") % 2 == 1, "en").otherwise("de")))
    known = language.learn(texts, "doc_id", "text", "lang")
    assert sorted(known.names) == ["de", "en"]
    found = texts.select("doc_id", "lang", language.identify(known, common.F.col("text")).alias("f")).select("doc_id", "lang", "f.*").collect()
    for r in found:
        if r["doc_id"] in (1, 2, 3, 30):
            assert (r["lang_pred"], r["score"], r["accepted"]) == ("und", 0.0, False)
        if r["lang"]:
            assert r["lang_pred"] == r["lang"] and r["accepted"]
    nothing = language.learn(texts.limit(0), "doc_id", "text", "lang")
    assert nothing.identify("some text") == ("und", 0.0, False)


def test_languages_of_short_and_of_long_texts_are_learned(spark):
    """Beside a language with ordinary texts one with short posts only and one with books
    only, which begin with a long table of numbers."""
    random = np.random.default_rng(5)
    words = {lang: ["".join(random.choice(list(letters), 6)) for _ in range(2000)] for lang, letters in (("en", "abcdefgh"), ("xs", "abcdefij"), ("xl", "abcdefkl"))}

    def text(lang, n):
        return " ".join(random.choice(words[lang], n))

    rows = [(k, text("en", 120), "en") for k in range(300)]
    rows += [(1000 + k, text("xs", 12), "xs") for k in range(4000)]
    rows += [(6000 + k, "0 1 2 3 4 " * 600 + text("xl", 6000), "xl") for k in range(12)]
    rows += [(7000 + k, "12 34", "no") for k in range(3)]
    known = language.learn(materialize(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "docs"), "doc_id", "text", "lang")
    assert known.names == ["xs", "en", "xl"]
    assert all(language.DICTIONARY_BYTES - 4_000 <= len(content) <= language.DICTIONARY_BYTES for content in known.contents)
    for lang in words:
        for n in (30, 1000):
            found, _, accepted = known.identify(text(lang, n))
            assert (found, accepted) == (lang, True)


# --- chat -----------------------------------------------------------------------------------------

_ROLE = st.sampled_from(["user", "assistant", "system", "tool", "", "[/ROLE]"])
_TEXT = st.lists(st.sampled_from(["<", "s>", "</s>", "<s>", "[INST]", "[/INST]", "\\", "<<SYS>>", "<</SYS>>", "[", "/", "[/TURN]", "[ROLE]", " ", "\n", "é", "SYS>>"]), max_size=8).map("".join)


@settings(deadline=None)
@given(st.lists(st.tuples(_ROLE, _TEXT), max_size=6))
def test_turns_come_back(turns):
    formatted, spans = chat.format_turns(turns)
    assert chat.parse_turns(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in zip(spans[::2], spans[1::2])] == [t for r, t in turns if r == "assistant"]


@pytest.mark.parametrize("limit", [0, 1 << 24])
def test_branches_of_trees(spark, limit):
    nodes = [
        ("t", "1", None, "user", "q", 0.0), ("t", "2", "1", "assistant", "bad", 1.0), ("t", "3", "1", "assistant", "good", 2.0), ("t", "3", "1", "assistant", "good", 2.0),
        ("t", "4", "2", "user", "thanks", 5.0), ("t", "5", "3", "user", "hm", 4.0), ("u", "9", "missing", "user", None, None), ("u", None, None, "user", "loose", 0.5),
        ("c", "1", "2", "user", "x", 0.0), ("c", "2", "1", "user", "y", 0.0), (None, "1", None, None, "z", 0.0), *(("d", str(k), str(k - 1) if k else None, "user", str(k), 0.0) for k in range(20)),
    ]
    table = materialize(spark.createDataFrame(nodes, "tree string, node string, parent string, role string, text string, score double").withColumn("leaf", common.F.lit(1)), "trees")
    rows = chat.conversations(table, keep=2, limit=limit).collect()
    got = {(r["tree"], r["rank"]): (r["score"], [t for _, t in chat.parse_turns(r["formatted"])]) for r in rows}
    assert got == {
        ("t", 1): (6.0, ["q", "bad", "thanks"]), ("t", 2): (6.0, ["q", "good", "hm"]), ("u", 1): (0.5, ["loose"]), ("u", 2): (0.0, [""]),
        (None, 1): (0.0, ["z"]), ("d", 1): (0.0, [str(k) for k in range(20)]),
    }
    assert chat.digest(chat.conversations(table.limit(0))).count() == 0
