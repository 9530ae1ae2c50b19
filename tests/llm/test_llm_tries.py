"""Prefix tries, byte pairs and manifests against plain Python."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from offerscope.llm import byte_pairs, merkle, prefix_trie
from offerscope.llm import queries as Q

SF_DIR = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PAIRS = byte_pairs.BytePairs(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=PAIRS.ranks, special_tokens={})


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# --- byte pairs -----------------------------------------------------------------------


def ids_of(text):
    return np.frombuffer(PAIRS.encode([text])[0], "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(), st.text("ab \n'ste", max_size=400), st.text("é日0  ́", max_size=200)))
def test_ids_are_the_librarys_and_decode(text):
    assert ids_of(text) == LIBRARY.encode_ordinary(text)
    assert PAIRS.decode(PAIRS.encode([text])[0]) == text.encode()


@pytest.mark.parametrize("text", ["a" * 100_000 + "b", "ab" * 50_000, "".join(chr(97 + k * k % 23) for k in range(60_000)), " " * 30_000 + "x"])
def test_long_pre_tokens(text):
    assert ids_of(text) == LIBRARY.encode_ordinary(text)


def test_a_small_cache_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(byte_pairs, "CACHE_BYTES", 500)
    monkeypatch.setattr(byte_pairs, "RUN_CHARS", 40)
    pairs = byte_pairs.BytePairs(RANKS, public_tokenizers.PATTERN)
    texts = [f"word{k % 7} other{k} " * (k % 5) for k in range(200)] + ["x" * 90 + " word1", "", "x" * 90]
    assert pairs.encode(texts) == PAIRS.encode(texts)


def test_queue_gives_ranks_in_order():
    queue = byte_pairs.RankQueue(1 << 17)
    ranks = [70_000, 3, 255, 256, 131_071, 0]
    for rank in ranks:
        queue.fill(rank, [rank])
    found = []
    while (rank := queue.lowest()) is not None:
        found.append(rank)
        queue.clear(rank)
    assert found == sorted(ranks) and not any(queue.levels)


def test_byte_pairs_query_equals_the_library(spark):
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    rows = Q.QUERIES["op12_byte_pairs"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = LIBRARY.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == sha(np.array(ids, "<u4").tobytes())
        assert row["decoded_sha256"] == sha(texts[row["doc_id"]])


def test_byte_pairs_of_odd_rows(spark):
    rows = [(1, None, "x", 1), (None, "", "x", 1), (2, "<|endoftext|> a", "y", 1), (2, "<|endoftext|> a", "y", 1), (3, "ü" * 200_000, "", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string, `a.b` int")
    found = byte_pairs.digest(byte_pairs.encode_documents(frame, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    want = [(i, len(LIBRARY.encode_ordinary(t or "")), sha(t or "")) for i, t, _, _ in rows]
    assert sorted(map(str, [(r[0], r[1], r[3]) for r in found.collect()])) == sorted(map(str, want))
    empty = byte_pairs.encode_documents(frame.filter("1 = 0"), RANKS, public_tokenizers.PATTERN)
    assert byte_pairs.digest(empty, RANKS, public_tokenizers.PATTERN).collect() == []


# --- prefix trie ----------------------------------------------------------------------


def plain_trie(rows, regroup):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if regroup else 0
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members, kids = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(c)
    below = {}
    for path in sorted(members, key=len, reverse=True):
        if path:
            kids[path[:-1]].append(path)
        saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        below[path] = (sum(below[k][0] for k in kids[path]) or 1, saved + sum(below[k][1] for k in kids[path]))
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -9, len(m), len(kids[p]), *below[p],
         sha(",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))))
        for p, m in members.items()
    )


def trie_rows(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-9 if v is None else v for v in row) for row in frame.select(*names).collect())


CONVERSATIONS = "conv_id long, turn long, role string, text string, path string, part int, `a.b` int"


@pytest.mark.parametrize("rows_of_a_block, joined", [(1 << 16, 4), (3, 1), (1, 1)])
@pytest.mark.parametrize("regroup", [True, False])
def test_trie_equals_plain_python(spark, monkeypatch, rows_of_a_block, joined, regroup):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", rows_of_a_block)
    monkeypatch.setattr(prefix_trie, "JOINED", joined)
    random = np.random.default_rng(5)
    rows = [(int(c), int(t), "user" if t % 2 == 0 else None, "hot" if t < 3 and c % 3 else f"é{random.integers(3)}") for c in range(90) for t in range(random.integers(1, 12))]
    rows += [(100, t, "user", "") for t in range(300)] + [(103, t, "user", "") for t in range(299)]
    rows += [(None, 1, "user", "x"), (200, None, None, None), (200, 1, "a", "b"), (201, 1, "a", "b"), (201, 1, "a", "b"), (-4, 0, "a", "b")]
    frame = spark.createDataFrame([(*row, "p", 1, 2) for row in rows], CONVERSATIONS).repartition(5)
    if regroup:
        rows, frame = [r for r in rows if r[0] != -4], frame.filter("conv_id is null or conv_id >= 0")
    assert trie_rows(prefix_trie.prefix_trie(frame, regroup=regroup)) == plain_trie(rows, regroup)


def test_trie_of_no_conversations(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], CONVERSATIONS), regroup=True).collect() == []


def test_a_family_without_its_first_and_without_turns(spark):
    rows = [(c, t, "user", "x") for c in (2, 3, 4, 11) for t in range(9 if c == 4 else 1)]
    frame = spark.createDataFrame([(*row, "p", 1, 2) for row in rows], CONVERSATIONS)
    assert trie_rows(prefix_trie.prefix_trie(frame, regroup=True)) == plain_trie(rows, True)


@given(st.sets(st.lists(st.integers(0, 255), min_size=0, max_size=4).map(bytes), min_size=1, max_size=400))
@settings(max_examples=60, deadline=None)
def test_radix_tree_holds_its_keys_in_order(keys):
    ordered = sorted(keys)
    root = prefix_trie.Node(b"")
    for place in np.random.default_rng(1).permutation(len(ordered)):
        prefix_trie.insert(root, ordered[place], int(place))
    found = []

    def walk(node, key):
        if node.value is not None:
            found.append((key + node.path, node.value))
        for child in node.children():
            walk(child, key + node.path)

    walk(root, b"")
    assert found == [(key, place) for place, key in enumerate(ordered)]


def test_layouts_grow_with_their_children():
    root, kinds = prefix_trie.Node(b""), []
    for byte in range(256):
        prefix_trie.insert(root, bytes([byte, 1]), byte)
        kinds.append((type(root.layout).__name__, getattr(root.layout, "room", None)))
    assert [kinds[k] for k in (3, 4, 15, 16, 47, 48, 255)] == [
        ("Sorted", 4), ("Sorted", 16), ("Sorted", 16), ("Indexed", None), ("Indexed", None), ("Direct", None), ("Direct", None),
    ]


# --- manifest -------------------------------------------------------------------------


def plain_manifest(rows):
    def leaf(row, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))

    def levels(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            found.append([sha("".join(found[-1][at : at + 8])) for at in range(0, len(found[-1]), 8)])
        return found

    def fold(found, at, node):
        beside = []
        for level in found[:-1]:
            run = level[at // 8 * 8 : at // 8 * 8 + 8]
            beside += run[: at % 8] + run[at % 8 + 1 :]
            node, at = sha("".join([*run[: at % 8], node, *run[at % 8 + 1 :]])), at // 8
        return beside, node

    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    names = sorted(trees, key=lambda name: (name is not None, (name or "").encode()))
    built = {name: levels([entry[2] for entry in sorted(trees[name], key=lambda e: e[:3])]) for name in names}
    top = levels([built[name][-1][0] for name in names])
    out = []
    for name in names:
        for at, (_, _, digest, row) in enumerate(sorted(trees[name], key=lambda e: e[:3])):
            text = row[1]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            low, node = fold(built[name], at, leaf(row, text))
            high, node = fold(top, names.index(name), node)
            out.append((row[0], digest, built[name][-1][0], top[-1][0], sha("".join(low + high)), node, node == top[-1][0]))
    return sorted(map(str, out))


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, hash string, `a.b` int"


def manifest_rows(rows, spark):
    frame = spark.createDataFrame([(*row, "h", 1) for row in rows], DOCUMENTS).repartition(3)
    return sorted(str(tuple(row)) for row in merkle.digest(merkle.manifest(frame)).collect())


@pytest.mark.parametrize("levels", [4, 1])
def test_manifest_equals_plain_python(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK_BITS", 3 * levels)
    monkeypatch.setattr(merkle, "BLOCK", 1 << 3 * levels)
    rows = [(k, f"Text {k} É" if k % 7 else "", "en" if k % 3 else f"l{k % 10}", None if k % 4 else "s", k) for k in range(150)]
    rows += [(None, "A", "en", "s", 1), (None, "A", "en", "s", 1), (5, "A", "en", "s", 1), (6, None, None, None, None), (6, "Z" * 90_000, "", "é", None), (9, "B", "zz", "s", -1)]
    assert manifest_rows(rows, spark) == plain_manifest(rows)


@pytest.mark.parametrize("count", [1, 8, 9, 64, 65])
def test_manifest_of_one_tree(spark, monkeypatch, count):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK_BITS", 3)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [(k, "Aa", "en", "s", 2) for k in range(count)]
    assert manifest_rows(rows, spark) == plain_manifest(rows)


def test_manifest_of_no_rows(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_a_parent_resumes_where_its_child_was():
    children = [sha(str(k)).encode() for k in range(5)]
    parent = merkle.Parent(children)
    for slot in range(5):
        assert parent.fold(slot, children[slot]) == parent.digest
        assert parent.fold(slot, b"x") == sha(b"".join([*children[:slot], b"x", *children[slot + 1 :]])).encode()


def test_listed_letters_are_cut_by_the_plain_pattern():
    import random
    import sys

    import regex

    every = regex.compile(public_tokenizers.PATTERN).findall
    letters = [chr(code) for code in range(sys.maxunicode + 1) if not 0xD800 <= code < 0xE000]
    for c in letters[:10_000] + letters[::7]:
        text = f"a 1.{c}{c} {c}'s{c}"
        assert PAIRS.find(text) == every(text)
    draw = random.Random(1)
    for _ in range(5000):
        text = "".join(draw.choices("  \n\t\r\x0b\x1c\x85\xa0''stremvld.,!aZé1²½İ\u2003\u3000", k=draw.randrange(12)))
        assert PAIRS.find(text) == every(text)
    assert "listed" in PAIRS.find.__code__.co_freevars
