"""Token ids of whole texts with a tokenizer file, fast on large corpora.

Texts are split at spaces by Arrow, the tokenizers library encodes every distinct word once per
worker, and ids are put together, column by column, from a bounded cache. That is exact where the file's own rules cut the
text at the same places: ``_cuts`` recognises the two pre-tokenizers for which it
holds; texts of any other file are encoded whole, and so are texts that hold an added token
such as ``<|endoftext|>``. That gets its own id, as the library has it, unless the caller
wants control strings in a text to be plain text.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from offerscope.llm.files import worker_state

#: Words in a worker's cache before it begins a new one and keeps only that one beside it,
#: and the longest word kept.
CACHE_WORDS = 200_000
CACHE_WORD_CHARS = 48
#: Bytes of texts that are encoded together.
BATCH_BYTES = 4 << 20

#: The pre-token patterns after which texts are cut at white space.
KEEPS_SPACE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DROPS_SPACE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_alphabet() -> dict[int, str]:
    """The letters that byte-level vocabularies have for bytes: printable Latin-1 is
    itself, the others follow from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    other = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(other)}


#: White space other than the four plain kinds, and signs without width.
ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")


def _cuts(spec: dict) -> tuple[Callable[[str], list[str]], bool] | None:
    """How texts may be cut into words, and whether words with odd space are excepted.

    With the byte-level pattern, which lets a word own the space before it, no match
    reaches over a place where white space begins, so each word takes the space
    before it along. Where the pattern drops white space, words between plain space
    are independent: neither its normal forms nor lower case look across a space.
    """
    pre = spec.get("pre_tokenizer") or {}
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec.get("normalizer"):
        return re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+").findall, True
    steps = pre.get("pretokenizers") or []
    forms = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    if (
        len(steps) == 2
        and steps[0].get("pattern") == {"Regex": DROPS_SPACE}
        and steps[0].get("invert")
        and steps[0].get("behavior") == "Removed"
        and steps[1].get("type") == "ByteLevel"
        and not steps[1].get("use_regex")
        and set(forms) <= {"NFC", "Replace", "Lowercase"}
    ):
        return re.compile(r"[^ \n\t\r]+").findall, False
    return None


#: A run of Latin-1 letters, with the space it owns, and these letters.
PLAIN = r"^ ?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+$"
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _flags(column: pa.BooleanArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The rows in runs whose texts take about ``BATCH_BYTES``; a longer one is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().cumsum(dtype=np.int64)
    at, done = 0, 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, done + BATCH_BYTES, "right")))
        yield batch.slice(at, end - at)
        at, done = end, int(sizes[end - 1])


class Encoder:
    """Encodes texts to the little-endian unsigned 32-bit bytes of their ids.

    The cache is two columns, words and their ids: some 30 bytes a word.
    """

    def __init__(self, path: str, plain_controls: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_controls
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = [t for t in spec.get("added_tokens") or [] if not (plain_controls and t.get("special"))]
        self.added = re.compile("|".join(re.escape(t["content"]) for t in added)) if added else None
        # a normalized one is found in texts that do not hold it as it stands
        known = any(t.get("normalized") for t in added)
        self.cut = None if known or spec.get("truncation") or spec.get("post_processor") else _cuts(spec)
        self.keeps = self.cut is not None and self.cut[1]
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())
        self.old, self.old_ids = self.words, self.ids
        self.alphabet = byte_alphabet() | {10: "\n"}  # line ends stand between words

    def whole(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 256):
            found = self.tokenizer.encode_batch_fast(texts[at : at + 256], add_special_tokens=False)
            out += [array("I", x.ids).tobytes() for x in found]
        return out

    def _runs(self, words: list[str]) -> list[bytes]:
        """Ids of ``PLAIN`` words. Each is one pre-token, so the file's model gets it without
        the steps before; lower case and normal forms are simple in Latin-1."""
        if not words:
            return []
        joined = "\n".join(words)
        if not self.keeps:
            joined = joined.lower()
        tokenize = self.tokenizer.model.tokenize
        shown = joined.encode().decode("latin-1").translate(self.alphabet).split("\n")
        return [array("I", [x.id for x in tokenize(word)]).tobytes() for word in shown]

    def _parts(self, span: str) -> list[str]:
        """The words of a span, as they are cached. One of letters and then ASCII marks is
        put together from both parts: the patterns end a run of letters before marks, and no
        mark before white space begins a contraction."""
        cut, keeps = self.cut
        parts = []
        for word in cut(span):
            if keeps and word[0] == "\n" and word[1:2].isalpha():  # a line end is a pre-token of its own
                parts.append("\n")
                word = word[1:]
            core = word.rstrip(punctuation)
            if len(core) < len(word) and core.lstrip(" \n\t\r").isalpha():
                parts += core, word[len(core) :]
            else:
                parts.append(word)
        return parts

    def _add(self, words: pa.Array, ids: pa.Array) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.ids = pa.concat_arrays([self.ids, ids])

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where the cache has words, -1 for others."""
        places = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(places < 0)
        if len(missing) and len(self.old):
            old = pc.index_in(words.take(pa.array(missing)), value_set=self.old)
            known = _flags(old.is_valid())
            old = old.drop_null()
            places[missing[known]] = len(self.words) + np.arange(len(old))
            self._add(self.old.take(old), self.old_ids.take(old))
        return places

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Brings distinct words into the cache; returns their places there."""
        places = self._places(words)
        missing = np.flatnonzero(places < 0)
        fresh = words.take(pa.array(missing))
        plain = _flags(pc.match_substring_regex(fresh, PLAIN))
        for some, find in ((plain, self._runs), (~plain, self.whole)):
            places[missing[some]] = len(self.words) + np.arange(some.sum())
            chosen = fresh.filter(pa.array(some))
            self._add(chosen, pa.array(find(_strings(chosen)), pa.large_binary()))
        return places

    def _words(self, spans: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The words of all spans in one column, how many each span has, and whether it holds
        odd space; then it has none.

        A span whose lines are letters and then ASCII marks is cut here, as ``_parts`` would:
        no line is empty, so a line end is a pre-token of its own.
        """
        lists = pc.split_pattern(spans, "\n")
        lines, first = lists.values, lists.offsets.to_numpy()[:-1]
        core = pc.utf8_rtrim(lines, punctuation)
        plain = _flags(pc.match_substring_regex(core, PLAIN))
        fit = np.logical_and.reduceat(plain, first)
        inside = np.repeat(fit, np.diff(lists.offsets.to_numpy()))
        lines, core = lines.filter(pa.array(inside)), core.filter(pa.array(inside))
        size, n = pc.list_value_length(lists).to_numpy()[fit], len(lines)
        marks = pc.utf8_ltrim(lines, " " + LETTERS)
        has = np.ones((n, 3), bool)  # letters, marks, the line end
        has[:, 1] = pc.binary_length(marks).to_numpy() > 0
        has[:, 2] = self.keeps
        has[size.cumsum() - 1, 2] = False
        which = np.column_stack([np.arange(n), n + np.arange(n), np.full(n, 2 * n)])[has]
        count, odd = np.zeros(len(spans), np.int64), np.zeros(len(spans), bool)
        if n:
            count[fit] = np.add.reduceat(has.sum(1), size.cumsum() - size)
        rest = np.flatnonzero(~fit)
        others: list[str] = []
        for k, span in zip(rest.tolist(), _strings(spans.take(pa.array(rest)))):
            if self.keeps and ODD_SPACE.search(span):
                odd[k] = True
            else:
                words = self._parts(span)
                count[k] = len(words)
                others += words
        # words of the spans cut here stand before the others; bring them in the spans' order
        words = pa.concat_arrays([core, marks, pa.array(["\n", *others], pa.string())])
        which = np.concatenate([which, 2 * n + 1 + np.arange(len(others))])
        order = np.argsort(np.concatenate([np.repeat(np.flatnonzero(fit), count[fit]), np.repeat(rest, count[rest])]), kind="stable")
        return words.take(pa.array(which[order])), count, odd

    def _spans(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct spans of texts, the spans of all texts by number, where each text's begin
        and end, and whether its words reach over their ends.

        Texts are split at plain spaces; where words keep the space before them, a span
        begins with it unless it is a text's first. If one ends in white space, the next one's
        space belongs to the same run.
        """
        lists = pc.split_pattern(pa.array(texts, pa.string()), " ")
        coded, bounds = lists.values.dictionary_encode(), lists.offsets.to_numpy()
        spans, at = coded.dictionary, coded.indices.to_numpy()
        if not self.keeps:
            return spans, at, bounds, np.zeros(len(texts), bool)
        at, first = at.copy(), bounds[:-1]
        heads = spans.take(pa.array(at[first])).dictionary_encode()
        at[first] = len(spans) + heads.indices.to_numpy()
        spans = pa.concat_arrays([pc.binary_join_element_wise(" ", spans, ""), heads.dictionary])
        used = np.bincount(at, minlength=len(spans)) > 0  # some are only ever a text's first
        spans, at = spans.filter(pa.array(used)), (used.cumsum() - 1)[at]
        spaced = np.zeros(len(spans), bool)
        for white in " \n\t\r":
            spaced |= _flags(pc.ends_with(spans, white))
        over = spaced[at]
        over[bounds[1:] - 1] = False  # nothing follows
        return spans, at, bounds, np.logical_or.reduceat(over, first)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; none for a null or empty one."""
        texts = [text or "" for text in texts]
        if self.cut is None or not texts:
            return self.whole(texts)
        if len(self.words) > CACHE_WORDS:  # words that are not met again until the next time go
            self.old, self.old_ids = self.words, self.ids
            self.words, self.ids = self.words[:0], self.ids[:0]
        whole = np.array([bool(self.added and self.added.search(text)) for text in texts])
        spans, at, bounds, over = self._spans(["" if mark else text for text, mark in zip(texts, whole)])
        places, known = self._places(spans), len(self.words)
        new = np.flatnonzero(places < 0)
        fresh = spans.take(pa.array(new))
        words, count, odd = self._words(fresh)
        if odd.any():
            whole |= np.logical_or.reduceat(np.isin(at, new[odd]), bounds[:-1])
        by_word = np.flatnonzero(over & ~whole).tolist()
        lists = [self._parts(texts[k]) for k in by_word]
        coded = pa.concat_arrays([words, pa.array([w for some in lists for w in some], pa.string())]).dictionary_encode()
        learned = self._learn(coded.dictionary)[coded.indices.to_numpy()]
        found = self.ids.take(pa.array(learned))
        ends = np.cumsum([0, *count, *map(len, lists)])
        _, starts, data = found.buffers()  # the ids of all words lie one after the other
        cuts = np.frombuffer(starts, np.int64)[ends] if len(found) else np.zeros(len(ends), np.int64)
        made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), data])
        places[new] = len(self.ids) + np.arange(len(new))
        taken = pa.concat_arrays([self.ids, made]).take(pa.array(places[at]))
        _, starts, data = taken.buffers()
        ends, joined = np.frombuffer(starts, np.int64)[bounds].tolist(), memoryview(data or b"")
        out = [joined[a:b].tobytes() for a, b in zip(ends, ends[1:])]
        for k, ids in zip(by_word, made[len(new) :].to_pylist()):
            out[k] = ids
        for k in np.flatnonzero(whole).tolist():
            out[k] = self.whole([texts[k]])[0]
        two = pa.array(np.flatnonzero((count == 2) & ~_flags(pc.match_substring(fresh, "\n"))))
        self._add(fresh.take(two), made.take(two))
        short = pc.less_equal(pc.utf8_length(self.words[known:]), CACHE_WORD_CHARS)
        if not pc.all(short).as_py():
            words, ids = self.words[known:].filter(short), self.ids[known:].filter(short)
            self.words, self.ids = self.words[:known], self.ids[:known]
            self._add(words, ids)
        return out


def encoder(path: str, plain_controls: bool = False) -> Encoder:
    """One encoder per worker process, file and option."""
    held, key = worker_state("tokens"), ("encoder", path, plain_controls)
    if key not in held:
        held[key] = Encoder(path, plain_controls)
    return held[key]
