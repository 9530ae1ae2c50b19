"""Byte-level BPE: encoding with a hierarchical-bitmap rank queue, and decoding.

A pre-token (a match of the pattern) that is a token itself gets that id. Any other is
a linked list of bytes in which the adjacent pair whose joined bytes have the lowest
rank is merged, the leftmost of equal ones first, until no pair has a rank. The queue
has a bucket of list positions per rank and a tree of bit words above the buckets:
the lowest set bit of each word, from the top down, leads to the lowest rank that
waits. A merge only adds the two new pairs beside it; what its neighbours had in the
queue before goes stale and is skipped when met, since a position never has the same
rank twice (its pair only grows). A pre-token of n bytes costs n log n at most,
whatever is repeated in it. Many pre-tokens share one list and queue.

Results for special input: a null or empty text has no ids and decodes to no bytes;
texts of any length and pre-tokens of any length are encoded whole; repeated rows and
null ids of documents are rows like others; an empty table gives no rows; columns
other than the id and the text are not used, whatever their names. Control strings
are plain text. An id that the vocabulary does not have raises when decoded.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerscope.llm import files
from offerscope.llm.common import plain
from offerscope.llm.tokens import KEEPS_SPACE

#: Bytes that a worker's cache of pre-tokens may take, half of them for those met since
#: the last change; what an entry takes beside its letters and ids; the longest kept.
CACHE_BYTES = 160 * 1024 * 1024
ENTRY_BYTES = 160
CACHE_CHARS = 64
#: Letters of texts whose new pre-tokens are merged together; a longer text is alone.
RUN_CHARS = 1 << 22
#: Positions at one rank from which they are merged together, ranks in a row with fewer
#: that end this, and the longest pre-token for it.
TOGETHER, FEW, TOGETHER_BYTES = 40, 20, 256

#: Bits of a word of the bitmap, as a power of two.
WORD_BITS = 8


#: Letters below this are listed in the plain pattern, class by class.
LISTED = 0x2070


def _listed(kind: str) -> str:
    """The listed letters of a class of the ``regex`` module, as ranges."""
    known = {code for code in range(LISTED) if regex.match(kind, chr(code))}
    starts = sorted(code for code in known if code - 1 not in known)
    ends = sorted(code for code in known if code + 1 not in known)
    return "".join(f"\\u{start:04x}-\\u{end:04x}" for start, end in zip(starts, ends))


def finder(pattern: str) -> Callable[[str], list[str]]:
    """The matches of a pattern in a text. Those of the byte-level pattern come from ``re``,
    which is faster, where all letters of the text are listed."""
    every = regex.compile(pattern).findall
    if pattern != KEEPS_SPACE:
        return every
    letter, number, space = (_listed(kind) for kind in (r"\p{L}", r"\p{N}", r"\s"))
    # a contraction begins with a mark and the first two runs do not, so these may be tried first
    listed = re.compile(
        f" ?[{letter}]+| ?[{number}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    ).findall
    other = re.compile(f"[{chr(LISTED)}-\U0010ffff]").search
    return lambda text: every(text) if other(text) else listed(text)


class RankQueue:
    """Positions by rank: a heap per rank, and bit words that say which ranks have one."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        height = 1
        while ranks > 1 << (WORD_BITS * height):
            height += 1
        #: From the lowest level, which has a bit per rank, up to a single word.
        self.levels: list[dict[int, int]] = [{} for _ in range(height)]

    def fill(self, rank: int, positions: list[int]) -> None:
        """A rank's first positions, ascending."""
        self.buckets[rank] = positions
        for level in self.levels:
            bit, rank = 1 << (rank & ((1 << WORD_BITS) - 1)), rank >> WORD_BITS
            word = level.get(rank, 0)
            level[rank] = word | bit
            if word:
                return

    def lowest(self) -> int | None:
        """The lowest rank that has positions."""
        rank = 0
        for level in reversed(self.levels):
            word = level.get(rank, 0)
            if not word:
                return None
            rank = rank << WORD_BITS | (word & -word).bit_length() - 1
        return rank

    def clear(self, rank: int) -> None:
        """Forgets a rank whose positions are used up."""
        del self.buckets[rank]
        for level in self.levels:
            bit, rank = 1 << (rank & ((1 << WORD_BITS) - 1)), rank >> WORD_BITS
            word = level[rank] & ~bit
            if word:
                level[rank] = word
                return
            del level[rank]


def _wait(queue: RankQueue, positions: np.ndarray, pair: np.ndarray) -> None:
    """Puts positions into the buckets of their pairs' ranks."""
    order = np.argsort(pair[positions], kind="stable")
    positions = positions[order]
    ranks = pair[positions]
    cuts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(ranks)]
    firsts, positions = ranks[cuts[:-1]].tolist() if len(ranks) else [], positions.tolist()
    for rank, start, end in zip(firsts, cuts, cuts[1:]):
        bucket = queue.buckets.get(rank)
        if bucket is None:
            queue.fill(rank, positions[start:end])
        else:
            bucket += positions[start:end]


class BytePairs:
    """The vocabulary of a rank file (a token in base64 and its rank per line)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            lines = (line.split() for line in file if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.size = max(self.ranks.values(), default=-1) + 1
        tokens = {rank: token for token, rank in self.ranks.items()}
        #: All tokens' bytes in a row, and each one's start and length (0: no token).
        self.letters = np.frombuffer(b"".join(tokens.get(rank, b"") for rank in range(self.size)), np.uint8)
        self.lengths = np.array([len(tokens.get(rank, b"")) for rank in range(self.size)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.first = np.full(1 << 16, -1, np.int32)  # ranks of two bytes
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.first[token[0] << 8 | token[1]] = rank
        self.bytes = np.array([self.ranks.get(bytes([byte]), -1) for byte in range(256)], np.int64)
        splits = (
            (self.ranks[token[:cut]] * self.size + self.ranks[token[cut:]], rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        )
        table = np.array(sorted(splits), np.int64).reshape(-1, 2)
        #: Pairs of tokens that are joined to one, in order, and its rank.
        self.pairs, self.joined = np.append(table[:, 0], np.iinfo(np.int64).max), np.append(table[:, 1], -1)
        self.find = finder(pattern)
        self.cache, self.older, self.held = {}, {}, 0

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pre-tokens, little-endian. All lie in one list, and no pair reaches
        from one to the next, so the order of merges within each is its own.

        While many positions wait at the lowest rank, the first of each pre-token are
        merged together; after that one position at a time is.
        """
        data = b"".join(pieces)
        lengths = [len(piece) for piece in pieces]
        ends = np.cumsum(lengths, dtype=np.int64)
        size = len(data)
        codes = np.frombuffer(data, np.uint8).astype(np.int64)
        pair = np.full(size, -1, np.int64)
        if size:
            pair[:-1] = self.first[codes[:-1] << 8 | codes[1:]]
        pair[ends - 1] = -1
        edge = np.zeros(size + 1, bool)  # where a pre-token starts, and the end
        edge[0] = True
        edge[ends] = True
        after, before = np.arange(1, size + 1), np.arange(-1, size)
        queue = RankQueue(self.size)
        _wait(queue, np.flatnonzero(pair >= 0), pair)
        token, held = self.bytes[codes], np.ones(size, bool)  # places that still start a token
        if max(lengths, default=0) <= TOGETHER_BYTES:
            owner = np.repeat(np.arange(len(pieces)), lengths)
            self._merge_together(queue, token, held, pair, after, before, edge, owner)
        if queue.lowest() is not None:
            rest = [pair.tolist(), after.tolist(), before.tolist(), edge.tobytes()]
            changed = self._merge_singly(queue, data, held, *rest)
            token[list(changed)] = list(changed.values())
        ids, counts = token[held].astype("<u4").tobytes(), np.cumsum(held)
        cuts = [0, *(4 * counts[ends - 1]).tolist()]
        return [ids[start:end] for start, end in zip(cuts, cuts[1:])]

    def _rank_of(self, keys: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens, -1 where they do not join."""
        place = np.searchsorted(self.pairs, keys)
        return np.where(self.pairs[place] == keys, self.joined[place], -1)

    def _merge_together(self, queue, token, held, pair, after, before, edge, owner) -> None:
        few = 0
        while few < FEW and (rank := queue.lowest()) is not None:
            bucket = queue.buckets[rank]
            few = 0 if len(bucket) >= TOGETHER else few + 1
            waiting = np.sort(np.array(bucket, np.int64))
            waiting = waiting[pair[waiting] == rank]  # the others are stale
            lead = np.ones(len(waiting), bool)
            lead[1:] = owner[waiting[1:]] != owner[waiting[:-1]]
            if lead.all():
                queue.clear(rank)
            else:
                queue.buckets[rank] = waiting[~lead].tolist()
            at = waiting[lead]
            gone = after[at]
            right = after[gone]
            after[at] = right
            token[at], held[gone] = rank, False
            pair[at] = pair[gone] = -1
            inner = ~edge[right]
            begin, right = at[inner], right[inner]
            before[right] = begin
            pair[begin] = self._rank_of(rank * self.size + token[right])
            left = before[at[~edge[at]]]
            pair[left] = self._rank_of(token[left] * self.size + rank)
            changed = np.concatenate([begin, left])
            _wait(queue, changed[pair[changed] >= 0], pair)
        for bucket in queue.buckets.values():
            bucket.sort()

    def _merge_singly(self, queue, data, held, pair, after, before, edge) -> dict[int, int]:
        """The tokens that changed, by place."""
        changed = {}
        rank_of, bucket_of, fill = self.ranks.get, queue.buckets.get, queue.fill
        while (rank := queue.lowest()) is not None:
            bucket, least = bucket_of(rank), rank
            while bucket and least == rank:
                at = heappop(bucket)
                if pair[at] != rank:
                    continue  # stale
                gone = after[at]
                right = after[at] = after[gone]
                changed[at], held[gone] = rank, False
                pair[at] = pair[gone] = -1
                if not edge[right]:
                    before[right] = at
                    now = rank_of(data[at : after[right]])
                    if now is not None:
                        pair[at] = now
                        if (there := bucket_of(now)) is None:
                            fill(now, [at])
                        else:
                            heappush(there, at)
                        if now < least:
                            least = now
                if not edge[at]:
                    left = before[at]
                    now = rank_of(data[left:right])
                    if now is None:
                        pair[left] = -1
                    else:
                        pair[left] = now
                        if (there := bucket_of(now)) is None:
                            fill(now, [left])
                        else:
                            heappush(there, left)
                        if now < least:
                            least = now
            if not bucket:
                queue.clear(rank)
        return changed

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are not in the cache; short ones are added to it."""
        older, ranks = self.older.get, self.ranks.get
        found, rest, pieces, long = {}, [], [], []
        for word in words:
            ids = older(word)
            if ids is None:
                piece = word.encode("utf-8")
                rank = ranks(piece)
                if rank is None:
                    if len(piece) > TOGETHER_BYTES:
                        long.append(word)
                    else:
                        rest.append(word)
                        pieces.append(piece)
                    continue
                ids = rank.to_bytes(4, "little")
            found[word] = ids
        if rest:
            found.update(zip(rest, self.merge(pieces)))
        if long:
            found.update(zip(long, self.merge([word.encode("utf-8") for word in long])))
        kept = {word: ids for word, ids in found.items() if len(word) <= CACHE_CHARS}
        self.cache.update(kept)
        self.held += ENTRY_BYTES * len(kept) + sum(map(len, kept)) + sum(map(len, kept.values()))
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out, at = [], 0
        while at < len(texts):
            if self.held > CACHE_BYTES // 2:  # what was not met since the last time goes
                self.cache, self.older, self.held = {}, self.cache, 0
            found, fresh, chars = [], set(), 0
            while at < len(texts) and (not found or chars + len(texts[at] or "") <= RUN_CHARS):
                words = self.find(texts[at] or "")
                fresh |= set(words).difference(self.cache)
                found.append(words)
                chars += len(texts[at] or "")
                at += 1
            new = self._learn(list(fresh))
            if all(len(word) <= CACHE_CHARS for word in new):
                out += [b"".join(map(self.cache.__getitem__, words)) for words in found]
            else:
                out += [b"".join([new.get(word) or self.cache[word] for word in words]) for words in found]
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        known = np.frombuffer(ids, "<u4").astype(np.int64)
        if known.size and (known.max() >= self.size or not self.lengths[known].all()):
            raise ValueError("an id that the vocabulary does not have")
        lengths = self.lengths[known]
        ends = np.cumsum(lengths)
        places = np.repeat(self.starts[known] - ends + lengths, lengths)
        places += np.arange(len(places))
        return self.letters[places].tobytes()


def byte_pairs(path: str, pattern: str) -> BytePairs:
    """One vocabulary per worker process."""
    held, key = files.worker_state("byte pairs"), ("byte pairs", path, pattern)
    if key not in held:
        held[key] = BytePairs(path, pattern)
    return held[key]


def encoded(text: Column, vocabulary: str, pattern: str) -> Column:
    """The ids of a text column as binary: little-endian unsigned 32-bit integers."""

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(byte_pairs(vocabulary, pattern).encode(texts.tolist()), dtype=object)

    return encode(text)


def decoded(ids: Column, vocabulary: str, pattern: str) -> Column:
    """The bytes of a column of ids, as ``encoded`` gives it."""

    @F.pandas_udf("binary")
    def decode(values: pd.Series) -> pd.Series:
        return values.map(byte_pairs(vocabulary, pattern).decode).astype(object)

    return decode(ids)


def encode_documents(
    documents: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids`` per row, where the text lies: nothing is shuffled."""
    text = F.coalesce(plain(text_col), F.lit(""))
    return documents.select(plain(id_col).alias("doc_id"), encoded(text, vocabulary, pattern).alias("ids"))


def digest(coded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """The columns of the registered query: of the ids, and of what they decode to."""
    return coded.select("doc_id", "ids", decoded(F.col("ids"), vocabulary, pattern).alias("bytes")).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
