"""Quality classifier: a factorisation machine over hashed words, structure statistics
and metadata.

Features are binary: a word's bucket, a statistic's bin between quantiles of the
training rows, a metadata value's bin. A score is the logistic of bias, weights and
pairwise interactions of low rank, in linear time: the sum over pairs is half of the
square of the sum minus the sum of the squares. Words count with one over the square
root of their number, so that long texts do not outweigh the rest.

Results for special input: a null text is scored like an empty one; a null metadata
value has a bin of its own; training rows without a label are left out; of several
labels for one id the largest counts; without rows of both labels the score is 0.5
everywhere; repeated rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerscope.llm.common import BROADCAST_BYTES, measured_join, plain
from offerscope.llm.files import worker_state
from offerscope.session import materialize

#: Bound of the labelled rows that the model is fitted on, drawn by the hash of their id.
TRAIN_ROWS = 6_000
#: Bits of a hash that the draw of training rows counts by.
PREFIX_BITS = 16
BUCKETS, RANK, BINS = 1 << 16, 6, 10
EPOCHS, BATCH, RATE, DECAY = 6, 128, 0.02, 1e-5
CACHE_WORDS = 400_000
STATISTICS = (
    "bytes", "words", "lines", "mean word", "upper", "digits", "space", "stops", "symbols", "non-ascii",
    "distinct words", "commonest word", "same word next", "distinct lines", "commonest line", "longest word",
)


def _byte_classes() -> np.ndarray:
    """0 lower case, 1 upper case, 2 digit, 3 white space, 4 sentence marks, 5 other ASCII, 6 the rest."""
    kinds = np.full(256, 5, np.uint8)
    kinds[128:] = 6
    for kind, chars in ((0, b"abcdefghijklmnopqrstuvwxyz"), (1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, b"0123456789"), (3, b" \t\r\n\x0b\x0c"), (4, b".,;:'\"?-()")):
        kinds[list(chars)] = kind
    return kinds


class Features:
    """Word buckets and statistics of a text; words are hashed once per worker."""

    def __init__(self) -> None:
        self.classes, self.words = _byte_classes(), {}

    def of(self, text: str | None) -> tuple[np.ndarray, list[float]]:
        """Distinct buckets, and the statistics in the order of ``STATISTICS``."""
        import zlib

        data = (text or "").encode("utf-8", "surrogatepass")
        shares = np.bincount(self.classes[np.frombuffer(data, np.uint8)], minlength=7) / max(1, len(data))
        words = data.lower().split()
        known = self.words
        if len(known) > CACHE_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = zlib.crc32(word) % BUCKETS
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        buckets, counts = np.unique(ids, return_counts=True)
        lines = [line for line in data.split(b"\n") if line.strip()]
        distinct = set(lines)
        most = min(1, len(lines)) if len(distinct) == len(lines) else max(Counter(lines).values())
        n = max(1, len(words))
        statistics = [
            float(np.log1p(len(data))), float(np.log1p(len(words))), float(np.log1p(len(lines))), len(data) / n,
            shares[1], shares[2], shares[3], shares[4], shares[5], shares[6],
            len(buckets) / n, counts.max(initial=0) / n, float((ids[1:] == ids[:-1]).sum()) / n,
            len(distinct) / max(1, len(lines)), most / max(1, len(lines)), float(max(map(len, words), default=0)),
        ]
        return buckets, statistics


def features() -> Features:
    held = worker_state("quality")
    if "quality features" not in held:
        held["quality features"] = Features()
    return held["quality features"]


@dataclass
class Model:
    """``weights`` and ``factors`` have a row per word bucket, then per bin."""

    edges: np.ndarray  # (values, BINS - 1) inner edges of the bins
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def places(self, values: np.ndarray) -> np.ndarray:
        """The feature numbers of a row's values; null is the last bin of its own."""
        bins = [BINS if np.isnan(v) else int(np.searchsorted(e, v, "right")) for v, e in zip(values, self.edges)]
        return BUCKETS + np.arange(len(values)) * (BINS + 1) + np.array(bins, dtype=np.int64)

    def score(self, buckets: np.ndarray, values: np.ndarray) -> float:
        at = np.concatenate([buckets, self.places(values)])
        x = np.ones(len(at), np.float32)
        x[: len(buckets)] = 1 / np.sqrt(max(1, len(buckets)))
        taken = self.factors[at] * x[:, None]
        sums = taken.sum(axis=0)
        z = self.bias + self.weights[at] @ x + 0.5 * float(sums @ sums - (taken * taken).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Model | None:
    """The model from ``(buckets, values, label)``; None if a label is missing. Adam on
    the logistic loss, in batches, with the same draw of batches each time."""
    labels = np.array([row[2] for row in rows], dtype=np.float32)
    if len(rows) == 0 or labels.min() == labels.max():
        return None
    values = np.array([row[1] for row in rows], dtype=np.float64)
    filled = np.where(np.isnan(values), np.nanmedian(np.where(np.isnan(values).all(axis=0), 0, values), axis=0), values)
    edges = np.quantile(filled, np.arange(1, BINS) / BINS, axis=0).T
    random = np.random.default_rng(6)
    size = BUCKETS + values.shape[1] * (BINS + 1)
    model = Model(edges, float(np.log(labels.mean() / (1 - labels.mean()))), np.zeros(size, np.float32),
                  random.normal(0, 0.05, (size, RANK)).astype(np.float32))
    at = [np.concatenate([row[0], model.places(row[1])]) for row in rows]
    x = [np.concatenate([np.full(len(row[0]), 1 / np.sqrt(max(1, len(row[0])))), np.ones(values.shape[1])]).astype(np.float32) for row in rows]
    parameters = np.concatenate([model.weights[:, None], model.factors], axis=1)
    mean, square, step = np.zeros_like(parameters), np.zeros_like(parameters), 0
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            some = order[start : start + BATCH]
            lengths = [len(at[k]) for k in some]
            heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            places, xs = np.concatenate([at[k] for k in some]), np.concatenate([x[k] for k in some])
            taken = parameters[places] * xs[:, None]
            sums = np.add.reduceat(taken, heads, axis=0)
            squares = np.add.reduceat(taken[:, 1:] ** 2, heads, axis=0)
            z = model.bias + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2 - squares).sum(axis=1)
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[some]
            own = np.repeat(np.arange(len(some)), lengths)
            slope = np.empty_like(taken)
            slope[:, 0] = xs
            slope[:, 1:] = (sums[own, 1:] - taken[:, 1:]) * xs[:, None]
            slope *= (error[own] / len(some))[:, None]
            touched, where = np.unique(places, return_inverse=True)
            gradient = np.zeros((len(touched), RANK + 1), np.float32)
            np.add.at(gradient, where, slope)
            gradient += DECAY * parameters[touched]
            step += 1
            mean[touched] = 0.9 * mean[touched] + 0.1 * gradient
            square[touched] = 0.999 * square[touched] + 0.001 * gradient**2
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            parameters[touched] -= rate * mean[touched] / (np.sqrt(square[touched]) + 1e-8)
            model.bias -= 0.1 * RATE * float(error.mean())
    model.weights, model.factors = parameters[:, 0].copy(), parameters[:, 1:].copy()
    return model


def remainder(id_: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.pmod(F.crc32(id_.cast("string")), F.lit(divisor))


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    meta_cols: list[str],
    rows: int = TRAIN_ROWS,
    limit: int = BROADCAST_BYTES,
) -> Model | None:
    """A model from at most ``rows`` labelled documents whose remainder by 5 is not 0.
    Features are made where the texts lie; the driver gets numbers of those rows. Ids may
    repeat: beyond twice ``rows`` equal rows count once, and a draw by hash takes at most
    that many."""
    known = labels.select(plain(id_col).alias("id"), plain(label_col).cast("int").alias("label"))
    known = known.filter("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    known = known.filter(remainder(F.col("id"), 5) != 0).orderBy(F.xxhash64("id"), "id").limit(rows)
    known = materialize(known, "labelled")
    held = documents.select(
        plain(id_col).alias("id"), plain(text_col).alias("text"),
        F.array(*[plain(c).cast("double") for c in meta_cols]).cast("array<double>").alias("meta"),
    )

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = features()
        for batch in batches:
            out = []
            for text, meta, label in zip(batch["text"], batch["meta"], batch["label"]):
                buckets, statistics = made.of(text)
                values = np.array([*statistics, *meta], dtype=np.float64)
                out.append((buckets.astype("<i4").tobytes(), values.tobytes(), label))
            yield pd.DataFrame(out, columns=["buckets", "numbers", "label"])

    chosen = measured_join(held, known, ["id"], "inner", "id", limit).select("text", "meta", "label")
    kept = materialize(chosen.mapInPandas(make, "buckets binary, numbers binary, label int"), "features")
    if kept.count() > 2 * rows:
        kept = drawn(kept, 2 * rows)
    found = kept.collect()
    found.sort(key=lambda r: (bytes(r["numbers"]), bytes(r["buckets"])))  # the same order each time
    return fit([(np.frombuffer(r["buckets"], "<i4").astype(np.int64), np.frombuffer(r["numbers"]), r["label"]) for r in found])


def drawn(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` of the distinct rows, the same each time: those whose hash lies below
    a bound that counts per hash prefix give. Driver memory: a count per prefix."""
    columns = rows.columns
    rows = materialize(rows.distinct().withColumn("_prefix", F.shiftrightunsigned(F.xxhash64(*columns), 64 - PREFIX_BITS)), "distinct")
    bound, held = 0, 0
    for row in sorted(rows.groupBy("_prefix").count().collect()):
        if held + row["count"] > most:
            break
        bound, held = row["_prefix"] + 1, held + row["count"]
    return rows.filter(F.col("_prefix") < bound).drop("_prefix")


def score(model: Model | None, text: Column, meta: list[Column]) -> Column:
    """The score of a text (0 to 1) as a column; the text is read whole."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series, numbers: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series(np.full(len(texts), 0.5))
        made, out = features(), np.empty(len(texts))
        for k, (body, values) in enumerate(zip(texts, numbers)):
            buckets, statistics = made.of(body)
            out[k] = model.score(buckets, np.array([*statistics, *values], dtype=np.float64))
        return pd.Series(out)

    return scored(text, F.array(*[c.cast("double") for c in meta]).cast("array<double>"))
