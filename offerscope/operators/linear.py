"""Weighted logistic regressions of many labels, fitted in the same passes.

Each pass is one job: tasks add up loss and gradient of all unfinished problems over
their rows, partial sums meet per problem, and the driver gets one vector of the
features' width per problem. Its steps (limited-memory BFGS with backtracking) are
taken for every problem on its own, so a problem's result does not depend on the
others. Features are standardised inside; the penalty is on standardised weights and
spares the intercept.

A row without a label (null, or neither 0 nor 1) counts for the other labels only. A
label with one class only has zero weights and an infinite intercept; a label without
rows is an error, and so is a feature place outside the width.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerscope.session import materialize

#: Rows whose products with all problems are held at once in a task.
BLOCK_ROWS = 512
MEMORY = 10


class Problem(NamedTuple):
    """``label`` is a place in the table's labels; positives count ``weight`` times."""

    label: int
    weight: float
    penalty: float


class Weights(NamedTuple):
    intercept: float
    coefficients: np.ndarray


class Rows(NamedTuple):
    """Sparse rows of a block: the row, place and value of every entry."""

    count: int
    row: np.ndarray
    place: np.ndarray
    value: np.ndarray

    def times(self, coefficients: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * coefficients[self.place], self.count)

    def transposed_times(self, column: np.ndarray, dims: int, power: int = 1) -> np.ndarray:
        return np.bincount(self.place, self.value**power * column[self.row], dims)


def sparse_rows(places: pa.Array, values: pa.Array) -> Rows:
    lengths = places.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = [x.flatten().to_numpy(zero_copy_only=False) for x in (places, values)]
    return Rows(len(lengths), np.repeat(np.arange(len(lengths)), lengths), *flat)


def sparse_parts(features: Column) -> list[Column]:
    """``places`` and ``values`` of a vector column."""
    held = F.unwrap_udt(features)
    every = F.transform(held["values"], lambda x, i: i)
    return [F.coalesce(held["indices"], every).alias("places"), held["values"].alias("values")]


def probability(margin: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -margin))


def training_table(df: DataFrame, features_col: str, labels: list[str]) -> DataFrame:
    """What the passes read, stored once."""
    marks = F.array(*[F.coalesce(F.col(label).cast("double"), F.lit(-1.0)) for label in labels])
    rows = df.select(*sparse_parts(F.col(features_col)), marks.alias("labels"))
    return materialize(rows.mapInArrow(_packed, "places binary, values binary, labels array<double>"), "features")


def _packed(batches):
    """Lists of numbers as bytes, which the passes take over whole, not number by number."""
    for batch in batches:
        columns = []
        for column, kind in zip(batch.columns[:2], ("<i4", "<f8")):
            flat = np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False), kind)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(lengths)]) * flat.itemsize
            offsets = pa.py_buffer(ends.astype("<i8").tobytes())
            whole = pa.Array.from_buffers(pa.large_binary(), len(column), [None, offsets, pa.py_buffer(flat.tobytes())])
            columns.append(whole.cast(pa.binary()))
        yield pa.RecordBatch.from_arrays([*columns, batch.column(2)], ["places", "values", "labels"])


def packed_rows(places: pa.Array, values: pa.Array) -> Rows:
    """``sparse_rows`` of a stored table."""
    lengths = pc.binary_length(places).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    place, value = (np.frombuffer(b"".join(x.to_pylist()), kind) for x, kind in ((places, "<i4"), (values, "<f8")))
    return Rows(len(lengths), np.repeat(np.arange(len(lengths)), lengths), place, value)


def _sums(table: DataFrame, problems: list[Problem], width: int, add) -> np.ndarray:
    """A row of ``width`` sums per problem; ``add`` takes the sums, a block, its labels
    (0 or 1) and weights, one column per problem."""

    def partial(batches):
        total = np.zeros((len(problems), width))
        label = [p.label for p in problems]
        positive = np.array([p.weight for p in problems])
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                marks = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)[:, label]
                weight = np.where(marks == 1, positive, np.where(marks == 0, 1.0, 0.0))
                add(total, packed_rows(part.column(0), part.column(1)), (marks == 1).astype(float), weight)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(problems)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "part"]
        )

    parts = table.mapInArrow(partial, "i int, part array<double>")
    sums = parts.groupBy("i").agg(vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("sums"))
    found = np.zeros((len(problems), width))
    for row in sums.collect():
        found[row["i"]] = row["sums"]
    return found


@dataclass
class _State:
    """One problem's place, and the last steps and changes of its gradient."""

    at: np.ndarray
    loss: float = np.inf
    slope: np.ndarray | None = None
    steps: list = field(default_factory=list)
    direction: np.ndarray | None = None
    length: float = 1.0
    taken: int = 0

    def trial(self) -> np.ndarray:
        return self.at if self.direction is None else self.at + self.length * self.direction

    def _downhill(self) -> np.ndarray:
        way, shares = self.slope.copy(), []
        for step, change in reversed(self.steps):
            share = step @ way / (step @ change)
            shares.append(share)
            way -= share * change
        if self.steps:
            step, change = self.steps[-1]
            way *= step @ change / (change @ change)
        for (step, change), share in zip(self.steps, reversed(shares)):
            way += (share - change @ way / (step @ change)) * step
        return -way

    def learn(self, loss: float, slope: np.ndarray, tolerance: float) -> bool:
        """Takes or shortens the step that was tried; whether the problem goes on."""
        if self.direction is not None:
            fall = self.slope @ self.direction
            # Near the end losses differ by rounding only; there the slope decides.
            flat = abs(loss - self.loss) <= 1e-13 * abs(self.loss) and abs(slope @ self.direction) <= abs(fall)
            if loss > self.loss + 1e-4 * self.length * fall and not flat:
                self.length *= 0.5
                return self.length > 1e-12
            step, change = self.length * self.direction, slope - self.slope
            if step @ change > 0:
                self.steps = [*self.steps, (step, change)][-MEMORY:]
            self.at, self.taken = self.at + step, self.taken + 1
        self.loss, self.slope = loss, slope
        self.direction = self._downhill()
        self.length = 1.0 if self.steps else min(1.0, 1.0 / max(np.linalg.norm(slope), 1e-300))
        return bool(np.abs(slope).max() > tolerance)


def fit(
    table: DataFrame, problems: list[Problem], dims: int, iterations: int = 100, tolerance: float = 1e-6
) -> tuple[list[Weights], int]:
    """Weights per problem, and the number of passes over ``table``."""

    def moments(total, rows, y, weight):
        for i in range(len(total)):
            total[i, :dims] += rows.transposed_times(weight[:, i], dims)
            total[i, dims : 2 * dims] += rows.transposed_times(weight[:, i], dims, 2)
        total[:, -3] += weight.sum(0)
        total[:, -2] += (weight**2).sum(0)
        total[:, -1] += (weight * y).sum(0)

    seen = _sums(table, problems, 2 * dims + 3, moments)
    size, squares, positive = seen[:, -3], seen[:, -2], seen[:, -1]
    if (size == 0).any():
        raise ValueError(f"no rows for the labels at {sorted({p.label for p, n in zip(problems, size) if n == 0})}")
    centre = seen[:, :dims] / size[:, None]
    freedom = np.maximum(size - squares / size, 1e-300)[:, None]
    variance = np.maximum(seen[:, dims : 2 * dims] - centre**2 * size[:, None], 0.0) / freedom
    varies = variance > 1e-18 * np.maximum(centre**2, 1e-300)
    scale = np.where(varies, 1.0 / np.sqrt(np.where(varies, variance, 1.0)), 0.0)

    states: dict[int, _State] = {}
    for i, (n, p) in enumerate(zip(size, positive)):
        if 0 < p < n:
            states[i] = _State(np.append(np.zeros(dims), np.log(p / (n - p))))
    active, passes = list(states), 1

    def weights_of(i: int, at: np.ndarray) -> Weights:
        coefficients = at[:-1] * scale[i]
        return Weights(float(at[-1] - centre[i] @ coefficients), coefficients)

    while active:
        tried = [weights_of(i, states[i].trial()) for i in active]

        def slopes(total, rows, y, weight, tried=tried):
            for i, (intercept, coefficients) in enumerate(tried):
                margin = rows.times(coefficients) + intercept
                total[i, -1] += weight[:, i] @ (np.logaddexp(0.0, margin) - y[:, i] * margin)
                rest = weight[:, i] * (probability(margin) - y[:, i])
                total[i, -2] += rest.sum()
                total[i, :-2] += rows.transposed_times(rest, dims)

        sums = _sums(table, [problems[i] for i in active], dims + 2, slopes)
        passes += 1
        goes_on = []
        for i, row in zip(active, sums):
            at, penalty = states[i].trial()[:-1], problems[i].penalty
            inner = (row[:-2] - centre[i] * row[-2]) * scale[i] / size[i] + penalty * at
            loss = row[-1] / size[i] + 0.5 * penalty * (at @ at)
            if states[i].learn(loss, np.append(inner, row[-2] / size[i]), tolerance) and states[i].taken < iterations:
                goes_on.append(i)
        active = goes_on

    one_class = lambda i: Weights(np.inf if positive[i] > 0 else -np.inf, np.zeros(dims))
    return [weights_of(i, states[i].at) if i in states else one_class(i) for i in range(len(problems))], passes
