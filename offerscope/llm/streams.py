"""Rows through Arrow tasks, in runs of equal keys, with bounded batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that a task hands on together.
OUT_ROWS = 4096


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows that follow each other with the same first ``keys`` columns."""
    held: list[tuple] = []
    for row in rows_of(batches):
        if held and held[0][:keys] != row[:keys]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def mapped(rows: DataFrame, fields: list[T.StructField], make: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]) -> DataFrame:
    """``mapInArrow`` with a function that yields tuples."""
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in make(batches):
            held.append(row)
            if len(held) >= OUT_ROWS:
                yield batch(held)
                held = []
        if held:
            yield batch(held)

    return rows.mapInArrow(run, schema)


def fields(text: str) -> list[T.StructField]:
    """Fields of ``name type`` pairs, comma between them."""
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(), "binary": T.BinaryType()}
    return [T.StructField(name, kinds[kind]) for name, kind in (part.split() for part in text.split(","))]
