"""Column expressions over ``array<double>`` or ``array<float>`` vectors."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerscope.functions.text import bind


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def squared_norm(vector: Column) -> Column:
    return F.aggregate(as_doubles(vector), F.lit(0.0), lambda total, x: total + x * x)


def norm(vector: Column) -> Column:
    return F.sqrt(squared_norm(vector))


def _scaled(vector: Column, zero) -> Column:
    """Entries over the norm. The norm is bound to a name of its own: written
    inside the inner function it would be worked out again for every entry."""
    return bind(
        norm(vector),
        lambda n: F.transform(
            as_doubles(vector), lambda x: F.when(n > 0, x / n).otherwise(zero(x))
        ),
    )


def unit_or_nan(vector: Column) -> Column:
    """Unit length; a zero vector becomes NaN in every place."""
    return _scaled(vector, lambda x: F.lit(float("nan")))


def unit_or_zero(vector: Column) -> Column:
    """Unit length; a zero vector stays zero."""
    return _scaled(vector, lambda x: x)


def literal_vector(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def cosine_to(vector: Column, target: list[float]) -> Column:
    """Cosine with a fixed vector; null where one of the two is zero."""
    length = math.sqrt(sum(x * x for x in target))
    if length == 0:
        return F.lit(None).cast("double")
    unit = literal_vector(x / length for x in target)
    own = norm(vector)
    return F.when(own > 0, dot(as_doubles(vector), unit) / own)


def sigmoid(x: Column, clip: float | None = 50.0) -> Column:
    if clip is not None:
        x = F.least(F.greatest(x, F.lit(-clip)), F.lit(clip))
    return 1 / (1 + F.exp(-x))
