"""The solver of many labels against one solver per label."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from offerscope.operators import linear

DIMS, LABELS = 12, [f"l{i}" for i in range(17)]


@pytest.fixture(scope="module")
def frame(spark):
    random = np.random.default_rng(4)
    x = random.normal(size=(400, DIMS)) * (random.random((400, DIMS)) < 0.4) * np.logspace(-2, 2, DIMS)
    x[:, 5] = 0.0
    x[7] = 0.0
    way = random.normal(size=(DIMS, len(LABELS))) / np.logspace(-2, 2, DIMS)[:, None]
    y = (x @ way + random.normal(size=(400, len(LABELS))) > 0.7).astype(int)
    rows = []
    for i, (row, marks) in enumerate(zip(x, y)):
        vector = Vectors.dense(row) if i % 5 == 0 else Vectors.sparse(DIMS, [(int(j), float(row[j])) for j in np.flatnonzero(row)])
        rows.append((vector, *[int(m) for m in marks]))
    return spark.createDataFrame(rows, ["x", *LABELS]).repartition(5).cache()


def test_weights_equal_a_fit_per_label(frame):
    table = linear.training_table(frame, "x", LABELS)
    problems = [linear.Problem(i, 1.0 + i % 3, [0.01, 0.2][i % 2]) for i in range(len(LABELS))]
    found, passes = linear.fit(table, problems, DIMS, 1000, 1e-10)
    for i in (0, 1, 8, 16):
        weight = F.when(F.col(LABELS[i]) == 1, F.lit(problems[i].weight)).otherwise(F.lit(1.0))
        rows = frame.select("x", F.col(LABELS[i]).cast("double").alias("y"), weight.alias("w"))
        solver = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=problems[i].penalty, maxIter=1000, tol=1e-14)
        right = solver.fit(rows)
        assert found[i].intercept == pytest.approx(right.intercept, abs=1e-6)
        assert found[i].coefficients == pytest.approx(right.coefficients.toArray(), rel=1e-6, abs=1e-6)
        alone, own_passes = linear.fit(table, [problems[i]], DIMS, 1000, 1e-10)
        assert own_passes <= passes
        assert np.abs(alone[0].coefficients - found[i].coefficients).max() < 1e-9
    assert passes < 120


def test_rows_without_a_label_and_labels_of_one_class(spark, frame):
    half = frame.withColumn("some", F.when(F.col("l1") == 1, F.col("l0"))).withColumn("one", F.lit(1)).withColumn("no", F.lit(0))
    names = ["some", "one", "no", "l0"]
    found, _ = linear.fit(linear.training_table(half, "x", names), [linear.Problem(i, 2.0, 0.1) for i in range(4)], DIMS, 500, 1e-10)
    own = linear.training_table(half.filter("l1 = 1"), "x", ["some"])
    right, _ = linear.fit(own, [linear.Problem(0, 2.0, 0.1)], DIMS, 500, 1e-10)
    assert np.abs(found[0].coefficients - right[0].coefficients).max() < 1e-8
    assert (found[1].intercept, found[2].intercept) == (np.inf, -np.inf)
    assert not found[1].coefficients.any() and found[3].coefficients.any()
    assert linear.probability(np.array([np.inf, -np.inf, 0.0])).tolist() == [1.0, 0.0, 0.5]
    with pytest.raises(ValueError, match="no rows"):
        linear.fit(linear.training_table(half.filter("l1 = 0"), "x", ["some"]), [linear.Problem(0, 1.0, 0.1)], DIMS)
    with pytest.raises(ValueError, match="no rows"):
        linear.fit(linear.training_table(half.limit(0), "x", ["l0"]), [linear.Problem(0, 1.0, 0.1)], DIMS)


def test_training_rows_are_stored_as_bytes(spark):
    """Passes take a row's numbers over whole; an empty vector keeps its row."""
    rows = [(Vectors.sparse(5, {1: 0.5, 4: 2.0}), 1), (Vectors.sparse(5, {}), 0), (Vectors.dense([1, 2, 3, 4, 5]), 1)]
    table = linear.training_table(spark.createDataFrame(rows, ["x", "y"]), "x", ["y"])
    assert dict(table.dtypes)["places"] == dict(table.dtypes)["values"] == "binary"
    held = sorted((np.frombuffer(r["places"], "<i4").tolist(), np.frombuffer(r["values"], "<f8").tolist(), r["labels"]) for r in table.collect())
    assert held == [([], [], [0.0]), ([0, 1, 2, 3, 4], [1, 2, 3, 4, 5], [1.0]), ([1, 4], [0.5, 2.0], [1.0])]
