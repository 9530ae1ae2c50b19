"""Centroids, coherence, similarity and components against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerscope.functions import vectors as V
from offerscope.operators import groups as G
from offerscope.operators import pca as P
from offerscope.operators import ranges as R
from offerscope.operators import similarity as S
from offerscope.session import materialize


def table(spark, n=400, dims=6, seed=0, zeros=()):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) + np.arange(dims) / 3
    x[list(zeros)] = 0
    # One firm holds a third of the rows.
    firms = ["hot" if i % 3 == 0 else f"f{rng.integers(0, 9)}" for i in range(n)]
    rows = [(i, firms[i], [float(v) for v in x[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, firm string, v array<double>"), x, np.array(firms)


def units(x):
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norms, out=np.zeros_like(x), where=norms > 0)


def test_unit_vectors(spark):
    frame = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    nan, zero = zip(*frame.select(V.unit_or_nan(F.col("v")), V.unit_or_zero(F.col("v"))).collect())
    assert nan[0] == zero[0] == pytest.approx([0.6, 0.8])
    assert all(math.isnan(x) for x in nan[1]) and zero[1] == [0.0, 0.0]


def test_centroids_and_keys(spark):
    frame = spark.createDataFrame(
        [("a", "H1206", [1.0, 2.0]), ("a", "H1206", [3.0, 4.0]), ("", "H1206", [5.0, 5.0]), (None, "H1206", [9.0, 9.0]), ("a", "x", [7.0, 7.0]), ("a", None, [0.0, 0.0])],
        "firm string, code string, v array<double>",
    )
    firms = {r["firm"]: (r["centroid"], r["n_offers"]) for r in G.centroids(frame, ["firm"], "v").collect()}
    assert set(firms) == {"a", ""} and firms[""] == ([5.0, 5.0], 1) and firms["a"][1] == 4
    both = G.centroids(frame, ["firm", "code"], "v", code_col="code", drop_empty=True).collect()
    assert [(r["firm"], r["code"], r["centroid"], r["n_offers"]) for r in both] == [("a", "H1206", [2.0, 3.0], 2)]


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_coherence(spark, partitions):
    frame, x, firms = table(spark, zeros=[5, 9])
    u = units(x)
    found = {r["firm"]: r for r in G.within_group_coherence(frame.repartition(partitions), ["firm"], "v").collect()}
    for firm in set(firms):
        g = u[firms == firm]
        pairs = (g @ g.T)[np.triu_indices(len(g), 1)]
        # The closed form counts every row as a unit vector, zero rows too.
        n, s = len(g), g.sum(axis=0)
        assert found[firm]["mean_within_cos"] == pytest.approx((s @ s - n) / (n * (n - 1)))
        if not (np.linalg.norm(g, axis=1) == 0).any():
            assert found[firm]["mean_within_cos"] == pytest.approx(pairs.mean())


def test_small_groups_have_no_coherence(spark):
    frame = spark.createDataFrame([("a", [1.0]), ("b", [1.0]), ("b", [2.0]), (None, [1.0])], "k string, v array<double>")
    rows = {r["k"]: r["mean_within_cos"] for r in G.within_group_coherence(frame, ["k"], "v", min_obs=1).collect()}
    assert rows == {"a": None, "b": pytest.approx(1.0)}
    assert [r["k"] for r in G.within_group_coherence(frame, ["k"], "v").collect()] == ["b"]


def test_nearest_groups(spark):
    rows = [("t", [1.0, 0.0]), ("b", [1.0, 1.0]), ("a", [2.0, 2.0]), ("z", [0.0, 0.0]), ("o", [-1.0, 0.0])]
    frame = spark.createDataFrame(rows, "k string, centroid array<double>")
    found = [(r["k"], r["cosine_similarity"]) for r in G.top_k_similar(frame, "k", "t", 10).collect()]
    assert [k for k, _ in found] == ["a", "b", "o", "z"]
    assert found[0][1] == pytest.approx(math.sqrt(0.5)) and found[3][1] is None
    assert len(G.top_k_similar(frame, "k", "t", 2).collect()) == 2
    with pytest.raises(ValueError):
        G.top_k_similar(frame, "k", "unknown")


def test_firm_names(spark):
    frame = spark.createDataFrame(
        [(3, "a", "late"), (1, "a", None), (2, "a", "first"), (4, "b", None)], "offer_id int, SIREN string, entreprise_nom string"
    )
    cents = spark.createDataFrame([("a", [1.0]), ("b", [1.0]), ("t", [1.0])], "SIREN string, centroid array<double>")
    found = G.top_k_similar_firms(cents, frame, "t").collect()
    assert {r["SIREN"]: r["entreprise_nom"] for r in found} == {"a": "first", "b": None}


def test_pair_statistics(spark):
    frame, x, _ = table(spark)
    pairs = (units(x) @ units(x).T)[np.triu_indices(len(x), 1)]
    row = S.pair_statistics(frame.repartition(5), "v").first()
    assert (row["n_rows"], row["n_pairs"]) == (400, len(pairs))
    assert row["mean_cos"] == pytest.approx(pairs.mean()) and row["std_cos"] == pytest.approx(pairs.std())


@pytest.mark.parametrize("block_rows", [7, 64, 5000])
def test_pair_histogram(spark, block_rows):
    frame, x, _ = table(spark, n=150, zeros=[3])
    u = units(np.delete(x, 3, axis=0))
    pairs = (u @ u.T)[np.triu_indices(len(u), 1)]
    expected, edges = np.histogram(pairs, bins=40)
    rows = S.pair_histogram(frame, "id", "v", 40, block_rows).orderBy("bin").collect()
    assert [r["n_pairs"] for r in rows] == expected.tolist()
    assert [r["lower"] for r in rows] == pytest.approx(edges[:-1])


def test_pair_histogram_of_copies(spark):
    rows = [(i, [1.0, 0.0] if i % 3 else [0.0, 1.0]) for i in range(90)]
    frame = spark.createDataFrame(rows, "id long, v array<double>")
    counts = [r["n_pairs"] for r in S.pair_histogram(frame, "id", "v", 10, 16).orderBy("bin").collect()]
    assert counts[0] == 30 * 60 and counts[-1] == 30 * 29 // 2 + 60 * 59 // 2 and sum(counts) == 90 * 89 // 2


def test_column_histogram(spark):
    values = [0.0, 0.1, 0.5, 0.99, 1.0, None, float("nan")]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    counts = [r["n"] for r in S.column_histogram(frame, "v", 4).orderBy("bin").collect()]
    assert counts == np.histogram([0, 0.1, 0.5, 0.99, 1.0], bins=4)[0].tolist()
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [r["n"] for r in S.column_histogram(same, "v", 2).orderBy("bin").collect()] == [0, 2]


@pytest.mark.parametrize("n", [1, 2, 5, 997])
def test_quantiles(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.normal(size=n) ** 3, 1)
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    probabilities = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    held = R.value_table(frame, "v")
    assert R.exact_quantiles(held, probabilities) == pytest.approx(np.quantile(values, probabilities))
    row = R.describe(held, [0.5]).first()
    assert row["count"] == n and row["mean"] == pytest.approx(values.mean())
    assert row["std"] == (pytest.approx(values.std(ddof=1)) if n > 1 else None)


def test_components(spark):
    frame, x, _ = table(spark, n=300, dims=5)
    x = x * np.array([5, 3, 1, 0.5, 0.2])
    frame = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>")
    centred = x - x.mean(axis=0)
    _, singular, vt = np.linalg.svd(centred, full_matrices=False)
    share = singular**2 / (singular**2).sum()
    basis = P.fit_components(frame, "v")
    assert basis.explained == pytest.approx(share)
    kept = int(np.searchsorted(np.cumsum(share), 0.90) + 1)
    assert basis.enough_for(0.90) == kept
    signs = np.sign(vt[np.arange(5), np.abs(vt).argmax(axis=1)])
    expected = centred @ (vt * signs[:, None]).T[:, :kept]
    rows = P.reduce_vectors(frame, "v").orderBy("id").collect()
    assert np.array([r["embedding_pca"] for r in rows]) == pytest.approx(expected, abs=1e-4)


def test_components_of_the_shared_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert P.fit_components(frame, "embedding").enough_for(0.90) == 53


def test_centroid_map(spark):
    rows = [(f"k{i}", [float(i), float(i % 3), 1.0], i) for i in range(40)]
    frame = spark.createDataFrame(rows, "k string, centroid array<double>, n_offers long")
    placed = P.centroid_map(frame, "k", labelled=30).collect()
    assert len(placed) == 40 and {r["k"] for r in placed if r["labelled"]} == {f"k{i}" for i in range(10, 40)}


def test_components_leave_rows_without_a_vector_alone(spark):
    rows = [(k, [float(k % 3), float(k % 5), float(k * k % 7)]) for k in range(40)]
    with_null = spark.createDataFrame([(-1, None), *rows, (99, None)], "i int, v array<double>").coalesce(1)
    without = spark.createDataFrame(rows, "i int, v array<double>")
    got, right = (
        {r["i"]: r["embedding_pca"] for r in P.reduce_vectors(table, "v", 0.99).collect()} for table in (with_null, without)
    )
    assert got.pop(-1) is None and got.pop(99) is None
    assert got.keys() == right.keys()
    assert all(np.allclose(got[k], right[k], atol=1e-5) for k in right)
    with pytest.raises(ValueError, match="no vectors"):
        P.fit_components(with_null.filter("v is null"), "v")


def test_pair_histogram_shuffles_no_block_twice(spark):
    rng = np.random.default_rng(8)
    frame = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(90)], "id int, v array<double>")
    packed = materialize(S._block_matrices(S._units(frame, "v", "id"), "id", 8), "blocks")
    plan = S._block_pairs(packed)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Explode" not in plan
    met = [tuple(sorted(r)) for r in S._block_pairs(packed).select("block_i", "block_j").collect()]
    blocks = [r["block"] for r in packed.select("block").collect()]
    assert len(met) == len(set(met)) == len(blocks) * (len(blocks) + 1) // 2
