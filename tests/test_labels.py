"""Label reports and evaluation."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerscope.operators import metrics as M
from offerscope.operators import quality as Q


def test_coercion(spark):
    rows = [(0.5,), (1.5,), (-1.0,), (3.0,), (None,), (0.51,)]
    frame = spark.createDataFrame([(a, 1.0) for (a,) in rows], "a double, b double")
    assert [r["a"] for r in Q.coerce_labels(frame, ["a", "b"]).collect()] == [0, 1, 0, 1, 1]


def labels(spark):
    rows = [(1, 1, 0, "H"), (1, 1, 1, "H"), (0, 0, 0, "A"), (None, 1, 1, "A"), (0, 1, 0, "B"), (None, None, None, "C")]
    return spark.createDataFrame(rows, "a int, b int, c int, d string")


def test_reports(spark):
    names = ["a", "b", "c"]
    table = {r["label"]: tuple(r[1:]) for r in Q.label_table(labels(spark), names).collect()}
    assert table == {"a": (2, 50.0, 2, 50.0), "b": (3, 75.0, 1, 25.0), "c": (1, 25.0, 3, 75.0)}
    assert tuple(Q.rows_without_positive(labels(spark), names).first()) == (4, 1, 25.0)
    pairs = [tuple(r) for r in Q.cooccurrence(labels(spark), names).collect()]
    assert pairs == [("a", "b", 2), ("a", "c", 1), ("b", "c", 1)]
    domains = {r["d"]: (r["n_offers"], round(r["mean_positive_pct"], 6)) for r in Q.domain_rates(labels(spark), names, "d").collect()}
    assert domains == {"H": (2, 83.333333), "A": (1, 0.0), "B": (1, 33.333333)}
    weights = {r["label"]: r["pos_weight"] for r in Q.class_weights(labels(spark).dropna(), names).collect()}
    assert weights == {"a": 1.0, "b": 1.0, "c": 3.0}


def test_nothing_annotated(spark):
    frame = labels(spark).filter("d = 'C'")
    assert Q.label_table(frame, ["a", "b", "c"]).count() == 0


def test_rules(spark):
    rows = [(1, 1, 0), (0, 0, 1), (0, 1, 1), (1, 0, 0), (1, 1, 1)]
    frame = spark.createDataFrame(rows, "junior_offer int, experienced_offer int, very_experienced_offer int")
    found = {r["rule"]: r["n_violations"] for r in Q.rule_violations(frame).collect()}
    assert found == {"junior_and_experienced": 2, "very_experienced_without_experienced": 1}


# --- evaluation ---------------------------------------------------------------------


def scored(spark, y, score):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, score)], "y int, s double")


PAIR = {"l": ("y", "s")}


def direct_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    wins = [(p > n) + 0.5 * (p == n) for p, n in itertools.product(pos, neg)]
    return float(np.mean(wins)) if wins else None


def direct_ap(y, s):
    total, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        hit = s >= t
        recall = (y[hit] == 1).sum() / (y == 1).sum()
        total += (recall - last) * (y[hit] == 1).mean()
        last = recall
    return total


@pytest.mark.parametrize("seed, digits", [(0, 1), (1, 2), (2, 9)])
def test_ranking(spark, seed, digits):
    rng = np.random.default_rng(seed)
    y = (rng.random(400) < 0.3).astype(int)
    s = np.round(np.clip(rng.random(400) * 0.7 + y * 0.3, 0, 1), digits)
    row = M.ranking_quality(scored(spark, y, s), PAIR).first()
    assert row["auc"] == pytest.approx(direct_auc(y, s)) and row["ap"] == pytest.approx(direct_ap(y, s))


def test_ranking_edges(spark):
    one = M.ranking_quality(scored(spark, [1, 1], [0.2, 0.4]), PAIR).first()
    none = M.ranking_quality(scored(spark, [0, 0], [0.2, 0.4]), PAIR).first()
    same = M.ranking_quality(scored(spark, [0, 1, 1], [0.5] * 3), PAIR).first()
    assert (one["auc"], one["ap"]) == (None, 1.0)
    assert (none["auc"], none["ap"]) == (None, None)
    assert (same["auc"], same["ap"]) == (0.5, pytest.approx(2 / 3))
    macro = M.macro_ranking_quality(
        M.ranking_quality(
            spark.createDataFrame([(1, 0, 0.1), (0, 0, 0.2)], "a int, b int, s double"), {"a": ("a", "s"), "b": ("b", "s")}
        )
    ).first()
    assert macro["auc_macro"] == 0.0 and macro["ap_macro"] == 0.5


def direct_best(y, s, floor=None):
    best, best_score = 0.5, -1.0
    for t in np.arange(0.05, 0.96, 0.01):
        p = s >= t
        tp, fp, fn = (p & (y == 1)).sum(), (p & (y == 0)).sum(), (~p & (y == 1)).sum()
        precision = tp / (tp + fp) if tp + fp else 0.0
        recall = tp / (tp + fn) if tp + fn else 0.0
        f1 = 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0
        if floor is not None and precision < floor:
            continue
        score = f1 if floor is None else recall
        if score > best_score:
            best, best_score = float(t), score
    return best


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("floor", [None, 0.5, 0.8, 1.01])
def test_thresholds(spark, seed, floor):
    rng = np.random.default_rng(seed)
    y = (rng.random(200) < 0.4).astype(int)
    # Scores that sit exactly on thresholds.
    s = rng.choice(np.arange(0.05, 0.96, 0.01), 200) * 0.8 + y * 0.1 if seed else rng.choice(np.arange(0.05, 0.96, 0.01), 200)
    found = M.best_thresholds(scored(spark, y, s), PAIR, floor).first()["threshold"]
    assert found == direct_best(y, s, floor)


def test_thresholds_without_positives(spark):
    assert M.best_thresholds(scored(spark, [0, 0], [0.3, 0.6]), PAIR).first()["threshold"] == 0.05


def test_grid():
    assert len(M.THRESHOLDS) == 91 and M.THRESHOLDS == list(np.arange(0.05, 0.96, 0.01))


def test_undefined_rates_are_zero(spark):
    row = M.rates_by_label(scored(spark, [0, 0], [0.1, 0.2]), PAIR, 0.5).first()
    assert tuple(row) == ("l", 0.0, 0.0, 0.0)


def test_error_table(spark):
    errors = M.error_table(scored(spark, [1, 0, 1, 0], [0.5, 0.5, 0.4, 0.1]), PAIR, {"l": 0.5}).collect()
    assert [r["error_l"] for r in errors] == [0, 1, -1, 0]
    flags = [[r[f"is_{k}_l"] for k in ("tp", "fp", "fn", "tn")].index(True) for r in errors]
    assert flags == [0, 1, 2, 3] and errors[2]["distance_to_threshold_l"] == pytest.approx(0.1)


def test_loss(spark):
    x, y, w = np.array([-800.0, 0.3, 900.0, -2.0]), np.array([0, 1, 1, 1]), 3.0
    expected = np.mean(w * y * np.logaddexp(0, -x) + (1 - y) * np.logaddexp(0, x))
    assert M.weighted_bce(scored(spark, y, x), PAIR, {"l": w}).first()["loss"] == pytest.approx(expected)


def test_probabilities(spark):
    frame = spark.createDataFrame([(-1000.0,), (0.0,), (1000.0,)], "x double")
    found = [r["proba_l"] for r in M.probabilities(frame, {"l": "x"}).collect()]
    assert found == pytest.approx([1 / (1 + math.exp(50)), 0.5, 1 / (1 + math.exp(-50))])


def test_lengths(spark):
    frame = spark.createDataFrame([(n,) for n in (100, 300, 600, 2000)], "n int")
    coverage = {r["max_length"]: r["pct"] for r in Q.length_coverage(frame, "n").collect()}
    assert coverage[256] == 25.0 and coverage[1024] == 75.0 and coverage[8192] == 100.0
    row = Q.token_summary(frame, "n", 512).first()
    assert (row["count"], row["p50"], row["n_truncated"], row["pct_truncated"]) == (4, 450.0, 2, 50.0)
    assert frame.agg(F.max("n")).first()[0] == row["max"]
