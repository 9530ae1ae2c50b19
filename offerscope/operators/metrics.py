"""Evaluation of multi-label scores.

A scored table has, per label, a truth column (0/1) and a score column. ``pairs``
maps the label name to these two columns.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerscope.functions.vectors import sigmoid
from offerscope.operators.quality import stacked
from offerscope.operators.ranges import add_range
from offerscope.session import materialize

Pairs = dict[str, tuple[str, str]]

# The thresholds that are tried, and the one that stands when no
# threshold qualifies.
THRESHOLDS = [float(t) for t in np.arange(0.05, 0.96, 0.01)]
DEFAULT_THRESHOLD = 0.5


def confusion(df: DataFrame, pairs: Pairs, thresholds: dict[str, float] | float) -> DataFrame:
    """``label, tp, fp, fn, tn`` with prediction = score >= threshold."""
    sums = []
    for label, (truth, score) in pairs.items():
        cut = thresholds if isinstance(thresholds, float) else float(thresholds[label])
        y, hit = F.col(truth) == 1, F.col(score) >= F.lit(cut)
        sums += [
            F.count_if(y & hit).alias(f"tp_{label}"),
            F.count_if(~y & hit).alias(f"fp_{label}"),
            F.count_if(y & ~hit).alias(f"fn_{label}"),
            F.count_if(~y & ~hit).alias(f"tn_{label}"),
        ]
    names = ("tp", "fp", "fn", "tn")
    return stacked(
        df.agg(*sums), {label: {n: F.col(f"{n}_{label}") for n in names} for label in pairs}
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def _with_rates(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def rates_by_label(df: DataFrame, pairs: Pairs, thresholds: dict[str, float] | float = 0.5) -> DataFrame:
    """``label, precision, recall, f1``; an undefined rate is 0."""
    rates = _with_rates(confusion(df, pairs, thresholds))
    return rates.select("label", "precision", "recall", "f1")


def pooled_rates(df: DataFrame, pairs: Pairs, thresholds: dict[str, float] | float = 0.5) -> DataFrame:
    """Micro rates from pooled counts and the mean F1 over labels."""
    by_label = _with_rates(confusion(df, pairs, thresholds))
    pooled = by_label.agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.avg("f1").alias("f1_macro")
    )
    return _with_rates(pooled).select(
        F.col("precision").alias("precision_micro"),
        F.col("recall").alias("recall_micro"),
        F.col("f1").alias("f1_micro"),
        "f1_macro",
    )


def long_scores(df: DataFrame, pairs: Pairs) -> DataFrame:
    """``label, y, score``: one row per row and label."""
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.col(truth).cast("int").alias("y"),
                F.col(score).cast("double").alias("score"),
            )
            for label, (truth, score) in pairs.items()
        ]
    )
    return df.select(F.explode(rows).alias("r")).select("r.*")


def ranking_quality(df: DataFrame, pairs: Pairs) -> DataFrame:
    """``label, auc, ap``: area under the ROC curve with ties averaged, and
    average precision over distinct scores. Null where undefined.

    Equal scores are added up first and stored, so the scores are computed once.
    They are cut into ranges; the totals below
    each range are few (labels times ranges) and are broadcast, so rows are
    ordered only inside a range and one label never sits in one task.
    """
    by_score = materialize(
        long_scores(df, pairs)
        .groupBy("label", "score")
        .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")),
        "scores",
    )
    counted = add_range(by_score, "score")
    up = Window.partitionBy("label").orderBy("_range")
    whole = Window.partitionBy("label")
    totals = (
        counted.groupBy("label", "_range")
        .agg(F.sum("pos").alias("rp"), F.sum("neg").alias("rn"))
        .select(
            "label",
            "_range",
            (F.sum("rp").over(up) - F.col("rp")).alias("pos_before"),
            (F.sum("rn").over(up) - F.col("rn")).alias("neg_before"),
            F.sum("rp").over(whole).alias("P"),
            F.sum("rn").over(whole).alias("N"),
        )
    )
    inside = Window.partitionBy("label", "_range").orderBy("score")
    placed = (
        counted.join(F.broadcast(totals), ["label", "_range"])
        .withColumn("pos_below", F.col("pos_before") + F.sum("pos").over(inside) - F.col("pos"))
        .withColumn("neg_below", F.col("neg_before") + F.sum("neg").over(inside) - F.col("neg"))
    )
    P, N = F.col("P").cast("double"), F.col("N").cast("double")
    tp, fp = P - F.col("pos_below"), N - F.col("neg_below")
    return placed.groupBy("label").agg(
        F.sum(
            F.when((P > 0) & (N > 0), F.col("pos") * (F.col("neg_below") + F.col("neg") / 2) / (P * N))
        ).alias("auc"),
        F.sum(F.when(P > 0, F.col("pos") / P * (tp / (tp + fp)))).alias("ap"),
    )


def macro_ranking_quality(by_label: DataFrame) -> DataFrame:
    """Means over the labels for which the measure is defined."""
    return by_label.agg(F.avg("auc").alias("auc_macro"), F.avg("ap").alias("ap_macro"))


def threshold_curve(df: DataFrame, pairs: Pairs, grid: list[float] | None = None) -> DataFrame:
    """``label, threshold, precision, recall, f1`` for every threshold.

    Each score falls between two thresholds; counting those gaps once and adding
    them up from the top gives all thresholds together.
    """
    grid = grid or THRESHOLDS
    steps = Bucketizer(
        splits=[-math.inf, *grid, math.inf], inputCol="score", outputCol="_passed", handleInvalid="keep"
    )
    gaps = (
        steps.transform(long_scores(df, pairs))
        .groupBy("label", F.col("_passed").cast("int").alias("passed"))
        .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    )
    # passed = number of thresholds that the score reaches; every label gets all
    # the steps so that thresholds between scores are there too.
    spark = df.sparkSession
    places = [(label, i, t) for label in pairs for i, t in enumerate([-math.inf, *grid])]
    ladder = spark.createDataFrame(places, "label string, passed int, threshold double")
    down = Window.partitionBy("label").orderBy(F.col("passed").desc())
    whole = Window.partitionBy("label")
    counts = (
        ladder.join(gaps, ["label", "passed"], "left")
        .withColumn("pos", F.coalesce("pos", F.lit(0)))
        .withColumn("neg", F.coalesce("neg", F.lit(0)))
        .withColumn("tp", F.sum("pos").over(down))
        .withColumn("fp", F.sum("neg").over(down))
        .withColumn("fn", F.sum("pos").over(whole) - F.col("tp"))
        .filter(F.col("passed") > 0)
    )
    return _with_rates(counts).select("label", "threshold", "precision", "recall", "f1")


def best_thresholds(
    df: DataFrame, pairs: Pairs, min_precision: float | None = None, grid: list[float] | None = None
) -> DataFrame:
    """``label, threshold``: the lowest threshold with the best F1, or with the
    best recall among those that keep the precision; 0.5 when none does."""
    curve = threshold_curve(df, pairs, grid)
    if min_precision is None:
        quality = F.col("f1")
    else:
        quality = F.when(F.col("precision") >= min_precision, F.col("recall"))
    best = F.max_by(
        "threshold", F.when(quality.isNotNull(), F.struct(quality, -F.col("threshold")))
    )
    return curve.groupBy("label").agg(
        F.coalesce(best, F.lit(DEFAULT_THRESHOLD)).alias("threshold")
    )


def evaluate_held_out(
    df: DataFrame, pairs: Pairs, split_col: str = "split", min_precision: float | None = None
) -> DataFrame:
    """Thresholds chosen on ``valid``, rates on ``test``:
    ``label, threshold, precision, recall, f1``."""
    chosen = best_thresholds(df.filter(F.col(split_col) == "valid"), pairs, min_precision)
    thresholds = {row["label"]: row["threshold"] for row in chosen.collect()}
    rates = rates_by_label(df.filter(F.col(split_col) == "test"), pairs, thresholds)
    cut = F.create_map(*[F.lit(v) for pair in thresholds.items() for v in pair])
    return rates.select("label", cut[F.col("label")].alias("threshold"), "precision", "recall", "f1")


def error_table(df: DataFrame, pairs: Pairs, thresholds: dict[str, float]) -> DataFrame:
    """Adds per label the prediction, truth, error, four flags, and the distance
    of the score to the threshold."""
    predicted, judged = {}, {}
    for label, (truth, score) in pairs.items():
        cut = F.lit(float(thresholds[label]))
        predicted[f"pred_{label}"] = (F.col(score) >= cut).cast("int")
        predicted[f"true_{label}"] = F.col(truth).cast("int")
        predicted[f"distance_to_threshold_{label}"] = F.abs(F.col(score) - cut)
        pred, true = F.col(f"pred_{label}"), F.col(f"true_{label}")
        judged[f"error_{label}"] = pred - true
        judged[f"is_fp_{label}"] = (pred == 1) & (true == 0)
        judged[f"is_fn_{label}"] = (pred == 0) & (true == 1)
        judged[f"is_tp_{label}"] = (pred == 1) & (true == 1)
        judged[f"is_tn_{label}"] = (pred == 0) & (true == 0)
    return df.withColumns(predicted).withColumns(judged)


def browse_errors(errors: DataFrame, label: str, kind: str, id_col: str, n: int = 20) -> DataFrame:
    """The ``n`` rows of one kind (fp, fn, tp, tn) nearest to the threshold."""
    return (
        errors.filter(F.col(f"is_{kind}_{label}"))
        .orderBy(f"distance_to_threshold_{label}", id_col)
        .limit(n)
    )


def weighted_bce(
    df: DataFrame, logits: Pairs, weights: dict[str, float] | None = None
) -> DataFrame:
    """``loss``: mean binary cross-entropy of logits over rows and labels, the
    positive term weighted per label."""
    losses = []
    for label, (truth, logit) in logits.items():
        x, y = F.col(logit), F.col(truth)
        weight = F.lit(1.0 if weights is None else float(weights[label]))
        # log(1 + exp(-x)) without overflow, for the positive term; the negative
        # term is the same plus x.
        softplus = F.log1p(F.exp(-F.abs(x))) + F.greatest(-x, F.lit(0.0))
        losses.append(weight * y * softplus + (1 - y) * (softplus + x))
    return df.agg(F.avg(sum(losses[1:], losses[0]) / len(losses)).alias("loss"))


def probabilities(df: DataFrame, logit_cols: dict[str, str], clip: float | None = 50.0) -> DataFrame:
    """Adds ``proba_<label>`` from logits."""
    return df.withColumns(
        {f"proba_{label}": sigmoid(F.col(col), clip) for label, col in logit_cols.items()}
    )
