"""Embedding, scoring and a trainable multi-label text model."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerscope.functions import text as X
from offerscope.operators import linear
from offerscope.operators.metrics import macro_ranking_quality, ranking_quality
from offerscope.operators.quality import class_weights
from offerscope.session import materialize

# Rows per model call when embedding and when scoring.
EMBED_BATCH = 64
SCORE_BATCH = 16
WORD_BREAK = r"[^\p{L}\p{N}]+"


# --- a caller's model -------------------------------------------------------------------


def model_column(make_predict: Callable, text: Column, batch_size: int) -> Column:
    """``array<float>`` per text from a model that is built once per worker.

    ``make_predict`` returns a function from an array of texts to a matrix.
    """
    call = predict_batch_udf(
        make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size
    )
    return call(text)


def embed_texts(
    df: DataFrame, text_col: str, make_predict: Callable, out_col: str = "embedding", batch_size: int = EMBED_BATCH
) -> DataFrame:
    """Unit-length embeddings from a caller's model."""
    from offerscope.functions.vectors import unit_or_zero

    text = F.coalesce(F.col(text_col), F.lit(""))
    embedded = df.withColumn(out_col, model_column(make_predict, text, batch_size))
    return embedded.withColumn(out_col, unit_or_zero(F.col(out_col)).cast("array<float>"))


def score_texts(
    df: DataFrame, text_col: str, make_predict: Callable, labels: list[str], batch_size: int = SCORE_BATCH
) -> DataFrame:
    """Adds ``proba_<label>`` from a caller's model over cleaned text. Empty texts
    are scored too. A model of another width is an error."""
    scored = df.withColumn(
        "_proba", model_column(make_predict, X.minimal_clean(F.col(text_col)), batch_size)
    )
    return _spread_scores(scored, labels)


def _spread_scores(scored: DataFrame, labels: list[str]) -> DataFrame:
    width = F.size("_proba")
    checked = F.when(width == len(labels), F.col("_proba")).otherwise(
        F.raise_error(F.concat(F.lit(f"{len(labels)} labels, but the model gives "), width.cast("string")))
    )
    return scored.withColumn("_proba", checked).withColumns(
        {f"proba_{label}": F.col("_proba")[i] for i, label in enumerate(labels)}
    ).drop("_proba")


def apply_thresholds(df: DataFrame, labels: list[str], thresholds: dict[str, float]) -> DataFrame:
    """Adds ``pred_<label>``: 1 where ``proba_<label>`` reaches its threshold."""
    missing = [label for label in labels if label not in thresholds]
    if missing:
        raise ValueError(f"no threshold for {missing}")
    return df.withColumns(
        {
            f"pred_{label}": (F.col(f"proba_{label}") >= F.lit(float(thresholds[label]))).cast("int")
            for label in labels
        }
    )


def best_class(scores: Column, classes: list[str]) -> Column:
    """``struct<label, score>`` of the highest score, the first on ties."""
    top = F.array_max(scores)
    place = F.array_position(scores, top).cast("int")
    return F.struct(
        F.element_at(F.array(*[F.lit(c) for c in classes]), place).alias("label"), top.alias("score")
    )


# --- built-in features -------------------------------------------------------------------


def _text_features(text_col: str, out_col: str, dims: int, min_docs: int = 0) -> list:
    return [
        RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=WORD_BREAK, minTokenLength=1),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dims),
        IDF(inputCol="_counts", outputCol="_weighted", minDocFreq=min_docs),
        Normalizer(inputCol="_weighted", outputCol=out_col, p=2.0),
    ]


def embed_by_words(df: DataFrame, text_col: str, dims: int = 256, out_col: str = "embedding") -> DataFrame:
    """Unit-length hashed word weights as ``array<float>``; empty texts give zeros."""
    clean = df.withColumn("_text", X.minimal_clean(F.col(text_col)))
    model = Pipeline(stages=_text_features("_text", "_unit", dims)).fit(clean)
    return (
        model.transform(clean)
        .withColumn(out_col, vector_to_array("_unit", "float32"))
        .drop("_text", "_words", "_counts", "_weighted", "_unit")
    )


class LabelModel:
    """Word features with a weighted logistic regression per label."""

    def __init__(self, features: PipelineModel, weights: dict[str, linear.Weights]):
        self.features = features
        self.weights = weights

    @property
    def labels(self) -> list[str]:
        return list(self.weights)

    def score(self, df: DataFrame, text_col: str) -> DataFrame:
        """Adds ``proba_<label>``; a narrow pass over the table, all labels at once."""
        weights = list(self.weights.values())

        @F.arrow_udf("array<double>")
        def probabilities(places: pa.Array, values: pa.Array) -> pa.Array:
            rows = linear.sparse_rows(places, values)
            margins = [rows.times(coefficients) + intercept for intercept, coefficients in weights]
            return pa.array(list(linear.probability(np.stack(margins, axis=1))), pa.list_(pa.float64()))

        scored = self.features.transform(df.withColumn("_text", X.minimal_clean(F.col(text_col))))
        scored = scored.withColumn("_proba", probabilities(*linear.sparse_parts(F.col("_features"))))
        return _spread_scores(scored, self.labels).drop("_text", "_words", "_counts", "_weighted", "_features")

    def save(self, path: str) -> None:
        self.features.write().overwrite().save(f"{path}/features")
        rows = [(label, w.intercept, w.coefficients.tolist()) for label, w in self.weights.items()]
        schema = "label string, intercept double, coefficients array<double>"
        spark = SparkSession.getActiveSession()
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/weights")

    @classmethod
    def load(cls, path: str, labels: list[str]) -> LabelModel:
        rows = SparkSession.getActiveSession().read.parquet(f"{path}/weights").collect()
        held = {row["label"]: linear.Weights(row["intercept"], np.array(row["coefficients"])) for row in rows}
        missing = [label for label in labels if label not in held]
        if missing:
            raise ValueError(f"the model has no label {missing}")
        return cls(PipelineModel.load(f"{path}/features"), {label: held[label] for label in labels})


def train_label_models(
    train: DataFrame,
    text_col: str,
    labels: list[str],
    regularisations: list[float],
    dims: int = 4096,
    weighted: bool = True,
    iterations: int = 100,
    tolerance: float = 1e-6,
) -> list[LabelModel]:
    """A model per penalty. All labels and penalties are fitted in the same passes over
    the stored features."""
    clean = train.withColumn("_text", X.minimal_clean(F.col(text_col)))
    words, *rest = _text_features("_text", "_features", dims)
    counted = PipelineModel([words, rest[0]]).transform(clean)
    # texts are cut into words once; their counts serve the document frequencies and the features
    counted = materialize(counted.select("_counts", *labels), "word-counts")
    weighted_features = Pipeline(stages=rest[1:]).fit(counted)
    features = PipelineModel([words, rest[0], *weighted_features.stages])
    table = linear.training_table(weighted_features.transform(counted), "_features", labels)
    marks = train.select(*labels)
    weights = {r["label"]: r["pos_weight"] for r in class_weights(marks, labels).collect()} if weighted else {}
    problems = [
        linear.Problem(i, weights.get(label, 1.0), value) for value in regularisations for i, label in enumerate(labels)
    ]
    found, _ = linear.fit(table, problems, dims, iterations, tolerance)
    width = len(labels)
    return [
        LabelModel(features, dict(zip(labels, found[at : at + width]))) for at in range(0, len(found), width)
    ]


def train_label_model(
    train: DataFrame, text_col: str, labels: list[str], regularisation: float = 0.01, **settings
) -> LabelModel:
    """All labels on the same features; ``settings`` as in ``train_label_models``."""
    return train_label_models(train, text_col, labels, [regularisation], **settings)[0]


def select_label_model(
    train: DataFrame,
    valid: DataFrame,
    text_col: str,
    labels: list[str],
    regularisations: list[float],
    **settings,
) -> LabelModel:
    """The model with the best mean average precision on ``valid``, the first of equals."""
    best, best_quality = None, -np.inf
    for model in train_label_models(train, text_col, labels, regularisations, **settings):
        pairs = {label: (label, f"proba_{label}") for label in labels}
        quality = macro_ranking_quality(ranking_quality(model.score(valid, text_col), pairs)).first()
        ap = quality["ap_macro"] if quality["ap_macro"] is not None else -np.inf
        if best is None or ap > best_quality:
            best, best_quality = model, ap
    return best
