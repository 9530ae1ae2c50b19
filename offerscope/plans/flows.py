"""End-to-end flows over tables of offers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from offerscope.functions import text as X
from offerscope.operators import boilerplate as B
from offerscope.operators import metrics as M
from offerscope.operators.annotation import Annotator, run_annotation
from offerscope.operators.pca import reduce_vectors
from offerscope.operators.quality import coerce_labels
from offerscope.operators.sampling import split_train_valid_test, stratified_sample
from offerscope.operators.scoring import LabelModel, apply_thresholds, embed_by_words, select_label_model
from offerscope.session import materialize
from offerscope.sources.tables import table_as_mapping


def clean_titles(
    offers: DataFrame, title_col: str, word: str = "stage", out_col: str = "job_title_clean", seen: Observation | None = None
) -> DataFrame:
    """Adds the clean title and leaves out titles that hold ``word``. ``seen``
    receives ``n_rows`` and ``n_removed`` when the result is computed."""
    titled = offers.withColumn(out_col, X.clean_title(F.col(title_col)))
    unwanted = X.has_word(F.col(out_col), word)
    if seen is not None:
        titled = titled.observe(
            seen, F.count("*").alias("n_rows"), F.count_if(unwanted).alias("n_removed")
        )
    return titled.filter(~unwanted)


def clean_descriptions(
    offers: DataFrame, id_col: str, text_col: str, firm_col: str, **rule
) -> DataFrame:
    """Adds ``description_clean`` without the firm's repeated sentences."""
    segmented = B.segment_offers(offers, id_col, text_col, firm_col, keep_row=True)
    return B.remove_boilerplate(segmented, B.learn_boilerplate(segmented, **rule))


def clean_and_embed(
    offers: DataFrame,
    id_col: str,
    text_col: str,
    firm_col: str,
    embed: Callable[[DataFrame, str], DataFrame] = embed_by_words,
    **rule,
) -> DataFrame:
    """Clean text, ``embedding`` and ``embedding_pca``. The embedded table is
    stored before the components are fitted."""
    cleaned = clean_descriptions(offers, id_col, text_col, firm_col, **rule)
    return reduce_vectors(materialize(embed(cleaned, "description_clean"), "embedded"), "embedding")


def sample_and_annotate(
    offers: DataFrame,
    n: int,
    id_col: str,
    text_col: str,
    code_col: str,
    annotate: Annotator,
    store_path: str,
    labels: list[str],
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    sample = materialize(
        stratified_sample(offers, n, id_col, text_col, code_col, seed=seed), "annotation-sample"
    )
    return run_annotation(sample, id_col, text_col, annotate, store_path, labels)


def training_table(annotated: DataFrame, id_col: str, text_col: str, labels: list[str]) -> DataFrame:
    """Labelled offers with text: ``offer_id, text, n_tokens``, labels, ``split``."""
    text = X.minimal_clean(F.col(text_col))
    kept = (
        coerce_labels(annotated, labels)
        .filter(X.has_text(F.col(text_col)))
        .select(F.col(id_col).alias("offer_id"), text.alias("text"), *labels)
        .withColumn("n_tokens", X.word_count(F.col("text")))
    )
    return split_train_valid_test(kept, "offer_id", labels)


def train_and_evaluate(
    table: DataFrame, labels: list[str], min_precision: float | None = None, regularisations=(0.01, 0.1)
) -> tuple[LabelModel, dict[str, float], DataFrame]:
    """The model chosen on ``valid``, its thresholds, and the rates on ``test``."""
    part = {name: table.filter(F.col("split") == name) for name in ("train", "valid", "test")}
    model = select_label_model(part["train"], part["valid"], "text", labels, list(regularisations))
    pairs = {label: (label, f"proba_{label}") for label in labels}
    tuned = M.best_thresholds(model.score(part["valid"], "text"), pairs, min_precision)
    thresholds = table_as_mapping(tuned, "label", "threshold")
    return model, thresholds, M.rates_by_label(model.score(part["test"], "text"), pairs, thresholds)


def score_table(
    offers: DataFrame, text_col: str, model: LabelModel, thresholds: dict[str, float]
) -> DataFrame:
    """``proba_`` and ``pred_`` columns for every offer, in one narrow pass."""
    if text_col not in offers.columns:
        raise ValueError(f"no column {text_col}; there are {offers.columns}")
    return apply_thresholds(model.score(offers, text_col), model.labels, thresholds)
