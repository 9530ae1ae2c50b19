"""Queries over samples, labels, scores and their evaluation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from offerscope.functions import text as X
from offerscope.operators import metrics as M
from offerscope.operators import quality as Q
from offerscope.operators import sampling as S
from offerscope.operators.scoring import (
    apply_thresholds,
    best_class,
    score_texts,
    train_label_model,
)
from offerscope.plans.inputs import (
    DOMAIN,
    LABELLED,
    LABELS,
    LONG_SCORES,
    OFFERS,
    PAIRS,
    SCORED,
    documents,
    labelled,
    offers,
    scored,
)
from offerscope.plans.registry import query
from offerscope.plans.text_queries import _CLEAN
from offerscope.session import scratch_path
from offerscope.sources.tables import (
    load_splits,
    load_table,
    read_artefact,
    save_splits,
    table_as_mapping,
    write_artefact,
)

_MARKS = {"quality": 0.5, "toxic": 0.6}


def _labels(spark, sf_dir):
    return load_table(spark, f"{sf_dir}/labels.parquet")


# --- samples and splits ------------------------------------------------------------------------


@query(
    """SELECT doc_id, lang FROM (SELECT *, row_number() OVER (ORDER BY md5('42|' || doc_id)) AS r FROM documents)
       WHERE r <= (SELECT round_even(CAST(0.1 AS DOUBLE) * count(*), 0) FROM documents)"""
)
def sample_fraction(spark, sf_dir):
    table = load_table(spark, f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    return S.sample_fraction(table, 0.1, "doc_id")


_SAMPLE = f"""{OFFERS},
valid AS (SELECT *, {DOMAIN} AS rome_domain FROM offers WHERE length(coalesce(text, '')) >= 100),
strata AS (SELECT rome_domain, count(*) AS c, least(5, count(*)) AS q FROM valid GROUP BY 1),
spare AS (SELECT 100 - sum(q) AS s, sum(c) AS total FROM strata),
shared AS (SELECT rome_domain, c, q + least(CAST(floor(s * (c / CAST(total AS DOUBLE))) AS BIGINT), c - q) AS q FROM strata, spare),
quotas AS (
  SELECT rome_domain, CASE WHEN row_number() OVER (ORDER BY c DESC, rome_domain) = 1
                           THEN greatest(0, q + 100 - sum(q) OVER ()) ELSE q END AS quota FROM shared),
sample AS (
  SELECT * FROM (SELECT v.*, quota, row_number() OVER (PARTITION BY rome_domain ORDER BY md5('42|' || doc_id)) AS r
                 FROM valid v JOIN quotas USING (rome_domain)) WHERE r <= quota)"""


@query(f"WITH {_SAMPLE} SELECT doc_id, rome_domain FROM sample")
def stratified_sample(spark, sf_dir):
    sample = S.stratified_sample(offers(spark, sf_dir), 100, "doc_id", "text", "occ")
    return sample.select("doc_id", "rome_domain")


@query(
    f"""WITH {_SAMPLE} SELECT rome_domain, count(*) AS n,
          round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 6) AS pct FROM sample GROUP BY 1"""
)
def sample_distribution(spark, sf_dir):
    sample = S.stratified_sample(offers(spark, sf_dir), 100, "doc_id", "text", "occ")
    return S.stratum_distribution(sample, "rome_domain").withColumn("pct", F.round("pct", 6))


def _split(table: str, pattern: str) -> str:
    return f"""patterned AS (SELECT *, {pattern} AS pattern FROM {table}),
placed AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY pattern) < 20 THEN 'rare' ELSE pattern END AS stratum FROM patterned),
ranks AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('42|' || doc_id)) AS r,
                 count(*) OVER (PARTITION BY stratum) AS m FROM placed),
cuts AS (SELECT *, m - CAST(round_even(CAST(0.3 AS DOUBLE) * m, 0) AS BIGINT) AS a FROM ranks),
split AS (SELECT *, CASE WHEN r <= a THEN 'train'
                         WHEN r <= a + CAST(round_even((m - a) / CAST(2 AS DOUBLE), 0) AS BIGINT) THEN 'valid' ELSE 'test' END AS split
          FROM cuts)"""


_STRATA = "CAST(quality AS VARCHAR) || CAST(toxic AS VARCHAR)"


@query(f"WITH {_split('labels', _STRATA)} SELECT doc_id, quality, toxic, split FROM split")
def label_split(spark, sf_dir):
    return S.split_train_valid_test(_labels(spark, sf_dir), "doc_id", LABELS)


@query(f"WITH {_split('labels', _STRATA)} SELECT doc_id, quality, toxic, split FROM split WHERE split IN ('valid', 'test')")
def split_read_back(spark, sf_dir):
    """The splits stored in folders, and two of them read back."""
    table = S.split_train_valid_test(_labels(spark, sf_dir), "doc_id", LABELS)
    path = scratch_path(spark, "splits")
    save_splits(table, path)
    return load_splits(spark, path, table.schema, ["valid", "test"])


_ALL_ROWS = "'all'"


@query(f"WITH {_split('labels', _ALL_ROWS)} SELECT doc_id, quality, toxic, split FROM split")
def random_split(spark, sf_dir):
    return S.split_train_valid_test(_labels(spark, sf_dir), "doc_id", LABELS, stratify=False)


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('0|' || doc_id)) - 1 AS row_id FROM documents")
def dense_row_id(spark, sf_dir):
    return S.dense_row_id(load_table(spark, f"{sf_dir}/documents.parquet").select("doc_id"), "doc_id")


# --- label reports -------------------------------------------------------------------------------


@query(
    f"""WITH {OFFERS}, {LABELLED} SELECT doc_id, CAST(quality AS INTEGER) AS quality, CAST(toxic AS INTEGER) AS toxic
        FROM labelled WHERE quality IS NOT NULL AND toxic IS NOT NULL"""
)
def labels_coerced(spark, sf_dir):
    return Q.coerce_labels(labelled(spark, sf_dir).select("doc_id", *LABELS), LABELS)


@query(
    """SELECT 'quality' AS label, CAST(sum(quality) AS BIGINT) AS n_positive, round(avg(quality), 6) AS prevalence FROM labels
       UNION ALL SELECT 'toxic', CAST(sum(toxic) AS BIGINT), round(avg(toxic), 6) FROM labels"""
)
def label_prevalence(spark, sf_dir):
    return Q.label_prevalence(_labels(spark, sf_dir), LABELS).withColumn("prevalence", F.round("prevalence", 6))


@query(
    f"""WITH {_split('labels', _STRATA)}
        SELECT split, 'quality' AS label, CAST(sum(quality) AS BIGINT) AS n_positive, round(avg(quality), 6) AS prevalence FROM split GROUP BY split
        UNION ALL SELECT split, 'toxic', CAST(sum(toxic) AS BIGINT), round(avg(toxic), 6) FROM split GROUP BY split"""
)
def prevalence_by_split(spark, sf_dir):
    split = S.split_train_valid_test(_labels(spark, sf_dir), "doc_id", LABELS)
    return Q.label_prevalence(split, LABELS, by="split").withColumn("prevalence", F.round("prevalence", 6))


def _per_label(select: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS label, {select.format(l=label)} FROM {source}" for label in LABELS
    )


@query(
    f"""WITH {OFFERS}, {LABELLED}, complete AS (SELECT * FROM labelled WHERE quality IS NOT NULL AND toxic IS NOT NULL)
        {_per_label("CAST(sum({l}) AS BIGINT) AS n_1, round(avg({l}) * 100, 6) AS pct_1, CAST(sum(1 - {l}) AS BIGINT) AS n_0, round(avg(1 - {l}) * 100, 6) AS pct_0", "complete")}"""
)
def label_qc(spark, sf_dir):
    table = Q.label_table(labelled(spark, sf_dir), LABELS)
    return table.withColumns({c: F.round(c, 6) for c in ("pct_1", "pct_0")})


@query(
    """SELECT count(*) AS n_rows, count(*) FILTER (quality + toxic = 0) AS n_zero,
              round(count(*) FILTER (quality + toxic = 0) / CAST(count(*) AS DOUBLE) * 100, 6) AS pct_zero FROM labels"""
)
def label_no_positive(spark, sf_dir):
    return Q.rows_without_positive(labelled(spark, sf_dir), LABELS).withColumn("pct_zero", F.round("pct_zero", 6))


_THREE = ["quality", "toxic", "long"]
_LONG = "(SELECT l.*, CAST(d.n_chars > 2000 AS INTEGER) AS long FROM labels l JOIN documents d USING (doc_id))"


@query(
    f"""SELECT 'quality' AS label_a, 'toxic' AS label_b, count(*) FILTER (quality = 1 AND toxic = 1) AS n_both FROM {_LONG}
        UNION ALL SELECT 'quality', 'long', count(*) FILTER (quality = 1 AND long = 1) FROM {_LONG}
        UNION ALL SELECT 'toxic', 'long', count(*) FILTER (toxic = 1 AND long = 1) FROM {_LONG}"""
)
def label_cooccurrence(spark, sf_dir):
    table = labelled(spark, sf_dir).withColumn("long", (F.col("n_chars") > 2000).cast("int"))
    return Q.cooccurrence(table, _THREE)


@query(
    f"""WITH {OFFERS}, {LABELLED} SELECT {DOMAIN} AS rome_domain, count(*) AS n_offers,
          round((avg(quality) + avg(toxic)) / 2 * 100, 6) AS mean_positive_pct
        FROM labelled WHERE quality IS NOT NULL GROUP BY 1"""
)
def qc_by_domain(spark, sf_dir):
    table = labelled(spark, sf_dir).withColumn("rome_domain", X.occupation_domain(F.col("occ")))
    return Q.domain_rates(table, LABELS, "rome_domain").withColumn(
        "mean_positive_pct", F.round("mean_positive_pct", 6)
    )


@query(
    "SELECT count(*) AS n_rows, count(DISTINCT l.doc_id) AS n_annotated, count(*) FILTER (l.quality IS NULL) AS n_unlabelled "
    "FROM documents d LEFT JOIN labels l USING (doc_id)"
)
def annotation_counts(spark, sf_dir):
    return Q.annotation_counts(labelled(spark, sf_dir), "doc_id", LABELS)


@query(_per_label("round(least(greatest((count(*) - sum({l})) / CAST(greatest(sum({l}), 1) AS DOUBLE), 1), 10), 6) AS pos_weight", "labels"))
def class_weights(spark, sf_dir):
    return Q.class_weights(_labels(spark, sf_dir), LABELS).withColumn("pos_weight", F.round("pos_weight", 6))


# --- scores ------------------------------------------------------------------------------------------


@query(
    f"""WITH {SCORED} SELECT doc_id, proba_quality, proba_toxic, CAST(proba_quality >= 0.5 AS INTEGER) AS pred_quality,
          CAST(proba_toxic >= 0.6 AS INTEGER) AS pred_toxic FROM scored"""
)
def score_apply(spark, sf_dir):
    return apply_thresholds(scored(spark, sf_dir).drop(*LABELS), LABELS, _MARKS)


@query(
    f"""WITH {SCORED} SELECT doc_id, round(1 / (1 + exp(-least(greatest((proba_quality - 0.5) * 200, -50), 50))), 6) AS proba_quality,
          round(1 / (1 + exp(-least(greatest((proba_toxic - 0.5) * 200, -50), 50))), 6) AS proba_toxic FROM scored"""
)
def logit_probabilities(spark, sf_dir):
    logits = scored(spark, sf_dir).withColumns(
        {f"x_{label}": (F.col(f"proba_{label}") - 0.5) * 200 for label in LABELS}
    )
    result = M.probabilities(logits, {label: f"x_{label}" for label in LABELS})
    return result.select("doc_id", *[F.round(f"proba_{label}", 6).alias(f"proba_{label}") for label in LABELS])


@query(
    f"""WITH {SCORED} SELECT doc_id, CASE WHEN proba_quality >= proba_toxic THEN 'quality' ELSE 'toxic' END AS label,
          greatest(proba_quality, proba_toxic) AS score FROM scored"""
)
def best_section_class(spark, sf_dir):
    scores = F.array(*[F.col(f"proba_{label}") for label in LABELS])
    return scored(spark, sf_dir).select("doc_id", best_class(scores, LABELS).alias("b")).select("doc_id", "b.*")


def _counts(cut: str, source: str = "long_scores") -> str:
    return f"""counts AS (SELECT label, count(*) FILTER (y = 1 AND score >= {cut}) AS tp, count(*) FILTER (y = 0 AND score >= {cut}) AS fp,
  count(*) FILTER (y = 1 AND score < {cut}) AS fn, count(*) FILTER (y = 0 AND score < {cut}) AS tn FROM {source} GROUP BY label)"""


_CUT = "CASE label WHEN 'quality' THEN 0.5 ELSE 0.6 END"


def _rates(tp="tp", fp="fp", fn="fn") -> str:
    return f"""round(CASE WHEN {tp} + {fp} = 0 THEN 0 ELSE {tp} / CAST({tp} + {fp} AS DOUBLE) END, 6) AS precision,
  round(CASE WHEN {tp} + {fn} = 0 THEN 0 ELSE {tp} / CAST({tp} + {fn} AS DOUBLE) END, 6) AS recall,
  round(CASE WHEN 2 * {tp} + {fp} + {fn} = 0 THEN 0 ELSE 2 * {tp} / CAST(2 * {tp} + {fp} + {fn} AS DOUBLE) END, 6) AS f1"""


def _rounded(frame, *columns):
    return frame.withColumns({c: F.round(c, 6) for c in columns})


@query(f"WITH {SCORED}, {LONG_SCORES}, {_counts(_CUT)} SELECT * FROM counts")
def confusion_counts(spark, sf_dir):
    return M.confusion(scored(spark, sf_dir), PAIRS, _MARKS)


@query(f"WITH {SCORED}, {LONG_SCORES}, {_counts(_CUT)} SELECT label, {_rates()} FROM counts")
def prf_by_label(spark, sf_dir):
    return _rounded(M.rates_by_label(scored(spark, sf_dir), PAIRS, _MARKS), "precision", "recall", "f1")


@query(
    f"""WITH {SCORED}, {LONG_SCORES}, {_counts('0.5')}, rates AS (SELECT label, {_rates()} FROM counts),
        pooled AS (SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM counts)
        SELECT p.precision AS precision_micro, p.recall AS recall_micro, p.f1 AS f1_micro, (SELECT round(avg(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE)), 6) FROM counts) AS f1_macro
        FROM (SELECT {_rates()} FROM pooled) p"""
)
def prf_micro_macro(spark, sf_dir):
    rates = M.pooled_rates(scored(spark, sf_dir), PAIRS, 0.5)
    return _rounded(rates, "precision_micro", "recall_micro", "f1_micro", "f1_macro")


_RANKING = """totals AS (SELECT label, sum(y) AS p, sum(1 - y) AS n FROM long_scores GROUP BY label),
by_score AS (SELECT label, score, sum(y) AS pos, sum(1 - y) AS neg FROM long_scores GROUP BY label, score),
above AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM by_score WINDOW w AS (PARTITION BY label ORDER BY score DESC)),
quality AS (
  SELECT label, sum(pos * (n - fp + neg / 2.0)) / CAST(any_value(p) * any_value(n) AS DOUBLE) AS auc,
         sum(pos / CAST(p AS DOUBLE) * tp / (tp + fp)) AS ap
  FROM above JOIN totals USING (label) GROUP BY label)"""


@query(f"WITH {SCORED}, {LONG_SCORES}, {_RANKING} SELECT label, round(auc, 6) AS auc, round(ap, 6) AS ap FROM quality")
def auc_ap_by_label(spark, sf_dir):
    return _rounded(M.ranking_quality(scored(spark, sf_dir), PAIRS), "auc", "ap")


@query(f"WITH {SCORED}, {LONG_SCORES}, {_RANKING} SELECT round(avg(auc), 6) AS auc_macro, round(avg(ap), 6) AS ap_macro FROM quality")
def auc_ap_macro(spark, sf_dir):
    macro = M.macro_ranking_quality(M.ranking_quality(scored(spark, sf_dir), PAIRS))
    return _rounded(macro, "auc_macro", "ap_macro")


_GRID = f"grid AS (SELECT CAST(unnest([{', '.join(map(repr, M.THRESHOLDS))}]) AS DOUBLE) AS threshold)"


def _curve(source: str) -> str:
    return f"""{_GRID},
swept AS (SELECT label, threshold, count(*) FILTER (y = 1 AND score >= threshold) AS tp, count(*) FILTER (y = 0 AND score >= threshold) AS fp,
  count(*) FILTER (y = 1 AND score < threshold) AS fn FROM {source}, grid GROUP BY label, threshold),
curve AS (SELECT label, threshold, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1 FROM swept)"""


@query(
    f"""WITH {SCORED}, {LONG_SCORES}, {_curve('long_scores')} SELECT label, threshold, round(precision, 6) AS precision,
          round(recall, 6) AS recall, round(f1, 6) AS f1 FROM curve"""
)
def threshold_curve(spark, sf_dir):
    return _rounded(M.threshold_curve(scored(spark, sf_dir), PAIRS), "precision", "recall", "f1")


@query(
    f"""WITH {SCORED}, {LONG_SCORES}, {_curve('long_scores')}
        SELECT label, threshold FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY f1 DESC, threshold) AS r FROM curve) WHERE r = 1"""
)
def best_thresholds(spark, sf_dir):
    return M.best_thresholds(scored(spark, sf_dir), PAIRS)


@query(
    f"""WITH {SCORED}, {LONG_SCORES}, {_curve('long_scores')}
        SELECT label, threshold FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY f1 DESC, threshold) AS r FROM curve) WHERE r = 1"""
)
def thresholds_artefact(spark, sf_dir):
    """The best thresholds kept as a JSON artefact and read back."""
    path = scratch_path(spark, "thresholds") + ".json"
    write_artefact(spark, table_as_mapping(M.best_thresholds(scored(spark, sf_dir), PAIRS), "label", "threshold"), path)
    return spark.createDataFrame(sorted(read_artefact(spark, path).items()), "label string, threshold double")


@query(
    f"""WITH {SCORED}, {LONG_SCORES}, {_curve('long_scores')},
        fit AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY recall DESC, threshold) AS r FROM curve WHERE precision >= 0.75)
        SELECT l.label, coalesce(f.threshold, 0.5) AS threshold FROM (SELECT DISTINCT label FROM long_scores) l
        LEFT JOIN fit f ON f.label = l.label AND f.r = 1"""
)
def best_thresholds_at_precision(spark, sf_dir):
    return M.best_thresholds(scored(spark, sf_dir), PAIRS, min_precision=0.75)


@query(
    f"""WITH {SCORED}, {_split('scored', _STRATA)},
        parts AS (SELECT split, 'quality' AS label, quality AS y, proba_quality AS score FROM split
                  UNION ALL SELECT split, 'toxic', toxic, proba_toxic FROM split),
        chosen_on AS (SELECT * FROM parts WHERE split = 'valid'), {_curve('chosen_on')},
        best AS (SELECT label, threshold FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY f1 DESC, threshold) AS r FROM curve) WHERE r = 1),
        held AS (SELECT p.*, b.threshold FROM parts p JOIN best b USING (label) WHERE split = 'test'),
        {_counts('threshold', 'held')}
        SELECT label, threshold, {_rates()} FROM counts JOIN best USING (label)"""
)
def test_at_valid_thresholds(spark, sf_dir):
    split = S.split_train_valid_test(scored(spark, sf_dir), "doc_id", LABELS)
    return _rounded(M.evaluate_held_out(split, PAIRS), "precision", "recall", "f1")


def _judged(label: str, cut: float) -> str:
    p, y = f"CAST(proba_{label} >= {cut} AS INTEGER)", f"CAST({label} AS INTEGER)"
    return f"""{p} AS pred_{label}, {y} AS true_{label}, {p} - {y} AS error_{label},
  {p} = 1 AND {y} = 0 AS is_fp_{label}, {p} = 0 AND {y} = 1 AS is_fn_{label}, {p} = 1 AND {y} = 1 AS is_tp_{label},
  {p} = 0 AND {y} = 0 AS is_tn_{label}, round(abs(proba_{label} - {cut}), 6) AS distance_to_threshold_{label}"""


_ERRORS = f"errors AS (SELECT doc_id, {_judged('quality', 0.5)}, {_judged('toxic', 0.6)} FROM scored)"


def _errors(spark, sf_dir):
    errors = M.error_table(scored(spark, sf_dir), PAIRS, _MARKS)
    errors = errors.drop(*LABELS, *[f"proba_{label}" for label in LABELS])
    return _rounded(errors, *[f"distance_to_threshold_{label}" for label in LABELS])


@query(f"WITH {SCORED}, {_ERRORS} SELECT * FROM errors")
def error_table(spark, sf_dir):
    return _errors(spark, sf_dir)


@query(
    f"""WITH {SCORED}, {_ERRORS} SELECT doc_id, distance_to_threshold_quality FROM errors WHERE is_fp_quality
        ORDER BY distance_to_threshold_quality, doc_id LIMIT 20"""
)
def ambiguous_errors(spark, sf_dir):
    nearest = M.browse_errors(_errors(spark, sf_dir), "quality", "fp", "doc_id", 20)
    return nearest.select("doc_id", "distance_to_threshold_quality")


def _loss(label: str, weight: float) -> str:
    x = f"((proba_{label} - 0.5) * 10)"
    return f"({weight} * {label} * ln(1 + exp(-{x})) + (1 - {label}) * ln(1 + exp({x})))"


@query(f"WITH {SCORED} SELECT round(avg(({_loss('quality', 1.0)} + {_loss('toxic', 2.0)}) / 2), 6) AS loss FROM scored")
def bce_loss(spark, sf_dir):
    logits = scored(spark, sf_dir).withColumns(
        {f"x_{label}": (F.col(f"proba_{label}") - 0.5) * 10 for label in LABELS}
    )
    pairs = {label: (label, f"x_{label}") for label in LABELS}
    return _rounded(M.weighted_bce(logits, pairs, {"quality": 1.0, "toxic": 2.0}), "loss")


def make_letter_model():
    """A stand-in for a caller's model: the share of ``e``, and the length."""

    def predict(texts):
        sizes = np.array([max(len(t), 1) for t in texts], dtype=np.float64)
        share = np.array([t.count("e") for t in texts]) / sizes
        return np.column_stack([share, np.minimum(sizes / 5000, 1)]).astype(np.float32)

    return predict


@query(
    f"""SELECT doc_id, round(p1, 5) AS proba_quality, round(p2, 5) AS proba_toxic,
          CAST(p1 >= 0.125 AS INTEGER) AS pred_quality, CAST(p2 >= 0.25 AS INTEGER) AS pred_toxic
        FROM (SELECT doc_id, CAST(CAST((length(c) - length(replace(c, 'e', ''))) / CAST(greatest(length(c), 1) AS DOUBLE) AS FLOAT) AS DOUBLE) AS p1,
                     CAST(CAST(least(greatest(length(c), 1) / CAST(5000 AS DOUBLE), 1) AS FLOAT) AS DOUBLE) AS p2
              FROM (SELECT doc_id, {_CLEAN} AS c FROM documents))"""
)
def scores_by_model(spark, sf_dir):
    table = documents(spark, sf_dir).select("doc_id", "text")
    scored_table = score_texts(table, "text", make_letter_model, LABELS)
    applied = apply_thresholds(scored_table, LABELS, {"quality": 0.125, "toxic": 0.25})
    return applied.drop("text").withColumns(
        {f"proba_{label}": F.round(F.col(f"proba_{label}").cast("double"), 5) for label in LABELS}
    )


@query()
def classifier_scores(spark, sf_dir):
    """Every document scored by a model fitted on the labelled ones."""
    table = documents(spark, sf_dir).select("doc_id", "text")
    train = table.join(_labels(spark, sf_dir), "doc_id")
    return train_label_model(train, "text", LABELS).score(table, "text").drop("text")


_WEIGHT = "least(greatest((n - pos) / greatest(pos, 1.0), 1.0), 10.0)"


@query(
    f"""WITH c AS (
          SELECT 'quality' AS label, count(*) AS n, CAST(sum(quality) AS DOUBLE) AS pos FROM documents JOIN labels USING (doc_id)
          UNION ALL SELECT 'toxic', count(*), CAST(sum(toxic) AS DOUBLE) FROM documents JOIN labels USING (doc_id))
        SELECT label, n AS n_rows, CAST(pos AS BIGINT) AS n_positive,
               round(pos * {_WEIGHT} / (pos * {_WEIGHT} + n - pos), 4) AS mean_score FROM c"""
)
def classifier_calibration(spark, sf_dir):
    """Weighted mean score of the fitted rows. Where the solver has come to the optimum,
    the free intercept makes it the weighted share of positives."""
    train = documents(spark, sf_dir).select("doc_id", "text").join(_labels(spark, sf_dir), "doc_id")
    weights = Q.class_weights(train, LABELS).withColumnRenamed("label", "_label")
    scored = train_label_model(train, "text", LABELS).score(train, "text")
    rows = scored.select(
        F.explode(F.array(*[F.struct(F.lit(x).alias("label"), F.col(x).alias("y"), F.col(f"proba_{x}").alias("p")) for x in LABELS])).alias("s")
    ).select("s.*")
    rows = rows.join(F.broadcast(weights), F.col("label") == F.col("_label"))
    weight = F.when(F.col("y") == 1, F.col("pos_weight")).otherwise(F.lit(1.0))
    return rows.groupBy("label").agg(
        F.count("*").alias("n_rows"), F.sum("y").cast("long").alias("n_positive"),
        F.round(F.sum(weight * F.col("p")) / F.sum(weight), 4).alias("mean_score"),
    )
