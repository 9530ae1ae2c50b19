"""Queries over annotation batches, answers, stores and arriving offers."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerscope.operators import annotation as A
from offerscope.operators import quality as Q
from offerscope.operators import sampling as S
from offerscope.plans.inputs import LABELS, documents, labelled, offers
from offerscope.plans.label_queries import _SAMPLE
from offerscope.plans.registry import query
from offerscope.plans.text_queries import _CLEAN, _replaced
from offerscope.session import scratch_path
from offerscope.sources.tables import append_annotations, load_table, read_annotations
from offerscope.streaming.incremental import arriving_offers, process_arrivals, read_results

# Words of the test texts in place of job-advertisement terms.
_TERMS = {
    "remote_work": ["with", "dans"],
    "junior_offer": ["only", "nicht"],
    "experienced_offer": ["from", "pour", "is only"],
    "very_experienced_offer": ["license", "that"],
    "programming_skills": ["mit license", "apache license"],
}
_WORDS_SQL = "trim(" + _replaced(f"strip_accents(lower({_CLEAN}))", [(r"[^\p{L}\p{N}]+", " ")]) + ")"
_KEYWORDS = "keywords AS (SELECT doc_id, " + ", ".join(
    f"CAST(regexp_matches(words, '{A.term_pattern(terms)}') AS INTEGER) AS {label}" for label, terms in _TERMS.items()
) + f" FROM (SELECT doc_id, {_WORDS_SQL} AS words FROM documents))"

_BATCHES = """numbered AS (
  SELECT doc_id, lang, text, row_number() OVER (ORDER BY md5('0|' || doc_id)) - 1 AS row_id FROM documents),
batches AS (SELECT *, row_id // 5 AS batch_id FROM numbered)"""


@query(f"WITH {_KEYWORDS} SELECT * FROM keywords")
def keyword_labels(spark, sf_dir):
    return A.keyword_labels(documents(spark, sf_dir), "text", _TERMS).select("doc_id", *_TERMS)


@query(
    f"""WITH {_KEYWORDS}
        SELECT 'junior_and_experienced' AS rule, count(*) FILTER (junior_offer = 1 AND experienced_offer = 1) AS n_violations FROM keywords
        UNION ALL SELECT 'very_experienced_without_experienced',
          count(*) FILTER (very_experienced_offer = 1 AND experienced_offer = 0) FROM keywords"""
)
def label_rule_violations(spark, sf_dir):
    return Q.rule_violations(A.keyword_labels(documents(spark, sf_dir), "text", _TERMS))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_DEFINITIONS = {"quality": "le texte est soigné", "toxic": "le texte est blessant"}
_HEAD, _TAIL = A.prompt_frame(LABELS, _DEFINITIONS)


@query(
    f"""WITH {_BATCHES}
        SELECT batch_id, {_sql_text(_HEAD)} || string_agg(chr(10) || '[annonce ' || (row_id % 5 + 1) || ', id ' || doc_id || ']'
            || chr(10) || substr(text, 1, 5000) || chr(10), '' ORDER BY row_id) || chr(10) || {_sql_text(_TAIL)} AS prompt
        FROM batches GROUP BY batch_id"""
)
def annotation_prompts(spark, sf_dir):
    batches = A.make_batches(documents(spark, sf_dir), "doc_id", "text", max_chars=5000)
    return batches.select("batch_id", A.prompt_of(F.col("offers"), LABELS, _DEFINITIONS).alias("prompt"))


@query(
    f"""WITH {_BATCHES},
        joined AS (SELECT b.*, l.quality, l.toxic FROM batches b LEFT JOIN labels l USING (doc_id)),
        good AS (SELECT batch_id FROM joined GROUP BY batch_id HAVING count(*) FILTER (lang = 'es' AND quality IS NULL) = 0)
        SELECT batch_id, CAST(doc_id AS VARCHAR) AS id, CAST(coalesce(quality, 0) AS INTEGER) AS quality,
               CAST(coalesce(toxic, 0) AS INTEGER) AS toxic FROM joined JOIN good USING (batch_id)"""
)
def annotation_parse(spark, sf_dir):
    """Answers made from the labels, in the forms that answers take: text around
    the JSON, ids as numbers, truth values, nulls. Answers over unlabelled Spanish
    documents lack a label, which refuses their batch."""
    table = labelled(spark, sf_dir).select("doc_id", "lang", *LABELS)
    batches = A.make_batches(documents(spark, sf_dir), "doc_id", "text")
    members = batches.select("batch_id", F.posexplode("offers").alias("place", "o")).select(
        "batch_id", "place", F.col("o.id").alias("id")
    )
    number = F.when(F.col("lang") == "en", F.concat(F.lit('"'), "id", F.lit('"'))).otherwise(F.col("id"))
    toxic = F.when(F.col("quality").isNull(), F.lit("0")).otherwise((F.col("toxic") == 1).cast("string"))
    entry = F.concat(
        F.lit('{"id": '), number, F.lit(', "quality": '), F.coalesce(F.col("quality").cast("string"), F.lit("null")),
        F.when((F.col("lang") == "es") & F.col("quality").isNull(), F.lit("")).otherwise(F.concat(F.lit(', "toxic": '), toxic)),
        F.lit("}"),
    )
    answers = (
        members.join(table.withColumn("id", F.col("doc_id").cast("string")), "id")
        .groupBy("batch_id")
        .agg(F.array_sort(F.collect_list(F.struct("place", "id", entry.alias("entry")))).alias("m"))
        .select(
            "batch_id",
            F.col("m.id").alias("ids"),
            F.concat(F.lit('Voici : {"annotations": ['), F.array_join("m.entry", ", "), F.lit("]} fin.")).alias("response"),
        )
    )
    read = A.read_answers(answers, LABELS).filter(F.col("annotations").isNotNull())
    return read.select("batch_id", F.explode("annotations").alias("a")).select("batch_id", "a.*")


_ANSWER_TERMS = {"quality": ["that", "pour", "und"], "toxic": ["from", "dans", "nicht"]}


@query(
    "WITH words AS (SELECT doc_id, trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS w FROM documents) "
    "SELECT doc_id, "
    + ", ".join(
        f"CAST(coalesce(l.{label}, CAST(regexp_matches(w, '{A.term_pattern(t)}') AS INTEGER)) AS INTEGER) AS {label}"
        for label, t in _ANSWER_TERMS.items()
    )
    + " FROM words LEFT JOIN labels l USING (doc_id)"
)
def annotation_resume(spark, sf_dir):
    """A store that already holds the labelled documents; the rest is annotated."""
    store = scratch_path(spark, "annotations")
    done = load_table(spark, f"{sf_dir}/labels.parquet").withColumn("id", F.col("doc_id").cast("string"))
    append_annotations(done, store, LABELS)
    annotated, _ = A.run_annotation(
        documents(spark, sf_dir), "doc_id", "text", A.keyword_annotator(_ANSWER_TERMS), store, LABELS
    )
    return annotated.select("doc_id", *LABELS)


def _refusing(annotate: A.Annotator, word: str) -> A.Annotator:
    def refuse(offers: list[dict]) -> str | None:
        if any(word in offer["text"].lower() for offer in offers):
            raise ConnectionError("no answer")
        return annotate(offers)

    return refuse


@query(
    f"""WITH {_BATCHES},
        failed AS (SELECT DISTINCT batch_id FROM batches WHERE contains(lower(text), 'license'))
        SELECT CAST(doc_id AS VARCHAR) AS id FROM batches JOIN failed USING (batch_id)"""
)
def annotation_failed(spark, sf_dir):
    """Ids of the batches that an annotator refuses at every attempt."""
    annotate = _refusing(A.keyword_annotator(_ANSWER_TERMS), "license")
    store = scratch_path(spark, "annotations")
    _, failed = A.run_annotation(
        documents(spark, sf_dir), "doc_id", "text", annotate, store, LABELS, attempts=2, retry_delay=0
    )
    return failed


@query(
    f"""WITH {_SAMPLE} SELECT s.doc_id, CAST(l.quality AS INTEGER) AS quality, CAST(l.toxic AS INTEGER) AS toxic
        FROM sample s LEFT JOIN labels l USING (doc_id)"""
)
def annotation_recovered(spark, sf_dir):
    """A sample joined to a store in which later lines correct earlier ones."""
    store = scratch_path(spark, "annotations")
    done = load_table(spark, f"{sf_dir}/labels.parquet").withColumn("id", F.col("doc_id").cast("string"))
    append_annotations(done.withColumns({label: 1 - F.col(label) for label in LABELS}), store, LABELS)
    append_annotations(done, store, LABELS)
    sample = S.stratified_sample(offers(spark, sf_dir), 100, "doc_id", "text", "occ")
    return A.recover_annotations(sample, "doc_id", store, LABELS).select("doc_id", *LABELS)


@query("SELECT CAST(doc_id AS VARCHAR) AS id, CAST(quality AS INTEGER) AS quality, CAST(toxic AS INTEGER) AS toxic FROM labels")
def annotation_store(spark, sf_dir):
    """Records written twice and read back, the later ones standing."""
    store = scratch_path(spark, "annotations")
    done = load_table(spark, f"{sf_dir}/labels.parquet").withColumn("id", F.col("doc_id").cast("string"))
    append_annotations(done.withColumns({label: 1 - F.col(label) for label in LABELS}), store, LABELS)
    append_annotations(done, store, LABELS)
    return read_annotations(spark, store, LABELS)


@query(
    """SELECT count(*) AS n_waiting FROM documents ANTI JOIN labels USING (doc_id)"""
)
def annotation_waiting(spark, sf_dir):
    done = load_table(spark, f"{sf_dir}/labels.parquet").select(F.col("doc_id").cast("string").alias("id"))
    table = load_table(spark, f"{sf_dir}/documents.parquet")
    return A.not_yet_annotated(table, "doc_id", done).agg(F.count("*").alias("n_waiting"))


@query(f"WITH {_KEYWORDS} SELECT * FROM keywords")
def incremental_labels(spark, sf_dir):
    """Documents that arrive as files are labelled as they come; a second start
    finds nothing left to do."""
    arrivals = scratch_path(spark, "arrivals")
    store, checkpoint = scratch_path(spark, "labelled"), scratch_path(spark, "progress")
    table = documents(spark, sf_dir).select("doc_id", "text")
    table.write.parquet(arrivals)
    for _ in range(2):
        stream = arriving_offers(spark, arrivals, table.schema, files_per_trigger=4)
        process_arrivals(
            stream,
            "doc_id",
            lambda batch: A.keyword_labels(batch, "text", _TERMS).drop("text"),
            store,
            checkpoint,
        ).awaitTermination()
    return read_results(spark, store)


@query("SELECT CAST(doc_id AS VARCHAR) AS id, quality, toxic FROM labels")
def response_format(spark, sf_dir):
    """Answers in the format demanded of annotators, read by its schema."""
    table = load_table(spark, f"{sf_dir}/labels.parquet")
    entry = F.struct(F.col("doc_id").cast("string").alias("id"), *LABELS)
    answers = table.select(F.to_json(F.struct(F.array(entry).alias("annotations"))).alias("answer"))
    read = F.from_json("answer", A.response_schema(LABELS), {"mode": "FAILFAST"})
    return answers.select(F.inline(read["annotations"]))
