"""Batch annotation with binary labels that can stop and resume.

Offers are numbered in hash order and grouped in small batches. A caller's
``annotate`` receives a batch and answers with text. One job asks for a whole table:
each task has several calls under way, repeats refused ones itself, and commits its
answers to the store when it ends, so a lost executor or driver costs only the calls
of tasks that had not ended. Texts are never stored.
"""

from __future__ import annotations

import json
import re
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerscope.functions import text as X
from offerscope.labels import LABELS_17
from offerscope.operators.sampling import dense_row_id
from offerscope.sources.tables import (
    append_as_tasks_end,
    next_commit,
    path_exists,
    read_annotations,
    record_schema,
)

# Offers per call, attempts per batch, batches per call under way between
# two writes to the store.
BATCH_SIZE = 5
MAX_ATTEMPTS = 3
CHECKPOINT_EVERY = 50
# Ours: calls under way in a task, seconds before the second attempt, tasks of a run.
PARALLEL_CALLS = 4
RETRY_DELAY = 0.5
MAX_TASKS = 20_000

Annotator = Callable[[list[dict]], str | None]


# --- batches and prompts ------------------------------------------------------------


def annotation_key(id_col: str, text_col: str | None = None) -> Column:
    """What an offer's annotation is stored under: its id, or without one a digest of its
    text. Offers that share an id, or have none and the same text, share an annotation."""
    key = F.col(id_col).cast("string")
    if text_col is None:
        return key
    return F.coalesce(key, F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_col), F.lit("")))))


def make_batches(
    df: DataFrame,
    id_col: str,
    text_col: str,
    batch_size: int = BATCH_SIZE,
    max_chars: int | None = None,
    seed: int = 0,
    per_task: int | None = None,
    tasks: int = 1,
) -> DataFrame:
    """``batch_id, offers``: up to ``batch_size`` offers ``(id, text, key)`` in order.

    ``id`` tells the offers of a batch apart: their ``key`` (``annotation_key``), or their
    place in the batch where keys are empty or shared. Texts are whole unless
    ``max_chars`` is given. With ``per_task``, so many batches in a row meet in each of
    ``tasks`` tasks, whose number ``task`` comes first.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    numbered = dense_row_id(
        df.select(
            annotation_key(id_col, text_col).alias("id"),
            (text if max_chars is None else X.truncate(text, max_chars)).alias("text"),
        ),
        "id",
        "_row",
        seed,
    )
    numbered = numbered.withColumn("batch_id", F.floor(F.col("_row") / batch_size))
    keys_of_group = ["batch_id"]
    if per_task is not None:
        numbered = numbered.withColumn("task", F.floor(F.col("batch_id") / per_task).cast("int"))
        numbered = numbered.repartitionById(tasks, "task")  # grouping needs no other exchange
        keys_of_group = ["task", "batch_id"]
    members = F.array_sort(F.collect_list(F.struct("_row", "id", "text")))
    keys = F.col("_members.id")
    differ = (F.size(F.array_distinct(keys)) == F.size(keys)) & ~F.array_contains(keys, "")
    return (
        numbered.groupBy(*keys_of_group)
        .agg(members.alias("_members"))
        .withColumn("_differ", differ)
        .select(
            *keys_of_group,
            F.transform(
                "_members",
                lambda m, i: F.struct(
                    F.when(F.col("_differ"), m["id"]).otherwise(F.concat(F.lit("#"), (i + 1).cast("string"))).alias("id"),
                    m["text"].alias("text"),
                    m["id"].alias("key"),
                ),
            ).alias("offers"),
        )
    )


def prompt_frame(labels: list[str], definitions: dict[str, str]) -> tuple[str, str]:
    """What stands before and after the offers of a batch."""
    listed = "\n".join(f"- {label} : {definitions.get(label, label)}" for label in labels)
    head = (
        "Pour chaque annonce, indique par 1 ou 0 si chaque élément est clairement mentionné.\n"
        "En cas de doute, réponds 0. Ne te fie qu'au texte de l'annonce.\n\n"
        f"Éléments :\n{listed}\n\n"
        "junior_offer et experienced_offer s'excluent ; very_experienced_offer suppose experienced_offer.\n"
    )
    tail = (
        'Réponds par un objet JSON dont la clé "annotations" contient une entrée par annonce, '
        f"avec id, {', '.join(labels)}.\n"
    )
    return head, tail


def prompt_of(offers: Column, labels: list[str], definitions: dict[str, str]) -> Column:
    """The request for one batch."""
    head, tail = prompt_frame(labels, definitions)
    blocks = F.transform(
        offers,
        lambda offer, i: F.concat(
            F.lit("\n[annonce "), (i + 1).cast("string"), F.lit(", id "), offer["id"], F.lit("]\n"), offer["text"], F.lit("\n")
        ),
    )
    return F.concat(F.lit(head), F.array_join(blocks, ""), F.lit("\n"), F.lit(tail))


def response_schema(labels: list[str]) -> T.StructType:
    """What a well-formed answer holds, for callers that can demand a format."""
    entry = T.StructType(
        [T.StructField("id", T.StringType(), False)]
        + [T.StructField(label, T.IntegerType(), False) for label in labels]
    )
    return T.StructType([T.StructField("annotations", T.ArrayType(entry, False), False)])


# --- answers --------------------------------------------------------------------------


def _truth(value: Column) -> Column:
    """A JSON value as 0 or 1: null, false, zero and empty values give 0."""
    kind = F.schema_of_variant(value)
    text = F.trim(value.cast("string"))
    number = F.coalesce(text.try_cast("double") != 0, F.lit(True))
    return (
        F.when(kind == "VOID", 0)
        .when(kind == "STRING", (F.length(value.cast("string")) > 0).cast("int"))
        .when(kind == "BOOLEAN", value.cast("boolean").cast("int"))
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), (~text.isin("[]", "{}")).cast("int"))
        .otherwise(number.cast("int"))
    )


def read_answers(answers: DataFrame, labels: list[str]) -> DataFrame:
    """Adds ``annotations`` (array of ``id`` and labels) to ``ids, response``.

    The text between the outermost braces must be JSON with one entry per
    expected id, no other id, none twice, and every label. One fault makes the
    whole batch null. Entries come in the order of ``ids``.
    """
    found = F.nullif(F.regexp_extract("response", r"(?s)\{.*\}", 0), F.lit(""))
    body = F.try_parse_json(F.concat(F.lit("["), found, F.lit("]")))  # as the only value: none may follow
    alone = F.try_variant_get("_body", "$[1]", "variant").isNull()
    entries = F.when(alone, F.try_variant_get("_body", "$[0].annotations", "array<variant>"))
    given = F.transform(
        "_entries", lambda e: F.coalesce(F.try_variant_get(e, "$.id", "string"), F.lit(""))
    )
    complete = F.forall(
        "_entries",
        lambda e: F.forall(
            F.array(*[F.try_variant_get(e, f"$.{label}", "variant").isNotNull() for label in labels]),
            lambda present: present,
        ),
    )
    valid = (
        (F.size("_entries") == F.size("ids"))
        & (F.size(F.array_except("ids", "_given")) == 0)
        & (F.size(F.array_except("_given", "ids")) == 0)
        & (F.size(F.array_distinct("_given")) == F.size("_given"))
        & complete
    )
    ordered = F.transform(
        "ids",
        lambda wanted: F.struct(
            wanted.alias("id"),
            *[
                _truth(
                    F.try_variant_get(
                        F.element_at("_entries", F.array_position("_given", wanted).cast("int")),
                        f"$.{label}",
                        "variant",
                    )
                ).alias(label)
                for label in labels
            ],
        ),
    )
    return (
        answers.withColumn("_body", body)
        .withColumn("_entries", entries)
        .withColumn("_given", given)
        .withColumn("annotations", F.when(F.coalesce(valid, F.lit(False)), ordered))
        .drop("_body", "_entries", "_given")
    )


# --- the pipeline -----------------------------------------------------------------------


def usable_answer(response: str | None, ids: list[str], labels: list[str]) -> bool:
    """Whether ``read_answers`` will take this response, so that a task can ask again."""

    def once(pairs: list[tuple]) -> dict:
        if len({name for name, _ in pairs}) < len(pairs):
            raise ValueError("repeated name")
        return dict(pairs)

    def refuse(constant: str):
        raise ValueError(constant)

    response = response or ""
    first, last = response.find("{"), response.rfind("}")
    try:
        found = json.loads(response[first : last + 1], object_pairs_hook=once, parse_constant=refuse) if first >= 0 else None
    except (ValueError, RecursionError):
        return False
    entries = found.get("annotations") if isinstance(found, dict) else None
    if not isinstance(entries, list) or not all(isinstance(e, dict) and all(n in e for n in labels) for e in entries):
        return False
    given = [str(e["id"]) if e.get("id") is not None else "" for e in entries]
    return sorted(given) == sorted(ids) and len(set(given)) == len(given)


def _ask(annotate: Annotator, offers: list[dict], labels: list[str], attempts: int, delay: float) -> str | None:
    """The first usable response, else the last one; each attempt waits longer."""
    asked = [{"id": o["id"], "text": o["text"]} for o in offers]
    ids = [o["id"] for o in offers]
    response = None
    for attempt in range(attempts):
        if attempt:
            time.sleep(delay * attempt)
        try:
            response = annotate([dict(o) for o in asked])
        except Exception:
            # A caller's failure of any kind counts as a failed attempt.
            response = None
        response = response if isinstance(response, str) else None
        if usable_answer(response, ids, labels):
            break
    return response


def request_answers(
    batches: DataFrame,
    annotate: Annotator,
    labels: list[str],
    attempts: int = MAX_ATTEMPTS,
    parallel_calls: int = PARALLEL_CALLS,
    retry_delay: float = RETRY_DELAY,
) -> DataFrame:
    """``batch_id, keys, ids, response`` (after ``task``, if there is one) without texts.

    Each task has up to ``parallel_calls`` calls under way, so ``annotate`` must bear
    threads. A batch whose response is not usable is asked again at once, ``attempts``
    times in all, after ``retry_delay`` seconds, twice, three times as many. The last
    response stands; a call that fails or gives no text gives null.
    """
    names = [name for name in ("task", "batch_id") if name in batches.columns]
    kept = [batches.schema[name] for name in names]
    texts = T.ArrayType(T.StringType())
    schema = T.StructType([*kept, T.StructField("keys", texts), T.StructField("ids", texts), T.StructField("response", T.StringType())])
    kinds = {"task": pa.int32(), "batch_id": pa.int64()}
    out = pa.schema([*[(name, kinds[name]) for name in names], ("keys", pa.list_(pa.string())), ("ids", pa.list_(pa.string())), ("response", pa.string())])

    def ask(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answered(row: dict, future) -> pa.RecordBatch:
            offers = row["offers"]
            line = {name: row[name] for name in names} | {
                "keys": [o["key"] for o in offers], "ids": [o["id"] for o in offers], "response": future.result(),
            }
            return pa.RecordBatch.from_pylist([line], schema=out)

        under_way: deque = deque()
        with ThreadPoolExecutor(parallel_calls) as pool:
            for part in parts:
                for i in range(part.num_rows):
                    row = part.slice(i, 1).to_pylist()[0]
                    if len(under_way) >= 2 * parallel_calls:
                        yield answered(*under_way.popleft())
                    under_way.append((row, pool.submit(_ask, annotate, row["offers"], labels, attempts, retry_delay)))
            while under_way:
                yield answered(*under_way.popleft())

    return batches.select(*names, "offers").mapInArrow(ask, schema)


def annotate_store(
    df: DataFrame,
    id_col: str,
    text_col: str,
    annotate: Annotator,
    store_path: str,
    labels: list[str] = LABELS_17,
    batch_size: int = BATCH_SIZE,
    attempts: int = MAX_ATTEMPTS,
    parallel_calls: int | None = None,
    checkpoint_every: int = CHECKPOINT_EVERY,
    max_chars: int | None = None,
    retry_delay: float = RETRY_DELAY,
) -> DataFrame:
    """Asks for the rows of ``df`` that the store lacks, in one job, and returns the keys of
    those that failed as ``id``.

    A task takes ``checkpoint_every`` batches per call under way and is one commit with a
    ``seq`` of its own: its records are in the store once it has ended. A task that is
    repeated repeats its calls, so ``annotate`` must not mind being asked twice. Beyond
    ``MAX_TASKS`` tasks, tasks grow.
    """
    spark = df.sparkSession
    remaining = df
    if path_exists(spark, store_path):
        remaining = not_yet_annotated(df, id_col, read_annotations(spark, store_path, labels), text_col)
    calls = parallel_calls or PARALLEL_CALLS
    n_batches = -(-df.count() // batch_size)
    if n_batches == 0:
        return spark.createDataFrame([], "id string")
    per_task = max(checkpoint_every * calls, -(-n_batches // MAX_TASKS))
    tasks = -(-n_batches // per_task)
    batches = make_batches(remaining, id_col, text_col, batch_size, max_chars, per_task=per_task, tasks=tasks)
    read = read_answers(request_answers(batches, annotate, labels, attempts, calls, retry_delay), labels)
    no_label = [F.lit(None).cast("int").alias(label) for label in labels]
    good = F.transform(  # answers come in the order of the offers
        "annotations",
        lambda a, i: F.struct(F.col("keys")[i].alias("id"), *[a[label].alias(label) for label in labels], F.lit(None).cast("boolean").alias("_failed")),
    )
    bad = F.transform("keys", lambda key: F.struct(key.alias("id"), *no_label, F.lit(True).alias("_failed")))
    first = next_commit(spark, store_path)
    lines = read.select((F.lit(first) + F.col("task")).alias("seq"), F.explode(F.coalesce(good, bad)).alias("r"))
    folder = append_as_tasks_end(lines.select("r.id", "seq", *[F.col("r")[n].alias(n) for n in (*labels, "_failed")]), store_path, first + tasks - 1)
    written = spark.read.schema("id string, _failed boolean").json(folder)
    return written.filter("_failed").select("id")


def run_annotation(
    df: DataFrame,
    id_col: str,
    text_col: str,
    annotate: Annotator,
    store_path: str,
    labels: list[str] = LABELS_17,
    **settings,
) -> tuple[DataFrame, DataFrame]:
    """The annotated table and the failed ids; ids in the store are not asked for again.
    ``settings`` are those of ``annotate_store``."""
    spark = df.sparkSession
    failed = annotate_store(df, id_col, text_col, annotate, store_path, labels, **settings)
    if not path_exists(spark, store_path):
        nothing = spark.createDataFrame([], record_schema(labels)).drop("seq")
        return attach_annotations(df, id_col, nothing, text_col), failed
    return attach_annotations(df, id_col, read_annotations(spark, store_path, labels), text_col), failed


def not_yet_annotated(df: DataFrame, id_col: str, done: DataFrame, text_col: str | None = None) -> DataFrame:
    done_ids = done.select(F.col("id").alias("_done"))
    return df.join(done_ids, annotation_key(id_col, text_col) == F.col("_done"), "left_anti")


def attach_annotations(
    df: DataFrame, id_col: str, annotations: DataFrame, text_col: str | None = None
) -> DataFrame:
    """All rows of ``df``; rows without annotation have null labels. Rows without an id
    find theirs where ``text_col`` is given."""
    keyed = df.withColumn("_annotation_id", annotation_key(id_col, text_col))
    return keyed.join(annotations.withColumnRenamed("id", "_annotation_id"), "_annotation_id", "left")


def recover_annotations(
    df: DataFrame, id_col: str, store_path: str, labels: list[str], text_col: str | None = None
) -> DataFrame:
    """The annotated table from the store alone, joined by the stable key."""
    return attach_annotations(df, id_col, read_annotations(df.sparkSession, store_path, labels), text_col)


# --- terms instead of a model -----------------------------------------------------------


def term_pattern(terms: list[str]) -> str:
    """Any of the terms as whole words of a normalised text."""
    return "(^| )(" + "|".join(re.escape(term).replace(r"\ ", " ") for term in terms) + ")( |$)"


def keyword_labels(df: DataFrame, text_col: str, terms: dict[str, list[str]]) -> DataFrame:
    """Adds one 0/1 column per label: whether one of its terms occurs.

    The text is normalised like a sentence key, once for all labels.
    """
    words = X.sentence_keys_of(
        X.minimal_clean(F.col(text_col)), remove_accents=True, collapse_digits=False
    )[0]
    found = {label: F.col("_words").rlike(term_pattern(t)).cast("int") for label, t in terms.items()}
    return df.withColumn("_words", words).withColumns(found).drop("_words")


def keyword_annotator(terms: dict[str, list[str]]) -> Annotator:
    """An offline ``annotate`` that answers from terms in plain lower-case text."""
    patterns = {label: re.compile(term_pattern(t)) for label, t in terms.items()}

    def annotate(offers: list[dict]) -> str:
        entries = []
        for offer in offers:
            words = re.sub(r"[\W_]+", " ", offer["text"].lower()).strip()
            entries.append(
                {"id": offer["id"], **{label: int(bool(p.search(words))) for label, p in patterns.items()}}
            )
        return json.dumps({"annotations": entries})

    return annotate
