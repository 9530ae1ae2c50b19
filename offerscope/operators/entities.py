"""Entities in texts: a caller's extractor or a list of terms."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTITY_SCHEMA = "array<struct<label string, text string, score double>>"


def extract_entities(
    df: DataFrame,
    id_col: str,
    text_col: str,
    make_extractor: Callable[[], Callable[[str, list[str]], list[dict]]],
    labels: list[str],
    threshold: float = 0.5,
) -> DataFrame:
    """``id, label, text, score`` from a caller's model.

    ``make_extractor`` runs once per task; what it returns maps a text and the
    label list to dicts with ``label``, ``text`` and ``score``.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extract = make_extractor()
        for batch in batches:
            found = [
                [(e["label"], e["text"], float(e["score"])) for e in extract(text or "", labels)]
                for text in batch[text_col]
            ]
            yield pd.DataFrame({id_col: batch[id_col], "entities": found})

    found = df.select(id_col, text_col).mapInPandas(run, f"{id_col} {id_type}, entities {ENTITY_SCHEMA}")
    return (
        found.select(id_col, F.explode("entities").alias("e"))
        .select(id_col, "e.*")
        .filter(F.col("score") >= threshold)
    )


def term_entities(
    df: DataFrame,
    id_col: str,
    text_col: str,
    terms: dict[str, dict[str, float]],
    threshold: float = 0.5,
) -> DataFrame:
    """``id, label, text, score`` from terms (label -> term -> score), every
    occurrence as a whole word, without regard to case."""
    text = F.lower(F.col(text_col))

    def occurrences(label: str, term: str, score: float) -> Column:
        word = rf"(?:^|[^\p{{L}}\p{{N}}])({re.escape(term.lower())})(?=[^\p{{L}}\p{{N}}]|$)"
        return F.transform(
            F.regexp_extract_all(text, F.lit(word), F.lit(1)),
            lambda hit: F.struct(
                F.lit(label).alias("label"), hit.alias("text"), F.lit(float(score)).alias("score")
            ),
        )

    found = [
        occurrences(label, term, score)
        for label, scored in terms.items()
        for term, score in scored.items()
        if score >= threshold
    ]
    return df.select(id_col, F.explode(F.concat(*found)).alias("e")).select(id_col, "e.*")


def group_entities(entities: DataFrame, id_col: str) -> DataFrame:
    """``id, entities``: a JSON object from label to its texts, both sorted.

    A text's entities are grouped, so a group is bounded by one text.
    """
    by_label = entities.groupBy(id_col, "label").agg(
        F.array_sort(F.collect_list("text")).alias("texts")
    )
    return by_label.groupBy(id_col).agg(
        F.to_json(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "texts"))))
        ).alias("entities")
    )
