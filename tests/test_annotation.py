"""Answers, batches, resuming, stores, streams, models and sources."""

import json
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from offerscope.labels import LABELS_17
from offerscope.operators import annotation as A
from offerscope.operators import entities as E
from offerscope.operators import scoring as C
from offerscope.plans import flows
from offerscope.session import scratch_path
from offerscope.sources import tables as T
from offerscope.streaming import incremental as I

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LABELS = ["a", "b"]


def read(spark, responses, ids=("1", "2")):
    frame = spark.createDataFrame([(i, list(ids), r) for i, r in enumerate(responses)], "i int, ids array<string>, response string")
    rows = A.read_answers(frame, LABELS).orderBy("i").collect()
    return [r["annotations"] and [tuple(x) for x in r["annotations"]] for r in rows]


def answer(*entries):
    return json.dumps({"annotations": list(entries)})


def test_good_answers(spark):
    one, two = {"id": "1", "a": 1, "b": 0}, {"id": "2", "a": 0, "b": 0}
    good = [("1", 1, 0), ("2", 0, 0)]
    responses = [
        answer(one, two),
        "Voici :\n" + answer(two, one) + "\nfin",
        answer({**one, "id": 1}, {**two, "id": 2, "other": "x"}),
        answer({"id": "1", "a": True, "b": None}, {"id": "2", "a": False, "b": ""}),
        answer({"id": "1", "a": "0", "b": 0.0}, {"id": "2", "a": [], "b": {}}),
        answer({"id": "1", "a": [0], "b": []}, {"id": "2", "a": -0.0, "b": 0}),
    ]
    assert read(spark, responses) == [good] * 6


def test_refused_answers(spark):
    one, two = {"id": "1", "a": 1, "b": 0}, {"id": "2", "a": 0, "b": 0}
    responses = [
        None, "", "pas de json", "{broken", answer(one), answer(one, one), answer(one, {**two, "id": "3"}),
        answer(one, two, two), answer(one, {"id": "2", "a": 1}), answer(one, {"a": 1, "b": 1}), '{"annotations": 3}', "{}",
    ]
    assert read(spark, responses) == [None] * len(responses)


def offers(spark, n=23):
    return spark.createDataFrame([(i, f"texte {i} " + ("remote" if i % 2 else "")) for i in range(n)], "id long, text string")


def test_batches_and_prompt(spark):
    batches = A.make_batches(offers(spark), "id", "text", max_chars=5).orderBy("batch_id").collect()
    assert [len(b["offers"]) for b in batches] == [5, 5, 5, 5, 3]
    assert {o["text"] for b in batches for o in b["offers"]} == {"texte"}
    prompt = A.make_batches(offers(spark), "id", "text").select(A.prompt_of(F.col("offers"), LABELS_17, {"management": "meaning"})).first()[0]
    assert all(label in prompt for label in LABELS_17) and "[annonce 5, id " in prompt


def test_vocabularies():
    assert len(set(LABELS_17)) == len(LABELS_17) == 17
    assert A.response_schema(["x"]).fieldNames() == ["annotations"]


def test_resume_and_failures(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def flaky(batch):
        calls.add(1)
        if any(o["id"] == "7" for o in batch):
            raise RuntimeError("no service")
        return answer(*[{"id": o["id"], "a": "remote" in o["text"], "b": 0} for o in batch])

    store = scratch_path(spark, "store")
    table, failed = A.run_annotation(offers(spark), "id", "text", flaky, store, LABELS)
    lost = {r["id"] for r in failed.collect()}
    assert "7" in lost and len(lost) in (3, 5)
    assert calls.value == 4 + 3
    rows = {r["_annotation_id"]: r["a"] for r in table.collect()}
    assert len(rows) == 23 and all((rows[i] is None) == (i in lost) for i in rows)

    def steady(batch):
        calls.add(100)
        return answer(*[{"id": o["id"], "a": 1, "b": 1} for o in batch])

    again, failed = A.run_annotation(offers(spark), "id", "text", steady, store, LABELS)
    assert calls.value == 7 + 100 and failed.count() == 0
    final = {r["_annotation_id"]: (r["a"], r["b"]) for r in again.collect()}
    assert all(final[i] == ((1, 1) if i in lost else (int(int(i) % 2 == 1), 0)) for i in final)
    recovered = A.recover_annotations(offers(spark), "id", store, LABELS)
    assert sorted(map(tuple, recovered.collect())) == sorted(map(tuple, again.collect()))


def test_waves_store_as_they_go(spark):
    def annotate(batch):
        return answer(*[{"id": o["id"], "a": 0, "b": 1} for o in batch])

    store = scratch_path(spark, "store")
    table, failed = A.run_annotation(
        offers(spark), "id", "text", annotate, store, LABELS, parallel_calls=2, checkpoint_every=1
    )
    assert failed.count() == 0 and table.filter("a = 0 and b = 1").count() == 23
    # Five batches, two at a time: three writes.
    assert spark.read.json(store).select("seq").distinct().count() == 3


def test_nothing_to_annotate(spark):
    table, failed = A.run_annotation(offers(spark, 3).limit(0), "id", "text", len, scratch_path(spark, "store"), LABELS)
    assert table.count() == failed.count() == 0 and table.columns[-2:] == LABELS


def test_foreign_store(spark, tmp_path):
    lines = ['{"id": 1, "a": 0, "b": 0}', "", '{"id": "2", "a": 1}', '{"id": "1", "a": 1, "b": 1}', "{broken"]
    (tmp_path / "store.jsonl").write_text("\n".join(lines))
    rows = {r["id"]: (r["a"], r["b"]) for r in T.read_annotations(spark, str(tmp_path / "store.jsonl"), LABELS).collect()}
    assert rows == {"1": (1, 1), "2": (1, None)}


def test_empty_store(spark, tmp_path):
    (tmp_path / "store.jsonl").write_text("\n")
    assert A.recover_annotations(offers(spark), "id", str(tmp_path / "store.jsonl"), LABELS).filter("a is null").count() == 23


def test_keywords(spark):
    texts = ["Télétravail possible, débutant accepté !", "teletravailleur", None, "esprit d'équipe"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    terms = {"remote_work": ["teletravail"], "junior_offer": ["debutant accepte"], "company_culture": ["esprit d equipe"]}
    rows = A.keyword_labels(frame, "t", terms).orderBy("i").collect()
    assert [(r["remote_work"], r["junior_offer"], r["company_culture"]) for r in rows] == [(1, 1, 0), (0, 0, 0), (0, 0, 0), (0, 0, 1)]


def test_sample_and_annotate(spark):
    frame = spark.createDataFrame([(i, "mutuelle " * 20, "H1206" if i % 3 else "x") for i in range(60)], "id long, text string, code string")
    annotate = A.keyword_annotator({"a": ["mutuelle"], "b": ["python"]})
    table, failed = flows.sample_and_annotate(frame, 20, "id", "text", "code", annotate, scratch_path(spark, "store"), LABELS)
    assert failed.count() == 0 and {(r["a"], r["b"]) for r in table.collect()} == {(1, 0)} and table.count() == 20


# --- streams -----------------------------------------------------------------------


def test_arrivals_are_done_once(spark):
    source, store, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    seen = spark.sparkContext.accumulator(0)
    schema = offers(spark).schema

    def run():
        def transform(batch):
            seen.add(batch.count())
            return A.keyword_labels(batch, "text", {"a": ["remote"]}).drop("text")

        I.process_arrivals(I.arriving_offers(spark, source, schema, 1), "id", transform, store, progress).awaitTermination()

    offers(spark, 10).write.parquet(source)
    run()
    assert seen.value == 10
    # New files that repeat known ads: only unknown ones are worked on.
    offers(spark, 15).coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    assert seen.value == 15
    rows = I.read_results(spark, store).collect()
    assert sorted((r["id"], r["a"]) for r in rows) == [(i, i % 2) for i in range(15)]


@pytest.mark.parametrize("ids", [(1, 1, 2, 3, 4), (None, None, 2, None, 4), ("", "#2", "", "a", "#2")])
def test_shared_and_missing_ids_do_not_refuse_a_batch(spark, ids):
    rows = [(i, "remote work" if i in (1, "") or i is None else "office") for i in ids]
    frame = spark.createDataFrame(rows, f"id {'string' if isinstance(ids[0], str) else 'int'}, text string")
    store, calls = scratch_path(spark, "store"), spark.sparkContext.accumulator(0)
    answer = A.keyword_annotator({"a": ["remote"]})

    def annotate(batch):
        calls.add(1)
        assert len({offer["id"] for offer in batch}) == len(batch)
        return answer(batch)

    for _ in range(2):  # the second start has nothing left to ask
        table, failed = A.run_annotation(frame, "id", "text", annotate, store, ["a"])
        assert failed.count() == 0
        assert sorted((str(r["id"]), r["a"]) for r in table.collect()) == sorted((str(i), int("remote" in t)) for i, t in rows)
        assert calls.value == 1


def test_arrivals_without_an_id_all_stay(spark):
    source, store, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    for rows in ([(None, "a"), (None, "a"), (1, "b"), (1, "c")], [(None, "a"), (1, "d"), (2, "e")]):
        spark.createDataFrame(rows, "id int, text string").coalesce(1).write.mode("append").parquet(source)
        stream = I.arriving_offers(spark, source, spark.createDataFrame(rows, "id int, text string").schema)
        I.process_arrivals(stream, "id", lambda batch: batch, store, progress).awaitTermination()
    found = I.read_results(spark, store).collect()
    assert sorted(str(r["id"]) for r in found) == ["1", "2", "None", "None", "None"]
    assert [r["text"] for r in found if r["id"] is None] == ["a"] * 3


def test_a_batch_that_breaks_is_repeated_whole(spark):
    source, store, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    fails = [True]

    def transform(batch):
        if fails[0] and batch.filter("id >= 10").count():
            batch.limit(1).write.mode("overwrite").parquet(f"{store}/batch=1")  # cut off in the middle
            raise RuntimeError("lost")
        return batch

    def run():
        I.process_arrivals(I.arriving_offers(spark, source, offers(spark).schema, 8), "id", transform, store, progress).awaitTermination()

    offers(spark, 10).coalesce(1).write.parquet(source)
    run()
    offers(spark, 15).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="lost"):
        run()
    fails[0] = False
    run()
    assert sorted(r["id"] for r in I.read_results(spark, store).collect()) == list(range(15))


def test_an_old_id_is_forgotten(spark):
    source, store, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    for day in ("01-01", "01-03", "03-01", "06-01", "06-02", "01-01"):
        frame = spark.sql(f"SELECT id, TIMESTAMP '2024-{day}' AS at FROM VALUES (1), (null), (null) AS t(id)")
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = I.arriving_offers(spark, source, frame.schema)
        I.process_arrivals(stream, "id", lambda batch: batch, store, progress, "at", "10 days").awaitTermination()
    found = [(r["id"], str(r["at"])[5:10]) for r in I.read_results(spark, store).collect()]
    # an id goes after the batch that finds it older than the watermark; late rows are left out
    assert [day for i, day in sorted(found, key=str) if i == 1] == ["01-01", "06-01"]
    assert sorted(day for i, day in found if i is None) == sorted(["01-01", "01-03", "03-01", "06-01", "06-02"] * 2)


def test_stream_with_known_boilerplate(spark):
    source, store, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    frame = spark.createDataFrame([(1, "f", "Bonjour. Mission un."), (2, "f", "Bonjour. Mission deux.")], "id long, firm string, text string")
    frame.write.parquet(source)
    drops = spark.createDataFrame([("f", "bonjour")], "firm string, key string")
    transform = I.clean_arrivals(drops, "text", "firm", "id")
    I.process_arrivals(I.arriving_offers(spark, source, frame.schema), "id", transform, store, progress).awaitTermination()
    assert I.read_results(spark, store).columns == ["id", "firm", "text", "description_clean"]
    assert {r["id"]: r["description_clean"] for r in I.read_results(spark, store).collect()} == {1: "mission un.", 2: "mission deux."}


# --- models --------------------------------------------------------------------------


def make_lengths():
    def predict(texts):
        return np.array([[len(t), 1.0] for t in texts], dtype=np.float32)

    return predict


def test_caller_model(spark):
    frame = spark.createDataFrame([("abc",), (None,)], "t string")
    rows = C.score_texts(frame, "t", make_lengths, ["x", "y"]).collect()
    assert [(r["proba_x"], r["proba_y"]) for r in rows] == [(3.0, 1.0), (0.0, 1.0)]
    applied = C.apply_thresholds(C.score_texts(frame, "t", make_lengths, ["x", "y"]), ["x", "y"], {"x": 3, "y": 1.5}).collect()
    assert [(r["pred_x"], r["pred_y"]) for r in applied] == [(1, 0), (0, 0)]
    with pytest.raises(Exception, match="3 labels, but the model gives 2"):
        C.score_texts(frame, "t", make_lengths, ["x", "y", "z"]).collect()
    with pytest.raises(ValueError):
        C.apply_thresholds(frame, ["x"], {})
    unit = C.embed_texts(frame, "t", make_lengths).collect()
    assert unit[0]["embedding"] == pytest.approx([3 / 10**0.5, 1 / 10**0.5])


def test_best_class(spark):
    frame = spark.createDataFrame([([0.1, 0.7, 0.7],)], "v array<double>")
    assert tuple(frame.select(C.best_class(F.col("v"), ["x", "y", "z"]).alias("b")).first()["b"]) == ("y", 0.7)


def test_word_embedding(spark):
    frame = spark.createDataFrame([(0, "un deux"), (1, "un"), (2, "")], "i int, t string")
    rows = C.embed_by_words(frame, "t", dims=64).orderBy("i").collect()
    norms = [np.linalg.norm(r["embedding"]) for r in rows]
    assert len(rows[0]["embedding"]) == 64 and norms == pytest.approx([1, 1, 0], abs=1e-6)


def test_train_and_score(spark, tmp_path):
    words = [("python sql", 1, 0), ("soudure atelier", 0, 1), ("python atelier", 1, 1), ("accueil bureau", 0, 0)]
    rows = [(i, f"{words[i % 4][0]} offre numero{i}", *words[i % 4][1:]) for i in range(400)]
    annotated = spark.createDataFrame(rows, "id long, description string, a int, b int")
    table = flows.training_table(annotated, "id", "description", LABELS).cache()
    assert {r["split"]: r["count"] for r in table.groupBy("split").count().collect()} == {"train": 280, "valid": 60, "test": 60}
    model, thresholds, rates = flows.train_and_evaluate(table, LABELS, regularisations=(0.01,))
    # The lowest of the equally good thresholds stands, so a few rows may pass it.
    assert all(r["f1"] > 0.95 and r["recall"] == 1.0 for r in rates.collect())
    model.save(str(tmp_path / "model"))
    loaded = C.LabelModel.load(str(tmp_path / "model"), LABELS)
    scored = flows.score_table(annotated, "description", loaded, thresholds)
    assert scored.filter("(proba_a >= 0.5) != (a = 1) or (proba_b >= 0.5) != (b = 1)").count() == 0
    assert scored.filter(f"(pred_a = 1) != (proba_a >= {thresholds['a']})").count() == 0
    assert scored.columns == [*annotated.columns, "proba_a", "proba_b", "pred_a", "pred_b"]
    with pytest.raises(ValueError):
        flows.score_table(annotated, "missing", model, thresholds)


def test_clean_and_embed(spark):
    rows = [(i, "f", f"Bonjour à tous. Mission {w} numéro {w}.") for i, w in enumerate("un deux trois quatre cinq six".split())]
    frame = spark.createDataFrame(rows, "id long, nom string, texte string")
    result = flows.clean_and_embed(frame, "id", "texte", "nom").collect()
    assert all("bonjour" not in r["description_clean"] for r in result)
    assert len({len(r["embedding_pca"]) for r in result}) == 1


# --- entities and sources ----------------------------------------------------------------


def make_finder():
    def find(text, labels):
        return [{"label": labels[0], "text": w, "score": len(w) / 10} for w in text.split()]

    return find


def test_entities(spark):
    frame = spark.createDataFrame([(1, "abcdef ab abcde"), (2, None)], "id long, t string")
    rows = E.extract_entities(frame, "id", "t", make_finder, ["mot"], 0.5)
    assert sorted(r["text"] for r in rows.collect()) == ["abcde", "abcdef"]
    assert E.group_entities(rows, "id").first()["entities"] == '{"mot":["abcde","abcdef"]}'
    terms = E.term_entities(frame, "id", "t", {"x": {"ab": 0.9, "abcde": 0.1}}, 0.5).collect()
    assert [(r["id"], r["text"]) for r in terms] == [(1, "ab")]


def test_tables(spark, tmp_path):
    frame = spark.createDataFrame([(1, 'a "b", c\nd', None), (2, "é", 0.5)], "i int, t string, x double")
    for name in ("t.parquet", "t.CSV"):
        T.save_table(frame, str(tmp_path / "new" / name))
        back = T.load_table(spark, str(tmp_path / "new" / name), frame.schema)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, frame.collect()))
    for call in (lambda: T.load_table(spark, "x.json"), lambda: T.save_table(frame, "x")):
        with pytest.raises(ValueError):
            call()


def test_other_splits_are_not_opened(spark, tmp_path):
    frame = spark.createDataFrame([(1, "train"), (2, "test"), (3, "valid"), (4, None)], "i int, split string")
    path = tmp_path / "splits"
    T.save_splits(frame, str(path))
    read = lambda names=None: sorted(map(tuple, T.load_splits(spark, str(path), "split string, i int", names).collect()))
    assert [row[0] for row in read()] == [1, 2, 3, 4]
    for file in (path / "split=train").glob("*.parquet"):
        (path / "split=train" / f".{file.name}.crc").unlink(missing_ok=True)
        file.write_bytes(b"not parquet")
    wanted = spark.createDataFrame([("test", 1), ("train", 0), (None, 1), ("none", 1)], "split string, use int").filter("use = 1")
    assert read(["test", "valid"]) == [(2, "test"), (3, "valid")]
    assert read(wanted) == [(2, "test")]
    assert read(["none"]) == [] and read(wanted.limit(0)) == []
    with pytest.raises(Exception, match="(?i)parquet"):
        read(["train"])


def test_splits_and_artefacts(spark, tmp_path):
    frame = spark.createDataFrame([(1, "train"), (2, "test")], "i int, split string")
    T.save_splits(frame, str(tmp_path / "splits"))
    assert [r["i"] for r in spark.read.parquet(str(tmp_path / "splits")).filter("split = 'test'").collect()] == [2]
    value = {"télétravail": 0.35, "labels": ["a"], "n": None}
    T.write_artefact(spark, value, str(tmp_path / "thresholds.json"))
    assert T.read_artefact(spark, str(tmp_path / "thresholds.json")) == value
    with pytest.raises(FileNotFoundError):
        T.read_artefact(spark, str(tmp_path / "none.json"))
