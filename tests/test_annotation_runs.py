"""Commits of the record store; runs that ask in parallel, ask again, and are cut off."""

import json
import sys
import threading
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from offerscope.operators import annotation as A
from offerscope.session import scratch_path
from offerscope.sources import tables as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LABELS = ["a", "b"]


def answer(*entries):
    return json.dumps({"annotations": list(entries)})


def all_ones(batch):
    return answer(*[{"id": o["id"], "a": 1, "b": 1} for o in batch])


def offers(spark, n):
    return spark.range(n).select("id", F.concat(F.lit("texte "), "id").alias("text"))


def records(spark, *rows):
    return spark.createDataFrame(rows, "id string, a int, b int")


def stored(spark, path):
    return sorted(map(tuple, T.read_annotations(spark, path, LABELS).collect()))


def test_commits_are_numbered_and_the_last_one_stands(spark):
    store = scratch_path(spark, "store")
    assert T.append_annotations(records(spark, ("1", 0, 0), ("2", 0, 0)), store, LABELS) == 0
    assert T.append_annotations(records(spark, ("1", 1, 1), (None, 1, 1)), store, LABELS) == 1
    assert T.next_commit(spark, store) == 2
    assert stored(spark, store) == [("1", 1, 1), ("2", 0, 0)]
    assert T.append_annotations(records(spark).limit(0), store, LABELS) == 2
    assert stored(spark, store) == [("1", 1, 1), ("2", 0, 0)]


def test_an_unfinished_append_is_not_read(spark, tmp_path):
    store = str(tmp_path / "store")
    T.append_annotations(records(spark, ("1", 0, 0)), store, LABELS)

    def breaks(batches):
        for batch in batches:
            yield batch
        raise RuntimeError("lost")

    broken = records(spark, ("1", 1, 1), ("2", 1, 1)).repartition(2).mapInPandas(breaks, "id string, a int, b int")
    with pytest.raises(Exception, match="lost"):
        T.append_annotations(broken, store, LABELS)
    # a driver that ends while files are being moved to their place leaves no mark
    cut_off = tmp_path / "store" / "commit=000000000007-all-x"
    cut_off.mkdir()
    (cut_off / "part-0.json").write_text('{"id": "1", "seq": 7, "a": 1, "b": 1}\n{"id": "3", "se')
    assert stored(spark, store) == [("1", 0, 0)]
    assert T.append_annotations(records(spark, ("4", 0, 1)), store, LABELS) == 8
    assert stored(spark, store) == [("1", 0, 0), ("4", 0, 1)]


def test_only_unfinished_appends(spark, tmp_path):
    cut_off = tmp_path / "store" / "commit=000000000000-all-x"
    cut_off.mkdir(parents=True)
    (cut_off / "part-0.json").write_text('{"id": "1", "seq": 0, "a": 1, "b": 1}\n')
    assert stored(spark, str(tmp_path / "store")) == []


def test_commits_come_after_lines_of_others(spark, tmp_path):
    (tmp_path / "old.json").write_text('{"id": "1", "seq": 90, "a": 0, "b": 0}\n{"id": "2", "seq": 90, "a": 0, "b": 0}\n')
    assert T.append_annotations(records(spark, ("1", 1, 1)), str(tmp_path), LABELS) == 0
    assert stored(spark, str(tmp_path)) == [("1", 1, 1), ("2", 0, 0)]


def test_what_ended_stays_when_a_run_is_cut_off(spark):
    """One task dies with its worker; the others' answers are not asked for again."""
    store, asked = scratch_path(spark, "store"), spark.sparkContext.accumulator(0)

    def dies(batch):
        if any(o["id"] == "17" for o in batch):
            time.sleep(4)
            raise SystemExit
        return all_ones(batch)

    def steady(batch):
        asked.add(1)
        return all_ones(batch)

    settings = {"parallel_calls": 1, "checkpoint_every": 2}
    with pytest.raises(Exception):
        A.run_annotation(offers(spark, 40), "id", "text", dies, store, LABELS, **settings)
    kept = {row[0] for row in stored(spark, store)}
    assert len(kept) == 30 and "17" not in kept  # three of four tasks of ten offers
    table, failed = A.run_annotation(offers(spark, 40), "id", "text", steady, store, LABELS, **settings)
    assert asked.value == 2 and failed.count() == 0
    assert table.filter("a = 1 and b = 1").count() == 40


def test_calls_of_a_task_overlap_and_are_bounded(spark, tmp_path):
    def annotate(batch):
        name = f"{time.time_ns()}-{threading.get_ident()}"
        (tmp_path / f"{name}.start").write_text(str(time.time()))
        time.sleep(0.3)
        (tmp_path / f"{name}.end").write_text(str(time.time()))
        return all_ones(batch)

    _, failed = A.run_annotation(offers(spark, 60), "id", "text", annotate, scratch_path(spark, "store"), LABELS, parallel_calls=3)
    assert failed.count() == 0
    events = [(float(p.read_text()), 1 if p.suffix == ".start" else -1) for p in tmp_path.iterdir()]
    running = most = 0
    for _, change in sorted(events):
        running += change
        most = max(most, running)
    assert len(events) == 24 and most == 3


def test_refused_answers_are_asked_again_in_the_task(spark, tmp_path):
    def annotate(batch):
        key = "-".join(sorted(o["id"] for o in batch))
        before = len(list(tmp_path.glob(f"{key}.*")))
        (tmp_path / f"{key}.{before}").write_text("")
        ids = {o["id"] for o in batch}
        if before == 0:
            return '{"annotations": []}'
        if before == 1 and "3" in ids:
            raise ConnectionError("busy")
        return None if "7" in ids else all_ones(batch)

    table, failed = A.run_annotation(offers(spark, 20), "id", "text", annotate, scratch_path(spark, "store"), LABELS, batch_size=1, retry_delay=0.01)
    assert [r["id"] for r in failed.collect()] == ["7"]
    assert table.filter("a = 1").count() == 19
    assert len(list(tmp_path.glob("3.*"))) == 3 and len(list(tmp_path.glob("7.*"))) == 3 and len(list(tmp_path.glob("5.*"))) == 2


def test_failed_offers_are_not_annotations(spark):
    store = scratch_path(spark, "store")
    T.append_annotations(records(spark, ("0", 0, 0)), store, LABELS)
    table, failed = A.run_annotation(offers(spark, 8), "id", "text", len, store, LABELS, attempts=1)
    assert failed.count() == 7 and stored(spark, store) == [("0", 0, 0)]
    assert table.filter("a is null").count() == 7


def test_answers_hold_no_text(spark):
    batches = A.make_batches(offers(spark, 30), "id", "text", per_task=2, tasks=3)
    answers = A.request_answers(batches, all_ones, LABELS)
    assert answers.columns == ["task", "batch_id", "keys", "ids", "response"]
    assert sorted((r["task"], r["batch_id"]) for r in answers.collect()) == [(b // 2, b) for b in range(6)]
    plan = batches._jdf.queryExecution().executedPlan().toString()
    # by number within a prefix, and by task; grouping into batches adds no exchange
    assert plan.count("hashpartitioning(batch_id") == plan.count("hashpartitioning(task, batch_id") == 0


def test_tasks_judge_answers_as_the_store_does(spark):
    one, two = {"id": "1", "a": 1, "b": 0}, {"id": "2", "a": 0, "b": 0}
    responses = [
        None, "", "pas de json", "{broken", "}{", answer(one), answer(one, one), answer(one, two), answer(two, one),
        "Voici :\n" + answer(one, two) + "\nfin", answer({**one, "id": 1}, {**two, "id": 2, "c": [1]}), answer(one, {**two, "id": "3"}),
        answer(one, two, two), answer(one, {"id": "2", "a": 1}), answer(one, {"a": 1, "b": 1}), answer(one, {**two, "b": None}),
        '{"annotations": 3}', '{"annotations": [1, 2]}', "{}", "[1]", '{"a": {}}', answer(one, {**two, "a": float("nan")}),
        '{"annotations": [{"id": "1", "a": 1, "a": 0, "b": 1}, {"id": "2", "a": 1, "b": 1}]}', answer(one, two) + answer(one, two),
    ]
    frame = spark.createDataFrame([(i, ["1", "2"], r) for i, r in enumerate(responses)], "i int, ids array<string>, response string")
    taken = {r["i"]: r["annotations"] is not None for r in A.read_answers(frame, LABELS).collect()}
    assert {i: A.usable_answer(r, ["1", "2"], LABELS) for i, r in enumerate(responses)} == taken
