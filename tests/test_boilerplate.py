"""Boilerplate learning and removal against small direct versions."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from offerscope.operators import boilerplate as B
from offerscope.operators import joins
from offerscope.operators import key_clusters as K
from offerscope.session import materialize


def direct_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def direct_leaders(keys, threshold):
    leaders, found = [], []
    for i, key in enumerate(keys):
        for j in leaders:
            if 1 - direct_distance(key, keys[j]) / max(len(key), len(keys[j])) >= threshold:
                found.append(j)
                break
        else:
            leaders.append(i)
            found.append(i)
    return found


@pytest.mark.parametrize("threshold", [0.88, 0.7, 0.5])
def test_similar_keys(spark, threshold):
    rng = random.Random(3)
    pairs = [tuple("".join(rng.choices("abc", k=rng.randint(1, 12))) for _ in range(2)) for _ in range(2000)]
    found = spark.createDataFrame(pairs, "a string, b string").select("a", "b", K.similar("a", "b", threshold).alias("s"))
    for a, b, s in found.collect():
        assert s == (1 - direct_distance(a, b) / max(len(a), len(b)) >= threshold)


def near_copies(rng, n):
    bases = ["".join(rng.choices("abcde ", k=rng.randint(1, 60))).strip() or "a" for _ in range(n // 4)]
    keys = []
    for _ in range(n):
        key = list(rng.choice(bases))
        for _ in range(rng.randint(0, 8)):
            key[rng.randrange(len(key))] = rng.choice("abcde")
        keys.append("".join(key))
    return list(dict.fromkeys(keys))


@pytest.mark.parametrize("threshold", [0.88, 0.7])
def test_leaders_follow_the_greedy_rule(spark, threshold):
    firms, rows = {}, []
    for seed in range(4):
        rng = random.Random(seed)
        keys = near_copies(rng, 200)
        if seed == 1:  # long keys, over several pieces and widths of bucket
            base = "".join(rng.choices("abcdefgh é", k=700))
            keys += [base[:k] + "xyz"[: k % 4] + base[k + k % 9 :] for k in range(0, 700, 45)]
            keys += [base[j : j + 130] + "q" * (j % 3) for j in range(0, 20)]
        counts = {key: rng.randint(1, 3) for key in keys}
        firms[f"f{seed}"] = sorted(counts, key=lambda key: (-counts[key], key))
        rows += [(f"f{seed}", key, n) for key, n in counts.items()]
    frame = materialize(spark.createDataFrame(rows, "firm string, key string, n_docs long").repartition(3), "keys")
    found = {(r["firm"], r["key"]): r for r in K.cluster_keys(frame, threshold).collect()}
    assert len(found) == len(rows)
    for firm, keys in firms.items():
        leaders = direct_leaders(keys, threshold)
        numbers = {lead: n for n, lead in enumerate(dict.fromkeys(leaders))}
        for key, lead in zip(keys, leaders):
            row = found[firm, key]
            assert (row["rep"], row["cluster_id"], row["n_members"]) == (keys[lead], numbers[lead], leaders.count(lead))
        assert any(leaders.count(lead) > 2 for lead in leaders)


def test_no_keys_have_no_clusters(spark):
    frame = materialize(spark.createDataFrame([], "firm string, key string, n_docs long"), "keys")
    assert K.cluster_keys(frame, 0.88).collect() == []


def test_similar_pairs_meet_in_cells(spark):
    """Whole keys are shuffled, not their substrings, and crowded cells lose no pair."""
    draw, rows = random.Random(5), []
    words = ["and", "ing", "ndre", "tion", "he", "ouor", "est", "ünd", "zoo"]
    for firm in ("a", "b"):
        texts = {" ".join(draw.choices(words, k=draw.randint(1, 30))) for _ in range(60)}
        for text in list(texts):
            for _ in range(2):
                at = draw.randrange(len(text))
                texts.add(text[:at] + draw.choice("xyz") + text[at + draw.randint(0, 2) :])
        rows += [(firm, text, draw.randint(1, 3)) for text in sorted(texts)]
    numbered = [(i, *row, len(row[1])) for i, row in enumerate(rows)]
    keys = spark.createDataFrame(numbered, "id long, firm string, key string, n_docs long, l int")
    keys = keys.select("*", *[K._bag("key", classes).alias(name) for name, classes in K.BAGS.items()])
    every = keys.crossJoin(keys.select(*[F.col(c).alias(f"{c}2") for c in keys.columns]))
    every = every.filter((F.col("firm") == F.col("firm2")) & (F.col("id") < F.col("id2")) & K.similar("key", "key2", 0.88))
    wanted = {(r["id"], r["id2"]) for r in every.collect()}
    assert len(wanted) > 50
    for letters in (200, 8_000_000):
        found = [(min(r), max(r)) for r in K.similar_pairs(keys, 0.88, letters).collect()]
        assert len(found) == len(wanted) and set(found) == wanted
    with K._joined_where_they_lie(spark):
        plan = K._found(keys, 0.88, 200)._jdf.queryExecution().executedPlan().toString()
    places = re.findall(r"Exchange hashpartitioning\(([a-z]+)#", plan)
    assert places and set(places) <= {"cell", "a"}  # "a": the distinct pairs


@pytest.mark.parametrize("ids", [(1, 2, 3, 4), (None, None, None, None), (7, 7, 7, 7)])
def test_offers_are_counted_by_row_whatever_their_ids(spark, ids):
    texts = ["Nous recrutons des personnes motivees a Lyon.", "Nous recrutons des personnes motivees a Lyom.",
             "Nous recrutons des personnes motivees a Lyo.", "Nous recrutons des personnes motives a Lyon."]
    frame = spark.createDataFrame(list(zip(ids, texts, ["f"] * 4)), "id int, text string, firm string")
    segmented = B.segment_offers(frame, "id", "text", "firm")
    report = B.boilerplate_report(segmented).collect()
    assert [(r["df_offers"], r["n_members"], r["share"]) for r in report] == [(4, 4, 1.0)]
    assert B.learn_boilerplate(segmented, min_count=4).count() == 4


def offers_frame(spark, seed=0):
    rng = random.Random(seed)
    common = ["Notre groupe recrute.", "Nous sommes leader du marché.", "Postulez en ligne 24h sur 24."]
    rows = []
    for i in range(240):
        # One firm holds a third of all offers.
        firm = "grand" if i < 80 else f"firme {rng.randint(1, 12)}"
        body = [f"Mission numéro {'abcdefgh'[rng.randrange(8)]} {'xyz'[rng.randrange(3)] * 5}." for _ in range(3)]
        extra = [s if rng.random() < 0.7 else s.replace("o", "0", 1) for s in common if rng.random() < 0.4]
        parts = body + extra
        rng.shuffle(parts)
        rows.append((i, f" {firm} ", " ".join(parts)))
    rows += [(900, None, "Notre groupe recrute."), (901, "", "Notre groupe recrute."), (902, "grand", None), (903, "grand", "--- !!!")]
    return spark.createDataFrame(rows, "id int, firm string, text string")


def direct_drops(segmented, threshold, share=0.10, min_count=2, max_keys=5000):
    by_firm = {}
    for row in segmented.collect():
        if row["firm"]:
            by_firm.setdefault(row["firm"], []).append({k for k in row["keys"] if k})
    drops = set()
    for firm, sets in by_firm.items():
        counts = {}
        for keys in sets:
            for key in keys:
                counts[key] = counts.get(key, 0) + 1
        ordered = sorted(counts, key=lambda k: (-counts[k], k))[:max_keys]
        leaders = direct_leaders(ordered, threshold)
        floor = max(min_count, math.ceil(share * len(sets)))
        for lead in set(leaders):
            members = {k for k, own in zip(ordered, leaders) if own == lead}
            if sum(1 for keys in sets if keys & members) >= floor:
                drops |= {(firm, k) for k in members}
    return drops


@pytest.mark.parametrize("threshold, max_keys", [(0.88, 5000), (0.88, 6), (1.0, 5000), (1.0, 3)])
def test_learned_keys(spark, threshold, max_keys):
    segmented = B.segment_offers(offers_frame(spark), "id", "text", "firm")
    learned = B.learn_boilerplate(segmented, sim_threshold=threshold, max_keys_per_firm=max_keys)
    found = {(r["firm"], r["key"]) for r in learned.collect()}
    assert found == direct_drops(segmented, threshold, max_keys=max_keys) and found


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_partitioning_does_not_matter(spark, partitions):
    frame = offers_frame(spark).repartition(partitions)
    segmented = B.segment_offers(frame, "id", "text", "firm")
    drops = B.learn_boilerplate(segmented)
    assert {tuple(r) for r in drops.collect()} == direct_drops(segmented, 0.88)


def test_removal_keeps_order_and_every_offer(spark):
    segmented = B.segment_offers(offers_frame(spark), "id", "text", "firm")
    drops = B.learn_boilerplate(segmented)
    dropped = {(r["firm"], r["key"]) for r in drops.collect()}
    expected = {
        r["offer_id"]: " ".join(
            " ".join(s for s, k in zip(r["sentences"], r["keys"]) if (r["firm"], k) not in dropped).split()
        )
        for r in segmented.collect()
    }
    found = {r["offer_id"]: r["description_clean"] for r in B.remove_boilerplate(segmented, drops).collect()}
    assert found == expected
    assert found[900] == found[901] == "notre groupe recrute."
    assert found[902] == "" and found[903] == "--- !!!"


def test_removal_without_broadcast(spark, monkeypatch):
    segmented = B.segment_offers(offers_frame(spark), "id", "text", "firm")
    drops = B.learn_boilerplate(segmented)
    near = sorted(map(tuple, B.remove_boilerplate(segmented, drops).collect()))
    explained = sorted(map(tuple, B.explain_removal(segmented, drops).collect()))
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr(B, "fits_broadcast", lambda *a, **k: False)
    far = B.remove_boilerplate(segmented, drops)
    assert sorted(map(tuple, far.collect())) == near
    assert sorted(map(tuple, B.explain_removal(segmented, drops).collect())) == explained
    learned = B.learn_boilerplate(segmented)
    assert sorted(map(tuple, learned.collect())) == sorted(map(tuple, drops.collect()))


def test_threshold_edges(spark):
    rows = []
    for n in (1, 19, 20, 21):
        for i in range(n):
            said = "toujours là." if i < max(2, math.ceil(0.1 * n)) else "autre chose ."
            fewer = "presque." if i < max(2, math.ceil(0.1 * n)) - 1 else ""
            rows.append((n * 100 + i, f"f{n}", f"{said} {fewer} unique {'abcdefghijklmnopqrstu'[i]}."))
    frame = spark.createDataFrame(rows, "id int, firm string, text string")
    segmented = B.segment_offers(frame, "id", "text", "firm")
    dropped = {tuple(r) for r in B.learn_boilerplate(segmented, sim_threshold=1.0).collect()}
    assert {(f, "toujours la") for f in ("f19", "f20", "f21")} <= dropped
    assert not any(k == "presque" or f == "f1" for f, k in dropped)


def test_offer_cap(spark):
    segmented = B.segment_offers(offers_frame(spark), "id", "text", "firm")
    sizes = {r["firm"]: r["count"] for r in segmented.groupBy("firm").count().collect()}
    capped = {r["firm"]: r["count"] for r in B.cap_offers(segmented, 15).groupBy("firm").count().collect()}
    assert capped == {firm: min(15, n) for firm, n in sizes.items()}


def test_phrase_lookup(spark):
    segmented = B.segment_offers(offers_frame(spark), "id", "text", "firm")
    rows = {r["firm"]: r for r in B.phrase_lookup(segmented, "LEADER").collect()}
    hits = [k for r in segmented.collect() if r["firm"] == "grand" for s, k in zip(r["sentences"], r["keys"]) if "leader" in s]
    assert rows["grand"]["n_occurrences"] == len(hits)
    assert rows["grand"]["examples"] == sorted(set(hits))[:5]


def test_report_shares(spark):
    segmented = B.segment_offers(offers_frame(spark), "id", "text", "firm")
    report = B.boilerplate_report(segmented)
    row = report.filter(F.col("firm") == "grand").orderBy(F.col("df_offers").desc()).first()
    assert row["share"] == pytest.approx(row["df_offers"] / 82)


def test_salted_join_equals_broadcast(spark):
    big = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    small = materialize(spark.createDataFrame([(k, f"v{k}") for k in range(5)], "k long, v string"), "small")
    for how in ("inner", "left", "left_semi", "left_anti"):
        one = joins.lookup_join(big, small, ["k"], how)
        two = joins.lookup_join(big, small, ["k"], how, limit=0)
        assert one.columns == two.columns
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
