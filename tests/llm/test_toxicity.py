from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import adlift.llm.toxicity as module
from adlift.llm.toxicity import choose, place_counts, places, ratios, score, toxicity, train
from odd_texts import docs, no_docs, texts  # noqa: F401  fixtures

BAD = ["grobnok", "vilstrum", "zagthar"]
LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(spark, n=500, seed=1):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        words = [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.choice('lmnprs')}{rng.choice('aeiou')}" for _ in range(rng.randint(10, 120))]
        toxic = int(rng.random() < 0.2)
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "en", "as"]))
        rows.append((i, " ".join(words).title() if i % 5 == 1 else " ".join(words)))
        marks.append((i, toxic))
    table = spark.createDataFrame([(*r, 9.0, True, "x") for r in rows], "doc_id long, text string, score double, held_out boolean, toxic string")
    return rows, dict(marks), table, spark.createDataFrame([(i, 1, t, "clash") for i, t in marks], LABELS)


def test_held_out_accuracy(spark):
    rows, marks, table, labels = corpus(spark)
    got = {r.doc_id: r for r in toxicity(table.repartition(3), labels).collect()}
    assert len(got) == len(rows)
    held = [i for i in marks if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held) and sum(got[i].held_out for i in got) == len(held)
    hits = sum(got[i].predicted == marks[i] for i in held)
    assert hits >= len(held) - 1 and any(marks[i] for i in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_labels_held_out_teach_nothing(spark):
    _, marks, table, labels = corpus(spark, 300)
    flipped = spark.createDataFrame(
        [(i, 1, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, "") for i, t in marks.items()], LABELS
    )
    one, two = ({r.doc_id: r.score for r in toxicity(table, x).collect()} for x in (labels, flipped))
    assert max(abs(one[i] - two[i]) for i in one) < 1e-9


def test_model_by_brute_force(spark):
    rows, marks, _, _ = corpus(spark, 200)
    taught = spark.createDataFrame([(marks[i], t) for i, t in rows], "toxic int, text string").repartition(3)
    p, q, n_p, n_q = place_counts(taught)
    want = [Counter(), Counter()]
    for i, text in rows:
        want[marks[i]].update(set(places(text).tolist()))
    assert (n_p, n_q) == (sum(marks.values()), len(marks) - sum(marks.values()))
    assert {i: int(p[i]) for i in np.flatnonzero(p)} == want[1] and {i: int(q[i]) for i in np.flatnonzero(q)} == want[0]
    ratio = ratios(p, q)
    at = next(iter(want[1]))
    sums = [sum(w.values()) + module.SMOOTH * module.DIMS for w in want]
    assert ratio[at] == pytest.approx(np.log((want[1][at] + 0.1) / sums[1]) - np.log((want[0][at] + 0.1) / sums[0]))
    model = train(taught)
    assert set(model["places"]) == set(choose(p, q, n_p, n_q))
    assert all(i in want[1] for i in model["places"][model["weights"] > 0.5])
    found = {r.doc_id: r.score for r in score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    weight = dict(zip(model["places"].tolist(), model["weights"]))
    for i, text in rows:
        margin = model["intercept"] + sum(weight.get(x, 0.0) for x in set(places(text).tolist()))
        assert found[i] == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9)


def test_few_rows_of_a_class_are_sampled_and_weighted(spark):
    rows, marks, _, _ = corpus(spark, 400)
    taught = spark.createDataFrame([(marks[i], t) for i, t in rows], "toxic int, text string")
    found = score(spark.createDataFrame(rows, "doc_id long, text string"), train(taught, sample=100)).collect()
    assert sum(r.predicted == marks[r.doc_id] for r in found) >= 0.97 * len(rows)


@pytest.mark.parametrize(("toxic", "want"), [([0, 0], 0.0), ([1, 1], 1.0), ([None, None], 0.0), ([], 0.0)])
def test_one_class_or_none(spark, toxic, want):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(["some text", "", None, "ugly"])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, t, "") for i, t in zip((1, 3), toxic)] if toxic else [], LABELS)
    assert {r.score for r in toxicity(table, labels).collect()} == {want}


def test_odd_tables(spark, docs, texts, no_docs):  # noqa: F811
    labels = spark.createDataFrame([(i, 0, int((t or "").startswith("w1")), "") for i, t in texts] + [(None, 1, 1, "")], LABELS)
    got = toxicity(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in texts)
    assert len({round(r.score, 12) for r in got if r.doc_id in {i for i, t in texts if not t}}) >= 1
    assert toxicity(no_docs, labels).collect() == []


def test_pieces_hold_the_same_grams(monkeypatch):
    whole = "Some téxt, again and again! " * 50
    before = set(places(whole).tolist())
    monkeypatch.setattr(module, "PIECE", 64)
    assert set(places(whole).tolist()) == before
    assert len(places("")) == len(places(None)) == 0
