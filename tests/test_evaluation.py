from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from adlift.operators.evaluation import binary_metrics, stratified_split

SCHEMA = "score double, label int"


def test_metrics_by_hand(spark):
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0), (0.3, 1), (0.1, 0)]
    got = binary_metrics(spark.createDataFrame(rows, SCHEMA), "score", "label").first()
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert got["auc_roc"] == round(wins / 9, 6)
    assert got["pr_auc"] == round((1 * 1 / 1 + 1 * 2 / 3 + 1 * 3 / 5) / 3, 6)
    loss = -sum(math.log(s) if y else math.log(1 - s) for s, y in rows) / 6
    assert got["log_loss"] == round(loss, 6)
    assert got["f1_score"] == round(2 * 3 / (2 * 3 + 2 + 0), 6)
    assert (got["observations"], got["positives"]) == (6, 3)


def test_auc_agrees_with_the_evaluator_and_mirrors(spark):
    rng = random.Random(3)
    rows = [(round(rng.random(), 3), int(rng.random() < 0.3)) for _ in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    auc = binary_metrics(df, "score", "label").first()["auc_roc"]
    peer = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(df)
    assert auc == pytest.approx(peer, abs=1e-6)
    mirrored = binary_metrics(df.selectExpr("1 - score AS score", "label"), "score", "label").first()
    assert mirrored["auc_roc"] == pytest.approx(1 - auc, abs=2e-6)


def test_certain_scores_are_clipped(spark):
    got = binary_metrics(spark.createDataFrame([(1.0, 0), (0.0, 1)], SCHEMA), "score", "label").first()
    assert got["auc_roc"] == 0.0
    assert 30 < got["log_loss"] < 40


def test_split_is_exact_per_label_and_stable(spark):
    rows = [(f"id{i}", int(i % 7 == 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id string, label int")
    got = stratified_split(df, "id", "label").collect()
    assert len(got) == 1000
    counts = {}
    for r in got:
        counts[(r["label"], r["is_test"])] = counts.get((r["label"], r["is_test"]), 0) + 1
    assert counts == {(0, 0): 686, (0, 1): 171, (1, 0): 114, (1, 1): 29}
    again = stratified_split(df.repartition(9), "id", "label").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    other = stratified_split(df, "id", "label", seed=1).collect()
    assert sorted(map(tuple, other)) != sorted(map(tuple, got))


def test_copies_stay_on_one_side(spark):
    rows = [("dup", 0)] * 300 + [(f"id{i}", 0) for i in range(600)]
    got = stratified_split(spark.createDataFrame(rows, "id string, label int"), "id", "label").collect()
    assert len(got) == 900
    assert len({r["is_test"] for r in got if r["id"] == "dup"}) == 1


def test_split_keeps_rows_without_id_or_label(spark):
    rows = [(f"id{i}", i % 2) for i in range(40)] + [(None, 1), (None, 1), ("x", None), (None, None)]
    df = spark.createDataFrame(rows, "id string, label int")
    got = stratified_split(df, "id", "label", test_share=0.5).collect()
    assert sorted((str(r["id"]), str(r["label"])) for r in got) == sorted((str(i), str(y)) for i, y in rows)
    assert {r["is_test"] for r in got} == {0, 1}
    assert len({r["is_test"] for r in got if r["id"] is None and r["label"] == 1}) == 1


def test_split_is_exact_with_many_ids_in_a_cell(spark, monkeypatch):
    from pyspark.sql import functions as F

    import adlift.operators.evaluation as module

    # All ids share the first 16 bits, many the last ones too.
    monkeypatch.setattr(module, "hash32", lambda c, salt: F.pmod(F.xxhash64(c), F.lit(5)))
    df = spark.createDataFrame([(f"id{i}", 0) for i in range(333)], "id string, label int")
    got = stratified_split(df, "id", "label", test_share=0.3).collect()
    assert sum(r["is_test"] for r in got) == 100


def test_scores_that_are_no_probabilities_are_refused(spark):
    with pytest.raises(Exception, match="have to lie in"):
        binary_metrics(spark.createDataFrame([(1.5, 0), (0.0, 1)], SCHEMA), "score", "label").collect()
