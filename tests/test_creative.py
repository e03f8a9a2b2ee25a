from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from conftest import ORDER, order
from pyspark.sql import functions as F

from adlift.operators import bandit, creative, texts


@pytest.fixture(scope="module")
def catalog(spark):
    return creative.creative_catalog(creative.generate(creative.example_segments(spark))).cache()


def test_catalog_sizes_at_both_limits(spark, catalog):
    rows = catalog.collect()
    assert len(rows) == 20
    assert {r["status"] for r in rows} == {texts.APPROVED}
    ids = sorted(r["creative_id"] for r in rows if r["segment_id"] == "seg_pizza_promo")
    assert ids == [f"crt_seg_pizza_promo_{i:02d}" for i in range(4)]
    short = creative.creative_catalog(creative.generate(creative.example_segments(spark)), max_chars=60)
    per = Counter(r["segment_id"] for r in short.collect())
    assert sum(per.values()) == 18
    assert per["seg_mercado_semana"] == per["seg_saudavel_corp"] == 3


def test_numbering_follows_the_guardrails(spark):
    generated = spark.createDataFrame(
        [("s", "x", True, "p", 0, "a" * 70), ("s", "x", True, "p", 1, "ok"), ("s", "x", True, "p", 2, "Erro!")],
        "segment_id string, cuisine string, discount_sensitive boolean, period string, position int, copy_text string",
    )
    rows = creative.creative_catalog(generated).collect()
    assert [(r["creative_id"], r["copy_text"]) for r in rows] == [("crt_s_00", "ok")]
    verdicts = {r["position"]: r["reason"] for r in creative.guardrails(generated).collect()}
    assert verdicts == {0: "too_long", 1: None, 2: "banned_term"}


def test_length_counts_code_points_after_cleaning(spark):
    lines = ["🍕" * 60, "🍕" * 61, "🍕" * 65, "🍕" * 66, "  a\t\n b \x07c ", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "position int, copy_text string")
    got = {r["position"]: r for r in creative.guardrails(df).collect()}
    assert [got[i]["reason"] for i in range(7)] == [None, None, None, "too_long", None, "empty", "empty"]
    assert got[4]["copy_text"] == "a b c"
    assert [r["reason"] for r in creative.guardrails(df, max_chars=60).orderBy("position").collect()][:3] == [
        None,
        "too_long",
        "too_long",
    ]


def test_generic_texts_fill_in_the_cuisine(spark):
    segments = spark.createDataFrame(
        [("s", "Brasileira", True, "jantar")],
        "segment_id string, cuisine string, discount_sensitive boolean, period string",
    )
    rows = creative.guardrails(creative.generate(segments)).orderBy("position").collect()
    assert [r["n_chars"] for r in rows] == [58, 65, 58]
    assert all("Brasileira" in r["copy_text"] for r in rows)
    assert creative.segment_prompts(segments).first()["prompt"].startswith("Gere 5 textos de ate 60 caracteres")


def test_segments_from_gold(spark):
    gold = spark.createDataFrame(
        [("u", "Pizza", 0.36, 10.0, 0.5), ("v", "Burger", 0.35, 20.0, 0.1)],
        "customer_id string, user_preferred_cuisine string, user_discount_affinity double, "
        "user_avg_basket_value double, user_historical_ctr double",
    )
    orders = spark.createDataFrame([order("a", 12 * 3600), order("b", 20 * 3600), order("c", 20 * 3600)], ORDER)
    members = creative.customer_segments(gold, orders)
    got = {r["customer_id"]: r["segment_id"] for r in members.collect()}
    assert got == {"u": "seg_pizza_promo_jantar", "v": "seg_burger_regular_jantar"}
    assert creative.segment_profile(members, 2).count() == 0
    assert creative.segment_profile(members).count() == 2


def test_context_of_known_and_unknown_customers(spark):
    gold = spark.createDataFrame(
        [("u", "Doces", 0.9, 90.0, 2.0)],
        "customer_id string, user_preferred_cuisine string, user_discount_affinity double, "
        "user_avg_basket_value double, user_ad_fatigue_score double",
    )
    asked = spark.createDataFrame([("u",), ("?",)], "customer_id string")
    got = {r["customer_id"]: tuple(r)[1:] for r in creative.customer_context(asked, gold).collect()}
    assert got == {"u": (True, "Doces", True, 90.0, 2.0, 0.72), "?": (False, "Pizza", False, 50.0, 1.0, 0.3)}


def _requests(spark, n, segment="seg_pizza_promo"):
    return spark.range(n).select(
        F.format_string("r%06d", "id").alias("request_id"), F.lit(segment).alias("segment_id")
    )


def _stats(spark, clicks):
    rows = [(f"crt_{i:02d}", "seg_pizza_promo", i, 100, c) for i, c in enumerate(clicks)]
    return spark.createDataFrame(
        rows, "creative_id string, segment_id string, arm int, impressions long, clicks long"
    )


def test_best_arm_ties_go_to_catalog_order(spark):
    assert bandit.best_arm(_stats(spark, [5, 9, 9])).first()["creative_id"] == "crt_01"


def test_greedy_and_fallback(spark):
    stats = _stats(spark, [5, 9, 9])
    greedy = bandit.decide(_requests(spark, 50), stats, epsilon=0.0).collect()
    assert {(r["creative_id"], r["explored"]) for r in greedy} == {("crt_01", False)}
    lost = bandit.decide(_requests(spark, 5, "nowhere"), stats).collect()
    assert {(r["creative_id"], r["explored"]) for r in lost} == {("crt_00", False)}


def test_epsilon_is_the_explored_share(spark):
    rows = bandit.decide(_requests(spark, 20_000), _stats(spark, [1, 9, 2, 3])).collect()
    explored = [r["creative_id"] for r in rows if r["explored"]]
    assert 0.14 < len(explored) / len(rows) < 0.16
    assert all(0.22 < n / len(explored) < 0.28 for n in Counter(explored).values())
    assert {r["creative_id"] for r in rows if not r["explored"]} == {"crt_01"}


def test_thompson_follows_the_posterior(spark):
    stats, requests = _stats(spark, [20, 30, 22]), _requests(spark, 20_000)
    out = bandit.decide_thompson(requests, stats)
    got = Counter(r["creative_id"] for r in out.collect())
    rng = np.random.default_rng(0)
    draws = np.stack([rng.beta(c + 1, 100 - c + 1, 200_000) for c in (20, 30, 22)])
    want = np.bincount(draws.argmax(axis=0), minlength=3) / 200_000
    for i in range(3):
        assert got[f"crt_{i:02d}"] / 20_000 == pytest.approx(want[i], abs=0.015)
    again = bandit.decide_thompson(requests.repartition(7), stats)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
    lost = bandit.decide_thompson(_requests(spark, 3, "nowhere"), stats).collect()
    assert {r["creative_id"] for r in lost} == {"crt_00"}


def test_gamma_draws_have_the_right_moments():
    seed = np.arange(200_000, dtype=np.uint64) * np.uint64(7919)
    for shape in (1.0, 2.5, 40.0):
        draws = bandit._gamma(np.full(len(seed), shape), seed)
        assert draws.mean() == pytest.approx(shape, rel=0.02)
        assert draws.var() == pytest.approx(shape, rel=0.03)


def test_arm_stats_add_what_was_served(spark, catalog):
    start = {r["creative_id"]: r for r in bandit.arm_stats(catalog).collect()}
    assert {r["impressions"] for r in start.values()} == {10}
    assert {r["clicks"] for r in start.values()} <= {1, 2, 3, 4}
    served = spark.createDataFrame(
        [("crt_seg_pizza_promo_00", 1), ("crt_seg_pizza_promo_00", 0)], "creative_id string, clicked int"
    )
    after = {r["creative_id"]: r for r in bandit.arm_stats(catalog, served).collect()}
    one = after["crt_seg_pizza_promo_00"]
    assert one["impressions"] == 12
    assert one["clicks"] == start["crt_seg_pizza_promo_00"]["clicks"] + 1
    assert len(after) == 20


def test_ab_shares(spark):
    units = spark.range(20_000).select(F.format_string("u%d", "id").alias("unit"))
    rows = bandit.ab_assignment(units, "unit", {"a": 0.5, "b": 0.3, "c": 0.2}).collect()
    shares = Counter(r["variant"] for r in rows)
    assert shares["a"] == pytest.approx(10_000, rel=0.03)
    assert shares["b"] == pytest.approx(6_000, rel=0.04)
    assert shares["c"] == pytest.approx(4_000, rel=0.05)


def test_rank_candidates(spark):
    rows = [("q", f"m{i}", i % 3 * 0.1) for i in range(9)] + [("p", "m0", 0.5)]
    df = spark.createDataFrame(rows, "request_id string, merchant_id string, score double")
    got = bandit.rank_candidates(df, "request_id", "score", ["merchant_id"], 2).collect()
    assert sorted((r["request_id"], r["rank"], r["merchant_id"]) for r in got) == [
        ("p", 1, "m0"),
        ("q", 1, "m2"),
        ("q", 2, "m5"),
    ]


def test_thompson_answers_requests_without_an_id(spark, catalog):
    requests = spark.createDataFrame([(None, "seg_pizza_promo"), ("r", None)], "request_id string, segment_id string")
    got = bandit.decide_thompson(requests, bandit.arm_stats(catalog)).collect()
    assert len(got) == 2 and all(r["creative_id"] for r in got)


def test_pinned_segments_and_decision_rows(spark, catalog):
    asked = spark.createDataFrame(
        [("r1", "seg_pizza_promo"), ("r2", "seg_burger_promo"), ("r3", None)], "request_id string, segment_id string"
    )
    pinned = spark.createDataFrame([("r2", "seg_pizza_promo")], "request_id string, segment_id string")
    requests = bandit.pin_segments(asked, pinned)
    assert {r["request_id"]: r["segment_id"] for r in requests.collect()} == {
        "r1": "seg_pizza_promo", "r2": "seg_pizza_promo", "r3": None,
    }
    chosen = bandit.decide(requests, bandit.arm_stats(catalog), epsilon=0.0)
    context = spark.createDataFrame([("r1", "u"), ("r2", "v"), ("r3", "w")], "request_id string, customer_id string")
    rows = {r["request_id"]: r for r in bandit.decision_rows(context, chosen, catalog).collect()}
    texts_of = {r["creative_id"]: r["copy_text"] for r in catalog.collect()}
    assert len(rows) == 3 and all(r["copy_text"] == texts_of[r["creative_id"]] for r in rows.values())
