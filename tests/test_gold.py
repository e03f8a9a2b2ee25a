from __future__ import annotations

import pytest
from conftest import CLICK, ORDER, VIEW, at, click, order, view
from pyspark.sql import functions as F

from adlift.operators import gold
from adlift.operators.attribution import attribution_asof


def _gold(spark, orders, clicks, views):
    o, c, v = (spark.createDataFrame(r, s) for r, s in ((orders, ORDER), (clicks, CLICK), (views, VIEW)))
    silver = attribution_asof(o, c)
    return silver, c, v, {r["customer_id"]: r for r in gold.gold_customer_features(silver, v, c).collect()}


def test_defaults_and_dropped_customers(spark):
    _, _, _, got = _gold(
        spark,
        [order("a", 10, customer="buyer")],
        [click("c", 5, customer="viewer", impression="i1")],
        [view("i1", 1, customer="viewer")],
    )
    assert set(got) == {"viewer"}
    row = got["viewer"]
    assert (row["user_total_orders"], row["user_attributed_orders"]) == (0, 0)
    assert (row["user_avg_basket_value"], row["user_discount_affinity"]) == (45.0, 0.20)
    assert row["user_preferred_cuisine"] == "Burger"
    assert (row["user_ad_impressions"], row["user_ad_clicks"]) == (1, 1)
    assert (row["user_historical_ctr"], row["user_ad_fatigue_score"]) == (1.0, 0.5)


def test_counts_are_distinct_and_mode_ties_take_the_smallest(spark):
    orders = [
        order("a", 10, amount=10.0, coupon=1, cuisine="Pizza"),
        order("a", 10, amount=10.0, coupon=1, cuisine="Pizza"),
        order("b", 20, amount=40.0, cuisine="Burger"),
        order("c", 10**7, amount=40.0, cuisine="Burger"),
    ]
    views = [view("i1", 1), view("i1", 1), view("i2", 2)]
    clicks = [click("k1", 3, impression="i1"), click("k2", 4, impression="i1"), click("k2", 4, impression="i1")]
    silver, _, _, got = _gold(spark, orders, clicks, views)
    row = got["u"]
    assert (row["user_total_orders"], row["user_attributed_orders"]) == (3, 2)
    assert row["user_avg_basket_value"] == 25.0
    assert row["user_discount_affinity"] == 0.5
    assert row["user_preferred_cuisine"] == "Burger"
    assert (row["user_ad_impressions"], row["user_ad_clicks"]) == (2, 2)
    assert row["user_ad_fatigue_score"] == 0.67
    shop = gold.gold_merchant_features(silver).first()
    assert (shop["merchant_total_orders"], shop["merchant_avg_ticket"]) == (3, 25.0)
    assert shop["merchant_retail_media_dependency_rate"] == 0.6667


def test_daily_sums_equal_the_direct_form(spark):
    views = [view(f"i{n}", n * 40_000, customer=f"u{n % 3}") for n in range(30)]
    clicks = [click(f"c{n}", n * 50_000, impression=f"i{n % 11}") for n in range(20)]
    v, c = spark.createDataFrame(views, VIEW), spark.createDataFrame(clicks, CLICK)
    direct = {
        r["customer_id"]: (r["total_impressions"], r["total_clicks"], r["user_ad_fatigue_score"])
        for r in gold.customer_ad_behavior(v, c).collect()
    }
    daily = {
        r["customer_id"]: tuple(r)[1:] for r in gold.fatigue_from_daily(gold.daily_ad_counts(v, c)).collect()
    }
    assert daily == direct


def test_reference_time_windows(spark):
    as_of = F.lit(at(30 * 86_400)).cast("timestamp")
    orders = spark.createDataFrame([order("a", 0), order("b", 1), order("b", 1), order("c", 31 * 86_400)], ORDER)
    assert gold.orders_last_days(orders, as_of).first()["user_orders_last_30d"] == 1


def test_conversion_rate(spark):
    clicks = spark.createDataFrame([click("a", 0), click("b", 1), click("x", 0, merchant="n")], CLICK)
    silver = attribution_asof(spark.createDataFrame([order("o", 9)], ORDER), clicks)
    got = {r["merchant_id"]: r["merchant_conversion_rate"] for r in gold.merchant_conversion_rate(silver, clicks).collect()}
    assert got == {"m": 0.5, "n": 0.0}


def test_merchant_quality(spark):
    shops = spark.createDataFrame([("a",), ("b",), ("c",)], "merchant_id string")
    ratings = spark.createDataFrame(
        [("a", 1.0, 0.5), ("b", None, 0.4)], "merchant_id string, rating double, punctuality double"
    )
    out = gold.merchant_quality(shops, ratings, {"rating": 3, "punctuality": 1})
    assert {r["merchant_id"]: r["merchant_score_quality"] for r in out.collect()} == {
        "a": 0.875,
        "b": 0.4,
        "c": None,
    }


@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_rolling_features_do_not_look_ahead(spark, hot_rows):
    views = spark.createDataFrame([view("i1", 0), view("i2", 100), view("i3", 8 * 86_400)], VIEW)
    clicks = [click("c", 50, impression="i1"), click("d", 100, impression="i2"), click("lost", 60)]
    clicks = spark.createDataFrame(clicks, CLICK)
    orders = spark.createDataFrame([order("o", 60)], ORDER)
    at_rows = views.select("impression_id", "customer_id", "timestamp")
    got = {
        r["impression_id"]: tuple(r)[3:]
        for r in gold.rolling_customer_features(at_rows, views, clicks, orders, hot_rows).collect()
    }
    assert got == {"i1": (0, 0, 0, 0.0), "i2": (1, 1, 1, 0.5), "i3": (1, 0, 0, 0.0)}


def test_rollup_levels_add_up(spark):
    views = spark.createDataFrame([view(f"i{n}", n * 30_000, merchant=f"m{n % 2}") for n in range(20)], VIEW)
    clicks = spark.createDataFrame([click(f"c{n}", n * 30_000, merchant=f"m{n % 2}") for n in range(9)], CLICK)
    silver = attribution_asof(spark.createDataFrame([order("o", 90_000, merchant="m1", amount=7.5)], ORDER), clicks)
    rows = gold.advertiser_rollup(views, clicks, silver).collect()
    by_level = {}
    for r in rows:
        sums = by_level.setdefault(r["level"], [0, 0, 0, 0.0])
        for i, name in enumerate(("impressions", "clicks", "attributed_orders", "attributed_revenue")):
            sums[i] += r[name]
    assert by_level == {level: [20, 9, 1, 7.5] for level in (0, 1, 3, 7)}


def test_last_snapshot_equals_gold(spark):
    day = 86_400
    views = [view("i0", 10, "u"), view("i1", day, "u"), view("i1", 2 * day, "u"), view("i2", 10, "v")]
    clicks = [click("c0", 20, "u", impression="i0"), click("c1", 3 * day, "u", impression="i1")]
    clicks += [click("c1", 4 * day, "u", impression="i1"), click("lost", 30, "u", impression="none")]
    orders = [order("o0", day, "u", amount=8.0, cuisine="Doces"), order("o1", 2 * day, "u"), order("o2", 3 * day, "u")]
    seen, hit = spark.createDataFrame(views, VIEW), spark.createDataFrame(clicks, CLICK)
    silver = attribution_asof(spark.createDataFrame(orders, ORDER), hit)
    table = {r["customer_id"]: r for r in gold.gold_customer_features(silver, seen, hit).collect()}
    snapshots = gold.customer_snapshots(silver, seen, hit).orderBy("feature_ts").collect()
    last = {r["customer_id"]: r for r in snapshots}
    for customer, row in last.items():
        for name in set(row.asDict()) - {"customer_id", "feature_ts"}:
            assert row[name] == table[customer][name], (customer, name)
    # Nothing of a later day is in an earlier snapshot.
    first = next(r for r in snapshots if r["customer_id"] == "u")
    assert (first["user_total_orders"], first["user_historical_ctr"]) == (0, 1.0)
    second = [r for r in snapshots if r["customer_id"] == "u"][1]
    assert second["user_preferred_cuisine"] == "Doces" and last["u"]["user_preferred_cuisine"] == "Pizza"


def test_time_windows_are_pushed_to_the_files(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.createDataFrame([order("a", 10)], ORDER).write.parquet(path)
    recent = gold.orders_last_days(spark.read.parquet(path), F.lit("2024-01-31 00:00:00").cast("timestamp"), 30)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(timestamp" in plan and "LessThanOrEqual(timestamp" in plan


def test_snapshots_count_ids_without_distinct_counts(spark):
    """Replays and rows without an id do not count; ids come one row each, so nothing is counted as distinct."""
    orders = [order("a", 10, amount=10.0), order("a", 10, amount=30.0), order(None, 20, amount=20.0)]
    clicks = [click("c", 5, impression="i1"), click("c", 7, impression="i1"), click(None, 8, impression="i1")]
    views = [view("i1", 1), view("i1", 3), view(None, 4)]
    o, c, v = (spark.createDataFrame(r, s) for r, s in ((orders, ORDER), (clicks, CLICK), (views, VIEW)))
    snapshots = gold.customer_snapshots(attribution_asof(o, c), v, c)
    got = snapshots.select(
        "user_total_orders", "user_avg_basket_value", "user_ad_fatigue_score", "user_historical_ctr"
    )
    assert [tuple(r) for r in got.collect()] == [(1, 20.0, 0.5, 1.0)]
    assert "distinct" not in snapshots._jdf.queryExecution().optimizedPlan().toString().lower()
