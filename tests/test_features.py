from __future__ import annotations

import pytest
from conftest import CLICK, ORDER, VIEW, click, order, view

from adlift.operators import features, gold
from adlift.operators.attribution import attribution_asof

CUSTOMERS = (
    "customer_id string, user_total_orders long, user_avg_basket_value double, user_discount_affinity double, "
    "user_ad_fatigue_score double, user_historical_ctr double, user_preferred_cuisine string"
)
MERCHANTS = (
    "merchant_id string, merchant_total_orders long, merchant_avg_ticket double, "
    "merchant_retail_media_dependency_rate double, merchant_cuisine string"
)


@pytest.fixture(scope="module")
def tables(spark):
    customers = [("u", 3, 20.0, 0.5, 1.5, 0.1, "Pizza"), ("n", 1, None, 0.1, 1.0, 0.2, None)]
    merchants = [("m", 9, 30.0, 0.25, "Pizza"), ("x", 2, 11.0, 0.5, None)]
    return spark.createDataFrame(customers, CUSTOMERS), spark.createDataFrame(merchants, MERCHANTS)


def _lookup(spark, tables, missing):
    asked = [("1", "u", "m"), ("2", "?", "m"), ("3", "u", "?"), ("4", "?", "?"), ("5", "n", "x")]
    requests = spark.createDataFrame(asked, "request_id string, customer_id string, merchant_id string")
    return {r["request_id"]: r for r in features.batch_lookup(requests, *tables, missing=missing).collect()}


def test_serving_defaults_apply_to_unknown_keys_only(spark, tables):
    got = _lookup(spark, tables, "serving_defaults")
    assert got["2"]["user_avg_basket_value"] == 45.0 and got["2"]["user_historical_ctr"] == 0.05
    assert not got["2"]["customer_found"] and got["2"]["merchant_found"]
    assert got["3"]["merchant_avg_ticket"] == 50.0
    assert got["5"]["user_avg_basket_value"] is None
    assert [got[k]["is_affinity_match"] for k in "12345"] == [1, 0, 0, 1, 1]


def test_zero_fill(spark, tables):
    got = _lookup(spark, tables, "zero")
    assert got["2"]["user_avg_basket_value"] == 0.0 and got["5"]["user_avg_basket_value"] == 0.0
    assert [got[k]["is_affinity_match"] for k in "12345"] == [1, 0, 0, 0, 0]


def test_skew_report_finds_the_defaults(spark, tables):
    asked = [(str(i), "u" if i % 2 else "?", "m") for i in range(10)]
    requests = spark.createDataFrame(asked, "request_id string, customer_id string, merchant_id string")
    zero = features.batch_lookup(requests, *tables, missing="zero")
    same = {r["feature"]: r for r in features.feature_skew_report(zero, zero, "request_id").collect()}
    assert {r["mismatches"] for r in same.values()} == {0} and {r["psi"] for r in same.values()} == {0.0}
    served = features.batch_lookup(requests, *tables)
    report = {r["feature"]: r for r in features.feature_skew_report(zero, served, "request_id").collect()}
    assert report["user_avg_basket_value"]["mismatch_rate"] == 0.5
    assert report["user_avg_basket_value"]["psi"] > 1
    assert report["merchant_avg_ticket"]["mismatches"] == 0
    assert report["user_total_orders"]["mismatches"] == 0


def test_observations_fan_out_and_dedup(spark):
    views = spark.createDataFrame([view("i1", 0), view("i2", 0)], VIEW)
    clicks = spark.createDataFrame(
        [click("a", 1, impression="i1"), click("b", 2, impression="i1"), click("c", 2, impression=None)], CLICK
    )
    rows = features.observations_clicked(views, clicks).collect()
    assert sorted((r["impression_id"], r["has_clicked"]) for r in rows) == [("i1", 1), ("i1", 1), ("i2", 0)]
    split = features.observations_clicked(views, clicks, hot_rows=0)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, rows))
    once = features.observations_clicked(views, clicks, dedup=True).collect()
    assert sorted((r["impression_id"], r["has_clicked"]) for r in once) == [("i1", 1), ("i2", 0)]
    silver = attribution_asof(spark.createDataFrame([order("o", 5)], ORDER), clicks.where("click_id != 'c'"))
    sold = features.observations_converted(views, silver).collect()
    assert sorted((r["impression_id"], r["has_converted"]) for r in sold) == [("i1", 1), ("i2", 0)]


def test_training_set_and_matrix(spark, tables):
    views = spark.createDataFrame([view("i1", 0), view("i2", 0, customer="?", device="android")], VIEW)
    observed = features.observations_clicked(views, spark.createDataFrame([], CLICK))
    lookups = [features.customer_lookup(tables[0]), features.merchant_lookup(tables[1])]
    training = features.training_set(observed, lookups)
    assert "customer_id" not in features.training_set(observed, lookups, exclude=["customer_id"]).columns
    matrix = features.training_matrix(training)
    assert matrix.columns == ["impression_id", *features.FEATURE_COLUMNS, "has_clicked"]
    rows = {r["impression_id"]: r for r in matrix.collect()}
    assert rows["i1"]["is_affinity_match"] == 1.0 and rows["i1"]["device_ios"] == 1
    assert rows["i2"]["user_avg_basket_value"] == 0.0 and rows["i2"]["device_ios"] == 0
    assert rows["i1"]["ad_placement_feed_banner_top"] == 1
    assert len(features.FEATURE_COLUMNS) == 13


@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_point_in_time_uses_the_day_before(spark, hot_rows):
    day = 86_400
    views = spark.createDataFrame([view("i1", 10), view("i2", day), view("i3", day + 1), view("i4", 9 * day)], VIEW)
    clicks = spark.createDataFrame([click("c", 20, impression="i1")], CLICK)
    silver = attribution_asof(spark.createDataFrame([order("o", 30), order("p", 3 * day)], ORDER), clicks)
    observed = features.observations_clicked(views, clicks, keep=["timestamp"])
    lookups = [
        features.FeatureLookup(
            gold.customer_snapshots(silver, views, clicks), "customer_id", ("user_total_orders", "user_historical_ctr")
        ),
        features.FeatureLookup(gold.merchant_snapshots(silver), "merchant_id", ("merchant_total_orders",)),
    ]
    out = features.training_set_point_in_time(observed, lookups, hot_rows=hot_rows)
    got = {
        r["impression_id"]: (r["user_total_orders"], r["user_historical_ctr"], r["merchant_total_orders"])
        for r in out.collect()
    }
    # A snapshot at midnight is not yet usable at midnight.
    assert got == {"i1": (None, None, None), "i2": (None, None, None), "i3": (1, 1.0, 1), "i4": (2, 0.3333, 2)}


def test_keys_are_counted_without_the_features_looked_up_before(spark, tables, monkeypatch):
    from adlift.operators import ordered

    counted = []

    def counting(frames, keys, *rest):
        counted.append((frames[0].columns, keys))
        return []

    monkeypatch.setattr(ordered, "hot_buckets", counting)
    clicks = spark.createDataFrame([click("c", 5)], CLICK)
    views = spark.createDataFrame([view("i0", 1)], VIEW)
    observed = features.observations_clicked(views, clicks, keep=["timestamp"])
    silver = attribution_asof(spark.createDataFrame([order("a", 9)], ORDER), clicks)
    counted.clear()
    lookups = [
        features.customer_lookup(gold.customer_snapshots(silver, views, clicks)),
        features.merchant_lookup(gold.merchant_snapshots(silver)),
    ]
    assert features.training_set_point_in_time(observed, lookups).count() == 1
    assert counted == [(observed.columns, ["customer_id"]), (observed.columns, ["merchant_id"])]


def test_primary_key_check(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert tuple(features.primary_key_check("t", df, ["k"]).first()) == ("t", 4, 2, 1, 1)
