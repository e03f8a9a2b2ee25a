from __future__ import annotations

import pytest
from conftest import CLICK, ORDER, VIEW, at, click, order, view

from adlift import schemas as S
from adlift.operators import attribution as A

DAY = 86_400
WEEK = 7 * DAY


def _silver(spark, rule, orders, clicks, **options):
    out = rule(spark.createDataFrame(orders, ORDER), spark.createDataFrame(clicks, CLICK), **options)
    return {r["order_id"]: r for r in out.collect()}


@pytest.mark.parametrize("rule", [A.attribution_asof, A.attribution_global_last])
def test_window_edges_are_inclusive(spark, rule):
    orders = [order("zero", 0), order("week", WEEK), order("late", WEEK + 1), order("before", -1)]
    got = _silver(spark, rule, orders, [click("c", 0)])
    assert {k: r["attributed_click_id"] for k, r in got.items()} == {
        "zero": "c",
        "week": "c",
        "late": None,
        "before": None,
    }
    assert got["zero"]["hours_from_click_to_order"] == 0.0
    assert got["week"]["hours_from_click_to_order"] == 168.0
    assert got["late"]["hours_from_click_to_order"] is None
    assert got["week"]["attribution_status"] == S.CLICK_STATUS
    assert got["late"]["attribution_status"] == S.ORGANIC_STATUS


def test_later_click_separates_the_two_rules(spark):
    orders, clicks = [order("o", 2 * DAY)], [click("c1", DAY), click("c3", 3 * DAY)]
    assert _silver(spark, A.attribution_asof, orders, clicks)["o"]["attributed_click_id"] == "c1"
    assert _silver(spark, A.attribution_global_last, orders, clicks)["o"]["attributed_click_id"] is None


@pytest.mark.parametrize("rule", [A.attribution_asof, A.attribution_global_last])
def test_equal_times_go_to_the_greater_click_id(spark, rule):
    got = _silver(spark, rule, [order("o", 9)], [click("c1", 5), click("c2", 5)])
    assert got["o"]["attributed_click_id"] == "c2"


def test_window_is_a_parameter(spark):
    orders, clicks = [order("o", 20 * DAY)], [click("c", 0)]
    assert _silver(spark, A.attribution_asof, orders, clicks)["o"]["attributed_click_id"] is None
    wide = _silver(spark, A.attribution_asof, orders, clicks, window_days=30)
    assert wide["o"]["attributed_click_id"] == "c"


def test_other_pairs_do_not_match(spark):
    orders = [order("a", 9, customer="v"), order("b", 9, merchant="n"), order("c", 9, customer=None)]
    got = _silver(spark, A.attribution_asof, orders, [click("c", 5), click("d", 5, customer=None)])
    assert len(got) == 3
    assert {r["attributed_click_id"] for r in got.values()} == {None}


def test_view_through_and_precedence(spark):
    orders = spark.createDataFrame(
        [order("edge", DAY), order("past", DAY + 1), order("both", 2 * DAY), order("none", 90 * DAY)], ORDER
    )
    views = spark.createDataFrame([view("i", 0), view("j", 2 * DAY - 60)], VIEW)
    got = {r["order_id"]: r["viewed_impression_id"] for r in A.attribution_view_through(orders, views).collect()}
    assert got == {"edge": "i", "past": None, "both": "j", "none": None}

    clicks = spark.createDataFrame([click("c", 2 * DAY - 3600, impression="k")], CLICK)
    full = {r["order_id"]: r for r in A.attribution_full(orders, clicks, views, view_weight=0.3).collect()}
    assert full["both"]["attribution_status"] == S.CLICK_STATUS
    assert full["both"]["attributed_impression_id"] == "k"
    assert full["both"]["attribution_weight"] == 1.0
    assert full["both"]["hours_from_view_to_order"] is None
    assert full["edge"]["attribution_status"] == S.VIEW_STATUS
    assert full["edge"]["attribution_weight"] == 0.3
    assert full["edge"]["hours_from_view_to_order"] == 24.0
    assert full["past"]["attribution_weight"] == 0.0


def test_global_last_is_within_asof(spark):
    clicks = [click(f"c{i}", i * 7_919 % (9 * DAY), customer=f"u{i % 5}") for i in range(120)]
    orders = [order(f"o{i}", i * 6_007 % (12 * DAY), customer=f"u{i % 6}") for i in range(150)]
    asof = _silver(spark, A.attribution_asof, orders, clicks)
    last = _silver(spark, A.attribution_global_last, orders, clicks)
    assert len(asof) == len(last) == 150
    for oid, row in last.items():
        if row["attributed_click_id"]:
            assert asof[oid]["attributed_click_id"] == row["attributed_click_id"]


def test_summary(spark):
    orders = spark.createDataFrame(
        [order("a", 3600, amount=10.0), order("b", 7200, amount=20.5), order("c", 0, customer="v")], ORDER
    )
    silver = A.attribution_asof(orders, spark.createDataFrame([click("c", 0)], CLICK))
    got = {r["attribution_status"]: tuple(r)[1:] for r in A.attribution_summary(silver).collect()}
    assert got == {S.CLICK_STATUS: (2, 30.5, 15.25, 1.5), S.ORGANIC_STATUS: (1, 10.0, 10.0, None)}


def test_dedup_keeps_the_latest_row(spark):
    rows = [order("a", 1, amount=5.0), order("a", 2, amount=6.0), order("a", 2, amount=7.0), order("b", 1)]
    out = A.dedup_latest(spark.createDataFrame(rows * 3, ORDER), ["order_id"], ["timestamp", "order_amount"])
    assert out.columns == spark.createDataFrame(rows, ORDER).columns
    assert {(r["order_id"], r["timestamp"], r["order_amount"]) for r in out.collect()} == {
        ("a", at(2), 7.0),
        ("b", at(1), 10.0),
    }


def test_rows_without_a_key_are_no_copies(spark):
    orders = spark.createDataFrame([order(None, 1), order(None, 1), order("a", 1), order("a", 2)], ORDER)
    once = A.dedup_latest(orders, ["order_id"], ["timestamp"]).collect()
    assert sorted((r["order_id"] or "", r["timestamp"]) for r in once) == [("", at(1)), ("", at(1)), ("a", at(2))]


def test_copies_with_a_map_column(spark):
    from pyspark.sql import functions as F

    orders = spark.createDataFrame([order("a", 1), order("a", 1), order("b", 2)], ORDER)
    tagged = orders.withColumn("tags", F.create_map(F.lit("k"), F.col("cuisine")))
    once = A.dedup_latest(tagged, ["order_id"], ["timestamp"]).collect()
    assert sorted(r["order_id"] for r in once) == ["a", "b"] and once[0]["tags"] == {"k": "Pizza"}
