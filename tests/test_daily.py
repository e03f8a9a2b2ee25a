"""Logs in date folders, and trailing windows from whole days and two cut days."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from conftest import CLICK, ORDER, T0, VIEW, at, click, order, view
from pyspark.sql import functions as F

from adlift.operators import daily, gold
from adlift.session import fresh_dir
from adlift.sources import sinks
from adlift.sources.versions import publish, read_published

DAY = 86_400
PRUNED = "PartitionFilters: ["


def _published(spark, df):
    root = fresh_dir(spark, "daily")
    publish(daily.in_folders(df), root, ["event_date"])
    return read_published(spark, root)


def _tables(spark, facts):
    facts = _published(spark, facts)
    return _published(spark, daily.per_day(facts)), facts


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _literal(seconds):
    return F.lit(f"{at(seconds):%Y-%m-%d %H:%M:%S}").cast("timestamp")


def _logs(seed, people=("u", "v", None)):
    draw = random.Random(seed)
    views, clicks, orders = [], [], []
    for i in range(400):
        seconds = draw.randrange(12 * DAY) if i % 7 else draw.randrange(12) * DAY
        views.append(view(f"i{i}", seconds, customer=draw.choice(people)))
        # Clicks on the spot, on another day, and before their impression.
        for k in range(draw.choice([0, 0, 1, 2])):
            later = draw.choice([0, 5, DAY, 3 * DAY, -60])
            clicks.append(click(f"c{i}_{k}", seconds + later, customer="other", impression=f"i{i}"))
        orders.append(order(f"o{i}", draw.randrange(12 * DAY), customer=draw.choice(people)))
    return views, clicks, orders


@pytest.mark.parametrize("asked", [6 * DAY, 6 * DAY + 50_000, 40 * DAY, 0])
@pytest.mark.parametrize("days", [0, 1, 3, 7])
def test_windows_against_brute_force(spark, logs_of_days, asked, days):
    (views, clicks, orders), order_tables, ad_tables = logs_of_days
    now, start = at(asked), at(asked) - timedelta(days=days)

    bought = {}
    for o in orders:
        if start < o[1] <= now:
            bought[o[2]] = bought.get(o[2], 0) + 1
    got = daily.trailing_orders(*order_tables, _literal(asked), days)
    assert {r[0]: r[1] for r in got.collect()} == bought

    shown = {v[0]: v[2] for v in views if start < v[1] <= now}
    counts = {}
    for customer in shown.values():
        n, c = counts.get(customer, (0, 0))
        counts[customer] = (n + 1, c)
    for c in clicks:
        if c[1] in shown and c[2] <= now:
            n, k = counts[shown[c[1]]]
            counts[shown[c[1]]] = (n, k + 1)
    got = daily.trailing_fatigue(*ad_tables, _literal(asked), days).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == counts
    assert all(r[3] == pytest.approx(r[1] / (r[2] + 1), abs=0.0051) for r in got)


@pytest.fixture(scope="module")
def logs_of_days(spark):
    views, clicks, orders = _logs(5)
    v, c, o = (spark.createDataFrame(r, s) for r, s in ((views, VIEW), (clicks, CLICK), (orders, ORDER)))
    # Rows without an id or a time, and clicks on nothing known, are no facts.
    v = v.unionByName(spark.createDataFrame([(None, at(9), "u", *[None] * 4), ("x", None, "u", *[None] * 4)], VIEW))
    c = c.unionByName(
        spark.createDataFrame(
            [(None, "i1", at(9), *["u"] * 3), ("x", "i1", None, *["u"] * 3), ("y", "i?", at(9), *["u"] * 3)], CLICK
        )
    )
    o = o.unionByName(spark.createDataFrame([(None, at(9), "u", *[None] * 4), ("x", None, "u", *[None] * 4)], ORDER))
    return (
        (views, clicks, orders),
        _tables(spark, daily.order_facts(o)),
        _tables(spark, daily.ad_facts(v, c)),
    )


def test_windows_read_their_days_only(spark, logs_of_days):
    days, facts = logs_of_days[1]
    plan = _plan(daily.trailing_orders(days, facts, _literal(6 * DAY + 50_000), 3))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and all("event_date" in s.split(PRUNED)[1].split("]")[0] for s in scans)
    # The facts of the days between are read only where they were known on the last day.
    assert any("EqualTo(known_date,2024-01-07)" in s for s in scans)


def test_empty_tables(spark):
    none = spark.createDataFrame([], ORDER)
    tables = _tables(spark, daily.order_facts(none))
    assert daily.trailing_orders(*tables, _literal(DAY), 3).collect() == []
    ads = _tables(spark, daily.ad_facts(spark.createDataFrame([], VIEW), spark.createDataFrame([], CLICK)))
    assert daily.trailing_fatigue(*ads, _literal(DAY), 3).collect() == []


def test_log_in_date_folders(spark):
    _, _, orders = _logs(6)
    path = fresh_dir(spark, "log")
    rows = spark.createDataFrame([*orders, ("late", None, "u", "m", 1.0, 0, "Pizza")], ORDER)
    found = sinks.write_log(rows, path, ["customer_id"], ["merchant_id"])
    assert found.last == max(o[1] for o in orders)
    assert [sum(s.top.values()) for s in found.summaries] == [401, 401]
    dated = spark.read.parquet(path)
    assert dated.count() == 401

    # Both sides of midnight, and the same answer as from the log as it came.
    for asked in (6 * DAY, 6 * DAY + 1, 6 * DAY - 1):
        want = {tuple(r) for r in gold.orders_last_days(rows, _literal(asked), 2).collect()}
        pruned = gold.orders_last_days(dated, _literal(asked), 2)
        assert {tuple(r) for r in pruned.collect()} == want and want
        filters = _plan(pruned).split(PRUNED)[1].split("]")[0]
        assert "event_date" in filters and "2024-01-0" in filters


def test_empty_log_in_date_folders(spark):
    path = fresh_dir(spark, "log")
    found = sinks.write_log(spark.createDataFrame([], ORDER), path, ["customer_id"])
    assert found.last is None and found.summaries[0].top == {}
    read = spark.read.parquet(path)
    assert read.count() == 0 and "event_date" in read.columns
    assert gold.orders_last_days(read, F.lit(T0), 30).collect() == []
