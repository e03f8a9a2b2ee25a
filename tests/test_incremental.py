"""Gold kept up batch by batch equals a full build."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adlift.operators.gold import gold_customer_features, gold_merchant_features
from adlift.plans.incremental import IncrementalGold
from adlift.session import fresh_dir
from adlift.sources.versions import file_system

SILVER = (
    "order_id string, customer_id string, merchant_id string, order_amount double, used_coupon int, "
    "cuisine string, attribution_status string"
)
VIEWS = "impression_id string, customer_id string, extra int"
CLICKS = "click_id string, impression_id string, customer_id string"


def batches(n_keys=30):
    rng = random.Random(4)
    keys = [f"u{i}" for i in range(n_keys)] + [None]
    out = []
    orders = {}
    for b in range(3):
        silver = []
        for i in range(60):
            again = b and i % 4 == 0
            oid = rng.choice([o for o in orders]) if again else (f"o{b}-{i}" if i % 13 else None)
            if oid is not None and any(row[0] == oid for row in silver):
                continue
            customer, merchant = orders.get(oid, (rng.choice(keys), f"m{rng.randrange(5)}"))
            if oid is not None:
                orders[oid] = customer, merchant
            status = rng.choice(["attributed_click", "organic"])
            silver.append((oid, customer, merchant, rng.choice([None, 5.0, 7.25]), rng.choice([0, 1, None]),
                           rng.choice(["Pizza", "Burger", None]), status))
        views = [(f"i{rng.randrange(90)}", rng.choice(keys), b) for _ in range(40)] + [(None, "u1", 0)]
        clicks = [(rng.choice([f"c{rng.randrange(60)}", None]), f"i{rng.randrange(100)}", "u0") for _ in range(40)]
        out.append((silver, views, clicks))
    return out


def rows(df):
    return Counter(map(tuple, df.drop("last_feature_update").collect()))


def everything(spark, done):
    newest, nameless = {}, []
    for silver, _, _ in done:
        nameless += [r for r in silver if r[0] is None]
        newest |= {r[0]: r for r in silver if r[0] is not None}
    return (
        spark.createDataFrame([*newest.values(), *nameless], SILVER),
        spark.createDataFrame([v for b in done for v in b[1]], VIEWS),
        spark.createDataFrame([c for b in done for c in b[2]], CLICKS),
    )


def frames(spark, batch):
    return [spark.createDataFrame(r, s) for r, s in zip(batch, (SILVER, VIEWS, CLICKS))]


def test_equal_to_a_full_build_after_every_batch(spark):
    gold, given = IncrementalGold(spark, fresh_dir(spark, "incremental"), buckets=4), batches()
    for b, batch in enumerate(given):
        assert gold.add(b, *frames(spark, batch))
        silver, views, clicks = everything(spark, given[: b + 1])
        assert rows(gold.customers()) == rows(gold_customer_features(silver, views, clicks))
        assert rows(gold.merchants()) == rows(gold_merchant_features(silver))
    assert not gold.add(1, *frames(spark, given[0]))  # delivered again
    before = rows(gold.customers())
    gold.merge()
    assert gold.add(3, *frames(spark, ([], [], [])))
    assert rows(gold.customers()) == before


def test_other_buckets_are_neither_read_nor_written(spark):
    gold, given = IncrementalGold(spark, fresh_dir(spark, "incremental"), buckets=16), batches()
    gold.add(0, *frames(spark, given[0]))
    _, before = gold.table.entries()
    one = [("x1", "u3", "m1", 4.0, 1, "Pizza", "organic")], [], []
    bucket = spark.createDataFrame([("u3",)], "customer_id string").select(gold._bucket("customer_id")).first()[0]
    # Files of untouched customers may be gone: nothing of the batch needs them.
    fs, path = file_system(spark, gold.root)
    lost = [e for e in before if e["kind"] in ("customers", "customer_orders") and e["bucket"] != bucket]
    assert lost
    for e in lost:
        fs.rename(path(e["path"]), path(f"{gold.root}/aside-{e['kind']}-{e['bucket']}"))
    gold.add(1, *frames(spark, one))
    _, after = gold.table.entries()
    paths = lambda entries: {e["path"] for e in entries if e["kind"] == "customers" and e["bucket"] != bucket}
    assert paths(before) == paths(after)


def test_a_batch_that_dies_changes_nothing(spark, monkeypatch):
    gold, given = IncrementalGold(spark, fresh_dir(spark, "incremental"), buckets=4), batches()
    gold.add(0, *frames(spark, given[0]))
    before = rows(gold.customers())

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(IncrementalGold, "_refolded", dies)
        with pytest.raises(RuntimeError):
            gold.add(1, *frames(spark, given[1]))
    assert rows(gold.customers()) == before
    assert gold.add(1, *frames(spark, given[1]))
    silver, views, clicks = everything(spark, given[:2])
    assert rows(gold.customers()) == rows(gold_customer_features(silver, views, clicks))
    assert gold.customers().where(F.col("customer_id").isNull()).count() == 1


def test_lists_of_customers_and_of_events_are_not_sent_to_the_driver(spark):
    silver = spark.createDataFrame([("o1", "u1", "m1", 5.0, 0, "Pizza", "organic")], SILVER)
    views = spark.createDataFrame([("i1", "u1", 0)], VIEWS)
    clicks = spark.createDataFrame([("c1", "i1", "u1")], CLICKS)
    kept = IncrementalGold(spark, fresh_dir(spark, "incremental"), buckets=2)
    kept.add(0, silver, views, clicks)
    facts = kept.table.entries()[1]
    for df in (kept._matches(facts, facts), gold_customer_features(silver, views, clicks)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
