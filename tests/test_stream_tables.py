"""Manifests, merges, late rows, arm sums and the interval join."""

from __future__ import annotations

import random
from datetime import timedelta

import pandas as pd
import pytest
from conftest import CLICK, ORDER, T0, at, click, order
from pyspark.sql import functions as F

import adlift.sources.versions as versions
from adlift.operators.bandit import weighted_arms
from adlift.plans.queries import _exact_files
from adlift.session import fresh_dir
from adlift.sources.versions import Versions, VersionTaken, publish, read_published
from adlift.streaming.arms import SERVED, ArmStream
from adlift.streaming.attribution import TOUCH, SilverStream, touches
from adlift.streaming.ingest import CountedIngest, append_stream, read_stream
from adlift.streaming.interval import HEARTBEAT, SETTLED, run_interval_join, settle

DAY = 86_400


def test_a_reader_during_a_rewrite_sees_one_version_whole(spark):
    root = fresh_dir(spark, "published")
    with pytest.raises(FileNotFoundError):
        read_published(spark, root)
    assert publish(spark.range(5).withColumn("day", F.lit(1)), root, ["day"]) == 1
    reader = read_published(spark, root)
    # The next version is computed from the table itself.
    assert publish(reader.withColumn("id", F.col("id") + 100), root, ["day"]) == 2
    assert sorted(r.id for r in reader.collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.id for r in read_published(spark, root).collect()) == [100, 101, 102, 103, 104]
    assert read_published(spark, root, 1).count() == 5


def test_a_writer_that_dies_or_comes_second_changes_nothing(spark, monkeypatch):
    root = fresh_dir(spark, "published")
    publish(spark.range(3), root)
    table = Versions(spark, root)
    with pytest.raises(VersionTaken):
        table.commit(0, [])
    monkeypatch.setattr(versions.Versions, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        publish(spark.range(9), root)
    assert read_published(spark, root).count() == 3 and table.numbers() == [1]


def _batches(seed=1):
    """Orders and clicks of some months in order of arrival, late clicks among them."""
    rng = random.Random(seed)
    out = []
    for k in range(5):
        base = k * 20 * DAY
        orders = [order(f"o{k}-{i}", base + rng.randrange(20 * DAY), merchant=rng.choice("ab")) for i in range(8)]
        clicks = [click(f"c{k}-{i}", max(0, base - 5 * DAY) + rng.randrange(20 * DAY), merchant=rng.choice("ab")) for i in range(8)]
        out.append((orders + ([(None, at(base), "u", "a", 1.0, 0, "x")] if k == 1 else []), clicks))
    return out


def test_merges_change_no_row(spark, monkeypatch):
    job = SilverStream(fresh_dir(spark, "job"))
    rows = lambda: sorted(map(str, job.silver(spark).collect()))
    touched = []
    for orders, clicks in _batches():
        both = touches(spark.createDataFrame(orders, ORDER), "order").unionByName(touches(spark.createDataFrame(clicks, CLICK), "click"))
        touched.append(both.coalesce(1))
    for number in (0, 1, 2):
        job.process(spark, touched[number], number)
    before = rows()
    with monkeypatch.context() as m:
        m.setattr(Versions, "commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job.merge(spark)
    assert rows() == before
    job.merge(spark)
    assert rows() == before
    entries = Versions(spark, job.versions).entries()[1]
    assert all(e["base"] for e in entries)
    job.process(spark, touched[2], 2)  # run again after the merge: it is in already
    assert rows() == before and Versions(spark, job.versions).entries()[1] == entries
    for number in (3, 4):
        job.process(spark, touched[number], number)
    before = rows()
    job.merge(spark)
    after = Versions(spark, job.versions).entries()[1]
    assert rows() == before and len({e["span"] for e in after}) == len(after)
    # Spans that the new deltas do not reach keep their folders.
    assert {e["path"] for e in after} & {e["path"] for e in entries}
    log = sorted(map(str, job.history(spark, 9).collect()))
    job.merge_log(spark, T0 + timedelta(days=45))
    folders = Versions(spark, job.log).entries()[1]
    assert 1 < len(folders) < 5 and sorted(map(str, job.history(spark, 9).collect())) == log
    whole = SilverStream(fresh_dir(spark, "whole"))
    whole.process(spark, touched[0].unionByName(touched[1]).unionByName(touched[2]).unionByName(touched[3]).unionByName(touched[4]), 0)
    assert sorted(map(str, whole.silver(spark).collect())) == before


def test_arm_sums_count_every_batch_once(spark):
    job = ArmStream(fresh_dir(spark, "arms"))
    batch = lambda *rows: spark.createDataFrame([(f"r{i}", at(i), c, k) for i, (c, k) in enumerate(rows)], SERVED)
    said = lambda: {tuple(r) for r in job.totals(spark).collect()}
    one, two, three = batch(("a", 1), ("a", 0)), batch(("b", 1)), batch(("a", 1), ("b", None))
    for number, rows in ((0, one), (1, two), (1, two), (2, three)):
        job.process(spark, rows, number)
    want = {("a", 3, 2), ("b", 2, 1)}
    assert said() == want
    job.merge(spark)
    assert said() == want and len(Versions(spark, job.sums).entries()[1]) == 2
    job.process(spark, one, 0)
    job.process(spark, three, 2)
    assert said() == want
    catalog = spark.createDataFrame([("a", "s", 1.0), ("b", "s", 1.0), ("z", "t", 1.0)], "creative_id string, segment_id string, mab_arm_weight double")
    got = {r.creative_id: r.mab_arm_weight for r in weighted_arms(catalog, job.totals(spark)).collect()}
    rate = 4 / 7
    assert got == {"a": pytest.approx((2 + 10 * rate) / 13 / rate, abs=1e-6), "b": pytest.approx((1 + 10 * rate) / 12 / rate, abs=1e-6), "z": 1.0}


def test_every_delivered_row_is_kept_or_late(spark):
    source = fresh_dir(spark, "source")
    slices = [[("n", 100 * DAY), ("m", 99 * DAY)], [("x", 60 * DAY), ("n", 100 * DAY)], [("y", 50 * DAY), ("y", 50 * DAY), (None, 1 * DAY), ("m", 99 * DAY)], [("y", 50 * DAY), ("x", 60 * DAY), ("z", 98 * DAY)]]
    frames = [spark.createDataFrame([(i, at(s), 1.0) for i, s in rows], "id string, timestamp timestamp, amount double") for rows in slices]
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(source)
    job, schema = CountedIngest(fresh_dir(spark, "counted"), ("id",)), frames[0].schema
    job.run(read_stream(spark, source, schema, files_per_batch=1))
    kept = sorted(str(r.id) for r in job.kept(spark, schema).collect())
    late = sorted(r.id for r in job.late(spark, schema).collect())
    assert sorted(kept + late) == ["None", "m", "n", "x", "y", "z"] and "y" in late and {"n", "m", "z", "None"} <= set(kept)
    batch = frames[2].withColumn("_kept", F.lit(False)).unionByName(frames[2].where("id IS NULL").withColumn("_kept", F.lit(True)))
    job.account(spark, batch, schema, 2)  # the third batch run again
    assert sorted(r.id for r in job.late(spark, schema).collect()) == late


def test_settled_orders_equal_brute_force():
    rng = random.Random(8)
    for _ in range(60):
        events = [(rng.choice(["order", "click"]), f"e{i}" if rng.random() < 0.9 else None, rng.randrange(60)) for i in range(rng.randint(1, 25))]
        events += [e for e in events if e[1] and rng.random() < 0.3]
        window, cuts = 10, sorted(rng.sample(range(70), 3)) + [1000]
        state, got = pd.DataFrame({"kind": [], "event_id": [], "at": pd.Series([], dtype="int64")}), []
        late = -1
        arrival = sorted(events, key=lambda e: e[2] + rng.randrange(8))
        for k, cut in enumerate(cuts):
            part = [e for e in arrival[k * len(arrival) // 4 : (k + 1) * len(arrival) // 4] if e[2] > late]
            taken = part if k else part
            rows = pd.concat([state, pd.DataFrame(taken, columns=["kind", "event_id", "at"])], ignore_index=True).astype({"at": "int64"})
            out, state = settle(rows, cut, window)
            got += list(out.itertuples(index=False, name=None))
            for kind, event, when in taken:
                _SEEN.setdefault(id(events), []).append((kind, event, when))
            late = cut
        seen = _SEEN.pop(id(events), [])
        once = {(k, e, w) for k, e, w in seen if e is not None}
        orders = [o for o in once if o[0] == "order"] + [s for s in seen if s[1] is None and s[0] == "order"]
        clicks = [c for c in once if c[0] == "click"] + [s for s in seen if s[1] is None and s[0] == "click"]
        want = []
        for _, name, when in orders:
            near = [w for _, _, w in clicks if when - window <= w <= when]
            want.append((str(name), when, max(near, default=-1)))
        assert sorted((str(n), w, c) for n, w, _, c in got) == sorted(want)


_SEEN: dict[int, list] = {}


def test_interval_join_of_two_streams_holds_a_bounded_state(spark):
    source, target = fresh_dir(spark, "source"), fresh_dir(spark, "settled")
    beat = [F.lit({"kind": HEARTBEAT, "timestamp": at(200 * DAY)}.get(f.name)).cast(f.dataType).alias(f.name) for f in TOUCH]
    feed = []
    for k in range(4):
        orders = [order(f"o{k}", 30 * k * DAY + 10 * DAY), order(f"n{k}", 30 * k * DAY + 10 * DAY, customer=None)]
        clicks = [click(f"a{k}", 30 * k * DAY + 4 * DAY), click(f"b{k}", 30 * k * DAY + 9 * DAY), click(f"z{k}", 30 * k * DAY + 11 * DAY)]
        feed.append(touches(spark.createDataFrame(orders, ORDER), "order").unionByName(touches(spark.createDataFrame(clicks, CLICK), "click")))
        feed.append(feed[-1])  # replayed
    feed.append(spark.range(1).select(*beat))
    for df in feed:
        df.coalesce(1).write.mode("append").parquet(source)
    progress = run_interval_join(read_stream(spark, source, TOUCH, files_per_batch=2), target, f"{target}-checkpoint", delay="1 day")
    got = {(r.order_id, r.click_id) for r in spark.read.schema(SETTLED).parquet(target).collect()}
    assert got == {(f"o{k}", f"b{k}") for k in range(4)} | {(f"n{k}", None) for k in range(4)}
    rows = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in progress]
    assert max(rows) <= 4 and rows[-1] == 0  # two pairs, each with its value and its timer at most


def test_interval_join_keeps_one_state_per_bucket_of_pairs(spark):
    source, target = fresh_dir(spark, "source"), fresh_dir(spark, "settled")
    pairs = [(f"c{k % 20}" if k % 7 else None, f"m{k}") for k in range(60)]
    orders = [order(f"o{k}", 9 * DAY, customer=c, merchant=m) for k, (c, m) in enumerate(pairs)]
    clicks = [click(f"a{k}", (8 if k % 2 else 1) * DAY, customer=c, merchant=m) for k, (c, m) in enumerate(pairs)]
    beats = [
        spark.range(1).select(
            *[F.lit({"kind": HEARTBEAT, "timestamp": at(days * DAY)}.get(f.name)).cast(f.dataType).alias(f.name) for f in TOUCH]
        )
        for days in (10, 60)
    ]
    logs = touches(spark.createDataFrame(orders, ORDER), "order").unionByName(touches(spark.createDataFrame(clicks, CLICK), "click"))
    for df in (logs, *beats):
        df.coalesce(1).write.mode("append").parquet(source)
    stream = read_stream(spark, source, TOUCH, files_per_batch=1)
    progress = run_interval_join(stream, target, f"{target}-checkpoint", delay="30 days", buckets=4)
    got = {(r.order_id, r.customer_id, r.merchant_id, r.click_id) for r in spark.read.schema(SETTLED).parquet(target).collect()}
    assert got == {(f"o{k}", c, m, f"a{k}" if k % 2 else None) for k, (c, m) in enumerate(pairs)}
    rows = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in progress]
    assert 0 < max(rows) <= 8 and rows[-1] == 0  # four buckets, each with its value and its timer


def test_a_slice_is_dealt_into_exactly_as_many_files_as_a_batch_takes(spark):
    path = fresh_dir(spark, "slices")
    for rows in (1_000, 1, 0):
        _exact_files(spark.range(rows), path, 3)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count()
    assert spark.read.parquet(path).count() == 1_001 and max(r["count"] for r in files.collect()) < 400
    target, stream = fresh_dir(spark, "taken"), read_stream(spark, path, spark.range(0).schema, files_per_batch=3)
    append_stream(stream, target, f"{target}-checkpoint")
    taken = {r.batch: r["count"] for r in spark.read.parquet(target).groupBy("batch").count().collect()}
    assert taken == {0: 1_000, 1: 1}
