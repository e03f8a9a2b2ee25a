from __future__ import annotations

import pytest
from conftest import CLICK, ORDER, VIEW, at, click, order, view

from adlift.operators.attribution import attribution_asof, attribution_view_through
from adlift.session import fresh_dir
from adlift.streaming.attribution import TOUCH, SilverStream, matched_clicks, touches
from adlift.streaming.ingest import append_stream, drop_replays, read_stream

DAY = 86_400


def _feed(spark, job, source, *frames):
    """One more file per frame, then everything that has arrived is processed."""
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(source)
    job.run(read_stream(spark, source, TOUCH, files_per_batch=1))


def _clicks(spark, *rows):
    return touches(spark.createDataFrame(list(rows), CLICK), "click")


def _orders(spark, *rows):
    return touches(spark.createDataFrame(list(rows), ORDER), "order")


def _state(spark, job):
    return {r["order_id"]: r["attributed_click_id"] for r in job.silver(spark).collect()}


def test_late_clicks_reattribute_written_orders(spark):
    job, source = SilverStream(fresh_dir(spark, "job")), fresh_dir(spark, "source")
    _feed(spark, job, source, _orders(spark, order("o", 5 * DAY), order("n", 5 * DAY, customer=None)))
    assert _state(spark, job) == {"o": None, "n": None}
    _feed(spark, job, source, _clicks(spark, click("c1", DAY)))
    assert _state(spark, job) == {"o": "c1", "n": None}
    _feed(spark, job, source, _clicks(spark, click("c2", 3 * DAY), click("c9", 6 * DAY)))
    assert _state(spark, job)["o"] == "c2"
    _feed(spark, job, source, _orders(spark, order("p", 6 * DAY + 1)))
    assert _state(spark, job) == {"o": "c2", "n": None, "p": "c9"}
    assert {tuple(r)[:2] for r in matched_clicks(job.silver(spark)).collect()} == {("o", "c2"), ("p", "c9")}


def test_running_a_batch_again_changes_nothing(spark):
    job, source = SilverStream(fresh_dir(spark, "job")), fresh_dir(spark, "source")
    first, second = _orders(spark, order("o", 2 * DAY)), _clicks(spark, click("c", DAY))
    _feed(spark, job, source, first, second)
    before = sorted(map(str, job.silver(spark).collect()))
    job.process(spark, second, 1)
    assert sorted(map(str, job.silver(spark).collect())) == before
    assert job.history(spark, 1).count() == 2


def test_replayed_events_count_once(spark):
    job, source = SilverStream(fresh_dir(spark, "job")), fresh_dir(spark, "source")
    o, c = _orders(spark, order("o", 2 * DAY)), _clicks(spark, click("c", DAY))
    _feed(spark, job, source, c, o, o, c)
    assert job.history(spark, 99).count() == 2
    assert _state(spark, job) == {"o": "c"}


def test_events_behind_the_watermark_are_ignored(spark):
    job, source = SilverStream(fresh_dir(spark, "job"), window_days=60), fresh_dir(spark, "source")
    _feed(spark, job, source, _orders(spark, order("o", 50 * DAY)), _orders(spark, order("p", 51 * DAY)))
    _feed(spark, job, source, _clicks(spark, click("in", 40 * DAY), click("out", 10 * DAY)))
    assert _state(spark, job) == {"o": "in", "p": "in"}
    assert job.history(spark, 99).where("event_id = 'out'").count() == 0


@pytest.mark.parametrize("rule", ["click", "view"])
def test_stream_equals_batch_in_any_order(spark, rule):
    views = [view(f"i{n}", n * 37_003 % (20 * DAY), customer=f"u{n % 4}") for n in range(60)]
    clicks = [click(f"c{n}", n * 41_011 % (20 * DAY), customer=f"u{n % 4}") for n in range(60)]
    orders = [order(f"o{n}", n * 29_017 % (20 * DAY), customer=f"u{n % 5}") for n in range(80)]
    v, c, o = (spark.createDataFrame(r, s) for r, s in ((views, VIEW), (clicks, CLICK), (orders, ORDER)))
    job, source = SilverStream(fresh_dir(spark, "job"), rule), fresh_dir(spark, "source")
    ads = touches(c, "click") if rule == "click" else touches(v, "impression")
    sold = touches(o, "order")
    _feed(spark, job, source, sold.where("event_id < 'o4'"), ads.where("event_id < 'c3' AND event_id < 'i5'"))
    _feed(spark, job, source, ads, sold)
    batch = attribution_asof(o, c) if rule == "click" else attribution_view_through(o, v)
    got = sorted(map(str, job.silver(spark).select(*batch.columns).collect()))
    assert got == sorted(map(str, batch.collect()))


def test_ingest_appends_once(spark):
    source, target = fresh_dir(spark, "in"), fresh_dir(spark, "bronze")
    df = spark.createDataFrame([view(f"i{n}", n * 1000) for n in range(20)], VIEW)
    for _ in range(2):
        df.coalesce(1).write.mode("append").parquet(source)
        stream = read_stream(spark, source, df.schema, files_per_batch=1)
        append_stream(drop_replays(stream, ["impression_id"]), target, f"{target}-checkpoint")
    back = spark.read.parquet(target)
    assert back.count() == 20 and "batch" in back.columns
    assert back.agg({"timestamp": "max"}).first()[0] == at(19_000)


def test_ingest_keeps_rows_without_id(spark):
    source, target = fresh_dir(spark, "in"), fresh_dir(spark, "bronze")
    rows = [view(None if n % 3 else f"i{n}", n * 1000) for n in range(12)]
    df = spark.createDataFrame(rows, VIEW)
    for thin in (False, True):
        df.coalesce(1).write.mode("append").parquet(source)
        stream = read_stream(spark, source, df.schema, files_per_batch=1)
        append_stream(drop_replays(stream, ["impression_id"], thin=thin), f"{target}-{thin}", f"{target}-c-{thin}")
    for thin, files in ((False, 1), (True, 2)):
        back = spark.read.parquet(f"{target}-{thin}")
        assert back.where("impression_id IS NULL").count() == 8 * files
        assert back.where("impression_id IS NOT NULL").count() == 4


def test_orders_without_id_are_attributed_again(spark):
    job, source = SilverStream(fresh_dir(spark, "job")), fresh_dir(spark, "source")
    nameless = [order(None, 5 * DAY), order(None, 5 * DAY), order(None, 6 * DAY), order(None, 5 * DAY, customer=None)]
    _feed(spark, job, source, _orders(spark, *nameless, order("o", 5 * DAY)))
    _feed(spark, job, source, _clicks(spark, click("c1", DAY)))
    _feed(spark, job, source, _clicks(spark, click("c2", 5 * DAY + 1)))
    _feed(spark, job, source, _orders(spark, order(None, 5 * DAY)))
    got = [(r["order_id"], r["customer_id"], r["attributed_click_id"]) for r in job.silver(spark).collect()]
    want = [(None, "u", "c1")] * 3 + [(None, "u", "c2"), (None, None, None), ("o", "u", "c1")]
    assert sorted(got, key=str) == sorted(want, key=str)
