"""The skew-split plans against brute force, at thresholds that make every key hot or none."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from conftest import T0, at
from pyspark.sql import functions as F

from adlift.functions.scalars import DAY_US
from adlift.operators.attribution import attribution_asof
from adlift.operators.ordered import Lookup, asof_join, rank_latest_first, trailing_sums
from adlift.operators.skew import hot_buckets, split

HOT = [0, 30, 10**9]


def _rows(seed: int, n: int, prefix: str, span: int = 4_000):
    """Rows of which a third share one key, with many equal times."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(12)}"
        rows.append((f"{prefix}{i:04d}", key if rng.random() > 0.05 else None, rng.randrange(span)))
    return rows


def _frame(spark, rows, name):
    return spark.createDataFrame(
        [(i, k, T0 + timedelta(seconds=t)) for i, k, t in rows], f"{name} string, key string, ts timestamp"
    )


@pytest.mark.parametrize("hot_rows", HOT)
@pytest.mark.parametrize("strict", [False, True])
def test_asof_matches_brute_force(spark, hot_rows, strict):
    left, right = _rows(1, 300, "l"), _rows(2, 300, "r")
    other = _rows(3, 100, "o")
    looks = [
        Lookup("r", _frame(spark, right, "rid"), "ts", "rid", within_us=900 * 1_000_000, strict=strict),
        Lookup("o", _frame(spark, other, "oid"), "ts", "oid"),
    ]
    out = asof_join(_frame(spark, left, "lid"), looks, ["key"], "ts", hot_rows)
    got = {(r["lid"], r["r"] and r["r"]["rid"], r["o"] and r["o"]["oid"]) for r in out.collect()}

    def best(rows, key, t, strictly, within):
        fits = [
            (s, i)
            for i, k, s in rows
            if k is not None and k == key and (s < t if strictly else s <= t) and t - s <= within
        ]
        return max(fits)[1] if fits else None

    want = {(i, best(right, k, t, strict, 900), best(other, k, t, False, 10**9)) for i, k, t in left}
    assert got == want
    assert out.count() == len(left)


@pytest.mark.parametrize("hot_rows", HOT)
def test_asof_keeps_copies_of_left_rows(spark, hot_rows):
    left = _frame(spark, [("a", "x", 10)] * 50 + [("b", "y", 5)], "lid")
    right = _frame(spark, [("r1", "x", 3), ("r2", "x", 3)] * 40, "rid")
    out = asof_join(left, [Lookup("r", right, "ts", "rid")], ["key"], "ts", hot_rows)
    rows = out.collect()
    assert len(rows) == 51
    assert {r["r"]["rid"] for r in rows if r["lid"] == "a"} == {"r2"}
    assert [r["r"] for r in rows if r["lid"] == "b"] == [None]


@pytest.mark.parametrize("hot_rows", HOT)
def test_rank_matches_brute_force(spark, hot_rows):
    rows = _rows(4, 400, "c", span=300)
    out = rank_latest_first(_frame(spark, rows, "id"), ["key"], "ts", "id", "rank", hot_rows)
    got = {r["id"]: r["rank"] for r in out.collect()}
    want = {}
    for key in {k for _, k, _ in rows}:
        mine = sorted(((t, i) for i, k, t in rows if k == key), reverse=True)
        want.update({i: n for n, (_, i) in enumerate(mine, 1)})
    assert got == want


@pytest.mark.parametrize("hot_rows", HOT)
def test_trailing_sums_match_brute_force(spark, hot_rows):
    span = 20 * 86_400
    at_rows, event_rows = _rows(5, 150, "a", span), _rows(6, 500, "e", span)
    events = _frame(spark, event_rows, "eid").withColumn("one", F.lit(1))
    out = trailing_sums(
        _frame(spark, at_rows, "aid"),
        events,
        ["key"],
        "ts",
        "ts",
        {"d1": ("one", DAY_US), "d7": ("one", 7 * DAY_US)},
        hot_rows,
    )
    got = {r["aid"]: (r["d1"], r["d7"]) for r in out.collect()}
    want = {
        i: tuple(
            sum(1 for _, ek, et in event_rows if ek is not None and ek == k and t - days * 86_400 <= et < t)
            for days in (1, 7)
        )
        for i, k, t in at_rows
    }
    assert got == want


def test_trailing_window_edges(spark):
    events = _frame(spark, [("e1", "x", 0), ("e2", "x", 86_400)], "eid").withColumn("one", F.lit(1))
    probes = _frame(spark, [("p1", "x", 86_400), ("p2", "x", 86_401)], "pid")
    out = trailing_sums(probes, events, ["key"], "ts", "ts", {"n": ("one", DAY_US)})
    assert {r["pid"]: r["n"] for r in out.collect()} == {"p1": 1, "p2": 1}


def test_only_outlying_buckets_are_hot(spark):
    df = _frame(spark, [(f"i{i}", "hot" if i % 3 == 0 else f"k{i}", i) for i in range(900)], "id")
    hot = hot_buckets([df], ["key"], 50)
    assert len(hot) == 1
    cold, warm = split(df, ["key"], hot)
    assert warm.where("key = 'hot'").count() == 300
    assert cold.count() + warm.count() == 900
    assert hot_buckets([df], ["key"], 10**6) == []


def test_further_keys_are_not_computed_where_the_first_is_cool(spark):
    df = _frame(spark, [(f"i{i}", "hot" if i < 90 else f"k{i}", i) for i in range(300)], "id")
    failing = df.withColumn("second", F.raise_error(F.lit("computed")))
    assert hot_buckets([failing], ["key", "second"], 100) == []
    # With a hot first key, the whole keys decide.
    assert hot_buckets([df], ["key", "id"], 50) == []
    pairs = df.withColumn("second", F.when(F.col("ts") < df.agg(F.max("ts")).first()[0], "x").otherwise("y"))
    cold, warm = split(pairs, ["key", "second"], hot_buckets([pairs], ["key", "second"], 50))
    assert (warm.where("key = 'hot'").count(), cold.where("key = 'hot'").count()) == (90, 0)


def test_hot_keys_stay_hot_where_every_bucket_is_large(spark, monkeypatch):
    import adlift.operators.skew as skew

    monkeypatch.setattr(skew, "BUCKETS", 8)
    rows = [(f"i{i}", "hot" if i < 600 else f"k{i}", i) for i in range(5_000)]
    hot = hot_buckets([_frame(spark, rows, "id")], ["key"], 200)
    assert len(hot) == 1
    assert hot_buckets([_frame(spark, rows[600:], "id")], ["key"], 200) == []


def test_partitioning_does_not_change_results(spark):
    clicks = [(f"c{i}", "i", at(i * 977 % 50_000), f"u{i % 3}", "m", "p") for i in range(200)]
    orders = [(f"o{i}", at(i * 613 % 60_000), f"u{i % 4}", "m", 1.0, 0, "Pizza") for i in range(200)]
    from conftest import CLICK, ORDER

    c, o = spark.createDataFrame(clicks, CLICK), spark.createDataFrame(orders, ORDER)
    expected = sorted(map(tuple, attribution_asof(o, c).collect()), key=str)
    for parts in (1, 7):
        got = attribution_asof(o.repartition(parts), c.repartition(parts + 2), hot_rows=parts * 20)
        assert sorted(map(tuple, got.collect()), key=str) == expected


def test_rank_of_a_key_at_a_single_instant(spark):
    rows = [(f"i{i:04d}", "hot", 5) for i in range(700)] + [(f"j{i}", f"k{i % 9}", i) for i in range(90)]
    got = rank_latest_first(_frame(spark, rows, "id").repartition(6), ["key"], "ts", "id", "n", hot_rows=50)
    ranks = {r["id"]: r["n"] for r in got.collect() if r["key"] == "hot"}
    assert ranks == {f"i{i:04d}": 700 - i for i in range(700)}


def test_rank_of_more_rows_than_the_ranges_are_sampled_from(spark, tmp_path):
    n = 60_000  # the bounds come from 100 rows per shuffle partition
    df = spark.range(0, n, 1, 6).selectExpr(
        "concat('i', lpad(id, 6, '0')) AS id",
        "CAST('hot' AS string) AS key",
        "timestamp_seconds(pmod(xxhash64(id), 5000)) AS ts",
        "sha2(CAST(id AS string), 256) AS other",
        "CAST(id AS int) AS number",
    )
    out = rank_latest_first(df, ["key"], "ts", "id", "rank", hot_rows=20_000)
    out.write.parquet(f"{tmp_path}/ranks")
    want = sorted(((r["ts"], r["id"]) for r in df.collect()), reverse=True)
    got = {r["id"]: r["rank"] for r in spark.read.parquet(f"{tmp_path}/ranks").collect()}
    assert got == {i: k for k, (_, i) in enumerate(want, 1)}


def test_summaries_written_along_rule_out_hot_keys_without_a_job(spark, monkeypatch):
    import adlift.operators.skew as skew
    from adlift.session import fresh_dir

    rows = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).cast("string").alias("k"))
    (found,) = skew.write_counted(rows, fresh_dir(spark, "counted"), ["k"])
    exact = {r.b: r.n for r in rows.groupBy(F.pmod(F.xxhash64("k"), F.lit(skew.BUCKETS)).cast("int").alias("b")).agg(F.count("*").alias("n")).collect()}
    assert all(exact[b] == n for b, n in found.top.items()) and max(exact.values()) == max(found.top.values())
    assert all(n <= found.bound(b) for b, n in exact.items())
    most = max(exact.values())
    hot = skew.hot_buckets([rows], ["k"], most - 50, [found])
    assert [exact[b] for b in hot] == [most]
    with monkeypatch.context() as m:
        m.setattr(skew, "reduce", lambda *a: 1 / 0)  # counting would start here
        assert skew.hot_buckets([rows], ["k"], most, [found]) == []
        assert skew.hot_buckets([rows, rows], ["k"], 2 * most, [found, found]) == []
    (none,) = skew.write_counted(rows.limit(0), fresh_dir(spark, "counted"), ["k"])
    assert none.bound(3) == 0 and skew.surely_cool([none], 0)
