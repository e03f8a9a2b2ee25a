"""Order-dependent operators that stay exact when one key holds most rows.

Each operator has two plans. Keys of ordinary size use one window per key.
Hot keys are cut along time into chunks of ``CHUNK_US``: a window runs inside
each chunk, the chunk results are combined per key (one row per chunk, so the
second step is bounded by the time span and not by the number of rows), and
the carried value is joined back. No task ever sorts a whole hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlift.functions.scalars import micros
from adlift.operators.skew import HOT_ROWS, KeySummary, hot_buckets, split
from adlift.session import fresh_dir

CHUNK_US = 60 * 1_000_000

_T, _SIDE, _ROW, _CHUNK = "_t", "_side", "_row", "_chunk"


@dataclass(frozen=True)
class Lookup:
    """One right side of an as-of join.

    ``name`` is the struct column that will hold the matched row: its time in
    microseconds (``at_us``), then ``tie`` (the greatest wins on equal times),
    then ``payload``. ``strict`` asks for a time before, not at, the left time.
    """

    name: str
    df: DataFrame
    time: str
    tie: str
    payload: tuple[str, ...] = ()
    within_us: int | None = None
    strict: bool = False

    def points(self, keys: Sequence[str]) -> DataFrame:
        known = reduce(Column.__and__, [F.col(k).isNotNull() for k in [*keys, self.time]])
        at = micros(self.time)
        row = F.struct(
            at.alias("at_us"),
            F.col(self.tie).alias(self.tie),
            *[F.col(c) for c in self.payload if c != self.tie],
        )
        return self.df.where(known).select(*keys, at.alias(_T), row.alias(self.name))


def asof_join(
    left: DataFrame,
    lookups: Sequence[Lookup],
    keys: Sequence[str],
    left_time: str,
    hot_rows: int = HOT_ROWS,
    count_on: Sequence[DataFrame] | None = None,
    summaries: Sequence[KeySummary] | None = None,
) -> DataFrame:
    """``left`` plus, per lookup, the latest right row of the same key not after it.

    One shuffle of the union of both sides; no pairs are built. Left rows
    without a match keep a null struct. ``count_on`` names cheaper frames to
    find hot keys in (say, the raw tables behind a deduplicated input),
    ``summaries`` of the tables behind both sides rule them out without a job.
    """
    keys = list(keys)
    names = [look.name for look in lookups]
    rights = [look.points(keys) for look in lookups]
    hot = hot_buckets(count_on or [left, *rights], keys, hot_rows, summaries)
    if not hot:
        out = _asof_by_key(left, list(zip(lookups, rights)), keys, left_time)
    else:
        cold_left, hot_left = split(left, keys, hot)
        parts = [split(r, keys, hot) for r in rights]
        cold = [(look, p[0]) for look, p in zip(lookups, parts)]
        warm = [(look, p[1]) for look, p in zip(lookups, parts)]
        out = _asof_by_key(cold_left, cold, keys, left_time).unionByName(
            _asof_by_chunk(hot_left, warm, keys, left_time)
        )
    for look in lookups:
        if look.within_us is not None:
            age = micros(left_time) - F.col(f"{look.name}.at_us")
            out = out.withColumn(look.name, F.when(age <= F.lit(look.within_us), F.col(look.name)))
    return out


def _timeline(left: DataFrame, rights: Sequence[tuple[Lookup, DataFrame]]) -> DataFrame:
    """Left and right points in one frame; at equal times a strict right sorts last."""
    parts = [left.withColumn(_SIDE, F.lit(1))]
    parts += [df.withColumn(_SIDE, F.lit(2 if look.strict else 0)) for look, df in rights]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _asof_by_key(
    left: DataFrame, rights: Sequence[tuple[Lookup, DataFrame]], keys: list[str], left_time: str
) -> DataFrame:
    names = [look.name for look, _ in rights]
    rows = left.select(*keys, micros(left_time).alias(_T), F.struct(*left.columns).alias(_ROW))
    w = Window.partitionBy(*keys).orderBy(_T, _SIDE, *names)
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    matched = _timeline(rows, rights).select(
        _ROW, *[F.last(n, ignorenulls=True).over(w).alias(n) for n in names]
    )
    return matched.where(F.col(_ROW).isNotNull()).select(f"{_ROW}.*", *names)


def _asof_by_chunk(
    left: DataFrame, rights: Sequence[tuple[Lookup, DataFrame]], keys: list[str], left_time: str
) -> DataFrame:
    # Copies at one instant share their answer, so a hot key is first reduced to its instants.
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in [*keys, left_time]])
    probes = left.where(known).select(*keys, micros(left_time).alias(_T)).distinct()
    instants = [
        (look, df.groupBy(*keys, _T).agg(F.max(look.name).alias(look.name))) for look, df in rights
    ]
    answers = _latest_in_chunks(probes.withColumn(_ROW, F.lit(True)), instants, keys)
    joined = left.withColumn(_T, micros(left_time)).join(answers, [*keys, _T], "left")
    return joined.select(*left.columns, *[look.name for look, _ in rights])


def _latest_in_chunks(
    left: DataFrame, rights: Sequence[tuple[Lookup, DataFrame]], keys: list[str]
) -> DataFrame:
    names = [look.name for look, _ in rights]
    points = _timeline(left, rights).withColumn(_CHUNK, F.floor(F.col(_T) / CHUNK_US))
    inside = (
        Window.partitionBy(*keys, _CHUNK)
        .orderBy(_T, _SIDE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        points.groupBy(*keys, _CHUNK)
        .agg(*[F.max(n).alias(n) for n in names])
        .select(
            *keys,
            _CHUNK,
            *[F.last(n, ignorenulls=True).over(before).alias(f"_before_{n}") for n in names],
        )
    )
    own = points.select(
        *keys, _T, _CHUNK, _ROW, *[F.last(n, ignorenulls=True).over(inside).alias(n) for n in names]
    ).where(F.col(_ROW).isNotNull())
    return own.join(carried, [*keys, _CHUNK]).select(
        *keys, _T, *[F.coalesce(F.col(n), F.col(f"_before_{n}")).alias(n) for n in names]
    )


def rank_latest_first(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: str,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Row number per key by ``time`` descending, then ``tie`` descending."""
    keys = list(keys)
    order = [F.desc(time), F.desc(tie)]
    by_key = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    hot_keys = hot_buckets([df], keys, hot_rows)
    if not hot_keys:
        return df.withColumn(name, by_key)
    cold, hot = split(df, keys, hot_keys)
    cold = cold.withColumn(name, by_key)

    # Hot keys are cut by ranges of (key, time, tie), so that not even one instant is one task's work.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, -(-hot.count() // hot_rows) if hot_rows > 0 else parts)
    # The bounds come from a sample that another shuffle of the same rows would draw anew, so chunks are
    # numbered once, in files that ranks and counts both read.
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, "ranked")
    numbered = hot.repartitionByRange(parts, *keys, *order).withColumn(_CHUNK, F.spark_partition_id())
    numbered.write.parquet(path)
    ranged = spark.read.schema(numbered.schema).parquet(path)
    earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        ranged.groupBy(*keys, _CHUNK)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            F.col(_CHUNK).alias("_k_chunk"),
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_ahead"),
        )
    )
    inside = F.row_number().over(Window.partitionBy(*keys, _CHUNK).orderBy(*order))
    same = reduce(
        Column.__and__,
        [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col(_CHUNK) == F.col("_k_chunk")],
    )
    hot = (
        ranged.withColumn(name, inside)
        .join(ahead, same)
        .withColumn(name, (F.col(name) + F.col("_ahead")).cast("int"))
        .select(*cold.columns)
    )
    return cold.unionByName(hot)


def trailing_sums(
    at: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    at_time: str,
    event_time: str,
    sums: dict[str, tuple[str, int]],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``at`` plus sums over the events of its key in ``[t - width, t)``.

    ``sums`` maps an output name to (event column, width in microseconds). A
    trailing sum is the difference of two running sums, so the cost is linear
    in the events however long the window is; a sliding frame would add up the
    frame again for every row.
    """
    keys = list(keys)
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    widths = sorted({0, *[width for _, width in sums.values()]})
    measures = sorted({column for column, _ in sums.values()})
    counted = events.where(known & F.col(event_time).isNotNull()).select(
        *keys, micros(event_time).alias(_T), *[F.col(m).cast("bigint").alias(m) for m in measures]
    )
    probes = (
        at.where(known & F.col(at_time).isNotNull())
        .select(*keys, micros(at_time).alias("_at"))
        .distinct()
        .withColumn("_width", F.explode(F.array(*[F.lit(w) for w in widths])))
        .withColumn(_T, F.col("_at") - F.col("_width"))
    )
    hot_keys = hot_buckets([at, events], keys, hot_rows)
    if not hot_keys:
        totals = _running_by_key(probes, counted, keys, measures)
    else:
        cold_events, hot_events = split(counted, keys, hot_keys)
        cold_probes, hot_probes = split(probes, keys, hot_keys)
        totals = _running_by_key(cold_probes, cold_events, keys, measures).unionByName(
            _running_by_chunk(hot_probes, hot_events, keys, measures)
        )

    def run_at(measure: str, width: int) -> Column:
        return F.max(F.when(F.col("_width") == width, F.col(measure)))

    answers = totals.groupBy(*keys, "_at").agg(
        *[(run_at(m, 0) - run_at(m, w)).alias(out) for out, (m, w) in sums.items()]
    )
    joined = at.withColumn("_at", micros(at_time)).join(answers, [*keys, "_at"], "left")
    return joined.select(
        *at.columns, *[F.coalesce(F.col(out), F.lit(0)).alias(out) for out in sums]
    )


def _probes_first(probes: DataFrame, events: DataFrame) -> DataFrame:
    """One frame in which an event at the instant of a probe sorts after it."""
    return probes.withColumn(_SIDE, F.lit(0)).unionByName(
        events.withColumn(_SIDE, F.lit(1)), allowMissingColumns=True
    )


def _running(measures: list[str], w) -> list[Column]:
    w = w.orderBy(_T, _SIDE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return [F.coalesce(F.sum(m).over(w), F.lit(0)).alias(m) for m in measures]


def _running_by_key(
    probes: DataFrame, events: DataFrame, keys: list[str], measures: list[str]
) -> DataFrame:
    sums = _running(measures, Window.partitionBy(*keys))
    points = _probes_first(probes, events).select(*keys, "_at", "_width", *sums)
    return points.where(F.col("_at").isNotNull())


def _running_by_chunk(
    probes: DataFrame, events: DataFrame, keys: list[str], measures: list[str]
) -> DataFrame:
    # Copies of one instant add up before they are shuffled to their chunk.
    instants = events.groupBy(*keys, _T).agg(*[F.sum(m).alias(m) for m in measures])
    points = _probes_first(probes, instants).withColumn(_CHUNK, F.floor(F.col(_T) / CHUNK_US))
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        points.groupBy(*keys, _CHUNK)
        .agg(*[F.sum(m).alias(m) for m in measures])
        .select(
            *keys,
            _CHUNK,
            *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_before_{m}") for m in measures],
        )
    )
    inside = _running(measures, Window.partitionBy(*keys, _CHUNK))
    return (
        points.select(*keys, "_at", "_width", _CHUNK, *inside)
        .where(F.col("_at").isNotNull())
        .join(carried, [*keys, _CHUNK])
        .select(
            *keys,
            "_at",
            "_width",
            *[(F.col(m) + F.col(f"_before_{m}")).alias(m) for m in measures],
        )
    )
