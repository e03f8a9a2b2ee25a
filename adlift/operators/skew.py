"""Telling hot keys from the rest, so that only they pay for being split.

Keys are hashed into a fixed number of buckets and rows are counted per
bucket, in one pass over the key columns. The count combines on the map side
to at most ``BUCKETS`` rows per task, and the list of hot buckets that reaches
the driver can never exceed ``BUCKETS`` integers, whatever the data. Where
ordinary buckets are large as well, the keys inside the large ones are counted
too, so the limit is one of rows per key at any size of the logs. A key that
shares a hot bucket by chance is only processed by the split plan too; results
do not depend on the choice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

BUCKETS = 65_536
# Rows of one key a single task sorts without trouble.
HOT_ROWS = 2_000_000
_BUCKET = "_key_bucket"


def _bucket(keys: Sequence[str]):
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias(_BUCKET)


# Largest buckets that a summary names, and buckets it tracks while it counts: more than there are, so counts are exact.
_NAMED = 1_000
_TRACKED = 100_000


@dataclass(frozen=True)
class KeySummary:
    """Rows per hash bucket of a table's keys: the largest buckets by name, a bound for each of the rest."""

    keys: tuple[str, ...]
    top: dict[int, int]
    rest: int

    def bound(self, bucket: int | None) -> int:
        return self.top.get(bucket, self.rest)


def key_counts(*keys: Sequence[str]) -> list[Column]:
    """Aggregates that count keys, one for each list of them; ``summaries`` reads their values."""
    return [
        F.expr(f"approx_top_k(CAST(pmod(xxhash64({', '.join(k)}), {BUCKETS}) AS INT), {_NAMED}, {_TRACKED})").alias(f"k{i}")
        for i, k in enumerate(keys)
    ]


def summaries_of(found: Mapping[str, Any], *keys: Sequence[str]) -> list[KeySummary]:
    return [_summary(tuple(k), found[f"k{i}"] or []) for i, k in enumerate(keys)]


def write_counted(df: DataFrame, path: str, *keys: Sequence[str]) -> list[KeySummary]:
    """Write a table and count its keys on the way, in the same job; one summary per list of keys."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *key_counts(*keys))
    counted.write.mode("overwrite").parquet(path)
    return summaries_of(seen.get, *keys)


def _summary(keys: tuple[str, ...], found: Sequence[Row]) -> KeySummary:
    top = {r["item"]: r["count"] for r in found}
    return KeySummary(keys, top, min(top.values()) if len(top) >= _NAMED else 0)


def surely_cool(summaries: Sequence[KeySummary], hot_rows: int) -> bool:
    """Whether no bucket can hold too many rows of the tables summarised, taken together."""
    named = {b for s in summaries for b in s.top} | {None}
    return max(sum(s.bound(b) for s in summaries) for b in named) <= hot_rows


def hot_buckets(
    frames: Sequence[DataFrame],
    keys: Sequence[str],
    hot_rows: int = HOT_ROWS,
    summaries: Sequence[KeySummary] | None = None,
) -> list[int]:
    """Hash buckets of ``keys`` that hold too many rows of ``frames`` together.

    The answer decides the plan, as a table size decides a join: with no hot
    key, which is the usual case, nothing is split. ``summaries`` of the tables
    behind the frames, one for each time that a table's rows enter, rule hot
    keys out without a job; only where they cannot, the rows are counted. Of
    several key columns the first is counted alone before: its values have at
    least the rows of the whole keys, and the other columns are not computed.
    """
    if summaries and surely_cool(summaries, hot_rows):
        return []
    if len(keys) > 1 and not hot_buckets(frames, keys[:1], hot_rows):
        return []
    rows = reduce(DataFrame.unionAll, [f.select(_bucket(keys), *keys) for f in frames])
    counts = rows.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    large = [r[_BUCKET] for r in counts.collect()]
    if not large:
        return []
    listed = F.broadcast(frames[0].sparkSession.createDataFrame([(b,) for b in large], f"{_BUCKET} int"))
    inside = rows.join(listed, _BUCKET, "left_semi")
    hot = inside.groupBy(_BUCKET, *keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    return sorted(r[_BUCKET] for r in hot.select(_BUCKET).distinct().collect())


def split(df: DataFrame, keys: Sequence[str], hot: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` with ordinary keys, and those in a hot bucket."""
    spark = df.sparkSession
    listed = F.broadcast(spark.createDataFrame([(b,) for b in hot], f"{_BUCKET} int"))
    marked = df.select("*", _bucket(keys))
    cold_rows = marked.join(listed, _BUCKET, "left_anti").drop(_BUCKET)
    hot_rows = marked.join(listed, _BUCKET, "left_semi").drop(_BUCKET)
    return cold_rows, hot_rows
