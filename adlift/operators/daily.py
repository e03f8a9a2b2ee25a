"""Trailing windows from counts of whole days and the rows of the two days that the window cuts.

A fact is something that happened to a customer ``at`` a time and was known from
``known_at`` on: an order, an impression, or a click, which happens at its impression
and is known when it is clicked. Facts and their counts per day lie in one folder per
date of ``at``. A window reads the counts of its whole days, the facts of its first and
last day, and of the days between only facts known on the last day, which the time
of asking may cut. Dates are those of the session's time zone, which must be the writer's.

Rows without an id or a time are no facts; ids must not repeat (the clean logs). Rows
without a customer are counted together, under null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlift import schemas as S
from adlift.operators.gold import fatigue

_NOT_MEASURES = ("customer_id", "at", "known_at", "known_date", S.EVENT_DATE)


def _facts(rows: DataFrame, at: str, known_at: str, **counts: int) -> DataFrame:
    timed = rows.where(F.col(at).isNotNull() & F.col(known_at).isNotNull())
    return timed.select(
        "customer_id",
        F.col(at).alias("at"),
        F.col(known_at).alias("known_at"),
        F.to_date(known_at).alias("known_date"),
        *[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()],
        F.to_date(at).alias(S.EVENT_DATE),
    )


def order_facts(orders: DataFrame) -> DataFrame:
    return _facts(orders.where("order_id IS NOT NULL"), "timestamp", "timestamp", orders=1)


def ad_facts(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Impressions, and clicks at the time and for the customer of the impression they are on."""
    shown = impressions.where("impression_id IS NOT NULL")
    hit = clicks.where("click_id IS NOT NULL").select("impression_id", F.col("timestamp").alias("_clicked"))
    seen = shown.select("impression_id", "customer_id", "timestamp")
    views = _facts(shown, "timestamp", "timestamp", impressions=1, clicks=0)
    return views.unionByName(
        _facts(hit.join(seen, "impression_id"), "timestamp", "_clicked", impressions=0, clicks=1)
    )


def _measures(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in _NOT_MEASURES]


def per_day(facts: DataFrame) -> DataFrame:
    """Counts per customer, date of the fact and date it was known; such counts add up over batches."""
    return facts.groupBy("customer_id", "known_date", S.EVENT_DATE).agg(
        *[F.sum(m).alias(m) for m in _measures(facts)]
    )


def in_folders(df: DataFrame) -> DataFrame:
    """Rows of a date together, heavy dates in several tasks, for writing by date."""
    return df.hint("rebalance", S.EVENT_DATE)


def trailing(days_counted: DataFrame, facts: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Per customer, the counts of the facts in ``(as_of - days, as_of]`` known at ``as_of``."""
    start = as_of - F.expr(f"INTERVAL {days} DAYS")
    first, last = F.to_date(start), F.to_date(as_of)
    day, known = F.col(S.EVENT_DATE), F.col("known_date")
    between = (day > first) & (day < last)
    in_time = (F.col("at") > start) & (F.col("at") <= as_of) & (F.col("known_at") <= as_of)
    parts = [
        days_counted.where(between & (known < last)),
        facts.where(((day == first) | (day == last)) & in_time),
        facts.where(between & (known == last) & in_time),
    ]
    measures = _measures(facts)
    counted = parts[0].select("customer_id", *measures)
    for part in parts[1:]:
        counted = counted.unionByName(part.select("customer_id", *measures))
    return counted.groupBy("customer_id").agg(*[F.sum(m).alias(m) for m in measures])


def trailing_orders(days_counted: DataFrame, facts: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    found = trailing(days_counted, facts, as_of, days)
    return found.select("customer_id", F.col("orders").alias(f"user_orders_last_{days}d"))


def trailing_fatigue(days_counted: DataFrame, facts: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    found = trailing(days_counted, facts, as_of, days)
    return found.select(
        "customer_id",
        F.col("impressions").alias(f"impressions_last_{days}d"),
        F.col("clicks").alias(f"clicks_last_{days}d"),
        fatigue(F.col("impressions"), F.col("clicks")).alias(f"user_ad_fatigue_last_{days}d"),
    )
