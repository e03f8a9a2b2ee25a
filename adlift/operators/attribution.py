"""Closed-loop attribution: orders matched to the ad clicks and views before them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlift import schemas as S
from adlift.functions.scalars import DAY_US, HOUR_US, hours_between, micros, money, ratio, rounded
from adlift.operators.ordered import Lookup, asof_join, rank_latest_first
from adlift.operators.skew import HOT_ROWS

PAIR = ["customer_id", "merchant_id"]
_ORDER = ["order_id", "order_timestamp", *PAIR, "order_amount", "used_coupon", "cuisine"]


def _orders(orders: DataFrame) -> DataFrame:
    return orders.withColumnRenamed("timestamp", "order_timestamp").select(*_ORDER)


def _clicks(clicks: DataFrame, window_days: float) -> Lookup:
    return Lookup(
        "click",
        clicks,
        "timestamp",
        "click_id",
        ("impression_id", "ad_placement"),
        within_us=int(window_days * DAY_US),
    )


def _views(impressions: DataFrame, window_hours: float) -> Lookup:
    return Lookup(
        "view",
        impressions,
        "timestamp",
        "impression_id",
        ("ad_placement",),
        within_us=int(window_hours * HOUR_US),
    )


def _hours(at_us: Column) -> Column:
    return hours_between(F.col("order_timestamp"), F.timestamp_micros(at_us))


def _silver(matched: DataFrame) -> DataFrame:
    """The silver layout from orders with a nullable ``click`` struct."""
    clicked = F.col("click.click_id").isNotNull()
    return matched.select(
        *_ORDER,
        F.col("click.click_id").alias("attributed_click_id"),
        F.col("click.impression_id").alias("attributed_impression_id"),
        F.col("click.ad_placement").alias("ad_placement"),
        F.when(clicked, S.CLICK_STATUS).otherwise(S.ORGANIC_STATUS).alias("attribution_status"),
        F.when(clicked, _hours(F.col("click.at_us"))).alias("hours_from_click_to_order"),
    )


def ranked_clicks(clicks: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Clicks with their recency rank within the customer-merchant pair."""
    return rank_latest_first(clicks, PAIR, "timestamp", "click_id", "click_rank", hot_rows)


def latest_clicks(clicks: DataFrame) -> DataFrame:
    """The rank-1 click of every pair, as a maximum that combines before the shuffle."""
    row = F.struct(
        micros("timestamp").alias("at_us"), "click_id", "impression_id", "ad_placement"
    )
    return clicks.groupBy(*PAIR).agg(F.max(row).alias("click"))


def attribution_global_last(
    orders: DataFrame, clicks: DataFrame, window_days: float = S.CLICK_WINDOW_DAYS
) -> DataFrame:
    """Only the last click a pair ever made can be matched to its orders."""
    matched = _orders(orders).join(latest_clicks(clicks), PAIR, "left")
    age = micros("order_timestamp") - F.col("click.at_us")
    in_window = age.between(0, int(window_days * DAY_US))
    return _silver(matched.withColumn("click", F.when(in_window, F.col("click"))))


def attribution_asof(
    orders: DataFrame,
    clicks: DataFrame,
    window_days: float = S.CLICK_WINDOW_DAYS,
    hot_rows: int = HOT_ROWS,
    count_on: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Each order takes the pair's last click at or before it, within the window."""
    matched = asof_join(
        _orders(orders), [_clicks(clicks, window_days)], PAIR, "order_timestamp", hot_rows, count_on
    )
    return _silver(matched)


def attribution_view_through(
    orders: DataFrame,
    impressions: DataFrame,
    window_hours: float = S.VIEW_WINDOW_HOURS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each order takes the pair's last impression at or before it, within the window."""
    matched = asof_join(
        _orders(orders), [_views(impressions, window_hours)], PAIR, "order_timestamp", hot_rows
    )
    viewed = F.col("view.impression_id").isNotNull()
    return matched.select(
        *_ORDER,
        F.col("view.impression_id").alias("viewed_impression_id"),
        F.col("view.ad_placement").alias("ad_placement"),
        F.when(viewed, S.VIEW_STATUS).otherwise(S.ORGANIC_STATUS).alias("attribution_status"),
        F.when(viewed, _hours(F.col("view.at_us"))).alias("hours_from_view_to_order"),
    )


def attribution_full(
    orders: DataFrame,
    clicks: DataFrame,
    impressions: DataFrame,
    window_days: float = S.CLICK_WINDOW_DAYS,
    window_hours: float = S.VIEW_WINDOW_HOURS,
    view_weight: float = 1.0,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Click before view before organic, from one pass over all three logs."""
    matched = asof_join(
        _orders(orders),
        [_clicks(clicks, window_days), _views(impressions, window_hours)],
        PAIR,
        "order_timestamp",
        hot_rows,
    )
    clicked = F.col("click.click_id").isNotNull()
    viewed = F.col("view.impression_id").isNotNull()
    return matched.select(
        *_ORDER,
        F.col("click.click_id").alias("attributed_click_id"),
        F.when(clicked, F.col("click.impression_id"))
        .otherwise(F.col("view.impression_id"))
        .alias("attributed_impression_id"),
        F.when(clicked, F.col("click.ad_placement"))
        .otherwise(F.col("view.ad_placement"))
        .alias("ad_placement"),
        F.when(clicked, S.CLICK_STATUS)
        .when(viewed, S.VIEW_STATUS)
        .otherwise(S.ORGANIC_STATUS)
        .alias("attribution_status"),
        F.when(clicked, _hours(F.col("click.at_us"))).alias("hours_from_click_to_order"),
        F.when(~clicked & viewed, _hours(F.col("view.at_us"))).alias("hours_from_view_to_order"),
        F.when(clicked, F.lit(1.0))
        .when(viewed, F.lit(float(view_weight)))
        .otherwise(F.lit(0.0))
        .alias("attribution_weight"),
    )


def attribution_summary(silver: DataFrame) -> DataFrame:
    """Orders, revenue, ticket and hours to convert per attribution status."""
    revenue = F.sum(money("order_amount"))
    hours = F.col("hours_from_click_to_order").cast("decimal(18,1)")
    return silver.groupBy("attribution_status").agg(
        F.count(F.lit(1)).alias("total_orders"),
        rounded(revenue, 2).alias("total_revenue"),
        rounded(ratio(revenue, F.count("order_amount")), 2).alias("avg_ticket"),
        rounded(ratio(F.sum(hours), F.count("hours_from_click_to_order")), 1).alias("avg_hours_to_convert"),
    )


def dedup_latest(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """One row per business key: the one with the greatest ``newest`` columns.

    A struct maximum combines on the map side, so any number of copies of a
    key shrinks to one row per task before it is shuffled. Rows without a key
    cannot be copies of each other and stay as they are. Columns that have no
    order (maps) are compared by their JSON text.
    """
    lead = [c for c in newest if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    unordered = [c for c in rest if "map<" in dict(df.dtypes)[c]]
    if unordered:
        order = F.struct(*lead, *[F.to_json(F.struct(c)) if c in unordered else F.col(c) for c in rest])
        best = F.max_by(F.struct(*lead, *rest), order).alias("_row")
    else:
        best = F.max(F.struct(*lead, *rest)).alias("_row")
    once = df.where(known).groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)
    return once.unionByName(df.where(~known))
