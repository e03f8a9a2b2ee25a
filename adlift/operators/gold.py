"""Customer and merchant feature tables, and the aggregates next to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlift import schemas as S
from adlift.functions.scalars import DAY_US, money, or_default, ratio, rounded
from adlift.operators.ordered import trailing_sums
from adlift.operators.skew import HOT_ROWS


def order_profile(silver: DataFrame, key: str) -> DataFrame:
    """Per ``key``: distinct orders, attributed orders, mean amount and coupon use, mode cuisine.

    Distinct counts come from one row per (key, order), the mode from one row
    per (key, cuisine). Both shrink before the shuffle on ``key``, so neither
    copies of an order nor a busy key pile up in one task.
    """
    attributed = (F.col("attribution_status") == S.CLICK_STATUS).cast("int")
    per_order = (
        silver.groupBy(key, "order_id")
        .agg(
            F.sum(money("order_amount")).alias("amount"),
            F.count("order_amount").alias("amounts"),
            F.sum("used_coupon").alias("coupons"),
            F.count("used_coupon").alias("coupon_rows"),
            F.max(attributed).alias("attributed"),
        )
        .withColumn("orders", F.col("order_id").isNotNull().cast("int"))
        .withColumn("attributed", F.col("attributed") * F.col("orders"))
        .drop("order_id")
    )
    totals = per_order.groupBy(key).agg(
        F.sum("orders").alias("total_orders"),
        F.sum("attributed").alias("attributed_orders"),
        ratio(F.sum("amount"), F.sum("amounts")).alias("avg_amount"),
        ratio(F.sum("coupons"), F.sum("coupon_rows")).alias("avg_coupon"),
    )
    # Apart from the sums: a struct in the buffer would turn their hash aggregate into a sorted one.
    favourites = (
        silver.where(F.col("cuisine").isNotNull())
        .groupBy(key, "cuisine")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(F.struct((-F.col("n")).alias("n"), "cuisine")).alias("best"))
        .select("_key", "best.cuisine")
    )
    # A row per key on either side: neither is collected for a broadcast.
    return totals.join(favourites.hint("merge"), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def customer_order_agg(silver: DataFrame) -> DataFrame:
    return order_profile(silver, "customer_id").select(
        "customer_id",
        F.col("total_orders").alias("user_total_orders"),
        F.col("attributed_orders").alias("user_attributed_orders"),
        rounded(F.col("avg_amount"), 2).alias("user_avg_basket_value"),
        rounded(F.col("avg_coupon"), 3).alias("user_discount_affinity"),
        F.col("cuisine").alias("user_preferred_cuisine"),
    )


def fatigue(impressions: Column, clicks: Column) -> Column:
    return rounded(impressions / (clicks + F.lit(1.0)), 2)


def customer_ad_behavior(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Per customer: distinct impressions, distinct clicks on them, CTR and fatigue.

    The two distinct counts stay apart, since one ``count distinct`` pair over
    the joined rows would double them with an Expand first.
    """
    seen = impressions.select("customer_id", "impression_id").distinct()
    clicked = (
        seen.join(clicks.select("impression_id", "click_id").distinct().hint("merge"), "impression_id")
        .select("customer_id", "click_id")
        .distinct()
    )
    events = seen.select("customer_id", F.col("impression_id"), F.lit(None).cast("string").alias("click_id"))
    events = events.unionByName(
        clicked.select("customer_id", F.lit(None).cast("string").alias("impression_id"), "click_id")
    )
    shown, hit = F.col("total_impressions"), F.col("total_clicks")
    return (
        events.groupBy("customer_id")
        .agg(F.count("impression_id").alias("total_impressions"), F.count("click_id").alias("total_clicks"))
        .withColumn("user_historical_ctr", rounded(ratio(hit, shown), 4))
        .withColumn("user_ad_fatigue_score", fatigue(shown, hit))
    )


def gold_customer_features(
    silver: DataFrame, impressions: DataFrame, clicks: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """One row per customer who saw an ad; order features default where there are no orders."""
    joined = customer_ad_behavior(impressions, clicks).join(
        customer_order_agg(silver).hint("merge"), "customer_id", "left"
    )
    joined = joined.withColumnsRenamed(
        {"total_impressions": "user_ad_impressions", "total_clicks": "user_ad_clicks"}
    )
    filled = or_default(S.GOLD_DEFAULTS)
    return joined.select(
        "customer_id",
        *[column.alias(name) for name, column in filled.items()],
        (as_of if as_of is not None else F.current_timestamp()).alias("last_feature_update"),
    )


def gold_merchant_features(silver: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per merchant with orders."""
    share = ratio(F.col("attributed_orders"), F.col("total_orders"))
    return order_profile(silver, "merchant_id").select(
        "merchant_id",
        F.col("total_orders").alias("merchant_total_orders"),
        rounded(F.col("avg_amount"), 2).alias("merchant_avg_ticket"),
        rounded(F.col("avg_coupon"), 3).alias("merchant_coupon_dependency"),
        F.col("cuisine").alias("merchant_cuisine"),
        rounded(share, 4).alias("merchant_retail_media_dependency_rate"),
        (as_of if as_of is not None else F.current_timestamp()).alias("last_feature_update"),
    )


def _within(df: DataFrame, ts: str, as_of: Column, days: int) -> DataFrame:
    """The rows in ``(as_of - days, as_of]``; of a log in date folders, only the folders that can hold them are read."""
    start = as_of - F.expr(f"INTERVAL {days} DAYS")
    # On the columns themselves, so that the bounds reach the folders and the Parquet reader.
    if S.EVENT_DATE in df.columns:
        # A day wider on both sides: the writer's time zone may have been another one.
        first, last = F.date_sub(F.to_date(start), 1), F.date_add(F.to_date(as_of), 1)
        df = df.where(F.col(S.EVENT_DATE).between(first, last))
    return df.where((F.col(ts) > start) & (F.col(ts) <= as_of))


def orders_last_days(orders: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    return _within(orders, "timestamp", as_of, days).groupBy("customer_id").agg(
        F.countDistinct("order_id").alias(f"user_orders_last_{days}d")
    )


def fatigue_last_days(
    impressions: DataFrame, clicks: DataFrame, as_of: Column, days: int = 7
) -> DataFrame:
    """The fatigue ratio over the impressions of the last days and the clicks on them."""
    shown = _within(impressions, "timestamp", as_of, days)
    # A click follows its impression, so the window bounds the clicks as well.
    hit = _within(clicks, "timestamp", as_of, days)
    return customer_ad_behavior(shown, hit).select(
        "customer_id",
        F.col("total_impressions").alias(f"impressions_last_{days}d"),
        F.col("total_clicks").alias(f"clicks_last_{days}d"),
        F.col("user_ad_fatigue_score").alias(f"user_ad_fatigue_last_{days}d"),
    )


def fatigue_from_daily(daily: DataFrame) -> DataFrame:
    """The summed form: per-day impression and click counts added up per customer."""
    sums = daily.groupBy("customer_id").agg(
        F.sum("ad_impressions").alias("ad_impressions"), F.sum("ad_clicks").alias("ad_clicks")
    )
    return sums.withColumn(
        "user_ad_fatigue_score", fatigue(F.col("ad_impressions"), F.col("ad_clicks"))
    )


def daily_ad_counts(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Per customer and day of impression: impressions shown, clicks on them."""
    shown = impressions.select(
        "customer_id", "impression_id", F.to_date("timestamp").alias("day")
    ).dropDuplicates(["customer_id", "impression_id"])
    hit = clicks.select("impression_id", "click_id").distinct()
    hits = shown.join(hit, "impression_id").groupBy("customer_id", "day")
    return (
        shown.groupBy("customer_id", "day")
        .agg(F.count(F.lit(1)).alias("ad_impressions"))
        .join(hits.agg(F.count(F.lit(1)).alias("ad_clicks")), ["customer_id", "day"], "left")
        .fillna(0, ["ad_clicks"])
    )


def rolling_customer_features(
    at: DataFrame,
    impressions: DataFrame,
    clicks: DataFrame,
    orders: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """For every row of ``at``, the customer's orders of 30 days and ads of 7 days before it.

    Clicks count for the customer of the impression they are on, as in the
    gold table; a click without a known impression does not count. Replays of
    an id count once, at their first time.
    """
    orders, impressions = _first_of(orders, "order_id"), _first_of(impressions, "impression_id")
    clicks = _on_impressions(clicks, impressions)

    def events(df: DataFrame, kind: str) -> DataFrame:
        flags = [F.lit(int(kind == k)).alias(f"n_{k}") for k in ("order", "view", "click")]
        return df.select("customer_id", F.col("timestamp").alias("event_time"), *flags)

    log = (
        events(orders, "order").unionByName(events(impressions, "view")).unionByName(events(clicks, "click"))
    )
    out = trailing_sums(
        at,
        log,
        ["customer_id"],
        "timestamp",
        "event_time",
        {
            "user_orders_last_30d": ("n_order", 30 * DAY_US),
            "user_impressions_last_7d": ("n_view", 7 * DAY_US),
            "user_clicks_last_7d": ("n_click", 7 * DAY_US),
        },
        hot_rows,
    )
    return out.withColumn(
        "user_ad_fatigue_7d",
        fatigue(F.col("user_impressions_last_7d"), F.col("user_clicks_last_7d")),
    )


def _first_of(df: DataFrame, key: str) -> DataFrame:
    """(customer_id, ``key``, timestamp): the first time of each id."""
    return df.groupBy("customer_id", key).agg(F.min("timestamp").alias("timestamp"))


def _on_impressions(clicks: DataFrame, impressions: DataFrame) -> DataFrame:
    """Clicks under the customer of their impression, each at its own first time."""
    seen = impressions.select("impression_id", F.col("customer_id").alias("_seen_by")).distinct()
    hit = clicks.select("impression_id", "click_id", "timestamp").join(seen, "impression_id")
    return _first_of(hit.withColumnRenamed("_seen_by", "customer_id"), "click_id")


def merchant_conversion_rate(silver: DataFrame, clicks: DataFrame) -> DataFrame:
    """Attributed orders per ad click of the merchant."""
    sold = (
        silver.where(F.col("attribution_status") == S.CLICK_STATUS)
        .groupBy("merchant_id")
        .agg(F.countDistinct("order_id").alias("attributed_orders"))
    )
    hits = clicks.groupBy("merchant_id").agg(F.countDistinct("click_id").alias("clicks"))
    orders = F.coalesce(F.col("attributed_orders"), F.lit(0))
    return hits.join(sold, "merchant_id", "left").select(
        "merchant_id",
        "clicks",
        orders.alias("attributed_orders"),
        rounded(ratio(orders, F.col("clicks")), 4).alias("merchant_conversion_rate"),
    )


def merchant_quality(merchants: DataFrame, ratings: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Merchants with ``merchant_score_quality``: the weighted mean of the known rating columns."""
    top = sum((F.coalesce(F.col(c) * F.lit(float(w)), F.lit(0.0)) for c, w in weights.items()), F.lit(0.0))
    bottom = sum(
        (F.when(F.col(c).isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0)) for c, w in weights.items()),
        F.lit(0.0),
    )
    score = F.when(bottom > 0, rounded(top / bottom, 4)).alias("merchant_score_quality")
    rated = ratings.select("merchant_id", *weights)
    return merchants.join(rated, "merchant_id", "left").select(*merchants.columns, score)


def advertiser_rollup(impressions: DataFrame, clicks: DataFrame, silver: DataFrame) -> DataFrame:
    """Impressions, clicks, attributed orders and revenue by merchant, placement, day, with subtotals.

    Counts are brought to (merchant, placement, day) first, so that the
    roll-up expands the small table and not the logs.
    """
    by = ["merchant_id", "ad_placement", "day"]

    def part(df: DataFrame, ts: str, **measures: Column) -> DataFrame:
        names = {"impressions": "bigint", "clicks": "bigint", "orders": "bigint", "revenue": "decimal(18,2)"}
        return df.select(
            "merchant_id",
            "ad_placement",
            F.date_format(ts, "yyyy-MM-dd").alias("day"),
            *[measures.get(n, F.lit(0)).cast(t).alias(n) for n, t in names.items()],
        )

    one = F.lit(1)
    sold = silver.where(F.col("attribution_status") == S.CLICK_STATUS)
    rows = (
        part(impressions, "timestamp", impressions=one)
        .unionByName(part(clicks, "timestamp", clicks=one))
        .unionByName(part(sold, "order_timestamp", orders=one, revenue=money("order_amount")))
    )
    sums = [F.sum(n).alias(n) for n in ("impressions", "clicks", "orders", "revenue")]
    return (
        rows.groupBy(*by)
        .agg(*sums)
        .rollup(*by)
        .agg(F.grouping_id().alias("level"), *sums)
        .select(
            *by,
            F.col("level").cast("int").alias("level"),
            "impressions",
            "clicks",
            F.col("orders").alias("attributed_orders"),
            F.col("revenue").cast("double").alias("attributed_revenue"),
        )
    )


def traffic_totals(impressions: DataFrame, clicks: DataFrame, orders: DataFrame) -> DataFrame:
    """Log sizes, global click-through rate and order value, in one row."""

    def part(df: DataFrame, kind: str) -> DataFrame:
        amount = money("order_amount") if kind == "orders" else F.lit(None).cast("decimal(18,2)")
        return df.select(F.lit(kind).alias("kind"), amount.alias("amount"))

    rows = (
        part(impressions, "impressions").unionByName(part(clicks, "clicks")).unionByName(part(orders, "orders"))
    )

    def n(kind: str) -> Column:
        return F.count(F.when(F.col("kind") == kind, 1))

    return rows.agg(
        n("impressions").alias("impressions"),
        n("clicks").alias("clicks"),
        n("orders").alias("orders"),
        rounded(ratio(n("clicks"), n("impressions")), 6).alias("global_ctr"),
        rounded(F.sum("amount"), 2).alias("order_value"),
    )


def layer_counts(**tables: DataFrame) -> DataFrame:
    """One row per table with its number of rows."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        out = row if out is None else out.unionByName(row)
    return out


def customer_snapshots(silver: DataFrame, impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """The customer's features as they stood at the end of each day with activity.

    Counted as the gold table counts: clicks through their impressions, but on
    the day of the click, so that no later click leaks into an earlier
    snapshot; the last snapshot of a customer equals the gold row. Days are
    summed first, so the running sums see at most one row per customer and day.
    """
    day = F.to_date
    impressions = _first_of(impressions, "impression_id")
    clicks = _on_impressions(clicks, impressions)
    # One row per id here, so that ids are counted as rows and one sum per customer and day is left.
    bought = (
        silver.groupBy("customer_id", day("order_timestamp").alias("day"), "order_id")
        .agg(
            F.sum(money("order_amount")).alias("amount"),
            F.count("order_amount").alias("amounts"),
            F.sum("used_coupon").alias("coupons"),
            F.count("used_coupon").alias("coupon_rows"),
        )
        .withColumn("orders", F.col("order_id").isNotNull().cast("bigint"))
        .drop("order_id")
    )

    def counted(ids: DataFrame, key: str, name: str) -> DataFrame:
        return ids.select(
            "customer_id", day("timestamp").alias("day"), F.col(key).isNotNull().cast("bigint").alias(name)
        )

    shown, hit = counted(impressions, "impression_id", "shown"), counted(clicks, "click_id", "hit")
    measures = ["orders", "amount", "amounts", "coupons", "coupon_rows", "shown", "hit"]
    daily = bought.unionByName(shown, allowMissingColumns=True).unionByName(hit, allowMissingColumns=True)
    daily = daily.where(F.col("day").isNotNull()).groupBy("customer_id", "day")
    daily = daily.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    daily = _with_favourite(daily, silver, "customer_id")
    w = Window.partitionBy("customer_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    run = daily.select(
        "customer_id",
        "day",
        *[F.sum(m).over(w).alias(m) for m in measures],
        F.min("best").over(w)["cuisine"].alias("cuisine"),
    )
    return run.select(
        "customer_id",
        (F.col("day") + F.expr("INTERVAL 1 DAY")).cast("timestamp").alias("feature_ts"),
        F.col("orders").alias("user_total_orders"),
        F.coalesce(rounded(ratio(F.col("amount"), F.col("amounts")), 2), F.lit(45.0)).alias(
            "user_avg_basket_value"
        ),
        F.coalesce(rounded(ratio(F.col("coupons"), F.col("coupon_rows")), 3), F.lit(0.20)).alias(
            "user_discount_affinity"
        ),
        fatigue(F.col("shown"), F.col("hit")).alias("user_ad_fatigue_score"),
        F.coalesce(rounded(ratio(F.col("hit"), F.col("shown")), 4), F.lit(0.0)).alias("user_historical_ctr"),
        F.coalesce("cuisine", F.lit(S.GOLD_DEFAULTS["user_preferred_cuisine"])).alias("user_preferred_cuisine"),
    )


def _with_favourite(daily: DataFrame, silver: DataFrame, key: str) -> DataFrame:
    """``daily`` with ``best``: of the cuisines ordered that day the one with most orders until then.

    A cuisine's running count never falls, so the running minimum of
    (-count, cuisine) over the days is the favourite as of each day.
    """
    counts = (
        silver.where(F.col("cuisine").isNotNull())
        .groupBy(key, "cuisine", F.to_date("order_timestamp").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    w = Window.partitionBy(key, "cuisine").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("n", F.sum("n").over(w))
    best = running.groupBy(F.col(key).alias("_key"), F.col("day").alias("_day")).agg(
        F.min(F.struct((-F.col("n")).alias("n"), "cuisine")).alias("best")
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("day") == F.col("_day"))
    return daily.join(best, same, "left").drop("_key", "_day")


def merchant_snapshots(silver: DataFrame) -> DataFrame:
    """The merchant's features as they stood at the end of each day with orders."""
    sold = F.when(F.col("attribution_status") == S.CLICK_STATUS, F.col("order_id"))
    per_order = silver.groupBy("merchant_id", F.to_date("order_timestamp").alias("day"), "order_id").agg(
        F.sum(money("order_amount")).alias("amount"),
        F.count("order_amount").alias("amounts"),
        F.max(sold.isNotNull().cast("int")).alias("attributed"),
    )
    daily = per_order.where(F.col("day").isNotNull()).groupBy("merchant_id", "day").agg(
        F.count("order_id").alias("orders"),
        F.sum("amount").alias("amount"),
        F.sum("amounts").alias("amounts"),
        F.sum("attributed").alias("attributed"),
    )
    daily = _with_favourite(daily, silver, "merchant_id")
    w = Window.partitionBy("merchant_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    measures = ["orders", "amount", "amounts", "attributed"]
    run = daily.select(
        "merchant_id",
        "day",
        *[F.sum(m).over(w).alias(m) for m in measures],
        F.min("best").over(w)["cuisine"].alias("cuisine"),
    )
    return run.select(
        "merchant_id",
        (F.col("day") + F.expr("INTERVAL 1 DAY")).cast("timestamp").alias("feature_ts"),
        F.col("orders").alias("merchant_total_orders"),
        rounded(ratio(F.col("amount"), F.col("amounts")), 2).alias("merchant_avg_ticket"),
        rounded(ratio(F.col("attributed"), F.col("orders")), 4).alias(
            "merchant_retail_media_dependency_rate"
        ),
        F.col("cuisine").alias("merchant_cuisine"),
    )
