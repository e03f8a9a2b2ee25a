"""The ad logs as views of the star-schema tables (events, orders, lineitem, part)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlift.operators.ordered import Lookup, asof_join

_CUISINES = ("Pizza", "Burger", "Japonesa", "Brasileira", "Saudavel", "Mercado", "Doces")
_PLACEMENTS = ("feed_banner_top", "search_sponsored_item", "post_order_carousel", "category_highlight")


@dataclass(frozen=True)
class AdLogs:
    impressions: DataFrame
    clicks: DataFrame
    orders: DataFrame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; zone-less timestamps become instants (the session runs in UTC)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(
        *[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes]
    )


def numbered(prefix: str, number, width: int):
    """``prefix`` and the number with leading zeros, wider numbers in full."""
    digits = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def _pick(index, names):
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


def base_events(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return events.withColumn("k", k).select(
        "event_id",
        F.col("ts").alias("timestamp"),
        "event_type",
        "value",
        "k",
        numbered("usr_", "user_id", 6).alias("customer_id"),
        numbered("merch_", F.col("k") % 10, 4).alias("merchant_id"),
        _pick((F.col("k") % 10) % 7, _CUISINES).alias("cuisine"),
        _pick(F.floor(F.col("k") / 10) % 4, _PLACEMENTS).alias("ad_placement"),
    )


def impressions_of(base: DataFrame) -> DataFrame:
    return base.where(F.col("event_type") == "view").select(
        numbered("imp_", "event_id", 8).alias("impression_id"),
        "timestamp",
        "customer_id",
        "merchant_id",
        "ad_placement",
        F.col("cuisine").alias("advertiser_cuisine"),
        F.when(F.col("event_id") % 3 == 0, "ios").otherwise("android").alias("device"),
    )


def clicks_of(base: DataFrame, impressions: DataFrame) -> DataFrame:
    """A click belongs to the pair's last impression at or before it, if any."""
    clicks = base.where(F.col("event_type") == "click").select(
        numbered("clk_", "event_id", 7).alias("click_id"),
        "timestamp",
        "customer_id",
        "merchant_id",
        "ad_placement",
    )
    seen = Lookup("seen", impressions, "timestamp", "impression_id")
    # Both sides in one scan.
    behind = [base.where(F.col("event_type").isin("view", "click"))]
    return asof_join(clicks, [seen], ["customer_id", "merchant_id"], "timestamp", count_on=behind).select(
        "click_id",
        F.col("seen.impression_id").alias("impression_id"),
        "timestamp",
        "customer_id",
        "merchant_id",
        "ad_placement",
    )


def orders_of(base: DataFrame) -> DataFrame:
    return base.where(F.col("event_type") == "purchase").select(
        numbered("ord_", "event_id", 7).alias("order_id"),
        "timestamp",
        "customer_id",
        "merchant_id",
        F.col("value").alias("order_amount"),
        F.when(F.col("k") >= 65, 1).otherwise(0).alias("used_coupon"),
        "cuisine",
    )


def ad_logs(spark: SparkSession, sf_dir: str) -> AdLogs:
    base = base_events(table(spark, sf_dir, "events"))
    impressions = impressions_of(base)
    return AdLogs(impressions, clicks_of(base, impressions), orders_of(base))


def line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as ad orders: the large order table, with repeated order ids."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.concat(F.lit("ord_"), "l_orderkey", F.lit("_"), "l_linenumber").alias("order_id"),
            F.col("l_shipdate").alias("timestamp"),
            numbered("usr_", "o_custkey", 6).alias("customer_id"),
            numbered("merch_", "l_suppkey", 4).alias("merchant_id"),
            F.col("l_extendedprice").alias("order_amount"),
            F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).alias("used_coupon"),
            F.col("p_type").alias("cuisine"),
        )
    )
