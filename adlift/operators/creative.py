"""Audience segments, copy generation, guardrails and the creative catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlift import schemas as S
from adlift.functions.scalars import (
    heuristic_propensity,
    meal_period,
    price_sensitive,
    rounded,
    sanitised,
)
from adlift.operators import texts

_SEGMENT = ["segment_id", "cuisine", "discount_sensitive", "period"]


def usual_period(orders: DataFrame) -> DataFrame:
    """The meal period a customer orders in most often; the smallest name on ties."""
    counts = (
        orders.select("customer_id", meal_period("timestamp").alias("period"))
        .where(F.col("period").isNotNull())
        .groupBy("customer_id", "period")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), "period"))
    return counts.groupBy("customer_id").agg(best.alias("b")).select("customer_id", "b.period")


def customer_segments(gold: DataFrame, orders: DataFrame) -> DataFrame:
    """Each customer's segment: favourite cuisine, price sensitivity and usual period."""
    joined = gold.join(usual_period(orders), "customer_id", "left")
    sensitive = price_sensitive(F.col("user_discount_affinity"))
    period = F.coalesce(F.col("period"), F.lit("jantar"))
    segment = F.concat_ws(
        "_",
        F.lit("seg"),
        F.lower("user_preferred_cuisine"),
        F.when(sensitive, "promo").otherwise("regular"),
        period,
    )
    return joined.select(
        "customer_id",
        segment.alias("segment_id"),
        F.col("user_preferred_cuisine").alias("cuisine"),
        sensitive.alias("discount_sensitive"),
        period.alias("period"),
        "user_avg_basket_value",
        "user_historical_ctr",
    )


def segment_profile(members: DataFrame, min_customers: int = 1) -> DataFrame:
    """Aggregates per segment; segments under ``min_customers`` are withheld."""
    return (
        members.groupBy(*_SEGMENT)
        .agg(
            F.count(F.lit(1)).alias("customers"),
            rounded(F.sum(F.col("user_avg_basket_value").cast("decimal(18,2)")).cast("double")
                    / F.count("user_avg_basket_value"), 2).alias("avg_ticket"),
            rounded(F.sum(F.col("user_historical_ctr").cast("decimal(18,4)")).cast("double")
                    / F.count("user_historical_ctr"), 4).alias("avg_ctr"),
        )
        .where(F.col("customers") >= min_customers)
    )


def customer_context(requests: DataFrame, gold: DataFrame) -> DataFrame:
    """Context and heuristic propensity per request; fixed values for unknown customers."""
    known = gold.select(
        "customer_id",
        F.lit(True).alias("known"),
        F.col("user_preferred_cuisine").alias("cuisine"),
        F.coalesce(price_sensitive(F.col("user_discount_affinity")), F.lit(False)).alias("discount_sensitive"),
        F.col("user_avg_basket_value").alias("avg_ticket"),
        F.col("user_ad_fatigue_score").alias("fatigue"),
    )
    joined = requests.join(known, "customer_id", "left")
    seen = F.coalesce(F.col("known"), F.lit(False))
    fields = {n: F.when(seen, F.col(n)).otherwise(F.lit(v)) for n, v in S.UNKNOWN_CONTEXT.items()}
    out = joined.select(
        *requests.columns, seen.alias("known"), *[c.alias(n) for n, c in fields.items()]
    )
    score = heuristic_propensity(F.col("avg_ticket"), F.col("discount_sensitive"))
    return out.withColumn("propensity", rounded(score, 6))


def templates(spark: SparkSession) -> DataFrame:
    """The fixed copy texts as a table."""
    rows = [(*key, lines) for key, lines in texts.TEMPLATES.items()]
    return spark.createDataFrame(
        rows, "cuisine string, discount_sensitive boolean, period string, copies array<string>"
    )


def example_segments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        texts.SEGMENTS, "segment_id string, cuisine string, discount_sensitive boolean, period string"
    )


def segment_prompts(segments: DataFrame, variations: int = 5, max_chars: int = 60) -> DataFrame:
    """The request a text generator would get for each segment. Aggregates only, no ids."""
    prompt = F.format_string(
        "Gere %d textos de ate %d caracteres para o publico de %s, %s, no periodo %s.",
        F.lit(variations),
        F.lit(max_chars),
        "cuisine",
        F.when(F.col("discount_sensitive"), "sensivel a desconto").otherwise("sem foco em desconto"),
        "period",
    )
    return segments.select(*_SEGMENT, prompt.alias("prompt"))


def generate(segments: DataFrame, copies: DataFrame | None = None) -> DataFrame:
    """Copy texts per segment with their position; generic ones where no template fits.

    ``copies`` is any (cuisine, discount_sensitive, period, copies) table; the
    default one is ten fixed rows, which is why it may be broadcast.
    """
    if copies is None:
        copies = F.broadcast(templates(segments.sparkSession))
    before, after = zip(*[line.split("{cuisine}") for line in texts.GENERIC])
    generic = F.array(
        *[F.concat(F.lit(a), F.col("cuisine"), F.lit(b)) for a, b in zip(before, after)]
    )
    joined = segments.select(*_SEGMENT).join(copies, ["cuisine", "discount_sensitive", "period"], "left")
    return joined.select(
        *_SEGMENT, F.posexplode(F.coalesce("copies", generic)).alias("position", "copy_text")
    )


def guardrails(
    generated: DataFrame,
    max_chars: int = texts.MAX_CHARS,
    banned: Sequence[str] = texts.BANNED_TERMS,
) -> DataFrame:
    """Cleaned texts with length, verdict and the reason of a rejection."""
    cleaned = generated.withColumn("copy_text", sanitised(F.col("copy_text")))
    lowered = F.lower("copy_text")
    has_banned: Column = F.lit(False)
    for term in banned:
        has_banned = has_banned | lowered.contains(term)
    reason = (
        F.when(F.col("copy_text").isNull() | (F.length("copy_text") == 0), "empty")
        .when(F.length("copy_text") > max_chars, "too_long")
        .when(has_banned, "banned_term")
    )
    return cleaned.select(
        *cleaned.columns,
        F.length("copy_text").alias("n_chars"),
        F.when(reason.isNull(), texts.APPROVED).otherwise("REJECTED_GUARDRAILS").alias("status"),
        reason.alias("reason"),
    )


def creative_catalog(
    generated: DataFrame,
    max_chars: int = texts.MAX_CHARS,
    banned: Sequence[str] = texts.BANNED_TERMS,
) -> DataFrame:
    """Approved texts, numbered within their segment after the guardrails.

    A segment holds a handful of texts, so its numbering window is small by
    nature and does not grow with the logs.
    """
    approved = guardrails(generated, max_chars, banned).where(F.col("status") == texts.APPROVED)
    arm = F.row_number().over(Window.partitionBy("segment_id").orderBy("position")) - 1
    return approved.withColumn("arm", arm).select(
        F.concat(F.lit("crt_"), "segment_id", F.format_string("_%02d", "arm")).alias("creative_id"),
        *_SEGMENT,
        "copy_text",
        "status",
        F.lit(1.0).alias("mab_arm_weight"),
        "arm",
    )
