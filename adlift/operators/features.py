"""Observations, feature lookups, the training matrix and the skew report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlift import schemas as S
from adlift.functions.scalars import affinity_match, ratio, rounded
from adlift.operators.ordered import Lookup, asof_join
from adlift.operators.skew import HOT_ROWS, KeySummary, hot_buckets


@dataclass(frozen=True)
class FeatureLookup:
    """Which columns to take from a feature table, and the key to take them by."""

    table: DataFrame
    key: str
    features: tuple[str, ...]
    ts: str = "feature_ts"


def customer_lookup(gold: DataFrame) -> FeatureLookup:
    return FeatureLookup(gold, "customer_id", (*S.CUSTOMER_FEATURES, "user_preferred_cuisine"))


def merchant_lookup(gold: DataFrame) -> FeatureLookup:
    return FeatureLookup(gold, "merchant_id", (*S.MERCHANT_FEATURES, "merchant_cuisine"))


_OBSERVED = ["impression_id", "customer_id", "merchant_id", "ad_placement", "device"]


def observations_clicked(
    impressions: DataFrame,
    clicks: DataFrame,
    dedup: bool = False,
    keep: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Impressions labelled by whether they were clicked.

    As coded, an impression with several clicks appears once per click;
    ``dedup`` brings clicks to one per impression first. A left join can only
    be split on its left side, so where one impression holds too many clicks
    the clicked part becomes an inner join, which can be split on either.
    """
    hits = clicks.where(F.col("impression_id").isNotNull()).select("impression_id", "click_id")
    if dedup:
        hits = hits.groupBy("impression_id").agg(F.max("click_id").alias("click_id"))
    if dedup or not hot_buckets([hits], ["impression_id"], hot_rows):
        joined = impressions.join(hits, "impression_id", "left")
    else:
        clicked = hits.select("impression_id").distinct()
        quiet = impressions.join(clicked, "impression_id", "left_anti")
        joined = hits.join(impressions, "impression_id").unionByName(quiet, allowMissingColumns=True)
    label = F.col("click_id").isNotNull().cast("int").alias("has_clicked")
    return joined.select(*_OBSERVED, *keep, label)


def observations_converted(impressions: DataFrame, silver: DataFrame) -> DataFrame:
    """Impressions labelled by whether an order is attributed to them."""
    sold = (
        silver.where(F.col("attributed_impression_id").isNotNull())
        .select(F.col("attributed_impression_id").alias("impression_id"))
        .distinct()
        .withColumn("_sold", F.lit(1))
    )
    label = F.coalesce(F.col("_sold"), F.lit(0)).alias("has_converted")
    return impressions.join(sold, "impression_id", "left").select(*_OBSERVED, label)


def label_prevalence(observations: DataFrame, label: str = "has_clicked") -> DataFrame:
    return observations.agg(
        F.count(F.lit(1)).alias("observations"),
        F.sum(label).alias("positives"),
        rounded(F.avg(label), 6).alias("prevalence"),
    )


def training_set(
    observations: DataFrame, lookups: Sequence[FeatureLookup], exclude: Sequence[str] = ()
) -> DataFrame:
    """Observations with the current value of every looked-up feature.

    Feature tables hold one row per key. Whether one is small enough to
    broadcast is left to the planner, which knows its size; otherwise a hot
    key is split by the skew join.
    """
    out = observations
    for look in lookups:
        out = out.join(look.table.select(look.key, *look.features), look.key, "left")
    names = [*observations.columns, *[f for look in lookups for f in look.features]]
    return out.select(*[n for n in names if n not in exclude])


def training_set_point_in_time(
    observations: DataFrame,
    lookups: Sequence[FeatureLookup],
    ts: str = "timestamp",
    exclude: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    summaries: Mapping[str, Sequence[KeySummary]] | None = None,
) -> DataFrame:
    """Observations with the features as of the last snapshot strictly before them.

    ``summaries`` by lookup key are those of the tables that observations and
    snapshots come from (see ``hot_buckets``); with them no job runs here.
    """
    out = observations
    for look in lookups:
        side = Lookup("snap", look.table, look.ts, look.ts, look.features, strict=True)
        # Lookups keep every row and its key: where keys are counted, the features looked up before are not computed.
        joined = asof_join(
            out, [side], [look.key], ts, hot_rows, [observations, look.table], (summaries or {}).get(look.key)
        )
        out = joined.select(*out.columns, *[F.col(f"snap.{f}").alias(f) for f in look.features])
    return out.select(*[c for c in out.columns if c not in exclude])


def batch_lookup(
    requests: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    missing: str = "serving_defaults",
) -> DataFrame:
    """Feature vectors for a table of (customer_id, merchant_id) requests.

    ``serving_defaults`` gives a feature its default only where the key is
    unknown; a null stored under a known key stays null, and two unknown
    cuisines match. ``zero`` turns every null into 0 and never matches unknowns.
    """
    joined = _looked_up(requests, customers, merchants)
    return joined.select(
        *requests.columns, "customer_found", "merchant_found", *[c.alias(n) for n, c in _vector(missing).items()]
    )


def _looked_up(requests: DataFrame, customers: DataFrame, merchants: DataFrame) -> DataFrame:
    """Requests with both feature rows as stored, and whether each was there."""
    joined = requests
    for look, found in (
        (customer_lookup(customers), "customer_found"),
        (merchant_lookup(merchants), "merchant_found"),
    ):
        side = look.table.select(look.key, *look.features, F.lit(True).alias(found))
        joined = joined.join(side, look.key, "left").withColumn(
            found, F.coalesce(F.col(found), F.lit(False))
        )
    return joined


def _vector(missing: str) -> dict[str, Column]:
    """The features of a looked-up request, with what is missing filled in."""
    user, shop = F.col("user_preferred_cuisine"), F.col("merchant_cuisine")

    def feature(name: str) -> Column:
        value = F.col(name).cast("double")
        if missing == "zero":
            return F.coalesce(value, F.lit(0.0))
        found = F.col("customer_found" if name in S.CUSTOMER_FEATURES else "merchant_found")
        return F.when(found, value).otherwise(F.lit(S.SERVING_DEFAULTS[name]))

    match = affinity_match(user, shop) if missing == "zero" else user.eqNullSafe(shop).cast("int")
    names = (*S.CUSTOMER_FEATURES, *S.MERCHANT_FEATURES)
    return {n: feature(n) for n in names} | {"is_affinity_match": match}


def one_hot(column: str, levels: Sequence[str]) -> list[Column]:
    """Indicator columns for every level but the alphabetically first."""
    return [
        F.coalesce((F.col(column) == level).cast("int"), F.lit(0)).alias(f"{column}_{level}")
        for level in sorted(levels)[1:]
    ]


FEATURE_COLUMNS = (
    *S.NUMERIC_FEATURES,
    *[f"ad_placement_{p}" for p in sorted(S.PLACEMENTS)[1:]],
    *[f"device_{d}" for d in sorted(S.DEVICES)[1:]],
)


def training_matrix(training: DataFrame, label: str = "has_clicked") -> DataFrame:
    """The 13 model inputs in fixed order, nulls as 0, with id and label."""
    match = affinity_match(F.col("user_preferred_cuisine"), F.col("merchant_cuisine"))
    with_match = training.withColumn("is_affinity_match", match)
    return with_match.select(
        "impression_id",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in S.NUMERIC_FEATURES],
        *one_hot("ad_placement", S.PLACEMENTS),
        *one_hot("device", S.DEVICES),
        label,
    )


# Bin width per feature for the stability index; the tenth bin is open.
SKEW_BINS = {
    "user_total_orders": 5.0,
    "user_avg_basket_value": 10.0,
    "user_discount_affinity": 0.1,
    "user_ad_fatigue_score": 0.5,
    "user_historical_ctr": 0.1,
    "merchant_total_orders": 50.0,
    "merchant_avg_ticket": 10.0,
    "merchant_retail_media_dependency_rate": 0.1,
    "is_affinity_match": 1.0,
}


def feature_skew_report(offline: DataFrame, serving: DataFrame, key: str) -> DataFrame:
    """Per feature: share of rows whose two values differ, and the stability index (PSI).

    ``offline`` and ``serving`` hold one row per ``key``.
    """
    names = list(SKEW_BINS)
    left = offline.select(key, *[F.col(n).cast("double").alias(n) for n in names])
    right = serving.select(key, *[F.col(n).cast("double").alias(f"s_{n}") for n in names])
    return _skew(left.join(right, key))


def lookup_skew_report(
    requests: DataFrame, customers: DataFrame, merchants: DataFrame, offline: str = "zero",
    serving: str = "serving_defaults",
) -> DataFrame:
    """The report between two ways to fill what is missing, from one lookup of the requests."""
    left = [c.cast("double").alias(n) for n, c in _vector(offline).items()]
    right = [c.cast("double").alias(f"s_{n}") for n, c in _vector(serving).items()]
    return _skew(_looked_up(requests, customers, merchants).select(*left, *right))


def _skew(pairs: DataFrame) -> DataFrame:
    """The report over rows with both values of every feature.

    Rows first shrink to the distinct patterns of bins, nine features at once;
    only those few are taken apart by feature.
    """

    def binned(value: Column, width: float) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(9), F.floor(value / F.lit(width)))).cast("int")

    codes = []
    for name, width in SKEW_BINS.items():
        off, srv = F.col(name), F.col(f"s_{name}")
        differ = (~off.eqNullSafe(srv)).cast("int")
        codes.append((binned(off, width) * 20 + binned(srv, width) * 2 + differ).alias(name))
    patterns = pairs.select(*codes).groupBy(*SKEW_BINS).agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("code")) for n in SKEW_BINS]))
    code = F.col("p.code")
    cells = patterns.select("n", each.alias("p")).groupBy(
        F.col("p.feature").alias("feature"),
        F.floor(code / 20).cast("int").alias("off_bin"),
        F.floor(code % 20 / 2).cast("int").alias("srv_bin"),
    )
    cells = cells.agg(F.sum("n").alias("n"), F.sum(F.col("n") * (code % 2)).alias("differ"))
    bins = cells.select(
        "feature",
        F.explode(
            F.array(
                F.struct(F.col("off_bin").alias("bin"), F.col("n").alias("off"), F.lit(0).cast("bigint").alias("srv")),
                F.struct(F.col("srv_bin").alias("bin"), F.lit(0).cast("bigint").alias("off"), F.col("n").alias("srv")),
            )
        ).alias("b"),
    ).groupBy("feature", "b.bin").agg(F.sum("b.off").alias("off"), F.sum("b.srv").alias("srv"))
    totals = cells.groupBy("feature").agg(F.sum("n").alias("rows"), F.sum("differ").alias("mismatches"))

    def share(count: Column) -> Column:
        return F.greatest(ratio(count, F.col("rows")), F.lit(1e-6))

    off, srv = share(F.col("off")), share(F.col("srv"))
    psi = F.sum((off - srv) * F.log(off / srv))
    return (
        bins.join(totals, "feature")
        .groupBy("feature", "rows", "mismatches")
        .agg(rounded(psi, 6).alias("psi"))
        .withColumn("mismatch_rate", rounded(ratio(F.col("mismatches"), F.col("rows")), 6))
    )


def primary_key_check(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, repeated keys and null keys of a feature table, in one row."""
    null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("null_key", null_key)
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(F.when(F.col("null_key") == 0, 1)).alias("distinct_keys"),
        F.count(F.when((F.col("null_key") == 0) & (F.col("n") > 1), 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(F.col("null_key") == 1, F.col("n"))), F.lit(0)).alias("null_key_rows"),
    )
