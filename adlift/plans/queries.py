"""The named queries: every operator over the star-schema tables of one folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import partial, reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlift import schemas as S
from adlift.functions.scalars import (
    affinity_match,
    heuristic_propensity,
    hours_between,
    meal_period,
    price_sensitive,
    rounded,
)
from adlift.operators import attribution as A
from adlift.operators import bandit, creative, daily, features, gold, governance, model
from adlift.operators.evaluation import binary_metrics, stratified_split
from adlift.session import fresh_dir, side_by_side
from adlift.plans.incremental import IncrementalGold
from adlift.plans.medallion import Layers, layers
from adlift.sources import bronze, sinks
from adlift.sources.driver_tables import base_events, numbered, table
from adlift.sources.versions import file_system
from adlift.streaming.arms import SERVED, ArmStream
from adlift.streaming.attribution import TOUCH, SilverStream, touches
from adlift.streaming.ingest import CountedIngest, append_stream, drop_replays, read_stream
from adlift.streaming.interval import HEARTBEAT, SETTLED, run_interval_join

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

# Segments below this size are not shown to a text generator or in reports.
MIN_SEGMENT = 3
# Hours between the end of the logs and the afternoon that the trailing windows look back from.
MID_DAY = 250


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(build(spark, sf_dir))

    _REGISTRY[build.__name__.strip("_")] = run
    return build


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as text with microseconds, so that engines compare alike."""
    return df.select(
        *[
            F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) if t == "timestamp" else F.col(c)
            for c, t in df.dtypes
        ]
    )


# ---- tables the queries share -------------------------------------------------


def _as_of(t: Layers, hours_before: int = 0):
    """The start of the day after the logs end, or some hours before it, as a literal that filters are pushed down with."""
    return F.lit(f"{t.end - timedelta(hours=hours_before):%Y-%m-%d %H:%M:%S}").cast("timestamp")


def _line_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ad request per (order, supplier): many customers and merchants are unknown to gold."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.concat(F.lit("req_"), "l_orderkey", F.lit("_"), "l_suppkey").alias("request_id"),
        numbered("usr_", "o_custkey", 6).alias("customer_id"),
        numbered("merch_", "l_suppkey", 4).alias("merchant_id"),
    )


def _silver(t: Layers) -> DataFrame:
    return A.attribution_asof(t.logs.orders, t.logs.clicks)


def _line_silver(t: Layers) -> DataFrame:
    """The large order table attributed to the clicks of the event log."""
    return t.published("line_attribution", lambda: A.attribution_asof(t.line_orders, t.logs.clicks))


def _clicked(t: Layers, **options) -> DataFrame:
    return features.observations_clicked(t.logs.impressions, t.logs.clicks, **options)


def _training(t: Layers) -> DataFrame:
    lookups = [features.customer_lookup(t.customers), features.merchant_lookup(t.merchants)]
    return features.training_set(_clicked(t), lookups)


def _members(t: Layers) -> DataFrame:
    return t.published("customer_segments", lambda: creative.customer_segments(t.customers, t.logs.orders))


def _profile(t: Layers, minimum: int = 1) -> DataFrame:
    return creative.segment_profile(_members(t), minimum)


def _catalog(t: Layers) -> DataFrame:
    return t.published(
        "creative_catalog", lambda: creative.creative_catalog(creative.generate(_profile(t)))
    )


def _requests(t: Layers) -> DataFrame:
    """Every impression as a request for a creative of its customer's segment."""
    asked = t.logs.impressions.select(F.col("impression_id").alias("request_id"), "customer_id")
    segment = _members(t).select("customer_id", "segment_id")
    return asked.join(segment, "customer_id", "left").select("request_id", "segment_id")


def _arm_stats(t: Layers) -> DataFrame:
    """Arms after a round of pure exploration over the logged impressions."""
    return t.published("arm_stats", lambda: _explored_arms(t))


def _explored_arms(t: Layers) -> DataFrame:
    catalog = _catalog(t)
    shown = bandit.decide(_requests(t), bandit.arm_stats(catalog), epsilon=1.0, seed="log")
    labels = _clicked(t, dedup=True).select(
        F.col("impression_id").alias("request_id"), F.col("has_clicked").alias("clicked")
    )
    return bandit.arm_stats(catalog, shown.join(labels, "request_id"))


def publish(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All gold tables that several queries read, written if they are not yet."""
    t = layers(spark, sf_dir)
    assert t.logs
    side_by_side(lambda: t.gold, lambda: _line_silver(t))
    return [t.customers, t.merchants, _line_silver(t), _members(t), _catalog(t), _arm_stats(t)]


# ---- attribution --------------------------------------------------------------


@query
def layer_counts(spark, sf_dir):
    t = layers(spark, sf_dir)
    return gold.layer_counts(
        bronze_impressions=t.logs.impressions,
        bronze_clicks=t.logs.clicks,
        bronze_orders=t.logs.orders,
        silver_ad_attribution=t.silver,
        gold_customer_features=t.customers,
        gold_merchant_features=t.merchants,
    )


@query
def ranked_clicks(spark, sf_dir):
    return A.ranked_clicks(layers(spark, sf_dir).logs.clicks)


@query
def attribution_global_last(spark, sf_dir):
    t = layers(spark, sf_dir)
    return A.attribution_global_last(t.logs.orders, t.logs.clicks)


@query
def attribution_asof(spark, sf_dir):
    return _silver(layers(spark, sf_dir))


@query
def attribution_view_through(spark, sf_dir):
    t = layers(spark, sf_dir)
    return A.attribution_view_through(t.logs.orders, t.logs.impressions)


@query
def attribution_full(spark, sf_dir):
    t = layers(spark, sf_dir)
    return A.attribution_full(t.logs.orders, t.logs.clicks, t.logs.impressions, view_weight=0.5)


@query
def attribution_summary(spark, sf_dir):
    return A.attribution_summary(layers(spark, sf_dir).silver)


@query
def dedup_orders(spark, sf_dir):
    orders = layers(spark, sf_dir).line_orders
    return A.dedup_latest(orders, ["order_id"], ["timestamp", "order_amount", "merchant_id"])


# ---- gold ---------------------------------------------------------------------


@query
def customer_order_agg(spark, sf_dir):
    return gold.customer_order_agg(layers(spark, sf_dir).silver)


@query
def customer_ad_behavior(spark, sf_dir):
    t = layers(spark, sf_dir)
    return gold.customer_ad_behavior(t.logs.impressions, t.logs.clicks)


@query
def gold_customer_features(spark, sf_dir):
    t = layers(spark, sf_dir)
    return gold.gold_customer_features(_silver(t), t.logs.impressions, t.logs.clicks).drop(
        "last_feature_update"
    )


@query
def gold_customer_features_sparse(spark, sf_dir):
    """Ads of the event log against the order lines: customers on either side are missing on the other."""
    t = layers(spark, sf_dir)
    silver = _line_silver(t)
    return gold.gold_customer_features(silver, t.logs.impressions, t.logs.clicks).drop("last_feature_update")


@query
def gold_merchant_features(spark, sf_dir):
    return gold.gold_merchant_features(_silver(layers(spark, sf_dir))).drop("last_feature_update")


_INCREMENTAL: dict[tuple[str, str], IncrementalGold] = {}


def _incremental(spark: SparkSession, sf_dir: str) -> IncrementalGold:
    """Gold from three batches, the last of which delivers the first one's orders again; built once per session.

    Batches are dealt by id, so clicks come before their impressions as often as after.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INCREMENTAL:
        t = layers(spark, sf_dir)
        kept = IncrementalGold(spark, fresh_dir(spark, "incremental-gold"), buckets=8)

        def dealt(df: DataFrame, column: str, batches: list[int]) -> DataFrame:
            return df.where(F.pmod(F.xxhash64(column), F.lit(3)).isin(batches))

        for batch, again in enumerate([[0], [1], [2, 0]]):
            kept.add(
                batch,
                dealt(t.silver, "order_id", again),
                dealt(t.logs.impressions, "impression_id", [batch]),
                dealt(t.logs.clicks, "click_id", [batch]),
            )
        _INCREMENTAL[key] = kept
    return _INCREMENTAL[key]


@query
def gold_customers_as_of(spark, sf_dir):
    """Gold stamped with a given time."""
    t = layers(spark, sf_dir)
    return gold.gold_customer_features(t.silver, t.logs.impressions, t.logs.clicks, _as_of(t)).select(
        "customer_id", "user_total_orders", "user_ad_impressions", "last_feature_update"
    )


@query
def merchant_quality(spark, sf_dir):
    """Suppliers rated by their lines: not returned (three parts), and settled among the discounted (one part)."""
    lines = table(spark, sf_dir, "lineitem")
    settled = F.when(F.col("l_discount") >= 0.05, (F.col("l_linestatus") == "F").cast("double"))
    ratings = lines.groupBy(numbered("merch_", "l_suppkey", 4).alias("merchant_id")).agg(
        F.avg((F.col("l_returnflag") != "R").cast("double")).alias("not_returned"), F.avg(settled).alias("settled")
    )
    merchants = table(spark, sf_dir, "supplier").select(numbered("merch_", "s_suppkey", 4).alias("merchant_id"))
    return gold.merchant_quality(merchants, ratings, {"not_returned": 3.0, "settled": 1.0})


@query
def gold_incremental_customers(spark, sf_dir):
    return _incremental(spark, sf_dir).customers().drop("last_feature_update")


@query
def gold_incremental_merchants(spark, sf_dir):
    return _incremental(spark, sf_dir).merchants().drop("last_feature_update")


@query
def line_merchant_features(spark, sf_dir):
    """Merchant features of all order lines, the large order table."""
    silver = _line_silver(layers(spark, sf_dir))
    return gold.gold_merchant_features(silver).drop("last_feature_update")


@query
def line_customer_order_agg(spark, sf_dir):
    silver = _line_silver(layers(spark, sf_dir))
    return gold.customer_order_agg(silver)


@query
def traffic_totals(spark, sf_dir):
    t = layers(spark, sf_dir)
    return gold.traffic_totals(t.logs.impressions, t.logs.clicks, t.logs.orders)


@query
def orders_last_30d(spark, sf_dir):
    t = layers(spark, sf_dir)
    return gold.orders_last_days(t.dated_logs.orders, _as_of(t), 30)


@query
def fatigue_last_7d(spark, sf_dir):
    t = layers(spark, sf_dir)
    return gold.fatigue_last_days(t.dated_logs.impressions, t.dated_logs.clicks, _as_of(t), 7)


def _window_tables(t: Layers, name: str, build: Callable[[], DataFrame]) -> tuple[DataFrame, DataFrame]:
    facts = t.published(f"{name}_facts", lambda: daily.in_folders(build()), [S.EVENT_DATE])
    days = t.published(f"{name}_days", lambda: daily.in_folders(daily.per_day(facts)), [S.EVENT_DATE])
    return days, facts


@query
def orders_trailing_days(spark, sf_dir):
    """Orders of the 14 days before an afternoon: whole days from their counts, the two cut days from the orders."""
    t = layers(spark, sf_dir)
    tables = _window_tables(t, "order", lambda: daily.order_facts(t.clean("orders")))
    return daily.trailing_orders(*tables, _as_of(t, MID_DAY), 14)


@query
def fatigue_trailing_days(spark, sf_dir):
    """Ad fatigue over the 7 days before an afternoon, counting the clicks known by then."""
    t = layers(spark, sf_dir)
    tables = _window_tables(t, "ad", lambda: daily.ad_facts(t.clean("impressions"), t.clean("clicks")))
    return daily.trailing_fatigue(*tables, _as_of(t, MID_DAY), 7)


@query
def fatigue_from_daily(spark, sf_dir):
    t = layers(spark, sf_dir)
    return gold.fatigue_from_daily(gold.daily_ad_counts(t.logs.impressions, t.logs.clicks))


@query
def rolling_customer_features(spark, sf_dir):
    t = layers(spark, sf_dir)
    at = t.logs.impressions.select("impression_id", "customer_id", "timestamp")
    return gold.rolling_customer_features(at, t.logs.impressions, t.logs.clicks, t.logs.orders)


@query
def merchant_conversion_rate(spark, sf_dir):
    t = layers(spark, sf_dir)
    return gold.merchant_conversion_rate(t.silver, t.logs.clicks)


@query
def advertiser_rollup(spark, sf_dir):
    t = layers(spark, sf_dir)
    return gold.advertiser_rollup(t.logs.impressions, t.logs.clicks, t.silver)


@query
def feature_sample(spark, sf_dir):
    columns = [
        "customer_id",
        "user_preferred_cuisine",
        "user_avg_basket_value",
        "user_ad_fatigue_score",
        "user_historical_ctr",
    ]
    return layers(spark, sf_dir).customers.select(*columns).orderBy("customer_id").limit(5)


@query
def feature_table_pk_check(spark, sf_dir):
    t = layers(spark, sf_dir)
    return features.primary_key_check(
        "customer_features", t.customers, ["customer_id"]
    ).unionByName(
        features.primary_key_check("merchant_features", t.merchants, ["merchant_id"])
    ).unionByName(
        features.primary_key_check("line_orders", t.line_orders, ["order_id"])
    )


@query
def meal_period_(spark, sf_dir):
    base = base_events(table(spark, sf_dir, "events"))
    return base.select("event_id", meal_period("timestamp").alias("period"))


# ---- features and model -------------------------------------------------------


@query
def observations_clicked(spark, sf_dir):
    t = layers(spark, sf_dir)
    return _clicked(t)


@query
def observations_converted(spark, sf_dir):
    t = layers(spark, sf_dir)
    return features.observations_converted(t.logs.impressions, t.silver)


@query
def label_prevalence(spark, sf_dir):
    t = layers(spark, sf_dir)
    return features.label_prevalence(_clicked(t))


@query
def training_set(spark, sf_dir):
    return _training(layers(spark, sf_dir))


def _training_in_time(t: Layers) -> DataFrame:
    """Clicked observations with the features as they stood before each; no feature has seen its label."""
    observed = _clicked(t, keep=["timestamp"])
    lookups = [
        features.customer_lookup(gold.customer_snapshots(t.silver, t.logs.impressions, t.logs.clicks)),
        features.merchant_lookup(gold.merchant_snapshots(t.silver)),
    ]
    # An observation is an impression or a click, a snapshot a day with some event, of a merchant with orders.
    behind = t.key_summaries("impressions", "clicks", "impressions", "clicks", "orders")
    behind["merchant_id"] = t.key_summaries("impressions", "clicks", "orders")["merchant_id"]
    return features.training_set_point_in_time(observed, lookups, summaries=behind)


@query
def training_set_point_in_time(spark, sf_dir):
    return _training_in_time(layers(spark, sf_dir))


@query
def last_customer_snapshots(spark, sf_dir):
    """The last snapshot of every customer of the gold table, which it has to equal."""
    t = layers(spark, sf_dir)
    snapshots = gold.customer_snapshots(t.silver, t.logs.impressions, t.logs.clicks)
    last = snapshots.groupBy("customer_id").agg(F.max_by(F.struct(*snapshots.columns), "feature_ts").alias("s"))
    known = last.join(t.customers.select("customer_id"), "customer_id", "left_semi")
    return known.select("s.*").drop("feature_ts")


@query
def training_set_converted(spark, sf_dir):
    """The current features with the label of an attributed order."""
    t = layers(spark, sf_dir)
    observed = features.observations_converted(t.logs.impressions, t.silver)
    lookups = [features.customer_lookup(t.customers), features.merchant_lookup(t.merchants)]
    return features.training_set(observed, lookups)


@query
def affinity_match_(spark, sf_dir):
    match = affinity_match(F.col("user_preferred_cuisine"), F.col("merchant_cuisine"))
    return _training(layers(spark, sf_dir)).select("impression_id", match.alias("is_affinity_match"))


@query
def training_matrix(spark, sf_dir):
    return features.training_matrix(_training(layers(spark, sf_dir)))


@query
def batch_lookup_defaults(spark, sf_dir):
    t = layers(spark, sf_dir)
    return features.batch_lookup(_line_requests(spark, sf_dir), t.customers, t.merchants)


@query
def batch_lookup_zero(spark, sf_dir):
    t = layers(spark, sf_dir)
    requests = _line_requests(spark, sf_dir)
    return features.batch_lookup(requests, t.customers, t.merchants, missing="zero")


@query
def feature_skew_report(spark, sf_dir):
    t = layers(spark, sf_dir)
    requests = _line_requests(spark, sf_dir)
    return features.lookup_skew_report(requests, t.customers, t.merchants)


@query
def heuristic_propensity_(spark, sf_dir):
    sensitive = price_sensitive(F.col("user_discount_affinity"))
    score = heuristic_propensity(F.col("user_avg_basket_value"), sensitive)
    return layers(spark, sf_dir).customers.select("customer_id", rounded(score, 6).alias("propensity"))


@query
def binary_metrics_(spark, sf_dir):
    t = layers(spark, sf_dir)
    sensitive = price_sensitive(F.col("user_discount_affinity"))
    score = heuristic_propensity(F.col("user_avg_basket_value"), sensitive)
    scores = t.customers.select("customer_id", score.alias("score"))
    observed = _clicked(t)
    return binary_metrics(observed.join(scores, "customer_id"), "score", "has_clicked")


@query
def stratified_split_(spark, sf_dir):
    t = layers(spark, sf_dir)
    observed = _clicked(t, dedup=True)
    split = stratified_split(observed, "impression_id", "has_clicked")
    return split.select("impression_id", "has_clicked", "is_test")


@query
def training_set_excluding(spark, sf_dir):
    """The training set without its keys."""
    t = layers(spark, sf_dir)
    lookups = [features.customer_lookup(t.customers), features.merchant_lookup(t.merchants)]
    return features.training_set(_clicked(t), lookups, exclude=["customer_id", "merchant_id"])


@query
def run_log(spark, sf_dir):
    """The heuristic's metrics as a logged run, read back."""
    path = fresh_dir(spark, "runs")
    metrics = binary_metrics_(spark, sf_dir).first().asDict()
    model.log_run(spark, path, "propensity", "heuristic", model.BoostingParams(), metrics)
    runs = spark.read.parquet(f"{path}/runs")
    return runs.select("experiment", "run_name", F.explode("metrics").alias("metric", "value"))


@query
def training_vectors(spark, sf_dir):
    """Distinct vectors of the training set with the rows of either label as weights, as the trees are fitted on."""
    return model.weighted_vectors(features.training_matrix(_training(layers(spark, sf_dir))))


_MODELS: dict[tuple[str, str], PipelineModel] = {}


def _model_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix of the point-in-time set, written once: every pass of the split, the fit and the scores reads it."""
    t = layers(spark, sf_dir)
    return t.published("propensity_matrix", lambda: features.training_matrix(_training_in_time(t)))


def _model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix with its train/test split."""
    return stratified_split(_model_matrix(spark, sf_dir), "impression_id", "has_clicked")


def _model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """The propensity model on the training share; trained once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        split = _model_rows(spark, sf_dir)
        _MODELS[key] = model.train_propensity(split.where(F.col("is_test") == 0))
    return _MODELS[key]


def _test_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _model_rows(spark, sf_dir)
    return model.score(_model(spark, sf_dir), split.where(F.col("is_test") == 1))


@query
def propensity_scores(spark, sf_dir):
    return _test_scores(spark, sf_dir).select("impression_id", "has_clicked", "propensity")


@query
def propensity_metrics(spark, sf_dir):
    return binary_metrics(_test_scores(spark, sf_dir), "propensity", "has_clicked")


@query
def score_requests(spark, sf_dir):
    t = layers(spark, sf_dir)
    requests = t.logs.impressions.select(
        F.col("impression_id").alias("request_id"), "customer_id", "merchant_id", "ad_placement", "device"
    )
    return model.score_requests(_model(spark, sf_dir), requests, t.customers, t.merchants)


@query
def propensity_checks(spark, sf_dir):
    """Per label: scored observations, those with a probability, and those a second scoring gives the same."""
    matrix = _model_matrix(spark, sf_dir)
    scored = model.score(_model(spark, sf_dir), matrix)
    twice = model.score(_model(spark, sf_dir), scored.drop("probability"), "again")
    return twice.groupBy("has_clicked").agg(
        F.count(F.lit(1)).alias("observations"),
        F.count(F.when(F.col("propensity").between(0.0, 1.0), 1)).alias("probabilities"),
        F.count(F.when(F.col("propensity") == F.col("again"), 1)).alias("repeated"),
    )


@query
def score_request_checks(spark, sf_dir):
    """Every request with whether its keys were found and whether it got a probability."""
    scored = score_requests(spark, sf_dir)
    probable = F.coalesce(F.col("propensity").between(0.0, 1.0), F.lit(False))
    return scored.select("request_id", "customer_found", "merchant_found", probable.alias("is_probability"))


@query
def rank_candidates(spark, sf_dir):
    """The three best ads of a customer's day by the merchants' heuristic propensity."""
    t = layers(spark, sf_dir)
    score = heuristic_propensity(
        F.col("merchant_avg_ticket"), price_sensitive(F.col("merchant_coupon_dependency"))
    )
    shops = t.merchants.select("merchant_id", rounded(score, 6).alias("score"))
    day = F.date_format("timestamp", "yyyy-MM-dd")
    shown = t.logs.impressions.select(
        F.concat_ws("@", "customer_id", day).alias("request_id"), "merchant_id", "impression_id"
    )
    return bandit.rank_candidates(
        shown.join(shops, "merchant_id"), "request_id", "score", ["merchant_id", "impression_id"], 3
    )


# ---- creatives and bandit -----------------------------------------------------


@query
def customer_segments(spark, sf_dir):
    return _members(layers(spark, sf_dir))


@query
def segment_profile(spark, sf_dir):
    return _profile(layers(spark, sf_dir), MIN_SEGMENT)


@query
def segment_prompts(spark, sf_dir):
    return creative.segment_prompts(_profile(layers(spark, sf_dir), MIN_SEGMENT))


@query
def creative_generation(spark, sf_dir):
    return creative.generate(_profile(layers(spark, sf_dir)))


@query
def creative_guardrails(spark, sf_dir):
    """The stricter documented limit of 60 characters, and two banned words that occur."""
    generated = creative.generate(_profile(layers(spark, sf_dir), 1))
    return creative.guardrails(generated, max_chars=60, banned=("erro", "relâmpago"))


@query
def document_guardrails(spark, sf_dir):
    """The same guardrails over whole free texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("copy_text"))
    return creative.guardrails(docs).select("doc_id", "n_chars", "status", "reason")


@query
def creative_catalog(spark, sf_dir):
    return _catalog(layers(spark, sf_dir)).drop("arm")


@query
def customer_context(spark, sf_dir):
    requests = table(spark, sf_dir, "customer").select(
        numbered("usr_", "c_custkey", 6).alias("customer_id")
    )
    return creative.customer_context(requests, layers(spark, sf_dir).customers)


@query
def arm_stats(spark, sf_dir):
    t = layers(spark, sf_dir)
    return _arm_stats(t)


@query
def best_arm(spark, sf_dir):
    t = layers(spark, sf_dir)
    return bandit.best_arm(_arm_stats(t))


def _decisions(spark, sf_dir, choose) -> DataFrame:
    t = layers(spark, sf_dir)
    return choose(_requests(t), _arm_stats(t))


@query
def creative_decisions_greedy(spark, sf_dir):
    return _decisions(spark, sf_dir, partial(bandit.decide, epsilon=0.0))


@query
def creative_decisions_egreedy(spark, sf_dir):
    return _decisions(spark, sf_dir, bandit.decide)


@query
def creative_decisions_thompson(spark, sf_dir):
    return _decisions(spark, sf_dir, bandit.decide_thompson)


@query
def thompson_checks(spark, sf_dir):
    """Per request: whether the creative is one of its segment's, or the fallback, and drawn again alike."""
    t = layers(spark, sf_dir)
    chosen = bandit.decide_thompson(_requests(t), _arm_stats(t))
    again = bandit.decide_thompson(_requests(t), _arm_stats(t)).select(
        "request_id", F.col("creative_id").alias("again")
    )
    arms = _arm_stats(t).select("creative_id", F.col("segment_id").alias("of"))
    joined = chosen.join(again, "request_id").join(arms, "creative_id", "left")
    own = F.coalesce(F.col("of") == F.col("segment_id"), F.lit(False))
    return joined.select(
        "request_id", "segment_id", own.alias("in_segment"), (F.col("creative_id") == F.col("again")).alias("repeats")
    )


@query
def ad_decisions(spark, sf_dir):
    """Per request the context, the propensity, the creative and its text; every 50th request is pinned."""
    t = layers(spark, sf_dir)
    asked = t.logs.impressions.select(F.col("impression_id").alias("request_id"), "customer_id")
    pinned = asked.where(F.substring("request_id", -2, 2).isin("00", "50")).select(
        "request_id", F.lit("seg_pizza_promo_jantar").alias("segment_id")
    )
    context = creative.customer_context(asked, t.customers)
    requests = bandit.pin_segments(_requests(t), pinned)
    chosen = bandit.decide(requests, _arm_stats(t))
    return bandit.decision_rows(context, chosen, _catalog(t))


@query
def ab_assignment(spark, sf_dir):
    units = table(spark, sf_dir, "customer").select(
        numbered("usr_", "c_custkey", 6).alias("customer_id")
    )
    return bandit.ab_assignment(units, "customer_id", {"control": 0.5, "bandit": 0.3, "holdout": 0.2})


# ---- governance ---------------------------------------------------------------


@query
def pseudonymized_features(spark, sf_dir):
    return governance.pseudonymize(layers(spark, sf_dir).customers, "customer_id", "adlift:")


@query
def masked_orders(spark, sf_dir):
    orders = layers(spark, sf_dir).line_orders.drop("timestamp")
    policy = {"customer_id": "prefix:4", "order_amount": "null", "cuisine": "constant:hidden"}
    return governance.mask_columns(orders, policy)


@query
def row_filtered_silver(spark, sf_dir):
    """A regional manager sees the orders of the merchants in the region."""
    silver = _line_silver(layers(spark, sf_dir))
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    grants = table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("r_name").alias("principal"), numbered("merch_", "s_suppkey", 4).alias("merchant_id")
    )
    return governance.filter_rows(silver, grants, "EUROPE", ["merchant_id"])


# ---- files --------------------------------------------------------------------


def _orders_csv(spark: SparkSession, sf_dir: str) -> tuple[SparkSession, str, StructType]:
    """The order log as time-ordered CSV files, with the layout to read them by."""
    path, orders = fresh_dir(spark, "orders-csv"), layers(spark, sf_dir).logs.orders
    layout = StructType([f for f in S.ORDERS if f.name in orders.columns])
    sinks.export_csv(orders.select(layout.fieldNames()), path)
    return spark, path, layout


@query
def csv_orders(spark, sf_dir):
    return bronze.read_csv(*_orders_csv(spark, sf_dir))


@query
def csv_relation(spark, sf_dir):
    """The CSV files as a relation of SQL text."""
    _, path, layout = _orders_csv(spark, sf_dir)
    bronze.register_csv(spark, path, "orders_csv", layout)
    return spark.sql(
        """SELECT cuisine, count(*) AS orders, count(DISTINCT customer_id) AS customers, sum(used_coupon) AS coupons,
                  max(order_amount) AS largest FROM orders_csv GROUP BY cuisine"""
    )


@query
def csv_time_order(spark, sf_dir):
    """The exported rows and how many files begin before an earlier one ends."""
    rows = bronze.read_csv(*_orders_csv(spark, sf_dir))
    files = rows.groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("low"), F.max("timestamp").alias("high")
    )
    # A row per file.
    before = F.max("high").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("before", before).agg(
        F.sum("n").alias("row_count"),
        F.min("low").alias("first_time"),
        F.max("high").alias("last_time"),
        F.count(F.when(F.col("low") < F.col("before"), 1)).alias("overlapping_files"),
    )


@query
def evolving_clicks(spark, sf_dir):
    """A click log whose newer files have a column more and one less than the older ones."""
    clicks, path = layers(spark, sf_dir).logs.clicks, fresh_dir(spark, "evolving-clicks")
    newer = F.substring("click_id", -1, 1).cast("int") % 2 == 1
    sinks.append_bronze(clicks.where(~newer), path)
    version = F.concat(F.lit("2."), F.substring("click_id", -1, 1)).alias("app_version")
    sinks.append_bronze(clicks.where(newer).drop("ad_placement").select("*", version), path)
    return bronze.read_log(spark, path, "clicks").select(*S.CLICKS.fieldNames(), "app_version")


# ---- streams ------------------------------------------------------------------


# Rows of one delivered file; a micro-batch takes two of three time slices, however many files those are.
FILE_ROWS = 500_000
SLICES = 3


def _delivered(spark: SparkSession, df: DataFrame, name: str, schema=None) -> DataFrame:
    """A stream of ``df`` as files cut by time, each row delivered twice."""
    return _delivered_to(spark, df, name, schema)[1]


def _delivered_to(spark: SparkSession, df: DataFrame, name: str, schema=None) -> tuple[str, DataFrame]:
    path = fresh_dir(spark, name)
    files = max(1, -(-df.count() // (SLICES * FILE_ROWS)))
    for _ in range(2):
        df.repartitionByRange(SLICES * files, "timestamp").write.mode("append").parquet(path)
    return path, read_stream(spark, path, schema or df.schema, files_per_batch=2 * files)


def _touched(*logs: tuple[DataFrame, str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [touches(df, kind) for df, kind in logs])


def _touch_stream(spark: SparkSession, *logs: tuple[DataFrame, str]) -> DataFrame:
    return _delivered(spark, _touched(*logs), "touches", TOUCH)


@query
def stream_bronze_ingest(spark, sf_dir):
    shown = layers(spark, sf_dir).logs.impressions
    stream = _delivered(spark, shown, "impressions")
    target = fresh_dir(spark, "bronze")
    append_stream(drop_replays(stream, ["impression_id"]), target, f"{target}-checkpoint")
    return spark.read.parquet(target).drop("batch")


@query
def stream_dedup_orders(spark, sf_dir):
    orders = layers(spark, sf_dir).logs.orders
    stream = _delivered(spark, orders, "orders")
    target = fresh_dir(spark, "orders-once")
    append_stream(drop_replays(stream, ["order_id"]), target, f"{target}-checkpoint")
    return spark.read.parquet(target).drop("batch")


def _stream_silver(spark: SparkSession, sf_dir: str, rule: str) -> DataFrame:
    t = layers(spark, sf_dir)
    ads = (t.logs.clicks, "click") if rule == "click" else (t.logs.impressions, "impression")
    job = SilverStream(fresh_dir(spark, f"silver-{rule}"), rule)
    job.run(_touch_stream(spark, (t.logs.orders, "order"), ads))
    job.merge(spark)
    return job.silver(spark)


@query
def stream_attribution(spark, sf_dir):
    return _stream_silver(spark, sf_dir, "click")


@query
def stream_click_matches(spark, sf_dir):
    """Orders with their last click from the join of the two streams; a heartbeat far ahead settles the last ones."""
    t = layers(spark, sf_dir)
    logs = [(t.logs.orders, "order"), (t.logs.clicks, "click")]
    end = reduce(F.greatest, [F.lit(df.agg(F.max("timestamp")).first()[0]) for df, _ in logs])
    path, stream = _delivered_to(spark, _touched(*logs), "touches", TOUCH)
    ahead = {"kind": F.lit(HEARTBEAT), "timestamp": end + F.expr(f"INTERVAL {S.WATERMARK} 1 second")}
    beat = spark.range(1).select(*[ahead.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TOUCH])
    beat.coalesce(1).write.mode("append").parquet(path)
    target = fresh_dir(spark, "settled")
    run_interval_join(stream, target, f"{target}-checkpoint")
    settled = spark.read.schema(SETTLED).parquet(target).where("click_id IS NOT NULL")
    hours = hours_between(F.col("order_timestamp"), F.col("click_timestamp"))
    return settled.select("order_id", "click_id", hours.alias("hours_from_click_to_order"))


@query
def stream_view_through(spark, sf_dir):
    return _stream_silver(spark, sf_dir, "view")


LATE_SLICE_DAYS = 90


def _exact_files(df: DataFrame, path: str, files: int) -> None:
    """Add the rows as exactly so many files, the last ones without rows if need be: a batch is a number of files."""

    def there() -> int:
        fs, folder = file_system(df.sparkSession, path)
        listed = fs.listStatus(folder(path)) if fs.exists(folder(path)) else []
        return sum(f.getPath().getName().startswith("part-") for f in listed)

    wanted = there() + files
    df.repartition(files).write.mode("append").parquet(path)
    for _ in range(wanted - there()):
        df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(path)


@query
def stream_late_orders(spark, sf_dir):
    """Orders delivered newest first, in slices of 90 days: every one is kept or listed as late, and once.

    The engine judges a batch by the watermark that the batch before it had,
    so the second slice is still kept.
    """
    orders = A.dedup_latest(layers(spark, sf_dir).line_orders, ["order_id"], ["timestamp", "order_amount", "merchant_id"])
    newest = orders.agg(F.max("timestamp")).first()[0]
    behind = F.floor(F.datediff(F.lit(newest), "timestamp") / LATE_SLICE_DAYS)
    path = fresh_dir(spark, "late-first")
    sizes = orders.groupBy(F.least(behind, F.lit(SLICES - 1)).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    files = max(1, -(-max((r.n for r in sizes.collect()), default=0) // FILE_ROWS))
    for k in range(SLICES):
        _exact_files(orders.where(behind == k if k < SLICES - 1 else behind >= k), path, files)
    job = CountedIngest(fresh_dir(spark, "counted"), ("order_id",))
    job.run(read_stream(spark, path, orders.schema, files_per_batch=files))
    kept = job.kept(spark, orders.schema).withColumn("late", F.lit(False))
    found = kept.unionByName(job.late(spark, orders.schema).withColumn("late", F.lit(True)))
    return found.groupBy("order_id").agg(F.count(F.lit(1)).alias("times"), F.max("late").alias("late"))


@query
def creative_weights(spark, sf_dir):
    """The catalog's arm weights after three batches of feedback, of which some arrive twice, and a merge."""
    t = layers(spark, sf_dir)
    catalog = _catalog(t)
    shown = bandit.decide(_requests(t), bandit.arm_stats(catalog), epsilon=1.0, seed="log")
    labels = _clicked(t, dedup=True, keep=["timestamp"]).select(
        F.col("impression_id").alias("request_id"), "timestamp", F.col("has_clicked").cast("int").alias("clicked")
    )
    served = shown.join(labels, "request_id").select(*SERVED.names)
    job = ArmStream(fresh_dir(spark, "arms"))
    job.run(_delivered(spark, served, "served", SERVED))
    job.merge(spark)
    weighted = bandit.weighted_arms(catalog, job.totals(spark))
    return weighted.select("creative_id", "segment_id", "shown", "clicked", "mab_arm_weight")
