"""The layers end to end: bronze logs, silver attribution, gold features, creatives."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from adlift.operators.attribution import attribution_asof, attribution_global_last, dedup_latest
from adlift.operators.creative import creative_catalog, customer_segments, generate, segment_profile
from adlift.operators.gold import gold_customer_features, gold_merchant_features
from adlift.operators.skew import KeySummary
from adlift.schemas import CLICK_WINDOW_DAYS, EVENT_DATE
from adlift.session import fresh_dir, side_by_side
from adlift.sources.bronze import read_log
from adlift.sources.driver_tables import AdLogs, ad_logs, line_orders
from adlift.sources.sinks import by_date, write_log, write_table
from adlift.sources.versions import publish, read_published


@dataclass(frozen=True)
class Paths:
    """Where the layers live; one root reachable by every executor."""

    root: str

    def bronze(self, log: str) -> str:
        return f"{self.root}/bronze/{log}"

    def clean(self, log: str) -> str:
        return f"{self.root}/clean/{log}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/ad_attribution"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"


def _log(spark: SparkSession, paths: Paths, log: str) -> DataFrame:
    return read_log(spark, paths.bronze(log), log).drop(EVENT_DATE)


def _once(raw: DataFrame, log: str) -> DataFrame:
    """A log with replayed rows removed."""
    key, newest = {
        "impressions": ("impression_id", ["timestamp"]),
        "clicks": ("click_id", ["timestamp"]),
        "orders": ("order_id", ["timestamp", "order_amount", "merchant_id"]),
    }[log]
    return dedup_latest(raw, [key], newest)


def build_clean(spark: SparkSession, paths: Paths) -> None:
    """Write every log without its replays, once; the stages after it read that."""
    side_by_side(
        *[
            partial(write_table, _once(_log(spark, paths, log), log), paths.clean(log))
            for log in ("impressions", "clicks", "orders")
        ]
    )


def _clean(spark: SparkSession, paths: Paths, log: str) -> DataFrame:
    return spark.read.parquet(paths.clean(log))


def build_silver(
    spark: SparkSession, paths: Paths, mode: str = "asof", window_days: float = CLICK_WINDOW_DAYS
) -> DataFrame:
    """Write the logs without replays, attribute the orders and write silver; returns the written table.

    ``mode`` is ``asof`` or ``global_last``.
    """
    if mode not in ("asof", "global_last"):
        raise ValueError(f"unknown attribution mode: {mode}")
    build_clean(spark, paths)
    clicks, orders = _clean(spark, paths, "clicks"), _clean(spark, paths, "orders")
    attribute = attribution_asof if mode == "asof" else attribution_global_last
    silver = attribute(orders, clicks, window_days)
    publish(by_date(silver, "order_timestamp", "order_date"), paths.silver, ["order_date"])
    return read_published(spark, paths.silver)


def build_gold(spark: SparkSession, paths: Paths) -> tuple[DataFrame, DataFrame]:
    """Publish the next version of both feature tables, from silver and the ad logs."""
    impressions, clicks = _clean(spark, paths, "impressions"), _clean(spark, paths, "clicks")
    silver = read_published(spark, paths.silver)
    side_by_side(
        partial(publish, gold_customer_features(silver, impressions, clicks), paths.gold("customer_features")),
        partial(publish, gold_merchant_features(silver), paths.gold("merchant_features")),
    )
    return (
        read_published(spark, paths.gold("customer_features")),
        read_published(spark, paths.gold("merchant_features")),
    )


def build_creatives(spark: SparkSession, paths: Paths, min_customers: int = 1) -> DataFrame:
    """Segment the gold customers and publish the approved copies per segment."""
    customers = read_published(spark, paths.gold("customer_features"))
    orders = _clean(spark, paths, "orders")
    segments = segment_profile(customer_segments(customers, orders), min_customers)
    publish(creative_catalog(generate(segments)), paths.gold("creative_catalog"))
    return read_published(spark, paths.gold("creative_catalog"))


class Layers:
    """The written layers of one folder of star-schema tables, each built on first use.

    Later stages read the files of earlier ones, as separate jobs would.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.paths = Paths(fresh_dir(spark, "layers"))
        self.summaries: dict[tuple[str, str], KeySummary] = {}
        self.lasts: dict[str, datetime | None] = {}
        self._published: dict[str, DataFrame] = {}

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        write_table(df, path)
        return self.spark.read.parquet(path)

    def _log(self, df: DataFrame, log: str) -> DataFrame:
        """A raw log as date folders, its customers, merchants and last time learned while it is written."""
        found = write_log(df, self.paths.bronze(log), ["customer_id"], ["merchant_id"])
        self.summaries |= {(log, *s.keys): s for s in found.summaries}
        self.lasts[log] = found.last
        return self.spark.read.parquet(self.paths.bronze(log))

    def key_summaries(self, *logs: str) -> dict[str, list[KeySummary]]:
        """By key, the summaries of the logs named, once for each time a log is named."""
        assert self.logs
        return {key: [self.summaries[log, key] for log in logs] for key in ("customer_id", "merchant_id")}

    def published(
        self, name: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """The gold table ``name``, built and written on first use."""
        if name not in self._published:
            publish(build(), self.paths.gold(name), partition_by)
            self._published[name] = read_published(self.spark, self.paths.gold(name))
        return self._published[name]

    @cached_property
    def dated_logs(self) -> AdLogs:
        """The raw logs with the column of their date folders."""
        raw = ad_logs(self.spark, self.sf_dir)
        return AdLogs(
            *side_by_side(
                partial(self._log, raw.impressions, "impressions"),
                partial(self._log, raw.clicks, "clicks"),
                partial(self._log, raw.orders, "orders"),
            )
        )

    @cached_property
    def logs(self) -> AdLogs:
        t = self.dated_logs
        return AdLogs(t.impressions.drop(EVENT_DATE), t.clicks.drop(EVENT_DATE), t.orders.drop(EVENT_DATE))

    def clean(self, log: str) -> DataFrame:
        """A log without its replays, as silver was built from it."""
        assert self.silver
        return _clean(self.spark, self.paths, log)

    @property
    def end(self) -> datetime:
        """The start of the day after the logs end; nothing is read for it."""
        assert self.dated_logs
        last = max((e for e in self.lasts.values() if e is not None), default=datetime(1970, 1, 1))
        return datetime(last.year, last.month, last.day) + timedelta(days=1)

    @cached_property
    def line_orders(self) -> DataFrame:
        return self._written(line_orders(self.spark, self.sf_dir), self.paths.bronze("line_orders"))

    @cached_property
    def silver(self) -> DataFrame:
        assert self.logs
        return build_silver(self.spark, self.paths).drop("order_date")

    @cached_property
    def gold(self) -> tuple[DataFrame, DataFrame]:
        assert self.silver
        return build_gold(self.spark, self.paths)

    @property
    def customers(self) -> DataFrame:
        return self.gold[0].drop("last_feature_update")

    @property
    def merchants(self) -> DataFrame:
        return self.gold[1].drop("last_feature_update")


_LAYERS: dict[tuple[str, str], Layers] = {}


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    """The layers of a folder, shared by the queries of one application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYERS:
        _LAYERS[key] = Layers(spark, sf_dir)
    return _LAYERS[key]
