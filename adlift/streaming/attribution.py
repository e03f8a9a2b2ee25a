"""Silver kept up to date from micro-batches, with late clicks re-attributing old orders.

Every micro-batch is first written to a touch log under its own number. Then
only the customer-merchant pairs it touches are attributed again, over the
stretch of time their new rows can reach, and the result is written as one
more version of those orders. Log and silver are tables with a manifest: a
folder counts once the manifest names it, and takes the place of the folder of
the same batch number. So a batch that is run again after a failure leaves the
same tables, and nothing is ever read and overwritten in the same place.

Silver is a base, cut into spans of order time, and the deltas since. A merge
folds the deltas into the spans they touch, all other spans stay as they are;
the log's closed batches, which no new event can reach, become one folder.
Readers follow the manifest only: before, during and after a merge, and after
one that dies, they see the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlift import schemas as S
from adlift.operators.attribution import (
    PAIR,
    attribution_asof,
    attribution_view_through,
    dedup_latest,
)
from adlift.sources.versions import Versions, read_entries
from adlift.streaming.ingest import drop_replays

TOUCH = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("impression_id", T.StringType()),
        T.StructField("ad_placement", T.StringType()),
        T.StructField("order_amount", T.DoubleType()),
        T.StructField("used_coupon", T.IntegerType()),
        T.StructField("cuisine", T.StringType()),
    ]
)

#: Days of order time in one span of the base.
SPAN_DAYS = 30

_IDS = {"impression": "impression_id", "click": "click_id", "order": "order_id"}


def touches(df: DataFrame, kind: str) -> DataFrame:
    """A raw log in the common layout of the touch log."""
    renamed = df.withColumn("event_id", F.col(_IDS[kind])).withColumn("kind", F.lit(kind))
    return renamed.select(
        *[
            (F.col(f.name) if f.name in renamed.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TOUCH
        ]
    )


@dataclass(frozen=True)
class SilverStream:
    """One running attribution: ``rule`` is ``click`` (days) or ``view`` (24 hours)."""

    root: str
    rule: str = "click"
    window_days: float = S.CLICK_WINDOW_DAYS
    window_hours: float = S.VIEW_WINDOW_HOURS

    @property
    def log(self) -> str:
        return f"{self.root}/touches"

    @property
    def versions(self) -> str:
        return f"{self.root}/silver_versions"

    @property
    def _reach(self) -> float:
        """Seconds an ad event reaches forward."""
        return self.window_days * 86_400 if self.rule == "click" else self.window_hours * 3_600

    def run(self, stream: DataFrame) -> None:
        """Process all touches that have arrived, then stop."""
        # A stream plans its batches in a session without adaptive execution;
        # the attribution itself runs in the caller's.
        spark = stream.sparkSession
        query = (
            drop_replays(stream, ["kind", "event_id"])
            .writeStream.foreachBatch(lambda batch, number: self.process(spark, batch, number))
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def process(self, spark: SparkSession, batch: DataFrame, number: int) -> None:
        new = self._append(spark, self.log, batch, number, "timestamp")
        if new is None:
            return
        lo, hi, new = new
        pairs = (
            new.groupBy(*PAIR)
            .agg(F.min("timestamp").alias("_lo"), F.max("timestamp").alias("_hi"))
            .withColumnsRenamed({c: f"_{c}" for c in PAIR})
        )
        touched = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PAIR])
        reach = F.make_dt_interval(secs=F.lit(self._reach))
        near = timedelta(seconds=self._reach)
        history = (
            self.history(spark, number, lo - near, hi + near)
            .join(pairs, touched)
            .where(F.col("timestamp").between(F.col("_lo") - reach, F.col("_hi") + reach))
        )
        orders = history.where((F.col("kind") == "order") & (F.col("timestamp") >= F.col("_lo")))
        redone = self.attribute(orders, history).withColumn("version", F.lit(number))
        self._append(spark, self.versions, redone, number, "order_timestamp")

    @staticmethod
    def _append(spark: SparkSession, root: str, df: DataFrame, number: int, ts: str):
        """Write a batch's rows and name them in the manifest: (earliest, latest, rows), None if there are none.

        A number that a merge has folded in already is in the table: its rows are not written again.
        """
        table = Versions(spark, root)
        version, entries = table.entries()
        folder = table.new_folder()
        df.write.parquet(folder)
        rows = spark.read.schema(df.schema).parquet(folder)
        span = rows.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
        if span["lo"] is None:
            return None
        if not any(e["base"] and e["number"] >= number for e in entries):
            entry = {"path": folder, "number": number, "base": False, "lo": span["lo"].isoformat(), "hi": span["hi"].isoformat()}
            table.commit(version, [e for e in entries if e["base"] or e["number"] != number] + [entry])
        return span["lo"], span["hi"], rows

    def attribute(self, orders: DataFrame, history: DataFrame) -> DataFrame:
        orders = orders.withColumnRenamed("event_id", "order_id")
        if self.rule == "click":
            clicks = history.where(F.col("kind") == "click").withColumnRenamed("event_id", "click_id")
            return attribution_asof(orders, clicks, self.window_days)
        views = history.where(F.col("kind") == "impression")
        return attribution_view_through(orders, views, self.window_hours)

    def history(
        self, spark: SparkSession, upto: int, lo: datetime | None = None, hi: datetime | None = None
    ) -> DataFrame:
        """The touch log up to a batch, and between two times; folders outside them are not even listed."""
        _, entries = Versions(spark, self.log).entries()
        if lo is not None:
            entries = [e for e in entries if e["lo"] <= hi.isoformat() and e["hi"] >= lo.isoformat()]
        rows = read_entries(spark, [e for e in entries if e["number"] <= upto or e["base"]], TOUCH)
        return rows if lo is None else rows.where(F.col("timestamp").between(lo, hi))

    def silver(self, spark: SparkSession) -> DataFrame:
        """The current silver table: the latest version of every order, from the base and the open deltas.

        Orders without an id are known by their place: all that a pair has at
        one instant are attributed again together, so their newest version
        holds every one of them.
        """
        _, entries = Versions(spark, self.versions).entries()
        if not entries:
            raise FileNotFoundError(f"{self.versions}: no batch has been processed")
        return self._newest(spark.read.parquet(*[e["path"] for e in entries])).drop("version")

    @staticmethod
    def _newest(versions: DataFrame) -> DataFrame:
        known = dedup_latest(versions.where(F.col("order_id").isNotNull()), ["order_id"], ["version"])
        place = [*PAIR, "order_timestamp"]
        keyless = versions.where(F.col("order_id").isNull())
        newest = keyless.groupBy(*place).agg(F.max("version").alias("_version"))
        newest = newest.withColumnsRenamed({c: f"_{c}" for c in place})
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in place])
        keyless = keyless.join(newest, same & (F.col("version") == F.col("_version")), "left_semi")
        return known.unionByName(keyless)

    def merge(self, spark: SparkSession) -> None:
        """Fold the deltas of silver into the spans of the base that they touch."""
        table = Versions(spark, self.versions)
        version, entries = table.entries()
        deltas = [e for e in entries if not e["base"]]
        if not deltas:
            return
        span = F.floor(F.unix_seconds("order_timestamp") / (86_400 * SPAN_DAYS)).cast("int")
        changed = spark.read.parquet(*[e["path"] for e in deltas])
        # One number per month of order time that the deltas hold.
        touched = {r.span for r in changed.select(span.alias("span")).distinct().collect()}
        old = [e for e in entries if e["base"] and e["span"] in touched]
        rows = spark.read.parquet(*[e["path"] for e in deltas + old])
        folder = table.new_folder()
        merged = self._newest(rows).withColumn("span", span).hint("rebalance", "span")
        merged.write.partitionBy("span").parquet(folder)
        number = max(e["number"] for e in entries)
        kept = [e for e in entries if e["base"] and e["span"] not in touched]
        new = [{"path": f"{folder}/span={k}", "number": number, "base": True, "span": k} for k in sorted(touched)]
        table.commit(version, kept + new)

    def merge_log(self, spark: SparkSession, closed_before: datetime) -> None:
        """Make one folder of all batches of the touch log that end before a time which no new event can reach."""
        table = Versions(spark, self.log)
        version, entries = table.entries()
        closed = [e for e in entries if not e["base"] and e["hi"] < closed_before.isoformat()]
        # A batch that could be run again must stay replaceable.
        closed = [e for e in closed if e["number"] < max(x["number"] for x in entries)]
        if len(closed) < 2:
            return
        folder = table.new_folder()
        read_entries(spark, closed, TOUCH).hint("rebalance").write.parquet(folder)
        merged = {"path": folder, "number": max(e["number"] for e in closed), "base": True}
        merged |= {"lo": min(e["lo"] for e in closed), "hi": max(e["hi"] for e in closed)}
        table.commit(version, [merged, *[e for e in entries if e not in closed]])


def matched_clicks(silver: DataFrame) -> DataFrame:
    """The (order, click) matches of a silver table."""
    return silver.where(F.col("attributed_click_id").isNotNull()).select(
        "order_id", F.col("attributed_click_id").alias("click_id"), "hours_from_click_to_order"
    )
