"""Gold kept up batch by batch: only the keys a batch touches are folded again.

Facts lie in hash buckets of their key: the newest state of each order under
its customer and again under its merchant, the distinct impressions and the
clicks on them under the customer. A batch adds its facts as a folder of its
own; the keys in it are the touched ones. Their facts are read from their
buckets (partition filters), the same folds as a full build run over them, and
their rows, with the untouched rows of those buckets, become new bucket folders
of the gold table. All other buckets of gold and of the orders stay in place
and are not opened; to match clicks and impressions that come in different
batches, the ids of all earlier ones are read. One
version names the folders of facts and of both gold tables and is written last:
a batch that dies leaves the tables as they were, one that is delivered again
is known by its number and changes nothing.

An order that comes again in a later batch (attributed anew after a late click)
replaces its earlier rows; it must keep its customer and merchant. Orders
without an id are never versions of each other. A click counts for the
customers its impression was shown to, whichever comes first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlift.operators.gold import gold_customer_features, gold_merchant_features
from adlift.sources.versions import Versions, file_system

_ORDER = (
    "customer_id string, merchant_id string, order_id string, order_amount double, used_coupon int, "
    "cuisine string, attribution_status string, batch long"
)
_FACTS = {
    "customer_orders": ("customer_id", _ORDER),
    "merchant_orders": ("merchant_id", _ORDER),
    "ads": ("customer_id", "customer_id string, impression_id string, click_id string"),
    "clicks": ("impression_id", "impression_id string, click_id string"),
}
_KEYS = {"customers": "customer_id", "merchants": "merchant_id"}
#: More buckets leave more of a large table untouched; each is a folder of gold and of every batch.
BUCKETS = 64



class IncrementalGold:
    """Both gold tables below ``root``, after every batch equal to a full build over all batches."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root, buckets
        self.table = Versions(spark, root)

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.hash(key), F.lit(self.buckets)).alias("bucket")

    def _write(self, df: DataFrame, kind: str, key: str, batch: int | str) -> list[dict]:
        """Bucket folders of ``df`` as entries of a version."""
        part = self.table.new_folder().rsplit("-", 1)[1]
        folder = f"{self.root}/{kind}/part={batch}-{part}"
        dealt = df.withColumn("bucket", self._bucket(key)).hint("rebalance", "bucket")
        dealt.write.partitionBy("bucket").parquet(folder)
        fs, path = file_system(self.spark, folder)
        names = [f.getPath().getName() for f in fs.listStatus(path(folder))]
        return [
            {"kind": kind, "path": f"{folder}/{name}", "bucket": int(name.removeprefix("bucket="))}
            for name in sorted(names)
            if name.startswith("bucket=")
        ]

    def _read(self, entries: list[dict], kind: str, ddl: str, buckets: set[int] | None = None) -> DataFrame:
        """The folders of a kind, or those of some buckets only."""
        paths = [e["path"] for e in entries if e["kind"] == kind and (buckets is None or e["bucket"] in buckets)]
        return self.spark.read.schema(ddl).parquet(*paths) if paths else self.spark.createDataFrame([], ddl)

    def _facts(self, entries: list[dict], kind: str, buckets: set[int] | None = None) -> DataFrame:
        return self._read(entries, kind, _FACTS[kind][1], buckets)

    def add(
        self, batch: int, silver: DataFrame, impressions: DataFrame, clicks: DataFrame, as_of: Column | None = None
    ) -> bool:
        """Take in one batch and publish the next version; False where the batch is known already."""
        version, old = self.table.entries()
        if any(e["kind"] == "batch" and e["batch"] == batch for e in old):
            return False
        orders = silver.withColumn("batch", F.lit(batch).cast("long")).select(
            *[F.col(c).cast(t).alias(c) for c, t in (part.split() for part in _ORDER.split(", "))]
        )
        new = self._write(orders, "customer_orders", "customer_id", batch)
        new += self._write(orders, "merchant_orders", "merchant_id", batch)
        hits = clicks.where("click_id IS NOT NULL AND impression_id IS NOT NULL")
        new += self._write(hits.select("impression_id", "click_id").distinct(), "clicks", "impression_id", batch)
        shown = impressions.select("customer_id", "impression_id", F.lit(None).cast("string").alias("click_id"))
        new += self._write(shown.distinct(), "ads", "customer_id", batch)
        new += self._write(self._matches(old, new), "ads", "customer_id", batch)
        facts = [e for e in old if e["kind"] in _FACTS] + new
        gold = self._refolded("customers", facts, new, old, as_of) + self._refolded("merchants", facts, new, old, as_of)
        batches = [e for e in old if e["kind"] == "batch"] + [{"kind": "batch", "batch": batch}]
        self.table.commit(version, batches + facts + gold)
        return True

    def _matches(self, old: list[dict], new: list[dict]) -> DataFrame:
        """Clicks on known impressions that the batch completes, as facts of the customer."""
        is_view = F.col("click_id").isNull()
        views = [self._facts(e, "ads").where(is_view).drop("click_id") for e in (old, new)]
        hits = [self._facts(e, "clicks") for e in (old, new)]
        # Ids of events: no side goes through the driver, however small its files are.
        met = hits[1].join(views[0].unionByName(views[1]).hint("merge"), "impression_id").unionByName(
            hits[0].join(views[1].hint("merge"), "impression_id")
        )
        return met.select("customer_id", "impression_id", "click_id").distinct()

    def _refolded(
        self, name: str, facts: list[dict], new: list[dict], old: list[dict], as_of: Column | None
    ) -> list[dict]:
        """The gold entries: new folders for buckets with touched keys, the old ones of all others."""
        key = _KEYS[name]
        kinds = [k for k, (of, _) in _FACTS.items() if of == key]
        kept = [e for e in old if e["kind"] == name]
        buckets = {e["bucket"] for e in new if e["kind"] in kinds}
        if not buckets:
            return kept
        touched = reduce(DataFrame.unionByName, [self._facts(new, k).select(F.col(key).alias("_touched")) for k in kinds])
        # Customers grow with the logs and are no hot keys: their list stays on the executors.
        touched = touched.distinct().hint("merge") if name == "customers" else touched.distinct()

        def of_touched(df: DataFrame, how: str = "left_semi") -> DataFrame:
            return df.join(touched, F.col(key).eqNullSafe(F.col("_touched")), how)

        orders = _newest(of_touched(self._facts(facts, kinds[0], buckets)), key)
        if name == "customers":
            ads = of_touched(self._facts(facts, "ads", buckets))
            views = ads.where(F.col("click_id").isNull())
            hits = ads.where(F.col("click_id").isNotNull()).select("impression_id", "click_id")
            rows = gold_customer_features(orders, views, hits, as_of)
        else:
            rows = gold_merchant_features(orders, as_of)
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        others = of_touched(self._read(kept, name, ddl, buckets), "left_anti")
        written = self._write(rows.unionByName(others), name, key, "gold")
        return [e for e in kept if e["bucket"] not in buckets] + [e | {"schema": ddl} for e in written]

    def _published(self, name: str) -> DataFrame:
        version, entries = self.table.entries()
        found = [e for e in entries if e["kind"] == name]
        if not found:
            raise FileNotFoundError(f"{self.root} has no rows of {name}")
        return self._read(found, name, found[0]["schema"])

    def customers(self) -> DataFrame:
        return self._published("customers")

    def merchants(self) -> DataFrame:
        return self._published("merchants")

    def merge(self) -> None:
        """Bring the facts of all batches together in one folder per kind and bucket; gold stays as it is."""
        version, entries = self.table.entries()
        rest = [e for e in entries if e["kind"] not in _FACTS]
        for kind, (key, _) in _FACTS.items():
            facts = self._facts(entries, kind)
            facts = _newest(facts, key) if "orders" in kind else facts.distinct()
            rest += self._write(facts, kind, key, "merged")
        self.table.commit(version, rest)


def _newest(orders: DataFrame, key: str) -> DataFrame:
    """The rows of each order from the last batch that has it."""
    last = F.max("batch").over(Window.partitionBy(key, "order_id"))
    named = orders.where(F.col("order_id").isNotNull()).withColumn("_last", last)
    return named.where(F.col("batch") == F.col("_last")).drop("_last").unionByName(
        orders.where(F.col("order_id").isNull())
    )
