"""Arm statistics and weights that follow feedback, batch by batch and exactly once.

Every micro-batch of served ads becomes one small table of sums per creative,
kept under the batch's number; the manifest names which batches count. A batch
that is run again takes the place of its first try, or is left out where a
merge has folded it in already. Totals are the sum of a base and the open
deltas, so nothing is ever added twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlift.sources.versions import Versions, read_entries
from adlift.streaming.ingest import drop_replays

SERVED = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("creative_id", T.StringType()),
        T.StructField("clicked", T.IntegerType()),
    ]
)
SUMS = T.StructType(
    [
        T.StructField("creative_id", T.StringType()),
        T.StructField("shown", T.LongType()),
        T.StructField("clicked", T.LongType()),
    ]
)


@dataclass(frozen=True)
class ArmStream:
    """Sums of shown and clicked ads per creative, kept up to date from a stream of served ads."""

    root: str

    @property
    def sums(self) -> str:
        return f"{self.root}/sums"

    def run(self, stream: DataFrame) -> None:
        """Take in everything that has arrived, each request once, then stop."""
        spark = stream.sparkSession
        query = (
            drop_replays(stream, ["request_id"])
            .writeStream.foreachBatch(lambda batch, number: self.process(spark, batch, number))
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def process(self, spark: SparkSession, batch: DataFrame, number: int) -> None:
        table = Versions(spark, self.sums)
        version, entries = table.entries()
        if any(e["base"] and e["number"] >= number for e in entries):
            return
        part = batch.groupBy("creative_id").agg(
            F.count(F.lit(1)).alias("shown"), F.coalesce(F.sum("clicked"), F.lit(0)).cast("long").alias("clicked")
        )
        folder = table.new_folder()
        part.write.parquet(folder)
        others = [e for e in entries if e["base"] or e["number"] != number]
        table.commit(version, [*others, {"path": folder, "number": number, "base": False}])

    def totals(self, spark: SparkSession) -> DataFrame:
        """(creative_id, shown, clicked) over all batches."""
        return self._added(spark, Versions(spark, self.sums).entries()[1])

    @staticmethod
    def _added(spark: SparkSession, entries: list[dict]) -> DataFrame:
        parts = read_entries(spark, entries, SUMS).groupBy("creative_id")
        return parts.agg(F.sum("shown").alias("shown"), F.sum("clicked").alias("clicked"))

    def merge(self, spark: SparkSession) -> None:
        """Fold all open deltas but the newest, which may be run again, into the base."""
        table = Versions(spark, self.sums)
        version, entries = table.entries()
        newest = max((e["number"] for e in entries), default=0)
        closed = [e for e in entries if e["base"] or e["number"] < newest]
        if sum(not e["base"] for e in closed) == 0:
            return
        folder = table.new_folder()
        self._added(spark, closed).write.parquet(folder)
        base = {"path": folder, "number": max(e["number"] for e in closed), "base": True}
        table.commit(version, [base, *[e for e in entries if e not in closed]])
