"""Hourly micro-batches: read new files, drop replays, append, stop when drained."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlift import schemas as S
from adlift.operators.attribution import dedup_latest
from adlift.session import ship_package, use_disk_state


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _first_per_key(keys: Sequence[str]):
    """Arrow batches with one row per key and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch]).select(list(keys))
            rows = rows.append_column("_row", pa.array(np.arange(batch.num_rows)))
            firsts = rows.group_by(list(keys)).aggregate([("_row", "min")])["_row_min"]
            yield batch.take(firsts.combine_chunks())

    return run


def drop_replays(
    stream: DataFrame, keys: Sequence[str], ts: str = "timestamp", thin: bool = False
) -> DataFrame:
    """One row per key within the watermark; later rows than that are dropped as too late.

    Rows without a key are never copies of each other: they pass as they are,
    and neither wait in the state nor move the watermark.

    The stateful operator shuffles every row by key. Where an event may be
    delivered very many times, ``thin`` leaves one row per key and Arrow batch
    before that, so that its copies are not sent to one task.
    """
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    keyed, keyless = stream.where(known), stream.where(~known)
    if thin:
        ship_package(stream.sparkSession)
        keyed = keyed.mapInArrow(_first_per_key(keys), stream.schema)
    use_disk_state(stream.sparkSession)
    once = keyed.withWatermark(ts, S.WATERMARK).dropDuplicatesWithinWatermark(list(keys))
    return once.unionByName(keyless)


def write_batch(batch: DataFrame, table: str, number: int) -> str:
    """Write a micro-batch as folder ``number`` of ``table``, replacing an earlier try.

    The files follow the partitions of the deduplication. There are no date
    folders, which would multiply the files: a batch covers a short time, so
    the time range in each file's footer is enough to skip it.
    """
    path = f"{table}/batch={number}"
    batch.write.mode("overwrite").parquet(path)
    return path


def append_stream(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append everything that has arrived to ``target``, one folder per batch, then stop."""

    def append(batch: DataFrame, number: int) -> None:
        write_batch(batch, target, number)

    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


@dataclass(frozen=True)
class CountedIngest:
    """Ingestion that accounts for every delivered row: kept, a replay of a kept row, or late.

    ``root`` holds what was delivered and what was kept of it, one folder per
    batch, and the late rows: those whose key was not kept, as they came behind
    the watermark. A late key is listed once. A batch that is run again
    replaces its folders.
    """

    root: str
    keys: tuple[str, ...]
    ts: str = "timestamp"
    delay: str = S.WATERMARK

    def run(self, stream: DataFrame) -> None:
        """Ingest everything that has arrived, then stop."""
        spark, schema = stream.sparkSession, stream.schema
        kept = drop_replays(stream, self.keys, self.ts).withColumn("_kept", F.lit(True))
        # Both branches read the same batch of the same source.
        both = kept.unionByName(stream.withColumn("_kept", F.lit(False)))
        query = (
            both.writeStream.foreachBatch(lambda batch, number: self.account(spark, batch, schema, number))
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def account(self, spark: SparkSession, batch: DataFrame, schema: T.StructType, number: int) -> None:
        path = f"{self.root}/delivered/batch={number}"
        batch.write.mode("overwrite").partitionBy("_kept").parquet(path)
        rows = spark.read.schema(T.StructType([*schema, T.StructField("_kept", T.BooleanType())])).parquet(path)
        keys = list(self.keys)
        known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        missing = rows.where(~F.col("_kept") & known).drop("_kept")
        missing = missing.join(rows.where("_kept").select(*keys), keys, "left_anti")
        span = missing.agg(F.min(self.ts).alias("lo"), F.max(self.ts).alias("hi")).first()
        late = f"{self.root}/late/batch={number}"
        if span["lo"] is not None:
            # Kept rows farther away than the watermark's delay are not what these are replays of.
            delay = F.expr(f"INTERVAL {self.delay}")
            near = F.col(self.ts).between(F.lit(span["lo"]) - delay, F.lit(span["hi"]) + delay)
            before = self._table(spark, "delivered", schema, number).where("_kept").where(near)
            missing = missing.join(before.select(*keys), keys, "left_anti")
            missing = missing.join(self._table(spark, "late", schema, number).select(*keys), keys, "left_anti")
            missing = dedup_latest(missing, keys, [self.ts])
        else:
            missing = missing.limit(0)
        missing.write.mode("overwrite").parquet(late)

    def _table(self, spark: SparkSession, name: str, schema: T.StructType, before: int | None = None) -> DataFrame:
        extra = [T.StructField("batch", T.IntegerType())]
        extra += [T.StructField("_kept", T.BooleanType())] if name == "delivered" else []
        full = T.StructType([*schema, *extra])
        if before == 0:
            return spark.createDataFrame([], full)
        rows = spark.read.schema(full).parquet(f"{self.root}/{name}")
        return rows if before is None else rows.where(F.col("batch") < before)

    def kept(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        return self._table(spark, "delivered", schema).where("_kept").drop("_kept", "batch")

    def late(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        return self._table(spark, "late", schema).drop("batch")
