"""Writers for the layers and for feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.operators.features import primary_key_check
from adlift.operators.skew import KeySummary, key_counts, summaries_of
from adlift.schemas import EVENT_DATE
from adlift.session import fresh_dir
from adlift.sources.versions import write_folders


def by_date(df: DataFrame, ts: str, name: str) -> DataFrame:
    """Rows brought together by date for writing.

    The rebalance is sized at run time: a heavy day is split over several
    tasks and files, light days share one.
    """
    return df.withColumn(name, F.to_date(ts)).hint("rebalance", name)


def append_bronze(df: DataFrame, path: str) -> None:
    """Append to a raw log, one folder per event date."""
    dated = by_date(df, "timestamp", EVENT_DATE)
    dated.write.mode("append").partitionBy(EVENT_DATE).parquet(path)


@dataclass(frozen=True)
class LogStats:
    """What is learned of a log while it is written: rows per key bucket, and its last time (None: no row has one)."""

    summaries: list[KeySummary]
    last: datetime | None


def write_log(df: DataFrame, path: str, *keys: Sequence[str]) -> LogStats:
    """Replace a raw log, one folder per event date, and learn its statistics in the same job."""
    dated = by_date(df, "timestamp", EVENT_DATE)
    found = write_folders(dated, path, [EVENT_DATE], F.max("timestamp").alias("last"), *key_counts(*keys))
    return LogStats(summaries_of(found, *keys), found["last"])


def write_silver(df: DataFrame, path: str) -> None:
    """Replace the silver table, one folder per order date."""
    dated = by_date(df, "order_timestamp", "order_date")
    dated.write.mode("overwrite").partitionBy("order_date").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, order_by: Sequence[str] = ("timestamp",)) -> None:
    """Time-ordered CSV files with a header, timestamps to the second."""
    text = [
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if t == "timestamp" else F.col(c)
        for c, t in df.dtypes
    ]
    df.orderBy(*order_by).select(*text).write.mode("overwrite").option("header", True).csv(path)


def register_feature_table(
    df: DataFrame, name: str, primary_keys: Sequence[str], description: str = ""
) -> None:
    """Save ``df`` as table ``name`` after checking that the keys identify its rows."""
    found = primary_key_check(name, df, primary_keys).first()
    if found["repeated_keys"] or found["null_key_rows"]:
        raise ValueError(f"{name}: {list(primary_keys)} is not a primary key: {found.asDict()}")
    spark = df.sparkSession
    # The catalog points at a folder of its own for every version, and is turned to it when that is complete.
    folder = fresh_dir(spark, f"feature-table-{name}")
    df.write.parquet(folder)
    if spark.catalog.tableExists(name) and spark.table(name).schema == df.schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=folder, source="parquet", schema=df.schema)
    text = f"{description} (primary key: {', '.join(primary_keys)})".strip().replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {name} IS '{text}'")
