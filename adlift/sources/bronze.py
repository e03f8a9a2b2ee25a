"""Readers for the raw logs: CSV and Parquet, static, with an evolving schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlift import schemas as S

LOGS: dict[str, T.StructType] = {
    "impressions": S.IMPRESSIONS,
    "clicks": S.CLICKS,
    "orders": S.ORDERS,
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred in an extra pass."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_log(spark: SparkSession, path: str, log: str) -> DataFrame:
    """A Parquet log whose files may differ in columns.

    Columns added later are kept and null in older files; columns of the
    layout that no file has are added as null. A log without its identifier,
    time or keys is refused.
    """
    schema = LOGS[log]
    df = spark.read.option("mergeSchema", True).parquet(path)
    required = [schema[0].name, "timestamp", "customer_id", "merchant_id"]
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{log} log at {path} lacks {missing}")
    known = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*known, *extra)


def register_csv(spark: SparkSession, path: str, view: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV file as a relation that SQL text can name."""
    df = read_csv(spark, path, schema)
    df.createOrReplaceTempView(view)
    return df
