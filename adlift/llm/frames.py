"""What the operators share on the Spark side."""

from __future__ import annotations

from pyspark.sql import DataFrame

from adlift.session import fresh_dir, ship_package

__all__ = ["ship_package", "written"]


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows as a table in the shared folder: read from there, never computed twice."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
