"""Pseudonyms, column masks and row filters on tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pseudonymize(df: DataFrame, column: str, salt: str) -> DataFrame:
    """``column`` replaced by the salted SHA-256 of its value; equal ids stay equal."""
    return df.withColumn(column, F.sha2(F.concat(F.lit(salt), F.col(column)), 256))


def mask_columns(df: DataFrame, policy: Mapping[str, str]) -> DataFrame:
    """Mask columns by rule: ``null``, ``prefix:N`` (keep N characters) or ``constant:TEXT``."""

    def masked(name: str, kind: str) -> Column:
        rule, _, arg = policy[name].partition(":")
        if rule == "null":
            return F.lit(None).cast(kind)
        if rule == "prefix":
            return F.concat(F.substring(F.col(name).cast("string"), 1, int(arg)), F.lit("***"))
        if rule == "constant":
            return F.lit(arg).cast(kind)
        raise ValueError(f"unknown masking rule: {policy[name]}")

    return df.select(
        *[masked(c, t).alias(c) if c in policy else F.col(c) for c, t in df.dtypes]
    )


def filter_rows(df: DataFrame, grants: DataFrame, principal: str, keys: Sequence[str]) -> DataFrame:
    """The rows whose ``keys`` are granted to ``principal`` in (principal, *keys)."""
    allowed = grants.where(F.col("principal") == principal).select(*keys).distinct()
    return df.join(allowed, list(keys), "left_semi")
