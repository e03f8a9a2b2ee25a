"""Column expressions shared by the operators. All run inside codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlift import schemas as S

DAY_US = 86_400 * 1_000_000
HOUR_US = 3_600 * 1_000_000


def rounded(value: Column, digits: int) -> Column:
    """Scale, round half away from zero, unscale, all in double.

    ``F.round`` works on the decimal text of the double, so 1.005 becomes 1.01
    there and 1.0 in engines that round the scaled double.
    """
    scale = float(10**digits)
    return F.round(value.cast("double") * F.lit(scale), 0) / F.lit(scale)


def ratio(top: Column, bottom: Column) -> Column:
    """Division in double; null where the divisor is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def micros(ts: str | Column) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def seconds_between(later: Column, earlier: Column) -> Column:
    return later.cast("double") - earlier.cast("double")


def hours_between(later: Column, earlier: Column) -> Column:
    return rounded(seconds_between(later, earlier) / F.lit(3600.0), 1)


def money(amount: str) -> Column:
    """Amounts carry cents; sums of decimals do not depend on row order."""
    return F.col(amount).cast("decimal(18,2)")


def hash32(value: str | Column, salt: str = "") -> Column:
    """Uniform integer in [0, 2^32) from text, the same in every engine with md5."""
    column = F.col(value) if isinstance(value, str) else value
    digest = F.md5(F.concat(F.lit(salt), column.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def meal_period(ts: str | Column) -> Column:
    """Morning until 11:30; then the nearer of lunch (to 13:30) and dinner (from 19:00)."""
    column = F.col(ts) if isinstance(ts, str) else ts
    minute = F.hour(column) * 60 + F.minute(column)
    return (
        F.when(minute < 11 * 60 + 30, F.lit("manha"))
        .when(minute < 16 * 60 + 15, F.lit("almoco"))
        .when(minute.isNotNull(), F.lit("jantar"))
    )


def price_sensitive(affinity: Column) -> Column:
    return affinity > F.lit(S.PRICE_SENSITIVE_ABOVE)


def heuristic_propensity(ticket: Column, sensitive: Column) -> Column:
    weight = F.when(sensitive, F.lit(0.8)).otherwise(F.lit(0.6))
    return F.least(F.lit(0.95), F.greatest(F.lit(0.12), ticket / F.lit(100.0) * weight))


def affinity_match(user_cuisine: Column, merchant_cuisine: Column) -> Column:
    """1 where both are known and equal, else 0."""
    return F.coalesce((user_cuisine == merchant_cuisine).cast("int"), F.lit(0))


def or_default(columns: Mapping[str, object]) -> dict[str, Column]:
    return {name: F.coalesce(F.col(name), F.lit(value)) for name, value in columns.items()}


def sanitised(text: Column) -> Column:
    """Drop control characters, collapse runs of white space, trim."""
    no_control = F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")
    return F.trim(F.regexp_replace(no_control, r"[ \t\r\n]+", " "))
