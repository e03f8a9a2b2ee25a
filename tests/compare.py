"""Run a Spark query and its SQL twin, and compare the rows as multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or hasattr(value, "as_tuple"):
        number = float(value)
        return None if math.isnan(number) else round(number, 9)
    return value


def multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str:
    """An empty string where both sides agree."""
    got_columns = spark_df.columns
    got = multiset(got_columns, spark_df.collect())
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = multiset(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    if got == want:
        return ""
    only_got, only_want = list((got - want).items()), list((want - got).items())
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; columns {sorted(got_columns)}; "
        f"only Spark ({len(only_got)}): {only_got[:3]}; only SQL ({len(only_want)}): {only_want[:3]}"
    )
