"""Side-by-side check of the registered queries against DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when both sides hold the same columns and the same bag of rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _bag(names, cursor.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"
    actual = _bag(spark_df.columns, spark_df.collect())
    if actual == expected:
        return None if expected else "no rows on either side"
    missing, extra = expected - actual, actual - expected
    return (
        f"{sum(actual.values())} rows instead of {sum(expected.values())}; "
        f"missing {missing.most_common(2)}, extra {extra.most_common(2)}"
    )
