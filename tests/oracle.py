"""Side-by-side comparison of a query with its SQL in DuckDB."""

from __future__ import annotations

import decimal
import math
from collections import Counter

import duckdb

from layerwright.acceptance.tables import NAMES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None) is not None:
        return value.replace(tzinfo=None)
    return value


def differences(spark_df, con, sql: str) -> list[str]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    order = sorted(names)
    spots = [names.index(n) for n in order]
    theirs = Counter(tuple(plain(r[i]) for i in spots) for r in cursor.fetchall())
    ours = Counter(tuple(plain(r[n]) for n in order) for r in spark_df.select(*[f"`{n}`" for n in order]).collect())
    if ours == theirs:
        return []
    lost, extra = theirs - ours, ours - theirs
    return [
        f"{sum(ours.values())} rows against {sum(theirs.values())}; columns {order}",
        *[f"only in SQL: {r}"[:600] for r in list(lost)[:3]],
        *[f"only in Spark: {r}"[:600] for r in list(extra)[:3]],
    ]
