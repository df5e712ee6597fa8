"""Compare a registered query with its SQL, as sets of rows with multiplicity."""

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb

from sitegauge.catalog.standins import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def value(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(value(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(value(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    """Difference as text, None when both agree."""
    df = query(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_columns, want = rows_of(names, cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        return f"rows {sum(got.values())} vs {sum(want.values())}; only Spark {list((got - want).items())[:3]}; only SQL {list((want - got).items())[:3]}"
    return None
