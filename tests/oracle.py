"""Compare a query with its SQL in DuckDB: columns, rows and values, in any order."""

import glob
import math
import os
from decimal import Decimal

import duckdb
import pandas as pd


def connect(folder):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(x):
    if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, (float, Decimal)):
        return round(float(x), 6)
    if hasattr(x, "isoformat"):
        return str(pd.Timestamp(x).tz_localize(None))
    if hasattr(x, "tolist"):
        x = x.tolist()
    return str([plain(y) for y in x]) if isinstance(x, (list, tuple)) else round(x, 6) if isinstance(x, float) else x


def rows(frame):
    frame = frame.reindex(sorted(frame.columns), axis=1)
    return sorted((tuple(map(plain, r)) for r in frame.astype(object).itertuples(index=False)), key=str)


def assert_same(found, con, sql):
    spark_rows, duck = found.toPandas(), con.sql(sql).df()
    assert sorted(spark_rows.columns) == sorted(duck.columns)
    assert rows(spark_rows) == rows(duck)
