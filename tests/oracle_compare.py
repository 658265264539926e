"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import datetime as dt
import decimal
import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, decimal.Decimal)):
        return (2, str(decimal.Decimal(v).normalize()))
    if isinstance(v, float):
        return (2, "nan") if math.isnan(v) else (2, repr(round(v, 9)))
    if isinstance(v, dt.datetime):
        return (3, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (3, v.isoformat())
    return (5, str(v))


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(df):
    cols = df.columns
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted(tuple(norm(r[i]) for i in idx) for r in df.collect())


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
