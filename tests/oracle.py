"""Runs SQL in DuckDB over the test tables and compares it with a DataFrame, as rows in any order."""

from collections import Counter
from math import isnan

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def run_sql(sql: str, sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    out = con.execute(sql)
    return [d[0] for d in out.description], out.fetchall()


def plain(value):
    if isinstance(value, float):
        return None if isnan(value) else round(value, 9) + 0.0
    if hasattr(value, "tzinfo"):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def same(df, sql: str, sf_dir: str) -> int:
    """Asserts equal columns and equal rows; returns the number of rows."""
    names, rows = run_sql(sql, sf_dir)
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    order = sorted(names)
    theirs = Counter(tuple(plain(r[names.index(c)]) for c in order) for r in rows)
    ours = Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    assert ours == theirs, (order, list((ours - theirs).items())[:4], list((theirs - ours).items())[:4])
    return len(rows)
