"""Compare a registered query with its SQL twin: names, row count, values."""

from __future__ import annotations

import datetime as dt

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time() else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, float):
        return f"{v:.6f}"
    return v


def canonical(names, rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = sorted(repr([_norm(r[i]) for i in order]) for r in rows)
    return [names[i] for i in order], lines


def differences(spark_df, con, sql: str, show: int = 3) -> str | None:
    """None if equal, else what differs."""
    rel = con.sql(sql)
    want_names, want = canonical(rel.columns, rel.fetchall())
    got_names, got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_names != want_names:
        return f"columns {sorted(set(got_names) ^ set(want_names))}"
    if got == want:
        return None
    extra = sorted(set(got) - set(want))[:show]
    missing = sorted(set(want) - set(got))[:show]
    return f"rows {len(got)} vs {len(want)}; only Spark: {extra}; only SQL: {missing}"


