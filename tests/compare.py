"""Side-by-side run of a registered query and its SQL counterpart."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        if name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df) -> tuple[list[str], list[tuple[str, ...]]]:
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple[str, ...]]]:
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    return sorted(columns), rows_of(columns, rel.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None when both agree, otherwise a short description."""
    sc, sr = spark_rows(df)
    qc, qr = sql_rows(con, sql)
    if sc != qc:
        return f"columns {sc} vs {qc}"
    if sr == qr:
        return None
    left, right = list(set(sr) - set(qr))[:2], list(set(qr) - set(sr))[:2]
    return f"{len(sr)} vs {len(qr)} rows; columns {sc}; only spark {left}; only sql {right}"
