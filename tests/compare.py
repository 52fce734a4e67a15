"""Run registered queries beside their SQL and compare rows, column names and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return f"b:{v}"
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"n:{float(v):.6f}".replace("-0.000000", "0.000000")
    if isinstance(v, dt.datetime):
        return f"t:{v:%Y-%m-%d %H:%M:%S}"
    return f"{type(v).__name__}:{v}"


def canonical(columns, rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_value(r[i]) for i in order) for r in rows)


def differences(got, want) -> str | None:
    (gc, gr), (wc, wr) = got, want
    if gc != wc:
        return f"columns {gc} != {wc}"
    if len(gr) != len(wr):
        return f"{len(gr)} rows != {len(wr)} rows"
    wrong = [(a, b) for a, b in zip(gr, wr) if a != b]
    return f"{len(wrong)} rows differ, columns {gc}, first {wrong[0]}" if wrong else None
