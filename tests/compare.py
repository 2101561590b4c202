"""Side-by-side run of a query and its SQL: columns, row count, values."""

from __future__ import annotations

import datetime as dt
import math
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return str([_plain(v) for v in value])
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    kinds = [{type(r[i]).__name__ for r in rows if r[i] is not None} for i in order]
    table = sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: [str(x) for x in r])
    return [columns[i] for i in order], kinds, table


def compare(spark, con, name, fn, sql, sf_dir):
    started = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    spark_s = time.time() - started
    if not sql:
        return {"name": name, "ok": True, "rows": len(got), "spark": round(spark_s, 2), "note": "rows only"}
    started = time.time()
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    duck_s = time.time() - started
    gc, gk, gt = _rows(df.columns, got)
    wc, wk, wt = _rows(want_cols, want)
    note = ""
    if gc != wc:
        note = f"columns {gc} != {wc}"
    elif len(gt) != len(wt):
        note = f"rows {len(gt)} != {len(wt)}"
    elif gt != wt:
        bad = [(g, w) for g, w in zip(gt, wt) if g != w]
        note = f"{len(bad)} values differ, first {str(bad[0])[:700]}"
    elif gk != wk:
        note = f"kinds {gk} != {wk}"
    return {"name": name, "ok": not note, "rows": len(gt), "spark": round(spark_s, 2), "duck": round(duck_s, 2), "note": note}
