"""Compare a Spark result with a DuckDB query over the same Parquet tables.

Used by the tests and by ``python tests/compare.py`` to check every
registered query the way the driver does: row count, column names and
types, and an order-insensitive comparison of values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, dt.time)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    out = {
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_columns": s_cols,
        "oracle_columns": d_cols,
    }
    if out["columns_match"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        out["values_match"] = a == b
        if a != b:
            out["only_spark"] = list((a - b).elements())[:3]
            out["only_oracle"] = list((b - a).elements())[:3]
    else:
        out["values_match"] = False
    out["ok"] = out["columns_match"] and out["values_match"] and len(s_rows) == len(d_rows)
    return out


def main(argv: list[str]) -> int:
    import importlib.util
    import time

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spec = importlib.util.spec_from_file_location("spark_entry", "__spark_entry__.py")
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    from hourmill.session import build_session

    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = mod.queries(), mod.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        if name in sqls:
            res = compare(df, con, sqls[name])
        else:
            res = {"ok": True, "spark_rows": df.count(), "note": "no oracle"}
        bad += 0 if res["ok"] else 1
        print(f"{name:24s} {'OK ' if res['ok'] else 'BAD'} {time.time() - t0:6.2f}s {res if not res['ok'] else res['spark_rows']}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
