"""Differential check of catalogued queries against their DuckDB oracle.

Used by the tests and by hand (``python -m tickerlake.plans.compare sf_dir``).
Comparison is exact: same column names, same value types, and the same
multiset of rows (floats compared by their repr).
"""

from __future__ import annotations

import datetime as _dt
import math
import sys
from collections import Counter

from tickerlake.sources.feeds import TABLES


def duckdb_connection(sf_dir: str):
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
        return repr(v + 0.0)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _kind(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, float):
        return "float"
    if isinstance(v, _dt.datetime):
        return "timestamp"
    if isinstance(v, _dt.date):
        return "date"
    if isinstance(v, str):
        return "str"
    return type(v).__name__


def compare(spark_df, con, sql: str, limit_report: int = 5) -> dict:
    cols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    dcols = list(rel.columns)
    drows = rel.fetchall()
    out = {"spark_rows": len(srows), "oracle_rows": len(drows), "columns_match": sorted(cols) == sorted(dcols)}
    if not out["columns_match"]:
        out["spark_columns"], out["oracle_columns"] = cols, dcols
        out["ok"] = False
        return out
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    dorder = [dcols.index(cols[i]) for i in order]
    # value kinds per column
    kinds_ok = True
    for i, j in zip(order, dorder):
        sk = {_kind(r[i]) for r in srows} - {None}
        dk = {_kind(r[j]) for r in drows} - {None}
        if sk and dk and sk != dk:
            kinds_ok = False
            out.setdefault("kind_mismatch", {})[cols[i]] = (sorted(sk), sorted(dk))
    s = Counter(tuple(_norm(r[i]) for i in order) for r in srows)
    d = Counter(tuple(_norm(r[j]) for j in dorder) for r in drows)
    only_s = list((s - d).elements())
    only_d = list((d - s).elements())
    out["ok"] = kinds_ok and not only_s and not only_d
    if only_s or only_d:
        names = [cols[i] for i in order]
        out["columns"] = names
        out["only_spark"] = only_s[:limit_report]
        out["only_oracle"] = only_d[:limit_report]
        out["n_only_spark"], out["n_only_oracle"] = len(only_s), len(only_d)
    return out


def main(argv):
    import time

    from tickerlake.plans.catalog import QUERIES
    from tickerlake.plans.oracle_sql import ORACLE
    from tickerlake.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(QUERIES)
    spark = get_session("local[8]")
    con = duckdb_connection(sf_dir)
    bad = 0
    for n in names:
        t = time.time()
        if n not in ORACLE:
            rows = QUERIES[n](spark, sf_dir).count()
            print(f"{n:32s} rows-only {rows} ({time.time() - t:.1f}s)")
            continue
        try:
            r = compare(QUERIES[n](spark, sf_dir), con, ORACLE[n])
        except Exception as e:  # report and continue
            bad += 1
            print(f"{n:32s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        bad += 0 if r["ok"] else 1
        status = "OK " if r["ok"] else "BAD"
        print(f"{n:32s} {status} spark={r['spark_rows']} oracle={r['oracle_rows']} ({time.time() - t:.1f}s)")
        if not r["ok"]:
            for k in ("spark_columns", "oracle_columns", "kind_mismatch", "columns", "n_only_spark",
                      "n_only_oracle", "only_spark", "only_oracle"):
                if k in r:
                    print(f"    {k}: {r[k]}")
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
