"""Spark vs DuckDB comparison in the shape of the driver's check.

Row count, column names and types, and an order-insensitive hash of the
values with columns sorted by name.  Doubles are compared through ``repr`` after
normalising ``-0.0``; dates/timestamps through ISO text.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import math
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with a view per driver table present in ``sf_dir`` (file or folder)."""
    import glob
    import os

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.isdir(path):
            path = f"{path}/*.parquet"
        elif not os.path.exists(path):
            continue
        if glob.glob(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if v == 0.0:
            v = 0.0
        return repr(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    try:
        import decimal

        if isinstance(v, decimal.Decimal):
            return repr(float(v))
    except Exception:
        pass
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


SPARK_TO_DUCKDB = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def compare(spark_df, con, sql):
    s_types = {c: SPARK_TO_DUCKDB.get(t, t) for c, t in spark_df.dtypes}
    d_types = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "schema_match": sorted(s_cols) == sorted(d_cols),
    }
    hs, ls = digest(s_cols, s_rows)
    if out["schema_match"]:
        hd, ld = digest(d_cols, d_rows)
        out["value_match"] = hs == hd
        if hs != hd:
            sd, dd = set(ls), set(ld)
            out["only_spark"] = sorted(sd - dd)[:3]
            out["only_oracle"] = sorted(dd - sd)[:3]
    else:
        out["value_match"] = False
        out["cols_spark"] = sorted(s_cols)
        out["cols_oracle"] = sorted(d_cols)
    out["type_match"] = s_types == d_types
    if not out["type_match"]:
        out["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                            if s_types.get(c) != d_types.get(c)}
    out["ok"] = (
        out["schema_match"] and out["type_match"] and out["value_match"]
        and out["rows_spark"] == out["rows_oracle"]
    )
    return out


def main(argv):
    import os
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from marketstar.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = argv[2:]
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = []
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        if name not in sqls:
            print(f"{name:38s} (no oracle)")
            continue
        try:
            r = compare(fn(spark, sf_dir), con, sqls[name])
        except Exception as e:  # report and continue
            r = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        status = "OK " if r["ok"] else "BAD"
        print(f"{status} {name:38s} {time.time() - t:5.1f}s {r if not r['ok'] else r['rows_spark']}", flush=True)
        if not r["ok"]:
            bad.append(name)
    print("MISMATCH:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
