"""Spark-vs-DuckDB comparison used by the tests and by ``python -m tests.harness``.

Compares row count, column names and the multiset of rows (columns sorted
by name; doubles compared exactly, and with a 1e-9 relative tolerance as a
fallback diagnostic).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact=True):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int,)):
        return (2, float(v)) if not exact else (2, v)
    if isinstance(v, decimal.Decimal):
        return (2, float(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (3, "nan")
        if v == 0.0:
            return (2, 0.0)   # -0.0 and 0.0 compare equal (see functions.numeric)
        return (2, v if exact else float(f"{v:.9g}"))
    if isinstance(v, dt.datetime):
        return (4, v.isoformat())
    if isinstance(v, dt.date):
        return (4, v.isoformat())
    return (5, str(v))


def _rows(cols, rows, exact):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i], exact) for i in order) for r in rows)


def compare(spark, con, name, qfn, sql, sf_dir, verbose=False):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"query": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["only_spark"] = sorted(set(s_cols) - set(d_cols))
        out["only_oracle"] = sorted(set(d_cols) - set(s_cols))
        out["match"] = False
        return out
    # align oracle column order to spark's names
    idx = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in idx) for r in d_rows]
    exact = _rows(s_cols, s_rows, True) == _rows(s_cols, d_rows, True)
    out["exact"] = exact
    out["match"] = exact or _rows(s_cols, s_rows, False) == _rows(s_cols, d_rows, False)
    if not out["match"] and verbose:
        a, b = _rows(s_cols, s_rows, False), _rows(s_cols, d_rows, False)
        sa, sb = set(a), set(b)
        cols_sorted = sorted(s_cols)
        diff_a = [r for r in a if r not in sb][:3]
        diff_b = [r for r in b if r not in sa][:3]
        for ra, rb in zip(diff_a, diff_b):
            for c, x, y in zip(cols_sorted, ra, rb):
                if x != y:
                    print(f"   {name}.{c}: spark={x} oracle={y}")
    return out


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from marginflow.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        if name not in sqls:
            print(f"{name:36s} (no oracle)")
            continue
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir, verbose=True)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:36s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        bad += not r["match"]
        flag = "OK " if r["match"] else "BAD"
        print(f"{name:36s} {flag} exact={r.get('exact')} rows={r['spark_rows']}/{r['oracle_rows']} "
              f"cols={r['columns_match']} t={r['spark_sec']}s"
              + ("" if r["columns_match"] else f" only_spark={r['only_spark']} only_oracle={r['only_oracle']}"))
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
