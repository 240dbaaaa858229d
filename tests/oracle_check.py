"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison: same column names (sorted), same row count, and the same
multiset of rows after normalising values (timestamps and decimals to text,
floats exact). Prints one line per query and exits non-zero on a mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted((tuple(norm(r[i]) for i in order) for r in rows),
                 key=lambda t: tuple((x is None, str(x)) for x in t))
    return cols, out


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare_one(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spark_s = time.time() - t0
    s_cols, s_rows = canon(df.columns, rows)
    if sql is None:
        return dict(name=name, ok=None, rows=len(rows), spark_s=spark_s, note="rows-only")
    t0 = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    duck_s = time.time() - t0
    o_cols, o_rows = canon(d_cols, d_rows)
    note = ""
    ok = True
    if s_cols != o_cols:
        ok, note = False, f"columns {s_cols} vs {o_cols}"
    elif len(s_rows) != len(o_rows):
        ok, note = False, f"rows {len(s_rows)} vs {len(o_rows)}"
    elif s_rows != o_rows:
        ok = False
        diff = [(a, b) for a, b in zip(s_rows, o_rows) if a != b][:2]
        note = f"values differ, e.g. {diff}"
    return dict(name=name, ok=ok, rows=len(rows), spark_s=spark_s, duck_s=duck_s, note=note)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(argv[2:])
    from dimkiln.session import build_session
    import __spark_entry__ as E
    spark = build_session(extra={"spark.sql.warehouse.dir": __import__("tempfile").mkdtemp(prefix="dimkiln-wh-", dir="/tmp")})
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            res = compare_one(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as exc:  # report and continue with the next query
            res = dict(name=name, ok=False, rows=-1, spark_s=0, note=f"ERROR {type(exc).__name__}: {str(exc)[:300]}")
        bad += res["ok"] is False
        flag = {True: "OK  ", False: "FAIL", None: "ROWS"}[res["ok"]]
        print(f"{flag} {name:28s} rows={res['rows']:7d} spark={res['spark_s']:.2f}s {res.get('note', '')}",
              flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
