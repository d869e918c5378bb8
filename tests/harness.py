"""Run a registered query in Spark and its DuckDB twin; compare like the driver.

Checks: same column names, compatible column types, same row count and the
same multiset of rows with exact values.

CLI: ``python tests/harness.py [sf_dir] [key ...]``
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def duck_con(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, repr(x)) for x in row)


def compare(spark, con, key: str, sf_dir: str, sql: str | None, fn) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    s_rows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"key": key, "rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    d_types = [str(c[1]) for c in rel.description]
    problems = []
    if sorted(cols) != sorted(d_cols):
        problems.append(f"columns spark={cols} duck={d_cols}")
    else:
        order = [d_cols.index(c) for c in cols]
        d_rows = [tuple(r[i] for i in order) for r in d_rows]
        d_types = [d_types[i] for i in order]
        for c, st, dt in zip(cols, s_types, d_types):
            want = SPARK_TO_DUCK.get(st)
            if want and want != dt:
                problems.append(f"type {c}: spark {st} vs duck {dt}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rowcount spark={len(s_rows)} duck={len(d_rows)}")
    elif not problems:
        a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    res["status"] = "ok" if not problems else "FAIL"
    if problems:
        res["problems"] = problems
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from __spark_entry__ import oracle_sql, queries
    from mediafeat.session import get_session
    spark = get_session(shuffle_partitions=8)
    con = duck_con(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for k in keys or sorted(qs):
        try:
            r = compare(spark, con, k, sf_dir, sqls.get(k), qs[k])
        except Exception as e:  # report and continue
            r = {"key": k, "status": "ERROR", "error": str(e)[:600]}
        bad += r["status"] in ("FAIL", "ERROR")
        print(r, flush=True)
    print(f"{len(keys or qs)} checked, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
