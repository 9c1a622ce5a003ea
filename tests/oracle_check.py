"""Run every catalogue query in Spark and its oracle in DuckDB; compare rows, columns and values.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from cleanlane.session import local_session  # noqa: E402
from cleanlane.sources.io import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def key(t):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "double": "DOUBLE",
    "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def compare(name, sdf, con, sql):
    scols = list(sdf.columns)
    stypes = dict(sdf.dtypes)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    dtypes = {d[0]: str(d[1]) for d in res.description}
    drows = res.fetchall()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={scols} duck={dcols}")
        return problems
    tdiff = {c: (stypes[c], dtypes[c]) for c in scols if SPARK_TO_DUCK.get(stypes[c], stypes[c]) != dtypes[c]}
    if tdiff:
        problems.append(f"types {tdiff}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    s = sorted((tuple(norm(r[i]) for i in si) for r in srows), key=key)
    d = sorted((tuple(norm(r[i]) for i in di) for r in drows), key=key)
    if s != d:
        diff = [(a, b) for a, b in zip(s, d) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            if name in orc:
                probs = compare(name, df, con, orc[name])
            else:
                n = df.count()
                probs = [] if n >= 0 else ["no rows"]
        except Exception as e:  # noqa: BLE001
            probs = [f"error {type(e).__name__}: {str(e)[:400]}"]
        status = "OK " if not probs else "BAD"
        bad += bool(probs)
        tag = "" if name in orc else " (rows-only)"
        print(f"{status} {name}{tag} {time.time() - t0:.1f}s {'; '.join(probs)}", flush=True)
    print(f"{bad} failing of {len([n for n in qs if not names or n in names])}")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
