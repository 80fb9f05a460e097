"""Run a registered query in Spark and its SQL in DuckDB and compare rows, names and types."""

from __future__ import annotations

import datetime
import math
import os
import sys
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
         "smallint": "SMALLINT", "tinyint": "TINYINT"}


def connect(folder: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return repr(v)


def compare(spark, folder: str, fn, sql: str) -> list[str]:
    """Problems found, empty when equal."""
    df = fn(spark, folder)
    con = connect(folder)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = [str(d[1]) for d in rel.description]
    rows = rel.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns spark-sql={sorted(set(df.columns) - set(names))} sql-spark={sorted(set(names) - set(df.columns))}"]
    spark_types = dict(df.dtypes)
    for n, t in zip(names, types):
        want = TYPES.get(spark_types[n], spark_types[n].upper().replace("DECIMAL", "DECIMAL"))
        if want.replace(" ", "").upper() != t.replace(" ", "").upper():
            problems.append(f"type {n}: spark {spark_types[n]} sql {t}")
    order = sorted(names)
    a = sorted(tuple(canon(r[n]) for n in order) for r in df.collect())
    at = [names.index(n) for n in order]
    b = sorted(tuple(canon(r[i]) for i in at) for r in rows)
    if len(a) != len(b):
        problems.append(f"rows spark {len(a)} sql {len(b)}")
    if a != b:
        sa, sb = set(a), set(b)
        pairs = list(zip(sorted(sa - sb), sorted(sb - sa)))[:3]
        shown = [{c: (u, v) for c, u, v in zip(order, p, q) if u != v} for p, q in pairs]
        problems.append(f"values differ: {len(sa - sb)}/{len(sb - sa)}; {shown}")
    if not a:
        problems.append("no rows")
    return problems


if __name__ == "__main__":
    import time

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry
    from casegauge.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                  "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            if name in oracles:
                problems = compare(spark, folder, fn, oracles[name])
            else:
                problems = [] if fn(spark, folder).count() else ["no rows"]
        except Exception as e:  # report and go on
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - t:.1f}s {'' if name in oracles else '(no sql)'}", flush=True)
        for p in problems:
            print("     ", p[:1500])
    print("failed:", bad)
