"""Run queries and their SQL side by side: ``python tests/oracle.py [folder] [name ...]``."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
KINDS = {"int": "int32", "bigint": "int64", "double": "double", "string": "text", "boolean": "bool", "date": "date",
         "timestamp_ntz": "time", "timestamp": "time",
         "INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "double", "VARCHAR": "text", "BOOLEAN": "bool",
         "DATE": "date", "TIMESTAMP": "time"}


def database(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def differences(df, con, sql):
    """None when names, types and rows agree, else what differs."""
    got_types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    rel = con.sql(sql)
    want_types = {n: KINDS.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    if got_types != want_types:
        return f"schema {sorted(set(got_types.items()) ^ set(want_types.items()))}"
    names = sorted(got_types)
    got = sorted(tuple(cell(r[n]) for n in names) for r in df.collect())
    at = [rel.columns.index(n) for n in names]
    want = sorted(tuple(cell(r[i]) for i in at) for r in rel.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows, want {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows, first {str(bad[0])[:600]}" if bad else None


if __name__ == "__main__":
    import __spark_entry__ as driver
    from tidecart.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("oracle")
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    failed = 0
    for name, run in driver.queries().items():
        sql = driver.oracle_sql().get(name)
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            wrong = differences(df, con, sql) if sql else (None if df.count() else "no rows")
        except Exception as e:
            wrong = f"{type(e).__name__}: {str(e)[:700]}"
        failed += wrong is not None
        print(f"{'ok  ' if wrong is None else 'FAIL'} {name} {time.time() - start:.1f}s {'' if sql else '(no SQL)'} {wrong or ''}",
              flush=True)
    print(f"{failed} failed")
    spark.stop()
