"""Runs a catalogue query on Spark and its SQL twin on DuckDB and compares rows, names, types and values."""

from __future__ import annotations

import datetime
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, query, sql):
    """(ok, message, seconds)"""
    start = time.time()
    df = query(spark, folder)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}", seconds
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    sql_types = {d[0]: str(d[1]) for d in cur.description}
    odd = [(n, types[n], sql_types[n]) for n in types if types[n] in same and same[types[n]] not in (sql_types[n], {"STRING": "VARCHAR", "NUMBER": sql_types[n]}.get(sql_types[n], sql_types[n]))]
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return False, f"{len(a)} rows != {len(b)}", seconds
    if not a:
        return False, "no rows", seconds
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} of {len(a)} rows differ, columns {sorted(names)}, first {bad[0]}", seconds
    return True, f"{len(a)} rows" + (f" types {odd}" if odd else ""), seconds


if __name__ == "__main__":
    import sys

    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from pricecast.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        try:
            if name in oracle:
                ok, text, sec = compare(spark, con, folder, query, oracle[name])
            else:
                t = time.time()
                n = len(query(spark, folder).collect())
                ok, text, sec = n > 0, f"{n} rows, no SQL", time.time() - t
        except Exception as e:  # report and go on
            ok, text, sec = False, f"{type(e).__name__}: {str(e)[:1500]}", 0.0
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {sec:6.2f}s {text}", flush=True)
    spark.stop()
