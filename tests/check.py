"""Side-by-side check of registered queries with their SQL: python tests/check.py SF [name ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf, fn, sql):
    """Empty text if equal, else what differs."""
    df = fn(spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if got else "no rows"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}; e.g. {got[:2]} vs {want[:2]}"
    types = {n: t for n, t in df.dtypes}
    plain_types = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    other = {d[0]: str(d[1]) for d in cur.description}
    unlike = [(n, t, other[n]) for n, t in types.items() if plain_types.get(t) != other[n]]
    if unlike:
        return f"types unlike: {unlike}"
    odd = [n for n, t in types.items() if t.startswith(("array", "map", "struct", "decimal", "float", "void"))]
    if odd:
        return f"types not plain: {odd}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} of {len(got)} rows differ; e.g. {bad[0]}" if bad else ("" if got else "no rows")


def main(sf, names):
    from __spark_entry__ import oracle_sql, queries
    from shoalgrid import build_session

    registered, sql = queries(), oracle_sql()

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for name in names or registered:
        start = time.time()
        try:
            problem = compare(spark, con, sf, registered[name], sql.get(name))
        except Exception as err:  # report and go on with the other queries
            problem = f"{type(err).__name__}: {str(err)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem[:900]}", flush=True)
    print(f"{failed} failed of {len(names or registered)}; oracles {len(sql)}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
