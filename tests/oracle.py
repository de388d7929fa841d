"""Run queries and their SQL twins side by side: python tests/oracle.py [sf] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = "/root/testdata"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def spark_rows(df):
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    return columns, sorted(tuple(canonical(v) for v in row) for row in rows)


def duck_rows(con, text):
    cur = con.execute(text)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(canonical(row[i]) for i in order) for row in cur.fetchall())


def compare(spark, con, sf_dir, query, text):
    """None if equal, else what differs."""
    columns, got = spark_rows(query(spark, sf_dir))
    names, want = duck_rows(con, text)
    if columns != names:
        return f"columns {columns} != {names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if not bad:
        return None
    g, w = bad[0]
    cells = [(c, a, b) for c, a, b in zip(columns, g, w) if a != b]
    return f"{len(bad)} of {len(got)} rows differ; first: {cells[:4]} in {g[:6]}"


def session():
    from fleetprep.session import local_session

    return local_session(8, "oracle")


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries

    sf_dir = f"{DATA}/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    wanted = sys.argv[2:] or list(queries())
    spark, con = session(), connect(sf_dir)
    failed = []
    for label in wanted:
        start = time.time()
        try:
            if label in oracle_sql():
                result = compare(spark, con, sf_dir, queries()[label], oracle_sql()[label])
            else:
                n = len(queries()[label](spark, sf_dir).collect())
                result = None if n else "no rows"
        except Exception as e:
            result = f"{type(e).__name__}: {str(e)[:600]}"
        if result:
            failed.append(label)
        print(f"{'FAIL' if result else 'ok  '} {time.time() - start:6.1f}s {label} {result or ''}", flush=True)
    print(f"{len(wanted) - len(failed)} of {len(wanted)} ok; failed: {failed}")
