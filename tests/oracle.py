"""Compare registered queries with their SQL on DuckDB: python tests/oracle.py [--sf DIR] [names...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def compare(df, con, sql):
    """Empty text when equal, else what differs."""
    cur = con.execute(sql)
    names = [x[0] for x in cur.description]
    dtypes = {x[0]: str(x[1]) for x in cur.description}
    theirs = cur.fetchall()
    ours = df.collect()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = dict(df.dtypes)
    want = {"bigint": ("BIGINT", "NUMBER"), "double": ("DOUBLE", "FLOAT", "NUMBER"), "string": ("VARCHAR", "STRING"), "boolean": ("BOOLEAN", "bool")}
    odd = [f"{c}: {kinds[c]}/{dtypes[c]}" for c in names if not any(w.lower() in dtypes[c].lower() for w in want.get(kinds[c], ("?",)))]
    cols = sorted(names)
    a = sorted((tuple(norm(r[c]) for c in cols) for r in ours), key=repr)
    idx = [names.index(c) for c in cols]
    b = sorted((tuple(norm(r[i]) for i in idx) for r in theirs), key=repr)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, columns {cols}, first {bad[0]}"
    if not a:
        return "no rows on either side"
    if odd:
        return "types " + "; ".join(odd)
    return ""


def main():
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.001"
    if args and args[0] == "--sf":
        sf, args = args[1], args[2:]
    from locusframe.plans.registry import all_queries
    from locusframe.session import get_session

    spark = get_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, q in all_queries().items():
        if args and not any(a in name for a in args):
            continue
        t = time.time()
        try:
            df = q(spark, sf)
            msg = compare(df, con, q.oracle) if q.oracle else f"(rows only: {len(df.collect())})"
        except Exception as e:  # noqa: BLE001
            msg = "FAILED " + type(e).__name__ + ": " + str(e)[:600]
        bad += bool(msg) and not msg.startswith("(rows only")
        print(f"{time.time() - t:6.1f}s {name}: {msg or 'ok'}", flush=True)
    print("problems:", bad)


if __name__ == "__main__":
    main()
