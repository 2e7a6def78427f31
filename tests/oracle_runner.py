"""Run registered queries against their DuckDB oracles (the driver's correctness gate).

    python tests/oracle_runner.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

import duckdb  # noqa: E402

from compare import compare  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark", "pages", "labels", "embeddings")


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or queries:
        t0 = time.time()
        sdf = queries[name](spark, sf_dir).toPandas()
        t1 = time.time()
        if name in oracles:
            odf = con.execute(oracles[name]).df()
            ok, msg = compare(sdf, odf)
        else:
            ok, msg = None, "no oracle"
        results[name] = (ok, msg, len(sdf))
        if verbose:
            print(f"{name:28s} rows={len(sdf):7d} spark={t1 - t0:6.2f}s {ok} {msg[:300]}", flush=True)
    return results


if __name__ == "__main__":
    from ledgerline.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    run(local_session(), sf, sys.argv[2:] or None)
