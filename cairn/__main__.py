"""Run a registered query: ``python -m cairn <query> <tables_dir> [--out PATH] [--show N]``.

``python -m cairn --list`` prints the query names. The query reads the parquet
tables in ``tables_dir``; ``--out`` writes the result as parquet (overwrite),
``--show`` prints the first N rows, ``--explain`` prints the formatted plan.
"""

from __future__ import annotations

import argparse
import os
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m cairn")
    ap.add_argument("query", nargs="?")
    ap.add_argument("tables_dir", nargs="?")
    ap.add_argument("--out")
    ap.add_argument("--show", type=int, default=0)
    ap.add_argument("--explain", action="store_true")
    ap.add_argument("--list", action="store_true")
    a = ap.parse_args(argv)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from cairn.plans.queries import QUERIES
    if a.list or not a.query:
        print("\n".join(sorted(QUERIES)))
        return 0
    if a.query not in QUERIES or not a.tables_dir:
        ap.error(f"unknown query or missing tables_dir: {a.query}")
    from pyspark.sql import SparkSession
    from cairn.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.appName(f"cairn-{a.query}")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    df = QUERIES[a.query](spark, a.tables_dir)
    if a.explain:
        df.explain("formatted")
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    if a.show:
        df.show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
