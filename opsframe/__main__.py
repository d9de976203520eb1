"""Command line: run one registered query over a folder of tables.

    python -m opsframe list
    python -m opsframe <query> <tables_dir> [--out DIR] [--show N] [--explain]

Without ``--out`` the first rows are shown; with it the result is written as
parquet (the usual way on a cluster). The session's own settings are used
when one exists (``spark-submit``); otherwise a local session is created.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from opsframe import registry
from opsframe.session import DEFAULT_CONF, ensure_checkpoint_dir


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m opsframe")
    ap.add_argument("query", help="query name, or 'list'")
    ap.add_argument("tables", nargs="?", help="folder holding <table>.parquet files")
    ap.add_argument("--out", help="write the result here as parquet")
    ap.add_argument("--show", type=int, default=20)
    ap.add_argument("--explain", action="store_true")
    a = ap.parse_args(argv)
    qs = registry.queries()
    if a.query == "list":
        for name, fn in qs.items():
            doc = (fn.__doc__ or "").strip().splitlines()
            print(f"{name:26s} {doc[0] if doc else ''}")
        return 0
    if a.query not in qs or not a.tables:
        ap.error("unknown query or missing tables folder (see 'list')")
    builder = SparkSession.builder.appName(f"opsframe-{a.query}")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    df = qs[a.query](spark, a.tables)
    if a.explain:
        df.explain("formatted")
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(a.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
