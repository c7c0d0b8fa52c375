"""Run a registered query or job from the command line (the counterpart of
the reference's one ``main`` per program) and write its result table.

    python -m tabml.plans.run --list
    python -m tabml.plans.run corr_matrix --sf-dir /data/tpch --out /data/out/corr
    python -m tabml.plans.run job_segment --sf-dir /data/tpch --show
    python -m tabml.plans.run linear_ols --csv "lineitem=/data/csv/part-*.csv" --show
"""

from __future__ import annotations

import argparse
import sys

from ..session import build_session
from ..sources import using
from .catalog import ORACLE_SQL, QUERIES


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m tabml.plans.run")
    ap.add_argument("query", nargs="?", help="registered query name")
    ap.add_argument("--list", action="store_true", help="list the registered queries")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01", help="folder of the parquet tables")
    ap.add_argument("--csv", action="append", default=[], metavar="TABLE=PATH",
                    help="read a table from CSV files with a header (file, folder or glob) instead; may be repeated")
    ap.add_argument("--out", help="write the result here (parquet, overwrite)")
    ap.add_argument("--show", action="store_true", help="print the first 20 rows")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    a = ap.parse_args(argv)
    if a.list or not a.query:
        for name in QUERIES:
            print(f"{name}\t{'oracle' if name in ORACLE_SQL else 'invariants'}")
        return 0
    if a.query not in QUERIES:
        print(f"unknown query {a.query!r}; try --list", file=sys.stderr)
        return 2
    if not all("=" in x for x in a.csv):
        print("--csv wants TABLE=PATH", file=sys.stderr)
        return 2
    spark = build_session(a.master, app=f"tabml-{a.query}")
    with using(dict(x.split("=", 1) for x in a.csv)):
        df = QUERIES[a.query](spark, a.sf_dir)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    if a.show or not a.out:
        df.show(20, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
