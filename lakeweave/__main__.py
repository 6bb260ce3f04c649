"""Command line: build the layers and run their checks, or ask the metric layer.

  python -m lakeweave build    --tables DIR [--root PATH] [--fail-on-checks]
  python -m lakeweave query    --tables DIR '{"measures": ["noaa_ghcn_stations.count"], ...}'
  python -m lakeweave describe

``--tables`` is a directory with the shared tables (one Parquet file per table); the
lakehouse root defaults to a folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="lakeweave")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build every layer, then run the declared checks")
    b.add_argument("--tables", required=True)
    b.add_argument("--root", default=None)
    b.add_argument("--fail-on-checks", action="store_true")
    b.add_argument("--fail-fast", action="store_true", help="check each model right after it is built")
    q = sub.add_parser("query", help="run a governed metric query (JSON)")
    q.add_argument("--tables", required=True)
    q.add_argument("query")
    sub.add_parser("describe", help="list cubes, measures and dimensions")
    args = ap.parse_args(argv)

    if args.cmd == "describe":
        from lakeweave.plans.metrics import MetricService

        print(json.dumps(MetricService({}).describe(), indent=2))
        return 0

    from lakeweave.session import build_session

    spark = build_session()
    if args.cmd == "build":
        from lakeweave.operators.quality import assert_passing, run_suite
        from lakeweave.plans.build import build_all
        from lakeweave.plans.checks import DECLARED_CHECKS
        from lakeweave.plans.raw import RawTables
        from lakeweave.sinks.tables import Lakehouse

        lh = Lakehouse(spark, args.root) if args.root else Lakehouse(spark)
        tables = build_all(lh, RawTables(spark, args.tables), DECLARED_CHECKS, fail_fast=args.fail_fast)
        results = run_suite(tables, DECLARED_CHECKS, lh.counted)
        for r in results.collect():
            print(f"{r.model:30s} {r.column_name:30s} {r.test:20s} {r.failures}")
        if args.fail_on_checks:
            assert_passing(results)
        return 0

    from lakeweave.queries.metrics import service

    rows = service(spark, args.tables).load(json.loads(args.query))
    print(json.dumps(rows, default=str, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
