"""Run the pipeline from the command line (what a scheduled daily job calls).

    python -m tierwise run --orders DIR_OR_FILE --customers ... --products ... \\
        --database retail [--incremental] [--fail-on-error]
    python -m tierwise run --testdata /root/testdata/sf0.01 --database retail
    python -m tierwise health --database retail

The session comes from the environment (``spark-submit`` settings or the
cluster's defaults); ``spark.checkpoint.dir`` and ``spark.sql.warehouse.dir``
must name shared folders on a cluster.
"""

from __future__ import annotations

import argparse
import sys

from tierwise.session import get_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tierwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="bronze -> silver -> gold -> checks")
    run.add_argument("--database", default="tierwise")
    run.add_argument("--orders")
    run.add_argument("--customers")
    run.add_argument("--products")
    run.add_argument("--testdata", help="a directory of the TPC-H-like parquet tables")
    run.add_argument("--incremental", action="store_true",
                     help="landing arguments are folders; ingest only new files")
    run.add_argument("--calendar", nargs=2, metavar=("START", "END"))
    run.add_argument("--month-folders", action="store_true", help="fact folders by month, not day")
    run.add_argument("--reload-days", action="store_true",
                     help="write only the fact folders that changed; the KPI view reads sums per folder")
    run.add_argument("--history", action="store_true", help="keep every customer version, and its key in the fact")
    run.add_argument("--heavy-keys", action="store_true", help="deal lines of heavy customers and products over tasks")
    run.add_argument("--fresh-since", metavar="DAY", help="fail if the newest order is older")
    run.add_argument("--max-age-days", type=int, help="fail if the newest order is older")
    run.add_argument("--fail-on-error", action="store_true")
    health = sub.add_parser("health", help="row counts per table")
    health.add_argument("--database", default="tierwise")
    args = ap.parse_args(argv)

    from tierwise.plans import pipeline as pl

    spark = get_session()
    if args.cmd == "health":
        src = pl.Sources(None, None, None, None, None, None)
        pl.Pipeline(spark, src, database=args.database).health().show(50, truncate=False)
        return 0
    if args.testdata:
        src = pl.testdata_sources(spark, args.testdata)
    elif args.incremental:
        src = pl.incremental_landing_sources(spark, args.orders, args.customers, args.products)
    else:
        src = pl.landing_sources(spark, args.orders, args.customers, args.products)
    p = pl.Pipeline(spark, src, database=args.database,
                    calendar=tuple(args.calendar) if args.calendar else None,
                    fact_grain="month" if args.month_folders else "day",
                    reload="days" if args.reload_days else "full", history=args.history,
                    heavy_keys=args.heavy_keys)
    results = p.run(args.fail_on_error, args.fresh_since, args.max_age_days)
    results.orderBy("status", "check").show(50, truncate=False)
    p.health().show(50, truncate=False)
    p.dropped().show(truncate=False)  # facts the KPI view's inner joins leave out
    print(p.metrics)
    return 0


if __name__ == "__main__":
    sys.exit(main())
