"""Command line for ``spark-submit``: run the monthly build.

    spark-submit --py-files portolan.zip -m portolan build \\
        --immigration s3a://in/i94/2016-04/ --immigration-format parquet \\
        --temperature s3a://in/temps.csv --demographics s3a://in/cities.csv \\
        --state-lookup s3a://in/state_codes.csv --country-lookup s3a://in/country_codes.csv \\
        --out s3a://out/ --database dw
"""

from __future__ import annotations

import argparse

from portolan.plans.build import Sources, build_warehouse
from portolan.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="portolan")
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", help="raw sources -> loaded and checked warehouse")
    build.add_argument("--immigration", required=True)
    build.add_argument("--immigration-format", default="parquet")
    build.add_argument("--immigration-option", action="append", default=[], metavar="NAME=VALUE",
                       help="an option of the arrivals reader; may be repeated")
    build.add_argument("--temperature", required=True)
    build.add_argument("--demographics", required=True)
    build.add_argument("--state-lookup", required=True)
    build.add_argument("--country-lookup", required=True)
    build.add_argument("--airport")
    build.add_argument("--out", required=True, help="output folder (shared storage)")
    build.add_argument("--database", required=True)
    build.add_argument("--debug-size", type=int, help="keep only this many arrival records")
    build.add_argument("--pieces", action="store_true", help="the arrivals are a piece of their months: merge them in by key")
    build.add_argument("--hive", action="store_true", help="keep the catalog in the cluster's metastore")
    args = parser.parse_args(argv)

    spark = build_session(master=None, shuffle_partitions=None, app="portolan-build", hive=args.hive)
    sources = Sources(immigration=args.immigration, temperature=args.temperature,
                      demographics=args.demographics, state_lookup=args.state_lookup,
                      country_lookup=args.country_lookup, airport=args.airport,
                      immigration_format=args.immigration_format,
                      immigration_options=dict(o.split("=", 1) for o in args.immigration_option))
    report = build_warehouse(spark, sources, args.out, args.database, args.debug_size, whole_months=not args.pieces)
    report.show(truncate=False)


if __name__ == "__main__":
    main()
