"""Command line: ``python -m stratum`` (or ``spark-submit -m``-style launch).

    python -m stratum daily LANDING_DIR OUT_DIR [--as-of YYYY-MM-DD] [--encoding UTF-8]
    python -m stratum profile CSV_PATH OUT_DIR [--encoding ISO-8859-1] [--name listings]

``daily`` runs the gated pipeline from a landing folder holding the listings
and reviews CSVs and writes the layered tables under OUT_DIR. ``profile``
writes the long-format profile report of one CSV as a Parquet table. The
session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings are whatever the submitter configured.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stratum")
    sub = parser.add_subparsers(dest="command", required=True)
    daily = sub.add_parser("daily", help="gated bronze/silver/gold run from a CSV landing folder")
    daily.add_argument("landing")
    daily.add_argument("out")
    daily.add_argument("--as-of", default=None, help="run date for host_years_active (default: today)")
    daily.add_argument("--encoding", default="UTF-8")
    daily.add_argument("--single-line", action="store_true", help="the files hold no quoted line breaks")
    prof = sub.add_parser("profile", help="long-format profile report of one CSV")
    prof.add_argument("path")
    prof.add_argument("out")
    prof.add_argument("--encoding", default="UTF-8")
    prof.add_argument("--single-line", action="store_true", help="the file holds no quoted line breaks")
    prof.add_argument("--name", default="input")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"stratum-{args.command}").getOrCreate()
    if args.command == "daily":
        from stratum.plans.run import run_from_landing
        run_from_landing(spark, args.landing, args.out, as_of=args.as_of, encoding=args.encoding,
                         multiline=not args.single_line)
    else:
        from stratum.operators.cleanse import null_tokens
        from stratum.operators.lookup import city_dimension
        from stratum.operators.profile import profile_report
        from stratum.sources.csv import read_csv_named
        df = null_tokens(read_csv_named(spark, args.path, encoding=args.encoding,
                                        multiline=not args.single_line))
        report = profile_report(df, args.name, dim=city_dimension(spark))
        report.write.mode("overwrite").parquet(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
