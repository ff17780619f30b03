"""Run the pipeline as a Spark application.

    python -m ledgerlake --csv /landing             # seven headered CSV extracts
    python -m ledgerlake --driver /data/sf0.1       # the driver's Parquet tables
    python -m ledgerlake --jdbc jdbc:postgresql://host/db --csv /landing
                                                    # ERP tables over JDBC, transactions from CSV

With spark-submit, the master, executors and warehouse come from the
cluster; ``--local N`` runs on N local cores instead.
"""

from __future__ import annotations

import argparse
import json

from ledgerlake.schemas import CSV_TABLES, RELATIONAL_TABLES


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerlake")
    parser.add_argument("--csv", help="folder with <table>.csv extracts")
    parser.add_argument("--driver", help="folder with the driver's <table>.parquet files")
    parser.add_argument("--jdbc", help="JDBC URL of the ERP source (credentials from "
                                       "SOURCE_DB_USER / SOURCE_DB_PASSWORD)")
    parser.add_argument("--jdbc-partitions", type=int, default=16,
                        help="range queries per table, by its numeric key (default 16)")
    parser.add_argument("--single-line-csv", action="store_true",
                        help="no quoted field holds a newline: the files aren't searched for them")
    parser.add_argument("--dashboards", metavar="FOLDER",
                        help="then write every dashboard query over the marts as Parquet there")
    parser.add_argument("--local", type=int, help="run on this many local cores")
    args = parser.parse_args(argv)
    if not (args.csv or args.driver):
        parser.error("give --csv or --driver")

    from ledgerlake.plans.dashboards import dashboards_from_marts
    from ledgerlake.plans.pipeline import run_pipeline
    from ledgerlake.session import build_session
    from ledgerlake.sources.crosswalk import RawLayer
    from ledgerlake.sources.readers import (
        credentials_from_env,
        key_ranges,
        read_jdbc_table,
        read_raw_csv,
    )

    spark = build_session(f"local[{args.local}]" if args.local else None)
    if args.driver:
        raw = RawLayer(spark, args.driver).as_dict()
    elif args.jdbc:
        creds = credentials_from_env()
        raw = {t: read_jdbc_table(spark, args.jdbc, t, key_ranges(
            spark, args.jdbc, t, args.jdbc_partitions, **creds), **creds) for t in RELATIONAL_TABLES}
        raw.update(read_raw_csv(spark, args.csv, CSV_TABLES, not args.single_line_csv))
    else:
        raw = read_raw_csv(spark, args.csv, multiline=not args.single_line_csv)
    result = run_pipeline(spark, raw)
    if args.dashboards:
        for name, card in dashboards_from_marts(spark).items():
            card.write.mode("overwrite").parquet(f"{args.dashboards.rstrip('/')}/{name}")
    print(json.dumps({"raw_rows": result.raw_counts, "mart_rows": result.mart_counts,
                      "failed_checks": result.failed_checks}, indent=2))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
