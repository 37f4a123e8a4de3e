"""Run all queries over a folder of input tables.

    spark-submit ... -m palate  or  python -m palate --input DIR --output DIR
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from palate.plans.batch import TARGET_MOVIE, run_all
from palate.plans.workloads import ANOMALY_TAGS
from palate.sources import read_csv_tables, read_parquet_tables


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="palate", description="Run all queries.")
    parser.add_argument("--input", required=True, help="folder of the five tables")
    parser.add_argument("--output", required=True, help="folder for the results")
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--target", default=TARGET_MOVIE, help="movie id of the similarity queries")
    parser.add_argument("--top", type=int, default=10)
    parser.add_argument("--anomaly-tags", nargs="+", default=list(ANOMALY_TAGS))
    parser.add_argument("--mode", choices=["overwrite", "errorifexists"], default="overwrite")
    parser.add_argument("--quarantine", help="folder for the lines of CSV files that do not fit")
    parser.add_argument("--line-breaks", choices=["reject", "escape"], default="reject", help="what to do with those in texts")
    args = parser.parse_args(argv)
    if args.quarantine and args.format != "csv":
        parser.error("only CSV files have lines to set apart")
    spark = SparkSession.builder.appName("palate").getOrCreate()
    if args.format == "csv":
        tables = read_csv_tables(spark, args.input, args.quarantine)
    else:
        tables = read_parquet_tables(spark, args.input)
    written = run_all(
        tables,
        args.output,
        target_movie_id=args.target,
        k=args.top,
        anomaly_tags=args.anomaly_tags,
        mode=args.mode,
        line_breaks=args.line_breaks,
    )
    for name, path in written.items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
