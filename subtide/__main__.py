"""``python -m subtide mrr data/ --format csv``: show one report over a folder of tables.

``python -m subtide write_checked data/ --output out/ --tables leads --sort-by leads=created_date,lead_id`` copies
tables whose quality checks pass. ``python -m subtide malformed_values data/`` counts what does not fit the columns of CSV tables.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.plans.reports import CHECKS, REPORTS, displayed, malformed_values, run_report, write_checked_tables
from subtide.session import SETTINGS


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="subtide", description="Subscription analytics reports.")
    parser.add_argument("report", choices=[*sorted(REPORTS), "malformed_values", "write_checked"])
    parser.add_argument("data", help="folder with the tables")
    parser.add_argument("--format", choices=["csv", "parquet"], default="parquet")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="report date (default: today)")
    parser.add_argument("--rows", type=int, help="show only so many rows (default: all)")
    parser.add_argument("--pretty", action="store_true", help="show revenue in dollars and percentages with their sign")
    parser.add_argument("--output", help="write to this folder instead of showing: a report as CSV, checked tables as Parquet")
    parser.add_argument("--multi-line", action="store_true", help="CSV fields may hold line breaks")
    parser.add_argument("--bad-values", choices=["fail", "null"], default="fail", help="CSV values that do not fit their column")
    parser.add_argument("--tables", nargs="+", choices=list(CHECKS), help="what write_checked copies (default: all)")
    parser.add_argument("--sort-by", nargs="+", default=[], metavar="TABLE=COLUMN,...", help="order of the rows that write_checked writes")
    parser.add_argument("--partition-by", nargs="+", default=[], metavar="TABLE=COLUMN", help="date whose days get a folder each in what write_checked writes")
    parser.add_argument("--bucket-by", nargs="+", default=[], metavar="TABLE=COLUMN:N", help="key and number of buckets of what write_checked writes")
    options = parser.parse_args(arguments)
    if options.report == "write_checked" and not options.output:
        parser.error("write_checked needs --output")

    builder = SparkSession.builder.appName("subtide")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    reading = {"multi_line": options.multi_line, "bad_values": options.bad_values}
    if options.report == "write_checked":
        sort_by = {table: columns.split(",") for table, _, columns in (entry.partition("=") for entry in options.sort_by)}
        partition_by = dict(entry.split("=", 1) for entry in options.partition_by)
        bucket_by = {table: (column, int(n)) for table, _, key in (entry.partition("=") for entry in options.bucket_by) for column, _, n in [key.partition(":")]}
        layout = {"partition_by": partition_by, "bucket_by": bucket_by}
        for path in write_checked_tables(spark, options.data, options.output, options.tables, sort_by, options.as_of, options.format, **layout, **reading):
            print(path)
        return
    if options.report == "malformed_values":
        result = malformed_values(spark, options.data, options.tables, options.multi_line)
    else:
        result = run_report(options.report, spark, options.data, options.format, options.as_of, **reading)
    if options.output:
        result.write.mode("overwrite").option("header", True).csv(options.output)
    else:
        print(options.report.upper())
        result = displayed(result) if options.pretty else result
        if options.rows is None:
            print_all(result)
        else:
            result.show(options.rows, truncate=False)


def print_all(result: DataFrame) -> None:
    """Every row on the screen, a partition of the result at a time: a first pass finds how wide the columns are, and
    only one partition's rows are ever here."""
    texts = result.select(*[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("NULL")).alias(n) for n in result.columns])
    widths = texts.agg(*[F.max(F.length(F.col(f"`{n}`"))).alias(n) for n in result.columns]).first()
    wide = [max(3, len(n), widths[k] or 0) for k, n in enumerate(result.columns)]
    rule = f"+{'+'.join('-' * w for w in wide)}+"
    lines = [rule, f"|{'|'.join(n.rjust(w) for n, w in zip(result.columns, wide, strict=True))}|", rule]
    print("\n".join(lines))
    for row in texts.toLocalIterator():
        print(f"|{'|'.join(v.ljust(w) for v, w in zip(row, wide, strict=True))}|")
    print(rule)


if __name__ == "__main__":
    main()
