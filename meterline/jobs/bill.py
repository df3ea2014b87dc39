"""Bills a period: summary and lines, published together, and their CSV and document exports."""

import argparse
from dataclasses import fields

from meterline.jobs.options import add_endpoint, options
from meterline.operators.documents import invoice_documents
from meterline.operators.rate import from_rated_table
from meterline.plans.pipeline import Rules, bill_period, published_tables
from meterline.session import session, size_shuffles
from meterline.sinks import attempts_of, export_csv, publish_tables, read_published, write_documents
from meterline.sources import read_batches, read_segments, read_table

RULE_TABLES = [field.name for field in fields(Rules)]


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_endpoint(parser, "rated", "segments")
    parser.add_argument("--period", required=True, help="such as 2025-04")
    parser.add_argument("--path", required=True, help="folder of the billing tables")
    parser.add_argument("--all-usage", action="store_true", help="bill all usage under the period's label")
    parser.add_argument("--keep-copies", action="store_true", help="charge every copy of a record")
    parser.add_argument("--attempts", action="store_true", help="the rating job appended the table: read which attempts finished")
    parser.add_argument("--input-gb", type=float, help="size of the period's usage, for sources that do not tell it")
    for name in RULE_TABLES:
        parser.add_argument(f"--{name}", help=f"Parquet table of the {name} rules")
    parser.add_argument("--csv", help="folder for the lines as CSV")
    parser.add_argument("--single-csv-file", action="store_true")
    parser.add_argument("--documents", help="folder for invoice documents")
    parser.add_argument("--document-format", choices=("json", "xml"), default="json")
    parser.add_argument("--database-option", action="append", default=[], metavar="KEY=VALUE")
    args = parser.parse_args(arguments)
    spark = session("billing")
    period = None if args.all_usage else args.period
    if args.rated_format == "segments":
        rated = read_segments(spark, args.rated_path, period)
    elif args.rated_format == "batches":
        rated = read_batches(spark, args.rated_path, period)
    else:
        place = options(args.rated_option), args.rated_path
        table = read_table(spark, args.rated_format, *place)
        attempts = read_table(spark, args.rated_format, *attempts_of(*place)) if args.attempts else None
        rated = from_rated_table(table, period, attempts)
    size_shuffles(rated, args.input_gb)
    given = {name: spark.read.parquet(path) for name in RULE_TABLES if (path := getattr(args, name))}
    rules = Rules(**given) if given else None
    # Streamed usage may hold copies that arrived further apart than stream state reaches back.
    run = bill_period(
        rated, args.path, args.period, period_filter=not args.all_usage, dedup=not args.keep_copies, rules=rules
    )
    tables = {name: read_published(spark, args.path, name, args.period) for name in published_tables(rules)}
    summary, lines = tables["billing_summary"], tables["invoice_lines"]
    if args.database_option:
        publish_tables(tables, args.period, run, "jdbc", options(args.database_option))
    if args.csv:
        export_csv(lines, args.csv, args.single_csv_file)
    if args.documents:
        pages = invoice_documents(summary, lines, fees=tables.get("invoice_fees"))
        write_documents(pages, args.documents, args.document_format)


if __name__ == "__main__":
    main()
