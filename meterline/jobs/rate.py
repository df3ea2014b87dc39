"""Prices a stream of clean records."""

import argparse

from meterline.jobs.options import add_endpoint, add_streaming, options, run_observed, trigger
from meterline.session import session
from meterline.sinks import BatchFolder, BatchTable, SegmentFolder
from meterline.sources import stream_clean
from meterline.streaming import start_rating


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_endpoint(parser, "source", "kafka")
    add_endpoint(parser, "rated", "segments")
    parser.add_argument("--run", required=True, help="name of this checkpoint's output; change both together")
    add_streaming(parser)
    args = parser.parse_args(arguments)
    spark = session("rating")
    clean = stream_clean(spark, args.source_format, options(args.source_option), args.source_path)
    if args.rated_format == "segments":
        write = SegmentFolder(args.rated_path, args.run)
    elif args.rated_format == "batches":
        write = BatchFolder(args.rated_path, args.run)
    else:
        write = BatchTable(args.run, args.rated_format, options(args.rated_option), args.rated_path)
    run_observed(spark, args, lambda: start_rating(clean, write, args.checkpoint, trigger(args)))


if __name__ == "__main__":
    main()
