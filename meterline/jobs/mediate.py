"""Splits a stream of raw records into clean and dirty ones."""

import argparse

from meterline.jobs.options import add_endpoint, add_streaming, options, run_observed, trigger
from meterline.session import session
from meterline.sources import stream_raw
from meterline.streaming import start_mediation


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_endpoint(parser, "source", "kafka")
    add_endpoint(parser, "sink", "kafka")
    parser.add_argument("--clean-topic", default="clean_records")
    parser.add_argument("--dirty-topic", default="dirty_records")
    parser.add_argument("--dedup-delay", help="leave out copies that arrive within this time, such as '7 days'")
    add_streaming(parser)
    args = parser.parse_args(arguments)
    spark = session("mediation")
    raw = stream_raw(spark, args.source_format, options(args.source_option), args.source_path)

    def start():
        return start_mediation(
            raw,
            args.sink_format,
            options(args.sink_option),
            args.checkpoint,
            args.sink_path,
            args.clean_topic,
            args.dirty_topic,
            trigger(args),
            dedup_delay=args.dedup_delay,
        )

    run_observed(spark, args, start)


if __name__ == "__main__":
    main()
