"""Sums consumption per user from a stream of clean records."""

import argparse

from meterline.jobs.options import add_endpoint, add_streaming, options, trigger
from meterline.operators.mediate import parse_usage
from meterline.operators.rate import rate_usage
from meterline.schema import CANONICAL
from meterline.session import session
from meterline.sources import stream_clean
from meterline.streaming import await_all, start_consumption


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    add_endpoint(parser, "source", "kafka")
    parser.add_argument("--path", required=True, help="folder of the sums")
    parser.add_argument("--run", required=True, help="name of this checkpoint's output; change both together")
    parser.add_argument("--width", default="1 day", help="length of a window")
    add_streaming(parser)
    args = parser.parse_args(arguments)
    spark = session("consumption")
    clean = stream_clean(spark, args.source_format, options(args.source_option), args.source_path)
    usage = rate_usage(parse_usage(clean).select(*CANONICAL))
    await_all([start_consumption(usage, args.path, args.run, args.checkpoint, args.width, trigger(args))])


if __name__ == "__main__":
    main()
