"""Job arguments that several jobs share."""

import argparse
import os
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from meterline.streaming import BatchMetrics, await_all


def options(pairs: list[str]) -> dict[str, str]:
    """``key=value`` pairs; ``key=$NAME`` takes the value from the environment, for credentials."""
    result = {}
    for pair in pairs:
        key, separator, value = pair.partition("=")
        if not separator:
            raise argparse.ArgumentTypeError(f"expected key=value, got {pair}")
        result[key] = os.environ[value[1:]] if value.startswith("$") else value
    return result


def add_endpoint(parser: argparse.ArgumentParser, name: str, default_format: str) -> None:
    """``--<name>-format``, ``--<name>-path`` and repeated ``--<name>-option key=value``."""
    parser.add_argument(f"--{name}-format", default=default_format)
    parser.add_argument(f"--{name}-path")
    parser.add_argument(f"--{name}-option", action="append", default=[], metavar="KEY=VALUE")


def trigger(args: argparse.Namespace) -> dict[str, object] | None:
    if args.once:
        return {"availableNow": True}
    return {"processingTime": args.every} if args.every else None


def run_observed(spark: SparkSession, args: argparse.Namespace, start: Callable[[], StreamingQuery]) -> None:
    """Starts a query and waits for its end, and with ``--metrics`` stores the counts of its batches."""
    if not args.metrics:
        return await_all([start()])
    metrics = BatchMetrics(spark, args.metrics)
    spark.streams.addListener(metrics)
    try:
        query = start()
        await_all([query])
        metrics.await_batch(query)
    finally:
        spark.streams.removeListener(metrics)


def add_streaming(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--checkpoint", required=True, help="folder that all executors share")
    parser.add_argument("--every", help="time between micro-batches, such as '30 seconds'")
    parser.add_argument("--metrics", help="folder for the counts of each batch")
    parser.add_argument("--once", action="store_true", help="process what is there and stop")
