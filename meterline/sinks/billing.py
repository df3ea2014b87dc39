"""Runs of a billing period: their tables become visible together."""

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.schema import RUNS
from meterline.sinks.tables import write_table
from meterline.sources.tables import table_options


def new_run() -> str:
    return uuid.uuid4().hex


def run_path(path: str, table: str, period: str, run: str) -> str:
    return f"{path}/{table}/period={period}/run={run}"


def record_run(spark: SparkSession, path: str, period: str, run: str) -> None:
    """Makes a run, all of whose tables are written, the one that readers of the period see."""
    _finished(spark, period, run).write.mode("append").parquet(f"{path}/runs")


def publish_tables(
    tables: Mapping[str, DataFrame],
    period: str,
    run: str,
    fmt: str = "jdbc",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> None:
    """Appends the tables of a run to a database (or to files below ``path``), and then marks the run as finished.

    Rows carry ``period`` and ``run``.  Readers take those of the last finished run
    (:func:`meterline.sources.read_published_table`), so billing a period again replaces it, and a run that fails
    half-way shows nothing.
    """
    for name, table in tables.items():
        marked = table.withColumns({"period": F.lit(period), "run": F.lit(run)})
        write_table(marked, fmt, table_options(options, name), path and f"{path}/{name}")
    spark = next(iter(tables.values())).sparkSession
    write_table(_finished(spark, period, run), fmt, table_options(options, RUNS), path and f"{path}/{RUNS}")


def _finished(spark: SparkSession, period: str, run: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(period).alias("period"), F.lit(run).alias("run"), F.current_timestamp().alias("published_at")
    )


def read_published(spark: SparkSession, path: str, table: str, period: str) -> DataFrame:
    """A table of the last published run of ``period`` (:func:`meterline.plans.pipeline.bill_period`)."""
    runs = spark.read.parquet(f"{path}/runs").where(F.col("period") == period)
    last = runs.agg(F.max_by("run", "published_at").alias("run")).first()["run"]
    if last is None:
        raise LookupError(f"nothing published for {period}")
    return spark.read.parquet(run_path(path, table, period, last))
