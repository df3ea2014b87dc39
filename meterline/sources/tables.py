"""Stored tables: files or a database."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.constants import VOLUME_TYPE
from meterline.plans.rules import with_rules
from meterline.schema import BALANCE_SCHEMA, BATCH_SCHEMA, CONSUMPTION_SCHEMA, RATED_SCHEMA, RUNS
from meterline.sinks.segments import read_live

#: The folder that Spark gives rows whose partition value is NULL.
UNDATED = "__HIVE_DEFAULT_PARTITION__"


def table_options(options: Mapping[str, str] | None, name: str) -> dict[str, str]:
    """Options for one of several tables: a database needs its name, files have it in their path."""
    return {**(options or {}), **({"dbtable": name} if options and "url" in options else {})}


def jdbc_options(
    url: str,
    dbtable: str,
    partition_column: str | None = None,
    lower_bound: str | None = None,
    upper_bound: str | None = None,
    num_partitions: int = 64,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Options of a database table.  With a partition column (number, date or time) it is read in parallel.

    ``properties`` carry user, password and driver, which callers take from their environment.
    """
    options = {"url": url, "dbtable": dbtable, "fetchsize": str(fetch_size), **properties}
    bounds = (partition_column, lower_bound, upper_bound)
    if any(value is not None for value in bounds):
        if any(value is None for value in bounds):
            raise ValueError("a partitioned read needs partition_column, lower_bound and upper_bound")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": lower_bound,
            "upperBound": upper_bound,
            "numPartitions": str(num_partitions),
        }
    return options


def read_table(
    spark: SparkSession, fmt: str = "parquet", options: Mapping[str, str] | None = None, path: str | None = None
) -> DataFrame:
    """Rated usage, invoice lines or any other stored table, in its stored schema."""
    reader = spark.read.format(fmt).options(**(options or {}))
    return reader.load() if path is None else reader.load(path)


def read_clients(
    spark: SparkSession, fmt: str = "parquet", options: Mapping[str, str] | None = None, path: str | None = None
) -> DataFrame:
    """The ids of all clients, each once."""
    return read_table(spark, fmt, options, path).select("user_id").distinct()


def read_batches(spark: SparkSession, path: str, period: str | None = None) -> DataFrame:
    """Rated usage that a streaming job wrote batch by batch (see :class:`meterline.sinks.BatchFolder`).

    With a period, only its folder and that of usage without time are listed and read.
    """
    folders = path if period is None else f"{path}/billing_period={{{period},{UNDATED}}}"
    return spark.read.schema(BATCH_SCHEMA).option("basePath", path).parquet(folders).drop("run", "batch_id")


def read_segments(spark: SparkSession, path: str, period: str | None = None) -> DataFrame:
    """Rated usage from the live segments of a stream (:class:`meterline.sinks.SegmentFolder`).

    With a period, only its partitions and those of usage without time.
    """
    wanted = None if period is None else {period, UNDATED}.__contains__
    return read_live(spark, path, StructType.fromDDL(RATED_SCHEMA), "billing_period", wanted)


def read_consumption(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Consumption per user, service and window: the partial sums of all batches added up.

    ``first`` and ``last``: days ``yyyy-MM-dd`` in which windows start; only their partitions are read, and no footer to find
    out what is in them.  Without bounds, usage without time is there, too.
    """

    def inside(day: str) -> bool:
        return (first is None and last is None) or (day != UNDATED and (first or day) <= day <= (last or day))

    parts = read_live(spark, path, StructType.fromDDL(CONSUMPTION_SCHEMA), "window_day", inside)
    return add_windows(parts).drop("window_day")


def add_windows(parts: DataFrame) -> DataFrame:
    """Partial sums of consumption added up."""
    kinds = dict(parts.dtypes)
    sums = [F.sum(name).cast(kinds[name]).alias(name) for name in ("n", "quantity", "cost")]
    return parts.groupBy("user_id", "record_type", "window_start", "window_end", "window_day").agg(*sums)


def add_balances(parts: DataFrame) -> DataFrame:
    """Partial balances added up."""
    kinds = dict(parts.dtypes)
    sums = [F.sum(name).cast(kinds[name]).alias(name) for name in ("n", "used")]
    return parts.groupBy("user_id", "record_type", "billing_period").agg(*sums)


def read_balances(
    spark: SparkSession, path: str, quotas: DataFrame | None = None, period: str | None = None
) -> DataFrame:
    """What clients have used of each service in each period so far; with quotas also the free units that are ``left``.

    Reads the few live segments of sums and none of the usage.
    """
    wanted = None if period is None else {period}.__contains__
    balances = add_balances(read_live(spark, path, StructType.fromDDL(BALANCE_SCHEMA), "billing_period", wanted))
    if quotas is None:
        return balances
    free = quotas.groupBy(F.col("service").alias("_service")).agg(F.sum("free_units").cast(VOLUME_TYPE).alias("free_units"))
    nothing = F.lit(0).cast(VOLUME_TYPE)
    left = F.greatest(nothing, F.coalesce("free_units", nothing) - F.col("used")).cast(VOLUME_TYPE)
    return with_rules(balances, free, {"_service": F.col("record_type")}).withColumn("left", left).drop("free_units")


def read_published_table(
    spark: SparkSession,
    name: str,
    period: str,
    fmt: str = "jdbc",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """A table of the last run of a period that :func:`meterline.sinks.publish_tables` finished."""
    runs = read_table(spark, fmt, table_options(options, f"{RUNS}"), path and f"{path}/{RUNS}")
    last = runs.where(F.col("period") == period).agg(F.max_by("run", "published_at").alias("run")).first()["run"]
    if last is None:
        raise LookupError(f"nothing published for {period}")
    table = read_table(spark, fmt, table_options(options, name), path and f"{path}/{name}")
    return table.where((F.col("period") == period) & (F.col("run") == last)).drop("period", "run")
