"""Session settings the jobs are written for."""

from math import ceil

from pyspark.sql import DataFrame, SparkSession

PARTITION_BYTES = 256_000_000
#: Sources without statistics report the largest number there is.
UNKNOWN_BYTES = 1 << 62
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
    # Looking up the Python line of every column expression takes longer than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app_name: str, **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` (as ``**{"spark.key": "value"}``) take precedence."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def input_bytes(df: DataFrame) -> int | None:
    """What Spark's statistics say about the size of all that ``df`` reads; None where a source has no size."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < UNKNOWN_BYTES else None


def size_shuffles(df: DataFrame, input_gb: float | None = None) -> int:
    """Sets and returns a number of shuffle partitions of about 256 MB of input each.

    The size comes from the statistics of ``df``; ``input_gb`` is for sources that have none, such as a database.
    Adaptive execution merges partitions that turn out small but cannot split those of an aggregation, so a large
    input needs a large number from the start.
    """
    size = input_gb * 1e9 if input_gb else input_bytes(df) or 0
    partitions = max(200, ceil(size / PARTITION_BYTES))
    df.sparkSession.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions
