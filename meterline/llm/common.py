"""Helpers shared by the text operators."""

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.plans.shared_folder import fresh_path

#: A word: everything but the space and the control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a table of short rows (a few hundred bytes at most) that may be sent to every task.
BROADCAST_ROWS = 50_000


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors, as ``--py-files`` does, unless the session's context already has it.

    Functions in tasks refer to the package by name.  Spark serves the archive from the driver, which deletes it at its end.
    """
    context = spark.sparkContext
    if getattr(context, "_meterline_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="meterline-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/meterline_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    context._meterline_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a Parquet table in the shared folder: computed once, and not lost with an executor."""
    path = fresh_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """``df``, a table that is already written, with a broadcast hint if its counted rows allow it."""
    few = df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(df) if few else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """All words of a text; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def bucket(key: Column, buckets: int) -> Column:
    """``crc32(key as text) mod buckets``: the fixed split into training and held-out rows; NULL counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % buckets


def smallest_hashes(rows: DataFrame, n: int, *columns: str) -> DataFrame:
    """(*columns, hash): the rows with the ``n`` smallest hashes of the columns, equal rows once.

    A bounded sample that does not depend on the partitions.  Only hashes are ranked; the rows are then picked by the
    largest of them, so that no task or shuffle holds more texts than the sample has.
    """
    hashed = rows.select(*columns, F.xxhash64(*columns).alias("hash"))
    most = hashed.select("hash").distinct().orderBy("hash").limit(n).agg(F.max("hash")).first()[0]
    picked = hashed.where(F.col("hash") <= F.lit(most).cast("bigint"))
    return picked.groupBy("hash").agg(*[F.first(name).alias(name) for name in columns])


def likely_smallest(hashed: Column, group: Column, n: int, sizes: dict) -> Column:
    """Whether a hash can be among the ``n`` smallest of its group, whose number of different hashes is in ``sizes``.

    Hashes spread evenly, so the ``n`` smallest of many lie in a known part of their range, but for a chance that
    the margin makes negligible.  What is then ranked has about ``2 n`` rows a group, however many rows there are.
    """
    least = F.lit(True)
    for name, size in sizes.items():
        share = (2 * n + 100) / max(size, 1)
        if share < 1:
            limit = F.lit(int(-(2**63) + share * 2**64)).cast("bigint")
            least = F.when(group == name, hashed <= limit).otherwise(least)
    return least


def smallest_hashes_by(rows: DataFrame, group: str, n: int, *columns: str) -> DataFrame:
    """(group, *columns, hash): the same for each group, which is not NULL.  Repeated rows count once throughout."""
    hashed = rows.select(F.col(group).alias("group"), *columns, F.xxhash64(group, *columns).alias("hash"))
    different = written(hashed.select("group", "hash").distinct(), "sample-hashes")
    sizes = {row["group"]: row["count"] for row in different.groupBy("group").count().collect()}
    ranked = different.where(likely_smallest(F.col("hash"), F.col("group"), n, sizes))
    rank = F.row_number().over(Window.partitionBy("group").orderBy("hash"))
    limits = ranked.withColumn("rank", rank).where(F.col("rank") <= n)
    limits = small(written(limits.groupBy("group").agg(F.max("hash").alias("most")), "sample-limits"))
    picked = hashed.join(limits, "group").where(F.col("hash") <= F.col("most"))
    return picked.groupBy("group", "hash").agg(*[F.first(name).alias(name) for name in columns])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(rows: DataFrame, group: str, *order: Column) -> DataFrame:
    """The rows with ``pos``, their number in their group from 0, and ``n``, the rows of the group.

    ``rows`` is a written table.  It is dealt out by the whole order, then by a number of each row, so a group with a third
    of all rows, or one row repeated as often, fills as many partitions as it needs.  A row's number is its place in the
    sorted partition plus the rows of its group in the partitions before; only the latter, one row for each group and
    partition, are summed up.  Rows equal in group and order are numbered in any order.  ``group`` is not NULL.
    """
    spread = rows.withColumn("_spread", F.monotonically_increasing_id())
    dealt = spread.repartitionByRange(partitions(rows.sparkSession), F.col(group), *order, F.col("_spread"))
    dealt = dealt.sortWithinPartitions(F.col(group), *order, F.col("_spread")).drop("_spread")
    placed = written(dealt.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_slice", F.shiftright("_at", 33))
    slices = placed.groupBy(group, "_slice").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select(
        F.col(group),
        "_slice",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("n"),
    )
    joined = placed.join(small(written(starts, "starts")), [group, "_slice"])
    return joined.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_slice", "_shift")
