"""Copies of records that arrived before anything that a stream still remembers."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.operators.mediate import payload_key
from meterline.plans.running import BROADCAST_ROWS, bounded
from meterline.plans.shared_folder import written
from meterline.sinks.segments import SegmentFolder, load, read_live

#: Parts of the index by the first byte of the digest.
PREFIXES = 256
INDEX_SCHEMA = "digest BINARY, prefix INT"


def with_digest(usage: DataFrame) -> DataFrame:
    """Adds the digest of the payload and its first byte."""
    named = usage.withColumn("digest", payload_key())
    return named.withColumn("prefix", F.conv(F.hex(F.substring("digest", 1, 1)), 16, 10).cast("int"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The digests of all records of finished batches: digest, prefix."""
    return read_live(spark, path, StructType.fromDDL(INDEX_SCHEMA), "prefix")


def known_digests(digests: DataFrame, index: DataFrame) -> DataFrame:
    """Those of ``digests`` (a written table: digest, prefix) that the index has.

    Digests are counted; up to a bound they are broadcast, and then only the parts of the index are read in which one of them
    can be: Spark prunes the index by the prefixes that it finds at run time.
    """
    few = bounded(digests, digests.limit(BROADCAST_ROWS + 1).count())
    sought = few.where(F.col("prefix").between(0, PREFIXES - 1))
    if few is not digests:
        sought = F.broadcast(sought)
    return index.join(sought.select("digest", "prefix"), ["prefix", "digest"], "left_semi").select("digest")


def dedup_against_history(usage: DataFrame, index: DataFrame) -> DataFrame:
    """The first arrival of every payload of ``usage`` that the index does not have, with its digest and prefix.

    Copies within ``usage`` collapse before the shuffle; it needs a ``record_id``.
    """
    row = F.struct(*usage.columns)
    first = with_digest(usage).groupBy("digest", "prefix").agg(F.min_by(row, "record_id").alias("_row"))
    first = written(first.select("digest", "prefix", "_row.*"), "first-arrivals")
    known = written(known_digests(first.select("digest", "prefix").distinct(), index), "known-digests")
    known = bounded(known, known.limit(BROADCAST_ROWS + 1).count())
    return first.join(known, "digest", "left_anti")


@dataclass(frozen=True)
class HistoryDedup:
    """``foreachBatch`` step before another writer: hands on what no batch before had, whenever that was.

    ``write`` must leave a repeated batch once, as :class:`meterline.sinks.SegmentFolder` does.  It comes first; then the batch's
    digests are added to the index at ``path``.  A batch that stops in between finds the index as it was, so it hands on the
    same records again.
    """

    path: str
    run: str
    write: Callable[[DataFrame, int], None]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if load(spark, self.path).covers(self.run, batch_id):
            return
        fresh = written(dedup_against_history(batch, read_index(spark, self.path)), "fresh")
        self.write(fresh.drop("digest", "prefix"), batch_id)
        SegmentFolder(self.path, self.run, "prefix")(fresh.select("digest", "prefix"), batch_id)
