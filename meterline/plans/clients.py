"""Usage laid out by client, so that everything billing does with a client's records needs no further exchange.

Totals, line numbers and quotas all work on the records of one payer.  The usage is exchanged on the payer once and written in
buckets; Spark knows that a bucket holds all records of its payers, so sums and windows over (payer, period, ...) read it
as it lies.  A payer above ``hot_rows`` records would make one bucket as large as it is; such payers stay out of the buckets,
and their usage is worked on in slices (:mod:`meterline.plans.running`).
"""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import charges
from meterline.plans.running import HOT_ROWS, bounded
from meterline.plans.shared_folder import fresh_path, written

#: Spark refuses tables of more buckets.
MOST_BUCKETS = 100_000


def bucketed(usage: DataFrame, name: str, buckets: int | None = None) -> DataFrame:
    """``usage``, with its ``payer``, written in buckets by it and read back.  Rows that already lie so are not exchanged.

    The table is known to this session alone, under a name of its own; its files lie below the shared folder.
    """
    spark = usage.sparkSession
    buckets = buckets or min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    table = f"meterline_{name}_{uuid.uuid4().hex}"
    writer = usage.repartition(buckets, "payer").write.bucketBy(buckets, "payer").sortBy("payer")
    writer.option("path", fresh_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def write_by_client(usage: DataFrame, hot_rows: int = HOT_ROWS, buckets: int | None = None) -> list[DataFrame]:
    """Usage that has a payer, with the column ``payer``, in one or two parts that share no payer.

    The first is bucketed by payer; the second, if there is one, holds all usage of hot payers as it is stored.  ``usage`` is
    stored: its payers are counted, and the parts written, while the plan is built.
    """
    owned = usage.withColumn("payer", charges.paying_user()).where(F.col("payer").isNotNull())
    sizes = owned.groupBy("payer").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    sizes = written(sizes.select("payer"), "hot-payers")
    n = sizes.count()
    if not n:
        return [bucketed(owned, "clients", buckets)]
    hot = bounded(sizes, n)
    ordinary = bucketed(owned.join(hot, "payer", "left_anti"), "clients", buckets)
    return [ordinary.select(*owned.columns), owned.join(hot, "payer", "left_semi").select(*owned.columns)]
