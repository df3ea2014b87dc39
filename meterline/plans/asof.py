"""The last rule of a key before a moment, by sorting usage and rules together.

Rules and usage of a key lie in one sorted sequence, and the last rule passed is carried forward: work grows with both, not
with their product, and neither side has to fit into memory.  Keys above ``hot_rows`` rows are cut into slices by time, as
for running totals (:mod:`meterline.plans.running`); each slice starts with the last rule of the slices before it.
"""

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.plans.running import HOT_ROWS, bounded, same_keys
from meterline.plans.shared_folder import written

ORDER = ["_at", "_side", "_tie"]


def _carried(rows: DataFrame, *parts: str) -> DataFrame:
    so_far = Window.partitionBy("_key", *parts).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_rule", F.last("_rule", ignorenulls=True).over(so_far))


def _sliced(rows: DataFrame, slices: int, n_keys: int) -> DataFrame:
    cut = rows.repartitionByRange(slices, "_key", *ORDER).withColumn("_slice", F.spark_partition_id())
    cut = written(cut, "asof-slices")
    last = F.max_by("_rule", F.struct(*ORDER)).alias("_last")
    ends = cut.where("_side = 0").groupBy("_key", "_slice").agg(last)
    # Slices without rules pass on what they were given.
    every = cut.select("_key", "_slice").distinct().join(ends, ["_key", "_slice"], "left")
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    given = every.select("_key", "_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_given"))
    given = bounded(written(given, "asof-given"), slices + n_keys)
    joined = _carried(cut, "_slice").join(given, ["_key", "_slice"], "left")
    return joined.withColumn("_rule", F.coalesce("_rule", "_given")).drop("_slice", "_given")


def as_of(
    usage: DataFrame,
    rules: DataFrame,
    key: str,
    usage_key: Column,
    at: str,
    start: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Usage with the values of the last rule of its key that starts at ``at`` or before: one row for each.

    ``rules``: the key, ``start`` (NULL: since ever) and values whose names do not occur in the usage, one row for a key and
    start.  Usage without key or time has no rule, but time-less usage those valid since ever.  ``usage`` has a
    ``record_id``, by which rows of one moment are cut apart.  Counts the rows of each key while the plan is built: give it
    stored usage.
    """
    values = [name for name in rules.columns if name not in (key, start)]
    kind = rules.select(F.struct(*values).alias("_rule")).schema["_rule"].dataType
    columns = usage.columns
    whole = usage.select(F.struct(*columns).alias("_row")).schema["_row"].dataType
    left = usage.select(
        usage_key.alias("_key"),
        F.col(at).alias("_at"),
        F.lit(1).alias("_side"),
        F.col("record_id").alias("_tie"),
        F.struct(*columns).alias("_row"),
        F.lit(None).cast(kind).alias("_rule"),
    )
    right = rules.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(start).alias("_at"),
        F.lit(0).alias("_side"),
        F.lit(None).cast("bigint").alias("_tie"),
        F.lit(None).cast(whole).alias("_row"),
        F.struct(*values).alias("_rule"),
    )
    both = left.unionByName(right)
    sizes = both.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    found = sizes.agg(F.count(F.lit(1)).alias("keys"), F.sum("_rows").alias("rows")).first()
    if found["keys"]:
        hot = bounded(written(sizes.select("_key"), "hot-keys"), found["keys"])
        ordinary = both.join(hot, same_keys(both, hot, ["_key"]), "left_anti")
        heavy = both.join(hot, same_keys(both, hot, ["_key"]), "left_semi")
        slices = ceil(found["rows"] / hot_rows)
        both = _carried(ordinary).unionByName(_sliced(heavy, slices, found["keys"]))
    else:
        both = _carried(both)
    return both.where("_side = 1").select("_row.*", *[F.col(f"_rule.{name}").alias(name) for name in values])
