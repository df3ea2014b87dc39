"""Running totals by key that do not put a hot key into one task.

A window partitioned by key sorts all rows of a key in one task.  That is the best plan for ordinary keys and
the wrong one for a client that holds a third of all usage.  Keys above ``hot_rows`` rows are therefore
range-partitioned by their full order into slices of about ``hot_rows`` rows; each slice is totalled by itself
and shifted by the total of the slices before it.  The result is the same for every key size.

:func:`write_running_totals` runs jobs while the plan is built: it counts the rows of each key, and if one is hot it
writes that key's rows below the shared folder.  Give it stored rows; from others they would be computed for each job.
"""

from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.plans.shared_folder import written

#: Rows of one key that a single task may sort: some hundred MB of usage lines.
HOT_ROWS = 2_000_000
#: Rows of keys or slice totals that are sent to every task; at some 100 bytes each about 20 MB.
BROADCAST_ROWS = 200_000


def same_keys(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(and_, [left[n].eqNullSafe(right[n]) for n in names])


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast side only if its known row bound allows it; otherwise Spark joins it by shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _windowed(df: DataFrame, keys: list[str], order: list[str], totals: dict[str, Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({name: F.sum(value).over(window) for name, value in totals.items()})


def _sliced(
    df: DataFrame, keys: list[str], order: list[str], totals: dict[str, Column], slices: int, n_keys: int
) -> DataFrame:
    columns = df.columns
    # The slice must not change between its two uses below, so the sliced rows are written first.
    rows = written(
        df.withColumns({f"_in_{name}": value for name, value in totals.items()})
        .repartitionByRange(slices, *keys, *order)
        .withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = rows.groupBy(*keys, "_slice").agg(*[F.sum(f"_in_{name}").alias(name) for name in totals])
    before = per_slice.select(
        *keys, "_slice", *[F.sum(name).over(earlier).alias(f"_before_{name}") for name in totals]
    )
    inside = _windowed(rows, [*keys, "_slice"], order, {f"_own_{n}": F.col(f"_in_{n}") for n in totals})
    # A slice border lies inside at most one key, so there are fewer slice totals than slices plus keys.
    joined = inside.join(bounded(before, slices + n_keys), same_keys(inside, before, [*keys, "_slice"]), "left")
    shifted = [
        F.when(F.col(f"_before_{n}").isNull(), F.col(f"_own_{n}"))
        .otherwise(F.col(f"_own_{n}") + F.col(f"_before_{n}"))
        .alias(n)
        for n in totals
    ]
    return joined.select(*[inside[name] for name in columns], *shifted)


def with_previous(
    df: DataFrame, keys: list[str], order: list[str], previous: dict[str, str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Adds, per entry of ``previous`` (output name -> column), the column's value in the key's row before, or NULL.

    ``order`` must be a total order within a key.  Hot keys are sliced as for running totals; the first row of a slice gets the
    values of the last row of the slice before.
    """
    columns = df.columns

    def lagged(rows: DataFrame, *parts: str) -> DataFrame:
        window = Window.partitionBy(*keys, *parts).orderBy(*order)
        return rows.withColumns({name: F.lag(column).over(window) for name, column in previous.items()})

    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    found = sizes.agg(F.count(F.lit(1)).alias("keys"), F.sum("_rows").alias("rows")).first()
    if not found["keys"]:
        return lagged(df)
    hot = bounded(written(sizes.select(*keys), "hot-keys"), found["keys"])
    ordinary = lagged(df.join(hot, same_keys(df, hot, keys), "left_anti"))
    slices = ceil(found["rows"] / hot_rows)
    rows = df.join(hot, same_keys(df, hot, keys), "left_semi").repartitionByRange(slices, *keys, *order)
    rows = written(rows.withColumn("_slice", F.spark_partition_id()), "slices")
    last = F.max_by(F.struct(*[F.col(column).alias(name) for name, column in previous.items()]), F.struct(*order))
    ends = rows.groupBy(*keys, "_slice").agg(last.alias("_last"), F.min(F.struct(*order)).alias("_first"))
    before = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slice"))
    ends = bounded(written(ends.withColumn("_last", before), "slice-ends"), slices + found["keys"])
    inside = lagged(rows, "_slice")
    joined = inside.join(ends, same_keys(inside, ends, [*keys, "_slice"]), "left")
    is_first = F.struct(*[inside[name] for name in order]) == F.col("_first")
    given = [F.when(is_first, F.col(f"_last.{name}")).otherwise(inside[name]).alias(name) for name in previous]
    return ordinary.unionByName(joined.select(*[inside[name] for name in columns], *given))


def write_running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds, per entry of ``totals``, the sum of its value over the key's rows up to and including this one.

    ``order`` must be a total order within a key, and values must not be NULL.  One narrow, map-side combined
    count, run at once, finds the hot keys; without any, the result is one plain window.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    found = sizes.agg(F.count(F.lit(1)).alias("keys"), F.sum("_rows").alias("rows")).first()
    if not found["keys"]:
        return _windowed(df, keys, order, totals)
    hot = bounded(written(sizes.select(*keys), "hot-keys"), found["keys"])
    ordinary = df.join(hot, same_keys(df, hot, keys), "left_anti")
    heavy = df.join(hot, same_keys(df, hot, keys), "left_semi")
    slices = ceil(found["rows"] / hot_rows)
    return _windowed(ordinary, keys, order, totals).unionByName(
        _sliced(heavy, keys, order, totals, slices, found["keys"])
    )
