"""Checks that a database would make on insert, and that a tariff needs before it is used."""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def key_violations(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once or have a NULL part, with their number of rows."""
    null_part = reduce(or_, [F.col(key).isNull() for key in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | null_part)


def tariff_gaps(tariff: DataFrame) -> DataFrame:
    """Tiers that do not start where the tier below ends (or at zero): gaps, overlaps and repeated tiers."""
    below = F.lag("tier_to").over(Window.partitionBy("service").orderBy("tier_from", F.col("tier_to").asc_nulls_last()))
    first = F.row_number().over(Window.partitionBy("service").orderBy("tier_from", F.col("tier_to").asc_nulls_last()))
    numbered = tariff.withColumns({"_below": below, "_first": first})
    expected = F.when(F.col("_first") == 1, F.lit(0)).otherwise(F.col("_below"))
    return numbered.where(~F.col("tier_from").eqNullSafe(expected)).drop("_below", "_first")
