"""Exact interpolated percentiles without a per-group value list in memory."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.plans.running import HOT_ROWS, bounded, write_running_totals
from meterline.plans.shared_folder import written


def write_histogram_percentiles(
    histogram: DataFrame,
    keys: list[str],
    value: str,
    count: str,
    shares: dict[str, float],
    extra: dict[str, Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per key with a column per entry of ``shares`` (output name -> share between 0 and 1).

    ``histogram`` holds each value of a key once with its count.  The count runs up in value order; the values
    at the two ranks around ``share * (n - 1)`` are picked and interpolated.  ``extra`` aggregates are taken along
    from the same histogram.  A NULL value counts there, but has no rank.

    The histogram, far smaller than the usage it was counted from, and the sizes of its groups are written below the
    shared folder while the plan is built.
    """
    ranked_count = F.when(F.col(value).isNull(), F.lit(0)).otherwise(F.col(count)).cast("bigint")
    histogram = written(histogram.withColumn("_counted", ranked_count), "histogram")
    running = write_running_totals(histogram, keys, [value], {"_upto": F.col("_counted")}, hot_rows)
    sizes = written(histogram.groupBy(*keys).agg(F.sum("_counted").alias("_n")), "sizes")
    sizes = bounded(sizes, sizes.count())
    matches = [F.col(f"h.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    ranked = running.alias("h").join(sizes.alias("s"), matches)

    def at(rank):
        inside = (F.col("_upto") > rank) & (F.col("_upto") - F.col("_counted") <= rank)
        return F.max(F.when(inside, F.col(value).cast("double")))

    picked = ranked.groupBy(*[F.col(f"h.{k}").alias(k) for k in keys]).agg(
        F.max("_n").alias("_n"),
        *[column.alias(name) for name, column in extra.items()],
        *[
            pick
            for name, share in shares.items()
            for pick in (
                at(F.floor((F.col("_n") - 1) * share)).alias(f"_low_{name}"),
                at(F.ceil((F.col("_n") - 1) * share)).alias(f"_high_{name}"),
            )
        ],
    )

    def between(name, share):
        position = (F.col("_n") - 1) * share
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        return F.round(low + (high - low) * (position - F.floor(position)), 6).alias(name)

    return picked.select(*keys, *extra, *[between(name, share) for name, share in shares.items()])
