"""Usage that is unusual for a client at that hour of the week."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions import charges
from meterline.operators.bill import billable
from meterline.plans.percentiles import write_histogram_percentiles
from meterline.plans.running import HOT_ROWS
from meterline.plans.shared_folder import written

#: A median absolute deviation times this is a standard deviation, if values are normal.
TO_DEVIATION = 1.4826
THRESHOLD = 6.0
#: Hours that a baseline needs, and the smallest deviation it is given, as a share of its median.
LEAST_HOURS, LEAST_SHARE = 4, 0.05

KEYS = ["user_id", "record_type", "season"]


def hour_of_week() -> Column:
    """0 is the hour after midnight on Monday."""
    return F.weekday("hour") * 24 + F.hour("hour")


def hourly_usage(rated: DataFrame) -> DataFrame:
    """Billed quantity by client, service and hour, with the ``season`` of the hour; usage without time has none."""
    timed = billable(rated).where(F.col("event_ts").isNotNull())
    hour = F.date_trunc("hour", "event_ts").cast("timestamp_ntz").alias("hour")
    hours = timed.select("user_id", "record_type", hour, charges.billed_quantity().alias("quantity"))
    sums = hours.groupBy("user_id", "record_type", "hour").agg(F.sum("quantity").cast("decimal(28,6)").alias("quantity"))
    return sums.withColumn("season", hour_of_week())


def _median(values: DataFrame, value: str, name: str, hot_rows: int) -> DataFrame:
    """The median of ``value`` by the keys from a histogram of it, and the number of values as ``n_<name>``."""
    histogram = values.groupBy(*KEYS, value).agg(F.count(F.lit(1)).alias("times"))
    return write_histogram_percentiles(histogram, KEYS, value, "times", {name: 0.5}, {f"n_{name}": F.sum("times")}, hot_rows)


def seasonal_baseline(hours: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """By client, service and season: number of hours, median quantity, and median absolute deviation from it.

    Both medians are exact and come from histograms, by running counts that survive one client with a third of all usage; no
    list of values is held.  ``hours`` is a written table.
    """
    medians = written(_median(hours, "quantity", "median", hot_rows), "medians")
    away = F.round(F.abs(F.col("quantity").cast("double") - F.col("median")), 6)
    apart = hours.join(medians, KEYS).withColumn("away", away)
    deviations = _median(apart, "away", "deviation", hot_rows)
    return medians.join(deviations.drop("n_deviation"), KEYS).withColumnRenamed("n_median", "hours")


def usage_anomalies(
    rated: DataFrame,
    threshold: float = THRESHOLD,
    least_hours: int = LEAST_HOURS,
    least_share: float = LEAST_SHARE,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Hours in which a client used far more or less of a service than in the same hour of other weeks.

    user_id, record_type, hour, quantity, hours, median, deviation, kind (``high`` or ``low``).  Far is more than ``threshold``
    deviations, 1.4826 times the median absolute one or ``least_share`` of the median, whichever is larger.  The median is hardly
    moved by the outliers themselves.  Hours of the week with fewer than ``least_hours`` values have no baseline.
    """
    hours = written(hourly_usage(rated), "hourly-usage")
    baseline = seasonal_baseline(hours, hot_rows).where(F.col("hours") >= least_hours)
    known = hours.join(written(baseline, "baseline"), KEYS)
    allowed = F.greatest(F.col("deviation") * TO_DEVIATION, F.col("median") * least_share) * threshold
    apart = F.col("quantity").cast("double") - F.col("median")
    kind = F.when(apart > allowed, "high").when(-apart > allowed, "low")
    found = known.withColumn("kind", kind).where(F.col("kind").isNotNull())
    return found.select("user_id", "record_type", "hour", "quantity", "hours", "median", "deviation", "kind")
