"""Pricing of usage records."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from meterline import constants as c
from meterline.functions import charges, records
from meterline.operators.constraints import tariff_gaps
from meterline.plans.rules import with_rules
from meterline.plans.running import BROADCAST_ROWS, bounded
from meterline.schema import CANONICAL, RATED_COLUMNS


def rating_status(df: DataFrame) -> DataFrame:
    return df.withColumn("status", charges.rating_status())


def rate_usage(df: DataFrame) -> DataFrame:
    """Adds ``status``, ``cost`` under the default tariff, and ``billing_period``: map-only."""
    return rating_status(df).withColumns({"cost": charges.cost(), "billing_period": records.billing_period()})


def to_rated_table(rated: DataFrame) -> DataFrame:
    """Rated usage in the columns of a stored table."""
    return rated.withColumnRenamed("event_ts", "timestamp").select(*RATED_COLUMNS)


def _last_attempts(table: DataFrame, attempts: DataFrame | None) -> DataFrame:
    """Of each batch in a table of appended batches the last attempt: an earlier one may have left rows, too.

    With the table of finished ``attempts``, one row each, usage is read once and meets a counted, broadcast table.  Without
    it, the attempts are looked up in the usage itself, and one that never finished may count.
    """
    last = (table if attempts is None else attempts).groupBy("run", "batch_id").agg(F.max("attempt").alias("attempt"))
    if attempts is not None:
        last = bounded(last, last.limit(BROADCAST_ROWS + 1).count())
    return table.join(last, ["run", "batch_id", "attempt"], "left_semi")


def of_period(table: DataFrame, period: str) -> DataFrame:
    """Rated rows of a stored table with a time in the period ``yyyy-MM``, or without one, which belong to none.

    Both conditions are on stored columns as they are, so they reach the files or the database.
    """
    start, end = (F.add_months(F.to_date(F.lit(f"{period}-01")), n).cast("timestamp_ntz") for n in (0, 1))
    stamp = F.col("timestamp")
    if isinstance(table.schema["timestamp"].dataType, TimestampType):
        start, end = records.utc_instant(start), records.utc_instant(end)
    inside = (stamp >= start) & (stamp < end)
    return table.where((F.col("status") == c.STATUS_RATED) & (inside | stamp.isNull()))


def from_rated_table(table: DataFrame, period: str | None = None, attempts: DataFrame | None = None) -> DataFrame:
    """A stored table, whose numbers may be floating point, as rated usage ready for billing.

    With a period, only its rows are read (:func:`of_period`).  Batches that were appended more than once
    (:class:`meterline.sinks.BatchTable`) count once; give their table of finished ``attempts``.  Stored rows have no arrival position; they are given one here,
    which holds once the rows are written (:func:`meterline.plans.pipeline.bill_period` does that first).
    """
    if period is not None:
        table = of_period(table, period)
    if {"run", "batch_id", "attempt"} <= set(table.columns):
        table = _last_attempts(table, attempts)
    stamp = F.col("timestamp")
    if isinstance(table.schema["timestamp"].dataType, TimestampType):
        stamp = records.utc_wall_clock(stamp)
    seconds = {name: F.col(name).try_cast("int") for name in ("duration_sec", "session_duration_sec")}
    return (
        table.withColumns(
            {
                "record_id": F.monotonically_increasing_id(),
                "event_ts": stamp,
                "data_volume_mb": records.volume(F.col("data_volume_mb")),
                "cost": F.col("cost").try_cast(c.COST_TYPE),
                **seconds,
            }
        )
        .withColumn("billing_period", records.billing_period())
        .select(*CANONICAL, "status", "cost", "billing_period")
    )


def default_tariff(spark) -> DataFrame:
    """The default prices as a tariff table."""
    return spark.sql(
        f"""SELECT service, CAST(tier_from AS {c.VOLUME_TYPE}) AS tier_from, CAST(tier_to AS {c.VOLUME_TYPE}) AS tier_to,
                   unit, CAST(price AS decimal(10,4)) AS price, round_rule
            FROM VALUES ('voice', 0, NULL, 'minute', {c.VOICE_PRICE_PER_MINUTE}, 'floor_plus_one'),
                        ('sms', 0, NULL, 'message', {c.SMS_PRICE}, 'none'),
                        ('data', 0, {c.DATA_FIRST_TIER_MB}, 'MB', {c.DATA_PRICE_FIRST_TIER}, 'none'),
                        ('data', {c.DATA_FIRST_TIER_MB}, NULL, 'MB', {c.DATA_PRICE_ABOVE}, 'none')
                 AS tariff(service, tier_from, tier_to, unit, price, round_rule)"""
    )


def rate_by_tariff_table(df: DataFrame, tariff: DataFrame) -> DataFrame:
    """Status and cost from a tariff table (service, tier_from, tier_to, unit, price, round_rule).

    Every tier is given the full charge of the tiers below it first, on the tariff side.  A record then meets
    exactly one tier, so pricing needs no regrouping of usage.  Tiers of a service must be contiguous from zero; a
    tariff with gaps or repeated tiers is refused before anything is priced.
    """
    gap = tariff_gaps(tariff).select("service", "tier_from").first()
    if gap:
        raise ValueError(f"the tariff of {gap['service']} has no tier that ends where the one from {gap['tier_from']} starts")
    below = Window.partitionBy("service").orderBy("tier_from").rowsBetween(Window.unboundedPreceding, -1)
    tiers = tariff.withColumn(
        "below", F.coalesce(F.sum((F.col("tier_to") - F.col("tier_from")) * F.col("price")).over(below), F.lit(0))
    ).select(F.col("service").alias("_service"), "tier_from", "tier_to", "price", "round_rule", "below")

    minutes = F.col("duration_sec") / F.lit(60)
    used = charges.by_type(
        {
            "voice": F.when(F.col("round_rule") == "floor_plus_one", charges.started_minutes().cast(c.VOLUME_TYPE))
            .when(F.col("round_rule") == "ceil", F.ceil(minutes).cast(c.VOLUME_TYPE))
            .otherwise((F.col("duration_sec").cast("decimal(12,0)") / 60).cast(c.VOLUME_TYPE)),
            "sms": F.lit(1).cast(c.VOLUME_TYPE),
        },
        F.col("data_volume_mb"),
    )
    in_tier = ((used > F.col("tier_from")) | ((used == 0) & (F.col("tier_from") == 0))) & (
        F.col("tier_to").isNull() | (used <= F.col("tier_to"))
    )
    charge = (F.col("below") + (used - F.col("tier_from")) * F.col("price")).cast(c.COST_TYPE)
    nothing = F.lit(0).cast(c.COST_TYPE)
    joined = with_rules(rating_status(df), tiers, {"_service": F.col("record_type")}, in_tier)
    priced = F.when(F.col("status") == c.STATUS_RATED, F.coalesce(charge, nothing)).otherwise(nothing)
    return joined.withColumns({"cost": priced, "billing_period": records.billing_period()}).drop(
        "tier_from", "tier_to", "price", "round_rule", "below"
    )
