"""Plans, promotions, and time and place modifiers on rated usage.

Where several rules of a kind fit a record the lowest price applies: rule tables are made unique before they meet
usage, so no record is charged twice.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.constants import COST_TYPE
from meterline.functions import charges
from meterline.plans.asof import as_of
from meterline.plans.intervals import strongest_segments, with_valid
from meterline.plans.rules import with_rules
from meterline.plans.running import HOT_ROWS
from meterline.plans.shared_folder import written

#: Stands for the end of a promotion without one: the last moment that a time stamp can hold here.
OPEN_END = "TIMESTAMP_NTZ'9999-12-31 23:59:59.999999'"
EARLIEST = "TIMESTAMP_NTZ'0001-01-01 00:00:00'"


def promotion_segments(promotions: DataFrame) -> DataFrame:
    """Promotions (service, valid_from, valid_to, percent_off) as non-overlapping segments by service.

    ``valid_to`` is excluded; NULL is an open end.  Where promotions overlap the largest reduction applies, so a record
    meets at most one segment.
    """
    lasting = promotions.withColumn("valid_to", F.coalesce("valid_to", F.expr(OPEN_END)))
    lasting = lasting.where(F.col("service").isNotNull() & (F.col("valid_from") < F.col("valid_to")))
    segments = strongest_segments(
        lasting.select("service", "valid_from", "valid_to", "percent_off"), "service", "valid_from", "valid_to", "percent_off"
    )
    return segments.withColumnsRenamed({"valid_from": "segment_from", "valid_to": "segment_to"})


def _with_percent_off(usage: DataFrame, promotions: DataFrame) -> DataFrame:
    """Adds ``percent_off``: that of the promotion valid for the record's service at its time."""
    segments = written(promotion_segments(promotions), "segments")
    segments = segments.withColumn("segment_to", F.when(F.col("segment_to") < F.expr(OPEN_END), F.col("segment_to")))
    return with_valid(usage, segments, "service", F.col("record_type"), "event_ts", "segment_from", "segment_to")


def _lowest_price(plans: DataFrame, *keys: str) -> DataFrame:
    return plans.groupBy(*keys).agg(F.min("plan_multiplier").alias("plan_multiplier"))


def _dated(table: DataFrame) -> bool:
    return "valid_from" in table.columns


def _with_multiplier(usage: DataFrame, subscriptions: DataFrame, plans: DataFrame, hot_rows: int) -> DataFrame:
    """Adds ``plan_multiplier``: the price, at the time of the record, of the plan that its payer had at that time."""
    clients = subscriptions.withColumnRenamed("user_id", "_payer")
    if not _dated(plans):
        prices = _lowest_price(plans, "plan")
        if not _dated(subscriptions):
            multipliers = _lowest_price(clients.join(prices, "plan"), "_payer")
            return usage.join(multipliers, F.col("payer") == F.col("_payer"), "left").drop("_payer")
        changes = _lowest_price(clients.join(prices, "plan", "left"), "_payer", "valid_from")
        return as_of(usage, changes, "_payer", F.col("payer"), "event_ts", "valid_from", hot_rows)
    if _dated(subscriptions):
        changes = clients.groupBy("_payer", "valid_from").agg(F.min("plan").alias("_plan"))
        planned = as_of(usage, changes, "_payer", F.col("payer"), "event_ts", "valid_from", hot_rows)
    else:
        held = clients.groupBy("_payer").agg(F.min("plan").alias("_plan"))
        planned = usage.join(held, F.col("payer") == F.col("_payer"), "left").drop("_payer")
    since = F.coalesce("valid_from", F.expr(EARLIEST)).alias("valid_from")
    prices = _lowest_price(plans.select("plan", since, "plan_multiplier"), "plan", "valid_from")
    following = Window.partitionBy("plan").orderBy("valid_from")
    spans = prices.withColumn("valid_to", F.lead("valid_from").over(following))
    spans = written(spans, "plan-prices")
    return with_valid(planned, spans, "plan", F.col("_plan"), "event_ts", "valid_from", "valid_to").drop("_plan")


def rate_with_promotions(
    rated: DataFrame,
    subscriptions: DataFrame | None = None,
    plans: DataFrame | None = None,
    promotions: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``base_cost`` becomes ``cost`` under the payer's plan and the promotion valid at that time.

    subscriptions: user_id, plan; plans: plan, plan_multiplier; they go together, and promotions stand for themselves.  With a
    column ``valid_from`` a subscription, or a plan's price, holds from then until the next one of the same client, or plan
    (:func:`meterline.plans.asof.as_of`); NULL is since ever, and the plan NULL ends a subscription.  A payer without a plan
    pays the base price, and so does one whose plan has no price yet.  Of several plans that a client has from the same
    moment on, the cheapest counts; if prices are dated, the first by name.  A payer with very much usage makes a skewed join
    partition, which adaptive execution splits: usage is the left, splittable side; with dated subscriptions it is cut into
    slices by time.
    """
    if (subscriptions is None) != (plans is None):
        raise ValueError("subscriptions and plans go together")
    usage = rated.withColumnRenamed("cost", "base_cost").withColumn("payer", charges.paying_user())
    price, whole = F.col("base_cost"), F.lit(1).cast("decimal(4,2)")
    if promotions is not None:
        usage = _with_percent_off(usage, promotions)
    if plans is not None:
        usage = _with_multiplier(usage, subscriptions, plans, hot_rows)
        price = price * F.coalesce("plan_multiplier", whole)
    if promotions is not None:
        price = price * (whole - F.coalesce("percent_off", F.lit(0).cast("decimal(4,2)")))
    return usage.withColumn("cost", price.cast(COST_TYPE)).drop("percent_off", "plan_multiplier")


def hour_rows(bands: DataFrame) -> DataFrame:
    """Bands (weekend, from_hour, to_hour, hour_multiplier) as one row per kind of day and hour.

    A band whose end comes before its start goes over midnight: 22 to 6 covers the hours 22, 23 and 0 to 5 of its kind
    of day.  A band that starts and ends at the same hour covers the whole day.
    """
    first, end = F.col("from_hour"), F.col("to_hour")
    hours = F.sequence(first, F.when(first < end, end).otherwise(end + 24) - 1)
    unfolded = bands.select("weekend", F.explode(hours).alias("hour"), "hour_multiplier")
    return unfolded.groupBy("weekend", (F.col("hour") % 24).alias("hour")).agg(
        F.min("hour_multiplier").alias("hour_multiplier")
    )


def rate_with_modifiers(rated: DataFrame, bands: DataFrame, cells: DataFrame) -> DataFrame:
    """``base_cost`` becomes ``cost`` after the hour and cell multipliers; an unlisted hour or cell has 1."""
    neutral = F.lit(1).cast("decimal(4,2)")
    hours = hour_rows(bands).withColumnsRenamed({"weekend": "_weekend", "hour": "_hour"})
    places = cells.groupBy(F.col("cell_id").alias("_cell")).agg(F.min("cell_multiplier").alias("cell_multiplier"))
    usage = rated.withColumnRenamed("cost", "base_cost")
    timed = with_rules(usage, hours, {"_weekend": F.weekday("event_ts") >= 5, "_hour": F.hour("event_ts")})
    joined = with_rules(timed, places, {"_cell": F.col("cell_id")})
    price = F.col("base_cost") * F.coalesce("hour_multiplier", neutral) * F.coalesce("cell_multiplier", neutral)
    return joined.withColumn("cost", price.cast(COST_TYPE)).drop("hour_multiplier", "cell_multiplier")
