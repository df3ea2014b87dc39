"""Status, price and invoice attributes of single usage records."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterline import constants as c

#: The field without which a record of that type cannot be priced.
PRICED_BY = {"voice": "duration_sec", "sms": "sender_id", "data": "data_volume_mb"}


def by_type(choices: dict[str, Column], otherwise: Column) -> Column:
    """The choice for the record's type."""
    (first, value), *others = choices.items()
    picked = F.when(F.col("record_type") == first, value)
    for kind, value in others:
        picked = picked.when(F.col("record_type") == kind, value)
    return picked.otherwise(otherwise)


def rating_status() -> Column:
    """``rejected`` without a type, ``error`` without the priced field, else ``rated`` (unknown types too)."""
    priced = by_type({kind: F.col(field).isNotNull() for kind, field in PRICED_BY.items()}, F.lit(True))
    return (
        F.when(F.col("record_type").isNull(), F.lit(c.STATUS_REJECTED))
        .when(priced, F.lit(c.STATUS_RATED))
        .otherwise(F.lit(c.STATUS_ERROR))
    )


def started_minutes(seconds: str = "duration_sec") -> Column:
    """Whole minutes passed plus one: 59 s is 1, 60 s is 2."""
    return F.floor(F.col(seconds) / 60) + 1


def graduated(quantity: Column, first_tier: int, price: Column, price_above: Column) -> Column:
    """Two-tier price: each part of the quantity costs what its tier says."""
    limit = F.lit(first_tier).cast(c.VOLUME_TYPE)
    return F.least(quantity, limit) * price + F.greatest(quantity - limit, F.lit(0).cast(c.VOLUME_TYPE)) * price_above


def cost() -> Column:
    """Price under the default tariff; needs ``status``.  Unpriced and unknown records cost nothing."""
    prices = {
        "voice": started_minutes() * F.lit(c.VOICE_PRICE_PER_MINUTE),
        "sms": F.lit(c.SMS_PRICE),
        "data": graduated(
            F.col("data_volume_mb"),
            c.DATA_FIRST_TIER_MB,
            F.lit(c.DATA_PRICE_FIRST_TIER),
            F.lit(c.DATA_PRICE_ABOVE),
        ),
    }
    nothing = F.lit(0).cast(c.COST_TYPE)
    priced = by_type({kind: price.cast(c.COST_TYPE) for kind, price in prices.items()}, nothing)
    return F.when(F.col("status") == c.STATUS_RATED, priced).otherwise(nothing)


def paying_user() -> Column:
    """Who is charged: the caller of a call, the sender of a message, else the record's user."""
    return by_type({"voice": F.col("caller_id"), "sms": F.col("sender_id")}, F.col("user_id"))


def service_label() -> Column:
    labels = {kind: F.lit(label) for kind, label in c.SERVICE_LABELS.items() if kind != "data"}
    return by_type(labels, F.lit(c.SERVICE_LABELS["data"]))


def unit_label() -> Column:
    labels = {kind: F.lit(label) for kind, label in c.UNIT_LABELS.items() if kind != "data"}
    return by_type(labels, F.lit(c.UNIT_LABELS["data"]))


def exact_minutes() -> Column:
    """Minutes to two places.  Priced minutes are started minutes, so this differs from what is charged."""
    return F.round(F.col("duration_sec").cast("decimal(12,0)") / 60, 2).cast(c.VOLUME_TYPE)


def quantity() -> Column:
    """Minutes, messages or MB."""
    return by_type(
        {"voice": exact_minutes(), "sms": F.lit(1).cast(c.VOLUME_TYPE)},
        F.col("data_volume_mb"),
    )


def billed_quantity() -> Column:
    """Quantity in the units that tariffs and quotas count: started minutes, messages or MB."""
    return by_type(
        {"voice": started_minutes().cast(c.VOLUME_TYPE), "sms": F.lit(1).cast(c.VOLUME_TYPE)},
        F.col("data_volume_mb"),
    )


def unit_price(quantity: Column) -> Column:
    """Cost per unit to four places; NULL for a zero or unknown quantity."""
    return F.round(F.try_divide(F.col("cost"), quantity), 4).cast(c.UNIT_PRICE_TYPE)


def line_amount() -> Column:
    """A record's cost in cents.  Everything an invoice shows is summed from these, so that it adds up."""
    return F.round("cost", 2).cast(c.AMOUNT_TYPE)


def invoice_id(period: Column, user: Column) -> Column:
    return F.concat(F.replace(period, F.lit("-"), F.lit("")), user)
