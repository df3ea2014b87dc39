"""Normalising and judging single usage records."""

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.constants import CORRUPTION_MARKER, RECORD_TYPES, VOLUME_TYPE
from meterline.schema import WIRE_SCHEMA

#: Per record type: identifiers that must be usable, then quantities that must be positive.
REQUIRED = {
    "voice": (("caller_id", "callee_id"), ("duration_sec",)),
    "sms": (("sender_id", "receiver_id"), ()),
    "data": (("user_id",), ("data_volume_mb", "session_duration_sec")),
}


def identifier(name: str) -> Column:
    """Lower case without surrounding spaces; tabs and line ends stay."""
    return F.lower(F.trim(F.col(name)))


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def utc_wall_clock(instant: Column) -> Column:
    """An instant as TIMESTAMP_NTZ in UTC, whatever the session time zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def utc_instant(wall_clock: Column) -> Column:
    """The reverse of :func:`utc_wall_clock`."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), wall_clock))


def micros(wall_clock: str) -> Column:
    """Microseconds of a wall clock time."""
    return F.timestamp_diff("MICROSECOND", _epoch(), F.col(wall_clock))


def event_time(name: str) -> Column:
    """Time stamp text to UTC wall clock; NULL where it cannot be read."""
    return utc_wall_clock(F.try_to_timestamp(F.col(name)))


def whole_number(name: str) -> Column:
    """Text as INT, NULL where it is none.

    Casting only what looks like a number matters: a failed cast costs some hundred times a good one, and unused
    fields are empty in every record.
    """
    return F.when(F.col(name).rlike(r"^\s*[-+]?[0-9]+\s*$"), F.col(name).try_cast("int"))


def real_number(name: str) -> Column:
    """Text as DOUBLE, including NaN and infinity, NULL where it is none; see :func:`whole_number`.

    The whole text must be a number: the cast alone would also accept a trailing type letter, as in ``5d``.
    """
    number = r"(?i)^\s*[-+]?((\d+\.?\d*|\.\d+)(e[-+]?\d+)?|nan|inf(inity)?)\s*$"
    return F.when(F.col(name).rlike(number), F.col(name).try_cast("double"))


def json_number(name: str, value: str) -> Column:
    """The number that ``from_json`` reads for a quantity of the JSON text ``value``; its own text is in ``name``.

    Reading quantities as numbers right away is slow, because unused ones are empty text and each of those fails
    inside the parser.  Text that looks like a number is one unless it was quoted, so only records with a quoted
    quantity, or with escapes or single quotes that could hide one, are parsed once more.
    """
    field = WIRE_SCHEMA[name]
    # Three tests and not one pattern: each of them starts from fixed text, which is searched much faster.
    text = F.col(value)
    doubtful = text.rlike(rf'''"{name}"\s*:\s*"[^"]''') | text.contains("'") | text.contains("\\")
    again = F.from_json(value, StructType([field]))[name]
    number = F.when(doubtful, again).otherwise(F.col(name).try_cast(field.dataType))
    return F.when(F.col(name).rlike(r"^[-+]?[.0-9NI]"), number)


def volume(source: Column) -> Column:
    """A double as an exact volume; NaN, infinity and values out of range become NULL."""
    return source.try_cast(VOLUME_TYPE)


def billing_period(ts: str = "event_ts") -> Column:
    return F.date_format(F.col(ts), "yyyy-MM")


def is_valid(marker: str = CORRUPTION_MARKER) -> Column:
    """True if every field its record type needs is usable; never NULL."""

    def complete(kind: str) -> Column:
        identifiers, quantities = REQUIRED[kind]
        return reduce(
            and_,
            [F.col("record_type") == kind]
            + [F.col(name).isNotNull() & ~F.col(name).contains(marker) for name in identifiers]
            + [F.col(name) > 0 for name in quantities],
        )

    return F.coalesce(reduce(or_, [complete(kind) for kind in RECORD_TYPES]), F.lit(False))


def reject_reason(text_of: Callable[[str], Column], marker: str = CORRUPTION_MARKER) -> Column:
    """``class:field`` of the first unusable field, NULL for a valid record.

    A quantity that cannot be read is NULL after parsing, so its original text tells missing from corrupted.
    ``text_of`` names the column holding that text; it is evaluated only for records that need it.
    """

    def identifier_problem(name: str) -> Column:
        return F.when(F.col(name).isNull(), F.lit(f"missing:{name}")).when(
            F.col(name).contains(marker), F.lit(f"corrupted:{name}")
        )

    def quantity_problem(name: str) -> Column:
        text = F.lower(text_of(name))
        number = text.try_cast("double")
        unreadable = (
            F.when(text.isNull() | (text == ""), F.lit(f"missing:{name}"))
            .when(text.contains(marker), F.lit(f"corrupted:{name}"))
            .when(F.isnan(number) | (F.abs(number) == float("inf")), F.lit(f"non_finite:{name}"))
            .otherwise(F.lit(f"malformed:{name}"))
        )
        return F.when(F.col(name).isNull(), unreadable).when(F.col(name) <= 0, F.lit(f"non_positive:{name}"))

    reason = F.when(F.col("record_type").isNull(), F.lit("missing:record_type"))
    for kind in RECORD_TYPES:
        identifiers, quantities = REQUIRED[kind]
        problems = [identifier_problem(n) for n in identifiers] + [quantity_problem(n) for n in quantities]
        reason = reason.when(F.col("record_type") == kind, F.coalesce(*problems))
    return reason.otherwise(F.lit("unknown:record_type"))
