"""From raw records to normalised, judged and deduplicated usage."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.constants import CORRUPTION_MARKER
from meterline.functions import records
from meterline.schema import CANONICAL, IDENTIFIERS, PAYLOAD, QUANTITIES, WIRE_TEXT_SCHEMA

QUANTITY_TEXT_NAMES = [f"{name}_text" for name in QUANTITIES]


def normalize_usage(df: DataFrame) -> DataFrame:
    """Identifiers in one spelling and the volume as an exact number; other columns pass."""
    changed = {name: records.identifier(name) for name in IDENTIFIERS}
    changed["data_volume_mb"] = records.volume(F.col("data_volume_mb"))
    return df.withColumns(changed)


def _keep_texts(df: DataFrame) -> DataFrame:
    return df.withColumns({text: F.col(name) for name, text in zip(QUANTITIES, QUANTITY_TEXT_NAMES, strict=True)})


def parse_usage(df: DataFrame, value: str = "value", carry: tuple[str, ...] = ("record_id",)) -> DataFrame:
    """JSON records as canonical columns, next to the original text and the ``carry`` columns.

    An unreadable field is NULL and the rest of its record stays; a value that is no JSON object is all NULL.
    The text of each quantity stays as ``<name>_text``.
    """
    parsed = df.select(*carry, F.col(value).cast("string").alias("value"))
    parsed = parsed.withColumn("_record", F.from_json("value", WIRE_TEXT_SCHEMA))
    flat = parsed.select(*carry, "value", "_record.*").withColumn("event_ts", records.event_time("timestamp"))
    numbers = {name: records.json_number(name, "value") for name in QUANTITIES}
    typed = _keep_texts(flat).withColumns(numbers)
    return normalize_usage(typed).select(*carry, *PAYLOAD, "value", *QUANTITY_TEXT_NAMES)


def type_usage(df: DataFrame) -> DataFrame:
    """Canonical columns from a table that holds quantities as text; the text stays as ``<name>_text``."""
    numbers = {
        "duration_sec": records.whole_number("duration_sec"),
        "data_volume_mb": records.real_number("data_volume_mb"),
        "session_duration_sec": records.whole_number("session_duration_sec"),
    }
    typed = _keep_texts(df).withColumns(numbers)
    return normalize_usage(typed).select(*CANONICAL, *QUANTITY_TEXT_NAMES)


def encode_usage(df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Records as JSON text in ``value``: the form that stages send each other.  NULL fields are left out."""
    extra = [name for name in ("is_valid", "reject_reason") if name in df.columns]
    stamp = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp")
    fields = [stamp if name == "event_ts" else F.col(name) for name in (*PAYLOAD, *extra)]
    return df.select(*carry, F.to_json(F.struct(*fields)).alias("value"))


def _original_text(df: DataFrame):
    """The column with a quantity's original text, or NULL if the frame no longer has it."""
    known = set(df.columns)
    return lambda name: F.col(f"{name}_text") if f"{name}_text" in known else F.lit(None).cast("string")


def validate_usage(df: DataFrame, marker: str = CORRUPTION_MARKER) -> DataFrame:
    """Adds ``is_valid`` (never NULL) and ``reject_reason`` (NULL for valid records)."""
    return df.withColumns(
        {
            "is_valid": records.is_valid(marker),
            "reject_reason": records.reject_reason(_original_text(df), marker),
        }
    )


def usage_clean(df: DataFrame, marker: str = CORRUPTION_MARKER) -> DataFrame:
    return df.where(records.is_valid(marker))


def usage_dirty(df: DataFrame, marker: str = CORRUPTION_MARKER) -> DataFrame:
    """Invalid records with their reason: together with :func:`usage_clean` exactly the input."""
    return validate_usage(df, marker).where(~F.col("is_valid"))


def dedup_usage(df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The first arrival of every payload, in canonical columns, with that arrival's ``carry`` columns.

    Grouping by the payload itself is exact, and copies collapse before the shuffle, so a record that was sent
    a billion times costs one row per task.
    """
    carried = [F.min_by(name, "record_id").alias(name) for name in carry]
    return df.groupBy(*PAYLOAD).agg(F.min("record_id").alias("record_id"), *carried).select(*CANONICAL, *carry)


def duplicate_report(df: DataFrame) -> DataFrame:
    """Payloads that arrived more than once: first and last arrival and number of copies."""
    return (
        df.groupBy(payload_key().alias("_key"), "record_type", "user_id")
        .agg(
            F.min("record_id").alias("record_id"),
            F.max("record_id").alias("last_record_id"),
            F.count(F.lit(1)).alias("copies"),
        )
        .where(F.col("copies") > 1)
        .select("record_id", "last_record_id", "record_type", "user_id", "copies")
    )


def payload_key() -> Column:
    """Digest of everything a record says, in 32 bytes, for state and shuffles that must stay small.

    The time goes in as microseconds: as JSON text it would lose all below the millisecond.
    """
    fields = [records.micros(name).alias(name) if name == "event_ts" else F.col(name) for name in PAYLOAD]
    return F.unhex(F.sha2(F.to_json(F.struct(*fields)), 256))


def unify_usage(*frames: DataFrame) -> DataFrame:
    """Voice, SMS and data records kept in separate tables as one canonical table."""
    merged = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
    types = {"duration_sec": "int", "session_duration_sec": "int", "data_volume_mb": "double"}
    missing = {
        name: F.lit(None).cast(types.get(name, "string")) for name in PAYLOAD if name not in merged.columns
    }
    return normalize_usage(merged.withColumns(missing) if missing else merged).select(*CANONICAL)
