"""Schemas of the records that stages exchange."""

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# Field names, types and column orders of the records and tables that stages exchange.
IDENTIFIERS = ("caller_id", "callee_id", "sender_id", "receiver_id", "user_id")
QUANTITIES = ("duration_sec", "data_volume_mb", "session_duration_sec")

#: A usage record as JSON.  The volume is a double because a decimal would also accept quoted numbers, which
#: count as damaged.
WIRE_SCHEMA = StructType(
    [
        StructField("record_type", StringType()),
        StructField("timestamp", StringType()),
        StructField("caller_id", StringType()),
        StructField("callee_id", StringType()),
        StructField("duration_sec", IntegerType()),
        StructField("sender_id", StringType()),
        StructField("receiver_id", StringType()),
        StructField("user_id", StringType()),
        StructField("data_volume_mb", DoubleType()),
        StructField("session_duration_sec", IntegerType()),
        StructField("cell_id", StringType()),
        StructField("technology", StringType()),
    ]
)

#: The same with every field as text.
WIRE_TEXT_SCHEMA = StructType([StructField(field.name, StringType()) for field in WIRE_SCHEMA])

#: Everything a record says; ``record_id`` is its arrival position and not part of what it says.
PAYLOAD = (
    "record_type",
    "event_ts",
    "caller_id",
    "callee_id",
    "duration_sec",
    "sender_id",
    "receiver_id",
    "user_id",
    "data_volume_mb",
    "session_duration_sec",
    "cell_id",
    "technology",
)
CANONICAL = ("record_id", *PAYLOAD)

#: Rated usage as a database table holds it.
RATED_COLUMNS = (
    "record_type",
    "timestamp",
    "user_id",
    "data_volume_mb",
    "session_duration_sec",
    "caller_id",
    "callee_id",
    "duration_sec",
    "sender_id",
    "receiver_id",
    "cell_id",
    "technology",
    "status",
    "cost",
)
#: Rated usage in the folders that streams write, one below the other by period, run and batch.
BATCH_SCHEMA = (
    "record_id BIGINT, record_type STRING, event_ts TIMESTAMP_NTZ, caller_id STRING, callee_id STRING, duration_sec INT, "
    "sender_id STRING, receiver_id STRING, user_id STRING, data_volume_mb DECIMAL(18,6), session_duration_sec INT, "
    "cell_id STRING, technology STRING, status STRING, cost DECIMAL(20,6), billing_period STRING, run STRING, batch_id BIGINT"
)
#: The same in segments (:mod:`meterline.sinks.segments`).
RATED_SCHEMA = BATCH_SCHEMA.removesuffix(", run STRING, batch_id BIGINT")
#: Partial sums of consumption, by the day in which their window starts.
CONSUMPTION_SCHEMA = (
    "user_id STRING, record_type STRING, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, n BIGINT, "
    "quantity DECIMAL(28,6), cost DECIMAL(28,6), window_day DATE"
)
#: Units that clients have used in a period.
BALANCE_SCHEMA = "user_id STRING, record_type STRING, n BIGINT, used DECIMAL(28,6), billing_period STRING"
#: The table of finished billing runs.
RUNS = "billing_runs"
SUMMARY_COLUMNS = (
    "invoice_id",
    "user_id",
    "billing_period",
    "invoice_date",
    "total_voice_cost",
    "total_sms_cost",
    "total_data_cost",
    "subtotal",
    "tax_amount",
    "total_amount",
)
LINE_COLUMNS = (
    "invoice_id",
    "user_id",
    "line_number",
    "service_type",
    "usage_quantity",
    "unit",
    "unit_price",
    "line_amount",
)
SUMMARY_KEY = ("invoice_id", "user_id")
LINE_KEY = ("invoice_id", "line_number")
