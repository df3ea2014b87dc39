"""Mediation, rating, deduplication and running usage on streams."""

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from meterline.constants import STATUS_RATED
from meterline.functions import charges, records
from meterline.operators.bill import billable
from meterline.operators.mediate import encode_usage, parse_usage, payload_key, validate_usage
from meterline.operators.rate import rate_usage
from meterline.operators.sessions import GAP, session_stream
from meterline.schema import CANONICAL
from meterline.sinks.segments import SegmentFolder
from meterline.sources.tables import add_balances, add_windows

#: Parts of one payload's copies that are thinned apart from each other.
SALTS = 64
VOLUME_SUM = "decimal(28,6)"


def _started(
    writer: DataStreamWriter, checkpoint: str, trigger: Mapping[str, object] | None, name: str | None
) -> StreamingQuery:
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return (writer.queryName(name) if name else writer).start()


def mediated(raw: DataFrame, dedup_delay: str | None = None) -> DataFrame:
    """Raw text to ``record_id``, ``is_valid``, ``reject_reason`` and ``value``.

    Clean records are re-encoded from their normalised fields; dirty ones keep their original text.  Counts of
    both are taken in the same pass.  With ``dedup_delay`` (streams only; needs ``arrival_ts``) a clean record that
    arrives again within that time is left out; dirty records are all kept.
    """
    carry = ("record_id",) if dedup_delay is None else ("record_id", "arrival_ts")
    judged = validate_usage(parse_usage(raw, carry=carry))
    if dedup_delay is not None:
        own = F.unhex(F.sha2(F.concat(F.lit("dirty "), F.col("record_id").cast("string")), 256))
        judged = _first_arrivals(judged, F.when(F.col("is_valid"), payload_key()).otherwise(own), "arrival_ts", dedup_delay)
    encoded = encode_usage(
        judged.withColumnRenamed("value", "original"), ("record_id", "is_valid", "reject_reason", "original")
    )
    shaped = encoded.withColumn("value", F.when(F.col("is_valid"), F.col("value")).otherwise(F.col("original")))
    return shaped.drop("original").observe(
        "mediation",
        F.count(F.lit(1)).alias("records"),
        F.count_if("is_valid").alias("clean"),
        F.count_if(~F.col("is_valid")).alias("dirty"),
    )


def to_messages(judged: DataFrame, clean_topic: str, dirty_topic: str) -> DataFrame:
    """Mediated records as messages that name their topic; a dead letter has its reason as a header."""
    header = F.struct(F.lit("reject_reason").alias("key"), F.col("reject_reason").cast("binary").alias("value"))
    return judged.select(
        F.when(F.col("is_valid"), clean_topic).otherwise(dirty_topic).alias("topic"),
        "value",
        F.when(~F.col("is_valid"), F.array(header)).alias("headers"),
    )


def start_mediation(
    raw: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str,
    path: str | None = None,
    clean_topic: str = "clean_records",
    dirty_topic: str = "dirty_records",
    trigger: Mapping[str, object] | None = None,
    name: str | None = "mediation",
    dedup_delay: str | None = None,
) -> StreamingQuery:
    """Splits raw records into clean and dirty in one query that reads and parses every record once.

    With ``dedup_delay``, such as ``7 days``, copies of clean records arriving within that time go no further.

    On Kafka each record names its topic.  On files the two outputs are the partitions ``is_valid=true`` and
    ``is_valid=false`` of ``path``, written exactly once.
    """
    judged = mediated(raw, dedup_delay)
    if fmt == "kafka":
        writer = to_messages(judged, clean_topic, dirty_topic).writeStream.format("kafka")
    else:
        writer = judged.writeStream.format(fmt).partitionBy("is_valid").option("path", path)
    return _started(writer.options(**options), checkpoint, trigger, name)


def start_rating(
    clean: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    name: str | None = "rating",
) -> StreamingQuery:
    """Prices clean records batch by batch.

    ``write_batch`` must leave a repeated batch once (:class:`meterline.sinks.BatchFolder`).  If it raises, the
    query stops and the batch is run again at the next start.  Row counts are observed, not counted anew.
    """
    rated = rate_usage(parse_usage(clean).select(*CANONICAL)).observe(
        "rating",
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("status") == STATUS_RATED).alias("rated"),
    )
    return _started(rated.writeStream.foreachBatch(write_batch), checkpoint, trigger, name)


def _first_arrivals(usage: DataFrame, key: Column, arrival: str, delay: str) -> DataFrame:
    """One row per key among those arriving within ``delay`` of each other.

    In two steps: first within each of ``SALTS`` parts of a key's rows, then among what is left.  A payload that makes
    up a third of all records is so spread over many tasks, and at most ``SALTS`` of its copies meet in one.

    The rule that this gives: the first arrival comes through, none within ``delay`` after it does, and a payload that keeps arriving
    comes through again between one and two delays later, as a part remembers for ``delay`` what it has passed on itself.
    Copies that must go whatever their distance are left to :class:`meterline.operators.history.HistoryDedup` or to billing.
    """
    salt = F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int")
    keyed = usage.withColumns({"_key": key, "_salt": salt}).withWatermark(arrival, delay)
    thinned = keyed.dropDuplicatesWithinWatermark(["_key", "_salt"])
    return thinned.dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_salt")


def dedup_stream(usage: DataFrame, arrival: str, delay: str) -> DataFrame:
    """One record per payload among those arriving within ``delay`` of each other.

    Usage times arrive in any order, so the watermark belongs on the arrival time.  State holds a digest per payload.
    """
    return _first_arrivals(usage, payload_key(), arrival, delay)


def window_sums(usage: DataFrame, width: str = "1 day") -> DataFrame:
    """Records, billed quantity and, if priced, cost by paying user, service and window of usage time.

    Usage without a time has the window NULL, so nothing is lost.  Sums add up over any parts of the usage.
    """
    instant = records.utc_instant(F.col("event_ts"))
    timed = usage.withColumns(
        {
            "user_id": charges.paying_user(),
            "quantity": charges.billed_quantity(),
            "_window": F.window(F.coalesce(instant, F.timestamp_micros(F.lit(0))), width),
        }
    ).withColumn("_window", F.when(F.col("event_ts").isNotNull(), F.col("_window")))
    measures = {"n": F.count(F.lit(1)), "quantity": F.sum("quantity").cast(VOLUME_SUM)}
    if "cost" in usage.columns:
        measures["cost"] = F.sum("cost").cast(VOLUME_SUM)
    summed = timed.groupBy("user_id", "record_type", "_window").agg(*[value.alias(name) for name, value in measures.items()])
    return summed.select(
        "user_id",
        "record_type",
        records.utc_wall_clock(F.col("_window.start")).alias("window_start"),
        records.utc_wall_clock(F.col("_window.end")).alias("window_end"),
        *measures,
    )


def start_consumption(
    usage: DataFrame,
    path: str,
    run: str,
    checkpoint: str,
    width: str = "1 day",
    trigger: Mapping[str, object] | None = None,
    name: str | None = "consumption",
    fan_out: int = 8,
) -> StreamingQuery:
    """Consumption per user while usage arrives: every batch adds its own partial sums, and they are merged as they grow.

    No watermark decides what still counts, so usage that is a month late is added all the same.  A repeated batch
    counts once (:class:`meterline.sinks.SegmentFolder`).  Usage has a ``cost``.
    :func:`meterline.sources.read_consumption` adds up what is live.
    """
    store = SegmentFolder(path, run, "window_day", fan_out, add_windows)

    def write_sums(batch: DataFrame, batch_id: int) -> None:
        store(window_sums(batch, width).withColumn("window_day", F.to_date("window_start")), batch_id)

    return _started(usage.writeStream.foreachBatch(write_sums), checkpoint, trigger, name)


def start_balances(
    rated: DataFrame,
    path: str,
    run: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    name: str | None = "balances",
    fan_out: int = 8,
) -> StreamingQuery:
    """What clients have used of each service in each period, kept up to date batch by batch.

    A batch is summed by client, period and service, and only the sums are stored; batches may hold usage of any period in any
    order.  Sums of billed quantity do not depend on the order either, so the free units left
    (:func:`meterline.sources.read_balances`) are those that a batch run over all usage would find.
    """
    store = SegmentFolder(path, run, "billing_period", fan_out, add_balances)

    def write_sums(batch: DataFrame, batch_id: int) -> None:
        units = billable(batch).select(
            "user_id", "record_type", "billing_period", F.lit(1).cast("bigint").alias("n"), charges.billed_quantity().cast(VOLUME_SUM).alias("used")
        )
        store(add_balances(units), batch_id)

    return _started(rated.writeStream.foreachBatch(write_sums), checkpoint, trigger, name)


def start_sessions(
    rated: DataFrame,
    path: str,
    checkpoint: str,
    gap: str = GAP,
    delay: str = "1 hour",
    trigger: Mapping[str, object] | None = None,
    name: str | None = "sessions",
) -> StreamingQuery:
    """Finished sessions of use as files (:func:`meterline.operators.sessions.session_stream`), each written once."""
    writer = session_stream(rated, gap, delay).writeStream.format("parquet").option("path", path)
    return _started(writer, checkpoint, trigger, name)


def await_all(queries: list[StreamingQuery], look_every: float = 1.0) -> None:
    """Waits until all queries have ended; the first failure of any of them is raised and stops the rest."""
    try:
        while not all([query.awaitTermination(look_every) for query in queries]):
            pass
    finally:
        for query in queries:
            query.stop()
