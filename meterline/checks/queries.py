"""Every operator as a query over the given tables, with plain result columns."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from meterline.checks import fixtures
from meterline.functions import charges
from meterline.operators import anomalies, bill, clients, constraints, documents, mediate, modifiers, rate, reports, sessions, sketches
from meterline.operators.history import HistoryDedup
from meterline.plans.pipeline import Rules, bill_period
from meterline.plans.shared_folder import fresh_path, written
from meterline.schema import CANONICAL, LINE_KEY, PAYLOAD
from meterline.sinks import BatchFolder, BatchTable, SegmentFolder, compact, export_csv, publish_tables, read_published, write_table
from meterline.sinks.segments import read_live
from meterline.sources import (
    read_balances,
    read_batches,
    read_clients,
    read_consumption,
    read_mediated,
    read_published_table,
    read_raw,
    read_segments,
    read_table,
    stream_clean,
    stream_raw,
)
from meterline.streaming import (
    BatchMetrics,
    await_all,
    dedup_stream,
    read_batch_metrics,
    start_balances,
    start_consumption,
    start_mediation,
    start_rating,
    start_sessions,
)

Query = Callable[[SparkSession, str], DataFrame]

PERIOD = "2024-01"
AT_ONCE = {"availableNow": True}


def invoice_day() -> Column:
    return F.to_date(F.lit("2024-02-01"))


def plain(df: DataFrame) -> DataFrame:
    """Exact numbers as doubles, the one numeric form that both engines print alike."""
    doubles = {
        field.name: F.col(field.name).cast("double")
        for field in df.schema.fields
        if isinstance(field.dataType, DecimalType)
    }
    return df.withColumns(doubles) if doubles else df


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mediate.usage_clean(fixtures.usage(spark, sf_dir)).select(*CANONICAL)


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean records as they came, copies included."""
    return rate.rate_usage(_clean(spark, sf_dir))


def _billed_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean records without copies."""
    return rate.rate_usage(mediate.dedup_usage(_clean(spark, sf_dir)))


def usage_canonical(spark, sf_dir):
    return fixtures.usage(spark, sf_dir).select(*CANONICAL)


def parse_usage(spark, sf_dir):
    return mediate.parse_usage(fixtures.raw_json(spark, sf_dir)).select(*CANONICAL)


def encode_usage(spark, sf_dir):
    encoded = mediate.encode_usage(fixtures.usage(spark, sf_dir), ("record_id",))
    return mediate.parse_usage(encoded).select(*CANONICAL)


def validate_usage(spark, sf_dir):
    judged = mediate.validate_usage(fixtures.usage(spark, sf_dir))
    return judged.select("record_id", "record_type", "is_valid", "reject_reason")


def usage_unified(spark, sf_dir):
    """Calls, messages, sessions and all others kept apart, each with its own fields only, as one table again."""
    usage = fixtures.usage(spark, sf_dir)
    common = ("record_id", "record_type", "event_ts", "user_id", "cell_id", "technology")
    own = {
        "voice": ("caller_id", "callee_id", "duration_sec"),
        "sms": ("sender_id", "receiver_id"),
        "data": ("data_volume_mb", "session_duration_sec"),
    }
    tables = [usage.where(F.col("record_type") == kind).select(*common, *fields) for kind, fields in own.items()]
    others = usage.where(~F.coalesce(F.col("record_type").isin(*own), F.lit(False))).select(*common)
    return mediate.unify_usage(*tables, others)


def usage_dirty(spark, sf_dir):
    return mediate.usage_dirty(fixtures.usage(spark, sf_dir)).select(*CANONICAL, "reject_reason")


def dedup_usage(spark, sf_dir):
    return mediate.dedup_usage(fixtures.usage(spark, sf_dir))


def duplicate_report(spark, sf_dir):
    return mediate.duplicate_report(fixtures.usage(spark, sf_dir))


def rating_status(spark, sf_dir):
    """On unfiltered records, so that every status occurs."""
    return rate.rating_status(fixtures.usage(spark, sf_dir)).select("record_id", "status")


def rate_usage(spark, sf_dir):
    return rate.rate_usage(fixtures.usage(spark, sf_dir)).select("record_id", "status", "cost")


def rated_table(spark, sf_dir):
    return rate.to_rated_table(_rated(spark, sf_dir))


def rate_by_tariff_table(spark, sf_dir):
    rated = rate.rate_by_tariff_table(fixtures.usage(spark, sf_dir), rate.default_tariff(spark))
    return rated.select("record_id", "status", "cost")


def rate_with_promotions(spark, sf_dir):
    priced = modifiers.rate_with_promotions(
        _rated(spark, sf_dir),
        fixtures.clients(spark, sf_dir),
        fixtures.plans(spark),
        fixtures.promotions(spark),
    )
    return priced.select("record_id", "base_cost", "cost")


def rate_with_many_promotions(spark, sf_dir):
    """Promotions that grow with the usage, most of them overlapping."""
    priced = modifiers.rate_with_promotions(_rated(spark, sf_dir), promotions=fixtures.many_promotions(spark, sf_dir))
    return priced.select("record_id", "base_cost", "cost")


def rate_with_plan_history(spark, sf_dir):
    """Clients change their plans, and plans their prices."""
    rated = written(_rated(spark, sf_dir), "rated")
    priced = modifiers.rate_with_promotions(rated, fixtures.plan_changes(spark, sf_dir), fixtures.plan_prices(spark))
    return priced.select("record_id", "base_cost", "cost")


def rate_with_modifiers(spark, sf_dir):
    priced = modifiers.rate_with_modifiers(
        _rated(spark, sf_dir), fixtures.hour_bands(spark), fixtures.cell_modifiers(spark)
    )
    return priced.select("record_id", "base_cost", "cost")


def charges_by_service(spark, sf_dir):
    return bill.charges_by_service(_rated(spark, sf_dir))


def billing_summary(spark, sf_dir):
    """All clean usage, copies included, under one period label."""
    return bill.billing_summary(_rated(spark, sf_dir), PERIOD, invoice_day(), period_filter=False)


def billing_summary_deduplicated(spark, sf_dir):
    """Usage of the period only, every payload charged once."""
    return bill.billing_summary(_billed_once(spark, sf_dir), PERIOD, invoice_day())


def invoice_lines(spark, sf_dir):
    return bill.invoice_lines(_rated(spark, sf_dir), PERIOD, period_filter=False)


def invoice_lines_deduplicated(spark, sf_dir):
    return bill.invoice_lines(_billed_once(spark, sf_dir), PERIOD)


def key_violations(spark, sf_dir):
    """Lines of a period and, on top, the SMS lines again: those keys must be found."""
    lines = bill.invoice_lines(_rated(spark, sf_dir), PERIOD, period_filter=False)
    again = F.when(F.col("service_type") == "SMS", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return constraints.key_violations(lines.withColumn("copy", F.explode(again)), LINE_KEY)


def billing_by_cycle(spark, sf_dir):
    return bill.billing_by_cycle(_billed_once(spark, sf_dir))


def invoice_fees(spark, sf_dir):
    return bill.invoice_fees(_billed_once(spark, sf_dir), fixtures.fees(spark)).drop("subtotal")


def billing_with_fees(spark, sf_dir):
    return bill.billing_with_fees(_billed_once(spark, sf_dir), fixtures.fees(spark))


def billable_after_quota(spark, sf_dir):
    left = bill.billable_after_quota(_billed_once(spark, sf_dir), fixtures.quotas(spark))
    return left.select("record_id", "quantity", "billable")


def invoice_documents(spark, sf_dir):
    """Taken from the nested rows again: per page its header total, number of lines, sum and last line."""
    rated = _rated(spark, sf_dir)
    pages = documents.invoice_documents(
        bill.billing_summary(rated, PERIOD, invoice_day(), period_filter=False),
        bill.invoice_lines(rated, PERIOD, period_filter=False),
        page_lines=20,
    )
    amounts = F.transform("lines", lambda line: line["line_amount"].cast("decimal(28,2)"))
    return pages.select(
        "invoice_id",
        "page",
        "pages",
        F.col("header.total_amount").alias("total_amount"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.aggregate(amounts, F.lit(0).cast("decimal(28,2)"), lambda a, b: (a + b).cast("decimal(28,2)")).alias("page_amount"),
        F.element_at("lines", -1)["line_number"].alias("last_line"),
    )


def usage_known_clients(spark, sf_dir):
    known = fixtures.subscribers(spark, sf_dir)
    return clients.usage_of_known_clients(fixtures.usage(spark, sf_dir), known).select("record_id", "payer")


def usage_unknown_clients(spark, sf_dir):
    known = fixtures.subscribers(spark, sf_dir)
    return clients.usage_of_unknown_clients(fixtures.usage(spark, sf_dir), known).select("record_id", "payer")


def clients_without_usage(spark, sf_dir):
    every = fixtures.clients(spark, sf_dir)
    return clients.clients_without_usage(_clean(spark, sf_dir), every).select("user_id", "plan", "country")


def reject_profile(spark, sf_dir):
    return reports.reject_profile(fixtures.usage(spark, sf_dir))


def pipeline_counts(spark, sf_dir):
    return reports.pipeline_counts(fixtures.usage(spark, sf_dir))


def consumption_rollup(spark, sf_dir):
    return reports.consumption_rollup(_billed_once(spark, sf_dir))


def revenue_kpi(spark, sf_dir):
    return reports.revenue_kpi(_billed_once(spark, sf_dir))


def revenue_kpi_daily(spark, sf_dir):
    return reports.revenue_kpi(_billed_once(spark, sf_dir), cycle="day")


def top_users(spark, sf_dir):
    return reports.top_users(_billed_once(spark, sf_dir))


def usage_by_hour(spark, sf_dir):
    return reports.usage_by_hour(_billed_once(spark, sf_dir))


def usage_by_weekday(spark, sf_dir):
    return reports.usage_by_weekday(_billed_once(spark, sf_dir))


def usage_by_cell_technology(spark, sf_dir):
    return reports.usage_by_cell_technology(_billed_once(spark, sf_dir))


def revenue_sketch(spark, sf_dir):
    """Weeks from stored daily sketches, beside what is exact; estimates are checked against usage and shown as verdicts."""
    usage = written(bill.billable(_billed_once(spark, sf_dir)), "billed")
    path = fresh_path(spark, "sketches")
    write_table(sketches.usage_sketches(usage), path=path)
    weeks = sketches.revenue_by_sketch(read_table(spark, path=path), "week")
    found = written(weeks.withColumnsRenamed({"users": "about", "n": "records"}), "weeks")
    week = F.to_date(F.date_trunc("week", "event_ts"))
    rows = usage.withColumns({"cycle": week, "units": charges.billed_quantity().cast("double")}).select("cycle", "record_type", "user_id", "units")
    joined = rows.join(F.broadcast(found), ["cycle", "record_type"])

    def share(condition):
        return F.avg(condition.cast("double"))

    def close(quantile, at):
        below, upto = share(F.col("units") < F.col(quantile)), share(F.col("units") <= F.col(quantile))
        return (below <= at + 0.03) & (upto >= at - 0.03)

    return joined.groupBy("cycle", "record_type").agg(
        F.max("records").alias("n"),
        F.max("quantity").alias("quantity"),
        F.max("revenue").alias("revenue"),
        F.count_distinct("user_id").alias("users"),
        (F.abs(F.max("about") - F.count_distinct("user_id")) <= F.count_distinct("user_id") * 0.06).alias("users_close"),
        close("median_quantity", 0.5).alias("median_close"),
        close("p95_quantity", 0.95).alias("p95_close"),
    )


def usage_anomalies(spark, sf_dir):
    """Planted outliers in usage that repeats itself every week."""
    weekly = fixtures.weekly_usage(mediate.dedup_usage(_clean(spark, sf_dir)))
    return anomalies.usage_anomalies(rate.rate_usage(weekly))


def usage_sessions(spark, sf_dir):
    return sessions.usage_sessions(_billed_once(spark, sf_dir), "6 hours")


def stream_sessions(spark, sf_dir):
    """A record far in the future moves the watermark past all others."""
    path = fresh_path(spark, "sessions")
    events = fixtures.table(spark, sf_dir, "events")
    late = events.limit(1).selectExpr("900000001L AS event_id", "TIMESTAMP_NTZ'2034-01-01 00:00:00' AS ts", "-1L AS user_id", "'click' AS event_type", "100D AS value", "props")
    for part in (events, late):
        part.write.mode("append").parquet(f"{path}/events")
        stream = spark.readStream.schema(fixtures.SCHEMAS["events"]).parquet(f"{path}/events")
        usage = mediate.usage_clean(mediate.type_usage(fixtures.raw_from_events(stream))).select(*CANONICAL)
        await_all([start_sessions(rate.rate_usage(usage), f"{path}/out", f"{path}/checkpoint", "6 hours", trigger=AT_ONCE, name=None)])
    return spark.read.parquet(f"{path}/out").where("user_id <> 'u-1'")


def dedup_against_history(spark, sf_dir):
    """Three batches, in which each record may be a copy of one of an earlier batch; the second one is run again."""
    path = fresh_path(spark, "history")
    usage = written(fixtures.usage(spark, sf_dir).select(*CANONICAL), "arrivals")
    copy = F.col("record_id") >= fixtures.COPY_OFFSET
    batch = F.when(copy, 2).otherwise(F.col("record_id") % 2)
    step = HistoryDedup(f"{path}/index", "check", SegmentFolder(f"{path}/out", "check", "day"))
    for batch_id in (0, 1, 1, 2):
        step(usage.where(batch == batch_id).withColumn("day", F.to_date("event_ts")), batch_id)
    schema = StructType([*usage.schema.fields]).add("day", "date")
    return read_live(spark, f"{path}/out", schema, "day").drop("day")


def _json_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.raw_from_events(fixtures.event_stream(spark, sf_dir))
    return fixtures.json_from_raw(raw)


def _mediated_files(spark: SparkSession, sf_dir: str) -> str:
    """Runs stream mediation over the events and returns the folder with its two outputs."""
    path = fresh_path(spark, "mediated")
    query = start_mediation(
        _json_stream(spark, sf_dir), "parquet", {}, f"{path}-checkpoint", path, trigger=AT_ONCE, name=None
    )
    query.awaitTermination()
    return path


def stream_mediate(spark, sf_dir):
    written = read_mediated(spark, _mediated_files(spark, sf_dir))
    return mediate.parse_usage(written.where("is_valid")).select(*CANONICAL)


def stream_mediate_rejects(spark, sf_dir):
    written = read_mediated(spark, _mediated_files(spark, sf_dir))
    return written.where("NOT is_valid").select("record_id", "reject_reason")


def stream_rate(spark, sf_dir):
    path = fresh_path(spark, "rated")
    clean = stream_clean(spark, "parquet", {}, _mediated_files(spark, sf_dir))
    query = start_rating(clean, BatchFolder(path, "check"), f"{path}-checkpoint", trigger=AT_ONCE, name=None)
    query.awaitTermination()
    return read_batches(spark, path).select("record_id", "status", "cost")


def _stream_written(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    path = fresh_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{path}-checkpoint")
        .trigger(**AT_ONCE)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(path)


def stream_dedup(spark, sf_dir):
    """The event time stands in for the arrival time; the month of events fits into the delay."""
    raw = fixtures.with_close_records(fixtures.raw_from_events(fixtures.event_stream(spark, sf_dir)))
    usage = mediate.type_usage(raw)
    arriving = usage.select(*CANONICAL, F.col("event_ts").cast("timestamp").alias("arrival_ts"))
    kept = dedup_stream(arriving, "arrival_ts", "31 days")
    return _stream_written(spark, kept.drop("record_id", "arrival_ts"), "deduplicated")


def stream_daily_usage(spark, sf_dir):
    """Consumption per user from several batches that each hold usage of all days."""
    path = fresh_path(spark, "consumption")
    events = fixtures.unordered_events(spark, sf_dir, f"{path}/events")
    usage = mediate.usage_clean(mediate.type_usage(fixtures.raw_from_events(events))).select(*CANONICAL)
    query = start_consumption(rate.rate_usage(usage), f"{path}/sums", "check", f"{path}/checkpoint", trigger=AT_ONCE, name=None)
    query.awaitTermination()
    return read_consumption(spark, f"{path}/sums")


def rated_compacted(spark, sf_dir):
    """Rated usage of twelve batches in merged segments; batches are run again, and merged by two jobs at once, meanwhile."""
    path = fresh_path(spark, "segments")
    events = fixtures.unordered_events(spark, sf_dir, f"{path}-events", batches=12)
    clean = mediate.encode_usage(mediate.usage_clean(mediate.type_usage(fixtures.raw_from_events(events))), ("record_id",))
    store = SegmentFolder(path, "check", fan_out=3, compacting=False)

    def run_twice(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        compact(spark, path, batch.schema, fan_out=3)
        store(batch, batch_id)

    start_rating(clean, run_twice, f"{path}-checkpoint", trigger=AT_ONCE, name=None).awaitTermination()
    return read_segments(spark, path).select("record_id", "status", "cost")


def stream_balance(spark, sf_dir):
    """Free units left after batches that each hold usage of all days."""
    path = fresh_path(spark, "balances")
    events = fixtures.unordered_events(spark, sf_dir, f"{path}-events")
    usage = mediate.usage_clean(mediate.type_usage(fixtures.raw_from_events(events))).select(*CANONICAL)
    query = start_balances(rate.rate_usage(usage), path, "check", f"{path}-checkpoint", trigger=AT_ONCE, name=None, fan_out=3)
    query.awaitTermination()
    return read_balances(spark, path, fixtures.quotas(spark), PERIOD)


def batch_metrics(spark, sf_dir):
    """Counts of all batches of mediation and rating, which are stopped half-way and started again from their checkpoints."""
    path = fresh_path(spark, "observed")
    events = fixtures.table(spark, sf_dir, "events").repartition(6, F.xxhash64("event_id"))
    halves = [events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")]
    metrics = BatchMetrics(spark, f"{path}/metrics", fan_out=3)
    spark.streams.addListener(metrics)
    try:
        for half in halves:
            half.write.mode("append").parquet(f"{path}/events")
            arriving = spark.readStream.schema(half.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/events")
            raw = fixtures.json_from_raw(fixtures.raw_from_events(arriving))
            mediation = start_mediation(raw, "parquet", {}, f"{path}/cp1", f"{path}/mediated", trigger=AT_ONCE, name=None)
            await_all([mediation])
            clean = stream_clean(spark, "parquet", {}, f"{path}/mediated")
            store = SegmentFolder(f"{path}/rated", "check", fan_out=3)
            rating = start_rating(clean, store, f"{path}/cp2", trigger=AT_ONCE, name=None)
            await_all([rating])
            for query in (mediation, rating):
                metrics.await_batch(query)
    finally:
        spark.streams.removeListener(metrics)
    counts = read_batch_metrics(spark, f"{path}/metrics")
    # Once by (query, batch): were a batch stored twice, its rows would add up to more.
    return counts.groupBy("metric", "counter").agg(F.sum("n").alias("n"))


def billing_published(spark, sf_dir):
    """Stored usage with prices of its own, billed and read back: the prices are the stored ones."""
    path = fresh_path(spark, "billing")
    priced = rate.rate_by_tariff_table(_clean(spark, sf_dir), fixtures.other_tariff(spark))
    write_table(priced, path=f"{path}/rated")
    bill_period(read_table(spark, path=f"{path}/rated"), path, PERIOD, invoice_day())
    return read_published(spark, path, "billing_summary", PERIOD)


def usage_unbillable(spark, sf_dir):
    """What a billing run could put on no invoice."""
    path = fresh_path(spark, "billing")
    rated = rate.rate_usage(fixtures.incomplete(_clean(spark, sf_dir)))
    bill_period(rated, path, PERIOD, invoice_day())
    return read_published(spark, path, "unbillable_usage", PERIOD).select("record_id", "problem", "cost")


def billing_full(spark, sf_dir):
    """Tariff, hours and cells, plans and promotions, quotas, and fees in sequence, up to the published invoice."""
    path = fresh_path(spark, "billing")
    rules = Rules(
        tariff=fixtures.other_tariff(spark),
        bands=fixtures.hour_bands(spark),
        cells=fixtures.cell_modifiers(spark),
        subscriptions=fixtures.clients(spark, sf_dir),
        plans=fixtures.plans(spark),
        promotions=fixtures.promotions(spark),
        quotas=fixtures.quotas(spark),
        fees=fixtures.fees(spark),
    )
    bill_period(_rated(spark, sf_dir), path, PERIOD, invoice_day(), rules=rules)
    lines = read_published(spark, path, "invoice_lines", PERIOD)
    sums = lines.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("line_amount").alias("lines_amount"))
    return read_published(spark, path, "invoices", PERIOD).join(sums, "user_id", "left")


def invoice_documents_full(spark, sf_dir):
    """Pages of a billing run with fees: header, fee rows, summary and invoice of each agree on one total."""
    path = fresh_path(spark, "billing")
    rules = Rules(subscriptions=fixtures.clients(spark, sf_dir), plans=fixtures.plans(spark), fees=fixtures.fees(spark))
    bill_period(_rated(spark, sf_dir), path, PERIOD, invoice_day(), rules=rules)
    summary, lines, invoices, fees = (
        read_published(spark, path, name, PERIOD) for name in ("billing_summary", "invoice_lines", "invoices", "invoice_fees")
    )
    pages = documents.invoice_documents(summary, lines, page_lines=20, fees=fees)
    zero = F.lit(0).cast("decimal(28,2)")
    fee_rows = F.aggregate("header.fees", zero, lambda total, fee: (total + fee["amount"]).cast("decimal(28,2)"))
    shown = pages.select(
        "invoice_id",
        "user_id",
        "page",
        "pages",
        F.col("header.subtotal").alias("subtotal"),
        F.col("header.fee_amount").alias("fee_amount"),
        F.col("header.tax_amount").alias("tax_amount"),
        F.col("header.total_amount").alias("total_amount"),
        F.size("header.fees").alias("n_fees"),
        fee_rows.alias("fee_rows"),
        "n_lines",
    )
    return shown.join(invoices.select("user_id", F.col("total_amount").alias("invoice_total")), "user_id", "left").drop("user_id")


def _landed(spark: SparkSession, sf_dir: str) -> str:
    path = f"{fresh_path(spark, 'landing')}/records"
    fixtures.raw_json(spark, sf_dir).select("value").repartition(3).write.text(path)
    return path


def landing_batch(spark, sf_dir):
    """Raw records through text files."""
    return mediate.parse_usage(read_raw(spark, _landed(spark, sf_dir))).select(*PAYLOAD)


def landing_stream(spark, sf_dir):
    """The same as a stream through mediation: normalised fields of clean records."""
    path = fresh_path(spark, "landed")
    raw = stream_raw(spark, "text", {"maxFilesPerTrigger": "1"}, _landed(spark, sf_dir))
    query = start_mediation(raw, "parquet", {}, f"{path}-checkpoint", path, trigger=AT_ONCE, name=None)
    await_all([query])
    return mediate.parse_usage(read_mediated(spark, path).where("is_valid")).select(*PAYLOAD)


def table_round_trip(spark, sf_dir):
    """Rated usage through a stored table, billed twice into result tables, and read back: one run shows."""
    path = fresh_path(spark, "tables")
    stored = rate.to_rated_table(_rated(spark, sf_dir))
    doubles = {name: F.col(name).cast("double") for name in ("data_volume_mb", "cost")}
    batches = BatchTable("check", "parquet", path=f"{path}/rated")
    for _ in range(2):
        batches(stored.withColumns(doubles).withColumnRenamed("timestamp", "event_ts"), 0)
    for _ in range(2):
        attempts = read_table(spark, path=f"{path}/rated_attempts")
        rated = rate.from_rated_table(read_table(spark, path=f"{path}/rated"), PERIOD, attempts)
        run = bill_period(rated, f"{path}/billing", PERIOD, invoice_day())
        tables = {name: read_published(spark, f"{path}/billing", name, PERIOD) for name in ("billing_summary", "invoice_lines")}
        publish_tables(tables, PERIOD, run, "parquet", path=f"{path}/database")
    summary, lines = (read_published_table(spark, name, PERIOD, "parquet", path=f"{path}/database") for name in tables)
    sums = lines.groupBy("invoice_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("line_amount").alias("lines_amount"))
    return summary.join(sums, "invoice_id", "left").select("invoice_id", "subtotal", "total_amount", "n_lines", "lines_amount")


def csv_round_trip(spark, sf_dir):
    path = fresh_path(spark, "csv")
    lines = bill.invoice_lines(_rated(spark, sf_dir), PERIOD, period_filter=False)
    export_csv(lines, path)
    return spark.read.schema(lines.schema).option("header", True).csv(path)


def client_ids(spark, sf_dir):
    path = fresh_path(spark, "clients")
    write_table(fixtures.clients(spark, sf_dir), path=path)
    write_table(fixtures.clients(spark, sf_dir), path=path)
    return read_clients(spark, path=path)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        usage_canonical,
        parse_usage,
        encode_usage,
        usage_unified,
        validate_usage,
        usage_dirty,
        dedup_usage,
        duplicate_report,
        rating_status,
        rate_usage,
        rated_table,
        rate_by_tariff_table,
        rate_with_promotions,
        rate_with_many_promotions,
        rate_with_plan_history,
        rate_with_modifiers,
        charges_by_service,
        billing_summary,
        billing_summary_deduplicated,
        invoice_lines,
        invoice_lines_deduplicated,
        key_violations,
        billing_by_cycle,
        invoice_fees,
        billing_with_fees,
        billable_after_quota,
        invoice_documents,
        usage_known_clients,
        usage_unknown_clients,
        clients_without_usage,
        reject_profile,
        pipeline_counts,
        consumption_rollup,
        revenue_kpi,
        revenue_kpi_daily,
        top_users,
        usage_by_hour,
        usage_by_weekday,
        usage_by_cell_technology,
        revenue_sketch,
        usage_anomalies,
        usage_sessions,
        stream_sessions,
        dedup_against_history,
        stream_mediate,
        stream_mediate_rejects,
        stream_rate,
        stream_dedup,
        stream_daily_usage,
        rated_compacted,
        batch_metrics,
        stream_balance,
        billing_published,
        usage_unbillable,
        billing_full,
        invoice_documents_full,
        landing_batch,
        landing_stream,
        table_round_trip,
        csv_round_trip,
        client_ids,
    )
} | {"usage_clean": _clean}


def _plain(query: Query) -> Query:
    return lambda spark, sf_dir: plain(query(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _plain(query) for name, query in QUERIES.items()}
