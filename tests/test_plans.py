"""Plans that must stay as they are for large inputs."""

import re

import pytest
from pyspark.sql import functions as F

from meterline.checks import fixtures
from meterline.checks.queries import QUERIES
from meterline.operators import bill, clients, mediate, modifiers, rate, reports
from meterline.schema import CANONICAL
from meterline.session import SETTINGS, session, size_shuffles
from meterline.streaming.jobs import mediated

#: The JVM's just-in-time compiler leaves larger methods alone, and they then run interpreted for ever.
LARGEST_COMPILED_METHOD = 8000


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "json")
    fixtures.raw_json(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def rated(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "rated")
    clean = mediate.usage_clean(fixtures.usage(spark, sf_dir)).select(*CANONICAL)
    rate.rate_usage(clean).write.partitionBy("billing_period").parquet(path)
    return spark.read.parquet(path)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", physical(df)))


def read_columns(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        found = re.findall(r"ReadSchema: struct<([^>]*)>", physical(df.select("*")))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    return {name for schema in found for name in re.findall(r"(\w+):", schema)}


def test_map_only_stages_do_not_shuffle(raw):
    clean = mediate.usage_clean(mediate.parse_usage(raw)).select(*CANONICAL)
    assert "Exchange" not in physical(rate.rate_usage(clean))
    assert "Exchange" not in physical(mediate.encode_usage(mediate.validate_usage(mediate.parse_usage(raw))))


def test_summary_is_one_exchange_over_few_columns(rated):
    summary = bill.billing_summary(rated, "2024-01")
    assert exchanges(summary) == 1
    assert "EqualTo(status,rated)" in physical(summary)
    assert "PartitionFilters: [isnotnull(billing_period" in physical(summary)
    assert read_columns(summary) == {"record_type", "caller_id", "sender_id", "user_id", "status", "cost"}


def test_lines_are_one_exchange(rated):
    lines = bill.invoice_lines(rated, "2024-01")
    assert exchanges(lines) == 1
    assert read_columns(lines) >= {"record_id", "event_ts", "cost"}
    assert not read_columns(lines) & {"callee_id", "cell_id", "technology", "session_duration_sec"}


def test_fees_add_no_exchange_to_the_totals(spark, rated):
    assert exchanges(bill.billing_with_fees(rated, fixtures.fees(spark))) == 1


def test_copies_are_dropped_in_one_exchange(rated):
    plan = physical(mediate.dedup_usage(rated))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_min(record_id" in plan


def test_few_rules_are_broadcast_whatever_the_estimate(spark, rated, sf_dir):
    """Usage is not exchanged on its few types, hours, days, cells or scopes."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        builds = [
            modifiers.rate_with_modifiers(rated, fixtures.hour_bands(spark), fixtures.cell_modifiers(spark)),
            modifiers.rate_with_promotions(rated, fixtures.clients(spark, sf_dir), fixtures.plans(spark), fixtures.promotions(spark)),
            rate.rate_by_tariff_table(rated.drop("status", "cost", "billing_period"), fixtures.other_tariff(spark)),
            bill.billable_after_quota(rated, fixtures.quotas(spark)),
            bill.billing_with_fees(rated, fixtures.fees(spark)),
        ]
        plans = [physical(df) for df in builds]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        # What is exchanged on such a key, if anything, is the rule table.
        few = r"Exchange hashpartitioning\((?:record_type|service|weekend|hour|day|cell_id|scope)#[^)]*\)"
        assert not [m for m in re.findall(few + r".*?(LocalTableScan|FileScan)", plan, re.S) if m == "FileScan"]
    assert [plan.count("BroadcastHashJoin") for plan in plans] == [2, 1, 1, 1, 0]


def test_a_stored_table_is_read_for_its_period_alone(spark, rated, tmp_path):
    path = str(tmp_path / "stored")
    rate.to_rated_table(rated).write.parquet(path)
    plan = physical(rate.from_rated_table(spark.read.parquet(path), "2024-01"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", physical(rate.from_rated_table(spark.read.parquet(path), "2024-01").select("*")))[1]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(status,rated)" in pushed
    assert "GreaterThanOrEqual(timestamp,2024-01-01T00:00)" in pushed and "LessThan(timestamp,2024-02-01T00:00)" in pushed
    assert "Exchange" not in plan


def test_a_period_of_batches_does_not_list_the_others(spark, rated, tmp_path):
    from meterline.sinks import BatchFolder
    from meterline.sources import read_batches

    path = str(tmp_path / "batches")
    usage = rated.withColumn("billing_period", F.when(F.col("record_id") % 3 == 0, "2024-02").when(F.col("record_id") % 3 == 1, "2024-01"))
    for batch in (0, 1, 1):
        BatchFolder(path, "r")(usage, batch)
    january = read_batches(spark, path, "2024-01")
    assert not any("billing_period=2024-02" in name for name in january.inputFiles())
    assert january.count() == 2 * usage.where("billing_period = '2024-01' OR billing_period IS NULL").count()
    assert read_batches(spark, path).count() == 2 * usage.count()


def test_rank_limit_is_applied_before_the_exchange(rated):
    plan = physical(reports.top_users(rated))
    assert re.search(r"WindowGroupLimit .* Partial", plan)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInArrow")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream")))
def test_no_query_pairs_everything_or_uses_one_task_or_python(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    assert not [operator for operator in FORBIDDEN if operator in plan]
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("delay", [None, "7 days"])
def test_no_stream_uses_python(spark, sf_dir, tmp_path, delay):
    raw = fixtures.json_from_raw(fixtures.raw_from_events(fixtures.event_stream(spark, sf_dir)))
    raw = raw.withColumn("arrival_ts", F.current_timestamp())
    query = mediated(raw, delay).writeStream.format("noop").option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert not [operator for operator in FORBIDDEN if operator in plan]
    assert ("StreamingDeduplicateWithinWatermark" in plan) == (delay is not None)


def generated_sizes(spark, build):
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = debug.codegenString(build()._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def test_generated_code_is_small_enough_to_be_compiled(spark, sf_dir, raw, rated):
    builds = {
        "validate": lambda: mediate.validate_usage(mediate.parse_usage(raw)),
        "rate": lambda: rate.rate_usage(mediate.usage_clean(mediate.parse_usage(raw))),
        "mediated": lambda: mediated(raw),
        "dedup": lambda: mediate.dedup_usage(mediate.parse_usage(raw)),
        "summary": lambda: bill.billing_summary(rated, "2024-01"),
        "lines": lambda: bill.invoice_lines(rated, "2024-01"),
        "modifiers": lambda: modifiers.rate_with_modifiers(rated, fixtures.hour_bands(spark), fixtures.cell_modifiers(spark)),
        "rollup": lambda: reports.consumption_rollup(rated),
        "kpi": lambda: reports.revenue_kpi(rated),
        "profile": lambda: reports.reject_profile(mediate.parse_usage(raw)),
        "counts": lambda: reports.pipeline_counts(mediate.parse_usage(raw)),
    }
    registered = {name: query for name, query in QUERIES.items() if not name.startswith("stream")}
    builds |= {name: lambda query=query: query(spark, sf_dir) for name, query in registered.items()}
    sizes = {name: max(generated_sizes(spark, build), default=0) for name, build in builds.items()}
    assert {name: size for name, size in sizes.items() if size > LARGEST_COMPILED_METHOD} == {}


def test_skewed_client_join_is_split(spark):
    """A payer with most of the usage: the join partition it falls into is split at run time."""
    usage = spark.range(0, 400_000, numPartitions=8).select(
        F.col("id").alias("record_id"), F.lit("data").alias("record_type"), F.lit("").alias("caller_id"), F.lit("").alias("sender_id"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("u"), F.col("id") % 1000)).otherwise("hot").alias("user_id"),
    )
    known = spark.range(500).select(F.concat(F.lit("u"), "id").alias("user_id")).union(spark.sql("SELECT 'hot'"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for build in (clients.usage_of_known_clients, clients.usage_of_unknown_clients):
            joined = build(usage, known).select("record_id")
            assert joined.collect()
            assert "skew=true" in physical(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_session_settings(spark):
    assert session("tests").conf.get("spark.sql.session.timeZone") == "UTC"
    assert SETTINGS["spark.ui.enabled"] == "false"


def test_shuffles_are_sized_by_what_is_read(spark, rated):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(rated) == 200
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
        wide = spark.range(10**12).select("id", F.lit("x" * 10).alias("x"))
        assert size_shuffles(wide) > 30_000
        assert size_shuffles(wide, input_gb=100_000) == 390_625
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_billing_reads_usage_by_client_without_an_exchange(spark, sf_dir, rated):
    """Totals, sizes, line numbers and quotas on what is laid out by payer once."""
    from meterline.plans.clients import bucketed, write_by_client

    usage = bill.usage_of_period(rated, "2024-01", False)
    (part,) = write_by_client(usage)
    after = bill.price_after_quota(part, fixtures.quotas(spark))
    again = bucketed(after.drop("base_cost"), "again")
    sizes = part.groupBy("payer", "billing_period").count()
    lines, charged = bill.invoice_lines(part), bill.invoice_charges(part, None, fixtures.fees(spark))
    for build in (lines, charged, sizes, after, bill.invoice_lines(again)):
        plan = physical(build)
        assert not re.search(r"Exchange (hash|range)partitioning\((?!service#)", plan)  # the rules of a service alone
        assert "Bucketed: true" in plan
    assert sorted(map(repr, lines.collect())) == sorted(map(repr, bill.invoice_lines(usage).collect()))
    own = bill.billable_after_quota(usage, fixtures.quotas(spark)).select("record_id", "billable")
    assert sorted(bill.billable_after_quota(part, fixtures.quotas(spark)).select("record_id", "billable").collect()) == sorted(own.collect())


def test_hot_payers_stay_out_of_the_buckets(spark, rated):
    from meterline.plans.clients import write_by_client

    usage = bill.usage_of_period(rated, "2024-01", False)
    parts = write_by_client(usage, hot_rows=50)
    assert len(parts) == 2 and parts[0].columns == parts[1].columns
    payers = [{row["payer"] for row in part.select("payer").distinct().collect()} for part in parts]
    assert payers[1] and not payers[0] & payers[1]
    lines = [bill.invoice_lines(part, hot_rows=50) for part in parts]
    assert sorted(map(repr, lines[0].unionByName(lines[1]).collect())) == sorted(map(repr, bill.invoice_lines(usage).collect()))
