"""Sources, sinks, streaming jobs and the command line: round trips through files."""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from meterline import jobs, sinks, sources, streaming
from meterline.checks import fixtures
from meterline.checks.queries import queries
from meterline.jobs import bill as bill_job
from meterline.jobs import mediate as mediate_job
from meterline.jobs import options as job_options
from meterline.jobs import rate as rate_job
from meterline.operators import bill, documents, mediate, rate
from meterline.plans import pipeline
from meterline.schema import CANONICAL

AT_ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def landing(spark, sf_dir, tmp_path_factory):
    """The raw records as JSON lines, in several files."""
    path = str(tmp_path_factory.mktemp("landing") / "raw")
    fixtures.raw_json(spark, sf_dir).select("value").repartition(3).write.text(path)
    return path


@pytest.fixture(scope="module")
def rated(spark, sf_dir):
    return rate.rate_usage(mediate.usage_clean(fixtures.usage(spark, sf_dir)).select(*CANONICAL))


def same_rows(left, right):
    assert left.columns == right.columns
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def no_id(df):
    return df.drop("record_id")


def test_landing_files_as_batch(spark, sf_dir, landing):
    raw = sources.read_raw(spark, landing)
    assert raw.select("record_id").distinct().count() == raw.count() == 1050
    assert raw.where("arrival_ts IS NULL").count() == 0
    parsed = mediate.parse_usage(raw).select(*CANONICAL)
    assert same_rows(no_id(parsed), no_id(fixtures.usage(spark, sf_dir).select(*CANONICAL)))
    once, copies = pipeline.rated_usage(raw), pipeline.rated_usage(raw, dedup=False)
    assert (once.count(), copies.count()) == (630, 672)


def test_file_stream_gives_every_line_an_id(spark, landing, tmp_path):
    stream = sources.stream_raw(spark, "text", {"maxFilesPerTrigger": "1"}, landing)
    out = str(tmp_path / "out")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(**AT_ONCE)
    writer.start(out).awaitTermination()
    written = spark.read.parquet(out)
    assert written.select("record_id").distinct().count() == written.count() == 1050


def test_unknown_source_format(spark):
    with pytest.raises(ValueError):
        sources.stream_raw(spark, "carrier pigeon", {})


def test_message_source_reads_bytes_and_positions(spark):
    from meterline.sources.raw import _from_messages, _topics

    messages = spark.sql(
        "SELECT CAST('{}' AS BINARY) AS value, t AS topic, p AS partition, o AS offset, TIMESTAMP'2024-01-01' AS timestamp "
        "FROM VALUES ('a', 0, 5L), ('a', 3, 5L), ('a', 3, 6L), ('b', 0, 5L) AS m(t, p, o)"
    )
    rows = _from_messages(messages, _topics({"subscribe": "a, b"})).orderBy("record_id").collect()
    assert [row["record_id"] for row in rows] == [5, (3 << 43) + 5, (3 << 43) + 6, (1 << 57) + 5]
    assert rows[0]["value"] == "{}"
    with pytest.raises(ValueError):
        _topics({"subscribePattern": ".*"})
    with pytest.raises(ValueError):
        _topics({"subscribe": ",".join(map(str, range(65)))})


def test_messages_name_their_topic(spark, sf_dir):
    from meterline.streaming.jobs import mediated, to_messages

    messages = to_messages(mediated(fixtures.raw_json(spark, sf_dir)), "good", "bad")
    counts = {row["topic"]: row["count"] for row in messages.groupBy("topic").count().collect()}
    assert counts == {"good": 672, "bad": 378}
    assert messages.schema["headers"].dataType.simpleString() == "array<struct<key:string,value:binary>>"
    letter = messages.where("topic = 'bad'").first()
    assert letter["headers"][0]["key"] == "reject_reason" and b":" in letter["headers"][0]["value"]
    assert messages.where("topic = 'good' AND headers IS NOT NULL").count() == 0


def test_jdbc_options():
    plain = sources.jdbc_options("jdbc:x", "rated", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "rated", "fetchsize": "10000", "user": "u"}
    parallel = sources.jdbc_options("jdbc:x", "rated", "timestamp", "2024-01-01", "2024-02-01", 8)
    assert parallel["numPartitions"] == "8" and parallel["partitionColumn"] == "timestamp"
    with pytest.raises(ValueError):
        sources.jdbc_options("jdbc:x", "rated", "timestamp")


def test_tables_and_clients(spark, rated, tmp_path):
    path = str(tmp_path / "rated")
    sinks.write_table(rated, path=path, partition_by=["billing_period"])
    back = sources.read_table(spark, path=path)
    assert same_rows(back.select(*rated.columns).withColumn("billing_period", F.col("billing_period").cast("string")), rated)
    plan = bill.billing_summary(back, "2024-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(billing_period" in plan and "EqualTo(status,rated)" in plan
    sinks.write_table(spark.sql("SELECT * FROM VALUES ('a', 1), ('a', 2), ('b', 1) AS t(user_id, x)"), path=f"{path}-clients")
    assert sorted(r[0] for r in sources.read_clients(spark, path=f"{path}-clients").collect()) == ["a", "b"]


def test_csv(spark, rated, tmp_path):
    lines = bill.invoice_lines(rated, "2024-01")
    for single in (False, True):
        path = str(tmp_path / f"csv-{single}")
        sinks.export_csv(lines, path, single)
        back = spark.read.schema(lines.schema).option("header", True).csv(path)
        assert same_rows(back, lines)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1


def test_documents(spark, rated, tmp_path):
    lines, summary = bill.invoice_lines(rated, "2024-01"), bill.billing_summary(rated, "2024-01")
    pages = documents.invoice_documents(summary, lines, page_lines=30)
    for fmt in ("json", "xml"):
        sinks.write_documents(pages, str(tmp_path / fmt), fmt)
    json_lines = spark.read.schema(pages.schema).json(str(tmp_path / "json")).select(F.inline("lines"))
    xml = spark.read.format("xml").options(rowTag="invoice").load(str(tmp_path / "xml"))
    assert json_lines.count() == lines.count() == xml.select(F.inline("lines.line")).count() == 672
    assert xml.agg(F.sum("page_amount").cast("decimal(12,2)")).first() == lines.agg(F.sum("line_amount").cast("decimal(12,2)")).first()
    text = documents.document_json(pages.where("invoice_id = '202401u1'")).first()["value"]
    assert json.loads(text)["header"]["billing_period"] == "2024-01"
    with pytest.raises(ValueError):
        sinks.write_documents(pages, str(tmp_path / "pdf"), "pdf")


def test_publishing_replaces_a_period_as_a_whole(spark, rated, tmp_path):
    path = str(tmp_path)
    with pytest.raises(Exception):
        sinks.read_published(spark, path, "billing_summary", "2024-01")
    pipeline.bill_period(rated, path, "2024-01")
    first = sinks.read_published(spark, path, "billing_summary", "2024-01").count()
    # Only the summary of the next run is written: readers still see the earlier run.
    bill.billing_summary(rated.limit(0), "2024-01").write.parquet(f"{path}/billing_summary/period=2024-01/run=broken")
    assert sinks.read_published(spark, path, "billing_summary", "2024-01").count() == first == 15
    pipeline.bill_period(rated.where("user_id = 'u1'"), path, "2024-01")
    usage = sinks.read_published(spark, path, "billed_usage", "2024-01")
    assert sinks.read_published(spark, path, "unbillable_usage", "2024-01").count() == 0
    assert usage.count() == sinks.read_published(spark, path, "invoice_lines", "2024-01").count() > 0
    lines = sinks.read_published(spark, path, "invoice_lines", "2024-01")
    assert [r[0] for r in lines.select("invoice_id").distinct().collect()] == ["202401u1"]
    with pytest.raises(LookupError):
        sinks.read_published(spark, path, "invoice_lines", "2024-02")


def test_mediation_stream_splits_and_counts(spark, sf_dir, landing, tmp_path):
    raw = sources.stream_raw(spark, "text", {"maxFilesPerTrigger": "1"}, landing)
    out = str(tmp_path / "out")
    query = streaming.start_mediation(raw, "parquet", {}, str(tmp_path / "cp"), out, trigger=AT_ONCE)
    streaming.await_all([query])
    written = sources.read_mediated(spark, out)
    assert written.count() == 1050
    dirty = written.where("NOT is_valid")
    assert dirty.where("reject_reason IS NULL").count() == 0
    originals = spark.read.text(landing)
    assert dirty.select("value").exceptAll(originals).count() == 0
    observed = [p["observedMetrics"]["mediation"] for p in map(json.loads, (p.json for p in query.recentProgress)) if p["observedMetrics"]]
    assert sum(o["records"] for o in observed) == 1050
    assert sum(o["clean"] for o in observed) == 672
    assert sum(o["dirty"] for o in observed) == dirty.count() == 378


def test_rating_stream_equals_batch_and_survives_a_failed_batch(spark, sf_dir, landing, rated, tmp_path):
    raw = sources.stream_raw(spark, "text", {}, landing)
    mediated = str(tmp_path / "mediated")
    streaming.start_mediation(raw, "parquet", {}, str(tmp_path / "cp1"), mediated, trigger=AT_ONCE).awaitTermination()
    out, checkpoint = str(tmp_path / "rated"), str(tmp_path / "cp2")
    write = sinks.BatchFolder(out, "first")

    def fails_after_writing(batch, batch_id):
        write(batch, batch_id)
        raise OSError("lost connection")

    clean = sources.stream_clean(spark, "parquet", {}, mediated)
    broken = streaming.start_rating(clean, fails_after_writing, checkpoint, AT_ONCE)
    with pytest.raises(StreamingQueryException):
        streaming.await_all([broken])
    again = streaming.start_rating(clean, write, checkpoint, AT_ONCE)
    streaming.await_all([again])
    result = sources.read_batches(spark, out)
    assert same_rows(no_id(result), no_id(rated).select(*no_id(result).columns))
    plan = result.where("billing_period = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(billing_period" in plan
    observed = json.loads(again.lastProgress.json)["observedMetrics"]["rating"]
    assert observed == {"records": 672, "rated": 672}


def test_appended_batches_carry_their_origin(spark, rated, tmp_path):
    path = str(tmp_path / "table")
    write = sinks.BatchTable("r", "parquet", path=path)
    for batch_id in (0, 1, 1):
        write(rated, batch_id)
    table = sources.read_table(spark, path=path)
    assert [tuple(r) for r in table.groupBy("run", "batch_id").count().orderBy("batch_id").collect()] == [("r", 0, 672), ("r", 1, 1344)]
    assert rate.from_rated_table(table).count() == 1344
    assert mediate.dedup_usage(rate.from_rated_table(table)).count() == 630


def test_billing_a_stored_table_with_floating_point(spark, rated, tmp_path):
    """Usage that another system rated into doubles and instants gives the same invoices."""
    doubles = {n: F.col(n).cast("double") for n in ("duration_sec", "data_volume_mb", "session_duration_sec", "cost")}
    stored = rate.to_rated_table(rated).withColumns({**doubles, "timestamp": F.col("timestamp").cast("timestamp")})
    path = str(tmp_path / "rated")
    stored.write.parquet(path)
    usage = rate.from_rated_table(sources.read_table(spark, path=path))
    day = F.to_date(F.lit("2024-02-01"))
    assert same_rows(bill.billing_summary(usage, "2024-01", day), bill.billing_summary(rated, "2024-01", day))
    pipeline.bill_period(usage, str(tmp_path / "billing"), "2024-01", day)
    assert sinks.read_published(spark, str(tmp_path / "billing"), "invoice_lines", "2024-01").count() == 630


def test_stream_dedup_across_batches(spark, tmp_path):
    """Copies in one batch and in a later one; the same payload again after the delay is a new record."""
    source = tmp_path / "in"
    schema = fixtures_schema = ", ".join(
        f"{n} {t}"
        for n, t in [("record_id", "BIGINT"), ("record_type", "STRING"), ("event_ts", "TIMESTAMP_NTZ"), ("caller_id", "STRING"),
                     ("callee_id", "STRING"), ("duration_sec", "INT"), ("sender_id", "STRING"), ("receiver_id", "STRING"),
                     ("user_id", "STRING"), ("data_volume_mb", "DECIMAL(18,6)"), ("session_duration_sec", "INT"),
                     ("cell_id", "STRING"), ("technology", "STRING"), ("arrival_ts", "TIMESTAMP")]
    )
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def arrive(*rows):
        values = [
            f"({i}L, 'sms', TIMESTAMP_NTZ'2024-01-01', '', '', NULL, '{who}', 'x', '{who}', NULL, NULL, 'c', '4G', TIMESTAMP'{at}')"
            for i, (who, at) in enumerate(rows)
        ]
        names = ", ".join(part.split(" ")[0] for part in schema.replace("(18,6)", "").split(", "))
        df = spark.sql(f"SELECT * FROM VALUES {', '.join(values)} AS t({names})")
        typed = df.selectExpr(*[f"CAST({p.rsplit(' ', 1)[0]} AS {p.rsplit(' ', 1)[1]}) AS {p.rsplit(' ', 1)[0]}" for p in schema.split(", ")])
        typed.coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(fixtures_schema).parquet(str(source))
        kept = streaming.dedup_stream(stream, "arrival_ts", "1 hour")
        writer = kept.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(**AT_ONCE)
        writer.start(out).awaitTermination()
        return sorted((r["sender_id"], str(r["arrival_ts"])) for r in spark.read.parquet(out).collect())

    first = arrive(("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:01:00"), ("b", "2024-01-01 10:02:00"))
    assert [who for who, _ in first] == ["a", "b"]
    assert len(arrive(("a", "2024-01-01 10:30:00"), ("c", "2024-01-01 10:30:00"))) == 3
    assert len(arrive(("d", "2024-01-01 14:00:00"))) == 4
    assert len(arrive(("a", "2024-01-01 14:10:00"))) == 5


def test_copies_are_thinned_before_they_reach_state(spark, tmp_path):
    """20,000 copies of one record do not meet in one task."""
    path = str(tmp_path / "copies")
    one = fixtures.usage(spark, "/root/testdata/sf0.001").select(*CANONICAL).where("record_id = 1")
    copies = one.drop("record_id").crossJoin(spark.range(20_000).withColumnRenamed("id", "record_id"))
    copies.withColumn("arrival_ts", F.expr("TIMESTAMP'2024-01-01 00:00:00'")).repartition(4).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    kept = streaming.dedup_stream(stream, "arrival_ts", "1 hour")
    out = str(tmp_path / "out")
    query = kept.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(**AT_ONCE).start(out)
    query.awaitTermination()
    assert spark.read.parquet(out).count() == 1
    states = [json.loads(p.json)["stateOperators"] for p in query.recentProgress]
    dropped = [sum(found[i]["customMetrics"]["numDroppedDuplicateRows"] for found in states if found) for i in (0, 1)]
    assert sum(dropped) == 19_999
    # Spread over the salts first: the step that has to bring all copies together sees a handful.
    assert min(dropped) < streaming.jobs.SALTS


def test_shared_folder_is_never_local_on_a_cluster(spark):
    from types import SimpleNamespace

    from meterline.plans.shared_folder import fresh_path, shared_folder

    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None),
    )
    for master in ("yarn", "local-cluster[3,2,3000]", "spark://host:7077"):
        cluster.sparkContext.master = master
        with pytest.raises(RuntimeError):
            shared_folder(cluster)
    cluster.sparkContext.getCheckpointDir = lambda: "hdfs://shared/cp"
    assert shared_folder(cluster) == "hdfs://shared/cp"
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_stream_equals_batch(spark, sf_dir):
    named = queries()
    assert same_rows(named["stream_mediate"](spark, sf_dir), named["usage_clean"](spark, sf_dir))


def test_await_all_raises_the_failure_of_any(spark, sf_dir, tmp_path):
    def fail(batch, batch_id):
        raise OSError("disk full")

    events = fixtures.event_stream(spark, sf_dir)
    running = events.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "a")).start()
    failing = events.writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "b")).start()
    with pytest.raises(StreamingQueryException):
        streaming.await_all([running, failing])
    assert not running.isActive


def test_stored_prices_stay_through_deduplication(spark, rated, tmp_path):
    """Prices that no tariff here gives: billed as they are, whether copies are removed or not."""
    doubled = rated.withColumn("cost", (F.col("cost") * 2).cast("decimal(20,6)"))
    once = pipeline.rated_once(rated)
    for dedup, source in ((True, once), (False, rated)):
        path = str(tmp_path / str(dedup))
        pipeline.bill_period(doubled, path, "2024-01", dedup=dedup)
        billed = sinks.read_published(spark, path, "billing_summary", "2024-01").agg(F.sum("subtotal")).first()[0]
        assert billed == 2 * source.agg(F.sum("cost").cast("decimal(18,2)")).first()[0]


def test_billed_unbillable_and_copies_are_all_that_was_rated(spark, rated, tmp_path):
    usage = rate.rate_usage(fixtures.incomplete(rated.select(*CANONICAL)))
    pipeline.bill_period(usage, str(tmp_path), "2024-01")
    billed, unbillable, lines = (sinks.read_published(spark, str(tmp_path), n, "2024-01") for n in ("billed_usage", "unbillable_usage", "invoice_lines"))
    accepted = usage.where("status = 'rated'")
    copies = accepted.count() - pipeline.rated_once(usage).count()
    assert unbillable.where("problem = 'time'").count() > 0 and unbillable.where("problem = 'payer'").count() > 0
    assert billed.count() + unbillable.count() + copies == accepted.count()
    assert lines.count() == billed.count()


def test_published_tables_show_one_run(spark, rated, tmp_path):
    path = str(tmp_path)
    lines = bill.invoice_lines(rated, "2024-01")
    for run in ("a", "b"):
        sinks.publish_tables({"invoice_lines": lines}, "2024-01", run, "parquet", path=path)
    lines.withColumns({"period": F.lit("2024-01"), "run": F.lit("unfinished")}).write.mode("append").parquet(f"{path}/invoice_lines")
    assert same_rows(sources.read_published_table(spark, "invoice_lines", "2024-01", "parquet", path=path), lines)
    with pytest.raises(LookupError):
        sources.read_published_table(spark, "invoice_lines", "2024-02", "parquet", path=path)


def test_consumption_counts_late_and_undated_usage(spark, sf_dir, rated, tmp_path):
    usage = rate.rate_usage(fixtures.incomplete(rated.select(*CANONICAL)))
    usage.repartition(5, F.xxhash64("record_id")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(usage.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "sums")
    query = streaming.start_consumption(stream, out, "r", str(tmp_path / "cp"), "1 hour", AT_ONCE)
    streaming.await_all([query])
    assert len({p["batchId"] for p in map(json.loads, (p.json for p in query.recentProgress))}) > 3
    found = sources.read_consumption(spark, out)
    assert same_rows(found, streaming.window_sums(usage, "1 hour").select(*found.columns))
    assert found.agg(F.sum("n")).first()[0] == usage.count()
    assert found.where("window_start IS NULL").count() > 0


def test_mediation_leaves_out_copies_and_keeps_every_dead_letter(spark, landing, tmp_path):
    raw = sources.stream_raw(spark, "text", {"maxFilesPerTrigger": "1"}, landing)
    out = str(tmp_path / "out")
    streaming.await_all([streaming.start_mediation(raw, "parquet", {}, str(tmp_path / "cp"), out, trigger=AT_ONCE, dedup_delay="30 days")])
    counts = {row["is_valid"]: row["count"] for row in sources.read_mediated(spark, out).groupBy("is_valid").count().collect()}
    assert counts == {True: 630, False: 378}


def test_jobs_with_rules(spark, landing, tmp_path):
    """Landing files through deduplicating mediation, consumption and billing with every kind of rule table."""
    from meterline.jobs import consume as consume_job

    def at(name):
        return str(tmp_path / name)

    mediate_job.main(["--source-format", "text", "--source-path", landing, "--sink-format", "parquet", "--sink-path", at("mediated"),
                      "--checkpoint", at("cp1"), "--once", "--dedup-delay", "30 days"])
    consume_job.main(["--source-format", "parquet", "--source-path", at("mediated"), "--path", at("sums"), "--run", "r", "--checkpoint", at("cp2"), "--once"])
    assert sources.read_consumption(spark, at("sums")).agg(F.sum("n")).first()[0] == 630
    rate_job.main(["--source-format", "parquet", "--source-path", at("mediated"), "--rated-path", at("rated"), "--run", "r1", "--checkpoint", at("cp3"), "--once"])
    rules = {"tariff": fixtures.other_tariff(spark), "bands": fixtures.hour_bands(spark), "cells": fixtures.cell_modifiers(spark), "plans": fixtures.plans(spark),
             "subscriptions": fixtures.clients(spark, "/root/testdata/sf0.001"), "promotions": fixtures.promotions(spark), "quotas": fixtures.quotas(spark), "fees": fixtures.fees(spark)}
    arguments = []
    for name, table in rules.items():
        table.write.parquet(at(name))
        arguments += [f"--{name}", at(name)]
    bill_job.main(["--rated-path", at("rated"), "--period", "2024-01", "--path", at("billing"), *arguments])
    invoices = sinks.read_published(spark, at("billing"), "invoices", "2024-01")
    expected = queries()["billing_full"](spark, "/root/testdata/sf0.001")
    assert invoices.count() == expected.count() == 15
    assert float(invoices.agg(F.sum("total_amount")).first()[0]) == pytest.approx(expected.agg(F.sum("total_amount")).first()[0])


def test_options_take_credentials_from_the_environment(monkeypatch):
    monkeypatch.setenv("DB_PASSWORD", "secret")
    assert job_options.options(["user=me", "password=$DB_PASSWORD", "url=a=b"]) == {"user": "me", "password": "secret", "url": "a=b"}
    with pytest.raises(Exception):
        job_options.options(["user"])


def test_jobs_from_landing_to_invoices(spark, landing, tmp_path):
    def at(name):
        return str(tmp_path / name)

    mediate_job.main(["--source-format", "text", "--source-path", landing, "--sink-format", "parquet", "--sink-path", at("mediated"),
                      "--checkpoint", at("cp1"), "--once"])
    rate_job.main(["--source-format", "parquet", "--source-path", at("mediated"), "--rated-path", at("rated"), "--run", "r1",
                   "--checkpoint", at("cp2"), "--once"])
    bill_job.main(["--rated-path", at("rated"), "--period", "2024-01", "--path", at("billing"), "--csv", at("csv"),
                   "--documents", at("xml"), "--document-format", "xml"])
    rate_job.main(["--source-format", "parquet", "--source-path", at("mediated"), "--rated-format", "parquet", "--rated-path", at("stored"),
                   "--run", "r1", "--checkpoint", at("cp3"), "--once"])
    bill_job.main(["--rated-format", "parquet", "--rated-path", at("stored"), "--period", "2024-01", "--path", at("billing2"), "--keep-copies"])
    assert sinks.read_published(spark, at("billing2"), "invoice_lines", "2024-01").count() == 672
    summary = sinks.read_published(spark, at("billing"), "billing_summary", "2024-01")
    expected = queries()["billing_summary_deduplicated"](spark, "/root/testdata/sf0.001")
    assert summary.agg(F.sum("total_amount").cast("double")).first()[0] == pytest.approx(expected.agg(F.sum("total_amount")).first()[0])
    assert spark.read.option("header", True).csv(at("csv")).count() == 630
    assert jobs.__doc__
