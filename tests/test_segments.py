"""Segments of streams: replays, merges, manifests, balances, counts of batches, finished attempts."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from meterline import sinks, sources, streaming
from meterline.checks import fixtures
from meterline.operators import mediate, rate
from meterline.schema import CANONICAL, RATED_SCHEMA
from meterline.sinks import segments

AT_ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def rated(spark, sf_dir):
    usage = rate.rate_usage(mediate.usage_clean(fixtures.usage(spark, sf_dir)).select(*CANONICAL))
    month = F.when(F.col("record_id") % 3 == 0, "2024-02").when(F.col("record_id") % 3 == 1, "2024-01")
    return usage.withColumn("billing_period", month).cache()


def part(rated, batch, of=20):
    return rated.where(F.pmod(F.xxhash64("record_id"), F.lit(of)) == batch)


def ids(df):
    return sorted(row["record_id"] for row in df.select("record_id").collect())


def test_batches_count_once_and_stay_few(spark, rated, tmp_path):
    path = str(tmp_path / "s")
    store = sinks.SegmentFolder(path, "r", fan_out=3)
    for batch in range(20):
        store(part(rated, batch), batch)
        store(part(rated, max(batch - 4, 0)), max(batch - 4, 0))  # one that is merged by now is run again
        manifest = segments.load(spark, path)
        levels = [s.level for s in manifest.segments]
        assert all(levels.count(level) < 3 for level in levels)
        assert [(s.first, s.last) for s in sorted(manifest.segments, key=lambda s: s.first)][-1][1] == batch
    assert ids(sources.read_segments(spark, path)) == ids(rated)
    january = sources.read_segments(spark, path, "2024-01")
    assert ids(january) == ids(rated.where("billing_period = '2024-01' OR billing_period IS NULL"))
    files = january.inputFiles()
    assert len(files) <= 2 * 2 * 3 and not any("billing_period=2024-02" in name for name in files)
    assert len([n for n in os.listdir(f"{path}/_manifest") if n.endswith(".json")]) <= segments.KEPT_VERSIONS
    # Readers open no footer to learn the schema, and see the columns of rated usage.
    assert [f.name for f in january.schema] == [c.split()[0] for c in RATED_SCHEMA.split(", ")]


def test_merged_segments_are_deleted_only_by_vacuum(spark, rated, tmp_path):
    path = str(tmp_path / "s")
    store = sinks.SegmentFolder(path, "r", fan_out=2)
    store(part(rated, 0), 0)
    early = sources.read_segments(spark, path)
    for batch in range(1, 4):
        store(part(rated, batch), batch)
    assert ids(early) == ids(part(rated, 0))  # a reader of an old version is not disturbed
    rated.limit(1).write.parquet(f"{path}/segment=left-by-a-dead-attempt")
    assert sinks.vacuum(spark, path) == []
    gone = sinks.vacuum(spark, path, older_than=-60)
    assert "left-by-a-dead-attempt" in gone and len(gone) == 7
    assert ids(sources.read_segments(spark, path)) == ids(rated.where(F.pmod(F.xxhash64("record_id"), F.lit(20)) < 4))
    assert segments.load(spark, path).retired == {}


def test_tasks_of_a_merge_have_few_rows_each(spark, tmp_path):
    """One frequent value, equal rows in it, and some rare values: no file has more than its share."""
    path = str(tmp_path / "s")
    months = F.when(F.col("id") % 100 < 96, "2024-01").otherwise(F.concat(F.lit("2024-0"), (F.col("id") % 4 + 2).cast("string")))
    rows = spark.range(4000).select((F.col("id") % 2 * F.col("id")).alias("record_id"), months.alias("billing_period"))
    store = sinks.SegmentFolder(path, "r", fan_out=2, compacting=False)
    for batch in range(2):
        store(rows.where(F.col("record_id") >= 0), batch)
    assert sinks.compact(spark, path, rows.schema, fan_out=2, file_rows=500) == 1
    merged = spark.read.parquet(f"{path}/segment={segments.load(spark, path).segments[0].name}")
    files = [row["n"] for row in merged.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(files) <= 750 and len(files) <= 16 + 4
    assert sorted(map(tuple, merged.select("record_id", "billing_period").collect())) == sorted(map(tuple, rows.union(rows).collect()))


def test_writers_and_merges_at_once(spark, rated, tmp_path):
    """Two runs write and a third thread merges; each version follows from the one before."""
    path, failures = str(tmp_path / "s"), []

    def guarded(work):
        try:
            work()
        except Exception as failure:
            failures.append(failure)

    def write(run, parity):
        store = sinks.SegmentFolder(path, run, fan_out=2, compacting=False)
        for batch in range(4):
            store(part(rated, 2 * batch + parity, of=8), batch)

    def merge():
        for _ in range(12):
            sinks.compact(spark, path, rated.schema, fan_out=2)

    works = [lambda: write("a", 0), lambda: write("b", 1), merge]
    threads = [threading.Thread(target=guarded, args=(work,)) for work in works]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failures
    sinks.compact(spark, path, rated.schema, fan_out=2)
    assert ids(sources.read_segments(spark, path)) == ids(rated)
    assert sorted((s.run, s.first, s.last) for s in segments.load(spark, path).segments) == [("a", 0, 3), ("b", 0, 3)]


def test_a_missing_batch_is_not_merged_over(spark, rated, tmp_path):
    path = str(tmp_path / "s")
    store = sinks.SegmentFolder(path, "r", fan_out=2)
    for batch in (0, 2, 1, 3):
        store(part(rated, batch, of=4), batch)
    assert ids(sources.read_segments(spark, path)) == ids(rated)


def test_a_lost_race_starts_over(spark, tmp_path):
    path, calls = str(tmp_path / "s"), []

    def change(name, first=False):
        def apply(before):
            calls.append(before.version)
            if first and len(calls) == 1:
                segments.commit(spark, path, change("other"))
            return segments.replace(before, segments=(*before.segments, segments.Segment(name, "r", len(before.segments), len(before.segments), 0, ())))

        return apply

    assert segments.commit(spark, path, change("mine", True))
    assert calls == [0, 0, 1]
    assert [s.name for s in segments.load(spark, path).segments] == ["other", "mine"]
    assert not segments.commit(spark, path, lambda before: None)


def test_nothing_written_and_empty_batches(spark, rated, tmp_path):
    path = str(tmp_path / "s")
    assert sources.read_segments(spark, path).count() == 0
    sinks.SegmentFolder(path, "r")(rated.where("false"), 0)
    assert segments.load(spark, path).covers("r", 0)
    assert sources.read_segments(spark, path).count() == 0
    with pytest.raises(ValueError):
        sinks.compact(spark, path, rated.schema, fan_out=1)


def test_consumption_of_some_days_reads_those_alone(spark, rated, tmp_path):
    rated.repartition(6, "record_id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rated.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "sums")
    streaming.await_all([streaming.start_consumption(stream, out, "r", str(tmp_path / "cp"), "1 hour", AT_ONCE, fan_out=2)])
    whole = streaming.window_sums(rated, "1 hour")
    days = sources.read_consumption(spark, out, "2024-01-03", "2024-01-05")
    wanted = whole.where("CAST(window_start AS DATE) BETWEEN '2024-01-03' AND '2024-01-05'").select(*days.columns)
    key = lambda rows: sorted(map(repr, rows.collect()))
    assert key(days) == key(wanted) and days.count() > 0
    opened = sources.tables.read_live(spark, out, sources.tables.StructType.fromDDL(sources.tables.CONSUMPTION_SCHEMA), "window_day", "2024-01-04".__eq__).inputFiles()
    assert opened and all("window_day=2024-01-04" in name for name in opened)
    assert key(sources.read_consumption(spark, out)) == key(whole.select(*days.columns))


def test_balances_in_any_order_and_again(spark, rated, tmp_path):
    path = str(tmp_path / "b")
    store = sinks.SegmentFolder(path, "r", "billing_period", 3, sources.tables.add_balances)
    from meterline.functions import charges
    from meterline.operators.bill import billable

    def sums(rows):
        return sources.tables.add_balances(
            billable(rows).select("user_id", "record_type", "billing_period", F.lit(1).cast("bigint").alias("n"), charges.billed_quantity().cast("decimal(28,6)").alias("used"))
        )

    for batch in (3, 1, 4, 0, 1, 2, 3, 5):
        store(sums(part(rated, batch, of=6)), batch)
    found = sources.read_balances(spark, path, fixtures.quotas(spark))
    assert sorted(map(repr, found.drop("left").collect())) == sorted(map(repr, sums(rated).select(*found.drop("left").columns).collect()))
    free = {"data": 500, "sms": 10, "voice": 60}
    for row in found.collect():
        assert row["left"] == max(0, free.get(row["record_type"], 0) - row["used"])
    assert sources.read_balances(spark, path, period="2024-02").select("billing_period").distinct().count() == 1


def test_counts_of_a_failed_listener_are_told(spark):
    class Event:
        class progress:
            id, name, batchId, timestamp = "q", None, 0, "2024-01-01T00:00:00Z"
            observedMetrics = {"m": None}

    class Query:
        id = "q"
        lastProgress = Event.progress

    metrics = streaming.BatchMetrics(spark, "/nowhere")
    metrics.onQueryProgress(Event)
    with pytest.raises(AttributeError):
        metrics.await_batch(Query)
    with pytest.raises(TimeoutError):
        streaming.BatchMetrics(spark, "/nowhere").await_batch(Query, 0.01)


def test_attempts_that_never_finished_do_not_count(spark, rated, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.BatchTable("r", "parquet", path=path)
    for batch in (0, 1, 1):
        write(part(rated, batch, of=2), batch)
    torn = rate.to_rated_table(part(rated, 0, of=2)).limit(5)
    torn.withColumns({"run": F.lit("r"), "batch_id": F.lit(0).cast("bigint"), "attempt": F.lit("9" * 20)}).write.mode("append").parquet(path)
    table = sources.read_table(spark, path=path)
    attempts = sources.read_table(spark, path=sinks.attempts_of({}, path)[1])
    found = rate.from_rated_table(table, attempts=attempts)
    assert found.count() == rated.count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 2 and "BroadcastHashJoin" in plan
    assert sinks.attempts_of({"url": "u", "dbtable": "rated"}, None) == ({"url": "u", "dbtable": "rated_attempts"}, None)
