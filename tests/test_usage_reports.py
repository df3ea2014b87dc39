"""Sketches, anomalies, sessions and copies of old records."""

import datetime
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterline import sinks, streaming
from meterline.checks import fixtures
from meterline.operators import anomalies, history, mediate, sessions, sketches
from meterline.plans.running import with_previous
from meterline.schema import CANONICAL
from meterline.sinks.segments import read_live

START = datetime.datetime(2024, 1, 1)
SCHEMA = (
    "record_id BIGINT, record_type STRING, event_ts TIMESTAMP_NTZ, caller_id STRING, callee_id STRING, "
    "duration_sec INT, sender_id STRING, receiver_id STRING, user_id STRING, data_volume_mb DECIMAL(18,6), "
    "session_duration_sec INT, cell_id STRING, technology STRING, status STRING, cost DECIMAL(20,6), billing_period STRING"
)


def data(i, user, at, mb="1", cell="c"):
    return (i, "data", at, None, None, None, None, None, user, Decimal(mb), 60, cell, "4G", "rated", Decimal(1), "2024-01")


def texts(df):
    return sorted(repr(tuple(row)) for row in df.select(*sorted(df.columns)).collect())


def test_sketches_stay_within_their_bounds(spark):
    """20,000 clients over 30 days: any range of days against what is exact."""
    usage = spark.range(120_000).select(
        F.col("id").alias("record_id"), F.lit("data").alias("record_type"), F.lit("rated").alias("status"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id % 30 AS INT))").alias("event_ts"),
        F.lit(None).cast("string").alias("caller_id"), F.lit(None).cast("string").alias("sender_id"), F.lit(None).cast("int").alias("duration_sec"),
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("user_id"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)) / 100).cast("decimal(18,6)").alias("data_volume_mb"), F.lit(1).cast("decimal(20,6)").alias("cost"),
    ).cache()
    daily = sketches.usage_sketches(usage).cache()
    for first, last in ((1, 30), (3, 9), (17, 17)):
        days = daily.where(F.dayofmonth("day").between(first, last))
        found = sketches.estimates(sketches.merge_sketches(days, "record_type"), {"p50": 0.5, "p95": 0.95}).first()
        exact = usage.where(F.dayofmonth("event_ts").between(first, last))
        assert found["n"] == exact.count() and found["revenue"] == exact.count()
        users = exact.select("user_id").distinct().count()
        assert abs(found["users"] - users) < 4 * 0.0163 * users
        for name, share in (("p50", 0.5), ("p95", 0.95)):
            rank = exact.where(F.col("data_volume_mb") <= found[name]).count() / exact.count()
            assert abs(rank - share) < 0.02
    whole = sketches.merge_sketches(daily, "record_type")
    halves = [sketches.merge_sketches(daily.where(F.dayofmonth("day") % 2 == parity), "record_type") for parity in (0, 1)]
    again = sketches.merge_sketches(halves[0].unionByName(halves[1]), "record_type")
    one, other = (sketches.estimates(x, {}).first() for x in (whole, again))
    assert one == other
    assert sketches.usage_sketches(usage.where("false")).count() == 0


def test_a_client_is_measured_by_its_own_past(spark):
    rows, i = [], 0
    for week in range(6):
        for user, usual in (("big", 1000), ("small", 10)):
            at = START + datetime.timedelta(weeks=week, hours=30)
            rows.append(data(i, user, at, str(usual + week)))
            i += 1
    rows.append(data(100, "small", START + datetime.timedelta(weeks=6, hours=30, minutes=5), "500"))
    rows.append(data(101, "small", START + datetime.timedelta(weeks=6, hours=30, minutes=9), "500"))
    rows.append(data(102, "big", START + datetime.timedelta(weeks=6, hours=30), "1"))
    rows.append(data(103, "big", START + datetime.timedelta(weeks=6, hours=77), "99999"))  # no other week has that hour
    rows.append(data(104, "big", None, "99999"))
    usage = spark.createDataFrame(rows, SCHEMA)
    for hot_rows in (2_000_000, 3):
        found = {(r["user_id"], r["kind"]): r for r in anomalies.usage_anomalies(usage, hot_rows=hot_rows).collect()}
        assert set(found) == {("small", "high"), ("big", "low")}
        assert found["small", "high"]["quantity"] == 1000 and found["small", "high"]["median"] == 13 and found["small", "high"]["hours"] == 7
        assert found["big", "low"]["deviation"] == 2
    assert anomalies.usage_anomalies(usage, least_hours=8).count() == 0
    assert anomalies.usage_anomalies(usage.where("false")).count() == 0


def walk(draw, user, n, first_id):
    at, rows = START, []
    for i in range(n):
        at += datetime.timedelta(minutes=draw.choice([0, 1, 7, 29, 30, 31, 500]))
        rows.append(data(first_id + i, user, at, "1", draw.choice(["x", "y", None])))
    return rows


def plain_sessions(rows):
    found = {}
    for row in sorted(rows, key=lambda r: (r[8], r[2], r[0])):
        own = found.setdefault(row[8], [])
        if own and row[2] - own[-1][-1][2] <= datetime.timedelta(minutes=30):
            own[-1].append(row)
        else:
            own.append([row])
    out = []
    for user, parts in found.items():
        for part in parts:
            cells = [row[11] for row in part]
            moves = sum(a != b for a, b in zip(cells, cells[1:], strict=False))
            out.append((user, part[0][2], part[-1][2], len(part), len({c for c in cells if c}), moves))
    return sorted(map(repr, out))


@pytest.mark.parametrize("hot_rows", [2_000_000, 50])
def test_sessions_and_moves(spark, hot_rows):
    """Also of a payer that is cut into slices: sessions go on over their borders."""
    draw = random.Random(6)
    rows = walk(draw, "hot", 700, 0) + walk(draw, "a", 40, 1000) + walk(draw, "b", 1, 2000) + walk(draw, "c", 30, 3000)
    usage = spark.createDataFrame([*rows, data(9000, "a", None), data(9001, None, START)], SCHEMA)
    found = sessions.usage_sessions(usage.repartition(4), "30 minutes", hot_rows)
    columns = ("user_id", "first_use", "last_use", "n", "cells", "moves")
    assert sorted(repr(tuple(row[c] for c in columns)) for row in found.collect()) == plain_sessions(rows)


def test_the_row_before_over_slices(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("k"), "id", (F.col("id") * 2).alias("v")).cache()
    plain, sliced = (with_previous(rows, ["k"], ["id"], {"before": "v", "id_before": "id"}, n) for n in (10_000, 17))
    assert texts(plain) == texts(sliced) and plain.where("before IS NULL").count() == 3


def test_streamed_sessions_are_those_of_a_batch(spark, tmp_path):
    draw = random.Random(7)
    rows = [row for user in "abc" for row in walk(draw, user, 60, ord(user) * 1000)]
    at_once = {"availableNow": True}
    for part in (rows, [data(1, "end", START + datetime.timedelta(days=4000))]):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        streaming.await_all([streaming.start_sessions(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "30 minutes", trigger=at_once)])
    found = spark.read.parquet(str(tmp_path / "out"))
    batch = sessions.usage_sessions(spark.createDataFrame(rows, SCHEMA), "30 minutes").drop("moves")
    assert texts(found) == texts(batch.select(*found.columns))


@pytest.fixture(scope="module")
def arrivals(spark, sf_dir):
    return fixtures.usage(spark, sf_dir).select(*CANONICAL).withColumn("day", F.to_date("event_ts")).cache()


def test_the_index_is_read_where_a_digest_can_be(spark, arrivals, tmp_path):
    store = sinks.SegmentFolder(str(tmp_path), "r", "prefix")
    store(history.with_digest(arrivals).select("digest", "prefix"), 0)
    index = history.read_index(spark, str(tmp_path))
    few = history.with_digest(arrivals.limit(2)).select("digest", "prefix")
    found = history.known_digests(few, index)
    assert found.distinct().count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"dynamicpruning(expression)?[(#]", plan.lower())


def test_copies_of_any_earlier_batch_are_left_out(spark, arrivals, tmp_path):
    """A batch that stops between its output and the index hands on the same records again."""
    out, index = str(tmp_path / "out"), str(tmp_path / "index")
    store = sinks.SegmentFolder(out, "r", "day")
    step = history.HistoryDedup(index, "r", store)
    first, second = arrivals.where("record_id < 600"), arrivals.where("record_id >= 600 OR record_id % 100 = 7")

    def dies(batch, batch_id):
        store(batch, batch_id)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        history.HistoryDedup(index, "r", dies)(first, 0)
    for batch_id, batch in ((0, first), (0, first), (1, second), (1, second), (2, arrivals)):
        step(batch, batch_id)
    found = read_live(spark, out, arrivals.schema, "day")
    expected = mediate.dedup_usage(arrivals)
    assert texts(found.select(*CANONICAL)) == texts(expected)


