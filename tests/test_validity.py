"""Rules that hold for a time: blocks, as-of joins, plans and promotions over time."""

import datetime
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterline.checks import fixtures
from meterline.operators import modifiers
from meterline.plans import asof, intervals
from meterline.plans.pipeline import Rules, priced

SCHEMA = (
    "record_id BIGINT, record_type STRING, event_ts TIMESTAMP_NTZ, caller_id STRING, callee_id STRING, "
    "duration_sec INT, sender_id STRING, receiver_id STRING, user_id STRING, data_volume_mb DECIMAL(18,6), "
    "session_duration_sec INT, cell_id STRING, technology STRING, status STRING, cost DECIMAL(20,6), billing_period STRING"
)
START = datetime.datetime(2024, 1, 1)


def sms(i, user, at, kind="sms", cost="10"):
    return (i, kind, at, None, None, None, user, None, user, None, None, "c", "4G", "rated", Decimal(cost), "2024-01")


def moment(draw, hours=2000):
    return START + datetime.timedelta(minutes=draw.randrange(hours * 60))


@pytest.fixture(scope="module")
def usage(spark):
    draw = random.Random(4)
    rows = [sms(i, draw.choice(["hot"] * 6 + ["a", "b", "c", None]), moment(draw), draw.choice(["sms", "data", "fax", None])) for i in range(1500)]
    rows += [sms(2000 + i, "hot", START) for i in range(40)] + [sms(3000, "a", None), sms(3001, "hot", None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_blocks_cover_an_interval_once(spark):
    pairs = [(a, b) for a in range(20) for b in range(a, 34)] + [(5, 1 << 40), (0, (1 << 62) + 1)]
    frame = spark.createDataFrame(pairs, "a bigint, b bigint").withColumn("blocks", intervals.cover(F.col("a"), F.col("b"), 62))
    for row in frame.collect():
        covered = sorted((x["block"] << x["level"], (x["block"] + 1) << x["level"]) for x in row["blocks"])
        assert len(covered) <= 2 * 63
        borders = [row["a"], *[end for _, end in covered]]
        assert [begin for begin, _ in covered] == borders[:-1] and borders[-1] == row["b"]


def test_a_number_lies_in_one_block_of_each_level(spark):
    found = spark.createDataFrame([(37,)], "a bigint").select(intervals.path(F.col("a"), 6).alias("p")).first()["p"]
    assert [(x["level"], x["block"]) for x in found] == [(level, 37 >> level) for level in range(7)]


def promotions_table(spark, n, seed=1, unit="minutes"):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        begin = START + datetime.timedelta(**{unit: draw.randrange(100_000)})
        end = None if draw.random() < 0.02 else begin + datetime.timedelta(**{unit: draw.randrange(-5, 3000)})
        rows.append((draw.choice(["sms", "data", "voice"]), begin, end, Decimal(draw.randrange(1, 90)) / 100))
    return rows, spark.createDataFrame(rows, "service string, valid_from timestamp_ntz, valid_to timestamp_ntz, percent_off decimal(4,2)")


def percent_off(rules, kind, at):
    fitting = [p for s, begin, end, p in rules if s == kind and at is not None and begin <= at and (end is None or at < end)]
    return max(fitting, default=Decimal(0))


@pytest.mark.parametrize("size,unit", [(1, "minutes"), (40, "minutes"), (5000, "minutes"), (300, "milliseconds")])
@pytest.mark.parametrize("rows", [intervals.COVER_ROWS, 0])
def test_promotions_of_any_number(spark, usage, size, unit, rows, monkeypatch):
    """Equal to trying each promotion, by blocks and, beyond their bound, by sorting usage and rules together."""
    monkeypatch.setattr(intervals.with_valid, "__defaults__", (rows, 16 if rows else 0))
    rules, table = promotions_table(spark, size, unit=unit)
    result = modifiers.rate_with_promotions(usage, promotions=table)
    plan = result._jdf.queryExecution().executedPlan().toString()
    found = {r["record_id"]: r["cost"] for r in result.collect()}
    expected = {r["record_id"]: 10 * (1 - percent_off(rules, r["record_type"], r["event_ts"])) for r in usage.collect()}
    assert found == expected
    assert size < 40 or unit != "minutes" or len(set(found.values())) > 1
    conditions = re.findall(r"(?:Join|Loop\w*) .*", plan)
    if size > 16:
        assert not [c for c in conditions if re.search(r"event_ts#\d+ (>|<)", c)]


def test_promotions_cost_no_exchange_of_usage(spark, usage, tmp_path):
    usage.write.parquet(str(tmp_path / "u"))
    stored = spark.read.parquet(str(tmp_path / "u"))
    plan = modifiers.rate_with_promotions(stored, promotions=promotions_table(spark, 2000)[1])._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"(\w+Join) ", plan)
    assert joins and joins[0] == "BroadcastHashJoin" and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Exchange hashpartitioning\((record_type|event_ts)", plan)


def history(spark):
    draw = random.Random(8)
    rows = [(user, draw.choice(["x", "y", "z", None]), moment(draw)) for user in ("hot", "a", "b") for _ in range(25)]
    rows += [("hot", "x", None), ("c", "y", None), ("a", "y", rows[30][2]), (None, "x", START)]
    return rows, spark.createDataFrame(rows, "user_id string, plan string, valid_from timestamp_ntz")


PRICES = {"x": Decimal("0.50"), "y": Decimal("0.80")}


def held(rows, user, at):
    """All plans of a client's last change at or before a moment."""
    fitting = [(begin, plan) for u, plan, begin in rows if u is not None and u == user and (begin is None or (at is not None and begin <= at))]
    if not fitting:
        return []
    last = max((begin or datetime.datetime.min for begin, _ in fitting))
    return [plan for begin, plan in fitting if (begin or datetime.datetime.min) == last]


@pytest.mark.parametrize("hot_rows", [2_000_000, 100])
def test_plans_over_time(spark, usage, hot_rows):
    """Also for a client whose usage is cut into slices, some of them without any change of plan."""
    rows, table = history(spark)
    plans = spark.createDataFrame(list(PRICES.items()), "plan string, plan_multiplier decimal(4,2)")
    result = modifiers.rate_with_promotions(usage, table, plans, hot_rows=hot_rows)
    assert result.columns == [*["base_cost" if n == "cost" else n for n in usage.columns], "payer", "cost"]
    for r in result.collect():
        fitting = [PRICES[p] for p in held(rows, r["payer"], r["event_ts"]) if p in PRICES]
        assert r["cost"] == 10 * min(fitting, default=Decimal(1)), r
    assert result.count() == usage.count()


@pytest.mark.parametrize("dated_clients", [True, False])
def test_prices_over_time(spark, usage, dated_clients):
    rows, table = history(spark)
    draw = random.Random(2)
    prices = [(draw.choice("xy"), moment(draw), Decimal(draw.randrange(10, 99)) / 100) for _ in range(30)] + [("x", None, Decimal("0.77"))]
    plans = spark.createDataFrame(prices, "plan string, valid_from timestamp_ntz, plan_multiplier decimal(4,2)")
    if not dated_clients:
        rows, table = [(u, p, None) for u, p, _ in rows], table.drop("valid_from")
    for r in modifiers.rate_with_promotions(usage, table, plans).collect():
        own = [p for p in held(rows, r["payer"], r["event_ts"]) if p is not None]
        price = Decimal(1)
        if own:
            of_plan = [(b or datetime.datetime.min, m) for p, b, m in prices if p == min(own) and (b is None or (r["event_ts"] is not None and b <= r["event_ts"]))]
            if of_plan and (r["event_ts"] is not None):
                price = min(m for b, m in of_plan if b == max(b for b, _ in of_plan))
        assert r["cost"] == 10 * price, r


def test_as_of_without_rules_or_usage(spark, usage):
    nothing = spark.createDataFrame([], "k string, since timestamp_ntz, v int")
    assert {r["v"] for r in asof.as_of(usage, nothing, "k", F.col("user_id"), "event_ts", "since").collect()} == {None}
    some = spark.createDataFrame([("a", None, 1)], "k string, since timestamp_ntz, v int")
    assert asof.as_of(usage.where("false"), some, "k", F.col("user_id"), "event_ts", "since").collect() == []


def test_each_rule_table_works_alone(spark, usage):
    plans = spark.createDataFrame(list(PRICES.items()), "plan string, plan_multiplier decimal(4,2)")
    clients = spark.createDataFrame([("hot", "x")], "user_id string, plan string")
    by_plan = {r["user_id"]: r["cost"] for r in priced(usage, Rules(subscriptions=clients, plans=plans)).collect()}
    assert by_plan["hot"] == 5 and by_plan["a"] == 10
    promoted = priced(usage, Rules(promotions=fixtures.promotions(spark)))
    assert {r["cost"] for r in promoted.where("record_type = 'data' AND event_ts >= '2024-01-10' AND event_ts < '2024-01-20'").collect()} == {Decimal("7.5")}
    for incomplete in (Rules(subscriptions=clients), Rules(plans=plans), Rules(plans=plans, promotions=fixtures.promotions(spark))):
        with pytest.raises(ValueError):
            priced(usage, incomplete)
