"""A key with a third or more of all rows: same results, and no task that holds it whole."""

import datetime

import compare
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterline.checks import fixtures
from meterline.checks.queries import plain
from meterline.operators import bill, mediate, rate, reports
from meterline.plans.running import write_running_totals


def reference_totals(rows, keys):
    """Running totals computed row by row."""
    state, result = {}, {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        state[row[0]] = state.get(row[0], 0) + row[3]
        result[row[2]] = state[row[0]]
    return result


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(st.sampled_from(["hot", "hot", "hot", "b", "c", None]), st.integers(0, 3), st.integers(-5, 50)),
        min_size=1,
        max_size=60,
    ),
    hot_rows=st.sampled_from([1, 3, 10, 1000]),
)
def test_running_totals_equal_brute_force(spark, rows, hot_rows):
    data = [(key, at, number, value) for number, (key, at, value) in enumerate(rows)]
    df = spark.createDataFrame(data, "k STRING, at INT, id INT, v BIGINT")
    found = write_running_totals(df, ["k"], ["at", "id"], {"total": F.col("v")}, hot_rows)
    assert found.columns == ["k", "at", "id", "v", "total"]
    assert {row["id"]: row["total"] for row in found.collect()} == reference_totals(data, ["k"])


def test_hot_key_is_split_even_at_one_moment(spark):
    """All rows of the hot key share their time, so only the arrival order can split them."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("hot").alias("k"),
        F.lit(0).alias("at"),
        "id",
    )
    numbered = write_running_totals(df, ["k"], ["at", "id"], {"n": F.lit(1).cast("bigint")}, hot_rows=500)
    whole = Window.partitionBy("k").orderBy("at", "id")
    expected = df.withColumn("n", F.row_number().over(whole).cast("bigint"))
    assert numbered.exceptAll(expected).count() == 0
    assert numbered.count() == 6000
    biggest = numbered.where("k = 'hot'").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert biggest < 2500


def skewed(spark, sf_dir):
    """The test usage with every second client folded into one."""
    usage = mediate.usage_clean(fixtures.usage(spark, sf_dir))
    one = {name: F.when(F.col(name).rlike("^u[0-9]*[02468]$"), "u0").otherwise(F.col(name)) for name in ("caller_id", "sender_id", "user_id")}
    return rate.rate_usage(usage.withColumns(one))


@pytest.mark.parametrize(
    "build",
    [
        lambda usage, spark, hot: bill.invoice_lines(usage, "2024-01", hot_rows=hot),
        lambda usage, spark, hot: bill.billable_after_quota(usage, fixtures.quotas(spark), hot_rows=hot).select("record_id", "billable"),
        lambda usage, spark, hot: reports.usage_by_hour(usage, hot_rows=hot),
        lambda usage, spark, hot: reports.usage_by_cell_technology(usage, hot_rows=hot),
    ],
    ids=["invoice_lines", "billable_after_quota", "usage_by_hour", "usage_by_cell_technology"],
)
def test_results_do_not_depend_on_the_hot_limit(spark, sf_dir, build):
    usage = skewed(spark, sf_dir)
    ordinary, sliced = (compare.spark_rows(plain(build(usage, spark, hot))) for hot in (10**6, 20))
    assert ordinary == sliced


def test_copies_collapse_before_the_shuffle(spark):
    """20,000 copies of one record in 8 tasks: the exchange carries one row per task."""
    copies = spark.range(0, 20_000, numPartitions=8).select(
        F.col("id").alias("record_id"), F.lit("sms").alias("record_type"),
        F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("event_ts"),
        *[F.lit("a").alias(n) for n in ("caller_id", "callee_id", "sender_id", "receiver_id", "user_id", "cell_id", "technology")],
        F.lit(1).alias("duration_sec"), F.lit(1).alias("session_duration_sec"), F.lit(1).cast("decimal(18,6)").alias("data_volume_mb"),
    )
    kept = mediate.dedup_usage(copies)
    assert [row["record_id"] for row in kept.collect()] == [0]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") >= 1
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
