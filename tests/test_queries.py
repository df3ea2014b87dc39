"""Every registered query against SQL over the same tables."""

import compare
import pytest

from meterline.checks import fixtures
from meterline.checks.oracle import oracle_sql
from meterline.checks.queries import queries
from meterline.operators import mediate


@pytest.fixture(scope="module")
def db(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, sf_dir, db, name):
    names, rows = compare.spark_rows(queries()[name](spark, sf_dir))
    expected_names, expected = compare.oracle_rows(db, oracle_sql()[name])
    assert names == expected_names
    assert rows == expected
    assert rows


@pytest.mark.parametrize(
    "name",
    ["parse_usage", "encode_usage", "rate_with_modifiers", "billing_summary_deduplicated", "usage_by_hour", "consumption_rollup", "stream_daily_usage"],
)
def test_results_do_not_depend_on_the_session_time_zone(spark, sf_dir, db, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = compare.spark_rows(queries()[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == compare.oracle_rows(db, oracle_sql()[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 15


def test_known_totals(spark):
    """Totals worked out before anything was built."""
    sf_dir = "/root/testdata/sf0.01"
    usage = fixtures.usage(spark, sf_dir)
    assert usage.count() == 10_500
    assert mediate.dedup_usage(usage).count() == 10_000
    clean = {row["record_type"]: row["count"] for row in mediate.usage_clean(usage).groupBy("record_type").count().collect()}
    assert clean == {"voice": 1703, "sms": 1704, "data": 3369}
    summary = queries()["billing_summary"](spark, sf_dir)
    sums = summary.groupBy().sum("subtotal", "tax_amount", "total_amount").first()
    assert [round(value, 2) for value in sums] == [779887.10, 155977.41, 935864.51]
    first = summary.where("user_id = 'u0'").first()
    amounts = ("total_voice_cost", "total_sms_cost", "total_data_cost", "subtotal", "tax_amount", "total_amount")
    assert [first[name] for name in amounts] == [34.00, 6.00, 3054.71, 3094.71, 618.94, 3713.65]
    assert first["invoice_id"] == "202401u0"
