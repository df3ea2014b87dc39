"""Prices, invoices, fees, quotas and documents on hand-computed rows."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterline.checks import fixtures
from meterline.operators import bill, clients, constraints, documents, mediate, modifiers, rate, reports
from meterline.schema import LINE_COLUMNS, LINE_KEY, SUMMARY_COLUMNS, SUMMARY_KEY

SCHEMA = (
    "record_id BIGINT, record_type STRING, event_ts TIMESTAMP_NTZ, caller_id STRING, callee_id STRING, "
    "duration_sec INT, sender_id STRING, receiver_id STRING, user_id STRING, data_volume_mb DECIMAL(18,6), "
    "session_duration_sec INT, cell_id STRING, technology STRING"
)
NOON = datetime.datetime(2024, 1, 10, 12)


def voice(sec, user="a", at=NOON, cell="c"):
    return ("voice", at, user, "x", sec, "", "", "someone", None, None, cell, "4G")


def sms(user="a", at=NOON, cell="c"):
    return ("sms", at, "", "", None, user, "y", "someone", None, None, cell, "4G")


def data(mb, user="a", at=NOON, cell="c"):
    return ("data", at, "", "", None, "", "", user, None if mb is None else Decimal(mb), 60, cell, "4G")


def other(kind, user="a"):
    return (kind, NOON, "", "", None, "", "", user, None, None, "c", "4G")


def frame(spark, *rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], SCHEMA)


def rated(spark, *rows):
    return rate.rate_usage(frame(spark, *rows))


def priced(df):
    return [(row["status"], row["cost"]) for row in df.orderBy("record_id").collect()]


CASES = [
    (voice(10), "rated", "1"),
    (voice(59), "rated", "1"),
    (voice(60), "rated", "2"),
    (voice(61), "rated", "2"),
    (voice(119), "rated", "2"),
    (voice(120), "rated", "3"),
    (voice(600), "rated", "11"),
    (voice(0), "rated", "1"),
    (voice(None), "error", "0"),
    (sms(), "rated", "0.5"),
    (sms(None), "error", "0"),
    (data("0.01"), "rated", "0.05"),
    (data("99.99"), "rated", "499.95"),
    (data("100"), "rated", "500"),
    (data("100.01"), "rated", "500.02"),
    (data("500"), "rated", "1300"),
    (data("100000000000"), "rated", "200000000300"),
    (data(None), "error", "0"),
    (other("fax"), "rated", "0"),
    (other(None), "rejected", "0"),
]


def test_default_tariff(spark):
    result = priced(rated(spark, *[row for row, _, _ in CASES]))
    assert result == [(status, Decimal(cost)) for _, status, cost in CASES]


def test_tariff_table_equals_default(spark):
    usage = frame(spark, *[row for row, _, _ in CASES])
    by_table = rate.rate_by_tariff_table(usage, rate.default_tariff(spark))
    assert priced(by_table) == priced(rate.rate_usage(usage))
    assert by_table.columns == rate.rate_usage(usage).columns


def test_tariff_table_with_other_rules(spark):
    tariff = spark.sql(
        """SELECT service, CAST(tier_from AS decimal(18,6)) AS tier_from, CAST(tier_to AS decimal(18,6)) AS tier_to, unit,
                  CAST(price AS decimal(10,4)) AS price, round_rule
           FROM VALUES ('voice', 0, 3, 'minute', 1.0, 'ceil'), ('voice', 3, 5, 'minute', 0.5, 'ceil'),
                       ('voice', 5, NULL, 'minute', 0.1, 'ceil') AS t(service, tier_from, tier_to, unit, price, round_rule)"""
    )
    result = rate.rate_by_tariff_table(frame(spark, voice(60), voice(181), voice(420), sms(), voice(0)), tariff)
    costs = [cost for _, cost in priced(result)]
    assert costs == [Decimal(c) for c in ("1", "3.5", "4.2", "0", "0")]


def test_promotions_and_plans(spark):
    usage = rated(
        spark,
        data("10", at=datetime.datetime(2024, 1, 10)),
        data("10", at=datetime.datetime(2024, 1, 19, 12)),
        data("10", at=datetime.datetime(2024, 1, 20)),
        data("10", at=datetime.datetime(2024, 1, 22, 5, 59, 59)),
        data("10", at=datetime.datetime(2024, 1, 22, 6)),
        data("10", at=datetime.datetime(2024, 1, 9, 23, 59, 59)),
        sms(user="b", at=datetime.datetime(2024, 1, 31, 23)),
        voice(10, user=None),
    )
    subscriptions = spark.createDataFrame([("a", "BUILDING"), ("b", "FURNITURE")], "user_id STRING, plan STRING")
    result = modifiers.rate_with_promotions(usage, subscriptions, fixtures.plans(spark), fixtures.promotions(spark))
    costs = [row["cost"] for row in result.orderBy("record_id").collect()]
    assert costs == [Decimal(c) for c in ("33.75", "33.75", "40.5", "40.5", "45", "45", "0.25", "1")]


def test_hour_and_cell_modifiers(spark):
    weekday, sunday = datetime.datetime(2024, 1, 10), datetime.datetime(2024, 1, 14)
    usage = rated(
        spark,
        data("10", at=weekday.replace(hour=5, minute=59), cell="mill-03"),
        data("10", at=weekday.replace(hour=8), cell="harbour-02"),
        data("10", at=weekday.replace(hour=23), cell="elsewhere"),
        data("10", at=sunday.replace(hour=8), cell=None),
        data("10", at=weekday.replace(hour=0), cell=None),
        data("10", at=weekday.replace(hour=6), cell=None),
        data("10", at=weekday.replace(hour=21, minute=59), cell=None),
    )
    result = modifiers.rate_with_modifiers(usage, fixtures.hour_bands(spark), fixtures.cell_modifiers(spark))
    costs = [row["cost"] for row in result.orderBy("record_id").collect()]
    assert costs == [Decimal(c) for c in ("27.5", "45", "25", "45", "25", "50", "40")]


def test_a_band_over_midnight_covers_both_ends(spark):
    bands = spark.sql("SELECT * FROM VALUES (false, 22, 6, 0.5), (true, 0, 24, 0.9), (true, 5, 5, 0.8) AS b(weekend, from_hour, to_hour, hour_multiplier)")
    hours = {(r["weekend"], r["hour"]): float(r["hour_multiplier"]) for r in modifiers.hour_rows(bands).collect()}
    assert hours == {(False, h): 0.5 for h in (22, 23, 0, 1, 2, 3, 4, 5)} | {(True, h): 0.8 for h in range(24)}


def test_overlapping_rules_charge_once_and_lowest(spark):
    usage = rated(spark, data("10", cell="mill-03"), data("600"))
    twice = [rules.union(rules.limit(2)) for rules in (fixtures.hour_bands(spark), fixtures.cell_modifiers(spark))]
    cheaper = spark.sql("SELECT false AS weekend, 12 AS from_hour, 13 AS to_hour, CAST(0.10 AS decimal(4,2)) AS hour_multiplier")
    result = modifiers.rate_with_modifiers(usage, twice[0].union(cheaper), twice[1]).orderBy("record_id").collect()
    assert [row["cost"] for row in result] == [Decimal("5.5"), Decimal("150")]
    two_plans = spark.createDataFrame([("a", "BUILDING"), ("a", "MACHINERY"), ("a", "BUILDING")], "user_id STRING, plan STRING")
    promotions = fixtures.promotions(spark).union(fixtures.promotions(spark))
    result = modifiers.rate_with_promotions(usage, two_plans, fixtures.plans(spark), promotions).orderBy("record_id").collect()
    assert [row["cost"] for row in result] == [Decimal("31.875"), Decimal("956.25")]
    quotas = fixtures.quotas(spark).union(fixtures.quotas(spark))
    left = bill.billable_after_quota(rated(spark, data("1100")), quotas).collect()
    assert [row["billable"] for row in left] == [Decimal("100")]


def test_promotion_segments_do_not_overlap(spark):
    segments = modifiers.promotion_segments(fixtures.promotions(spark)).where("service <> 'voice'")
    pairs = segments.selectExpr(
        "segment_from < lag(segment_to) OVER (PARTITION BY service ORDER BY segment_from) AS overlap", "segment_from >= segment_to AS empty"
    )
    assert pairs.where("overlap OR empty").count() == 0
    hours = segments.groupBy("service").agg(F.sum(F.unix_micros(F.col("segment_to").cast("timestamp")) - F.unix_micros(F.col("segment_from").cast("timestamp"))).alias("t"))
    assert {r["service"]: r["t"] / 3.6e9 for r in hours.collect()} == {"data": 12 * 24 + 6, "sms": 17 * 24}


def test_promotions_without_an_end(spark):
    usage = rated(spark, voice(600, at=datetime.datetime(2024, 1, 24, 23, 59)), voice(600, at=datetime.datetime(2024, 1, 25)), voice(600, at=datetime.datetime(2150, 1, 1)))
    nobody = spark.createDataFrame([], "user_id STRING, plan STRING")
    result = modifiers.rate_with_promotions(usage, nobody, fixtures.plans(spark), fixtures.promotions(spark))
    assert [row["cost"] for row in result.orderBy("record_id").collect()] == [Decimal(c) for c in ("11", "8.8", "8.8")]


def test_a_tariff_with_gaps_is_refused(spark):
    gap = rate.default_tariff(spark).where("NOT (service = 'data' AND tier_from = 0)")
    twice = rate.default_tariff(spark).union(rate.default_tariff(spark))
    for tariff in (gap, twice):
        with pytest.raises(ValueError):
            rate.rate_by_tariff_table(frame(spark, sms()), tariff)


def test_rules_of_any_size_give_the_same_prices(spark, sf_dir, monkeypatch):
    """Above the row bound rules are joined by shuffle, with usage of one key spread over salts, or sorted with the usage."""
    import inspect

    from meterline.plans import intervals, rules

    usage = rate.rate_usage(mediate.usage_clean(fixtures.usage(spark, sf_dir)))

    def prices():
        timed = modifiers.rate_with_modifiers(usage, fixtures.hour_bands(spark), fixtures.cell_modifiers(spark))
        promoted = modifiers.rate_with_promotions(usage, fixtures.clients(spark, sf_dir), fixtures.plans(spark), fixtures.promotions(spark))
        tariff = rate.rate_by_tariff_table(usage.drop("status", "cost", "billing_period"), fixtures.other_tariff(spark))
        frames = [df.select("record_id", "cost") for df in (timed, promoted, tariff)]
        return [sorted(df.collect()) for df in frames], [df._jdf.queryExecution().executedPlan().toString() for df in frames]

    small, plans = prices()
    assert all("Exchange hashpartitioning(record_type" not in plan for plan in plans)
    default = inspect.signature(rules.with_rules).parameters["rule_rows"].default
    monkeypatch.setattr(rules.with_rules, "__defaults__", (None, 0))
    monkeypatch.setattr(intervals.with_valid, "__defaults__", (0, 0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large, plans = prices()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert default > 0 and small == large
    assert ["_salt" in plan for plan in plans] == [True, False, True]
    assert "last(_rule" in plans[1]


def test_tariff_gaps(spark):
    assert constraints.tariff_gaps(rate.default_tariff(spark)).count() == 0
    bad = spark.sql("SELECT * FROM VALUES ('a', 0, 5), ('a', 6, NULL), ('b', 1, NULL), ('c', 0, 5), ('c', 5, NULL), ('c', 5, NULL) AS t(service, tier_from, tier_to)")
    assert sorted((r["service"], r["tier_from"]) for r in constraints.tariff_gaps(bad).collect()) == [("a", 6), ("b", 1), ("c", 5)]


def test_summary(spark):
    usage = rated(spark, voice(60), voice(60), sms(), data("100.01"), sms(user="b"), other("fax", user="c"), voice(5, user=None))
    day = F.to_date(F.lit("2024-02-01"))
    summary = bill.billing_summary(usage, "2024-01", day)
    assert summary.columns == list(SUMMARY_COLUMNS)
    rows = [tuple(row) for row in summary.orderBy("user_id").collect()]
    date = datetime.date(2024, 2, 1)

    def amounts(*texts):
        return tuple(Decimal(t) for t in texts)

    assert rows == [
        ("202401a", "a", "2024-01", date, *amounts("4", "0.5", "500.02", "504.52", "100.90", "605.42")),
        ("202401b", "b", "2024-01", date, *amounts("0", "0.5", "0", "0.5", "0.1", "0.6")),
        ("202401c", "c", "2024-01", date, *amounts("0", "0", "0", "0", "0", "0")),
    ]
    assert [row["problem"] for row in bill.unbillable(usage).collect()] == ["payer"]
    assert constraints.key_violations(summary, SUMMARY_KEY).count() == 0


def test_summary_period(spark):
    usage = rated(spark, sms(at=datetime.datetime(2024, 1, 31, 23, 59)), sms(at=datetime.datetime(2024, 2, 1)))
    assert bill.billing_summary(usage, "2024-02").first()["subtotal"] == Decimal("0.5")
    assert bill.billing_summary(usage, "2024-02", period_filter=False).first()["subtotal"] == Decimal("1")
    every = bill.billing_summary(usage).orderBy("billing_period").collect()
    assert [row["invoice_id"] for row in every] == ["202401a", "202402a"]
    assert bill.billing_summary(usage).first()["invoice_date"] is not None


def test_undated_usage_is_shown_and_not_lost(spark):
    usage = rated(spark, sms(), sms(at=None))
    assert bill.billing_summary(usage).count() == 1
    assert [row["record_id"] for row in bill.unbillable(usage).collect()] == [1]
    assert bill.billing_summary(usage, "2024-01", period_filter=False).first()["subtotal"] == Decimal("1")


def test_invoices_add_up_below_a_cent(spark):
    usage = rated(spark, sms(), sms(), sms(user="b"), data("10", user="b"))
    prices = {0: "0.425", 1: "0.425", 2: "0.0045", 3: "0.0045"}
    cost = F.element_at(F.create_map(*[F.lit(x) for pair in prices.items() for x in pair]), F.col("record_id").cast("int"))
    usage = usage.withColumn("cost", cost.cast("decimal(20,6)"))
    lines = {r["user_id"]: r["s"] for r in bill.invoice_lines(usage, "2024-01").groupBy("user_id").agg(F.sum("line_amount").alias("s")).collect()}
    for row in bill.billing_summary(usage, "2024-01").collect():
        assert row["subtotal"] == lines[row["user_id"]] == row["total_voice_cost"] + row["total_sms_cost"] + row["total_data_cost"]
        assert row["total_amount"] == row["subtotal"] + row["tax_amount"]
    assert lines == {"a": Decimal("0.86"), "b": Decimal("0")}
    for row in bill.billing_with_fees(usage, fixtures.fees(spark)).collect():
        assert row["subtotal"] == lines[row["user_id"]]
        assert row["total_amount"] == row["subtotal"] + row["fee_amount"] + row["tax_amount"]


def test_tax_rate_is_a_parameter(spark):
    row = bill.billing_summary(rated(spark, data("10")), tax_rate=Decimal("0.055")).first()
    assert (row["tax_amount"], row["total_amount"]) == (Decimal("2.75"), Decimal("52.75"))


def test_invoice_lines(spark):
    early = NOON - datetime.timedelta(hours=1)
    usage = rated(spark, voice(100), sms(), data("150"), voice(1, at=early), voice(100), other("fax"))
    lines = bill.invoice_lines(usage, "2024-01")
    assert lines.columns == list(LINE_COLUMNS)
    rows = [tuple(row)[2:] for row in lines.orderBy("line_number").collect()]
    d = Decimal
    assert rows == [
        (1, "Mobile Data", d("150"), "MB", d("4"), d("600")),
        (2, "Mobile Data", None, "MB", None, d("0")),
        (3, "SMS", d("1"), "messages", d("0.5"), d("0.5")),
        (4, "Voice Calls", d("0.02"), "minutes", d("50"), d("1")),
        (5, "Voice Calls", d("1.67"), "minutes", d("1.1976"), d("2")),
        (6, "Voice Calls", d("1.67"), "minutes", d("1.1976"), d("2")),
    ]


def test_zero_quantity_has_no_unit_price(spark):
    line = bill.invoice_lines(rated(spark, voice(0)), "2024-01").first()
    assert (line["usage_quantity"], line["unit_price"]) == (Decimal("0"), None)


def test_lines_sum_to_the_summary(spark, sf_dir):
    usage = rate.rate_usage(mediate.usage_clean(fixtures.usage(spark, sf_dir)))
    lines = bill.invoice_lines(usage, "2024-01").groupBy("invoice_id").agg(F.sum("line_amount").alias("lines"))
    both = bill.billing_summary(usage, "2024-01").join(lines, "invoice_id", "full")
    assert both.where(~F.col("lines").eqNullSafe(F.col("subtotal"))).count() == 0
    assert constraints.key_violations(bill.invoice_lines(usage, "2024-01"), LINE_KEY).count() == 0


def test_costs_grow_with_volume(spark):
    steps = spark.range(1, 60_000).select(
        F.col("id").alias("record_id"), F.lit("data").alias("record_type"), (F.col("id") / 100).cast("decimal(18,6)").alias("data_volume_mb"),
        F.lit(NOON).cast("timestamp_ntz").alias("event_ts"), F.lit(None).cast("int").alias("duration_sec"), F.lit("").alias("sender_id"),
    )
    ordered = rate.rate_usage(steps).selectExpr("cost - lag(cost) OVER (ORDER BY record_id) AS step", "cost")
    low, high = ordered.selectExpr("min(step)", "max(step)").first()
    assert (low, high) == (Decimal("0.02"), Decimal("0.05"))


def test_key_violations(spark):
    rows = spark.createDataFrame([("i", 1), ("i", 1), ("i", 2), ("i", None), (None, 1)], "invoice_id STRING, line_number INT")
    found = {(r["invoice_id"], r["line_number"]): r["n"] for r in constraints.key_violations(rows, LINE_KEY).collect()}
    assert found == {("i", 1): 2, ("i", None): 1, (None, 1): 1}


def test_fees(spark):
    usage = rated(spark, data("10"), sms(), sms(user="b"), other("fax", user="c"))
    rows = {row["user_id"]: row for row in bill.billing_with_fees(usage, fixtures.fees(spark)).collect()}
    assert rows["a"]["subtotal"] == Decimal("50.5")
    assert rows["a"]["fee_amount"] == Decimal("0.51") + Decimal("2") + Decimal("0.25")
    assert rows["a"]["tax_amount"] == Decimal("10.65")
    assert rows["b"]["total_amount"] == Decimal("0.5") + Decimal("0.01") + Decimal("2") + Decimal("0.50")
    assert rows["c"]["total_amount"] == Decimal("2.40")
    plain = bill.billing_with_fees(usage, fixtures.fees(spark).drop("step")).where("user_id = 'a'").first()
    assert plain["tax_amount"] == Decimal("10.1")
    with pytest.raises(ValueError):
        bill.invoice_fees(usage, spark.range(300).selectExpr("CAST(id AS STRING) AS fee", "'fee' AS category", "'all' AS scope", "'fixed' AS kind", "1.0 AS amount"))
    only_sms = fixtures.fees(spark).where("scope = 'sms'")
    assert bill.billing_with_fees(usage, only_sms).count() == 3
    assert bill.invoice_fees(usage, only_sms).count() == 0


def test_quota(spark):
    usage = rated(
        spark,
        data("300"),
        data("150"),
        data("100"),
        data("10"),
        voice(3599),
        voice(10),
        data("600", at=datetime.datetime(2024, 2, 1)),
        other("fax"),
    )
    left = bill.billable_after_quota(usage, fixtures.quotas(spark)).orderBy("record_id").collect()
    assert [row["billable"] for row in left] == [Decimal(b) for b in ("0", "0", "50", "10", "0", "1", "100", "0")]


def test_quota_lowers_the_price(spark):
    usage = rated(spark, data("300"), data("400"), data("100"), voice(10), sms(user=None), sms(at=None))
    left = bill.rate_after_quota(usage, fixtures.quotas(spark)).orderBy("record_id").collect()
    assert [row["cost"] for row in left] == [Decimal(c) for c in ("0", "550", "500", "0", "0", "0.5")]
    assert [row["base_cost"] for row in left] == [Decimal(c) for c in ("900", "1100", "500", "1", "0", "0.5")]
    assert set(usage.columns) <= set(left[0].asDict())


def test_documents_page_large_invoices(spark):
    usage = rated(spark, *[sms()] * 7, sms(user="b"))
    lines, summary = bill.invoice_lines(usage, "2024-01"), bill.billing_summary(usage, "2024-01")
    pages = documents.invoice_documents(summary, lines, page_lines=3).orderBy("invoice_id", "page").collect()
    assert [(p["user_id"], p["page"], p["n_lines"]) for p in pages] == [("a", 1, 3), ("a", 2, 3), ("a", 3, 1), ("b", 1, 1)]
    assert [line["line_number"] for page in pages[:3] for line in page["lines"]] == [1, 2, 3, 4, 5, 6, 7]
    assert [page["pages"] for page in pages] == [3, 3, 3, 1]
    assert [page["header"]["total_amount"] for page in pages] == [Decimal(t) for t in ("4.20", "4.20", "4.20", "0.60")]


def test_clients(spark):
    usage = frame(spark, sms("a"), sms("zz"), voice(5, user=None), sms("a"))
    known = spark.createDataFrame([("a",), ("b",)], "user_id STRING")
    assert [r["record_id"] for r in clients.usage_of_known_clients(usage, known).orderBy("record_id").collect()] == [0, 3]
    assert [r["record_id"] for r in clients.usage_of_unknown_clients(usage, known).orderBy("record_id").collect()] == [1, 2]
    assert [r["user_id"] for r in clients.clients_without_usage(usage, known).collect()] == ["b"]


def test_kpi_change(spark):
    usage = rated(
        spark,
        sms(at=datetime.datetime(2024, 1, 5)),
        sms(at=datetime.datetime(2024, 2, 5)),
        sms(at=datetime.datetime(2024, 2, 6), user="b"),
        sms(at=datetime.datetime(2024, 2, 7), user="b"),
    )
    rows = reports.revenue_kpi(usage).orderBy("cycle").collect()
    assert [(r["cycle"], r["revenue"], r["users"]) for r in rows] == [("2024-01", Decimal("0.5"), 1), ("2024-02", Decimal("1.5"), 2)]
    assert [(r["previous_revenue"], r["change"], r["revenue_per_user"]) for r in rows] == [
        (None, None, Decimal("0.5")),
        (Decimal("0.5"), Decimal("2"), Decimal("0.75")),
    ]


def test_kpi_after_a_gap(spark):
    usage = rated(spark, *[sms(at=datetime.datetime(2024, month, 5)) for month in (1, 3, 4, 4)])
    rows = reports.revenue_kpi(usage).orderBy("cycle").collect()
    assert [(r["previous_revenue"], r["change"]) for r in rows] == [(None, None), (Decimal("0"), None), (Decimal("0.5"), Decimal("1"))]
    days = rated(spark, *[sms(at=datetime.datetime(2024, 1, day)) for day in (1, 2, 4)])
    assert [r["previous_revenue"] for r in reports.revenue_kpi(days, "day").orderBy("cycle").collect()] == [None, Decimal("0.5"), Decimal("0")]


def test_usage_without_quantity_counts_as_a_record(spark):
    row = reports.usage_by_hour(rated(spark, data("3"), data("5"), other("data"), other("fax"))).where("record_type = 'data'").first()
    assert (row["n"], row["median_quantity"]) == (2, 4.0)
    fax = reports.usage_by_hour(rated(spark, data("3"), other("fax"))).where("record_type = 'fax'").first()
    assert (fax["n"], fax["median_quantity"], fax["total_quantity"]) == (1, None, None)


def test_top_users_breaks_ties_by_id(spark):
    usage = rated(spark, *[sms(user=u) for u in "dcba"], voice(10, user="e"))
    top = reports.top_users(usage, k=3).orderBy("rank").collect()
    assert [row["user_id"] for row in top] == ["e", "a", "b"]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 101])
def test_percentiles(spark, size):
    import numpy as np

    usage = rated(spark, *[data(str(i * i)) for i in range(1, size + 1)])
    row = reports.usage_by_hour(usage).first()
    values = [i * i for i in range(1, size + 1)]
    assert row["median_quantity"] == pytest.approx(np.percentile(values, 50), abs=1e-6)
    assert row["p95_quantity"] == pytest.approx(np.percentile(values, 95), abs=1e-6)
    assert row["n"] == size
