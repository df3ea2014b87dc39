"""Parsing, normalising, judging and deduplicating single records."""

import datetime
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterline.checks import fixtures
from meterline.operators import mediate
from meterline.schema import CANONICAL, PAYLOAD, QUANTITIES, WIRE_SCHEMA

VOICE = {
    "record_type": "voice",
    "timestamp": "2025-04-02T01:02:03Z",
    "caller_id": " U1 ",
    "callee_id": "9005500000001",
    "duration_sec": 60,
    "sender_id": "",
    "receiver_id": "",
    "user_id": "u1",
    "data_volume_mb": "",
    "session_duration_sec": "",
    "cell_id": "mill-03",
    "technology": "4G",
}
SMS = VOICE | {"record_type": "sms", "caller_id": "", "callee_id": "", "duration_sec": "", "sender_id": "u1", "receiver_id": "90055"}
DATA = VOICE | {
    "record_type": "data",
    "caller_id": "",
    "callee_id": "",
    "duration_sec": "",
    "data_volume_mb": 12.5,
    "session_duration_sec": 60,
}


def parsed(spark, *records):
    values = [r if isinstance(r, str) else json.dumps(r) for r in records]
    rows = spark.createDataFrame(list(enumerate(values)), "record_id BIGINT, value STRING")
    return mediate.parse_usage(rows)


def judge(spark, *records):
    rows = mediate.validate_usage(parsed(spark, *records)).orderBy("record_id").collect()
    return [(row["is_valid"], row["reject_reason"]) for row in rows]


def test_normalises(spark):
    row = parsed(spark, VOICE).first()
    assert row["caller_id"] == "u1"
    assert row["event_ts"] == datetime.datetime(2025, 4, 2, 1, 2, 3)
    assert row["duration_sec"] == 60


def test_event_time_is_utc_whatever_the_session_says(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stamps = ["2025-04-02T01:02:03.123456Z", "2025-04-02T03:02:03.123456+02:00", "no time", None]
        rows = parsed(spark, *[VOICE | {"timestamp": stamp} for stamp in stamps]).orderBy("record_id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    moment = datetime.datetime(2025, 4, 2, 1, 2, 3, 123456)
    assert [row["event_ts"] for row in rows] == [moment, moment, None, None]


def test_only_spaces_are_trimmed(spark):
    assert parsed(spark, VOICE | {"caller_id": "\tU1 "}).first()["caller_id"] == "\tu1"


@pytest.mark.parametrize(
    ("field", "value", "expected"),
    [
        ("duration_sec", "", None),
        ("duration_sec", "CORRUPTED_DATA", None),
        ("duration_sec", "120", None),
        ("duration_sec", 12.5, None),
        ("duration_sec", 3_000_000_000, None),
        ("duration_sec", None, None),
        ("duration_sec", 120, 120),
        ("data_volume_mb", "12.5", None),
        ("data_volume_mb", "NaN", None),
        ("data_volume_mb", 12, Decimal("12.000000")),
        ("cell_id", 7, "7"),
    ],
)
def test_lenient_fields(spark, field, value, expected):
    row = parsed(spark, VOICE | {field: value}).first()
    assert row[field] == expected
    assert row["record_type"] == "voice"


@pytest.mark.parametrize(
    "text",
    [
        '{"duration_sec":120}',
        '{"duration_sec" : "120"}',
        '{"duration_sec": ""}',
        '{"duration_sec": " 120"}',
        "{'duration_sec': '120'}",
        "{'duration_sec': 120}",
        '{"duration\\u005fsec": "120"}',
        '{"duration\\u005fsec": 120}',
        '{"duration_sec": "120", "duration_sec": 7}',
        '{"duration_sec": 7, "duration_sec": 8}',
        '{"cell_id": "\\"duration_sec\\":\\"5", "duration_sec": 5}',
        '{"duration_sec": -5}',
        '{"duration_sec": 7.0, "data_volume_mb": -7.25, "session_duration_sec": 12}',
        '{"duration_sec": 1e2, "data_volume_mb": 1e2, "session_duration_sec": 2147483648}',
        '{"data_volume_mb": NaN}',
        '{"data_volume_mb": "NaN"}',
        '{"data_volume_mb": -Infinity}',
        '{"data_volume_mb": 1e400}',
        '{"data_volume_mb": 0.1234567890123456789}',
        '{"data_volume_mb": 123456789012345678901234567890}',
        '{"data_volume_mb": {"a": 1}, "duration_sec": [5], "session_duration_sec": true}',
        '{"data_volume_mb": "CORRUPTED_DATA", "duration_sec": "1x", "session_duration_sec": "-"}',
        '{"duration_sec": 5} trailing',
        '{"duration_sec": 5',
        '[{"duration_sec": 5}]',
        "12",
    ],
)
def test_quantities_are_read_as_the_parser_reads_them(spark, text):
    """Text first and numbers afterwards gives what parsing into number fields gives."""
    row = parsed(spark, text).first()
    direct = spark.createDataFrame([(text,)], "value STRING").select(F.from_json("value", WIRE_SCHEMA).alias("r"))
    wanted = mediate.normalize_usage(direct.select("r.*")).first()
    for name in QUANTITIES:
        assert row[name] == wanted[name], name
    assert row["cell_id"] == wanted["cell_id"]


def test_damaged_objects(spark):
    rows = parsed(spark, "not json", "", "[1]", json.dumps(VOICE) + " rest", '{"Record_Type": "voice"}').orderBy("record_id")
    assert [row["record_type"] for row in rows.collect()] == [None, None, None, "voice", None]


@pytest.mark.parametrize(
    ("record", "reason"),
    [
        (VOICE, None),
        (SMS, None),
        (DATA, None),
        (VOICE | {"caller_id": ""}, None),
        (VOICE | {"caller_id": None}, "missing:caller_id"),
        (VOICE | {"callee_id": None}, "missing:callee_id"),
        (VOICE | {"duration_sec": None}, "missing:duration_sec"),
        (VOICE | {"duration_sec": "CORRUPTED_DATA"}, "corrupted:duration_sec"),
        (VOICE | {"duration_sec": "120"}, "malformed:duration_sec"),
        (VOICE | {"duration_sec": 0}, "non_positive:duration_sec"),
        (VOICE | {"duration_sec": -5}, "non_positive:duration_sec"),
        (VOICE | {"callee_id": "xCORRUPTED_DATAx"}, "corrupted:callee_id"),
        (VOICE | {"user_id": None}, None),
        (VOICE | {"timestamp": "bad", "cell_id": None}, None),
        (SMS | {"sender_id": "CORRUPTED_DATA"}, "corrupted:sender_id"),
        (SMS | {"receiver_id": None}, "missing:receiver_id"),
        (DATA | {"user_id": None}, "missing:user_id"),
        (DATA | {"data_volume_mb": None}, "missing:data_volume_mb"),
        (DATA | {"data_volume_mb": "NaN"}, "non_finite:data_volume_mb"),
        (DATA | {"data_volume_mb": "Infinity"}, "non_finite:data_volume_mb"),
        (DATA | {"data_volume_mb": 0}, "non_positive:data_volume_mb"),
        (DATA | {"session_duration_sec": "CORRUPTED_DATA"}, "corrupted:session_duration_sec"),
        (VOICE | {"record_type": "fax"}, "unknown:record_type"),
        (VOICE | {"record_type": "VOICE"}, "unknown:record_type"),
        (VOICE | {"record_type": None}, "missing:record_type"),
        ("not json", "missing:record_type"),
    ],
)
def test_verdicts(spark, record, reason):
    assert judge(spark, record) == [(reason is None, reason)]


def test_clean_and_dirty_split_the_input(spark, sf_dir):
    usage = fixtures.usage(spark, sf_dir)
    judged = mediate.validate_usage(usage)
    assert judged.where(F.col("is_valid").isNull()).count() == 0
    assert judged.where(F.col("is_valid") != F.col("reject_reason").isNull()).count() == 0
    assert mediate.usage_clean(usage).count() + mediate.usage_dirty(usage).count() == usage.count()


def test_marker_is_a_parameter(spark):
    frame = parsed(spark, SMS | {"sender_id": "BROKEN"})
    assert mediate.usage_clean(frame).count() == 1
    assert mediate.usage_clean(frame, marker="broken").count() == 0


def test_encoding_leaves_out_null_and_keeps_the_verdict(spark):
    judged = mediate.validate_usage(parsed(spark, VOICE | {"cell_id": None}))
    encoded = json.loads(mediate.encode_usage(judged).first()["value"])
    assert encoded["timestamp"] == "2025-04-02T01:02:03.000000Z"
    assert encoded["is_valid"] is True
    assert "cell_id" not in encoded
    assert "data_volume_mb" not in encoded


def test_dedup_keeps_the_first_and_is_idempotent(spark):
    usage = parsed(spark, VOICE, SMS, VOICE, VOICE | {"caller_id": "u1"}, "not json", "also not json")
    kept = mediate.dedup_usage(usage)
    assert sorted(row["record_id"] for row in kept.collect()) == [0, 1, 4]
    assert sorted(mediate.dedup_usage(kept).collect()) == sorted(kept.collect())
    assert kept.columns == list(CANONICAL)


def test_duplicate_report(spark):
    rows = mediate.duplicate_report(parsed(spark, VOICE, SMS, VOICE, VOICE)).collect()
    assert [(r["record_id"], r["last_record_id"], r["copies"]) for r in rows] == [(0, 3, 3)]


@pytest.mark.parametrize(
    ("text", "value"),
    [("5", "5"), (" 5.25 ", "5.25"), (".5", "0.5"), ("5.", "5"), ("1e2", "100"), ("5d", None), ("5f", None), ("5 MB", None), ("e5", None), ("-", None), ("", None), ("NaN", None)],
)
def test_only_whole_texts_are_numbers(spark, text, value):
    names = [f"'{text}' AS {name}" if name == "data_volume_mb" else f"CAST(NULL AS STRING) AS {name}" for name in CANONICAL if name not in ("record_id", "event_ts")]
    raw = spark.sql(f"SELECT 1L AS record_id, TIMESTAMP_NTZ'2024-01-01' AS event_ts, {', '.join(names)}")
    assert mediate.type_usage(raw).first()["data_volume_mb"] == (None if value is None else Decimal(value))


def test_payload_key_tells_microseconds_apart(spark):
    stamps = ["2025-04-02T01:02:03.000100Z", "2025-04-02T01:02:03.000900Z", "2025-04-02T01:02:03.000100Z"]
    keys = [r["k"] for r in parsed(spark, *[VOICE | {"timestamp": s} for s in stamps]).orderBy("record_id").select(mediate.payload_key().alias("k")).collect()]
    assert keys[0] == keys[2] != keys[1]
    assert len(keys[0]) == 32


def test_payload_key_ignores_arrival(spark):
    keys = parsed(spark, VOICE, VOICE, SMS).select(mediate.payload_key().alias("k")).collect()
    assert keys[0] == keys[1] != keys[2]


def test_separate_tables_become_one(spark):
    voice = spark.sql("SELECT 1L AS record_id, 'voice' AS record_type, TIMESTAMP_NTZ'2024-01-01' AS event_ts, ' A ' AS caller_id, 5 AS duration_sec")
    data = spark.sql("SELECT 2L AS record_id, 'data' AS record_type, TIMESTAMP_NTZ'2024-01-01' AS event_ts, 'b' AS user_id, 2.5D AS data_volume_mb")
    merged = mediate.unify_usage(voice, data)
    assert merged.columns == ["record_id", *PAYLOAD]
    rows = merged.orderBy("record_id").collect()
    assert rows[0]["caller_id"] == "a" and rows[0]["data_volume_mb"] is None
    assert rows[1]["data_volume_mb"] == Decimal("2.5")
