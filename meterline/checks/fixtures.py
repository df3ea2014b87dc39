"""Usage records, clients and rule tables derived from the given test tables.

Raw records are a projection of ``events``; clients come from ``customer``.  The rule tables hold our own
example values.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.mediate import type_usage
from meterline.schema import IDENTIFIERS, QUANTITIES

COPY_OFFSET = 1_000_000_000
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


_RECORD_TYPE = """
    CASE event_type WHEN 'click' THEN 'voice' WHEN 'purchase' THEN 'sms' WHEN 'view' THEN 'data'
                    WHEN 'signup' THEN 'data' ELSE CASE WHEN event_id % 2 = 0 THEN 'fax' END END"""

_RECORD = """
    named_struct(
      'record_type', record_type,
      'event_ts', ts,
      'caller_id', if(record_type = 'voice', concat(' ', upper(uid), ' '), ''),
      'callee_id', if(record_type = 'voice', partner, ''),
      'duration_sec', if(record_type = 'voice', if(corrupted, 'CORRUPTED_DATA', CAST(CAST(floor(value * 3) AS INT) AS STRING)), ''),
      'sender_id', if(record_type = 'sms', if(corrupted, 'CORRUPTED_DATA', uid), ''),
      'receiver_id', if(record_type = 'sms', partner, ''),
      'user_id', uid,
      'data_volume_mb', if(record_type = 'data', if(missing, NULL, CAST(CAST(value AS DECIMAL(10,2)) AS STRING)), ''),
      'session_duration_sec', if(record_type = 'data', if(corrupted, 'CORRUPTED_DATA', CAST(60 + event_id % 3541 AS STRING)), ''),
      'cell_id', element_at(array('ridge-01', 'harbour-02', 'mill-03'), CAST(event_id % 3 AS INT) + 1),
      'technology', concat(2 + event_id % 4, 'G')) AS record"""


def raw_from_events(events: DataFrame) -> DataFrame:
    """Raw records with quantities as text, as a source would send them; works on streams too.

    Damage and copies follow from the event id: 3 in tens lacks a field, 7 in tens has a corrupted one, 5 in
    twenties arrives twice.
    """
    described = events.selectExpr(
        "event_id",
        "ts",
        "value",
        "concat('u', user_id) AS uid",
        f"{_RECORD_TYPE} AS record_type",
        "event_id % 10 = 3 AS missing",
        "event_id % 10 = 7 AS corrupted",
        "if(event_id % 10 = 3, NULL, concat('90055', 10000000 + event_id)) AS partner",
    )
    # Unfolding records as wholes keeps these expressions from being repeated in everything built on them.
    unfolded = described.selectExpr("event_id", _RECORD).selectExpr(
        "event_id", "posexplode(if(event_id % 20 = 5, array(record, record), array(record))) AS (copy, record)"
    )
    return unfolded.selectExpr(f"event_id + copy * {COPY_OFFSET}L AS record_id", "record.*")


def json_from_raw(raw: DataFrame) -> DataFrame:
    """``record_id`` and ``value``: numbers bare, other text quoted, NULL as null."""
    texts = [*("record_type", "cell_id", "technology"), *IDENTIFIERS]
    members = [f"""'"{name}":', coalesce(concat('"', {name}, '"'), 'null')""" for name in texts]
    members += [
        f"""'"{name}":', coalesce(if({name} RLIKE '^[0-9.]+$', {name}, concat('"', {name}, '"')), 'null')"""
        for name in QUANTITIES
    ]
    members.append(
        """'"timestamp":', coalesce(concat('"', date_format(event_ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), '"'), 'null')"""
    )
    joined = ", ',', ".join(members)
    return raw.selectExpr("record_id", f"concat('{{', {joined}, '}}') AS value")


def raw_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_events(table(spark, sf_dir, "events"))


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_usage(raw_usage(spark, sf_dir))


def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_from_raw(raw_usage(spark, sf_dir))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )


def with_close_records(raw: DataFrame) -> DataFrame:
    """On top, of 1 record in 50 another one that differs in its time alone, and by less than a millisecond."""
    again = F.when(F.col("record_id") % 50 == 11, F.array(F.lit(0), F.lit(400))).otherwise(F.array(F.lit(0)))
    unfolded = raw.withColumn("_later", F.explode(again))
    return unfolded.withColumn("event_ts", F.timestamp_add("MICROSECOND", F.col("_later"), F.col("event_ts"))).drop("_later")


def unordered_events(spark: SparkSession, sf_dir: str, path: str, batches: int = 6) -> DataFrame:
    """The events as a stream of several batches, each with events of all days."""
    events = table(spark, sf_dir, "events")
    events.repartition(batches, F.xxhash64("event_id")).write.mode("overwrite").parquet(path)
    return spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", 1).parquet(path)


def incomplete(clean: DataFrame) -> DataFrame:
    """Clean usage of which some has lost its time and some its payer."""
    undated, unowned = F.col("record_id") % 50 == 1, F.col("record_id") % 50 == 2
    names = ("caller_id", "user_id")
    return clean.withColumns(
        {
            "event_ts": F.when(~undated, F.col("event_ts")),
            **{name: F.when(~unowned, F.col(name)) for name in names},
        }
    )


def weekly_usage(clean: DataFrame) -> DataFrame:
    """Clean usage in five weeks running, a little different each time; in the last one, some is twenty times as much."""
    weeks = F.explode(F.sequence(F.lit(0), F.lit(4)))
    unfolded = clean.withColumn("_week", weeks)
    outlier = (F.col("record_id") % 50 == 8) & (F.col("_week") == 4)
    factor = F.when(outlier, 20).otherwise(F.lit(1) + F.pmod(F.col("record_id") + F.col("_week") * 7, F.lit(5)) * F.lit(0.01).cast("decimal(4,2)"))
    seconds = F.floor(F.col("duration_sec") * factor).cast("int")
    return unfolded.withColumns(
        {
            "record_id": F.col("record_id") * 10 + F.col("_week"),
            "event_ts": F.expr("event_ts + make_dt_interval(7 * _week)"),
            "duration_sec": seconds,
            "data_volume_mb": F.round(F.col("data_volume_mb") * factor, 2).cast("decimal(18,6)"),
        }
    ).drop("_week")


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients with plan and country."""
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("user_id"),
        F.col("c_mktsegment").alias("plan"),
        "country",
    )


def plans(spark: SparkSession) -> DataFrame:
    """Price multiplier per plan; FURNITURE has none on purpose."""
    return spark.sql(
        """SELECT plan, CAST(plan_multiplier AS decimal(4,2)) AS plan_multiplier
           FROM VALUES ('AUTOMOBILE', 0.95), ('BUILDING', 0.90), ('HOUSEHOLD', 1.00), ('MACHINERY', 0.85)
                AS plans(plan, plan_multiplier)"""
    )


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients whose plan is in the catalogue; usage of all others counts as that of unknown clients."""
    return clients(spark, sf_dir).join(plans(spark), "plan", "left_semi")


def promotions(spark: SparkSession) -> DataFrame:
    """The second data promotion overlaps the first; the one for calls has no end."""
    return spark.sql(
        """SELECT service, CAST(valid_from AS TIMESTAMP_NTZ) AS valid_from, CAST(valid_to AS TIMESTAMP_NTZ) AS valid_to,
                  CAST(percent_off AS decimal(4,2)) AS percent_off
           FROM VALUES ('data', '2024-01-10 00:00:00', '2024-01-20 00:00:00', 0.25),
                       ('data', '2024-01-18 12:00:00', '2024-01-22 06:00:00', 0.10),
                       ('sms', '2024-01-15 00:00:00', '2024-02-01 00:00:00', 0.50),
                       ('voice', '2024-01-25 00:00:00', NULL, 0.20)
                AS promotions(service, valid_from, valid_to, percent_off)"""
    )


def many_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A promotion for every other event: some last minutes, some days, some end before they start, some never end."""
    own = table(spark, sf_dir, "events").where("event_id % 2 = 0")
    return own.selectExpr(
        "element_at(array('voice', 'sms', 'data'), CAST(event_id % 3 AS INT) + 1) AS service",
        "date_trunc('minute', ts) AS valid_from",
        "if(event_id % 100 = 50, NULL, date_trunc('minute', ts) + make_dt_interval(0, CAST(event_id % 700 AS INT) - 10)) AS valid_to",
        "CAST((event_id % 61) / 100 AS decimal(4,2)) AS percent_off",
    )


def plan_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan that each client has had since ever, and changes of plan while the events happen; some end without a new one."""
    changes = table(spark, sf_dir, "events").where("event_id % 7 = 0").selectExpr(
        "concat('u', user_id) AS user_id",
        "element_at(array('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD', 'MACHINERY', 'FURNITURE', NULL), CAST(event_id % 6 AS INT) + 1) AS plan",
        "ts AS valid_from",
    )
    first = clients(spark, sf_dir).select("user_id", "plan", F.lit(None).cast("timestamp_ntz").alias("valid_from"))
    return first.unionByName(changes)


def plan_prices(spark: SparkSession) -> DataFrame:
    """Prices of plans over time: one changes, one begins late, one has always been the same."""
    return spark.sql(
        """SELECT plan, CAST(plan_multiplier AS decimal(4,2)) AS plan_multiplier, CAST(valid_from AS TIMESTAMP_NTZ) AS valid_from
           FROM VALUES ('AUTOMOBILE', 0.95, NULL), ('AUTOMOBILE', 0.75, '2024-01-12 06:30:00'), ('AUTOMOBILE', 1.05, '2024-01-23 00:00:00'),
                       ('BUILDING', 0.90, '2024-01-08 00:00:00'), ('HOUSEHOLD', 1.00, NULL), ('MACHINERY', 0.85, '2024-01-01 00:00:00')
                AS prices(plan, plan_multiplier, valid_from)"""
    )


def hour_bands(spark: SparkSession) -> DataFrame:
    return spark.sql(
        """SELECT weekend, from_hour, to_hour, CAST(hour_multiplier AS decimal(4,2)) AS hour_multiplier
           FROM VALUES (false, 22, 6, 0.50), (false, 6, 20, 1.00), (false, 20, 22, 0.80),
                       (true, 0, 8, 0.50), (true, 8, 20, 0.90), (true, 20, 24, 0.70)
                AS bands(weekend, from_hour, to_hour, hour_multiplier)"""
    )


def cell_modifiers(spark: SparkSession) -> DataFrame:
    return spark.sql(
        """SELECT cell_id, CAST(cell_multiplier AS decimal(4,2)) AS cell_multiplier
           FROM VALUES ('ridge-01', 1.00), ('harbour-02', 0.90), ('mill-03', 1.10)
                AS cells(cell_id, cell_multiplier)"""
    )


def other_tariff(spark: SparkSession) -> DataFrame:
    """Prices unlike the default ones, with three tiers and amounts below a cent."""
    return spark.sql(
        """SELECT service, CAST(tier_from AS decimal(18,6)) AS tier_from, CAST(tier_to AS decimal(18,6)) AS tier_to, unit,
                  CAST(price AS decimal(10,4)) AS price, round_rule
           FROM VALUES ('voice', 0, 5, 'minute', 0.30, 'ceil'), ('voice', 5, NULL, 'minute', 0.10, 'ceil'),
                       ('sms', 0, NULL, 'message', 0.07, 'none'),
                       ('data', 0, 50, 'MB', 1.25, 'none'), ('data', 50, 200, 'MB', 0.80, 'none'),
                       ('data', 200, NULL, 'MB', 0.25, 'none')
                AS tariff(service, tier_from, tier_to, unit, price, round_rule)"""
    )


def fees(spark: SparkSession) -> DataFrame:
    """The tax comes last and is taken of the fees, too."""
    return spark.sql(
        """SELECT fee, category, scope, kind, CAST(amount AS decimal(10,4)) AS amount, step
           FROM VALUES ('tax', 'tax', 'all', 'percent', 0.20, 2),
                       ('regulatory', 'fee', 'all', 'percent', 0.01, 1),
                       ('access', 'fee', 'all', 'fixed', 2.00, 1),
                       ('data network', 'fee', 'data', 'percent', 0.005, 1)
                AS fees(fee, category, scope, kind, amount, step)"""
    )


def quotas(spark: SparkSession) -> DataFrame:
    return spark.sql(
        """SELECT service, CAST(free_units AS decimal(18,6)) AS free_units
           FROM VALUES ('data', 500), ('sms', 10), ('voice', 60) AS quotas(service, free_units)"""
    )
