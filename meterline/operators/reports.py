"""Reports for clients, revenue, usage patterns and the pipeline itself."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline import constants as c
from meterline.functions import charges
from meterline.operators.bill import billable
from meterline.operators.mediate import payload_key, validate_usage
from meterline.plans.percentiles import write_histogram_percentiles
from meterline.plans.running import HOT_ROWS


def reject_profile(usage: DataFrame) -> DataFrame:
    """Damaged records by type and reason, and copies as reason ``duplicate``, with their share of the type.

    One grouping finds both: copies share a payload and a verdict, and collapse before the shuffle.  ``usage``
    must still have its original text (see :func:`meterline.operators.mediate.type_usage` and ``parse_usage``).
    """
    judged = validate_usage(usage)
    payloads = judged.groupBy(payload_key().alias("_key"), "record_type", "reject_reason").agg(
        F.count(F.lit(1)).alias("copies")
    )

    def counted(reason: Column, n: Column, records: Column) -> Column:
        return F.struct(reason.alias("reason"), n.alias("n"), records.alias("records"))

    copies = F.col("copies")
    classes = F.array(
        counted(F.col("reject_reason"), copies, copies),
        counted(F.lit("duplicate"), copies - 1, F.lit(0).cast("bigint")),
    )
    counts = (
        payloads.select("record_type", F.inline(classes))
        .groupBy("record_type", "reason")
        .agg(F.sum("n").alias("n"), F.sum("records").alias("records"))
    )
    of_type = F.sum("records").over(Window.partitionBy("record_type"))
    share = F.round(F.col("n").cast("decimal(18,0)") / F.col("of_type").cast("decimal(18,0)"), 6)
    return (
        counts.withColumn("of_type", of_type)
        .where(F.col("reason").isNotNull() & (F.col("n") > 0))
        .select("record_type", "reason", "n", share.cast("decimal(9,6)").alias("share"))
    )


def consumption_rollup(rated: DataFrame) -> DataFrame:
    """Minutes, messages, MB and cost by client and day, by client, and in all.

    Usage is reduced to client days first, so the grouping sets unfold days and not records.
    """

    def amount(kind: str, value: Column) -> Column:
        return F.sum(F.when(F.col("record_type") == kind, value).otherwise(F.lit(0).cast(c.VOLUME_TYPE)))

    days = (
        billable(rated)
        .withColumn("day", F.to_date("event_ts"))
        .groupBy("user_id", "day")
        .agg(
            amount("voice", charges.billed_quantity()).alias("minutes"),
            amount("sms", charges.billed_quantity()).alias("messages"),
            amount("data", charges.billed_quantity()).alias("megabytes"),
            F.sum("cost").alias("cost"),
        )
    )
    measures = ("minutes", "messages", "megabytes", "cost")
    return days.rollup("user_id", "day").agg(
        F.grouping("user_id").cast("int").alias("all_users"),
        F.grouping("day").cast("int").alias("all_days"),
        *[F.sum(name).cast("decimal(38,6)").alias(name) for name in measures],
    )


def _cycle(cycle: str) -> Column:
    return F.date_format("event_ts", {"month": "yyyy-MM", "day": "yyyy-MM-dd"}[cycle])


def revenue_kpi(rated: DataFrame, cycle: str = "month") -> DataFrame:
    """Revenue, clients and revenue per client by service and cycle, with the change to the previous cycle.

    A service without revenue in the calendar cycle before has 0 there, and no change; its first cycle has neither.
    """
    by_client = (
        billable(rated)
        .groupBy(_cycle(cycle).alias("cycle"), "record_type", "user_id")
        .agg(F.sum("cost").alias("cost"))
    )
    # One row per client by now, so counting rows counts clients without a distinct aggregate.
    revenue = by_client.groupBy("cycle", "record_type").agg(
        F.sum("cost").cast("decimal(28,6)").alias("revenue"), F.count(F.lit(1)).alias("users")
    )
    ordered = Window.partitionBy("record_type").orderBy("cycle")
    start = F.to_date(F.rpad("cycle", 10, "-01"))
    following = F.add_months(F.lag(start).over(ordered), 1) if cycle == "month" else F.date_add(F.lag(start).over(ordered), 1)
    gap = F.lag("cycle").over(ordered).isNotNull() & (following != start)
    nothing = F.lit(0).cast("decimal(28,6)")
    kpi = revenue.withColumn("previous_revenue", F.when(gap, nothing).otherwise(F.lag("revenue").over(ordered)))
    change = F.try_divide(
        (F.col("revenue") - F.col("previous_revenue")).cast("decimal(22,6)"),
        F.col("previous_revenue").cast("decimal(22,6)"),
    )
    per_user = F.col("revenue").cast("decimal(22,6)") / F.col("users").cast("decimal(12,0)")
    return kpi.withColumns(
        {
            "revenue_per_user": F.round(per_user, 4).cast("decimal(22,4)"),
            "change": F.round(change, 4).cast("decimal(22,4)"),
        }
    )


def top_users(rated: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` clients with the highest revenue of every billing period, ties by client id.

    Spark applies the rank limit before the exchange as well, so at most ``k`` clients per task travel.
    """
    totals = billable(rated).groupBy("billing_period", "user_id").agg(F.sum("cost").alias("revenue"))
    ranking = Window.partitionBy("billing_period").orderBy(F.col("revenue").desc(), "user_id")
    return totals.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= k)


def pipeline_counts(usage: DataFrame) -> DataFrame:
    """Records per day and stage: raw, clean, dirty, duplicate, rated (clean, copies removed) and rated value."""
    judged = validate_usage(usage)
    described = judged.select(
        payload_key().alias("_key"), F.to_date("event_ts").alias("day"), "is_valid", charges.rating_status().alias("status")
    )
    payloads = described.groupBy("_key", "day", "is_valid", "status").agg(F.count(F.lit(1)).alias("copies"))
    valid = F.col("is_valid")
    days = (
        payloads.groupBy("day")
        .agg(
            F.sum("copies").alias("raw"),
            F.sum(F.when(valid, F.col("copies")).otherwise(0)).alias("clean"),
            F.sum(F.when(valid, 0).otherwise(F.col("copies"))).alias("dirty"),
            F.sum(F.col("copies") - 1).alias("duplicate"),
            F.sum(F.when(valid & (F.col("status") == c.STATUS_RATED), 1).otherwise(0)).alias("rated"),
            F.sum(F.when(F.col("status") == c.STATUS_ERROR, F.col("copies")).otherwise(0)).alias("error"),
        )
    )
    stages = ["raw", "clean", "dirty", "duplicate", "rated", "error"]
    return days.unpivot("day", stages, "stage", "n")


def _weighted(value: str) -> Column:
    return F.sum(F.col(value) * F.col("times").cast("decimal(18,0)")).cast("decimal(38,6)")


def _pattern(rated: DataFrame, keys: dict[str, Column], hot_rows: int) -> DataFrame:
    """Records, quantity, median and 95th percentile by ``keys``, all from one histogram of the quantities.

    Usage without quantity counts as a record.  Runs jobs while it is built (:mod:`meterline.plans.percentiles`).
    """
    histogram = (
        billable(rated)
        .select(*[column.alias(name) for name, column in keys.items()], charges.billed_quantity().alias("quantity"))
        .groupBy(*keys, "quantity")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    return write_histogram_percentiles(
        histogram,
        list(keys),
        "quantity",
        "times",
        {"median_quantity": 0.5, "p95_quantity": 0.95},
        {"n": F.sum("times"), "total_quantity": _weighted("quantity")},
        hot_rows,
    )


def usage_by_hour(rated: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    return _pattern(rated, {"hour": F.hour("event_ts"), "record_type": F.col("record_type")}, hot_rows)


def usage_by_weekday(rated: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Weekday 0 is Monday."""
    return _pattern(rated, {"weekday": F.weekday("event_ts"), "record_type": F.col("record_type")}, hot_rows)


def usage_by_cell_technology(rated: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Records, revenue and median cost for every combination of cell and technology, and their subtotals."""
    costs = (
        billable(rated).groupBy("cell_id", "technology", "cost").agg(F.count(F.lit(1)).alias("times"))
    )
    cell, technology, cost = F.col("cell_id"), F.col("technology"), F.col("cost")
    sets = [[cell, technology, cost], [cell, cost], [technology, cost], [cost]]
    cubed = costs.groupingSets(sets, cell, technology, cost).agg(
        F.grouping("cell_id").cast("int").alias("all_cells"),
        F.grouping("technology").cast("int").alias("all_technologies"),
        F.sum("times").alias("times"),
    )
    keys = ["cell_id", "technology", "all_cells", "all_technologies"]
    return write_histogram_percentiles(
        cubed,
        keys,
        "cost",
        "times",
        {"median_cost": 0.5},
        {"n": F.sum("times"), "revenue": _weighted("cost")},
        hot_rows,
    )
