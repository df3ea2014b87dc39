"""Usage of a client that follows on itself, and how the client moves meanwhile."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import records
from meterline.operators.bill import billable
from meterline.plans.running import HOT_ROWS, with_previous, write_running_totals
from meterline.plans.shared_folder import written

GAP = "30 minutes"
VOLUME_SUM = "decimal(28,6)"


def _measures() -> list:
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum("cost").cast(VOLUME_SUM).alias("cost"),
        F.size(F.collect_set("cell_id")).alias("cells"),
    ]


def usage_sessions(rated: DataFrame, gap: str = GAP, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sessions: usage of one payer without a pause longer than ``gap``.

    user_id, first_use, last_use, n, cost, cells (different ones) and moves (records in another cell than the one before; an
    unknown cell is another one than any known).  Usage without time is in no session.  A payer of any size is cut into slices by
    time, for the look at the record before as for the numbering; runs jobs while it is built.
    """
    names = ("user_id", "event_ts", "record_id", "cell_id", "cost")
    usage = written(billable(rated).where(F.col("event_ts").isNotNull()).select(*names), "session-usage")
    before = with_previous(usage, ["user_id"], ["event_ts", "record_id"], {"_ts": "event_ts", "_cell": "cell_id"}, hot_rows)
    length = F.expr(f"INTERVAL {gap}")
    begins = F.col("_ts").isNull() | (F.col("event_ts") > F.col("_ts") + length)
    moved = ~begins & ~F.col("cell_id").eqNullSafe(F.col("_cell"))
    flagged = before.select(*names, begins.cast("bigint").alias("_begins"), moved.cast("bigint").alias("_moved"))
    numbered = write_running_totals(
        written(flagged, "session-borders"), ["user_id"], ["event_ts", "record_id"], {"_session": F.col("_begins")}, hot_rows
    )
    return (
        numbered.groupBy("user_id", "_session")
        .agg(F.min("event_ts").alias("first_use"), F.max("event_ts").alias("last_use"), *_measures(), F.sum("_moved").alias("moves"))
        .drop("_session")
    )


def session_stream(rated: DataFrame, gap: str = GAP, delay: str = "1 hour") -> DataFrame:
    """The same sessions from a stream of rated usage, without moves, which need the order of the records.

    A session comes out once, when the watermark, ``delay`` behind the latest usage, has passed its end; state holds sums and the
    set of cells of open sessions, not their usage.
    """
    timed = billable(rated).withColumn("_at", records.utc_instant(F.col("event_ts"))).withWatermark("_at", delay)
    sessions = timed.groupBy("user_id", F.session_window("_at", gap).alias("_window")).agg(
        F.min("event_ts").alias("first_use"), F.max("event_ts").alias("last_use"), *_measures()
    )
    return sessions.drop("_window")
