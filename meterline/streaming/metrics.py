"""Counts of every micro-batch, kept where anyone can read them."""

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from meterline.sinks.segments import SegmentFolder, read_live

SCHEMA = (
    "query STRING, query_id STRING, batch_id BIGINT, metric STRING, counter STRING, n BIGINT, finished_at TIMESTAMP, day DATE"
)


class BatchMetrics(StreamingQueryListener):
    """Stores what streams observe (:func:`meterline.streaming.mediated`, ``start_rating``), once for each query and batch.

    Add it with ``spark.streams.addListener``.  A query keeps its id and counts its batches on when it starts again from its
    checkpoint, so nothing is counted twice; a batch whose driver died before it could report is missing here, not in the
    output.  Rows lie in merged segments by day, as other output of streams does.
    """

    def __init__(self, spark: SparkSession, path: str, fan_out: int = 8):
        self.spark, self.path, self.fan_out = spark, path, fan_out
        self.seen: dict[str, int] = {}
        self.failure: Exception | None = None
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        try:
            rows = [
                (progress.name, str(progress.id), progress.batchId, metric, counter, value, progress.timestamp)
                for metric, observed in progress.observedMetrics.items()
                for counter, value in observed.asDict().items()
            ]
            if rows:
                kinds = "query STRING, query_id STRING, batch_id BIGINT, metric STRING, counter STRING, n BIGINT, finished STRING"
                counts = self.spark.createDataFrame(rows, kinds).coalesce(1)
                finished = F.col("finished").cast("timestamp")
                dated = counts.withColumns({"finished_at": finished, "day": finished.cast("date")}).drop("finished")
                SegmentFolder(self.path, str(progress.id), "day", self.fan_out)(dated, progress.batchId)
        except Exception as failure:  # the stream goes on; whoever waits is told
            self.failure = failure
        with self.changed:
            self.seen[str(progress.id)] = max(progress.batchId, self.seen.get(str(progress.id), -1))
            self.changed.notify_all()

    def await_batch(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Waits until the last batch that ``query`` has reported is stored; raises what went wrong."""
        last = query.lastProgress
        if last is not None:
            with self.changed:
                arrived = self.changed.wait_for(lambda: self.seen.get(str(query.id), -1) >= last.batchId, timeout)
            if not arrived:
                raise TimeoutError(f"no counts of batch {last.batchId} of {query.id}")
        if self.failure:
            raise self.failure


def read_batch_metrics(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """query, query_id, batch_id, metric, counter, n, finished_at of the batches that finished from day ``first`` to ``last``."""

    def inside(day: str) -> bool:
        return (first or day) <= day <= (last or day)

    return read_live(spark, path, StructType.fromDDL(SCHEMA), "day", inside)
