"""Writing micro-batches of rated usage."""

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.operators.rate import to_rated_table
from meterline.sinks.tables import write_table


@dataclass(frozen=True)
class BatchFolder:
    """``foreachBatch`` writer to files: every batch replaces its own folders.

    A batch that Spark runs again after a failure has the same records, so it leaves its rows once.  Batch ids start
    over with a new checkpoint, so ``run`` must change whenever the checkpoint does.  Errors reach the query and stop it.
    Folders lie by billing period first, so that billing lists and reads those of its period alone.
    """

    path: str
    run: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumns({"run": F.lit(self.run), "batch_id": F.lit(batch_id).cast("bigint")})
        writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("billing_period", "run", "batch_id").parquet(self.path)


@dataclass(frozen=True)
class BatchTable:
    """``foreachBatch`` writer that appends to a table of rated usage, such as a database's.

    Appending is at least once: a batch that Spark runs again leaves its rows twice.  Each attempt has a name of its own and
    later ones are greater.  An attempt whose rows are all there is added to a small second table, whose name ends in
    ``_attempts``; readers take the last finished attempt of each batch
    (:func:`meterline.operators.rate.from_rated_table`).
    """

    run: str
    fmt: str = "jdbc"
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        attempt = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        origin = {"run": F.lit(self.run), "batch_id": F.lit(batch_id).cast("bigint"), "attempt": F.lit(attempt)}
        write_table(to_rated_table(batch).withColumns(origin), self.fmt, self.options, self.path)
        finished = batch.sparkSession.range(1).select(*[value.alias(name) for name, value in origin.items()])
        write_table(finished, self.fmt, *attempts_of(self.options, self.path))


def attempts_of(options: Mapping[str, str], path: str | None) -> tuple[dict[str, str], str | None]:
    """Options and path of the table of finished attempts beside a table of appended batches."""
    beside = {"dbtable": f"{options['dbtable']}_attempts"} if "dbtable" in options else {}
    return {**options, **beside}, path and f"{path.rstrip('/')}_attempts"
