"""The folder every executor can reach, for intermediate tables."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="meterline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or the folder given to ``setCheckpointDir``.

    Without either, a session whose executors are threads of the driver gets a folder of its own that goes when the
    driver ends; any other must name one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own_folder()
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a Parquet table below the shared folder, so that a lost executor cannot change them."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
