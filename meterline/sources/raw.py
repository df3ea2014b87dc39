"""Raw usage records as text, from message streams and landing files."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a record id: 6 for the topic's place among those subscribed, 14 for the partition, 43 for the offset.
OFFSET_BITS, PARTITION_BITS, MOST_TOPICS = 43, 14, 64
MEDIATED_SCHEMA = "record_id BIGINT, value STRING, reject_reason STRING, is_valid BOOLEAN"


def _topics(options: Mapping[str, str]) -> list[str]:
    """The topics that the options subscribe to; append new ones at the end, ids hold their places."""
    if "subscribe" not in options:
        raise ValueError("name the topics in 'subscribe': record ids hold a topic's place in that list")
    topics = [name.strip() for name in options["subscribe"].split(",")]
    if len(topics) > MOST_TOPICS:
        raise ValueError(f"at most {MOST_TOPICS} topics")
    return topics


def _from_messages(messages: DataFrame, topics: list[str]) -> DataFrame:
    """Message value as text, arrival position as ``record_id``, broker time as ``arrival_ts``."""
    topic = F.array_position(F.array(*[F.lit(name) for name in topics]), F.col("topic")) - 1
    partition = F.shiftleft(topic, PARTITION_BITS).bitwiseOR(F.col("partition").cast("bigint"))
    position = F.shiftleft(partition, OFFSET_BITS).bitwiseOR(F.col("offset"))
    return messages.select(
        position.alias("record_id"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("arrival_ts"),
    )


def _from_lines(lines: DataFrame, record_id: Column) -> DataFrame:
    """Lines of text files, with the file's time as ``arrival_ts``."""
    return lines.select(
        record_id.alias("record_id"),
        "value",
        F.col("_metadata.file_modification_time").alias("arrival_ts"),
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A landing folder with one JSON record per line, read as a batch."""
    return _from_lines(spark.read.text(path), F.monotonically_increasing_id())


def stream_raw(spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None) -> DataFrame:
    """Raw records as a stream: ``kafka`` by options (``subscribe`` etc.), or ``text`` files below ``path``.

    A new Kafka query starts with the earliest record unless ``startingOffsets`` says otherwise, so records sent
    before the first start are not lost.
    """
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").options(**{"startingOffsets": "earliest", **options})
        return _from_messages(reader.load(), _topics(options))
    if fmt == "text":
        lines = spark.readStream.format("text").options(**options).load(path)
        # A stream of lines has no positions.  The id is drawn here and stored by mediation, so it stays the same.
        # Of some billions of such ids a few will be equal; topics give ids that never are.
        return _from_lines(lines, F.xxhash64(F.uuid()))
    raise ValueError(f"raw records come from kafka or text, not {fmt}")


def read_mediated(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All records of a mediation folder: record_id, value, reject_reason, is_valid."""
    return spark.read.schema(MEDIATED_SCHEMA).format(fmt).load(path)


def stream_clean(spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None) -> DataFrame:
    """Clean records as mediation wrote them: a topic, or the files of a mediation folder."""
    if fmt == "kafka":
        return stream_raw(spark, fmt, options)
    written = spark.readStream.schema(MEDIATED_SCHEMA).format(fmt).options(**options).load(path)
    return written.where(F.col("is_valid")).select("record_id", "value")
