"""Documents to packed training sequences: quality rules, near-duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of their ``docs``, in any
number and with any further names, and change only what their decision is about.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import ship, written
from meterline.llm.host_quality import judge_by_host
from meterline.llm.mixing import mix
from meterline.llm.packing import pack
from meterline.llm.personal_data import fitted, redacted
from meterline.llm.simhash import simhash, simhash_classes


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text passes every rule and whose source is not rejected as a host."""
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("whole"), F.col("source").alias("host"))
    return judge_by_host(rows, "whole", "host", "row").where("kept").select("row.*")


def _identity() -> Column:
    """Sortable text that rows share if their ids and texts are equal, smaller ids first; documents without id come last."""
    known = F.lpad(F.expr("cast(cast(doc_id AS decimal(20,0)) + 9223372036854775808 AS string)"), 20, "0")
    return F.concat(F.coalesce(known, F.lit("~")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, that with the smallest id.

    Texts under one id are documents of their own.  Of rows with equal id and text, a text before NULL, then the one whose
    other columns come first as JSON.
    """
    ship(spark)
    keyed = docs.select(_identity().alias("key"), simhash(F.col("text")).alias("fingerprint"))
    classes = simhash_classes(written(keyed, "simhash"), "key", "fingerprint")
    kept = written(classes.where("key = component_id").select("key").distinct(), "kept")
    rows = docs.select(F.struct("*").alias("row"), _identity().alias("key"))
    order = F.struct(F.col("row.text").isNull(), F.to_json(F.col("row").dropFields("text")))
    return rows.join(kept, "key").groupBy("key").agg(F.min_by("row", order).alias("row")).select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with every piece of personal data replaced by the name of its kind; ``n_chars`` follows."""
    ship(spark)
    model = fitted(docs, "doc_id", "text")
    rows = docs.withColumn("text", redacted(F.col("text"), model))
    return rows.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for, in random order."""
    return mix(docs, "source").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; a document that was taken several times is packed as often."""
    ship(spark)
    return pack(docs, "doc_id", "text")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: Fingerprints, a trained labeller and a tokenizer are not SQL; the stages are tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
