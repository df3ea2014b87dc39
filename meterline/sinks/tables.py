"""Tables, CSV exports and invoice documents."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    mode: str = "append",
    partition_by: Sequence[str] = (),
) -> None:
    """Files (``path``) or a database table (``fmt="jdbc"`` and options); failures raise.

    For a database, ``numPartitions`` in the options bounds the number of connections.
    """
    writer = df.write.format(fmt).options(**(options or {})).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save() if path is None else writer.save(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header.  ``single_file`` makes one task write everything: only for small exports."""
    (df.coalesce(1) if single_file else df).write.option("header", True).mode("overwrite").csv(path)


def write_documents(documents: DataFrame, path: str, fmt: str = "json") -> None:
    """Invoice documents as JSON lines or as XML with one ``invoice`` element each."""
    if fmt == "json":
        documents.write.mode("overwrite").json(path)
    elif fmt == "xml":
        nested = documents.withColumn("lines", F.struct(F.col("lines").alias("line")))
        if "fees" in documents.schema["header"].dataType.names:
            listed = F.struct(F.col("header.fees").alias("fee"))
            nested = nested.withColumn("header", F.col("header").withField("fees", listed))
        nested.write.mode("overwrite").format("xml").options(rowTag="invoice", rootTag="invoices").save(path)
    else:
        raise ValueError(f"documents are written as json or xml, not {fmt}")
