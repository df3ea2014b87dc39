"""Invoices as nested documents."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.schema import LINE_COLUMNS

PAGE_LINES = 10_000


def _with_fee_rows(summary: DataFrame, fees: DataFrame) -> DataFrame:
    """Summaries with their fees as an array; an invoice has few (:data:`meterline.operators.bill.MOST_FEES`)."""
    keys = ["user_id", "billing_period"]
    rows = fees.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("category", "fee", "amount"))).alias("fees"))
    nothing = F.array().cast(rows.schema["fees"].dataType)
    return summary.join(rows, keys, "left").withColumn("fees", F.coalesce("fees", nothing))


def invoice_documents(
    summary: DataFrame, lines: DataFrame, page_lines: int = PAGE_LINES, fees: DataFrame | None = None
) -> DataFrame:
    """One nested row per invoice page, lines in order; every page carries the invoice header and the number of pages.

    With the table of invoice fees, the header lists the invoice's fees and taxes.

    An invoice becomes as many pages as it needs, so no array outgrows a task and no line is left out.  Headers are
    unfolded into their pages first, and meet them on (invoice, page), which stays evenly spread however many pages one
    invoice has.
    """
    if fees is not None:
        summary = _with_fee_rows(summary, fees)
    detail = [name for name in LINE_COLUMNS if name not in ("invoice_id", "user_id")]
    paged = lines.withColumn("page", F.floor((F.col("line_number") - 1) / page_lines) + 1)
    pages = paged.groupBy("invoice_id", "user_id", "page").agg(
        F.sort_array(F.collect_list(F.struct(*detail))).alias("lines"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("line_amount").alias("page_amount"),
    )
    sizes = paged.groupBy(F.col("invoice_id").alias("_of")).agg(F.max("page").alias("pages"))
    header = summary.join(sizes, F.col("invoice_id") == F.col("_of")).select(
        F.col("invoice_id").alias("_invoice"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("pages"))).alias("_page"),
        "pages",
        F.struct(*[name for name in summary.columns if name not in ("invoice_id", "user_id")]).alias("header"),
    )
    same = (F.col("invoice_id") == F.col("_invoice")) & (F.col("page") == F.col("_page"))
    return pages.join(header, same, "left").select(
        "invoice_id", "user_id", "page", "pages", "header", "n_lines", "page_amount", "lines"
    )


def document_json(documents: DataFrame) -> DataFrame:
    """Documents as one JSON text each."""
    return documents.select("invoice_id", "page", F.to_json(F.struct("*")).alias("value"))
