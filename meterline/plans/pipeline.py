"""The stages put together for batch jobs."""

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.constants import STATUS_RATED
from meterline.operators import bill, mediate, modifiers, rate
from meterline.plans.clients import bucketed, write_by_client
from meterline.plans.shared_folder import written
from meterline.schema import CANONICAL
from meterline.sinks import new_run, record_run, run_path


@dataclass(frozen=True)
class Rules:
    """Rule tables that change prices; what is None does not apply.

    tariff: see :func:`meterline.operators.rate.rate_by_tariff_table`; without one, stored prices stay.  subscriptions
    and plans go together, promotions stand for themselves
    (:func:`meterline.operators.modifiers.rate_with_promotions`).  fees: see :func:`meterline.operators.bill.billing_with_fees`.
    """

    tariff: DataFrame | None = None
    bands: DataFrame | None = None
    cells: DataFrame | None = None
    subscriptions: DataFrame | None = None
    plans: DataFrame | None = None
    promotions: DataFrame | None = None
    quotas: DataFrame | None = None
    fees: DataFrame | None = None


def rated_usage(raw: DataFrame, dedup: bool = True) -> DataFrame:
    """Raw JSON records to priced clean usage.  ``dedup=False`` charges every copy."""
    clean = mediate.usage_clean(mediate.parse_usage(raw)).select(*CANONICAL)
    return rate.rate_usage(mediate.dedup_usage(clean) if dedup else clean)


def priced(usage: DataFrame, rules: Rules) -> DataFrame:
    """Rated usage after all rules, in this order: tariff, hours and cells, plan and promotion, quota.

    ``base_cost`` is the price before the rules.
    """
    names = [name for name in usage.columns if name != "base_cost"]
    priced = usage
    if rules.tariff is not None:
        priced = rate.rate_by_tariff_table(priced.drop("status", "cost", "billing_period"), rules.tariff)
    priced = priced.select(*names).withColumn("_price", F.col("cost"))
    if rules.bands is not None or rules.cells is not None:
        spark = usage.sparkSession
        bands = rules.bands if rules.bands is not None else spark.createDataFrame(
            [], "weekend boolean, from_hour int, to_hour int, hour_multiplier decimal(4,2)"
        )
        cells = rules.cells if rules.cells is not None else spark.createDataFrame(
            [], "cell_id string, cell_multiplier decimal(4,2)"
        )
        priced = modifiers.rate_with_modifiers(priced, bands, cells).drop("base_cost")
    if any(table is not None for table in (rules.subscriptions, rules.plans, rules.promotions)):
        priced = modifiers.rate_with_promotions(priced, rules.subscriptions, rules.plans, rules.promotions)
        priced = priced.drop("base_cost", "payer")
    if rules.quotas is not None:
        # Quotas run over the usage several times, so what they run over is written.
        priced = bill.rate_after_quota(written(priced, "priced"), rules.quotas).drop("base_cost")
    return priced.select(*names, F.col("_price").alias("base_cost"))


def rated_once(rated: DataFrame) -> DataFrame:
    """Rated records, the first arrival of every payload with the price it was given."""
    kept = rated.where(F.col("status") == STATUS_RATED)
    return mediate.dedup_usage(kept, ("status", "cost", "billing_period"))


def bill_period(
    rated: DataFrame,
    path: str,
    period: str,
    invoice_date: Column | None = None,
    period_filter: bool = True,
    dedup: bool = True,
    rules: Rules | None = None,
) -> str:
    """Bills stored usage and publishes its tables of the period together; returns the run.

    ``billed_usage``: the usage that is billed, exchanged once, by payer
    (:func:`meterline.plans.clients.write_by_client`).  ``invoice_charges``: what each invoice charges, with its fees and
    taxes, worked out from it once; ``billing_summary`` and, with ``rules.fees``, ``invoices`` and ``invoice_fees`` are
    projections of that table, so all totals are equal.  ``invoice_lines`` reads the same usage.  ``unbillable_usage``: rated
    records without payer in the period, or without time, which belong to no period and appear with every one.  Stored
    prices stay, unless ``rules`` change them.
    """
    spark, run = rated.sparkSession, new_run()
    fees = None if rules is None else rules.fees
    if period_filter:
        rated = rated.where((F.col("billing_period") == period) | F.col("billing_period").isNull())
    usage = rated_once(rated) if dedup else rated.where(F.col("status") == STATUS_RATED)
    if rules is not None:
        usage = priced(usage, replace(rules, quotas=None))

    def stored(name: str, table: DataFrame) -> DataFrame:
        path_of_run = run_path(path, name, period, run)
        table.write.mode("error").parquet(path_of_run)
        return spark.read.schema(table.schema).parquet(path_of_run)

    usage = stored("rated_usage", usage)
    unbillable = bill.unbillable(usage if period_filter else usage.withColumn("billing_period", F.lit(period)))
    # All usage is exchanged here, on its payer, and nowhere below.  No payer is in two parts.
    parts = write_by_client(bill.usage_of_period(usage.where(F.col("status") == STATUS_RATED), period, period_filter))
    if rules is not None and rules.quotas is not None:

        def after_quota(part: DataFrame) -> DataFrame:
            left = bill.price_after_quota(part.withColumnRenamed("base_cost", "_price"), rules.quotas)
            return left.drop("base_cost").withColumnRenamed("_price", "base_cost")

        parts = [bucketed(after_quota(parts[0]), "after_quota"), *[written(after_quota(p), "after-quota") for p in parts[1:]]]

    def of_all(table: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, [table(part) for part in parts])

    charged = stored("invoice_charges", of_all(lambda part: bill.invoice_charges(part, None, fees)))
    tables = {
        "billed_usage": of_all(bill.billable),
        "billing_summary": bill.summary_of(charged, invoice_date, fees is not None),
        "invoice_lines": of_all(bill.invoice_lines),
        "unbillable_usage": unbillable,
    }
    if fees is not None:
        tables["invoices"] = charged.select(*bill.INVOICE_COLUMNS)
        tables["invoice_fees"] = bill.fees_of(charged)
    for name, table in tables.items():
        stored(name, table)
    record_run(spark, path, period, run)
    return run


def published_tables(rules: Rules | None = None) -> list[str]:
    """Names of the tables of a run that are for readers outside, such as a database."""
    fees = ["invoices", "invoice_fees"] if rules is not None and rules.fees is not None else []
    return ["billing_summary", "invoice_lines", "unbillable_usage", *fees]
