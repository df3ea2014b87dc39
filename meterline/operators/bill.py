"""Invoices from rated usage."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline import constants as c
from meterline.functions import charges
from meterline.plans.running import HOT_ROWS, write_running_totals
from meterline.plans.rules import with_rules
from meterline.schema import LINE_COLUMNS, SUMMARY_COLUMNS


FEE_TYPE = "array<struct<fee:string,category:string,amount:decimal(18,2),applies:boolean>>"
INVOICE_COLUMNS = ("user_id", "billing_period", "subtotal", "fee_amount", "tax_amount", "total_amount")


def billable(rated: DataFrame) -> DataFrame:
    """Rated records with the payer as ``user_id``; usage laid out by client has its ``payer`` already."""
    payer = F.col("payer") if "payer" in rated.columns else charges.paying_user()
    charged = rated.where(F.col("status") == c.STATUS_RATED).withColumn("user_id", payer).drop("payer")
    return charged.where(F.col("user_id").isNotNull())


def unbillable(rated: DataFrame) -> DataFrame:
    """Rated records that no invoice can hold, with the ``problem``: no payer, or no readable time and so no period."""
    problem = F.when(charges.paying_user().isNull(), "payer").when(F.col("billing_period").isNull(), "time")
    return rated.where(F.col("status") == c.STATUS_RATED).withColumn("problem", problem).where(F.col("problem").isNotNull())


def usage_of_period(rated: DataFrame, period: str | None, period_filter: bool) -> DataFrame:
    """Usage of the period, on the stored column so that partitions are pruned; or all of it, so labelled.

    Without a period, all usage that has one of its own.
    """
    if period is None:
        return rated.where(F.col("billing_period").isNotNull())
    if period_filter:
        return rated.where(F.col("billing_period") == period)
    return rated.withColumn("billing_period", F.lit(period))


def charges_by_service(rated: DataFrame) -> DataFrame:
    return billable(rated).groupBy("user_id", "record_type").agg(F.sum("cost").alias("service_cost"))


def _client_totals(rated: DataFrame, amount: Column | None = None) -> DataFrame:
    """One row per client and period with service totals: one pass, one exchange, no pivot.

    Totals are of line amounts in cents, as invoices show them, or of another ``amount``.
    """
    amount = charges.line_amount() if amount is None else amount
    # An unknown record type costs nothing, so the services are all there is to sum.
    totals = [F.sum(F.when(F.col("record_type") == kind, amount).otherwise(F.lit(0))).alias(kind) for kind in c.RECORD_TYPES]
    return (
        billable(rated)
        .groupBy("user_id", "billing_period")
        .agg(*totals)
        .withColumn("subtotal", F.col("voice") + F.col("sms") + F.col("data"))
    )


def invoice_charges(
    rated: DataFrame,
    period: str | None = None,
    fees: DataFrame | None = None,
    tax_rate: Decimal = c.TAX_RATE,
    period_filter: bool = True,
) -> DataFrame:
    """What each invoice charges, worked out once: voice, sms, data, subtotal, fees, fee_amount, tax_amount, total_amount.

    Lines are rounded to cents, the subtotal is their sum, each fee and tax is rounded, and the total is the sum of what
    is shown.  Without a fee table the only fee is the tax of ``tax_rate``.  Summary, documents and fee rows are projections of
    this table, so they agree.
    """
    totals = _client_totals(usage_of_period(rated, period, period_filter))
    if fees is None:
        tax = F.round(F.col("subtotal") * F.lit(tax_rate), 2).cast(c.AMOUNT_TYPE)
        only = F.struct(F.lit("tax").alias("fee"), F.lit("tax").alias("category"), tax.alias("amount"), F.lit(True).alias("applies"))
        listed = F.array(only).cast(FEE_TYPE)
    else:
        listed = _fee_list(fees)
    charged = totals.withColumn("fees", listed)

    def sum_of(category: str) -> Column:
        own = F.filter("fees", lambda fee: fee["category"] == category)
        total = F.aggregate(own, F.lit(0).cast(c.AMOUNT_TYPE), lambda sums, fee: (sums + fee["amount"]).cast(c.AMOUNT_TYPE))
        return total.cast(c.AMOUNT_TYPE)

    charged = charged.withColumns({"fee_amount": sum_of("fee"), "tax_amount": sum_of("tax")})
    total = F.col("subtotal") + F.col("fee_amount") + F.col("tax_amount")
    return charged.withColumns(
        {
            "subtotal": F.col("subtotal").cast(c.AMOUNT_TYPE),
            "total_amount": total.cast(c.AMOUNT_TYPE),
            "fees": F.transform("fees", lambda fee: fee.dropFields("applies")),
        }
    )


def summary_of(charged: DataFrame, invoice_date: Column | None = None, with_fees: bool = False) -> DataFrame:
    """The summary of :func:`invoice_charges`; ``with_fees`` adds the column ``fee_amount``, which is part of the total."""
    names = list(SUMMARY_COLUMNS)
    if with_fees:
        names.insert(names.index("tax_amount"), "fee_amount")
    return charged.withColumns(
        {
            "invoice_id": charges.invoice_id(F.col("billing_period"), F.col("user_id")),
            "invoice_date": F.current_date() if invoice_date is None else invoice_date,
            "total_voice_cost": F.col("voice").cast(c.AMOUNT_TYPE),
            "total_sms_cost": F.col("sms").cast(c.AMOUNT_TYPE),
            "total_data_cost": F.col("data").cast(c.AMOUNT_TYPE),
        }
    ).select(*names)


def fees_of(charged: DataFrame) -> DataFrame:
    """Every fee of :func:`invoice_charges`: user_id, billing_period, subtotal, fee, category, amount."""
    return charged.select("user_id", "billing_period", "subtotal", F.inline("fees"))


def billing_summary(
    rated: DataFrame,
    period: str | None = None,
    invoice_date: Column | None = None,
    tax_rate: Decimal = c.TAX_RATE,
    period_filter: bool = True,
    fees: DataFrame | None = None,
) -> DataFrame:
    """One invoice per client and period.

    ``period=None`` bills every period in the data; ``period_filter=False`` bills all usage under the label
    ``period``.  With a fee table its fees and taxes take the place of ``tax_rate`` (:func:`invoice_charges`).
    """
    return summary_of(invoice_charges(rated, period, fees, tax_rate, period_filter), invoice_date, fees is not None)


def invoice_lines(
    rated: DataFrame, period: str | None = None, period_filter: bool = True, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One line per billed record, numbered within the invoice by service, time and arrival.

    Runs jobs while it is built (:mod:`meterline.plans.running`): bill from stored usage.
    """
    usage = billable(usage_of_period(rated, period, period_filter)).withColumn("quantity", charges.quantity())
    lines = usage.select(
        charges.invoice_id(F.col("billing_period"), F.col("user_id")).alias("invoice_id"),
        "user_id",
        "billing_period",
        charges.service_label().alias("service_type"),
        "event_ts",
        "record_id",
        F.col("quantity").cast(c.QUANTITY_TYPE).alias("usage_quantity"),
        charges.unit_label().alias("unit"),
        charges.unit_price(F.col("quantity")).alias("unit_price"),
        charges.line_amount().alias("line_amount"),
    )
    numbered = write_running_totals(
        lines,
        ["user_id", "billing_period"],
        ["service_type", "event_ts", "record_id"],
        {"line_number": F.lit(1).cast("bigint")},
        hot_rows,
    )
    return numbered.select(*LINE_COLUMNS)


def billing_by_cycle(rated: DataFrame) -> DataFrame:
    """Exact charges of every client and billing period, before any rounding."""
    return _client_totals(usage_of_period(rated, None, True), F.col("cost")).select(
        "user_id",
        "billing_period",
        F.col("voice").alias("voice_cost"),
        F.col("sms").alias("sms_cost"),
        F.col("data").alias("data_cost"),
        "subtotal",
    )


def billable_after_quota(rated: DataFrame, quotas: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``quantity`` and ``billable``, the part beyond the client's free units of that service and period.

    quotas: service, free_units; several quotas of a service add up.  Free units go to the earliest usage.
    Runs jobs while it is built (:mod:`meterline.plans.running`).
    """
    free = quotas.groupBy(F.col("service").alias("_service")).agg(
        F.sum("free_units").cast(c.VOLUME_TYPE).alias("free_units")
    )
    nothing = F.lit(0).cast(c.VOLUME_TYPE)
    usage = billable(rated).withColumn("quantity", F.coalesce(charges.billed_quantity(), nothing))
    used = write_running_totals(
        usage,
        ["user_id", "billing_period", "record_type"],
        ["event_ts", "record_id"],
        {"used": F.col("quantity")},
        hot_rows,
    )
    beyond = F.col("used") - F.coalesce("free_units", nothing)
    return (
        with_rules(used, free, {"_service": F.col("record_type")})
        .withColumn("billable", F.greatest(nothing, F.least("quantity", beyond)).cast(c.VOLUME_TYPE))
        .drop("free_units", "used")
    )


def price_after_quota(owned: DataFrame, quotas: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``base_cost`` becomes ``cost`` of the units beyond the quota: a record costs its billable share.

    ``owned``: rated records with a payer and a period.
    """
    names = owned.columns
    # ``billable`` puts the payer into user_id, which later steps look up for themselves.
    left = billable_after_quota(owned.withColumn("_user", F.col("user_id")), quotas, hot_rows)
    if "payer" in names:
        left = left.withColumn("payer", F.col("user_id"))
    left = left.withColumn("user_id", F.col("_user"))
    share = F.try_divide(F.col("billable"), F.col("quantity")).cast("decimal(19,18)")
    cost = F.round(F.col("cost") * F.coalesce(share, F.lit(1).cast("decimal(19,18)")), 6).cast(c.COST_TYPE)
    return left.withColumn("base_cost", F.col("cost")).withColumn("cost", cost).select(*names, "base_cost")


def rate_after_quota(rated: DataFrame, quotas: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The same for all rated usage: records without payer or time keep their price, for no quota is theirs."""
    has_owner = charges.paying_user().isNotNull() & F.col("billing_period").isNotNull()
    owned = rated.where(has_owner & (F.col("status") == c.STATUS_RATED))
    priced = price_after_quota(owned, quotas, hot_rows)
    rest = rated.where(~F.coalesce(has_owner & (F.col("status") == c.STATUS_RATED), F.lit(False)))
    return priced.unionByName(rest.withColumn("base_cost", F.col("cost")).select(*owned.columns, "base_cost"))


#: Fees that one invoice may have; each becomes a column expression.
MOST_FEES = 200


def _fee_list(fees: DataFrame) -> Column:
    """All fees of an invoice as an array of (fee, category, amount, applies), from columns with its charges.

    fees: fee, category ('fee' or 'tax'), scope (a record type, or 'all' for the invoice), kind ('fixed' or
    'percent'), amount and, if the table has it, step.  A percentage for the whole invoice is taken of the subtotal and
    of all fees of earlier steps, so that a tax of a later step covers them; one for a service is taken of its charge
    alone, and applies only to invoices with charges for it.  A fee table is a few rows by nature: more than
    ``MOST_FEES`` are refused.
    """
    columns = ["fee", "category", "scope", "kind", "amount", *(["step"] if "step" in fees.columns else [])]
    rows = fees.select(*columns).limit(MOST_FEES + 1).collect()
    if len(rows) > MOST_FEES:
        raise ValueError(f"more than {MOST_FEES} fees")
    nothing = F.lit(0).cast(c.AMOUNT_TYPE)
    listed, earlier = [], nothing
    for step in sorted({row["step"] if "step" in columns else 0 for row in rows}):
        own = nothing
        for row in sorted(rows, key=lambda r: (str(r["fee"]), str(r["scope"]))):
            if "step" in columns and row["step"] != step:
                continue
            whole = row["scope"] == "all"
            charge = F.col("subtotal") + earlier if whole else F.col(row["scope"])
            applies = F.lit(True) if whole else F.col(row["scope"]) > 0
            amount = F.lit(row["amount"]) if row["kind"] == "fixed" else charge.cast("decimal(24,2)") * F.lit(row["amount"])
            amount = F.round(amount, 2).cast(c.AMOUNT_TYPE)
            own = (own + F.when(applies, amount).otherwise(nothing)).cast(c.AMOUNT_TYPE)
            listed.append(
                F.struct(
                    F.lit(row["fee"]).alias("fee"),
                    F.lit(row["category"]).alias("category"),
                    amount.alias("amount"),
                    applies.alias("applies"),
                )
            )
        earlier = (earlier + own).cast(c.AMOUNT_TYPE)
    return F.filter(F.array(*listed).cast(FEE_TYPE), lambda fee: fee["applies"])


def invoice_fees(rated: DataFrame, fees: DataFrame) -> DataFrame:
    """Every fee of every invoice: user_id, billing_period, subtotal, fee, category, amount."""
    return fees_of(invoice_charges(rated, None, fees))


def billing_with_fees(rated: DataFrame, fees: DataFrame) -> DataFrame:
    """Invoices with fees and taxes from the fee table; the total is the sum of what is shown."""
    return invoice_charges(rated, None, fees).select(*INVOICE_COLUMNS)
