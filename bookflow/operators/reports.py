"""Standard accounting reports: plain aggregates over ledgers, invoices, payroll and assets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookflow.functions import ledger as lx

AGING_BUCKETS = [("0-30", 0, 30), ("31-60", 31, 60), ("61-90", 61, 90)]


def trial_balance(ledger: DataFrame, account: str = "account_code") -> DataFrame:
    """Debits, credits and balance by account."""
    return ledger.groupBy(account).agg(
        F.sum("amount_debit").alias("total_debit"), F.sum("amount_credit").alias("total_credit"),
        F.sum(F.col("amount_debit") - F.col("amount_credit")).alias("balance"),
    )


def is_balanced(ledger: DataFrame) -> DataFrame:
    """One row: total debits, total credits and whether they agree."""
    return ledger.agg(
        F.sum("amount_debit").alias("total_debit"), F.sum("amount_credit").alias("total_credit")
    ).withColumn("balanced", F.col("total_debit") == F.col("total_credit"))


def prior_period_variance(ledger: DataFrame, account: str = "account_code") -> DataFrame:
    """Net per account and month with the change against the calendar month before; null where that has no rows."""
    monthly = ledger.groupBy(account, lx.year_month(F.col("transaction_date")).alias("year_month")).agg(
        F.sum(F.col("amount_debit") - F.col("amount_credit")).alias("net")
    )
    month = F.split("year_month", "-")
    number = F.get(month, F.lit(0)).cast("int") * 12 + F.get(month, F.lit(1)).cast("int")
    before = Window.partitionBy(account).orderBy(number).rangeBetween(-1, -1)
    return monthly.withColumn("prior_net", F.first("net").over(before)).withColumn(
        "variance", F.col("net") - F.col("prior_net")
    )


def aging_bucket(due: Column, as_of: Column) -> Column:
    """current, 0-30, 31-60, 61-90 or 90+ days past due."""
    late = F.datediff(as_of, due)
    chain = F.when(late < 0, "current")
    for name, _, last in AGING_BUCKETS:
        chain = chain.when(late <= last, F.lit(name))
    return chain.otherwise("90+")


def aging(invoices: DataFrame, as_of: Column, party: str) -> DataFrame:
    """Outstanding amount of every party by age of the due date, and what is overdue.

    ``invoices``: party, due_date, outstanding. Serves payables and receivables alike.
    """
    open_items = invoices.filter(F.col("outstanding") > 0).withColumn("bucket", aging_bucket(F.col("due_date"), as_of))
    names = ["current", *[name for name, _, _ in AGING_BUCKETS], "90+"]
    labels = {"current": "not_due", "90+": "over_90"}

    def part(name: str) -> Column:
        label = labels.get(name, "days_" + name.replace("-", "_"))
        return F.sum(F.when(F.col("bucket") == name, F.col("outstanding")).otherwise(0)).alias(label)

    return open_items.groupBy(party).agg(
        *[part(name) for name in names],
        F.sum("outstanding").alias("total_outstanding"),
        F.sum(F.when(F.col("bucket") != "current", F.col("outstanding")).otherwise(0)).alias("overdue"),
    )


def unpaid_above(invoices: DataFrame, threshold: float) -> DataFrame:
    """Unpaid invoices above an amount."""
    return invoices.filter(F.col("outstanding") > threshold)


def average_collection_period(receipts: DataFrame, by: list[str]) -> DataFrame:
    """Mean days between invoice and payment of paid invoices."""
    days = F.datediff("paid_date", "invoice_date")
    return receipts.filter(F.col("paid_date").isNotNull()).groupBy(*by).agg(
        F.avg(days).alias("avg_days"), F.count("*").alias("paid_invoices")
    )


def payroll_by_department(payroll: DataFrame, revenue: DataFrame) -> DataFrame:
    """Payroll per department and month, year to date, and in percent of the month's revenue.

    ``payroll``: department, pay_date, gross. ``revenue``: year_month, revenue.
    """
    monthly = payroll.groupBy("department", lx.year_month(F.col("pay_date")).alias("year_month")).agg(
        F.sum("gross").alias("payroll")
    )
    running = (
        Window.partitionBy("department", F.substring("year_month", 1, 4)).orderBy("year_month")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        monthly.withColumn("year_to_date", F.sum("payroll").over(running))
        .join(revenue.select("year_month", "revenue"), "year_month", "left")
        .withColumn("pct_of_revenue", F.col("payroll").cast("double") * 100 / F.col("revenue").cast("double"))
    )


def asset_schedule(assets: DataFrame, as_of: Column) -> DataFrame:
    """Straight-line depreciation: monthly charge, months used, net book value, fully depreciated.

    ``assets``: asset, purchase_date, cost, life_months.
    """
    used = F.least(
        F.floor(F.months_between(F.trunc(as_of, "month"), F.trunc("purchase_date", "month"))).cast("int"),
        F.col("life_months"),
    )
    charge = (F.col("cost") / F.col("life_months")).cast("decimal(18,4)")
    return (
        assets.withColumn("months_used", F.greatest(used, F.lit(0)))
        .withColumn("monthly_depreciation", charge)
        .withColumn("fully_depreciated", F.col("months_used") >= F.col("life_months"))
        .withColumn(
            "net_book_value",
            F.when(F.col("fully_depreciated"), F.lit(0)).otherwise(F.col("cost") - charge * F.col("months_used"))
            .cast(lx.MONEY),
        )
    )


def asset_summary(schedule: DataFrame, by: list[str]) -> DataFrame:
    """Net book value, monthly depreciation still running and count of fully depreciated assets."""
    return schedule.groupBy(*by).agg(
        F.sum("net_book_value").alias("net_book_value"),
        F.sum(F.when(~F.col("fully_depreciated"), F.col("monthly_depreciation")).otherwise(0)).alias("monthly_depreciation"),
        F.count_if("fully_depreciated").alias("fully_depreciated"),
    )


def statement(ledger: DataFrame, groups: list[str], sign: int = 1) -> DataFrame:
    """Net per report group and month: the income statement over revenue and expense, the balance sheet over asset,
    liability and equity."""
    net = (F.col("amount_credit") - F.col("amount_debit")) * sign
    grouped = ledger.withColumn("report_group", lx.account_group(F.col("account_code")))
    return grouped.filter(F.col("report_group").isin(groups)).groupBy(
        "report_group", lx.year_month(F.col("transaction_date")).alias("year_month")
    ).agg(F.sum(net).alias("amount"))


def income_statement(ledger: DataFrame) -> DataFrame:
    """Revenue and expense per month."""
    return statement(ledger, ["revenue", "expense"])


def balance_sheet(ledger: DataFrame, as_of: Column) -> DataFrame:
    """Balance of assets, liabilities and equity on a day."""
    upto = ledger.filter(F.col("transaction_date") <= as_of)
    grouped = upto.withColumn("report_group", lx.account_group(F.col("account_code")))
    return grouped.filter(F.col("report_group").isin("asset", "liability", "equity")).groupBy("report_group").agg(
        F.sum(F.col("amount_debit") - F.col("amount_credit")).alias("balance")
    )


def cash_flow(ledger: DataFrame) -> DataFrame:
    """Cash in and out per month: operating (revenue, expense), investing (asset), financing (liability, equity)."""
    group = lx.account_group(F.col("account_code"))
    activity = (
        F.when(group.isin("revenue", "expense"), "operating").when(group == "asset", "investing")
        .when(group.isin("liability", "equity"), "financing").otherwise("other")
    )
    return ledger.groupBy(
        activity.alias("activity"), lx.year_month(F.col("transaction_date")).alias("year_month")
    ).agg(
        F.sum("amount_credit").alias("cash_in"), F.sum("amount_debit").alias("cash_out"),
        F.sum(F.col("amount_credit") - F.col("amount_debit")).alias("net_cash"),
    )


def sales_tax_return(entries: DataFrame) -> DataFrame:
    """Sales, purchases, tax collected, tax paid and tax payable per month.

    ``entries``: transaction_date, tx_type (sales or purchase), amount, tax_amount.
    """
    def total(kind: str, column: str, name: str) -> Column:
        return F.sum(F.when(F.col("tx_type") == kind, F.col(column)).otherwise(0)).alias(name)

    return entries.groupBy(lx.year_month(F.col("transaction_date")).alias("year_month")).agg(
        total("sales", "amount", "sales"), total("purchase", "amount", "purchases"),
        total("sales", "tax_amount", "tax_collected"), total("purchase", "tax_amount", "tax_paid"),
    ).withColumn("tax_payable", F.col("tax_collected") - F.col("tax_paid"))
