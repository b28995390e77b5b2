"""Accounting reports over orders, line items, customers and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookflow.operators import reports
from checks.data import AS_OF, SQL_CLEAN, as_cents, cents, clean_lines
from checks.registry import check, table

# --- general ledger -------------------------------------------------------------------------------------


@check(
    "trial_balance",
    f"""WITH {SQL_CLEAN} SELECT account_code, CAST(sum(debit_cents) AS BIGINT) AS debit, CAST(sum(credit_cents) AS BIGINT) AS credit,
    CAST(sum(debit_cents - credit_cents) AS BIGINT) AS balance FROM clean_lines GROUP BY 1""",
)
def _(spark, sf_dir):
    balance = reports.trial_balance(clean_lines(spark, sf_dir))
    return balance.select(
        "account_code", as_cents("total_debit").alias("debit"), as_cents("total_credit").alias("credit"),
        as_cents("balance").alias("balance"),
    )


@check(
    "is_balanced",
    f"""WITH {SQL_CLEAN} SELECT CAST(sum(debit_cents) + sum(credit_cents) AS BIGINT) AS debit, CAST(sum(debit_cents) + sum(credit_cents) AS BIGINT) AS credit, true AS balanced FROM clean_lines""",
)
def _(spark, sf_dir):
    # Every line booked against its counter-account.
    lines = clean_lines(spark, sf_dir)
    counter = lines.withColumns({"amount_debit": F.col("amount_credit"), "amount_credit": F.col("amount_debit")})
    total = reports.is_balanced(lines.unionByName(counter))
    return total.select(as_cents("total_debit").alias("debit"), as_cents("total_credit").alias("credit"), "balanced")


@check(
    "prior_period_variance",
    f"""WITH {SQL_CLEAN}, m AS (SELECT account_code, year_month, CAST(sum(debit_cents - credit_cents) AS BIGINT) AS net FROM clean_lines GROUP BY ALL),
    l AS (SELECT m.*, b.net AS before FROM m LEFT JOIN m b ON b.account_code = m.account_code
      AND b.year_month = strftime(strptime(m.year_month || '-01', '%Y-%m-%d') - INTERVAL 1 MONTH, '%Y-%m'))
    SELECT account_code, year_month, net, CAST(before AS VARCHAR) AS prior_net, CAST(net - before AS VARCHAR) AS variance FROM l""",
)
def _(spark, sf_dir):
    moved = reports.prior_period_variance(clean_lines(spark, sf_dir))
    return moved.select(
        "account_code", "year_month", as_cents("net").alias("net"), as_cents("prior_net").cast("string").alias("prior_net"),
        as_cents("variance").cast("string").alias("variance"),
    )


@check(
    "income_statement",
    f"""WITH {SQL_CLEAN} SELECT CASE WHEN account_code LIKE '4%' THEN 'revenue' ELSE 'expense' END AS report_group, year_month, CAST(sum(net_cents) AS BIGINT) AS amount
    FROM clean_lines WHERE account_code[1] IN ('4', '5', '6') GROUP BY ALL""",
)
def _(spark, sf_dir):
    return reports.income_statement(clean_lines(spark, sf_dir)).withColumn("amount", as_cents("amount"))


@check(
    "balance_sheet",
    f"""WITH {SQL_CLEAN} SELECT ['asset', 'liability', 'equity'][CAST(account_code[1] AS INTEGER)] AS report_group, CAST(-sum(net_cents) AS BIGINT) AS balance
    FROM clean_lines WHERE account_code[1] IN ('1', '2', '3') AND transaction_date <= DATE '1999-06-30' GROUP BY 1""",
)
def _(spark, sf_dir):
    sheet = reports.balance_sheet(clean_lines(spark, sf_dir), F.lit("1999-06-30").cast("date"))
    return sheet.withColumn("balance", as_cents("balance"))


@check(
    "cash_flow",
    f"""WITH {SQL_CLEAN} SELECT CASE WHEN account_code[1] IN ('4', '5', '6') THEN 'operating' WHEN account_code[1] = '1' THEN 'investing'
      WHEN account_code[1] IN ('2', '3') THEN 'financing' ELSE 'other' END AS activity, year_month, CAST(sum(credit_cents) AS BIGINT) AS cash_in,
    CAST(sum(debit_cents) AS BIGINT) AS cash_out, CAST(sum(net_cents) AS BIGINT) AS net_cash FROM clean_lines GROUP BY ALL""",
)
def _(spark, sf_dir):
    flow = reports.cash_flow(clean_lines(spark, sf_dir))
    return flow.withColumns({c: as_cents(c) for c in ("cash_in", "cash_out", "net_cash")})


# --- payables and receivables ---------------------------------------------------------------------------


def invoices(spark, sf_dir):
    """One invoice per order, due after 30 days; finished orders (F) are paid after 10 to 69 days."""
    issued = F.to_date("o_orderdate")
    money = (cents(F.col("o_totalprice")).cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    paid = F.col("o_orderstatus") == "F"
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("party"), issued.alias("invoice_date"),
        F.date_add(issued, 30).alias("due_date"),
        F.when(paid, F.date_add(issued, (F.col("o_orderkey") % 60 + 10).cast("int"))).alias("paid_date"),
        F.when(paid, F.lit(0)).otherwise(money).cast("decimal(18,2)").alias("outstanding"),
    )


SQL_INVOICES = f"""invoices AS (SELECT o_orderkey, o_custkey AS party, CAST(o_orderdate AS DATE) AS issued, CAST(o_orderdate AS DATE) + 30 AS due,
  CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 60 + 10 END AS days, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS owed FROM orders),
late AS (SELECT *, DATE '{AS_OF}' - INTERVAL 5 MONTH AS as_of, date_diff('day', due, CAST(DATE '{AS_OF}' - INTERVAL 5 MONTH AS DATE)) AS late FROM invoices)"""


@check(
    "aging",
    f"""WITH {SQL_INVOICES} SELECT party, CAST(sum(owed) FILTER (late < 0) AS VARCHAR) AS not_due, CAST(coalesce(sum(owed) FILTER (late BETWEEN 0 AND 30), 0) AS BIGINT) AS days_0_30,
    CAST(coalesce(sum(owed) FILTER (late BETWEEN 31 AND 60), 0) AS BIGINT) AS days_31_60, CAST(coalesce(sum(owed) FILTER (late BETWEEN 61 AND 90), 0) AS BIGINT) AS days_61_90,
    CAST(coalesce(sum(owed) FILTER (late > 90), 0) AS BIGINT) AS over_90, CAST(sum(owed) AS BIGINT) AS total, CAST(coalesce(sum(owed) FILTER (late >= 0), 0) AS BIGINT) AS overdue
    FROM late WHERE owed > 0 GROUP BY party""",
)
def _(spark, sf_dir):
    aged = reports.aging(invoices(spark, sf_dir), F.lit("2001-07-31").cast("date"), "party")
    not_due = as_cents("not_due")
    return aged.select(
        "party", F.when(not_due != 0, not_due).cast("string").alias("not_due"),
        *[as_cents(c).alias(c) for c in ("days_0_30", "days_31_60", "days_61_90", "over_90", "overdue")],
        as_cents("total_outstanding").alias("total"),
    )


@check("unpaid_above", f"WITH {SQL_INVOICES} SELECT o_orderkey, owed FROM invoices WHERE owed > 5000000")
def _(spark, sf_dir):
    rows = reports.unpaid_above(invoices(spark, sf_dir), 50000)
    return rows.select("o_orderkey", as_cents("outstanding").alias("owed"))


@check(
    "average_collection_period",
    f"WITH {SQL_INVOICES} SELECT party, avg(days) AS avg_days, count(*) AS paid_invoices FROM invoices WHERE days IS NOT NULL GROUP BY 1",
)
def _(spark, sf_dir):
    return reports.average_collection_period(invoices(spark, sf_dir), ["party"])


# --- payroll, assets, sales tax -------------------------------------------------------------------------


@check(
    "payroll_by_department",
    """WITH c AS (SELECT CAST(o_custkey % 9 AS VARCHAR) AS department, strftime(o_orderdate, '%Y-%m') AS ym, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders),
    m AS (SELECT department, ym, CAST(sum(c) AS BIGINT) AS payroll FROM c GROUP BY ALL), r AS (SELECT ym, CAST(sum(c) AS BIGINT) * 2 AS revenue FROM c GROUP BY 1)
    SELECT department, ym AS year_month, payroll, CAST(sum(payroll) OVER (PARTITION BY department, left(ym, 4) ORDER BY ym) AS BIGINT) AS year_to_date,
    round((CAST(payroll AS DOUBLE) / 100) * 100 / (CAST(revenue AS DOUBLE) / 100), 6) AS pct FROM m JOIN r USING (ym)""",
)
def _(spark, sf_dir):
    money = (cents(F.col("o_totalprice")).cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    paid = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 9).cast("string").alias("department"), F.to_date("o_orderdate").alias("pay_date"), money.alias("gross")
    )
    revenue = paid.groupBy(F.date_format("pay_date", "yyyy-MM").alias("year_month")).agg((F.sum("gross") * 2).alias("revenue"))
    rows = reports.payroll_by_department(paid, revenue)
    return rows.select(
        "department", "year_month", as_cents("payroll").alias("payroll"), as_cents("year_to_date").alias("year_to_date"),
        F.round("pct_of_revenue", 6).alias("pct"),
    )


def assets(spark, sf_dir):
    """One asset per part: bought in some month of 1995-2004, living 12 to 61 months."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("asset"), "p_type", F.add_months(F.lit("1995-01-15").cast("date"), (key % 120).cast("int")).alias("purchase_date"),
        (cents(F.col("p_retailprice")).cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("cost"),
        (key % 50 + 12).cast("int").alias("life_months"),
    )


SQL_ASSETS = """assets AS (SELECT p_partkey AS asset, p_type, CAST(round(p_retailprice * 100) AS BIGINT) AS cents, p_partkey % 50 + 12 AS life,
  least(greatest(83 - p_partkey % 120, 0), p_partkey % 50 + 12) AS used FROM part),
schedule AS (SELECT *, CAST(round(CAST(cents AS DECIMAL(30, 10)) * 100 / life) AS BIGINT) AS monthly, used >= life AS done FROM assets)"""


@check(
    "asset_schedule",
    f"WITH {SQL_ASSETS} SELECT asset, CAST(used AS INTEGER) AS months_used, done AS fully_depreciated FROM schedule",
)
def _(spark, sf_dir):
    rows = reports.asset_schedule(assets(spark, sf_dir), F.lit(AS_OF).cast("date"))
    return rows.select("asset", "months_used", "fully_depreciated")


@check(
    "asset_summary",
    f"""WITH {SQL_ASSETS} SELECT p_type, count(*) FILTER (done) AS fully_depreciated, CAST(sum(CASE WHEN done THEN 0 ELSE CAST(round((cents * 100 - monthly * used) / 100.0) AS BIGINT) END) AS BIGINT) AS net_book_value
    FROM schedule GROUP BY 1""",
)
def _(spark, sf_dir):
    schedule = reports.asset_schedule(assets(spark, sf_dir), F.lit(AS_OF).cast("date"))
    return reports.asset_summary(schedule, ["p_type"]).select(
        "p_type", "fully_depreciated", as_cents("net_book_value").alias("net_book_value")
    )


@check(
    "sales_tax_return",
    """WITH l AS (SELECT strftime(l_shipdate, '%Y-%m') AS year_month, l_linenumber % 2 = 1 AS sale, CAST(round(l_extendedprice * 100) AS BIGINT) AS c, CAST(round(l_tax * 100) AS BIGINT) AS t FROM lineitem)
    SELECT year_month, CAST(sum(CASE WHEN sale THEN c ELSE 0 END) AS BIGINT) AS sales, CAST(sum(CASE WHEN sale THEN 0 ELSE c END) AS BIGINT) AS purchases,
    CAST(sum(CASE WHEN sale THEN c * t ELSE 0 END) AS BIGINT) AS tax_collected, CAST(sum(CASE WHEN sale THEN 0 ELSE c * t END) AS BIGINT) AS tax_paid,
    CAST(sum(CASE WHEN sale THEN c * t ELSE -c * t END) AS BIGINT) AS tax_payable FROM l GROUP BY 1""",
)
def _(spark, sf_dir):
    # Amounts in cents and tax in hundredths of a cent: whole numbers on both engines.
    c, t = cents(F.col("l_extendedprice")), F.round(F.col("l_tax") * 100).cast("bigint")
    entries = table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("transaction_date"),
        F.when(F.col("l_linenumber") % 2 == 1, "sales").otherwise("purchase").alias("tx_type"),
        c.alias("amount"), (c * t).alias("tax_amount"),
    )
    return reports.sales_tax_return(entries)
