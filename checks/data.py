"""Bookkeeping-shaped relations derived from the given tables, in Spark and in SQL side by side.

Every derived row comes from one table row by a column expression, so the work of a query grows with its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table

SYSTEMS = ["tally", "quickbooks_desktop", "ledgermax", "manual_excel", "bank_pdf_hbl", "unknown"]
AS_OF = "2001-12-31"


def sql_list(items) -> str:
    return "[" + ", ".join("'" + str(i).replace("'", "''") + "'" for i in items) + "]"


def sql_values(rows, names: str) -> str:
    """A VALUES relation of Python rows."""

    def literal(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).upper()
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) v({names}))"


def pick(items, index: Column) -> Column:
    """``items[index]``, 0-based."""
    return F.element_at(F.array(*[F.lit(i) for i in items]), (index + 1).cast("int"))


def cents(price: Column) -> Column:
    return F.round(price * 100).cast("bigint")


def grouped(amount: Column) -> Column:
    """1,234.56 from cents."""
    whole = F.format_number(F.floor(amount / 100), 0)
    return F.concat(whole, F.lit("."), F.lpad((amount % 100).cast("string"), 2, "0"))


def ungrouped(amount: Column) -> Column:
    """1234.56 from cents."""
    return F.concat(
        F.floor(amount / 100).cast("string"), F.lit("."), F.lpad((amount % 100).cast("string"), 2, "0")
    )


SQL_GROUPED = "format('{{:,}}', {0} // 100) || '.' || lpad(CAST({0} % 100 AS VARCHAR), 2, '0')"
SQL_UNGROUPED = "CAST({0} // 100 AS VARCHAR) || '.' || lpad(CAST({0} % 100 AS VARCHAR), 2, '0')"


def sql_grouped(column: str) -> str:
    return SQL_GROUPED.replace("{0}", column).replace("{{", "{").replace("}}", "}")


def sql_ungrouped(column: str) -> str:
    return SQL_UNGROUPED.replace("{0}", column)


# --- one ledger line per order, as text -----------------------------------------------------------------


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey, sys, cents, date_text, amount_text, vendor, memo."""
    o = table(spark, sf_dir, "orders")
    key, day, c = F.col("o_orderkey"), F.to_date("o_orderdate"), F.col("c")
    return (
        o.withColumn("c", cents(F.col("o_totalprice")))
        .select(
            key, "o_custkey", "o_orderpriority", (F.col("o_custkey") % 6).cast("int").alias("sys"),
            c.alias("cents"),
            day.alias("day"),
            F.when(key % 83 == 0, "soon")
            .when(key % 3 == 0, F.date_format(day, "yyyy-MM-dd"))
            .when(key % 3 == 1, F.date_format(day, "dd/MM/yyyy"))
            .otherwise(F.date_format(day, "d-M-yyyy")).alias("date_text"),
            F.when(key % 97 == 0, "N/A").when(key % 89 == 0, "abc")
            .when(key % 4 == 0, F.concat(F.lit("PKR "), grouped(c)))
            .when(key % 4 == 1, F.concat(F.lit("Rs. "), ungrouped(c)))
            .when(key % 4 == 2, grouped(c))
            .otherwise(ungrouped(c)).alias("amount_text"),
            F.when(F.col("o_custkey") % 10 == 0, "Shell Clifton")
            .otherwise(F.concat(F.lit("Customer C"), F.col("o_custkey").cast("string"))).alias("vendor"),
            F.concat("o_orderpriority", F.lit(" order K"), key.cast("string")).alias("memo"),
        )
    )


SQL_ORDER_TEXTS = f"""
order_texts AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_custkey % 6 AS INTEGER) AS sys, cents, day,
    CASE WHEN o_orderkey % 83 = 0 THEN 'soon'
         WHEN o_orderkey % 3 = 0 THEN strftime(day, '%Y-%m-%d')
         WHEN o_orderkey % 3 = 1 THEN strftime(day, '%d/%m/%Y')
         ELSE strftime(day, '%-d-%-m-%Y') END AS date_text,
    CASE WHEN o_orderkey % 97 = 0 THEN 'N/A' WHEN o_orderkey % 89 = 0 THEN 'abc'
         WHEN o_orderkey % 4 = 0 THEN 'PKR ' || {sql_grouped('cents')}
         WHEN o_orderkey % 4 = 1 THEN 'Rs. ' || {sql_ungrouped('cents')}
         WHEN o_orderkey % 4 = 2 THEN {sql_grouped('cents')}
         ELSE {sql_ungrouped('cents')} END AS amount_text,
    CASE WHEN o_custkey % 10 = 0 THEN 'Shell Clifton' ELSE 'Customer C' || o_custkey END AS vendor,
    o_orderpriority || ' order K' || o_orderkey AS memo,
    CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 THEN NULL ELSE cents / 100.0 END AS amount,
    CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE day END AS good_day
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CAST(o_orderdate AS DATE) AS day FROM orders)
)"""

HEADERS = {
    "tally": ["Date", "Particulars", "Vch Type", "Debit", "Credit"],
    "quickbooks_desktop": ["Date", "Name", "Memo", "Amount", "Type"],
    "ledgermax": ["Transaction Date", "Party Name", "Narration", "Dr Amount", "Cr Amount"],
    "manual_excel": ["Taareekh", "Raqam", "Naam", "Tafseelat", "quality_score"],
    "bank_pdf_hbl": ["Value Date", "Particulars", "Withdrawal", "Deposit", "Branch Code"],
    "unknown": ["DATE", "Narrations", "Total-Amount", "Party Nam", "Zzyx"],
}


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-table-like rows: one per order, with the headers of its system. Files hold up to 1,000 orders."""
    o = order_texts(spark, sf_dir)
    key = F.col("o_orderkey")
    even = key % 2 == 0
    amount = F.col("amount_text")
    out, into = F.when(even, amount).otherwise(""), F.when(even, "").otherwise(amount)
    signed = F.when(even & ~amount.isin("N/A", "abc"), F.concat(F.lit("("), F.regexp_replace(amount, "^(PKR|Rs\\.) ", ""), F.lit(")"))).otherwise(amount)
    kind = F.when(even, "Cash Payment").otherwise("Rcpt")
    cells = {
        "tally": [F.col("date_text"), F.col("vendor"), kind, out, into],
        "quickbooks_desktop": [F.col("date_text"), F.col("vendor"), F.col("memo"), signed, kind],
        "ledgermax": [F.col("date_text"), F.col("vendor"), F.col("memo"), out, into],
        "manual_excel": [F.col("date_text"), signed, F.col("vendor"), F.col("memo"), F.lit("=1+1")],
        "bank_pdf_hbl": [F.col("date_text"), F.col("memo"), out, into, F.lit("0421")],
        "unknown": [F.col("date_text"), F.col("memo"), signed, F.col("vendor"), F.lit("<script>x")],
    }
    headers, raw = F.when(F.lit(False), F.array(F.lit(""))), F.when(F.lit(False), F.array(F.lit("")))
    for n, system in enumerate(SYSTEMS):
        headers = headers.when(F.col("sys") == n, F.array(*[F.lit(h) for h in HEADERS[system]]))
        raw = raw.when(F.col("sys") == n, F.array(*cells[system]))
    file = F.concat_ws("-", F.lit("file"), F.floor(key / 1000).cast("string"), F.col("sys").cast("string"))
    return o.select(
        key, F.md5(key.cast("string")).alias("bronze_id"),
        file.alias("file_hash"), F.concat(F.lit("b-"), file).alias("batch_id"),
        pick(SYSTEMS, F.col("sys")).alias("source_software"), F.lit("csv").alias("source_type"),
        (key % 1000 + 1).cast("int").alias("source_row_number"),
        headers.alias("headers"), F.map_from_arrays(headers, raw).alias("raw"),
        F.lit(1024).cast("bigint").alias("file_size_bytes"),
    )


# What mapping must make of ``raw_rows``.
SQL_MAPPED = f"""
{SQL_ORDER_TEXTS},
mapped AS (
  SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS bronze_id, {sql_list(SYSTEMS)}[sys + 1] AS source_software,
    'file-' || (o_orderkey // 1000) || '-' || sys AS file_hash, CAST(o_orderkey % 1000 + 1 AS INTEGER) AS source_row_number,
    date_text AS transaction_date,
    CASE WHEN sys IN (0, 2, 4) AND o_orderkey % 2 = 0 THEN amount END AS amount_debit,
    CASE WHEN sys IN (0, 2, 4) AND o_orderkey % 2 = 1 THEN amount END AS amount_credit,
    CASE WHEN sys IN (1, 3, 5) THEN CASE WHEN o_orderkey % 2 = 0 THEN -amount ELSE amount END END AS net_amount,
    CASE WHEN sys <> 4 THEN vendor END AS vendor,
    CASE WHEN sys <> 0 THEN memo END AS description,
    CASE WHEN sys IN (0, 1) THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Cash Payment' ELSE 'Rcpt' END END AS tx_type,
    sys, amount, good_day, vendor AS party, memo, cents
  FROM order_texts
)"""


# --- clean rows straight from lineitem ------------------------------------------------------------------


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean-layer rows, one per line item; the id is made of the columns that tell line items apart."""
    li = table(spark, sf_dir, "lineitem")
    money = (cents(F.col("l_extendedprice")).cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    zero = F.lit(0).cast("decimal(18,2)")
    out = F.col("l_linenumber") % 2 == 1
    ident = F.concat_ws(
        "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int"),
        cents(F.col("l_extendedprice")),
    )
    words = ["Shell petrol", "PTCL internet", "Office rent", "Legal advisory", "Misc items", "Sui gas bill", "Freight cargo"]
    kinds = ["Payment", "Rcpt", "JV", "Sale", "Bill", "TRF", "Wages", "Contra", ""]
    day = F.to_date("l_shipdate")
    return li.select(
        ident.alias("silver_id"), F.concat(F.lit("b-"), ident).alias("bronze_id"),
        pick(SYSTEMS, F.col("l_suppkey") % 6).alias("source_software"), F.lit("csv").alias("source_type"),
        day.alias("transaction_date"), F.date_format(day, "yyyy-MM").alias("year_month"),
        F.when(out, money).otherwise(zero).cast("decimal(18,2)").alias("amount_debit"),
        F.when(out, zero).otherwise(money).cast("decimal(18,2)").alias("amount_credit"),
        F.when(out, -money).otherwise(money).cast("decimal(18,2)").alias("net_amount"),
        F.lit("PKR").alias("currency"),
        F.concat(F.lit("Trader "), F.col("l_suppkey").cast("string")).alias("vendor_raw"),
        pick(words, F.col("l_partkey") % 7).alias("description_raw"),
        F.concat((F.col("l_partkey") % 8).cast("string"), F.lit("010")).alias("account_code"),
        pick(kinds, F.col("l_orderkey") % 9).alias("tx_type"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    )


SQL_CLEAN = f"""
clean_lines AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER), cents) AS silver_id,
    'b-' || concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER), cents) AS bronze_id,
    {sql_list(SYSTEMS)}[l_suppkey % 6 + 1] AS source_software,
    CAST(l_shipdate AS DATE) AS transaction_date, strftime(l_shipdate, '%Y-%m') AS year_month,
    CASE WHEN l_linenumber % 2 = 1 THEN cents ELSE 0 END AS debit_cents,
    CASE WHEN l_linenumber % 2 = 1 THEN 0 ELSE cents END AS credit_cents,
    CASE WHEN l_linenumber % 2 = 1 THEN -cents ELSE cents END AS net_cents,
    'Trader ' || l_suppkey AS vendor_raw,
    ['Shell petrol', 'PTCL internet', 'Office rent', 'Legal advisory', 'Misc items', 'Sui gas bill', 'Freight cargo'][l_partkey % 7 + 1] AS description_raw,
    (l_partkey % 8) || '010' AS account_code,
    ['Payment', 'Rcpt', 'JV', 'Sale', 'Bill', 'TRF', 'Wages', 'Contra', ''][l_orderkey % 9 + 1] AS tx_type,
    l_orderkey, l_partkey, l_suppkey, l_linenumber
  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
)"""


def as_cents(amount) -> Column:
    """Money as whole cents, which both engines print alike."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return (amount * 100).cast("bigint")
