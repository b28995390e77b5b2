"""Contracts, clean layer, curated layer and period summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from bookflow import contracts as ct
from bookflow.functions import ledger as lx
from bookflow.operators import clean, curate
from bookflow.options import Options
from bookflow.plans.refine import map_batch, refine
from bookflow.plans.session import materialize
from checks.data import (
    SQL_CLEAN, SQL_MAPPED, as_cents, clean_lines, pick, raw_rows,
)
from checks.registry import check, table

# Thresholds so low that the test tables reach the paths for hot keys and for relations too large to broadcast.
TIGHT = Options(hot_key_rows=50, broadcast_rows=10)

# --- contracts ------------------------------------------------------------------------------------------

TYPES = ["xlsx", "csv", "pdf", "api_xero", "docx", "json"]
SOFTWARE = ["manual_excel", "tally", "peachtree", "xero", "unknown"]


def order_records(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("r"), F.floor(key / 2).cast("string")).alias("bronze_id"),
        pick(TYPES, key % 6).alias("source_type"), pick(SOFTWARE, key % 5).alias("source_software"),
        F.when(key % 11 == 0, F.lit(None)).otherwise(F.to_json(F.struct("o_orderpriority"))).alias("raw_content"),
        F.when(key % 7 == 0, "lost").otherwise("pending").alias("processing_status"),
        key.alias("source_row_number"),
    )


SQL_RECORDS = f"""r AS (SELECT 'r' || (o_orderkey // 2) AS bronze_id, o_orderkey AS n, o_orderkey % 11 = 0 AS no_content,
  o_orderkey % 6 = 4 AS bad_type, o_orderkey % 5 = 2 AS bad_software, o_orderkey % 7 = 0 AS bad_status FROM orders),
s AS (SELECT *, no_content OR bad_type OR bad_software OR bad_status AS bad FROM r),
u AS (SELECT *, NOT bad AND n > min(CASE WHEN NOT bad THEN n END) OVER (PARTITION BY bronze_id) AS late FROM s),
judged AS (SELECT bronze_id, n, array_to_string(list_filter([CASE WHEN no_content THEN 'raw_content is null' END, CASE WHEN bad_type THEN 'source_type is not allowed' END,
  CASE WHEN bad_software THEN 'source_software is not allowed' END, CASE WHEN bad_status THEN 'processing_status is not allowed' END,
  CASE WHEN late THEN 'bronze_id is not unique' END], lambda x: x IS NOT NULL), '|') AS reasons FROM u)"""


def judged_records(spark, sf_dir, options):
    return ct.validate(
        order_records(spark, sf_dir), ct.CONTRACTS["bronze_transactions"], ["source_row_number"], options=options
    )


@check("validate_accepted", f"WITH {SQL_RECORDS} SELECT bronze_id, n AS source_row_number FROM judged WHERE reasons = ''")
def _(spark, sf_dir):
    return judged_records(spark, sf_dir, Options())[0].select("bronze_id", "source_row_number")


@check("validate_rejected", f"WITH {SQL_RECORDS} SELECT bronze_id, n AS source_row_number, reasons FROM judged WHERE reasons <> ''")
def _(spark, sf_dir):
    return judged_records(spark, sf_dir, Options())[1].select(
        "bronze_id", "source_row_number", F.array_join("reasons", "|").alias("reasons")
    )


@check(
    "validate_unique_hot_key",
    """SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'Date' ELSE 'H' || o_orderkey END AS original_column, min(o_orderkey) AS times_seen FROM orders GROUP BY 1""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("m"), key.cast("string")).alias("mapping_id"), F.lit("tally").alias("source_software"),
        F.when(key % 3 == 0, "Date").otherwise(F.concat(F.lit("H"), key.cast("string"))).alias("original_column"),
        F.lit("vendor").alias("standard_field"), key.alias("times_seen"),
    )
    accepted, _ = ct.validate(rows, ct.CONTRACTS["bronze_schema_mappings"], ["times_seen"], options=TIGHT)
    return accepted.select("original_column", "times_seen")


@check(
    "validate_against_existing",
    """SELECT 'm' || o_orderkey AS mapping_id FROM orders WHERE o_custkey % 4 = 1""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("m"), key.cast("string")).alias("mapping_id"), F.lit("tally").alias("source_software"),
        F.concat(F.lit("H"), key.cast("string")).alias("original_column"), F.lit("vendor").alias("standard_field"),
        "o_custkey",
    )
    stored = rows.filter("o_custkey % 4 <> 1")
    accepted, _ = ct.validate(rows, ct.CONTRACTS["bronze_schema_mappings"], ["mapping_id"], stored)
    return accepted.select("mapping_id")


@check(
    "quality_gate",
    "SELECT o_orderkey, [true, false, true, true][o_orderkey % 4 + 1] AS passes FROM orders",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    scored = table(spark, sf_dir, "orders").select(
        key, F.when(key % 4 == 0, 0.85).when(key % 4 == 1, 0.5).when(key % 4 == 2, 0.7).cast("float").alias("quality_score"),
    )
    return scored.select("o_orderkey", ct.quality_gate().isNull().alias("passes"))


@check(
    "review_action_check",
    """SELECT o_orderkey, true AS legacy, [true, true, true, false, true][o_orderkey % 5 + 1] AS strict FROM orders""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    action = pick(["approve", "reject", "edit", "burn"], key % 5 % 4)
    rows = table(spark, sf_dir, "orders").select(key, F.when(key % 5 != 4, action).alias("user_action"))
    return rows.select(
        key, ct.review_action_check().isNull().alias("legacy"),
        ct.review_action_check(strict_review=True).isNull().alias("strict"),
    )


@check(
    "apply_defaults",
    """SELECT 's' || o_orderkey AS silver_id, CASE WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE 'PKR' END AS currency, 0 AS debit, 'en' AS language_detected,
    false AS is_duplicate, CAST(1.0 AS DOUBLE) AS confidence, (o_orderkey % 100) * 100 AS net FROM orders""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    contract = ct.CONTRACTS["silver_transactions"]
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("s"), key.cast("string")).alias("silver_id"), F.when(key % 2 == 0, "USD").alias("currency"),
        (key % 100).cast("decimal(18,2)").alias("amount_credit"),
    )
    filled = ct.with_computed(ct.apply_defaults(rows, contract), contract)
    return filled.select(
        "silver_id", "currency", as_cents("amount_debit").cast("int").alias("debit"), "language_detected", "is_duplicate",
        F.col("normalisation_confidence").cast("double").alias("confidence"), as_cents("net_amount").alias("net"),
    )


# --- clean layer ----------------------------------------------------------------------------------------


def standardized(spark, sf_dir):
    return clean.standardize(map_batch(raw_rows(spark, sf_dir)).rows)


SQL_STANDARD = f"""{SQL_MAPPED},
standard AS (SELECT *, CASE WHEN good_day IS NULL THEN 'date_parse_failed' WHEN amount IS NULL AND o_orderkey % 97 <> 0 THEN 'amount_parse_failed'
    WHEN amount IS NULL THEN 'missing_required_field' END AS reason,
  CASE WHEN amount IS NULL THEN NULL WHEN sys IN (0, 2, 4) THEN 'single_column' ELSE 'net' END AS amount_method,
  CASE WHEN amount IS NOT NULL THEN CASE WHEN o_orderkey % 2 = 0 THEN cents ELSE 0 END END AS debit,
  CASE WHEN amount IS NOT NULL THEN CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE cents END END AS credit FROM mapped)"""


@check(
    "standardize",
    f"""WITH {SQL_STANDARD} SELECT bronze_id, strftime(good_day, '%Y-%m-%d') AS day, strftime(good_day, '%Y-%m') AS year_month, debit, credit, 'PKR' AS currency,
    CASE WHEN good_day IS NOT NULL THEN ['iso', 'd/M/y', 'd-M-y'][o_orderkey % 3 + 1] END AS date_parse_method, amount_method AS amount_parse_method,
    'en' AS language_detected, CASE WHEN sys IN (0, 1) THEN CASE WHEN o_orderkey % 2 = 0 THEN 'payment' ELSE 'receipt' END END AS tx_type,
    reason AS quarantine_reason, CAST(round(CASE WHEN good_day IS NULL THEN 0 ELSE 30 END + CASE WHEN amount IS NULL THEN 0 ELSE 30 END + [20, 30, 25, 25, 10, 25][sys + 1]) AS INTEGER) AS score FROM standard""",
)
def _(spark, sf_dir):
    return standardized(spark, sf_dir).select(
        "bronze_id", F.date_format("transaction_date", "yyyy-MM-dd").alias("day"), "year_month",
        as_cents("amount_debit").alias("debit"), as_cents("amount_credit").alias("credit"), "currency",
        "date_parse_method", "amount_parse_method", "language_detected", "tx_type", "quarantine_reason",
        F.round(F.col("quality_score") * 100).cast("int").alias("score"),
    )


@check(
    "quarantine",
    f"""WITH {SQL_STANDARD} SELECT bronze_id, reason AS quarantine_reason, source_software, 'csv-' || file_hash AS source_file, false AS reviewed_by_user
    FROM standard WHERE reason IS NOT NULL""",
)
def _(spark, sf_dir):
    raw = raw_rows(spark, sf_dir).select(
        "bronze_id", F.to_json("raw").alias("raw_content"), F.concat(F.lit("csv-"), "file_hash").alias("source_file")
    )
    _, bad = clean.quarantine(standardized(spark, sf_dir), raw)
    return bad.select("bronze_id", "quarantine_reason", "source_software", "source_file", "reviewed_by_user")


@check(
    "advance_status",
    f"""WITH {SQL_STANDARD} SELECT processing_status, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'pending' WHEN reason IS NULL THEN 'normalised'
    ELSE 'quarantined' END AS processing_status FROM standard) GROUP BY 1""",
)
def _(spark, sf_dir):
    raw = raw_rows(spark, sf_dir)
    # Written down once, as in ``refine``: each of the two parts would else map and standardise all rows again.
    standard = materialize(clean.standardize(map_batch(raw.filter("o_orderkey % 10 <> 0")).rows))
    sound, bad = clean.quarantine(standard)
    all_raw = raw.select("bronze_id", F.lit("pending").alias("processing_status"))
    return clean.advance_status(all_raw, sound, bad).groupBy("processing_status").agg(F.count("*").alias("n"))


@check(
    "review_quarantine",
    """SELECT 'q' || o_orderkey AS id, ['approve', 'reject', 'edit', NULL][o_orderkey % 4 + 1] AS user_action, o_orderkey % 4 <> 3 AS reviewed_by_user,
    CASE o_orderkey % 4 WHEN 0 THEN o_orderpriority WHEN 2 THEN 'new' END AS released FROM orders""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    held = orders.select(
        F.concat(F.lit("q"), key.cast("string")).alias("quarantine_id"), F.concat(F.lit("q"), key.cast("string")).alias("bronze_id"),
        F.lit("tally").alias("source_software"), F.col("o_orderpriority").alias("raw_content"),
    )
    decisions = orders.filter(key % 4 != 3).select(
        F.concat(F.lit("q"), key.cast("string")).alias("quarantine_id"), pick(["approve", "reject", "edit"], key % 4).alias("user_action"),
        F.lit("2024-01-01").cast("timestamp").alias("reviewed_at"), F.lit("new").alias("edited_content"),
    )
    reviewed, released = clean.review_quarantine(held, decisions)
    return reviewed.select(F.col("quarantine_id").alias("id"), "user_action", "reviewed_by_user").join(
        released.select(F.col("bronze_id").alias("id"), F.col("raw_content").alias("released")), "id", "left"
    )


def repeated_lines(spark, sf_dir, hot: bool = False):
    """Clean rows with repeats: the amount is the quantity; with ``hot`` a third of all rows are one transaction."""
    lines = clean_lines(spark, sf_dir)
    qty = F.split("silver_id", "-")[4].cast("decimal(18,2)")
    same = (F.col("l_partkey") % 3 == 0) & F.lit(hot)
    return lines.withColumns({
        "net_amount": F.when(same, F.lit(1)).otherwise(qty).cast("decimal(18,2)"),
        "transaction_date": F.when(same, F.lit("2000-01-01").cast("date")).otherwise(F.col("transaction_date")),
        "vendor_raw": F.when(same, "Shell").when(F.col("l_suppkey") % 9 == 0, F.lit(None)).otherwise(F.col("vendor_raw")),
    })


def sql_repeated(hot: bool) -> str:
    same = "(l_partkey % 3 = 0)" if hot else "false"
    return f"""{SQL_CLEAN}, r AS (SELECT silver_id, bronze_id, description_raw, CASE WHEN {same} THEN 1 ELSE CAST(split_part(silver_id, '-', 5) AS BIGINT) END AS net,
      CASE WHEN {same} THEN DATE '2000-01-01' ELSE transaction_date END AS day,
      CASE WHEN {same} THEN 'Shell' WHEN l_suppkey % 9 = 0 THEN NULL ELSE vendor_raw END AS vendor FROM clean_lines),
    f AS (SELECT *, min(silver_id) OVER w AS first_id, arg_min(description_raw, silver_id) OVER w AS first_text FROM r WINDOW w AS (PARTITION BY day, net, vendor)),
    marked AS (SELECT silver_id, bronze_id, vendor IS NOT NULL AND silver_id <> first_id AS is_duplicate, CASE WHEN vendor IS NOT NULL AND silver_id <> first_id THEN first_id END AS duplicate_of,
      CASE WHEN vendor IS NOT NULL AND silver_id <> first_id THEN CASE WHEN description_raw = first_text THEN 95 ELSE 80 END END AS confidence FROM f)"""


def marked_columns(marked):
    return marked.select(
        "silver_id", "is_duplicate", "duplicate_of", F.round(F.col("dedup_confidence") * 100).cast("int").cast("string").alias("confidence")
    )


SQL_MARKED = "SELECT silver_id, is_duplicate, duplicate_of, CAST(confidence AS VARCHAR) AS confidence FROM marked"


@check("mark_duplicates", f"WITH {sql_repeated(False)} {SQL_MARKED}")
def _(spark, sf_dir):
    return marked_columns(clean.mark_duplicates(repeated_lines(spark, sf_dir)))


@check("mark_duplicates_hot_group", f"WITH {sql_repeated(True)} {SQL_MARKED}")
def _(spark, sf_dir):
    return marked_columns(clean.mark_duplicates(repeated_lines(spark, sf_dir, hot=True), TIGHT))


@check(
    "duplicate_survivors",
    f"WITH {sql_repeated(False)} SELECT silver_id, bronze_id, duplicate_of, 'b-' || duplicate_of AS survivor_bronze_id FROM marked WHERE is_duplicate",
)
def _(spark, sf_dir):
    return clean.survivors(clean.mark_duplicates(repeated_lines(spark, sf_dir)))


@check(
    "flag_amount_spikes",
    f"""WITH {SQL_CLEAN}, a AS (SELECT silver_id, vendor_raw, abs(net_cents) / 100.0 * CASE WHEN l_partkey % 997 = 0 THEN 100000 ELSE 1 END AS size FROM clean_lines)
    SELECT silver_id, size > 1.5 * avg(size) OVER (PARTITION BY vendor_raw) AS amount_spike FROM a""",
)
def _(spark, sf_dir):
    size = F.when(F.col("l_partkey") % 997 == 0, F.col("net_amount") * 100000).otherwise(F.col("net_amount"))
    rows = clean_lines(spark, sf_dir).withColumn("net_amount", size.cast("double"))
    flagged = clean.flag_amount_spikes(rows, ["vendor_raw"], Options(amount_spike_ratio=1.5))
    return flagged.select("silver_id", "amount_spike")


@check(
    "flag_future_dates",
    f"WITH {SQL_CLEAN} SELECT silver_id, transaction_date > DATE '2000-01-01' + INTERVAL 30 DAY AS future_date FROM clean_lines",
)
def _(spark, sf_dir):
    rows = clean.flag_future_dates(clean_lines(spark, sf_dir), F.lit("2000-01-01").cast("date"))
    return rows.select("silver_id", "future_date")


# --- curated layer --------------------------------------------------------------------------------------


def silver_lines(spark, sf_dir):
    day = F.col("transaction_date")
    return clean_lines(spark, sf_dir).withColumns({
        "fiscal_year": lx.fiscal_year(day), "is_duplicate": F.lit(False), "quality_score": F.lit(0.9).cast("float"),
        "language_detected": F.lit("en"),
    })


def gold_lines(spark, sf_dir):
    return curate.curate(silver_lines(spark, sf_dir))


SQL_GOLD = f"""{SQL_CLEAN},
kinds AS (SELECT *, CASE WHEN tx_type = '' THEN 'unknown' ELSE ['payment', 'receipt', 'journal', 'sales', 'purchase', 'transfer', 'payroll', 'contra'][l_orderkey % 9 + 1] END AS kind,
  l_partkey % 7 AS w, l_partkey % 8 AS d FROM clean_lines),
gold AS (SELECT *,
  CASE WHEN w IN (0, 6) THEN 'Fuel & Transport' WHEN w IN (1, 5) THEN 'Utilities' WHEN w = 2 THEN 'Rent' WHEN w = 3 THEN 'Services'
    WHEN d BETWEEN 1 AND 6 THEN ['Assets', 'Liabilities', 'Equity', 'Revenue', 'Expenses', 'Expenses'][d]
    ELSE CASE kind WHEN 'sales' THEN 'Sales' WHEN 'purchase' THEN 'Inventory' WHEN 'payroll' THEN 'Payroll' WHEN 'transfer' THEN 'Transfers'
      WHEN 'receipt' THEN 'Receipts' WHEN 'payment' THEN 'Payments' WHEN 'journal' THEN 'Adjustments' WHEN 'contra' THEN 'Transfers' END END AS category,
  CASE w WHEN 0 THEN 'Petrol' WHEN 6 THEN 'Freight' WHEN 1 THEN 'Telephone' WHEN 5 THEN 'Gas' WHEN 2 THEN 'Rent' WHEN 3 THEN 'Consulting' END AS subcategory,
  CASE WHEN w <> 4 THEN 'rule_based' WHEN d BETWEEN 1 AND 6 THEN 'account_code_map' WHEN kind <> 'unknown' THEN 'tx_type_map' END AS category_method,
  CASE WHEN w = 0 THEN 'fuel' WHEN w = 6 THEN 'freight' WHEN w = 1 THEN 'telephone' WHEN w = 5 THEN 'gas' WHEN w = 2 THEN 'rent' WHEN w = 3 THEN 'consulting'
    WHEN d BETWEEN 1 AND 6 THEN NULL WHEN kind = 'purchase' THEN 'purchases' WHEN kind = 'payroll' THEN 'salary' END AS fbr_category FROM kinds)"""


@check(
    "categorize",
    f"""WITH {SQL_GOLD} SELECT silver_id, category, subcategory, category_method, CAST(CASE category_method WHEN 'rule_based' THEN 90 WHEN 'account_code_map' THEN 80 WHEN 'tx_type_map' THEN 70 END AS VARCHAR) AS confidence FROM gold""",
)
def _(spark, sf_dir):
    return gold_lines(spark, sf_dir).select(
        "silver_id", "category", "subcategory", "category_method",
        F.round(F.col("category_confidence") * 100).cast("int").cast("string").alias("confidence"),
    )


@check(
    "tax_enrich",
    f"""WITH {SQL_GOLD} SELECT silver_id, fbr_category, coalesce(fbr_category IN ('freight', 'rent', 'consulting', 'purchases', 'salary'), false) AS fbr_tax_applicable,
    CAST(CASE fbr_category WHEN 'freight' THEN 2 WHEN 'rent' THEN 15 WHEN 'consulting' THEN 8 WHEN 'purchases' THEN 4 END AS VARCHAR) AS rate FROM gold""",
)
def _(spark, sf_dir):
    return gold_lines(spark, sf_dir).select(
        "silver_id", "fbr_category", "fbr_tax_applicable",
        F.round(F.col("withholding_tax_rate") * 100).cast("int").cast("string").alias("rate"),
    )


@check(
    "double_entry",
    f"""WITH {SQL_GOLD} SELECT silver_id, CASE WHEN net_cents < 0 THEN coalesce(category, 'Suspense') ELSE 'Cash' END AS debit_account,
    CASE WHEN net_cents < 0 THEN 'Cash' ELSE coalesce(category, 'Suspense') END AS credit_account FROM gold""",
)
def _(spark, sf_dir):
    return gold_lines(spark, sf_dir).select("silver_id", "debit_account", "credit_account")


@check(
    "narrative_text",
    f"""WITH {SQL_GOLD} SELECT silver_id, 'On ' || strftime(transaction_date, '%-d %B %Y') || ', PKR ' || format('{{:,}}', abs(net_cents) // 100) ||
    CASE WHEN net_cents % 100 = 0 THEN '' ELSE '.' || lpad(CAST(abs(net_cents) % 100 AS VARCHAR), 2, '0') END ||
    CASE WHEN net_cents < 0 THEN ' was paid to ' ELSE ' was received from ' END || vendor_raw || ' — ' || coalesce(category, 'Uncategorised') AS embedding_text FROM gold""",
)
def _(spark, sf_dir):
    return gold_lines(spark, sf_dir).select("silver_id", "embedding_text")


@check(
    "bump_version",
    f"""WITH {SQL_CLEAN} SELECT silver_id, CASE WHEN l_partkey % 2 = 0 THEN 4 ELSE 1 END AS gold_version FROM clean_lines""",
)
def _(spark, sf_dir):
    lines = silver_lines(spark, sf_dir)
    before = lines.filter("l_partkey % 2 = 0").select("silver_id", F.lit(3).alias("gold_version"))
    return curate.curate(lines, before).select("silver_id", "gold_version")


@check(
    "lineage",
    f"""WITH {SQL_CLEAN} SELECT silver_id, bronze_id, 'f' || l_suppkey AS source_file, l_linenumber AS source_row_number FROM clean_lines""",
)
def _(spark, sf_dir):
    lines = clean_lines(spark, sf_dir)
    raw = lines.select("bronze_id", F.concat(F.lit("f"), F.col("l_suppkey").cast("string")).alias("source_file"), F.col("l_linenumber").alias("source_row_number"))
    return curate.lineage(gold_lines(spark, sf_dir), lines, raw).drop("transaction_id")


@check(
    "pending_index_scan",
    f"WITH {SQL_CLEAN} SELECT silver_id FROM clean_lines WHERE l_partkey % 4 <> 0",
)
def _(spark, sf_dir):
    lines = clean_lines(spark, sf_dir).withColumn("qdrant_indexed", F.col("l_partkey") % 4 == 0)
    return curate.pending_index_scan(lines).select("silver_id")


# --- period summaries -----------------------------------------------------------------------------------

SQL_PERIODS = f"""{SQL_GOLD},
spread AS (SELECT 'daily' AS period_type, strftime(transaction_date, '%Y-%m-%d') AS period_key, * FROM gold
  UNION ALL SELECT 'weekly', strftime(transaction_date, '%G-W%V'), * FROM gold
  UNION ALL SELECT 'monthly', strftime(transaction_date, '%Y-%m'), * FROM gold),
totals AS (SELECT period_type, period_key, CAST(sum(debit_cents) AS BIGINT) AS debits, CAST(sum(credit_cents) AS BIGINT) AS credits, CAST(sum(net_cents) AS BIGINT) AS net,
  CAST(count(*) AS INTEGER) AS n, min(transaction_date) AS first_day FROM spread GROUP BY ALL),
starts AS (SELECT *, CASE period_type WHEN 'daily' THEN first_day WHEN 'weekly' THEN date_trunc('week', first_day) ELSE date_trunc('month', first_day) END::DATE AS day FROM totals),
prior AS (SELECT t.*, b.net AS before FROM starts t LEFT JOIN starts b ON b.period_type = t.period_type
  AND b.day = CAST(t.day - CASE t.period_type WHEN 'daily' THEN INTERVAL 1 DAY WHEN 'weekly' THEN INTERVAL 7 DAY ELSE INTERVAL 1 MONTH END AS DATE)),
moved AS (SELECT *, CASE WHEN before <> 0 THEN round((CAST(net AS DOUBLE) / 100 - CAST(before AS DOUBLE) / 100) / abs(CAST(before AS DOUBLE) / 100) * 100, 2) END AS pct FROM prior)"""


@check(
    "period_totals",
    f"""WITH {SQL_PERIODS} SELECT period_type, period_key, CASE WHEN month(first_day) >= 7 THEN year(first_day) || '-' || (year(first_day) + 1)
    ELSE (year(first_day) - 1) || '-' || year(first_day) END AS fiscal_year, debits, credits, net, n FROM totals""",
)
def _(spark, sf_dir):
    totals = curate.period_totals(gold_lines(spark, sf_dir))
    return totals.select(
        "period_type", "period_key", "fiscal_year", as_cents("total_debits").alias("debits"),
        as_cents("total_credits").alias("credits"), as_cents("net_cashflow").alias("net"),
        F.col("transaction_count").alias("n"),
    )


@check(
    "vs_prior_period",
    f"WITH {SQL_PERIODS} SELECT period_type, period_key, CAST(CAST(pct AS FLOAT) AS DOUBLE) + 0.0 AS pct FROM moved",
)
def _(spark, sf_dir):
    totals = curate.vs_prior_period(curate.period_totals(gold_lines(spark, sf_dir)))
    return totals.select("period_type", "period_key", F.col("vs_prior_period_pct").cast("double").alias("pct"))


@check(
    "anomaly_flag",
    f"WITH {SQL_PERIODS} SELECT period_type, period_key, coalesce(abs(CAST(pct AS FLOAT)) >= 200, false) AS anomaly_flag, CASE WHEN abs(CAST(pct AS FLOAT)) >= 200 THEN 'Net cashflow moved by ' || format('{{:,.2f}}', CAST(CAST(pct AS FLOAT) AS DOUBLE)) || '% against the prior period' END AS reason FROM moved",
)
def _(spark, sf_dir):
    totals = curate.anomaly_flag(curate.vs_prior_period(curate.period_totals(gold_lines(spark, sf_dir))))
    return totals.select(
        "period_type", "period_key", "anomaly_flag", F.col("anomaly_reason").alias("reason")
    )


SQL_MONEY = "CAST({0} // 100 AS VARCHAR) || '.' || lpad(CAST({0} % 100 AS VARCHAR), 2, '0')"


@check(
    "category_breakdown",
    f"""WITH {SQL_PERIODS}, c AS (SELECT period_type, period_key, coalesce(category, 'Uncategorised') AS category, CAST(sum(debit_cents + credit_cents) AS BIGINT) AS a FROM spread GROUP BY ALL)
    SELECT period_type, period_key, '{{' || string_agg('"' || category || '":' || {SQL_MONEY.format('a')}, ',' ORDER BY category) || '}}' AS category_breakdown FROM c GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    return curate.category_breakdown(gold_lines(spark, sf_dir))


SQL_VENDORS = f"""{SQL_PERIODS}, v AS (SELECT period_type, period_key, 'trader_' || l_suppkey AS vendor, CAST(sum(debit_cents + credit_cents) AS BIGINT) AS a FROM spread GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY period_type, period_key ORDER BY a DESC, vendor) AS rank FROM v)"""


@check("ranked_vendors", f"WITH {SQL_VENDORS} SELECT period_type, period_key, vendor, a AS amount, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 5")
def _(spark, sf_dir):
    return curate.ranked_vendors(gold_lines(spark, sf_dir)).withColumn("amount", as_cents("amount"))


@check(
    "top_vendors",
    f"""WITH {SQL_VENDORS} SELECT period_type, period_key, '[' || string_agg('{{"vendor":"' || vendor || '","amount":' || {SQL_MONEY.format('a')} || '}}', ',' ORDER BY rank) || ']' AS top_vendors
    FROM ranked WHERE rank <= 5 GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    return curate.top_vendors(gold_lines(spark, sf_dir))


@check(
    "period_summary",
    f"""WITH {SQL_VENDORS}, b AS (SELECT period_type, period_key, '{{' || string_agg('"' || category || '":' || {SQL_MONEY.format('a')}, ',' ORDER BY category) || '}}' AS category_breakdown
      FROM (SELECT period_type, period_key, coalesce(category, 'Uncategorised') AS category, CAST(sum(debit_cents + credit_cents) AS BIGINT) AS a FROM spread GROUP BY ALL) GROUP BY 1, 2),
    top AS (SELECT period_type, period_key, '[' || string_agg('{{"vendor":"' || vendor || '","amount":' || {SQL_MONEY.format('a')} || '}}', ',' ORDER BY rank) || ']' AS top_vendors
      FROM ranked WHERE rank <= 5 GROUP BY 1, 2)
    SELECT m.period_type, m.period_key, category_breakdown, top_vendors, CAST(CAST(pct AS FLOAT) AS DOUBLE) + 0.0 AS pct,
    coalesce(abs(CAST(pct AS FLOAT)) >= 200, false) AS anomaly_flag, debits, credits, net, n, 'In ' || period_key || ', ' || n || ' transactions: PKR ' || format('{{:,}}', debits // 100) || '.' || lpad(CAST(debits % 100 AS VARCHAR), 2, '0') ||
    ' paid, PKR ' || format('{{:,}}', credits // 100) || '.' || lpad(CAST(credits % 100 AS VARCHAR), 2, '0') || ' received, net PKR ' ||
    CASE WHEN net < 0 THEN '-' ELSE '' END || format('{{:,}}', abs(net) // 100) || '.' || lpad(CAST(abs(net) % 100 AS VARCHAR), 2, '0') || '.' AS summary_text
    FROM moved m LEFT JOIN b USING (period_type, period_key) LEFT JOIN top USING (period_type, period_key)""",
)
def _(spark, sf_dir):
    return curate.period_summary(gold_lines(spark, sf_dir)).select(
        "period_type", "period_key", "category_breakdown", "top_vendors", F.col("vs_prior_period_pct").cast("double").alias("pct"),
        "anomaly_flag", as_cents("total_debits").alias("debits"), as_cents("total_credits").alias("credits"),
        as_cents("net_cashflow").alias("net"), F.col("transaction_count").alias("n"), "summary_text",
    )


# --- the whole way --------------------------------------------------------------------------------------

SQL_WHOLE = f"""{SQL_STANDARD},
sound AS (SELECT *, CASE WHEN sys = 4 THEN NULL ELSE party END AS v, credit - debit AS net, 
  md5(concat_ws(chr(31), 'silver', bronze_id)) AS sid FROM standard WHERE reason IS NULL),
once AS (SELECT *, v IS NOT NULL AND sid <> min(sid) OVER (PARTITION BY good_day, net, v) AS copy FROM sound)"""


@check(
    "ledger_to_period_summary",
    f"""WITH {SQL_WHOLE}, spread AS (SELECT 'daily' AS period_type, strftime(good_day, '%Y-%m-%d') AS period_key, * FROM once
    UNION ALL SELECT 'weekly', strftime(good_day, '%G-W%V'), * FROM once UNION ALL SELECT 'monthly', strftime(good_day, '%Y-%m'), * FROM once)
    SELECT period_type, period_key, CAST(sum(debit) AS BIGINT) AS debits, CAST(sum(credit) AS BIGINT) AS credits,
    CAST(count(*) AS INTEGER) AS n FROM spread WHERE NOT copy GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    totals = curate.period_totals(refine(raw_rows(spark, sf_dir)).gold)
    return totals.select(
        "period_type", "period_key", as_cents("total_debits").alias("debits"), as_cents("total_credits").alias("credits"),
        F.col("transaction_count").alias("n"),
    )
