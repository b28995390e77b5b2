"""Clean rows to curated transactions and period summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookflow.contracts import PERIOD_TYPES
from bookflow.dictionary import tax_heads
from bookflow.functions import ledger as lx
from bookflow.functions.keys import uuid_of
from bookflow.options import DEFAULTS, Options
from bookflow.plans.session import materialize


def tax_info(rows: DataFrame, category: str = "tax_category") -> DataFrame:
    """Adds fbr_section, wht_applicable, wht_rate_filer and tax_note by lower-cased category; a miss gives nulls."""
    heads = tax_heads(rows.sparkSession).withColumnRenamed("tax_category", "_head")
    return rows.join(F.broadcast(heads), F.lower(F.col(category)) == F.col("_head"), "left").drop("_head")


def tax_enrich(rows: DataFrame) -> DataFrame:
    """Adds fbr_category, fbr_tax_applicable and withholding_tax_rate from ``tax_category``."""
    return tax_info(rows).select(
        *[c for c in rows.columns if c != "tax_category"],
        F.when(F.col("tax_note").isNotNull(), F.col("tax_category")).alias("fbr_category"),
        F.coalesce("wht_applicable", F.lit(False)).alias("fbr_tax_applicable"),
        F.col("wht_rate_filer").cast("float").alias("withholding_tax_rate"),
    )


def curate(silver: DataFrame, prior: DataFrame | None = None, options: Options = DEFAULTS) -> DataFrame:
    """Curated transactions of clean rows that are no duplicates and pass the quality gate.

    Narrow but for the join with ``prior`` (silver_id, gold_version), which numbers reprocessed rows.
    """
    sound = silver.filter(
        ~F.col("is_duplicate") & (F.col("quality_score") >= F.lit(options.quality_gate).cast("float"))
    )
    rule = lx.category_rule(F.col("vendor_raw"), F.col("description_raw"), F.col("tx_type"), F.col("account_code"))
    verdict = sound.withColumn("_rule", rule).withColumn("_c", lx.categorize(F.col("_rule")))
    staged = tax_enrich(verdict.withColumn("tax_category", F.col("_c.tax_category")))
    category, net = F.col("_c.category"), F.col("net_amount")
    accounts = lx.double_entry(category, net)
    gold = staged.select(
        uuid_of(F.lit("gold"), "silver_id").alias("transaction_id"),
        "silver_id", "bronze_id", "source_software", "source_type", "transaction_date", "year_month", "fiscal_year",
        "amount_debit", "amount_credit", "net_amount", "currency", "vendor_raw",
        lx.normalize_vendor(F.col("vendor_raw")).alias("vendor_normalised"),
        lx.clean_description(F.col("description_raw")).alias("description_clean"),
        category.alias("category"),
        F.col("_c.subcategory").alias("subcategory"),
        F.col("_c.confidence").alias("category_confidence"),
        F.col("_c.method").alias("category_method"),
        "fbr_category", "fbr_tax_applicable", "withholding_tax_rate", "account_code", "tx_type",
        accounts["debit_account"].alias("debit_account"),
        accounts["credit_account"].alias("credit_account"),
        lx.narrative_text(F.col("transaction_date"), F.col("currency"), net, F.col("vendor_raw"), category)
        .alias("embedding_text"),
        "quality_score",
        F.lit(True).alias("pii_masked"),
        "language_detected",
        F.lit(False).alias("qdrant_indexed"),
    )
    return bump_version(gold, prior)


def bump_version(gold: DataFrame, prior: DataFrame | None) -> DataFrame:
    """Adds gold_version: 1 for new rows, one more than before for rows in ``prior`` (silver_id, gold_version)."""
    if prior is None:
        return gold.withColumn("gold_version", F.lit(1))
    last = prior.groupBy("silver_id").agg(F.max("gold_version").alias("_last"))
    return gold.join(last, "silver_id", "left").withColumn(
        "gold_version", F.coalesce(F.col("_last"), F.lit(0)) + 1
    ).drop("_last")


def lineage(gold: DataFrame, silver: DataFrame, raw: DataFrame) -> DataFrame:
    """Curated row, clean row, raw row and its place in the source file. Ids are unique, so no key is hot."""
    return (
        gold.select("transaction_id", "silver_id")
        .join(silver.select("silver_id", "bronze_id"), "silver_id")
        .join(raw.select("bronze_id", "source_file", "source_row_number"), "bronze_id")
    )


def pending_index_scan(curated: DataFrame) -> DataFrame:
    """Rows not indexed yet; the condition reaches the scan."""
    return curated.filter(~F.col("qdrant_indexed"))


def periods_of(day: Column) -> Column:
    """Array of (period_type, period_key) of a day."""
    return F.array(
        *[F.struct(F.lit(p).alias("period_type"), lx.period_key(day, p).alias("period_key")) for p in PERIOD_TYPES]
    )


def daily_totals(gold: DataFrame, by: list[str]) -> DataFrame:
    """Totals per day and ``by``. Every period is a set of days, so longer periods start from these few rows."""
    return gold.groupBy("transaction_date", *by).agg(
        F.sum("amount_debit").alias("debits"), F.sum("amount_credit").alias("credits"), F.count("*").alias("n")
    )


#: Of a row of ``_by_number``: the place of its period type in PERIOD_TYPES, and the period counted through.
NUMBERED = ["_kind", "_number"]


def _by_number(daily: DataFrame, by: list[str]) -> DataFrame:
    """Totals per period and ``by``. Periods are grouped by numbers, which are shorter and sooner made than their keys."""
    day = F.col("transaction_date")
    count = F.unix_date(day)
    numbers = {"daily": count, "weekly": F.floor((count + 3) / 7).cast("int"), "monthly": F.year(day) * 12 + F.month(day)}
    places = F.array(*[F.struct(F.lit(k).alias("_kind"), numbers[p].alias("_number")) for k, p in enumerate(PERIOD_TYPES)])
    return daily.withColumn("p", F.explode(places)).groupBy("p._kind", "p._number", *by).agg(
        F.sum("debits").cast(lx.MONEY).alias("total_debits"),
        F.sum("credits").cast(lx.MONEY).alias("total_credits"),
        F.sum("n").cast("int").alias("transaction_count"),
        F.min("transaction_date").alias("first_day"),
    )


def _with_keys(numbered: DataFrame) -> DataFrame:
    """Rows of ``_by_number`` with period_type and period_key instead of the numbers; any day of a period gives its key."""
    period = F.get(periods_of(F.col("first_day")), F.col("_kind"))
    named = numbered.withColumns({"period_type": period["period_type"], "period_key": period["period_key"]})
    return named.select("period_type", "period_key", *[c for c in numbered.columns if c not in NUMBERED])


def _by_period(daily: DataFrame, by: list[str]) -> DataFrame:
    return _with_keys(_by_number(daily, by))


def period_totals(gold: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Debits, credits, net and count by day, ISO week and month."""
    return _totals(daily_totals(gold, []), options)


def _totals(daily: DataFrame, options: Options) -> DataFrame:
    totals = _by_period(daily, [])
    return totals.select(
        "period_type", "period_key", lx.fiscal_year(F.col("first_day"), options).alias("fiscal_year"),
        "total_debits", "total_credits",
        (F.col("total_credits") - F.col("total_debits")).cast(lx.MONEY).alias("net_cashflow"), "transaction_count",
    )


def category_breakdown(gold: DataFrame) -> DataFrame:
    """(period_type, period_key, category_breakdown): JSON object of turnover per category.

    Categories come from the fixed rule tables, which bounds the list of a period.
    """
    return _breakdown(daily_totals(gold, ["category"]))


def _breakdown(daily: DataFrame) -> DataFrame:
    per = _by_period(daily.withColumn("category", F.coalesce("category", F.lit("Uncategorised"))), ["category"])
    entry = F.struct("category", (F.col("total_debits") + F.col("total_credits")).cast(lx.MONEY).alias("amount"))
    return per.groupBy("period_type", "period_key").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("category_breakdown")
    )


def ranked_vendors(gold: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` vendors with the largest turnover per period, with their rank.

    The rank limit is applied before the shuffle as well, so a period with very many vendors sends each task's
    best ``n`` only.
    """
    return _ranked(daily_totals(gold, ["vendor_normalised"]), n)


def _ranked(daily: DataFrame, n: int) -> DataFrame:
    per = _by_number(daily.filter(F.col("vendor_normalised").isNotNull()), ["vendor_normalised"])
    amount = (F.col("total_debits") + F.col("total_credits")).cast(lx.MONEY)
    order = Window.partitionBy(*NUMBERED).orderBy(F.desc("amount"), "vendor")
    ranked = (
        per.select(*NUMBERED, "first_day", F.col("vendor_normalised").alias("vendor"), amount.alias("amount"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
    )
    return _with_keys(ranked).drop("first_day")


def top_vendors(gold: DataFrame, n: int = 5) -> DataFrame:
    """(period_type, period_key, top_vendors): JSON array, largest first."""
    return _listed(ranked_vendors(gold, n))


def _listed(ranked: DataFrame) -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct("rank", "vendor", "amount")))
    slim = F.transform(listed, lambda e: F.struct(e["vendor"].alias("vendor"), e["amount"].alias("amount")))
    return ranked.groupBy("period_type", "period_key").agg(F.to_json(slim).alias("top_vendors"))


def period_number(kind: str = "period_type", key: str = "period_key") -> Column:
    """Days, ISO weeks or months counted through, so that neighbours in the calendar differ by one."""
    key = F.col(key)
    number = [F.regexp_extract(key, r"^(\d{4})-W?(\d{1,2})", n).cast("int") for n in (1, 2)]
    # The fourth of January lies in the first ISO week.
    monday = F.date_trunc("week", F.make_date(number[0], F.lit(1), F.lit(4))).cast("date")
    return (
        F.when(F.col(kind) == "daily", F.unix_date(key.try_cast("date")))
        .when(F.col(kind) == "weekly", F.floor((F.unix_date(monday) + 3) / 7).cast("int") + number[1] - 1)
        .otherwise(number[0] * 12 + number[1])
    )


def vs_prior_period(totals: DataFrame, measure: str = "net_cashflow", offset: int = 1) -> DataFrame:
    """Adds vs_prior_period_pct: change against the ``offset``-th calendar period before, in percent of its absolute value.

    Null when that period has no rows or is 0. The window holds one row per calendar period.
    """
    place = Window.partitionBy("period_type").orderBy(period_number()).rangeBetween(-offset, -offset)
    before = F.first(measure).over(place).cast("double")
    change = F.when(before != 0, (F.col(measure).cast("double") - before) / F.abs(before) * 100)
    return totals.withColumn("vs_prior_period_pct", F.round(change, 2).cast("float"))


def anomaly_flag(totals: DataFrame, threshold_pct: float = 200.0) -> DataFrame:
    """Adds anomaly_flag and anomaly_reason where the change against the prior period reaches the threshold."""
    change = F.col("vs_prior_period_pct")
    flagged = F.coalesce(F.abs(change) >= threshold_pct, F.lit(False))
    text = F.concat(F.lit("Net cashflow moved by "), F.format_number(change, 2), F.lit("% against the prior period"))
    return totals.withColumn("anomaly_flag", flagged).withColumn("anomaly_reason", F.when(flagged, text))


def summary_text(currency: str = "PKR") -> Column:
    """One sentence per period."""
    def money(column: str) -> Column:
        return F.concat(F.lit(f"{currency} "), F.format_number(F.col(column), 2))

    return F.concat(
        F.lit("In "), F.col("period_key"), F.lit(", "), F.col("transaction_count").cast("string"),
        F.lit(" transactions: "), money("total_debits"), F.lit(" paid, "), money("total_credits"),
        F.lit(" received, net "), money("net_cashflow"), F.lit("."),
    )


#: What the summaries of all periods start from.
PARTIAL_KEYS = ["category", "vendor_normalised"]


def period_summary(gold: DataFrame, n: int = 5, offset: int = 1, options: Options = DEFAULTS) -> DataFrame:
    """All columns of the period-summary contract but the time stamp. The curated rows are read once."""
    return summary_of_daily(materialize(daily_totals(gold, PARTIAL_KEYS)), n, offset, options)


def summary_of_daily(
    daily: DataFrame, n: int = 5, offset: int = 1, options: Options = DEFAULTS, wanted: DataFrame | None = None,
    folder: str | None = None,
) -> DataFrame:
    """``period_summary`` from ``daily_totals`` by PARTIAL_KEYS; with ``wanted`` (period_type, number; see
    ``period_number``) of these periods alone, compared with the totals of all. ``folder`` as for ``materialize``."""
    keys = ["period_type", "period_key"]
    # Only the vendors' ranks need the rows of each vendor, which are about as many as transactions; all else starts from
    # the few rows by day and category.
    slim = materialize(
        daily.groupBy("transaction_date", "category")
        .agg(F.sum("debits").alias("debits"), F.sum("credits").alias("credits"), F.sum("n").alias("n")), folder,
    )
    totals = anomaly_flag(vs_prior_period(_totals(slim, options), offset=offset))
    if wanted is not None:
        totals = totals.withColumn("number", period_number()).join(wanted, ["period_type", "number"], "left_semi").drop("number")
    return (
        totals.join(_breakdown(slim), keys, "left")
        .join(_listed(_ranked(daily, n)), keys, "left")
        .withColumn("summary_text", summary_text(options.currency))
        .withColumn("summary_id", uuid_of(F.lit("summary"), *keys))
        .withColumn("qdrant_indexed", F.lit(False))
    )
