"""Mapped rows to the clean layer: dates, amounts, personal data, quarantine, duplicates, status.

The table contracts fix the columns; the rules are chosen here and in ``functions.ledger``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookflow.functions import ledger as lx
from bookflow.functions.keys import uuid_of
from bookflow.functions.values import mask_pii, normalize_tx_type
from bookflow.options import DEFAULTS, Options
from bookflow.plans.joins import attach_totals, salted_lookup

# Weights of the completeness score.
QUALITY_WEIGHTS = {
    "transaction_date": 0.30, "amount": 0.30, "vendor_raw": 0.15, "description_raw": 0.10, "account_code": 0.05,
    "tx_type": 0.05, "reference_number": 0.05,
}
PII_COLUMNS = ["vendor", "description", "reference_number"]


def standardize(rows: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Clean-layer columns of mapped rows, plus ``quality_score`` and ``quarantine_reason`` (null when sound).

    ``rows``: bronze_id, source_software, source_type, mapping_confidence, warnings and the standard fields. One
    narrow projection, no shuffle.
    """
    date = lx.parse_date(F.col("transaction_date"))
    money = lx.split_amount(F.col("amount_debit"), F.col("amount_credit"), F.col("net_amount"))
    masked = {c: mask_pii(F.col(c)) for c in PII_COLUMNS}
    # Plain columns first: each is worked out once, however often the next projection uses it.
    staged = rows.select(
        "*",
        date["date"].alias("_day"), date["method"].alias("_day_method"),
        money["amount_debit"].alias("_debit"), money["amount_credit"].alias("_credit"),
        money["method"].alias("_money_method"),
        *[text.alias(f"_{c}") for c, text in masked.items()],
    ).withColumn("_pii", F.array_compact(F.array(*[F.when(F.col(f"_{c}") != F.col(c), F.lit(c)) for c in PII_COLUMNS])))
    day, found = F.col("_day"), F.size("_pii") > 0
    kept = [c for c in ("file_hash", "source_row_number", "due_date", "tax_amount", "tax_rate") if c in rows.columns]
    columns = [
        uuid_of(F.lit("silver"), "bronze_id").alias("silver_id"),
        F.col("bronze_id"), F.col("source_software"), F.col("source_type"),
        day.alias("transaction_date"),
        lx.year_month(day).alias("year_month"),
        lx.fiscal_year(day, options).alias("fiscal_year"),
        F.col("_debit").alias("amount_debit"),
        F.col("_credit").alias("amount_credit"),
        lx.net_amount(F.col("_debit"), F.col("_credit")).alias("net_amount"),
        F.coalesce("currency", F.lit(options.currency)).alias("currency"),
        F.col("_vendor").alias("vendor_raw"),
        F.substring("_description", 1, 1000).alias("description_raw"),
        F.col("account_code"),
        F.when(F.col("tx_type").isNotNull(), normalize_tx_type(F.col("tx_type"))).alias("tx_type"),
        F.col("_reference_number").alias("reference_number"),
        F.coalesce("mapping_confidence", F.lit(1.0).cast("float")).alias("normalisation_confidence"),
        F.col("_day_method").alias("date_parse_method"),
        F.col("_money_method").alias("amount_parse_method"),
        found.alias("pii_detected"),
        found.alias("pii_masked"),
        F.when(found, F.to_json("_pii")).alias("pii_fields_masked"),
        lx.detect_language(F.concat_ws(" ", "_vendor", "_description")).alias("language_detected"),
        F.col("transaction_date").alias("_date_text"),
        F.exists("warnings", lambda w: w.contains("amount '")).alias("_amount_warned"),
        *[F.col(c) for c in kept],
    ]
    clean = staged.select(*columns)
    scored = clean.withColumn(
        "quality_score",
        lx.quality_score(
            {
                name: (F.col("amount_debit") if name == "amount" else F.col(name), weight)
                for name, weight in QUALITY_WEIGHTS.items()
            }
        ),
    )
    return scored.withColumn("quarantine_reason", quarantine_reason(options)).drop("_date_text", "_amount_warned")


def quarantine_reason(options: Options = DEFAULTS) -> Column:
    """First reason that applies, null for a sound row.

    encoding_error: a replacement character; date_parse_failed: a date text in no known spelling;
    amount_parse_failed: no amount and a warning about one; missing_required_field: no date or no amount;
    pii_unresolvable: ten digits in a row are left after masking; quality_too_low: the score misses the gate.
    """
    text = F.concat_ws(" ", "vendor_raw", "description_raw", "reference_number")
    no_amount = F.col("amount_parse_method").isNull()
    return (
        F.when(text.contains("�"), "encoding_error")
        .when(F.col("transaction_date").isNull() & F.col("_date_text").isNotNull(), "date_parse_failed")
        .when(no_amount & F.col("_amount_warned"), "amount_parse_failed")
        .when(no_amount | F.col("transaction_date").isNull(), "missing_required_field")
        .when(text.rlike(r"\d{10}"), "pii_unresolvable")
        .when(F.col("quality_score") < F.lit(options.quality_gate).cast("float"), "quality_too_low")
    )


def quarantine(standardized: DataFrame, raw: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(sound rows, quarantined rows); with ``raw`` the latter carry the original content and file name."""
    bad = standardized.filter(F.col("quarantine_reason").isNotNull()).select(
        uuid_of(F.lit("quarantine"), "bronze_id").alias("quarantine_id"), "bronze_id", "quarantine_reason",
        "quality_score", "source_software",
    )
    if raw is not None:
        # An inner join, so that the few bad rows can be the broadcast side; every bad row has a raw one.
        bad = raw.select("bronze_id", "raw_content", "source_file").join(bad, "bronze_id")
    bad = bad.withColumn("reviewed_by_user", F.lit(False)).withColumn("user_action", F.lit(None).cast("string"))
    return standardized.filter(F.col("quarantine_reason").isNull()).drop("quarantine_reason"), bad


def mark_duplicates(silver: DataFrame, options: Options = DEFAULTS, stored: DataFrame | None = None) -> DataFrame:
    """Adds is_duplicate, duplicate_of and dedup_confidence.

    Rows of any source with the same date, net amount and normalised vendor are one transaction; the one with the
    smallest silver_id survives, a row of ``stored`` (clean rows of earlier loads) before any new one. Confidence 0.95
    when the descriptions agree as well, else 0.8. Rows without a vendor are never duplicates and take no part. A group
    may hold any share of the rows: it is reduced map-side to its survivor, and only groups of several rows come back,
    through a salted join.
    """
    group = ["transaction_date", "net_amount", "_vendor"]
    keyed = silver.withColumn("_vendor", lx.normalize_vendor(F.col("vendor_raw")))
    named = keyed.filter(F.col("_vendor").isNotNull())
    entry = [*group, F.struct(F.lit(1).alias("new"), "silver_id", "description_raw").alias("_row")]
    entries = named.select(*entry)
    if stored is not None:
        known = stored.filter(~F.col("is_duplicate")).withColumn("_vendor", lx.normalize_vendor(F.col("vendor_raw")))
        entries = entries.unionByName(
            known.filter(F.col("_vendor").isNotNull())
            .select(*group, F.struct(F.lit(0).alias("new"), "silver_id", "description_raw").alias("_row"))
        )
    firsts = entries.groupBy(*group).agg(F.min("_row").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    marked = salted_lookup(named, firsts, group, ["silver_id"], options).unionByName(
        keyed.filter(F.col("_vendor").isNull()), allowMissingColumns=True
    )
    is_copy = F.coalesce(F.col("silver_id") != F.col("_first.silver_id"), F.lit(False))
    agree = F.col("description_raw").eqNullSafe(F.col("_first.description_raw"))
    return (
        marked.withColumn("is_duplicate", is_copy)
        .withColumn("duplicate_of", F.when(is_copy, F.col("_first.silver_id")))
        .withColumn("dedup_confidence", F.when(is_copy, F.when(agree, 0.95).otherwise(0.8)).cast("float"))
        .drop("_vendor", "_first")
    )


def survivors(silver: DataFrame) -> DataFrame:
    """Duplicates joined to the row that survives them; one survivor may have any share of the copies."""
    kept = silver.filter(~F.col("is_duplicate")).select(
        F.col("silver_id").alias("duplicate_of"), F.col("bronze_id").alias("survivor_bronze_id")
    )
    copies = silver.filter(F.col("is_duplicate")).select("silver_id", "bronze_id", "duplicate_of")
    return salted_lookup(copies, kept, ["duplicate_of"], ["silver_id"])


def row_statuses(silver: DataFrame, quarantined: DataFrame) -> DataFrame:
    """(bronze_id, processing_status) of the rows that a run has settled."""
    return silver.select("bronze_id", F.lit("normalised").alias("processing_status")).unionByName(
        quarantined.select("bronze_id", F.lit("quarantined").alias("processing_status"))
    )


def advance_status(raw: DataFrame, silver: DataFrame, quarantined: DataFrame) -> DataFrame:
    """(bronze_id, processing_status) of every raw row; the raw table itself stays as written."""
    outcome = row_statuses(silver, quarantined).withColumnRenamed("processing_status", "outcome")
    return raw.select("bronze_id", "processing_status").join(outcome, "bronze_id", "left").select(
        "bronze_id", F.coalesce("outcome", "processing_status").alias("processing_status")
    )


def review_quarantine(quarantined: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(quarantine with the user's actions, released rows).

    ``decisions``: quarantine_id, user_action (approve, reject or edit), reviewed_at, edited_content. Approved rows are
    released with their original content, edited ones with the new content.
    """
    known = [c for c in quarantined.columns if c not in ("user_action", "reviewed_by_user", "reviewed_at")]
    reviewed = quarantined.select(*known).join(decisions, "quarantine_id", "left").withColumn(
        "reviewed_by_user", F.col("user_action").isNotNull()
    )
    released = reviewed.filter(F.col("user_action").isin("approve", "edit")).select(
        "bronze_id", "source_software", "user_action",
        F.when(F.col("user_action") == "edit", F.col("edited_content")).otherwise(F.col("raw_content"))
        .alias("raw_content"),
    )
    return reviewed.drop("edited_content"), released


def flag_amount_spikes(rows: DataFrame, by: list[str], options: Options = DEFAULTS) -> DataFrame:
    """Adds ``amount_spike``: the amount is above ``options.amount_spike_ratio`` times the average of its group."""
    size = F.abs("net_amount")
    marked = attach_totals(rows, by, {"_mean": F.avg(size)}, ["silver_id"], options)
    return marked.withColumn("amount_spike", size > F.col("_mean") * options.amount_spike_ratio).drop("_mean")


def flag_future_dates(rows: DataFrame, as_of: Column, options: Options = DEFAULTS) -> DataFrame:
    """Adds ``future_date``: more than ``options.max_future_days`` after ``as_of``."""
    return rows.withColumn("future_date", F.col("transaction_date") > F.date_add(as_of, options.max_future_days))
