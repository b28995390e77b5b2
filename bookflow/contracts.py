"""The seven table contracts and the validation operator.

Parquet enforces neither NOT NULL, CHECK nor UNIQUE, so ``validate`` does: it splits rows into accepted and rejected
ones, or fails the job with ``strict=True``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructField

from bookflow.options import DEFAULTS, Options
from bookflow.plans.joins import attach_totals, salted_lookup
from bookflow.plans.session import materialize

# --- fixed values: enumerations -----------------------------------------------------------------------
SOURCE_TYPES = [
    "xlsx",
    "csv",
    "pdf",
    "api_quickbooks",
    "api_xero",
    "api_tally",
    "api_odoo",
    "json",
    "manual",
]
SOURCE_SYSTEMS = [
    "manual_excel",
    "ledgermax",
    "quickbooks_desktop",
    "quickbooks_online",
    "tally",
    "xero",
    "odoo",
    "erpnext",
    "sage",
    "moneypex",
    "bank_pdf_hbl",
    "bank_pdf_ubl",
    "bank_pdf_alfalah",
    "bank_pdf_meezan",
    "bank_pdf_nbp",
    "bank_pdf_generic",
    "unknown",
]
PROCESSING_STATUSES = [
    "pending",
    "processing",
    "normalised",
    "quarantined",
    "error",
]
LANGUAGES = [
    "en",
    "ur",
    "mixed",
]
QUARANTINE_REASONS = [
    "quality_too_low",
    "date_parse_failed",
    "amount_parse_failed",
    "missing_required_field",
    "suspected_duplicate",
    "pii_unresolvable",
    "encoding_error",
]
CATEGORY_METHODS = [
    "rule_based",
    "embedding",
    "tx_type_map",
    "account_code_map",
    "user_confirmed",
]
PERIOD_TYPES = [
    "daily",
    "weekly",
    "monthly",
]
LAYERS = [
    "bronze",
    "silver",
    "gold",
    "bridge",
]
STATUSES = [
    "success",
    "failure",
    "warning",
]
REVIEW_ACTIONS = [
    "approve",
    "reject",
    "edit",
]

TEXT, INTEGER, FLOAT, MONEY = T.StringType(), T.IntegerType(), T.FloatType(), T.DecimalType(18, 2)
DATE, TIMESTAMP, BOOLEAN = T.DateType(), T.TimestampType(), T.BooleanType()


@dataclass(frozen=True)
class Contract:
    """Columns (not nullable: NOT NULL), enumerations, unique keys, defaults and other checks."""

    name: str
    columns: tuple[StructField, ...]
    enums: dict[str, list[str]] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    quality_gate: bool = False
    computed: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        """All columns as nullable: rows that lack a value are read and then refused with a reason."""
        return T.StructType([StructField(c.name, c.dataType) for c in self.columns])

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]


# --- fixed values: the seven tables -------------------------------------------------------------------
CONTRACTS = {
    c.name: c
    for c in [
        Contract(
            "bronze_transactions",
            (
                StructField("bronze_id", TEXT, False),
                StructField("source_type", TEXT, False),
                StructField("source_software", TEXT, False),
                StructField("source_file", TEXT, True),
                StructField("source_file_hash", TEXT, True),
                StructField("source_row_number", INTEGER, True),
                StructField("raw_content", TEXT, False),
                StructField("raw_headers", TEXT, True),
                StructField("ingested_at", TIMESTAMP, True),
                StructField("ingestion_batch_id", TEXT, True),
                StructField("processing_status", TEXT, True),
                StructField("error_message", TEXT, True),
            ),
            {
                "source_type": SOURCE_TYPES, "source_software": SOURCE_SYSTEMS,
                "processing_status": PROCESSING_STATUSES,
            },
            (("bronze_id",),),
            {"processing_status": "pending", "ingested_at": "now"},
        ),
        Contract(
            "bronze_schema_mappings",
            (
                StructField("mapping_id", TEXT, False),
                StructField("source_software", TEXT, False),
                StructField("original_column", TEXT, False),
                StructField("standard_field", TEXT, False),
                StructField("confidence", FLOAT, True),
                StructField("confirmed_by_user", BOOLEAN, True),
                StructField("times_seen", INTEGER, True),
                StructField("created_at", TIMESTAMP, True),
                StructField("updated_at", TIMESTAMP, True),
            ),
            {},
            (("mapping_id",), ("source_software", "original_column")),
            {
                "confidence": 1.0, "confirmed_by_user": False, "times_seen": 1, "created_at": "now",
                "updated_at": "now",
            },
        ),
        Contract(
            "silver_transactions",
            (
                StructField("silver_id", TEXT, False),
                StructField("bronze_id", TEXT, False),
                StructField("source_software", TEXT, False),
                StructField("source_type", TEXT, False),
                StructField("transaction_date", DATE, False),
                StructField("year_month", TEXT, False),
                StructField("fiscal_year", TEXT, True),
                StructField("amount_debit", MONEY, True),
                StructField("amount_credit", MONEY, True),
                StructField("currency", TEXT, True),
                StructField("vendor_raw", TEXT, True),
                StructField("description_raw", TEXT, True),
                StructField("account_code", TEXT, True),
                StructField("tx_type", TEXT, True),
                StructField("normalisation_confidence", FLOAT, True),
                StructField("date_parse_method", TEXT, True),
                StructField("amount_parse_method", TEXT, True),
                StructField("pii_detected", BOOLEAN, True),
                StructField("pii_masked", BOOLEAN, True),
                StructField("pii_fields_masked", TEXT, True),
                StructField("duplicate_of", TEXT, True),
                StructField("is_duplicate", BOOLEAN, True),
                StructField("dedup_confidence", FLOAT, True),
                StructField("language_detected", TEXT, True),
                StructField("silver_created_at", TIMESTAMP, True),
            ),
            {"language_detected": LANGUAGES},
            (("silver_id",),),
            {
                "amount_debit": 0, "amount_credit": 0, "currency": "PKR", "normalisation_confidence": 1.0,
                "pii_detected": False, "pii_masked": False, "is_duplicate": False, "language_detected": "en",
                "silver_created_at": "now",
            },
            computed={"net_amount": "cast(amount_credit - amount_debit as decimal(18,2))"},
        ),
        Contract(
            "silver_quarantine",
            (
                StructField("quarantine_id", TEXT, False),
                StructField("bronze_id", TEXT, False),
                StructField("quarantine_reason", TEXT, False),
                StructField("quality_score", FLOAT, True),
                StructField("raw_content", TEXT, True),
                StructField("source_software", TEXT, True),
                StructField("source_file", TEXT, True),
                StructField("quarantined_at", TIMESTAMP, True),
                StructField("reviewed_by_user", BOOLEAN, True),
                StructField("user_action", TEXT, True),
                StructField("reviewed_at", TIMESTAMP, True),
            ),
            {"quarantine_reason": QUARANTINE_REASONS},
            (("quarantine_id",),),
            {"quarantined_at": "now", "reviewed_by_user": False},
        ),
        Contract(
            "gold_transactions",
            (
                StructField("transaction_id", TEXT, False),
                StructField("silver_id", TEXT, False),
                StructField("bronze_id", TEXT, False),
                StructField("source_software", TEXT, False),
                StructField("source_type", TEXT, False),
                StructField("transaction_date", DATE, False),
                StructField("year_month", TEXT, False),
                StructField("fiscal_year", TEXT, True),
                StructField("amount_debit", MONEY, True),
                StructField("amount_credit", MONEY, True),
                StructField("currency", TEXT, True),
                StructField("vendor_raw", TEXT, True),
                StructField("vendor_normalised", TEXT, True),
                StructField("description_clean", TEXT, True),
                StructField("category", TEXT, True),
                StructField("subcategory", TEXT, True),
                StructField("category_confidence", FLOAT, True),
                StructField("category_method", TEXT, True),
                StructField("fbr_category", TEXT, True),
                StructField("fbr_tax_applicable", BOOLEAN, True),
                StructField("withholding_tax_rate", FLOAT, True),
                StructField("account_code", TEXT, True),
                StructField("tx_type", TEXT, True),
                StructField("debit_account", TEXT, True),
                StructField("credit_account", TEXT, True),
                StructField("embedding_text", TEXT, False),
                StructField("quality_score", FLOAT, False),
                StructField("gold_version", INTEGER, True),
                StructField("pii_masked", BOOLEAN, True),
                StructField("language_detected", TEXT, True),
                StructField("qdrant_indexed", BOOLEAN, True),
                StructField("qdrant_indexed_at", TIMESTAMP, True),
                StructField("embedding_model", TEXT, True),
                StructField("gold_created_at", TIMESTAMP, True),
                StructField("gold_updated_at", TIMESTAMP, True),
            ),
            {"category_method": CATEGORY_METHODS},
            (("transaction_id",),),
            {
                "amount_debit": 0, "amount_credit": 0, "currency": "PKR", "fbr_tax_applicable": False,
                "gold_version": 1, "pii_masked": True, "language_detected": "en", "qdrant_indexed": False,
                "gold_created_at": "now", "gold_updated_at": "now",
            },
            quality_gate=True,
            computed={"net_amount": "cast(amount_credit - amount_debit as decimal(18,2))"},
        ),
        Contract(
            "gold_period_summaries",
            (
                StructField("summary_id", TEXT, False),
                StructField("period_key", TEXT, False),
                StructField("period_type", TEXT, False),
                StructField("fiscal_year", TEXT, True),
                StructField("total_debits", MONEY, True),
                StructField("total_credits", MONEY, True),
                StructField("net_cashflow", MONEY, True),
                StructField("transaction_count", INTEGER, True),
                StructField("category_breakdown", TEXT, True),
                StructField("top_vendors", TEXT, True),
                StructField("anomaly_flag", BOOLEAN, True),
                StructField("anomaly_reason", TEXT, True),
                StructField("vs_prior_period_pct", FLOAT, True),
                StructField("qdrant_indexed", BOOLEAN, True),
                StructField("summary_text", TEXT, True),
                StructField("computed_at", TIMESTAMP, True),
            ),
            {"period_type": PERIOD_TYPES},
            (("summary_id",), ("period_key", "period_type")),
            {
                "total_debits": 0, "total_credits": 0, "net_cashflow": 0, "transaction_count": 0,
                "anomaly_flag": False, "qdrant_indexed": False, "computed_at": "now",
            },
        ),
        Contract(
            "pipeline_audit_log",
            (
                StructField("log_id", TEXT, False),
                StructField("operation", TEXT, False),
                StructField("source_id", TEXT, True),
                StructField("source_layer", TEXT, True),
                StructField("status", TEXT, False),
                StructField("message", TEXT, True),
                StructField("rows_affected", INTEGER, True),
                StructField("duration_ms", INTEGER, True),
                StructField("logged_at", TIMESTAMP, True),
            ),
            {"source_layer": LAYERS, "status": STATUSES},
            (("log_id",),),
            {"logged_at": "now"},
        ),
    ]
}
TABLES = list(CONTRACTS)


def not_null(column: str) -> Column:
    """Reason text where the column is null, else null."""
    return F.when(F.col(column).isNull(), F.lit(f"{column} is null"))


def enum_check(column: str, allowed: list[str]) -> Column:
    """Reason text where the value is outside the list; null passes, as in SQL."""
    return F.when(~F.col(column).isin(allowed), F.lit(f"{column} is not allowed"))


def quality_gate(column: str = "quality_score", options: Options = DEFAULTS) -> Column:
    """Reason text below the gate. Compared in 32 bits, so that 0.7 itself passes."""
    gate = F.lit(options.quality_gate).cast("float")
    return F.when(F.col(column).cast("float") < gate, F.lit(f"{column} is below the gate"))


def review_action_check(column: str = "user_action", strict_review: bool = False) -> Column:
    """Reason text of the review-action check.

    The contract lists NULL among the allowed values, so the comparison is never false and nothing is rejected;
    ``strict_review`` checks the three real actions.
    """
    if strict_review:
        return enum_check(column, REVIEW_ACTIONS)
    allowed = F.col(column).isin(REVIEW_ACTIONS) | F.lit(None).cast("boolean")
    return F.when(~allowed, F.lit(f"{column} is not allowed"))


def row_reasons(contract: Contract, names: list[str], strict_review: bool = False, options: Options = DEFAULTS) -> Column:
    """What speaks against a row by itself: nulls, values outside a list, the quality gate."""
    checks = [not_null(c) for c in contract.required if c in names]
    checks += [enum_check(c, allowed) for c, allowed in contract.enums.items() if c in names]
    if contract.quality_gate and "quality_score" in names:
        checks.append(quality_gate(options=options))
    if "user_action" in names:
        checks.append(review_action_check(strict_review=strict_review))
    return F.array_compact(F.array(*checks))


def apply_defaults(df: DataFrame, contract: Contract, as_of: Column | None = None) -> DataFrame:
    """Missing columns added, nulls of defaulted columns filled, every column cast to its contract type."""
    now = F.current_timestamp() if as_of is None else as_of
    columns = []
    for item in contract.schema:
        value = F.col(item.name) if item.name in df.columns else F.lit(None)
        if item.name in contract.defaults:
            default = contract.defaults[item.name]
            value = F.coalesce(value, now if default == "now" else F.lit(default))
        columns.append(value.cast(item.dataType).alias(item.name))
    return df.select(*columns)


def with_computed(df: DataFrame, contract: Contract) -> DataFrame:
    """Adds the generated columns; they are derived on reading and never stored."""
    return df.withColumns({name: F.expr(text) for name, text in contract.computed.items()})


def duplicate_key(df: DataFrame, key: tuple[str, ...], order_by: list[str], options: Options = DEFAULTS) -> DataFrame:
    """Adds ``_late``: the row is not the first one (by ``order_by``) of its key. Keys with a null never clash.

    A row with ``reasons`` against it is not stored, so it takes no key.
    """
    place = F.struct(*order_by)
    storable = F.when(F.size("reasons") == 0, place)
    with_first = attach_totals(df, list(key), {"_first": F.min(storable)}, order_by, options)
    complete = F.lit(True)
    for column in key:
        complete = complete & F.col(column).isNotNull()
    late = complete & (F.size("reasons") == 0) & (place > F.col("_first"))
    return with_first.withColumn("_late", F.coalesce(late, F.lit(False))).drop("_first")


def validate(
    df: DataFrame,
    contract: Contract,
    order_by: list[str] | None = None,
    existing: DataFrame | None = None,
    strict: bool = False,
    strict_review: bool = False,
    options: Options = DEFAULTS,
) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with an array ``reasons``).

    Of rows sharing a unique key the first by ``order_by`` is accepted, unless ``existing`` holds the key already.
    ``order_by`` must tell all rows apart; without it the rows are written down once and numbered. ``strict=True``
    raises when anything is rejected.
    """
    names = df.columns
    if order_by is None and contract.unique:
        df, order_by = materialize(df.withColumn("_row", F.monotonically_increasing_id())), ["_row"]
    judged = df.withColumn("reasons", row_reasons(contract, names, strict_review, options))
    for key in contract.unique:
        if not set(key) <= set(names):
            continue
        judged = duplicate_key(judged, key, order_by, options)
        taken = F.lit(False)
        if existing is not None:
            stored = existing.select(*key).distinct().withColumn("_stored", F.lit(True))
            judged = salted_lookup(judged, stored, list(key), order_by, options)
            taken = F.coalesce("_stored", F.lit(False))
        clash = F.lit(f"{', '.join(key)} is not unique")
        judged = judged.withColumn(
            "reasons", F.when(F.col("_late") | taken, F.array_append("reasons", clash)).otherwise(F.col("reasons"))
        ).drop("_late", "_stored")
    accepted = judged.filter(F.size("reasons") == 0).select(*names)
    rejected = judged.filter(F.size("reasons") > 0).select(*names, "reasons")
    if strict and not rejected.isEmpty():
        raise ValueError(f"{contract.name}: rows break the contract: {rejected.first()['reasons']}")
    return accepted, rejected
