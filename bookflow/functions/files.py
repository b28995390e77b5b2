"""Decisions taken from a file's name, size and bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookflow.options import DEFAULTS, Options

# --- fixed values: suffixes ---------------------------------------------------------------------------
SUPPORTED = [".xlsx", ".xls", ".csv", ".pdf", ".json"]
IGNORED = [".tmp", ".lock", ".swp", ".bak", ".~", ".part", ".crdownload", ".ds_store"]

# --- fixed values: (file-name pattern, system, confidence), the first match wins ----------------------
NAME_PATTERNS = [
    (r"(?i)quickbooks|quick.?books|qb.*transactions|export.*quickbooks", "quickbooks_desktop", 0.85),
    (r"(?i)transaction.*detail.*report|general.*ledger.*detail", "quickbooks_desktop", 0.70),
    (r"(?i)qbo.*export|quickbooks.*online", "quickbooks_online", 0.85),
    (r"(?i)tally.*export|tallyprime|tally\.xml", "tally", 0.90),
    (r"(?i)daybook|cashbook.*tally|ledger.*tally", "tally", 0.70),
    (r"(?i)ledgermax|ledger.?max", "ledgermax", 0.95),
    (r"(?i)moneypex", "moneypex", 0.95),
    (r"(?i)hbl.*statement|habib.*bank.*statement", "bank_pdf_hbl", 0.90),
    (r"(?i)ubl.*statement|united.*bank.*statement", "bank_pdf_ubl", 0.90),
    (r"(?i)alfalah.*statement|bank.*alfalah", "bank_pdf_alfalah", 0.90),
    (r"(?i)meezan.*statement|meezan.*bank", "bank_pdf_meezan", 0.90),
    (r"(?i)nbp.*statement|national.*bank.*pakistan", "bank_pdf_nbp", 0.90),
    (r"(?i)account.*statement|bank.*statement|e.?statement", "bank_pdf_generic", 0.75),
    (r"(?i)xero.*export|xero.*report", "xero", 0.90),
    (r"(?i)odoo.*export|erpnext", "odoo", 0.90),
    (r"(?i)sage.*export|sage.*report", "sage", 0.85),
]

# --- fixed values: (file type, system, confidence) when no name pattern matches -----------------------
TYPE_DEFAULTS = [
    ("pdf", "bank_pdf_generic", 0.5),
    ("xlsx", "manual_excel", 0.5),
    ("csv", "unknown", 0.4),
    ("json", "unknown", 0.4),
    ("unknown", "unknown", 0.0),
]


def file_name(path: Column) -> Column:
    """Last component of a path."""
    return F.substring_index(path, "/", -1)


def suffix(name: Column) -> Column:
    """Lower-cased last suffix with its dot; "" for names such as ``.hidden`` and ``name.``."""
    return F.regexp_extract(F.lower(name), r"(?s)^.+(\.[^.]+)$", 1)


def is_supported(name: Column) -> Column:
    """The suffix is one that can be taken in."""
    return suffix(name).isin(SUPPORTED)


def is_ignored(name: Column) -> Column:
    """Temporary, hidden and lock files."""
    return suffix(name).isin(IGNORED) | name.startswith(".") | name.startswith("~$")


def source_type(name: Column) -> Column:
    """xlsx, csv, pdf, json or unknown."""
    ext = suffix(name)
    return (
        F.when(ext.isin(".xlsx", ".xls"), "xlsx")
        .when(ext.isin(".csv", ".pdf", ".json"), F.substring(ext, 2, 10))
        .otherwise("unknown")
    )


def classify_file(name: Column) -> Column:
    """struct(source_type, source_software, detection_conf) from a file name."""

    def verdict(software: str, confidence: float) -> Column:
        return F.struct(
            kind.alias("source_type"),
            F.lit(software).alias("source_software"),
            F.lit(confidence).alias("detection_conf"),
        )

    kind = source_type(name)
    chain = F.when(F.lit(False), verdict("unknown", 0.0))
    for pattern, software, confidence in NAME_PATTERNS:
        chain = chain.when(name.rlike(pattern), verdict(software, confidence))
    for default, software, confidence in TYPE_DEFAULTS:
        chain = chain.when(kind == default, verdict(software, confidence))
    return chain


def fingerprint(content: Column) -> Column:
    """SHA-256 of the bytes as 64 hex digits."""
    return F.sha2(content, 256)


def check_file_size(size_bytes: Column, options: Options = DEFAULTS) -> Column:
    """struct(passed, message) of the size gate."""
    megabytes = size_bytes / F.lit(1024 * 1024)
    shown = F.regexp_replace(F.format_number(megabytes, 1), ",", "")
    limit = options.max_file_mb
    passed = ~(megabytes > limit)
    message = F.when(passed, F.format_string("File size OK (%sMB)", shown)).otherwise(
        F.format_string(f"File size %sMB exceeds maximum {limit}MB. Split the file and upload in parts.", shown)
    )
    return F.struct(passed.alias("passed"), message.alias("message"))


def check_row_count(rows: Column, options: Options = DEFAULTS) -> Column:
    """struct(passed, message) of the row-count gate."""
    shown, limit = F.format_number(rows, 0), f"{options.max_rows_per_file:,}"
    passed = ~(rows > options.max_rows_per_file)
    message = F.when(passed, F.format_string("Row count OK (%s rows)", shown)).otherwise(
        F.format_string(
            f"File contains %s rows, exceeding the {limit} row limit. "
            "Please split into monthly files and upload separately.",
            shown,
        )
    )
    return F.struct(passed.alias("passed"), message.alias("message"))

