"""Every tunable of the pipeline in one frozen dataclass."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    """Thresholds and switches. The defaults are the documented constants."""

    # Gates. Their verdicts are always worked out; files above them are refused only where ``enforce_gates`` says so.
    max_file_mb: int = 50
    max_rows_per_file: int = 100_000
    enforce_gates: bool = False
    debounce_seconds: float = 2.0
    # Delimited files of a listing above this are read over many tasks; below, a file is one row of one task.
    split_above_bytes: int = 256 * 1024 * 1024

    # Delimited-file detection windows.
    encoding_sample_bytes: int | None = None  # None: all bytes
    encoding_min_confidence: float = 0.80
    delimiter_sample_chars: int = 4_096
    delimiter_fallback_lines: int = 5

    # Workbook detection windows.
    header_scan_rows: int = 15
    header_min_cells: int = 2
    sheet_scan_rows: int = 200

    # Header-mapping thresholds.
    auto_accept: float = 0.85
    suggest: float = 0.60
    reject: float = 0.40
    suggestion_confidence: float = 0.75

    # Value rules.
    large_amount: float = 1_000_000_000.0
    max_text: int = 500
    sample_rows: int = 2
    sample_chars: int = 50
    amount_spike_ratio: float = 1000.0
    max_future_days: int = 30

    # Clean and curated layers.
    currency: str = "PKR"
    fiscal_start_month: int = 7
    quality_gate: float = 0.7
    time_zone: str = "Asia/Karachi"

    # Join sizing. Lookup relations up to this many rows and bytes are broadcast,
    # larger ones are shuffled with their hot keys salted.
    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 256 * 1024 * 1024
    hot_key_rows: int = 1_000_000
    hot_keys: int = 100_000


DEFAULTS = Options()
