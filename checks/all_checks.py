"""Imports every module that registers queries."""

from checks import (  # noqa: F401
    functions_checks, intake_checks, large_checks, ledger_checks, mapping_checks, report_checks, state_checks,
)
from checks.registry import ORACLES, QUERIES  # noqa: F401
