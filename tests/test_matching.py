"""Golden header-mapping vectors, memory and suggestions."""

import pytest
from pyspark.sql import functions as F

from bookflow import contracts as ct
from bookflow.dictionary import header_rows, tax_rows, tx_type_rows
from bookflow.operators import matching, memory

VECTORS = [
    ("Date", "tally", "transaction_date", 0.95, "software_exact"),
    ("DATE", "unknown", "transaction_date", 0.95, "exact_case_insensitive"),
    ("Taareekh", "manual_excel", "transaction_date", 0.90, "exact_case_insensitive"),
    ("تاریخ", "manual_excel", "transaction_date", 0.90, "exact_case_insensitive"),
    ("Raqam", "manual_excel", "net_amount", 0.90, "exact_case_insensitive"),
    ("Particulars", "tally", "vendor", 0.95, "software_exact"),
    ("Particulars", "manual_excel", "vendor", 0.95, "exact_case_insensitive"),
    ("Particulars", "bank_pdf_hbl", "description", 0.95, "software_exact"),
    ("Date ", "tally", "transaction_date", 0.95, "exact_case_insensitive"),
    ("Branch", "manual_excel", "bank_name", 0.95, "exact_case_insensitive"),
    ("Total", "manual_excel", "net_amount", 0.80, "exact_case_insensitive"),
    ("Amt", "manual_excel", "net_amount", 0.70, "exact_case_insensitive"),
    ("Debit(Rs)", "manual_excel", "amount_debit", 0.85, "normalized_match"),
    ("Desc..", "manual_excel", "description", 0.70, "normalized_match"),
    ("Transaction Dates", "manual_excel", "transaction_date", 0.891, "fuzzy_ngram (best: Transaction Date)"),
    ("Narrations", "manual_excel", "description", 0.844, "fuzzy_ngram (best: Narration)"),
    ("Total-Amount", "manual_excel", "net_amount", 0.600, "fuzzy_ngram (best: Total Amount)"),
    ("Vendor Name", "manual_excel", "vendor", 0.415, "substring_match"),
    ("Debit Amt", "manual_excel", "amount_debit", 0.422, "substring_match"),
    ("Vendor Name (City)", "manual_excel", None, 0.0, "no_match"),
    ("XyzAbcDef123", "manual_excel", None, 0.0, "no_match"),
    ("quality_score", "manual_excel", None, 0.0, "reserved_rename"),
    ("MyCustomDate", "manual_excel", "transaction_date", 1.0, "user_confirmed"),
]


def test_dictionary_sizes():
    kinds = [r[1] for r in header_rows()]
    assert (len(kinds), kinds.count("system"), kinds.count("urdu"), kinds.count("general"), kinds.count("abbreviation")) == (
        487, 255, 48, 153, 31,
    )
    assert len(tx_type_rows()) == 41 and len(tax_rows()) == 21


@pytest.fixture(scope="module")
def mapped(spark):
    columns = spark.createDataFrame([(v[0], v[1]) for v in VECTORS], "column string, source_software string")
    known = spark.createDataFrame(
        [("manual_excel", "MyCustomDate", "transaction_date")],
        "source_software string, original_column string, standard_field string",
    )
    return {(r.column, r.source_software): r for r in matching.triage(matching.map_columns(columns, known)).collect()}


@pytest.mark.parametrize("vector", VECTORS, ids=lambda v: f"{v[0]}-{v[1]}")
def test_vector(mapped, vector):
    column, system, target, confidence, method = vector
    row = mapped[column, system]
    assert (row.standard_field, row.confidence, row.match_method) == (target, confidence, method)
    assert row.is_mapped == (target is not None and confidence >= 0.6)
    assert row.needs_review == (target is None or confidence < 0.85)


def brute_force(names):
    """Every header against every dictionary row, as the rules say it."""
    def grams(text):
        return {text[i : i + 2] for i in range(len(text) - 1)}

    from bookflow.dictionary import plain_name

    found = {}
    for name in names:
        best, plain, low = (0.0, None), plain_name(name), name.strip().lower()
        for _, _, _, header, ci, known, target, base in header_rows():
            a, b = grams(plain), grams(known)
            score = len(a & b) / len(a | b) * base if a and b else 0.0
            if score > best[0]:
                best = (score, header)
        fuzzy = (round(best[0], 3), best[1]) if best[0] >= 0.6 else None
        best = (0.0, None)
        for _, _, _, header, ci, known, target, base in header_rows():
            score = 0.0
            if ci in low and len(ci) >= 3:
                score = len(ci) / len(low) * base * 0.80
            elif low in ci and len(low) >= 3:
                score = len(low) / len(ci) * base * 0.75
            if score > best[0]:
                best = (score, target)
        part = (round(best[0], 3), best[1]) if best[0] >= 0.4 else None
        found[name] = (fuzzy, part)
    return found


def test_scored_strategies_against_brute_force(spark):
    names = sorted({
        variant
        for r in header_rows()[::5]
        for variant in (r[3] + "s", r[3][:-1], "The " + r[3], r[3] + " of " + r[3], r[3][1:], r[3].replace(" ", ""))
        if variant
    })
    columns = spark.createDataFrame([(n,) for n in names], "column string")
    fuzzy = {r.column: (r.confidence, r.match_method[len("fuzzy_ngram (best: "):-1]) for r in matching.match_fuzzy(columns).collect()}
    part = {r.column: (r.confidence, r.standard_field) for r in matching.match_substring(columns).collect()}
    for name, (want_fuzzy, want_part) in brute_force(names).items():
        assert fuzzy.get(name) == want_fuzzy, name
        assert part.get(name) == want_part, name


def test_memory_upsert_and_order(spark):
    contract = ct.CONTRACTS["bronze_schema_mappings"]
    day = F.lit("2024-01-01").cast("timestamp")
    before = ct.apply_defaults(
        spark.createDataFrame(
            [("m1", "tally", "Old", "vendor", 0.7), ("m2", "tally", "Sure", "vendor", 0.85)],
            "mapping_id string, source_software string, original_column string, standard_field string, confidence double",
        ).withColumn("times_seen", F.lit(5)), contract, day,
    )
    assert {r.original_column for r in memory.load_memory(before).collect()} == {"Sure"}
    seen = spark.createDataFrame(
        [("tally", "Old", "description", 0.9), ("tally", "Old", "description", 0.9), ("tally", "New", "balance", 0.6),
         ("tally", "Weak", "vendor", 0.59), ("tally", "None", None, 0.0)],
        "source_software string, column string, standard_field string, confidence double",
    )
    after = memory.save_memory(before, seen, F.lit("2024-02-01").cast("timestamp"))
    rows = {r.original_column: r for r in after.collect()}
    assert set(rows) == {"Old", "Sure", "New"}
    assert (rows["Old"].standard_field, round(rows["Old"].confidence, 2), rows["Old"].times_seen) == ("vendor", 0.7, 7)
    assert (rows["New"].times_seen, rows["New"].confirmed_by_user) == (1, False)
    assert rows["Sure"].updated_at < rows["Old"].updated_at
    assert [r.original_column for r in memory.by_times_seen(after).collect()] == ["Old", "Sure", "New"]
