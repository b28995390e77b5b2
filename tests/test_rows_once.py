"""Rows are mapped, standardised and summed up once, in code that the JVM compiles."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bookflow.functions.ledger import detect_language
from bookflow.functions.text import normalize_unicode
from bookflow.functions.values import mask_pii, neutralize_cell
from bookflow.operators.curate import ranked_vendors
from bookflow.plans.refine import secure_rows
from bookflow.plans.session import COMPILED_BYTES, HUGE_METHOD, compiled_methods, materialize
from bookflow.plans.summaries import daily_partials, period_summaries, refresh_summaries
from bookflow.tables import Ledger
from checks import large_checks
from checks.all_checks import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def orders(spark, tmp_path):
    """A folder with 200 orders; key 5 comes twice and one has no day."""
    key = F.col("id")
    rows = spark.range(200).unionAll(spark.range(5, 6)).select(
        key.alias("o_orderkey"), (key % 7).alias("o_custkey"), (key * 1.25).alias("o_totalprice"),
        F.when(key != 9, F.lit(dt.datetime(1995, 1, 30))).alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    )
    rows.write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_advance_status_maps_rows_once(spark, orders):
    """rows are written down before they are parted into sound and quarantined ones."""
    found = QUERIES["advance_status"](spark, orders)
    assert "ArrowEvalPython" not in plan(found)
    got = {r.processing_status: r.n for r in found.collect()}
    # Key 5 stands twice among the raw rows and twice among the settled ones.
    assert got["pending"] == 20 and sum(got.values()) == 203 and got["quarantined"] > 0


def test_cells_are_looked_at_once(spark):
    """every use of the map in the step behind was one more search through all cells."""
    rows = spark.createDataFrame([({"Amount": "=1+1", "quality_score": "+2", "x": None},), (None,)], "raw map<string,string>")
    done = secure_rows(rows)
    assert done._jdf.queryExecution().optimizedPlan().toString().count("transform_values") == 1
    want = {"Amount": "FORMULA_REMOVED:=1+1", "raw_quality_score": "FORMULA_REMOVED:+2", "x": None}
    assert [r.raw for r in done.collect()] == [want, None]


def test_texts_travel_to_python_as_text(spark):
    """a column of arrays, null in most rows, is walked over from its start at every row."""
    rows = [
        ({"cafe\u0301": 'e\u0301"\n'},), ({"plain": "text"},), ({"e\u0301": None},), ({},), (None,), ({"\u00e1": None, "b": "\u06c1"},),
    ]
    done = normalize_unicode(spark.createDataFrame(rows, "raw map<string,string>"))
    assert "to_json" in done._jdf.queryExecution().analyzed().toString()
    assert [r.raw for r in done.collect()] == [
        {"caf\u00e9": '\u00e9"\n'}, {"plain": "text"}, {"\u00e9": None}, {}, None, {"\u00e1": None, "b": "\u06c1"}
    ]


def test_shortcuts_give_what_the_whole_rules_give(spark):
    texts = [
        "12345-1234567-1 and 0300123456", "03001234567", "+923001234567", "1234567", "123456", None, "", "١" * 7, "a1234567", "x",
    ]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(mask_pii(F.col("t"))).collect()]
    assert got == ["[CNIC] and [ACCOUNT]", "[PHONE]", "[PHONE]", "[NTN]", "123456", None, "", "[NTN]", "a1234567", "x"]
    cells = ["a <SCRIPT", "JavaScript:x", "DATA:text", "hyperLink", "x =cmd(", "x=Shell(", "x=exec(", "../", "a\x00", "data", "a=b", "<b", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in cells], "t string").select(neutralize_cell(F.col("t"))).collect()]
    assert got == ["DANGEROUS_CONTENT_REMOVED"] * 9 + ["data", "a=b", "<b", None]
    words = ["شہر", "شہر a", "abc", "٠١", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in words], "t string").select(detect_language(F.col("t"))).collect()]
    assert got == ["ur", "mixed", "en", "en", "en", "en"]


def test_written_stages_run_in_compiled_methods(spark):
    """inside, the limit is what the JVM compiles; outside, and where a session has its own, it stays."""
    before = spark.conf.get(HUGE_METHOD, None)
    with compiled_methods(spark):
        assert spark.conf.get(HUGE_METHOD) == COMPILED_BYTES
    assert spark.conf.get(HUGE_METHOD, None) == before
    spark.conf.set(HUGE_METHOD, "9000")
    try:
        with compiled_methods(spark):
            assert spark.conf.get(HUGE_METHOD) == "9000"
        assert spark.conf.get(HUGE_METHOD) == "9000"
    finally:
        spark.conf.unset(HUGE_METHOD)
    assert materialize(spark.range(3)).count() == 3


def curated(spark, rows):
    """Curated rows of (id, day, debit, vendor)."""
    made = spark.createDataFrame(rows, "transaction_id string, transaction_date date, amount_debit decimal(18,2), vendor_normalised string")
    return made.select(
        "*", F.lit(0).cast("decimal(18,2)").alias("amount_credit"), F.col("transaction_id").alias("silver_id"), F.col("transaction_id").alias("bronze_id"),
        F.lit("tally").alias("source_software"), F.lit("csv").alias("source_type"), F.date_format("transaction_date", "yyyy-MM").alias("year_month"),
        F.lit("x").alias("embedding_text"), F.lit(0.9).cast("float").alias("quality_score"), F.lit("Rent").alias("category"), F.lit(1).alias("gold_version"),
    )


def test_vendors_meet_their_periods_as_numbers(spark):
    """keys of periods are made of the ranked rows, not of every day of every vendor."""
    days = [dt.date(2024, 12, 29) + dt.timedelta(days=n) for n in range(10)] + [dt.date(1969, 12, 28), dt.date(1969, 12, 29)]
    rows = [(f"t{k}", day, Decimal(k + 1), "v") for k, day in enumerate(days)]
    ranked = ranked_vendors(curated(spark, rows))
    assert "hashpartitioning(_kind" in plan(ranked) and "hashpartitioning(period_type" not in plan(ranked)
    want = {}
    for k, day in enumerate(days):
        year, week, _ = day.isocalendar()
        for period in (("daily", str(day)), ("weekly", f"{year}-W{week:02d}"), ("monthly", f"{day:%Y-%m}")):
            want[period] = want.get(period, 0) + k + 1
    assert {(r.period_type, r.period_key): int(r.amount) for r in ranked.collect()} == want
    assert ranked.columns == ["period_type", "period_key", "vendor", "amount", "rank"]


def test_stored_totals_are_not_shuffled_to_find_the_newest(spark, tmp_path):
    """the totals by day and vendor, about as many as transactions, meet the few days where they are."""
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    for load_id, amount in (("1", 5), ("2", 7)):
        ledger.append(curated(spark, [(f"t{load_id}", dt.date(2024, 1, 2), Decimal(amount), "v")]), "gold_transactions", load_id)
        refresh_summaries(ledger, load_id)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in plan(daily_partials(ledger))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    got = {(r.period_type, r.period_key): (int(r.total_debits), r.top_vendors, r.category_breakdown) for r in period_summaries(ledger).collect()}
    assert got == {p: (12, '[{"vendor":"v","amount":12.00}]', '{"Rent":12.00}') for p in (("daily", "2024-01-02"), ("weekly", "2024-W01"), ("monthly", "2024-01"))}


def test_reprocessed_rows_are_kept_without_texts(spark, orders, monkeypatch):
    """of the newest versions, only what the totals read is written down."""
    kept = []
    monkeypatch.setattr(large_checks, "materialize", lambda df: kept.append(df.columns) or materialize(df))
    found = QUERIES["reprocessed_period_summary"](spark, orders)
    assert kept == [["transaction_date", "amount_debit", "amount_credit", "gold_version"]]
    assert {r.version for r in found.collect()} == {2}


def test_a_workbook_made_later_has_the_same_bytes(monkeypatch):
    """damaged_workbooks failed when its loads were more than two seconds apart."""
    first = large_checks._book("a", 1, False)
    monkeypatch.setattr("time.time", lambda: 0.0)
    monkeypatch.setattr("time.localtime", lambda *_: (2001, 1, 1, 1, 1, 1, 0, 1, 0))
    assert large_checks._book("a", 1, False) == first
