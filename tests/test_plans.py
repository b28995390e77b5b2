"""Contracts, skew-safe joins against brute force, suggestions, streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bookflow import contracts as ct
from bookflow.options import Options
from bookflow.plans import joins
from bookflow.plans.refine import map_batch
from bookflow.operators.mapping import layout_id
from bookflow.operators.memory import validate_suggestions
from bookflow.streaming.debounce import debounce, debounce_stream

TIGHT = Options(hot_key_rows=20, broadcast_rows=3)


def skewed(spark):
    """3,000 rows; a third share one key, some keys are null."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))
    )
    return spark.range(3000).select("id", key.alias("k"), (F.col("id") % 11).alias("v"))


def test_attach_totals_matches_a_window(spark):
    rows = skewed(spark)
    got = joins.attach_totals(rows, ["k"], {"total": F.sum("v"), "first": F.min("id")}, ["id"], TIGHT)
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.k, []).append(r)
    want = {r.id: (sum(x.v for x in groups[r.k]), min(x.id for x in groups[r.k])) for r in rows.collect()}
    assert {r.id: (r.total, r.first) for r in got.collect()} == want


@pytest.mark.parametrize("options", [TIGHT, Options()], ids=["salted", "broadcast"])
def test_lookup_join_keeps_every_row_once(spark, options):
    rows = skewed(spark)
    names = rows.select("k").distinct().filter("k is null or k <> 'k5'").withColumn("name", F.concat_ws("-", F.lit("n"), "k"))
    got = {r.id: r.name for r in joins.lookup_join(rows, names, ["k"], ["id"], options).collect()}
    want = {r.id: None if r.k == "k5" else "-".join(filter(None, ["n", r.k])) for r in rows.collect()}
    assert got == want


def minimal(spark, table, **values):
    base = {
        "bronze_transactions": {"bronze_id": "b", "source_type": "xlsx", "source_software": "manual_excel", "raw_content": "{}"},
        "gold_transactions": {
            "transaction_id": "t", "silver_id": "s", "bronze_id": "b", "source_software": "tally", "source_type": "csv",
            "transaction_date": dt.date(2024, 1, 15), "year_month": "2024-01", "embedding_text": "x", "quality_score": 0.85,
        },
    }[table]
    row = {**base, **values}
    contract = ct.CONTRACTS[table]
    schema = [f for f in contract.schema if f.name in row]
    from pyspark.sql.types import StructType

    return spark.createDataFrame([tuple(row[f.name] for f in schema)], StructType(schema)), contract


@pytest.mark.parametrize("table, values, accepted", [
    ("bronze_transactions", {}, True), ("bronze_transactions", {"source_type": "docx"}, False),
    ("bronze_transactions", {"source_software": "peachtree"}, False), ("bronze_transactions", {"raw_content": None}, False),
    *[("bronze_transactions", {"source_type": t}, True) for t in ct.SOURCE_TYPES],
    ("gold_transactions", {"quality_score": 0.85}, True), ("gold_transactions", {"quality_score": 0.5}, False),
    ("gold_transactions", {"quality_score": 0.7}, True), ("gold_transactions", {"embedding_text": None}, False),
])
def test_contract_cases(spark, table, values, accepted):
    df, contract = minimal(spark, table, **values)
    good, bad = ct.validate(df, contract, ["bronze_id"])
    assert (good.count(), bad.count()) == ((1, 0) if accepted else (0, 1))


def test_strict_mode_raises(spark):
    df, contract = minimal(spark, "bronze_transactions", source_type="docx")
    with pytest.raises(ValueError, match="source_type is not allowed"):
        ct.validate(df, contract, ["bronze_id"], strict=True)


def test_equal_rows_without_an_order(spark):
    df, contract = minimal(spark, "bronze_transactions")
    good, bad = ct.validate(df.unionByName(df).unionByName(df), contract)
    assert (good.count(), bad.count()) == (1, 2)


def test_defaults_and_net_amount(spark):
    contract = ct.CONTRACTS["silver_transactions"]
    df = spark.createDataFrame([(5000, None), (None, 10000)], "amount_debit int, amount_credit int")
    rows = ct.with_computed(ct.apply_defaults(df, contract), contract).collect()
    assert [float(r.net_amount) for r in rows] == [-5000.0, 10000.0] and rows[0].currency == "PKR"


def test_suggestions_reach_the_batch(spark):
    headers = ["Date", "Zzyx"]
    rows = spark.createDataFrame(
        [("f", "b", "unknown", headers, 1, {"Date": "2024-01-01", "Zzyx": "Shell"}, 10)],
        "file_hash string, batch_id string, source_software string, headers array<string>, source_row_number int, "
        "raw map<string,string>, file_size_bytes bigint",
    )
    answers = rows.select(
        layout_id().alias("layout_id"), F.col("headers").alias("columns"),
        F.lit('{"mappings": {"Zzyx": "vendor", "Nope": "vendor"}}').alias("response"),
    )
    batch = map_batch(rows, suggestions=validate_suggestions(answers))
    result = batch.results.first()
    assert result.llm_used and result.llm_rejected == ["'Nope': not in original columns — possible injection"]
    assert result.column_mapping == '{"Date":"transaction_date","Zzyx":"vendor"}' and result.needs_user_review == ["Zzyx"]
    assert batch.rows.first().vendor == "Shell"


def test_row_gate(spark):
    rows = spark.range(30).select(
        F.when(F.col("id") < 10, "small").otherwise("large").alias("file_hash"), F.lit("b").alias("batch_id"),
        F.lit("tally").alias("source_software"), F.array(F.lit("Date")).alias("headers"),
        F.col("id").cast("int").alias("source_row_number"), F.create_map(F.lit("Date"), F.lit("1")).alias("raw"),
        F.lit(1).cast("bigint").alias("file_size_bytes"),
    )
    batch = map_batch(rows, options=Options(max_rows_per_file=15))
    results = {r.file_hash: r for r in batch.results.collect()}
    assert batch.rows.count() == 30 and all(r.success for r in results.values())
    assert results["large"].security_warnings[0].startswith("File contains 20 rows, exceeding the 15 row limit.")
    batch = map_batch(rows, options=Options(max_rows_per_file=15, enforce_gates=True))
    errors = {r.file_hash: r.error for r in batch.results.collect()}
    assert errors["small"] is None and errors["large"].startswith("File contains 20 rows, exceeding the 15 row limit.")
    assert batch.rows.count() == 10 and batch.refused.count() == 20


def test_contradicting_suggestions_are_not_used(spark):
    rows = spark.createDataFrame(
        [("f", "b", "unknown", ["Date", "Zzyx"], 1, {"Date": "2024-01-01", "Zzyx": "Shell"}, 10)],
        "file_hash string, batch_id string, source_software string, headers array<string>, source_row_number int, "
        "raw map<string,string>, file_size_bytes bigint",
    )
    answers = rows.select(
        layout_id().alias("layout_id"), F.col("headers").alias("columns"),
        F.explode(F.array(F.lit('{"mappings": {"Zzyx": "vendor"}}'), F.lit('{"mappings": {"Zzyx": "description"}}'))).alias("response"),
    )
    batch = map_batch(rows, suggestions=validate_suggestions(answers))
    result = batch.results.first()
    assert batch.rows.count() == 1 and result.column_mapping == '{"Date":"transaction_date"}'
    assert result.llm_rejected == ["'Zzyx': answers name both 'description' and 'vendor' — none is used"]


def test_reserved_names_beside_their_renamed_form(spark):
    from bookflow.functions.values import rename_reserved_keys

    raw = spark.sql("SELECT map('quality_score', '1', 'raw_quality_score', '2', 'x', '3') AS raw")
    assert raw.select(rename_reserved_keys(F.col("raw"))).first()[0] == {"raw_quality_score": "2", "x": "3"}


def test_append_checks_the_contract(spark, tmp_path):
    from bookflow.tables import Ledger

    ledger = Ledger(spark, str(tmp_path / "db"))
    ledger.ensure_tables()
    good, _ = minimal(spark, "bronze_transactions")
    bad, _ = minimal(spark, "bronze_transactions", source_type="docx")
    assert ledger.append(good.unionByName(bad), "bronze_transactions", "one") == 1
    assert ledger.read("bronze_transactions").count() == 1
    assert ledger.rejected("bronze_transactions").first().reasons == ["source_type is not allowed"]
    assert ledger.append(good, "bronze_transactions", "two", unique=True) == 1
    with pytest.raises(ValueError, match="not allowed"):
        ledger.append(bad, "bronze_transactions", "three", strict=True)
    assert ledger.read("bronze_transactions").filter("load_id = 'three'").count() == 0


def test_prior_period_across_gaps(spark):
    from bookflow.operators import curate

    keys = [("monthly", "2024-01"), ("monthly", "2024-02"), ("monthly", "2024-06"), ("weekly", "2020-W53"), ("weekly", "2021-W01"),
            ("weekly", "2021-W03"), ("daily", "2024-02-29"), ("daily", "2024-03-01"), ("daily", "2024-03-03")]
    totals = spark.createDataFrame([(*k, 100 * (i + 1)) for i, k in enumerate(keys)], "period_type string, period_key string, net_cashflow int")
    got = {r.period_key: r.vs_prior_period_pct for r in curate.vs_prior_period(totals).collect()}
    assert {k for k, v in got.items() if v is not None} == {"2024-02", "2021-W01", "2024-03-01"} and got["2024-02"] == 100


def test_duplicates_of_stored_rows(spark):
    from bookflow.operators.clean import mark_duplicates

    schema = "silver_id string, transaction_date date, net_amount decimal(18,2), vendor_raw string, description_raw string"
    day = dt.date(2024, 1, 1)
    from decimal import Decimal as D

    rows = spark.createDataFrame([("a", day, D(5), "Shell", "x"), ("b", day, D(5), "shell", "x"), ("c", day, D(6), None, "x"), ("d", day, D(6), None, "x")], schema)
    marked = {r.silver_id: r.duplicate_of for r in mark_duplicates(rows).collect()}
    assert marked == {"a": None, "b": "a", "c": None, "d": None}
    stored = spark.createDataFrame([("z", day, D(5), "SHELL", "y")], schema).withColumn("is_duplicate", F.lit(False))
    marked = {r.silver_id: (r.duplicate_of, r.dedup_confidence) for r in mark_duplicates(rows, stored=stored).collect()}
    assert marked["a"][0] == marked["b"][0] == "z" and round(marked["a"][1], 2) == 0.8 and marked["c"] == (None, None)
    long = "v" * 300
    far = spark.createDataFrame([("a", day, D(5), long + "1", "x"), ("b", day, D(5), long + "2", "x")], schema)
    assert mark_duplicates(far).filter("is_duplicate").count() == 0


def test_debounce(spark):
    start = dt.datetime(2024, 1, 1)
    events = [("a", 0), ("a", 1.5), ("a", 3.4), ("a", 5.4), ("b", 0), ("a", 100)]
    df = spark.createDataFrame([(k, start + dt.timedelta(seconds=s)) for k, s in events], "k string, ts timestamp")
    got = sorted((r.key, r.events, (r.fires_at - start).total_seconds()) for r in debounce(df, "k", "ts").collect())
    assert got == [("a", 1, 7.4), ("a", 1, 102.0), ("a", 3, 5.4), ("b", 1, 2.0)]


def test_debounce_stream_agrees_up_to_the_watermark(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("a" if i % 3 else "b", start + dt.timedelta(seconds=i * i / 7)) for i in range(60)], "k string, ts timestamp"
    )
    df.write.parquet(str(tmp_path / "in"))
    query = (
        debounce_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "k", "ts").writeStream
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).format("parquet").start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    streamed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {tuple(r) for r in debounce(df, "k", "ts").collect()}
    assert streamed <= batch and len(streamed) > len(batch) * 0.8
