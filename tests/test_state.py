"""Status log, summaries by load, windows handed over at the end of a stream."""

import datetime as dt
import random

from pyspark.sql import functions as F

from bookflow.operators.curate import period_summary
from bookflow.operators.status import NEXT, fold_statuses, settled_steps
from bookflow.plans.summaries import period_summaries, refresh_summaries
from bookflow.streaming.debounce import windowed_rest, windowed_totals
from bookflow.tables import Ledger

DAY = dt.datetime(2024, 1, 1)


def folded(rows):
    """The fold in plain code."""
    out = {}
    low = (False, DAY)
    for key, status, at, place in sorted(
        set((k, s or "", a, p) for k, s, a, p in rows),
        key=lambda r: ((r[2] is not None, r[2]) if r[2] else low, (r[3] is not None, r[3] or 0), r[1]),
    ):
        state, refused, n = out.get(key, ("pending", 0, 0))
        if status in NEXT.get(state, []):
            state = status
        elif status != state:
            refused += 1
        out[key] = state, refused, n + 1
    return out


def test_fold_statuses_matches_plain_code(spark):
    draw = random.Random(3)
    names = [*NEXT, "lost", None]
    rows = [
        (
            draw.choice(["hot", "hot", "a", "b", None]), draw.choice(names),
            draw.choice([None, DAY + dt.timedelta(hours=draw.randrange(400))]), draw.choice([None, 0, 1]),
        )
        for _ in range(600)
    ]
    rows += rows[:50]
    events = spark.createDataFrame(rows, "bronze_id string, status string, at timestamp, place int")
    for seconds in (3_600, 86_400, 10**9):
        got = {r.bronze_id: (r.processing_status, r.refused, r.steps) for r in fold_statuses(events, seconds).collect()}
        assert got == folded(rows)


def test_fold_statuses_without_steps(spark):
    assert fold_statuses(spark.createDataFrame([], "bronze_id string, status string, at timestamp, place int")).collect() == []


def test_settled_steps_reach_their_status(spark):
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "bronze_id string")
    got = fold_statuses(settled_steps(ids("a", "b"), ids("c"), F.lit(DAY))).collect()
    assert {r.bronze_id: r.processing_status for r in got} == {"a": "normalised", "b": "normalised", "c": "quarantined"}
    assert all(r.refused == 0 for r in got)


def gold(spark, rows):
    """Curated rows of (id, version, day, debit, credit, vendor)."""
    schema = "transaction_id string, gold_version int, transaction_date date, amount_debit decimal(18,2), amount_credit decimal(18,2), vendor_normalised string"
    from decimal import Decimal

    made = spark.createDataFrame([(i, v, d, Decimal(a), Decimal(b), n) for i, v, d, a, b, n in rows], schema)
    return made.select(
        "*", F.col("transaction_id").alias("silver_id"), F.col("transaction_id").alias("bronze_id"), F.lit("tally").alias("source_software"),
        F.lit("csv").alias("source_type"), F.date_format("transaction_date", "yyyy-MM").alias("year_month"), F.lit("x").alias("embedding_text"),
        F.lit(0.9).cast("float").alias("quality_score"), F.lit("Rent").alias("category"),
    )


def test_refreshed_summaries_equal_one_pass(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    day = lambda n: dt.date(2024, 1, 30) + dt.timedelta(days=n)
    loads = {
        "1": [(f"t{k}", 1, day(k % 5), k, 2 * k, f"v{k % 3}") for k in range(40)],
        "2": [(f"u{k}", 1, day(k % 9), k, k, "w") for k in range(30)] + [("alone", 1, day(200), 5, 0, None)],
        # Reprocessed: another amount, another month, the only row of its day gone elsewhere.
        "3": [("t3", 2, day(3), 100, 0, "v0"), ("t4", 2, day(60), 7, 0, "v1"), ("alone", 2, day(1), 5, 0, None)],
        "4": [("t4", 3, day(4), 8, 0, "v1")],
    }
    columns = ["period_type", "period_key", "total_debits", "total_credits", "transaction_count", "vs_prior_period_pct", "top_vendors", "category_breakdown"]
    rows = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    for load_id, made in loads.items():
        for _ in range(2 if load_id == "3" else 1):  # a load that is run again
            assert ledger.append(gold(spark, made), "gold_transactions", load_id) == 0
            refresh_summaries(ledger, load_id)
        assert rows(period_summaries(ledger)) == rows(period_summary(ledger.read_curated()))
    written = ledger.extra("period_refreshes").filter("load_id = '4' AND period_type = 'daily'").select("period_key").distinct().collect()
    # The days of both versions, and the days compared with them.
    assert {r.period_key for r in written} <= {str(day(n)) for n in (4, 5, 60, 61)}


def test_windowed_rest_adds_what_is_open(spark):
    events = spark.createDataFrame(
        [(DAY + dt.timedelta(hours=h), f"k{h % 2}", h) for h in range(72)], "ts timestamp, kind string, v int"
    )
    whole = windowed_totals(events, "ts", ["kind"], "v", "1 day")
    emitted = whole.filter(F.col("window_start") < F.lit(DAY + dt.timedelta(days=2)))
    rest = windowed_rest(events, emitted, "ts", ["kind"], "v", "1 day")
    assert sorted(emitted.unionAll(rest).collect()) == sorted(whole.collect())
    assert sorted(windowed_rest(events, emitted.limit(0), "ts", ["kind"], "v", "1 day").collect()) == sorted(whole.collect())


def test_ledger_files_are_written_small(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", 1, "1", None)], "transaction_id string, gold_version int, stored_in string, transaction_date date")
    ledger.append_extra(rows, "superseded", "2")
    files = [f.name for f in (tmp_path / "superseded" / "load_id=2").glob("*.parquet")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert [tuple(r) for r in ledger.extra("superseded").collect()] == [("a", 1, "1", None, "2")]
