"""Real files: landing rules, one ingest run after another, streaming with a restart, workbooks."""

import hashlib
import io
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from bookflow.options import Options
from bookflow.plans.intake import ingest
from bookflow.plans.refine import refine, store, summarize
from bookflow.functions.values import json_to_row
from bookflow.sources import landing, workbook, xlsx_cells
from bookflow.streaming.watch import record_files, stop, stream_files, watch
from bookflow.tables import Ledger


def xlsx(*sheets) -> bytes:
    """A minimal workbook of (name, rows) sheets; strings inline, numbers as numbers."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, (n, _) in enumerate(sheets))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="m" xmlns:r="r"><sheets>{names}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets)))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{rels}</Relationships>")
        for i, (_, rows) in enumerate(sheets):
            body = ""
            for r, row in enumerate(rows, 1):
                body += f'<row r="{r}">'
                for c, v in enumerate(row):
                    ref = f"{chr(65 + c)}{r}"
                    if isinstance(v, str):
                        body += f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
                    elif v is not None:
                        body += f'<c r="{ref}"><v>{v}</v></c>'
                body += "</row>"
            book.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet><sheetData>{body}</sheetData></worksheet>")
    return buffer.getvalue()


def rows_of(spark, content, mode="clean"):
    files = spark.createDataFrame([("f", bytearray(content))], "file_hash string, content binary")
    cells, failed = xlsx_cells.read_cells(files)
    rows = workbook.read_workbooks(cells, mode).orderBy("source_row_number").collect()
    return rows, failed.collect()


def test_workbook_fixtures(spark):
    rows, _ = rows_of(spark, xlsx(("T", [["Date", "Vendor", "Amount"], ["1", "Shell", 5000], ["2", "PTCL", 2.5]])))
    assert [r.raw for r in rows] == [
        {"Date": "1", "Vendor": "Shell", "Amount": "5000"}, {"Date": "2", "Vendor": "PTCL", "Amount": "2.5"},
    ]
    rows, _ = rows_of(spark, xlsx(
        ("T", [["My Company"], ["Ledger 2024"], [], ["Date", "Particulars", "Dr", "Cr", "Balance"],
               ["15/01/2024", "Shell", 4500, None, 100], ["16/01/2024", "PTCL", None, 1, "N/A"]]),
    ))
    assert rows[0].headers == ["Date", "Particulars", "Dr", "Cr", "Balance"] and len(rows) == 2
    rows, _ = rows_of(spark, xlsx(("T", [["تاریخ", "رقم"], ["1", 2], [None, None], ["3", 4]])))
    assert [r.raw["رقم"] for r in rows] == ["2", "4"] and [r.source_row_number for r in rows] == [1, 2]
    two = xlsx(("Summary", [["Total", "x"]]), ("Transactions", [["Date", "Amount"]] + [[str(i), i] for i in range(20)]))
    rows, _ = rows_of(spark, two)
    assert len(rows) == 20 and rows[0].headers == ["Date", "Amount"]
    rows, _ = rows_of(spark, xlsx(("T", [["Date", "", "Amount", "Amount", "Amount "], ["1", None, 2, 3, 4]])))
    assert rows[0].headers == ["Date", "Amount", "Amount.1", "Amount_1"]


def test_tolerant_and_damaged_workbooks(spark):
    rows, _ = rows_of(spark, xlsx(("T", [["Date", "Note"], ["-", "N/A"]])), "raw")
    assert rows[0].raw == {"Date": "-", "Note": "N/A"}
    rows, failed = rows_of(spark, b"PK\x03\x04 not a zip")
    assert rows == [] and "BadZipFile" in failed[0].error


@pytest.fixture
def vault(tmp_path):
    folder = tmp_path / "vault"
    folder.mkdir()
    files = {
        "a.csv": b"Date,Particulars,Debit,Credit\n15/01/2024,Shell petrol,4500,\n16/01/2024,PTCL,,900\n,,,\nTotal,4500,900,\n",
        "hbl_statement.csv": "Date;Particulars;Withdrawal;Deposit\n2024-01-20;Café;1,5;\n".encode("cp1252"),
        "empty.csv": b"A,B\n", "x.pdf": b"%PDF", "~$r.csv": b"A\n1", "z.txt": b"A\n1", "zero.csv": b"",
        "bad.xlsx": b"PK junk", "tally_export.xlsx": xlsx(("T", [["Date", "Particulars", "Dr"], ["17/01/2024", "Rent", 7000]])),
    }
    for name, content in files.items():
        (folder / name).write_bytes(content)
    (folder / "copy.csv").write_bytes(files["a.csv"])
    (folder / "sub").mkdir()
    (folder / "sub" / "deep.csv").write_bytes(b"A\n1")
    return folder


def test_ingest_then_refine(spark, vault, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "db"))
    assert len(ledger.missing_tables()) == 7
    ledger.ensure_tables()
    ledger.ensure_tables()
    files = landing.scan_files(spark, str(vault))
    assert [r.file_name for r in landing.list_files(files).collect()] == [
        "a.csv", "bad.xlsx", "copy.csv", "empty.csv", "hbl_statement.csv", "tally_export.xlsx", "x.pdf",
    ]
    results = {r.file_name: r for r in ingest(ledger, files, "one").collect()}
    assert {n: (r.success, r.rows_written) for n, r in results.items()} == {
        "a.csv": (True, 2), "hbl_statement.csv": (True, 1), "empty.csv": (True, 0), "x.pdf": (False, 0),
        "bad.xlsx": (False, 0), "tally_export.xlsx": (True, 1),
    }
    assert results["x.pdf"].error.startswith("Unsupported source_type for Bronze ingestion: pdf")
    audit = {r[0]: r[1] for r in ledger.sql("SELECT operation, count(*) FROM pipeline_audit_log GROUP BY 1").collect()}
    assert audit == {
        "file_detected": 6, "duplicate_file_skipped": 1, "bronze_ingest_success": 3, "bronze_ingest_empty": 1,
        "bronze_ingest_failed": 2,
    }
    # Known files are skipped; the same load run again replaces itself.
    ingest(ledger, files, "two")
    ingest(ledger, files, "one")
    raw = ledger.read("bronze_transactions")
    assert raw.count() == 4 and raw.select("ingestion_batch_id").distinct().count() == 3
    assert {r[0] for r in raw.select("processing_status").distinct().collect()} == {"pending"}

    rows = raw.select(
        "bronze_id", F.col("source_file_hash").alias("file_hash"), F.col("ingestion_batch_id").alias("batch_id"),
        "source_software", "source_type", F.from_json("raw_headers", "array<string>").alias("headers"),
        "source_row_number", json_to_row(F.col("raw_content")).alias("raw"), F.lit(100).cast("bigint").alias("file_size_bytes"),
    )
    for _ in range(2):  # run again, the load replaces itself and the memory counts nothing twice
        memory = ledger.version("bronze_schema_mappings", before="m1").drop("load_id")
        store(ledger, refine(rows, memory), "m1")
        summarize(ledger, "m1")
    gold = {r.vendor_raw: r for r in ledger.read_curated().collect()}
    assert float(gold["Shell petrol"].net_amount) == -4500 and gold["Shell petrol"].category == "Fuel & Transport"
    assert gold["Rent"].embedding_text == "On 17 January 2024, PKR 7,000 was paid to Rent — Rent"
    stats = {r.table_name: r.row_count for r in ledger.table_stats().collect()}
    assert stats["gold_transactions"] == stats["silver_transactions"] == 4 and stats["silver_quarantine"] == 0
    assert ledger.sql("SELECT * FROM gold_period_summaries WHERE period_type = 'monthly'").count() == 1
    assert ledger.read("bronze_schema_mappings").filter("times_seen = 1").count() == 11


def test_size_gate(spark, vault):
    inside, above = landing.split_by_size(landing.scan_files(spark, str(vault)), Options(max_file_mb=0))
    assert inside.filter("length > 0").count() == 0
    assert above.filter("error like 'File size 0.0MB exceeds maximum 0MB%'").count() == 7


def test_only_named_suffixes_are_read(spark, vault):
    files = landing.scan_files(spark, str(vault))
    names = {r[0].rsplit("/", 1)[1] for r in landing.by_suffix(files, [".csv"]).select("path").collect()}
    assert names == {"a.csv", "copy.csv", "empty.csv", "hbl_statement.csv"}
    # Reading any file above the limit fails, so this passes only because the workbooks are never opened.
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 200)
    try:
        files = landing.scan_files(spark, str(vault))
        assert landing.by_suffix(files, [".csv"]).selectExpr("sum(length(content))").first()[0] > 0
        with pytest.raises(Exception, match="(?i)length"):
            landing.by_suffix(files, [".xlsx"]).selectExpr("sum(length(content))").first()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_stream_restart(spark, vault, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "db"))
    ledger.ensure_tables()
    seen = []

    def run():
        query = watch(ledger, str(vault), str(tmp_path / "ck"), on_result=lambda r: seen.append(r.count()))
        query.awaitTermination()
        stop(ledger, query)

    run()
    assert ledger.read("bronze_transactions").count() == 4
    run()
    assert ledger.read("bronze_transactions").count() == 4 and len(seen) == 1
    (vault / "again.csv").write_bytes((vault / "a.csv").read_bytes())
    (vault / "new.csv").write_bytes(b"Date,Amount\n1,2\n")
    run()
    assert ledger.read("bronze_transactions").count() == 5 and seen[1:] == [1]
    notes = ledger.sql("SELECT operation, count(*) FROM pipeline_audit_log WHERE operation LIKE 'watcher%' GROUP BY 1")
    assert {tuple(r) for r in notes.collect()} == {("watcher_started", 3), ("watcher_stopped", 3)}
    # A new checkpoint starts over without touching what earlier watchers stored.
    query = watch(ledger, str(vault), str(tmp_path / "ck2"))
    query.awaitTermination()
    assert ledger.read("bronze_transactions").count() == 5


def test_recorded_files_with_bounded_state(spark, tmp_path):
    ledger, folder = Ledger(spark, str(tmp_path / "db")), tmp_path / "in"
    folder.mkdir()

    def run(name: str, content: bytes) -> int:
        (folder / name).write_bytes(content)
        query = record_files(ledger, stream_files(spark, str(folder)), str(tmp_path / "ck"), keep_for="1 second")
        query.awaitTermination()
        return max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])

    held = []
    for n in range(3):
        held.append(run(f"f{n}.csv", b"Date,Amount\n%d,1\n" % n))
        time.sleep(2)
    # The hash of the first file has left the state long ago; the stored hashes still know it.
    held.append(run("late copy.csv", b"Date,Amount\n0,1\n"))
    assert max(held) <= 2
    names = [r.file_name for r in ledger.extra("known_files").orderBy("file_name").collect()]
    assert names == ["f0.csv", "f1.csv", "f2.csv"]


def test_hash_look_up_skips_row_groups(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "db"))
    for load in range(3):
        hashes = spark.range(60_000).select(F.sha2(F.concat_ws("-", F.lit(load), "id"), 256).alias("file_hash"))
        ledger.append_extra(hashes.coalesce(1), "file_results", str(load))
    wanted = hashlib.sha256(b"1-4711").hexdigest()
    found = ledger.extra("file_results").filter(F.col("file_hash") == wanted)
    assert [r.load_id for r in found.collect()] == ["1"]
    plan = found._jdf.queryExecution().executedPlan()  # the one that was just run
    leaves = plan.collectLeaves()
    rows = [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())]
    # All ranges of the three files hold the hash; Bloom filters leave one file to read.
    assert sum(rows) <= 60_000


@pytest.mark.parametrize("lost", ["Vch Type", "Branch Code", "Date"])
def test_raw_json_round_trip_compares_all_cells(spark, monkeypatch, lost):
    from checks import mapping_checks
    from checks.registry import QUERIES

    monkeypatch.setattr(mapping_checks, "json_to_row", lambda c: F.map_filter(json_to_row(c), lambda k, _: k != lost))
    with pytest.raises(Exception, match="cells changed"):
        QUERIES["raw_json_round_trip"](spark, "/root/testdata/sf0.001").collect()
