"""What keeps tasks bounded: rows per partition, bytes that are not read, plans without joins or sorts."""

from pyspark.sql import functions as F

from bookflow.options import Options
from bookflow.plans.intake import ingest
from bookflow.plans.session import spread
from bookflow.sources import landing, workbook
from bookflow.sources import large_delimited as lx
from bookflow.tables import Ledger
from checks import large_checks
from checks.all_checks import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_by_partition(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_spread_counts_rows_not_splits(spark, tmp_path):
    """F4, F6 to F10, F13, F14, F16, F18: a file of one row group has as many splits as asked for, all but one empty."""
    path = str(tmp_path / "one")
    spark.range(5000).coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        one = spark.read.parquet(path)
        assert one.rdd.getNumPartitions() >= 8 and len(rows_by_partition(one)) == 1
        counts = rows_by_partition(spread(one, 200))
        assert len(counts) >= 25 and max(counts) <= 300 and sum(counts) == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows_by_partition(spread(spark.range(0), 200)) == []


CELLS = "file_hash string, sheet_idx int, sheet string, row_idx int, col_idx int, value string, is_string boolean"


def cells_of(spark, files):
    rows = [
        (name, s, f"S{s}", r, c, value, not value.isdigit())
        for name, sheets in files.items() for s, sheet in enumerate(sheets) for r, line in enumerate(sheet)
        for c, value in enumerate(line) if value is not None
    ]
    return spark.createDataFrame(rows, CELLS)


def test_workbooks_are_shuffled_once(spark):
    """no relation of a row per file is built on the driver, and cells are shuffled once."""
    cells = cells_of(spark, {
        "a": [[["x"]], [["Title"], ["Date", "Amount", "Amount", None, "Amount "], ["d1", "1", "-", None, "4"], [], ["d2", None, None, "9"]]],
        "b": [[["Only", "head"]]],
    })
    for mode in ("clean", "raw"):
        text = plan(workbook.read_workbooks(cells, mode))
        assert "Join" not in text and text.count("Exchange hashpartitioning") == 1
    got = {(r.file_hash, r.source_row_number): r for r in workbook.read_workbooks(cells).collect()}
    assert set(got) == {("a", 1), ("a", 2)}
    assert got["a", 1].headers == ["Date", "Amount", "Column_3", "Amount_1"]
    assert got["a", 1].raw == {"Date": "d1", "Amount": "1", "Column_3": None, "Amount_1": "4"}
    assert got["a", 2].raw == {"Date": "d2", "Amount": None, "Column_3": "9", "Amount_1": None} and got["a", 2].sheet_row == 5
    raw = {r.source_row_number: r.raw for r in workbook.read_workbooks(cells, "raw").collect()}
    assert raw[1] == {"Date": "d1", "Amount": "4", "Column_3": None}


def test_sheet_and_header_row_take_one_pass(spark):
    """cells are read once and files meet no second relation of themselves."""
    cells = cells_of(spark, {"a": [[["x"]], [["Title"], ["Date", "Amount"], ["1", "2"]]], "b": [[["1"]]]})
    picked, headed = workbook.pick_sheet(cells), workbook.detect_header_row(cells.filter("sheet_idx = 1 OR file_hash = 'b'"))
    assert "Join" not in plan(picked) and "Join" not in plan(headed)
    assert {tuple(r) for r in picked.collect()} == {("a", 1, "S1"), ("b", 0, "S0")}
    assert {tuple(r) for r in headed.collect()} == {("a", 1), ("b", 0)}


def test_large_file_is_no_row(spark, tmp_path):
    """a delimited file that is read over many tasks is never read as one value."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "big.csv").write_text("A,B\n" + "1,2\n" * 2000)
    (folder / "small.csv").write_text("A,B\n3,4\n")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        ledger = Ledger(spark, str(tmp_path / "db"))
        found = ingest(ledger, landing.scan_files(spark, str(folder)), "1", options=Options(split_above_bytes=1000)).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert {r.file_name: r.rows_written for r in found} == {"big.csv": 2000, "small.csv": 1}


def test_large_files_are_not_sorted(spark, tmp_path, monkeypatch):
    """lines keep the order they are read in, so no task holds the rows of a split."""
    (tmp_path / "big.csv").write_text("A,B\n" + "1,2\n" * 2000)
    written, write = [], lx.materialize
    monkeypatch.setattr(lx, "materialize", lambda df, folder=None: written.append(plan(df)) or write(df, folder))
    rows = lx.parse_large(spark, [str(tmp_path / "big.csv")]).rows
    cut = [text for text in written if "MapInArrow" in text]
    assert cut and not any(" Sort [" in text or "Exchange hashpartitioning" in text for text in cut)
    assert [r[0] for r in rows.select("source_row_number").orderBy("source_row_number").collect()] == list(range(1, 2001))


def test_csv_of_a_large_table_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    """no task reads the whole table; every row still comes out with its number."""
    lines = spark.range(50).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("id").alias("l_suppkey"),
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.lit(1.5).alias("l_extendedprice"),
    )
    lines.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(large_checks, "LINES_PER_FILE", 20)
    folder = large_checks.large_csv(spark, str(tmp_path))
    assert landing.scan_files(spark, folder).count() == 3
    rows = QUERIES["large_csv"](spark, str(tmp_path)).collect()
    assert {r.orderkey for r in rows} == {str(n) for n in range(50)}
    assert {r.last_number for r in rows} == {50} and {r.cents for r in rows} == {"150"}
