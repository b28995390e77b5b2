"""Landing folder, delimited files, workbook cells, raw table and streams.

Files are derived from the tables: either as a relation of names and bytes, one small file per row, or as real files
that Spark writes to the shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bookflow.functions import files as fx
from bookflow.functions import values as vx
from bookflow.functions.text import strip
from bookflow.plans.intake import ingest, raw_content
from bookflow.plans.session import shared_folder
from bookflow.sources import delimited as dx
from bookflow.sources import landing, workbook
from bookflow.streaming.debounce import debounce, debounce_rest, debounce_stream, windowed_totals
from bookflow.streaming.watch import manifest_stream, stop, stream_files, watch
from bookflow.tables import Ledger
from checks.data import pick, sql_list
from checks.functions_checks import SQL_CONFIDENCE, SQL_IGNORED, SQL_NAMED, SQL_SOFTWARE, SQL_SUPPORTED, named_files
from checks.registry import check, table


def scratch(spark, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written_csv(spark, sf_dir, source: str, columns: list[str]) -> str:
    """A landing folder with ``source`` as CSV files with a header."""
    folder = scratch(spark, "landing")
    table(spark, sf_dir, source).select(*columns).write.csv(folder, header=True)
    return folder


# --- files as a relation --------------------------------------------------------------------------------


def document_files(spark, sf_dir):
    """path, length and content, one file per document; every tenth is empty."""
    text = F.when(F.col("doc_id") % 10 == 9, "").otherwise(F.col("text"))
    content = F.encode(text, "UTF-8")
    path = F.concat(F.lit("/landing/"), "lang", F.lit("_"), F.col("doc_id").cast("string"), F.lit(".csv"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", path.alias("path"), F.octet_length(content).cast("bigint").alias("length"),
        content.alias("content"),
    )


SQL_FILES = """files AS (SELECT doc_id, lang, '/landing/' || lang || '_' || doc_id || '.csv' AS file_path,
  lang || '_' || doc_id || '.csv' AS file_name, CASE WHEN doc_id % 10 = 9 THEN '' ELSE text END AS text FROM documents),
manifest AS (SELECT *, sha256(text) AS file_hash, octet_length(encode(text)) AS file_size_bytes FROM files WHERE text <> '')"""


@check(
    "drop_empty_files",
    f"WITH {SQL_FILES} SELECT file_path AS path, file_size_bytes AS length FROM manifest",
)
def _(spark, sf_dir):
    return landing.drop_empty_files(document_files(spark, sf_dir)).select("path", "length")


def document_manifest(spark, sf_dir):
    files = landing.drop_empty_files(document_files(spark, sf_dir))
    return landing.file_manifest(files, F.lit("2024-01-31 12:00:00").cast("timestamp"))


@check(
    "file_manifest",
    f"""WITH {SQL_FILES} SELECT file_path, file_name, 'csv' AS source_type, 'unknown' AS source_software,
    CAST(0.4 AS DOUBLE) AS detection_conf, file_hash, file_size_bytes, '2024-01-31T12:00:00.000000' AS detected_at FROM manifest""",
)
def _(spark, sf_dir):
    return document_manifest(spark, sf_dir)


def fresh_and_skipped(spark, sf_dir):
    known = table(spark, sf_dir, "documents").filter("lang = 'fr' and doc_id % 10 <> 9").select(
        fx.fingerprint(F.encode("text", "UTF-8")).alias("file_hash")
    )
    return landing.drop_known_files(document_manifest(spark, sf_dir), known)


SQL_FRESH = f"""{SQL_FILES}, known AS (SELECT DISTINCT sha256(text) AS h FROM documents WHERE lang = 'fr' AND doc_id % 10 <> 9),
fresh AS (SELECT min(file_path) AS file_path, file_hash FROM manifest WHERE file_hash NOT IN (SELECT h FROM known) GROUP BY file_hash)"""


@check("drop_known_files", f"WITH {SQL_FRESH} SELECT file_path, file_hash FROM fresh")
def _(spark, sf_dir):
    return fresh_and_skipped(spark, sf_dir)[0].select("file_path", "file_hash")


@check(
    "duplicate_file_skipped",
    f"WITH {SQL_FRESH} SELECT file_path, file_hash FROM manifest WHERE file_path NOT IN (SELECT file_path FROM fresh)",
)
def _(spark, sf_dir):
    return fresh_and_skipped(spark, sf_dir)[1].select("file_path", "file_hash")


@check(
    "route_by_type",
    f"""WITH {SQL_NAMED} SELECT o_orderkey, CASE WHEN source_type = 'csv' THEN 'delimited' WHEN source_type = 'xlsx' THEN 'workbook'
    ELSE 'Unsupported source_type for Bronze ingestion: ' || source_type || '. PDF and JSON parsers are handled separately.' END AS route FROM typed""",
)
def _(spark, sf_dir):
    named = named_files(spark, sf_dir).withColumn("source_type", fx.source_type(F.col("file_name")))
    csv, books, other = landing.route_by_type(named)
    return (
        csv.select("o_orderkey", F.lit("delimited").alias("route"))
        .unionByName(books.select("o_orderkey", F.lit("workbook").alias("route")))
        .unionByName(other.select("o_orderkey", F.col("error").alias("route")))
    )


@check(
    "list_files",
    f"""WITH {SQL_NAMED} SELECT file_name, 7 AS file_size_bytes FROM typed WHERE {SQL_SUPPORTED} AND NOT {SQL_IGNORED}""",
)
def _(spark, sf_dir):
    named = named_files(spark, sf_dir).select(
        F.concat(F.lit("/in/"), "file_name").alias("path"), F.lit(7).alias("length"), "file_name"
    )
    return landing.list_files(named.filter(landing.wanted(F.col("file_name"))).drop("file_name"))


@check(
    "split_by_size",
    """SELECT doc_id, n_chars * 16384 <= 52428800 AS inside, CASE WHEN n_chars * 16384 > 52428800 THEN 'File size ' ||
    printf('%.1f', n_chars * 16384 / 1048576.0) || 'MB exceeds maximum 50MB. Split the file and upload in parts.' END AS error FROM documents""",
)
def _(spark, sf_dir):
    sized = table(spark, sf_dir, "documents").select(
        "doc_id", (F.col("n_chars") * 16384).alias("length"), F.encode("lang", "UTF-8").alias("content")
    )
    inside, above = landing.split_by_size(sized)
    return inside.select("doc_id", F.lit(True).alias("inside"), F.lit(None).cast("string").alias("error")).unionByName(
        above.select("doc_id", F.lit(False).alias("inside"), "error")
    )


# --- real files -----------------------------------------------------------------------------------------


@check(
    "scan_files",
    """SELECT sum(octet_length(encode(c_custkey || ',' || c_name || ',' || c_mktsegment)) + 1) AS bytes, true AS all_csv FROM customer""",
)
def _(spark, sf_dir):
    folder = scratch(spark, "landing")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment").write.csv(folder)
    found = landing.scan_files(spark, folder)
    return found.agg(
        F.sum("length").alias("bytes"), F.bool_and(F.col("path").endswith(".csv")).alias("all_csv")
    )


SQL_INGESTED = """SELECT CAST(c_custkey AS VARCHAR) AS custkey, c_name AS name, c_mktsegment AS segment, 'pending' AS status,
  '["c_custkey","c_name","c_mktsegment"]' AS headers, true AS numbered FROM customer"""


def ingested(ledger):
    raw = ledger.read("bronze_transactions").withColumn("row", vx.json_to_row(F.col("raw_content")))
    return raw.select(
        F.col("row.c_custkey").alias("custkey"), F.col("row.c_name").alias("name"),
        F.col("row.c_mktsegment").alias("segment"), F.col("processing_status").alias("status"),
        F.col("raw_headers").alias("headers"), (F.col("source_row_number") > 0).alias("numbered"),
    )


@check("ingest", SQL_INGESTED)
def _(spark, sf_dir):
    folder = written_csv(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    ledger = Ledger(spark, scratch(spark, "ledger"))
    ledger.ensure_tables()
    ingest(ledger, landing.scan_files(spark, folder), "first")
    # The second run finds every file known and adds nothing.
    ingest(ledger, landing.scan_files(spark, folder), "second")
    return ingested(ledger)


@check("stream_files", SQL_INGESTED)
def _(spark, sf_dir):
    folder = written_csv(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    ledger = Ledger(spark, scratch(spark, "ledger"))
    ledger.ensure_tables()
    checkpoint = scratch(spark, "checkpoint")
    for _ in range(2):  # the second start resumes from the checkpoint and finds nothing new
        query = watch(ledger, folder, checkpoint)
        query.awaitTermination()
        stop(ledger, query)
    return ingested(ledger)


@check(
    "table_stats",
    """SELECT * FROM (VALUES ('bronze_transactions', (SELECT count(*) FROM supplier)), ('silver_transactions', 0), ('silver_quarantine', 0),
    ('gold_transactions', 0), ('gold_period_summaries', 0)) t(table_name, row_count)""",
)
def _(spark, sf_dir):
    folder = written_csv(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    ledger = Ledger(spark, scratch(spark, "ledger"))
    ledger.ensure_tables()
    ingest(ledger, landing.scan_files(spark, folder), "first")
    return ledger.table_stats().filter("table_name <> 'pipeline_audit_log'")


@check(
    "audit_log",
    """SELECT 'bronze_ingest_success' AS operation, 'success' AS status, (SELECT count(*) FROM supplier) AS rows_affected""",
)
def _(spark, sf_dir):
    folder = written_csv(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    ledger = Ledger(spark, scratch(spark, "ledger"))
    ledger.ensure_tables()
    ingest(ledger, landing.scan_files(spark, folder), "first")
    return ledger.sql(
        """SELECT operation, status, sum(rows_affected) AS rows_affected FROM pipeline_audit_log
        WHERE operation = 'bronze_ingest_success' GROUP BY ALL"""
    )


@check("stream_manifest", "SELECT count(*) AS rows FROM nation")
def _(spark, sf_dir):
    folder = written_csv(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    # A second copy of the same files: the stream keeps one of each hash.
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.mode("append").csv(folder, header=True)
    out = scratch(spark, "manifest")
    query = (
        manifest_stream(stream_files(spark, folder)).writeStream.format("parquet")
        .option("checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    kept = spark.read.parquet(out).select("file_path")
    lines = spark.read.option("header", True).csv(folder).withColumn("file_path", F.col("_metadata.file_path"))
    return lines.join(kept, "file_path", "left_semi").agg(F.count("*").alias("rows"))


# --- delimited files ------------------------------------------------------------------------------------

DELIMITERS = [",", "\t", ";", "|"]


def order_files(spark, sf_dir):
    """One delimited file per order: quotes, line breaks in quotes, blank, short, long and total rows."""
    key, d = F.col("o_orderkey"), F.col("d")
    day, customer, cents = F.date_format("o_orderdate", "dd/MM/yyyy"), F.col("o_custkey").cast("string"), F.col("c")

    def line(*fields):
        return F.concat_ws("", *[x for f in fields for x in (f, d)][:-1])

    lit = F.lit
    lines = F.array_compact(F.array(
        line(lit("Date"), lit('"Amount"'), lit(" Vendor "), lit("Note")),
        line(day, F.concat(lit('"1,'), cents, lit('"')), F.concat(lit("  Customer "), customer, lit(" ")),
             F.concat(lit('"say ""'), "o_orderpriority", lit('""\nline two"'))),
        lit(""),
        line(lit(""), lit(" "), lit(""), lit("")),
        line(day, cents, lit("Café")),
        F.when(key % 5 == 0, line(day, cents, lit("V"), lit("n"), lit("one"))),
        F.when(key % 7 == 0, line(day, cents, lit("V"), lit("n"), lit("one"), lit("two"))),
        line(day, lit("7"), lit("last"), lit("row")),
        line(lit(""), lit("Grand Total"), lit("9"), lit("")),
        line(lit(" KUL "), lit("9"), lit(""), lit("")),
    ))
    end = F.when(key % 2 == 0, "\r\n").otherwise("\n")
    text = F.replace(F.array_join(lines, "\n"), lit("\n"), end)
    content = (
        F.when(key % 3 == 0, F.encode(text, "UTF-8"))
        .when(key % 3 == 1, F.concat(F.unhex(lit("EFBBBF")), F.encode(text, "UTF-8")))
        .otherwise(F.encode(text, "ISO-8859-1"))
    )
    return (
        table(spark, sf_dir, "orders")
        .withColumn("d", pick(DELIMITERS, key % 4)).withColumn("c", (key * 37 % 1000).cast("string"))
        .select(key, key.cast("string").alias("file_hash"), content.alias("content"))
    )


SQL_RECORDS = """records AS (
  SELECT o_orderkey, CAST(o_orderkey * 37 % 1000 AS VARCHAR) AS c, strftime(o_orderdate, '%d/%m/%Y') AS day, o_custkey, o_orderpriority FROM orders),
rows AS (
  SELECT o_orderkey, 1 AS row_no, day, '1,' || c AS amount, 'Customer ' || o_custkey AS vendor,
    'say "' || o_orderpriority || '"' || chr(10) || 'line two' AS note, '[]' AS overflow FROM records
  UNION ALL SELECT o_orderkey, 2, day, c, 'Café', NULL, '[]' FROM records
  UNION ALL SELECT o_orderkey, 3, day, c, 'V', 'n', '["one"]' FROM records WHERE o_orderkey % 5 = 0
  UNION ALL SELECT o_orderkey, 3 + CAST(o_orderkey % 5 = 0 AS INTEGER) + CAST(o_orderkey % 7 = 0 AS INTEGER), day, '7', 'last', 'row', '[]' FROM records)"""


@check("parse_delimited", f"WITH {SQL_RECORDS} SELECT * FROM rows")
def _(spark, sf_dir):
    rows, _ = dx.explode_records(dx.parse_delimited(order_files(spark, sf_dir)))
    return rows.select(
        "o_orderkey", F.col("source_row_number").alias("row_no"), F.col("raw.Date").alias("day"),
        F.col("raw.Amount").alias("amount"), F.col("raw.Vendor").alias("vendor"), F.col("raw.Note").alias("note"),
        F.to_json("overflow").alias("overflow"),
    )


@check(
    "reject_long_rows",
    """SELECT o_orderkey, 3 + CAST(o_orderkey % 5 = 0 AS INTEGER) AS row_no, '2 values past the last header' AS error FROM orders WHERE o_orderkey % 7 = 0""",
)
def _(spark, sf_dir):
    _, rejected = dx.explode_records(dx.parse_delimited(order_files(spark, sf_dir)))
    return rejected.select("o_orderkey", F.col("source_row_number").alias("row_no"), "error")


@check(
    "parse_metadata",
    f"""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'utf-8' ELSE 'utf-8-sig' END AS encoding,
    CAST([0.99, 1.0, 0.73][o_orderkey % 3 + 1] AS DOUBLE) AS encoding_confidence, [',', chr(9), ';', '|'][o_orderkey % 4 + 1] AS delimiter,
    3 + CAST(o_orderkey % 5 = 0 AS INTEGER) + CAST(o_orderkey % 7 = 0 AS INTEGER) AS total_rows, 4 AS total_cols, 'chardet_csv' AS parse_method FROM orders""",
)
def _(spark, sf_dir):
    parsed = dx.parse_delimited(order_files(spark, sf_dir))
    return dx.parse_metadata(parsed).withColumn("o_orderkey", F.col("file_hash").cast("bigint")).drop("file_hash")


@check("raw_content", f"""WITH {SQL_RECORDS} SELECT o_orderkey, row_no, replace(CAST(json_object('Date', day, 'Amount', amount, 'Vendor', vendor, 'Note', note) AS VARCHAR) ||
  CASE WHEN overflow = '[]' THEN '' ELSE ',"None":' || overflow || '}}' END, '}},"None"', ',"None"') AS raw_content FROM rows""")
def _(spark, sf_dir):
    rows, _ = dx.explode_records(dx.parse_delimited(order_files(spark, sf_dir)))
    return rows.select(
        "o_orderkey", F.col("source_row_number").alias("row_no"),
        raw_content(F.col("raw"), F.col("overflow")).alias("raw_content"),
    )


def encoded_documents(spark, sf_dir):
    """Whole documents as UTF-8, with byte-order mark, or as a one-byte encoding where their letters allow it."""
    n, text = F.col("doc_id") % 3, F.col("text")
    latin = (n == 2) & ~text.rlike(r"[^\x00-\xFF]")
    content = (
        F.when(n == 1, F.concat(F.unhex(F.lit("EFBBBF")), F.encode(text, "UTF-8")))
        .when(latin, F.encode(text, "ISO-8859-1")).otherwise(F.encode(text, "UTF-8"))
    )
    return table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))


SQL_ENCODED = r"""kinds AS (SELECT doc_id, text, doc_id % 3 AS n, regexp_full_match(text, '[\x00-\xFF\n]*') AS latin,
  regexp_full_match(text, '[\x00-\x7F\n]*') AS ascii FROM documents)"""


@check(
    "detect_encoding",
    f"""WITH {SQL_ENCODED} SELECT doc_id, CASE WHEN n = 1 THEN 'utf-8-sig' WHEN ascii THEN 'utf-8' WHEN n = 2 AND latin THEN 'utf-8-sig' ELSE 'utf-8' END AS encoding,
    CAST(CASE WHEN n = 1 OR ascii THEN 1.0 WHEN n = 2 AND latin THEN 0.73 ELSE 0.99 END AS DOUBLE) AS confidence FROM kinds""",
)
def _(spark, sf_dir):
    seen = dx.detect_encoding(F.col("content"))
    return encoded_documents(spark, sf_dir).select("doc_id", seen.alias("e")).select(
        "doc_id", "e.encoding", "e.confidence"
    )


@check("decode_with_fallback", "SELECT doc_id, md5(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))) AS text FROM documents")
def _(spark, sf_dir):
    seen = encoded_documents(spark, sf_dir).withColumn("e", dx.detect_encoding(F.col("content")))
    return seen.select("doc_id", F.md5(dx.decode_with_fallback(F.col("content"), F.col("e.decoder"))).alias("text"))


@check(
    "detect_delimiter",
    "SELECT o_orderkey, [',', chr(9), ';', '|'][o_orderkey % 4 + 1] AS delimiter FROM orders",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    d = pick(DELIMITERS, key % 4)
    line = F.concat("o_orderstatus", d, "o_orderpriority", d, F.col("o_custkey").cast("string"))
    text = F.concat(line, F.lit("\n"), line, F.lit("\n\n"), line)
    return table(spark, sf_dir, "orders").select(key, dx.detect_delimiter(text).alias("delimiter"))


SQL_WORDS = sql_list(["Total", " sub-total ", "KUL", "Opening Balance", "Totals", "Fuel"])


@check(
    "drop_blank_and_summary_rows",
    f"""SELECT o_orderkey, o_orderkey % 3 = 0 AS blank, NOT o_orderkey % 3 = 0 AND o_orderkey % 6 <> 4 AND o_orderkey % 6 <> 5 AS summary FROM orders""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    word = pick(["Total", " sub-total ", "KUL", "Opening Balance", "Totals", "Fuel"], key % 6)
    values = F.when(key % 3 == 0, F.array(F.lit(""), F.lit(" \t"), F.lit(None).cast("string"))).otherwise(
        F.array(F.lit(None).cast("string"), word, F.lit("7"))
    )
    record = F.struct(F.transform(values, strip).alias("values"), F.array().cast("array<string>").alias("overflow"))
    rows = table(spark, sf_dir, "orders").select(key, record.alias("r"))
    return rows.select(
        key, dx.is_blank_row(F.col("r")).alias("blank"), dx.is_summary_row(F.col("r")).alias("summary")
    )


# --- workbook cells -------------------------------------------------------------------------------------


def order_cells(spark, sf_dir):
    """A workbook per order as cells: a one-row summary sheet and a ledger sheet below two title rows.

    Ledger columns: Date, Vendor, an empty one without a header, Amount, Amount, Note (all N/A).
    """
    key, lit = F.col("o_orderkey"), F.lit
    day, price = F.date_format("o_orderdate", "dd/MM/yyyy"), (key * 37 % 1000).cast("string")

    def row(sheet, name, at, *values):
        return [
            F.struct(
                lit(sheet).alias("sheet_idx"), lit(name).alias("sheet"), lit(at).alias("row_idx"),
                lit(col).alias("col_idx"), value.cast("string").alias("value"), lit(text).alias("is_string"),
            )
            for col, (value, text) in enumerate(values) if value is not None
        ]

    cells = [
        *row(0, "Summary", 0, (lit("Ledger"), True), (lit("Done"), True)),
        *row(1, "T", 0, (lit("My Company"), True)),
        *row(1, "T", 2, (lit("01/01/2024"), True), (lit("31/12/2024"), True), (lit(5), False)),
        *row(1, "T", 3, (lit(" Date"), True), (lit("Vendor "), True), (None, False), (lit("Amount"), True),
             (lit("Amount"), True), (lit("Note"), True)),
        *row(1, "T", 4, (day, True), (F.col("o_orderpriority"), True), (None, False), (price, False), (lit("-"), True),
             (lit("N/A"), True)),
        *row(1, "T", 6, (day, True), (lit("None"), True), (None, False), (price, False), (lit("2"), False)),
        *row(1, "T", 7, (lit("NA"), True), (lit("--"), True)),
    ]
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("file_hash"), F.inline(F.array(*cells))
    )


@check("pick_sheet", "SELECT CAST(o_orderkey AS VARCHAR) AS file_hash, 1 AS sheet_idx, 'T' AS sheet FROM orders")
def _(spark, sf_dir):
    return workbook.pick_sheet(order_cells(spark, sf_dir))


@check("detect_header_row", "SELECT CAST(o_orderkey AS VARCHAR) AS file_hash, 3 AS header_row FROM orders")
def _(spark, sf_dir):
    return workbook.detect_header_row(order_cells(spark, sf_dir).filter("sheet_idx = 1"))


@check(
    "clean_headers",
    """SELECT CAST(o_orderkey AS VARCHAR) AS file_hash, c AS col_idx, h AS header FROM orders,
    (VALUES (0, 'Date'), (1, 'Vendor'), (2, 'Column_2'), (3, 'Amount'), (4, 'Amount.1'), (5, 'Note')) v(c, h)""",
)
def _(spark, sf_dir):
    sheet = order_cells(spark, sf_dir).filter("sheet_idx = 1").withColumn("header_row", F.lit(3))
    return workbook.clean_headers(workbook.header_cells(sheet))


SQL_BOOK_ROWS = """SELECT CAST(o_orderkey AS VARCHAR) AS file_hash, 1 AS source_row_number, '["Date","Vendor","Amount","Amount.1"]' AS headers,
  CAST(json_object('Date', strftime(o_orderdate, '%d/%m/%Y'), 'Vendor', o_orderpriority, 'Amount', CAST(o_orderkey * 37 % 1000 AS VARCHAR), 'Amount.1', NULL) AS VARCHAR) AS raw FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 2, '["Date","Vendor","Amount","Amount.1"]',
  CAST(json_object('Date', strftime(o_orderdate, '%d/%m/%Y'), 'Vendor', NULL, 'Amount', CAST(o_orderkey * 37 % 1000 AS VARCHAR), 'Amount.1', '2') AS VARCHAR) FROM orders"""


@check("read_workbooks", SQL_BOOK_ROWS)
def _(spark, sf_dir):
    rows = workbook.read_workbooks(order_cells(spark, sf_dir))
    return rows.select(
        "file_hash", "source_row_number", F.to_json("headers").alias("headers"), vx.row_to_json(F.col("raw")).alias("raw")
    )


@check(
    "tolerant_read",
    """WITH h AS (SELECT CAST(o_orderkey AS VARCHAR) AS file_hash, strftime(o_orderdate, '%d/%m/%Y') AS day, o_orderpriority AS p FROM orders)
    SELECT file_hash, 1 AS source_row_number, day AS date, p AS vendor, '-' AS amount FROM h UNION ALL SELECT file_hash, 2, day, 'None', '2' FROM h
    UNION ALL SELECT file_hash, 3, 'NA', '--', NULL FROM h""",
)
def _(spark, sf_dir):
    # Of the two Amount columns the last one counts.
    rows = workbook.read_workbooks(order_cells(spark, sf_dir), "raw")
    return rows.select(
        "file_hash", "source_row_number", F.col("raw.Date").alias("date"), F.col("raw.Vendor").alias("vendor"),
        F.col("raw.Amount").alias("amount"),
    )


@check(
    "colliding_headers",
    """SELECT CAST(o_orderkey AS VARCHAR) AS file_hash,
      CASE WHEN o_orderkey % 7 = 0 THEN '["A","A_1","A_1"]' ELSE '["A","B","C"]' END AS headers,
      CASE WHEN o_orderkey % 7 = 0 THEN CAST(json_object('A', o_orderpriority, 'A_1', o_orderstatus) AS VARCHAR)
        ELSE CAST(json_object('A', o_orderpriority, 'B', CAST(o_custkey AS VARCHAR), 'C', o_orderstatus) AS VARCHAR) END AS raw FROM orders""",
)
def _(spark, sf_dir):
    # Every seventh file has headers that clean_headers makes equal; its row and all others still come out.
    key, bad = F.col("o_orderkey"), F.col("o_orderkey") % 7 == 0
    heads = [F.lit("A"), F.when(bad, "A ").otherwise("B"), F.when(bad, "A_1").otherwise("C")]
    values = [F.col("o_orderpriority"), F.col("o_custkey").cast("string"), F.col("o_orderstatus")]
    cells = [
        F.struct(
            F.lit(0).alias("sheet_idx"), F.lit("S").alias("sheet"), F.lit(row).alias("row_idx"), F.lit(col).alias("col_idx"),
            value.alias("value"), F.lit(True).alias("is_string"),
        )
        for row, line in enumerate([heads, values]) for col, value in enumerate(line)
    ]
    books = table(spark, sf_dir, "orders").select(key.cast("string").alias("file_hash"), F.inline(F.array(*cells)))
    rows = workbook.read_workbooks(books)
    return rows.select("file_hash", F.to_json("headers").alias("headers"), vx.row_to_json(F.col("raw")).alias("raw"))


@check(
    "null_tokens",
    f"""SELECT o_orderkey, CASE WHEN NOT list_contains({sql_list(workbook.READER_NULLS + workbook.EXTRA_NULLS)}, s) THEN s END AS value FROM
    (SELECT o_orderkey, {sql_list(['N/A', '-', 'None', ' ', 'x', '#N/A', ' N/A', 'nan'])}[o_orderkey % 8 + 1] AS s FROM orders)""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    text = pick(["N/A", "-", "None", " ", "x", "#N/A", " N/A", "nan"], key % 8)
    return table(spark, sf_dir, "orders").select(key, workbook.null_tokens(text).alias("value"))


# --- quiet periods --------------------------------------------------------------------------------------

SQL_BURSTS = """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS starts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
b AS (SELECT user_id, ts, sum(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS burst FROM e)
SELECT user_id AS key, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(*) AS events,
  epoch_us(max(ts)) + 600000000 AS fires_us FROM b GROUP BY user_id, burst"""


def in_micros(bursts):
    return bursts.select(
        "key", F.unix_micros("first_ts").alias("first_us"), F.unix_micros("last_ts").alias("last_us"), "events",
        F.unix_micros("fires_at").alias("fires_us"),
    )


@check("debounce", SQL_BURSTS)
def _(spark, sf_dir):
    bursts = debounce(table(spark, sf_dir, "events"), "user_id", "ts", 600)
    return in_micros(bursts.withColumn("events", F.col("events").cast("bigint")))


@check("debounce_stream", SQL_BURSTS)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    folder, out = scratch(spark, "events"), scratch(spark, "bursts")
    events.write.parquet(folder)
    stream = spark.readStream.schema(events.schema).parquet(folder)
    query = (
        debounce_stream(stream, "user_id", "ts", 600, "1 hour").writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    emitted = spark.read.parquet(out)
    # The stream has ended, so what was still open is complete as well.
    return in_micros(emitted.unionByName(debounce_rest(events, emitted, "user_id", "ts", 600)))


@check(
    "windowed_totals_stream",
    """SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS window_us, event_type, count(*) AS events, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM events GROUP BY ALL""",
)
def _(spark, sf_dir):
    cents = F.round(F.col("value") * 100).cast("bigint")
    events = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), cents.alias("cents"))
    folder, out = scratch(spark, "events"), scratch(spark, "totals")
    events.repartitionByRange(4, "ts").write.parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    # The watermark waits longer than the files are apart; a last batch of open windows is added when the stream ends.
    query = (
        windowed_totals(stream, "ts", ["event_type"], "cents", "1 day", "3650 days").writeStream.outputMode("complete")
        .format("memory").queryName("totals_" + uuid.uuid4().hex).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.table(query.name).select(
        F.unix_micros("window_start").alias("window_us"), "event_type", "events", F.col("total").alias("cents")
    )
