"""Files to raw rows: scan, gates, duplicate check, parse, append, results and audit as one run."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookflow.functions.keys import uuid_of
from bookflow.functions.values import headers_to_json, row_to_json
from bookflow.options import DEFAULTS, Options
from bookflow.plans.joins import lookup_join
from bookflow.plans.session import materialize, stage_folder
from bookflow.sources import delimited, landing, workbook, xlsx_cells
from bookflow.sources.large_delimited import parse_large
from bookflow.tables import Ledger, audit_event


def batch_id(load_id: str) -> Column:
    """One batch id per file and load."""
    return uuid_of(F.lit(load_id), "file_hash")


def raw_content(raw: Column, overflow: Column) -> Column:
    """Row JSON; one surplus field is kept as a list under the key "None"."""
    body = row_to_json(raw)
    opened = F.substring(body, F.lit(1), F.length(body) - 1)
    comma = F.when(F.size(raw) > 0, ",").otherwise("")
    tail = F.concat(F.lit('"None":'), F.to_json(overflow), F.lit("}"))
    return F.when(F.size(overflow) > 0, F.concat(opened, comma, tail)).otherwise(body)


def raw_records(rows: DataFrame, load_id: str) -> DataFrame:
    """Raw-table columns of parsed rows (file columns, headers, source_row_number, raw, overflow)."""
    return rows.select(
        uuid_of(F.lit(load_id), "file_hash", "source_row_number").alias("bronze_id"),
        "source_type", "source_software",
        F.col("file_name").alias("source_file"),
        F.col("file_hash").alias("source_file_hash"),
        "source_row_number",
        raw_content(F.col("raw"), F.col("overflow")).alias("raw_content"),
        headers_to_json(F.col("headers")).alias("raw_headers"),
        batch_id(load_id).alias("ingestion_batch_id"),
        F.lit("pending").alias("processing_status"),
    )


ROW = ["file_hash", "file_name", "source_type", "source_software", "source_row_number", "headers", "raw", "overflow"]


@dataclass
class ParsedFiles:
    """``rows`` of all readable files, ``rejected`` rows (file_hash, file_name, source_row_number, raw_content, error),
    ``meta`` per file (file_hash, parse_meta as JSON), ``failed`` files (file_hash, error)."""

    rows: DataFrame
    rejected: DataFrame
    meta: DataFrame
    failed: DataFrame


def _large_parts(fresh: DataFrame, folder: str | None, options: Options) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """(rows as of ``explode_all``, meta, failed) of the fresh delimited files that are read over many tasks, None
    without such files. Their paths go through the driver as for any scan; each stands for a large file."""
    large = fresh.filter((F.col("source_type") == "csv") & (F.col("file_size_bytes") > options.split_above_bytes))
    paths = [r["file_path"] for r in large.select("file_path").toLocalIterator()]
    if not paths:
        return None
    parsed = parse_large(fresh.sparkSession, paths, folder, options)
    known = large.select("file_path", "file_hash", "file_name", "source_type", "source_software")
    meta = F.to_json(F.struct(*delimited.META), {"ignoreNullFields": "false"}).alias("parse_meta")
    return (
        parsed.rows.join(F.broadcast(known), "file_path"),
        parsed.meta.join(known, "file_path").select("file_hash", meta),
        parsed.failed.join(known, "file_path").select("file_hash", "error"),
    )


def parse_files(
    files: DataFrame, fresh: DataFrame, folder: str | None = None, options: Options = DEFAULTS, split: bool = False
) -> ParsedFiles:
    """Parses the files of ``files`` (a listing with content) that stand in ``fresh`` (manifest rows).

    Each reader scans the files of its own suffixes only, and the hash comes from the manifest. Delimited files are
    parsed once and written down in ``folder``, workbooks are unpacked once. With ``split`` the large delimited files of
    ``fresh`` are not in ``files``: each is read by its path over many tasks.
    """
    csv = landing.contents(landing.by_suffix(files, [".csv"]), fresh, options)
    parsed = materialize(delimited.explode_all(delimited.parse_delimited(csv, options)), folder)
    every = parsed.select(*ROW)
    large = _large_parts(fresh, folder, options) if split else None
    if large is not None:
        every = every.unionByName(large[0].select(*ROW))
    csv_rows, surplus = delimited.split_surplus(every)
    csv_meta = parsed.groupBy("file_hash").agg(
        F.first(F.to_json(F.struct(*delimited.META), {"ignoreNullFields": "false"})).alias("parse_meta")
    )

    books = landing.contents(landing.by_suffix(files, [".xlsx", ".xls"]), fresh, options)
    unpacked = materialize(xlsx_cells.unpack(books), folder)
    cells, damaged = xlsx_cells.split_damaged(unpacked)
    sheet_rows = materialize(workbook.read_workbooks(cells, "clean", options), folder)
    book_rows = lookup_join(
        sheet_rows, fresh.select("file_hash", "file_name", "source_type", "source_software"),
        ["file_hash"], ["file_hash", "source_row_number"], options,
    ).withColumn("overflow", F.array().cast("array<string>"))
    book_meta = workbook.workbook_metadata(sheet_rows, cells, options)
    _, _, other = landing.route_by_type(fresh)
    failed = other.select("file_hash", "error").unionByName(damaged)
    if large is not None:
        csv_meta, failed = csv_meta.unionByName(large[1]), failed.unionByName(large[2])
    return ParsedFiles(
        csv_rows.select(*ROW).unionByName(book_rows.select(*ROW)),
        surplus.select(
            "file_hash", "file_name", F.col("source_row_number").cast("int").alias("source_row_number"),
            raw_content(F.col("raw"), F.col("overflow")).alias("raw_content"), "error",
        ),
        csv_meta.unionByName(book_meta),
        failed.distinct(),
    )


def ingest(
    ledger: Ledger,
    files: DataFrame,
    load_id: str,
    detected_at: Column | None = None,
    options: Options = DEFAULTS,
) -> DataFrame:
    """Take in the new files of a listing and return one result row per file.

    ``files`` has the columns of Spark's binaryFile source. Results: file_name, file_hash, success, rows_written,
    rows_rejected, batch_id, error, parse_meta (JSON). Known files are skipped, a damaged file is reported and stops
    nothing. Rows that cannot be stored stand with a reason in the relation ``rejected_rows``, so written and rejected
    rows are all rows of a file. What is known is looked up in the results of earlier loads, one row per file: a file
    counts as known once it succeeded and rows of it are stored, so a failed one is taken up again by the next run. With
    ``options.enforce_gates`` files above the size gate are reported and not read. Delimited files of a listing that pass
    ``options.split_above_bytes`` are read over many tasks.
    """
    began = time.monotonic()
    with stage_folder(ledger.spark) as folder:
        small, large = landing.drop_empty_files(files), None
        if options.enforce_gates:
            small, large = landing.split_by_size(small, options)
        whole, large_csv = landing.split_large(small, options)
        manifest = landing.file_manifest(whole, detected_at)
        if large_csv is not None:
            manifest = manifest.unionByName(landing.large_manifest(large_csv, detected_at))
        manifest = materialize(manifest, folder)
        known = ledger.extra("file_results").filter((F.col("load_id") != load_id) & F.col("success") & (F.col("rows_written") > 0))
        fresh, skipped = landing.drop_known_files(manifest, known.select("file_hash"))
        fresh = materialize(fresh, folder)

        parsed = parse_files(whole, fresh, folder, options, split=large_csv is not None)
        ledger.append(raw_records(parsed.rows, load_id), "bronze_transactions", load_id)
        ledger.append_extra(parsed.rejected, "rejected_rows", load_id)

        written = (
            ledger.read("bronze_transactions").filter(F.col("load_id") == load_id)
            .groupBy(F.col("source_file_hash").alias("file_hash")).agg(F.count("*").alias("rows_written"))
        )
        refused = (
            ledger.extra("rejected_rows").filter(F.col("load_id") == load_id)
            .groupBy("file_hash").agg(F.count("*").alias("rows_rejected"))
        )
        results = (
            fresh.join(written, "file_hash", "left").join(refused, "file_hash", "left")
            .join(parsed.failed, "file_hash", "left").join(parsed.meta, "file_hash", "left")
            .select(
                "file_name", "file_hash",
                F.col("error").isNull().alias("success"),
                F.coalesce("rows_written", F.lit(0)).alias("rows_written"),
                F.coalesce("rows_rejected", F.lit(0)).alias("rows_rejected"),
                batch_id(load_id).alias("batch_id"),
                "error", "parse_meta",
            )
        )
        if large is not None:
            none = F.lit(None).cast("string")
            results = results.unionByName(
                large.select(
                    F.element_at(F.split("path", "/"), -1).alias("file_name"), none.alias("file_hash"),
                    F.lit(False).alias("success"), F.lit(0).cast("bigint").alias("rows_written"),
                    F.lit(0).cast("bigint").alias("rows_rejected"), none.alias("batch_id"), "error", none.alias("parse_meta"),
                )
            )
        ledger.append_extra(results, "file_results", load_id)
        results = ledger.extra("file_results").filter(F.col("load_id") == load_id).drop("load_id")
        spent = int((time.monotonic() - began) * 1000)
        ledger.audit(intake_events(fresh, skipped, results, spent), load_id)
    return results


def intake_events(fresh: DataFrame, skipped: DataFrame, results: DataFrame, duration_ms: int = 0) -> DataFrame:
    """Audit events of a run: files found, duplicates skipped, and the outcome of every file.

    ``duration_ms`` is the time of the whole run, whose files are parsed together.
    """
    found = fresh.select(
        *audit_event(
            "file_detected", "bronze", "success",
            F.format_string(
                "File queued: %s | %s | %s | confidence=%s%%", "file_name", "source_type", "source_software",
                F.round(F.col("detection_conf") * 100).cast("int"),
            ),
        )
    )
    again = skipped.select(
        *audit_event(
            "duplicate_file_skipped", "bronze", "warning",
            F.format_string("Duplicate: %s (hash %s)", "file_name", F.substring("file_hash", 1, 16)),
        )
    )
    empty = F.col("success") & (F.col("rows_written") == 0)
    partly = F.col("rows_rejected") > 0
    outcome = results.select(
        *audit_event(
            F.when(~F.col("success"), "bronze_ingest_failed").when(empty, "bronze_ingest_empty")
            .otherwise("bronze_ingest_success"),
            "bronze",
            F.when(~F.col("success"), "failure").when(empty | partly, "warning").otherwise("success"),
            F.when(~F.col("success"), F.concat_ws(": ", "file_name", "error"))
            .when(empty, F.concat(F.lit("No data rows: "), F.col("file_name")))
            .when(partly, F.format_string("%s: %s rows written, %s rejected", "file_name", "rows_written", "rows_rejected"))
            .otherwise(F.format_string("%s: %s rows written", "file_name", "rows_written")),
            F.col("rows_written"),
            F.col("batch_id"),
            duration_ms,
        )
    )
    return found.unionByName(again).unionByName(outcome)
