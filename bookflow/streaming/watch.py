"""Continuous intake of a landing folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bookflow.functions import files as fx
from bookflow.options import DEFAULTS, Options
from bookflow.plans.intake import ingest
from bookflow.sources import landing
from bookflow.tables import Ledger, audit_event

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(spark: SparkSession, folder: str, max_files_per_trigger: int = 10_000) -> DataFrame:
    """New files of a folder as they appear, supported and not ignored.

    Spark knows files by path and takes each one up once; run ``ingest`` on ``scan_files`` where files are
    overwritten in place.
    """
    files = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger).load(folder)
    )
    return files.filter(landing.wanted(fx.file_name(F.col("path"))))


def manifest_stream(files: DataFrame, keep_for: str | None = None) -> DataFrame:
    """Manifest of a file stream with one row per hash.

    With ``keep_for`` ("1 day") the state holds a hash for that long after its file arrived and no longer, so it is
    bounded by what arrives in that time; a copy that comes later is let through, see ``record_files``. Time is that of
    arrival, so no file is ever late. Without it the rule holds over the life of the checkpoint, and the state keeps
    every hash ever seen.
    """
    manifest = landing.file_manifest(files)
    if keep_for is None:
        return manifest.dropDuplicates(["file_hash"])
    arrived = manifest.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", keep_for)
    return arrived.dropDuplicatesWithinWatermark(["file_hash"]).drop("arrived")


def record_files(
    ledger: Ledger, files: DataFrame, checkpoint: str, keep_for: str = "1 day", processing_time: str | None = None
) -> StreamingQuery:
    """Append the manifest of a file stream to the relation ``known_files``, each hash once for ever.

    The stream's state answers for copies within ``keep_for``; what passes it is looked up among the stored hashes.
    A micro-batch that is run again replaces its own load and is compared with the other loads only.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        here = Ledger(batch.sparkSession, ledger.root)
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_id = f"{query_id}-{batch_id:012d}"
        known = here.extra("known_files").filter(F.col("load_id") != load_id)
        fresh, _ = landing.drop_known_files(batch, known)
        here.append_extra(fresh, "known_files", load_id)

    writer = manifest_stream(files, keep_for).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return writer.trigger(**trigger).start()


def watch(
    ledger: Ledger,
    folder: str,
    checkpoint: str,
    on_result: Callable[[DataFrame], None] | None = None,
    processing_time: str | None = None,
    max_files_per_trigger: int = 10_000,
    options: Options = DEFAULTS,
) -> StreamingQuery:
    """Start taking in a folder. Without ``processing_time`` it handles what is there and stops.

    ``on_result`` is called once per micro-batch with the per-file results. A micro-batch run again after a failure
    writes to the same load, so nothing is stored twice; a damaged file gives a failed result and stops nothing.
    """
    _note(ledger, "watcher_started", f"Watching: {folder}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        here = Ledger(batch.sparkSession, ledger.root)
        # The query id lives in the checkpoint: the same after a restart, another for a new checkpoint.
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        results = ingest(here, batch, f"{query_id}-{batch_id:012d}", options=options)
        if on_result is not None:
            on_result(results)

    writer = (
        stream_files(ledger.spark, folder, max_files_per_trigger).writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stop(ledger: Ledger, query: StreamingQuery) -> None:
    """Stop a watcher and note it in the audit log."""
    query.stop()
    _note(ledger, "watcher_stopped", "Watcher stopped cleanly")


def _note(ledger: Ledger, operation: str, message: str) -> None:
    event = ledger.spark.range(1).select(*audit_event(operation, "bronze", "success", F.lit(message)))
    ledger.audit(event.withColumn("logged_at", F.current_timestamp()), f"{operation}-{uuid.uuid4().hex}")
