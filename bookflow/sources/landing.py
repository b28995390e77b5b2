"""The landing folder: listing, gates, fingerprints, classification, duplicate files."""

from __future__ import annotations

import hashlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.functions import files as fx
from bookflow.options import DEFAULTS, Options
from bookflow.plans.joins import fits_broadcast

MANIFEST = [
    "file_path", "file_name", "source_type", "source_software", "detection_conf", "file_hash",
    "file_size_bytes", "detected_at",
]


def wanted(name: Column) -> Column:
    """A file the intake takes: supported and not ignored."""
    return fx.is_supported(name) & ~fx.is_ignored(name)


def scan_files(spark: SparkSession, folder: str) -> DataFrame:
    """Top-level files of a folder worth taking in, as path, length, modificationTime and content.

    Spark's file listing itself leaves out names that start with ``_`` or ``.`` and files of 0 bytes.
    """
    files = spark.read.format("binaryFile").load(folder)
    return files.filter(wanted(fx.file_name(F.col("path"))))


def list_files(files: DataFrame) -> DataFrame:
    """Names and sizes in name order; the bytes are not read."""
    return files.select(
        fx.file_name(F.col("path")).alias("file_name"), F.col("length").alias("file_size_bytes")
    ).orderBy("file_name")


def _listed_name(files: DataFrame) -> Column | None:
    """The file name from the metadata of a binary file scan; None for any other relation."""
    try:
        name = files["_metadata.file_name"]
    except AnalysisException:
        return None
    # A relation of paths and bytes that stands in files itself has metadata too, those of its own files.
    return name if "] binaryFile" in files._jdf.queryExecution().analyzed().toString() else None


def by_suffix(files: DataFrame, suffixes: list[str]) -> DataFrame:
    """Files with one of the suffixes. On a file scan the condition is on file metadata, so Spark skips the bytes of
    all other files."""
    name = _listed_name(files)
    return files.filter(fx.suffix(fx.file_name(F.col("path")) if name is None else name).isin(suffixes))


def drop_empty_files(files: DataFrame) -> DataFrame:
    """Without files of 0 bytes; the condition reaches the file scan."""
    return files.filter(F.col("length") > 0)


def split_by_size(files: DataFrame, options: Options = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """(files inside the size gate, files above it with the gate's message in ``error``).

    The condition on ``length`` reaches the file scan: bytes of files above the gate are never read. The gate
    also bounds what one row of ``content`` can hold.
    """
    limit = options.max_file_mb * 1024 * 1024
    gate = fx.check_file_size(F.col("length"), options)
    return (
        files.filter(F.col("length") <= limit),
        files.filter(F.col("length") > limit).drop("content").withColumn("error", gate["message"]),
    )


def file_manifest(files: DataFrame, detected_at: Column | None = None) -> DataFrame:
    """The 8-column record of every file, without its bytes."""
    return with_manifest(files, detected_at).select(*MANIFEST)


def with_manifest(files: DataFrame, detected_at: Column | None = None) -> DataFrame:
    """The manifest columns plus ``content``."""
    named = files.select("path", "length", "content", fx.fingerprint(F.col("content")).alias("file_hash"))
    return _described(named, detected_at).select(*MANIFEST, "content")


def large_manifest(files: DataFrame, detected_at: Column | None = None) -> DataFrame:
    """The manifest of files whose bytes fit no row: a task reads its file as a stream and keeps one piece at a time."""

    def read(batches):
        for batch in batches:
            hashes = []
            for path in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(quote(path, safe="/:"))
                digest = hashlib.sha256()
                with store.open_input_stream(name, compression=None) as stream:
                    while piece := stream.read(1 << 22):
                        digest.update(piece)
                hashes.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes, pa.string())], ["path", "length", "file_hash"])

    named = files.select("path", "length").mapInArrow(read, "path string, length bigint, file_hash string")
    return _described(named, detected_at).select(*MANIFEST)


def _described(named: DataFrame, detected_at: Column | None) -> DataFrame:
    """Manifest columns for rows of path, length and file_hash, beside what else they hold."""
    when = F.current_timestamp() if detected_at is None else detected_at
    return (
        named.withColumnRenamed("path", "file_path").withColumn("file_name", fx.file_name(F.col("file_path")))
        .withColumn("verdict", fx.classify_file(F.col("file_name"))).select("*", "verdict.*")
        .withColumn("file_size_bytes", F.col("length"))
        .withColumn("detected_at", F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    )


def split_large(files: DataFrame, options: Options = DEFAULTS) -> tuple[DataFrame, DataFrame | None]:
    """(files taken in one row each, delimited files above ``options.split_above_bytes``, which are read by their paths).

    Only a real listing can be split; a relation of contents has none of the second kind (None)."""
    name = _listed_name(files)
    if name is None:
        return files, None
    # The size is that of the listing: a condition on ``length`` would be judged after the bytes are read.
    large = fx.suffix(name).isin([".csv"]) & (files["_metadata.file_size"] > options.split_above_bytes)
    return files.filter(~large), files.filter(large).select("path", "length")


def first_of_each_hash(manifest: DataFrame) -> DataFrame:
    """One file per hash, the first by path. Combined map-side: a third of all files may be copies of one."""
    record = F.struct(*manifest.columns)
    return manifest.groupBy("file_hash").agg(F.min_by(record, "file_path").alias("f")).select("f.*")


def drop_known_files(manifest: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new files, skipped files): skipped are those whose hash is in ``known`` or came earlier in this run."""
    hashes = known.select("file_hash").filter(F.col("file_hash").isNotNull()).distinct()
    fresh = first_of_each_hash(manifest).join(hashes, "file_hash", "left_anti").select(*manifest.columns)
    skipped = manifest.join(fresh.select("file_path"), "file_path", "left_anti")
    return fresh, skipped


def contents(files: DataFrame, manifest: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Manifest rows with the content of their file; content is shuffled only past the broadcast bounds."""
    rows = F.broadcast(manifest) if fits_broadcast(manifest.select("file_path"), options) else manifest
    return files.select(F.col("path").alias("file_path"), "content").join(rows, "file_path").select(*manifest.columns, "content")


def route_by_type(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(delimited files, workbooks, files no reader takes with the reason in ``error``)."""
    kind = F.col("source_type")
    reason = F.concat(
        F.lit("Unsupported source_type for Bronze ingestion: "), kind,
        F.lit(". PDF and JSON parsers are handled separately."),
    )
    return (
        files.filter(kind == "csv"),
        files.filter(kind.isin("xlsx", "xls")),
        files.filter(~kind.isin("csv", "xlsx", "xls")).withColumn("error", reason),
    )
