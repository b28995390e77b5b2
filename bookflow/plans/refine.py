"""Raw rows to mapped rows: the whole header-mapping batch as one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookflow.functions import files as fx
from bookflow.functions.text import map_last_wins, normalize_unicode
from bookflow.functions.values import neutralize_row, neutralized_count, rename_reserved_keys, row_to_json
from bookflow.operators.clean import mark_duplicates, quarantine, row_statuses, standardize
from bookflow.operators.curate import curate, period_summary
from bookflow.operators.mapping import apply_mapping, attach_mapping, layout_columns, layout_id, layout_records
from bookflow.operators.matching import map_columns, mapping_summary, triage
from bookflow.operators.memory import apply_suggestions, conflicting_suggestions, load_memory, save_memory
from bookflow.operators.status import settled_steps
from bookflow.options import DEFAULTS, Options
from bookflow.plans.joins import lookup_join
from bookflow.plans.session import materialize
from bookflow.tables import Ledger, audit_event


@dataclass
class MappedBatch:
    """``results`` one row per file, ``rows`` the cleaned rows, ``columns`` the mapped headers per layout,
    ``memory`` the next memory version (None when no memory was given), ``refused`` the rows of files over an enforced
    gate with the reason in ``error`` (None when gates are not enforced)."""

    results: DataFrame
    rows: DataFrame
    columns: DataFrame
    memory: DataFrame | None
    refused: DataFrame | None = None


def secure_rows(rows: DataFrame, column: str = "raw") -> DataFrame:
    """Gates 3 to 5 on a string map: formulas neutralised, reserved keys renamed, text in NFC."""
    # Renaming uses its map several times over, so it goes first, on the plain column: cells are then looked at once.
    safe = rows.withColumn(column, neutralize_row(rename_reserved_keys(F.col(column))))
    return normalize_unicode(safe, column)


def file_facts(rows: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Per file: its layout, row count, neutralised cells and the verdict of the two size gates in ``gate``, which is
    an ``error`` only where the options enforce the gates.

    What is the same in all rows of a file is grouped by, so that only numbers are aggregated, by hash and map-side.
    """
    facts = rows.groupBy("file_hash", "batch_id", "source_software", "headers").agg(
        F.max("file_size_bytes").alias("file_size_bytes"),
        F.count("*").alias("row_count"),
        F.sum(neutralized_count(F.col("raw"))).alias("formula_count"),
    )
    size = fx.check_file_size(F.coalesce("file_size_bytes", F.lit(0)), options)
    count = fx.check_row_count(F.col("row_count"), options)
    gate = F.when(~size["passed"], size["message"]).when(~count["passed"], count["message"])
    error = gate if options.enforce_gates else F.lit(None).cast("string")
    return facts.withColumn("layout_id", layout_id()).withColumn("gate", gate).withColumn("error", error)


def map_batch(
    rows: DataFrame,
    memory: DataFrame | None = None,
    suggestions: DataFrame | None = None,
    as_of: Column | None = None,
    options: Options = DEFAULTS,
) -> MappedBatch:
    """Map and clean a batch of raw rows.

    ``rows``: file_hash, batch_id, source_software, headers, source_row_number, raw, file_size_bytes. A file over a
    gate is mapped and gets a warning; with ``options.enforce_gates`` it gets a failed result and its rows are the
    batch's ``refused``. ``suggestions``: answers checked by ``validate_suggestions``, with layout_id,
    column, target and reason.
    """
    facts = materialize(file_facts(rows, options))
    passed = facts.filter(F.col("error").isNull())
    layouts = passed.groupBy("layout_id", "source_software", "headers").agg(F.count("*").alias("files"))
    columns = layout_columns(layouts)
    reusable = None if memory is None else load_memory(memory, options)
    known = materialize(map_columns(columns, reusable, options).drop("renamed_to"))
    mapped = attach_mapping(columns, known, options)
    if suggestions is not None:
        mapped = apply_suggestions(mapped, suggestions, ["layout_id"], options)
    mapped = triage(mapped, options)

    eligible, refused = rows.withColumn("layout_id", layout_id()), None
    if options.enforce_gates:
        failed = facts.filter(F.col("error").isNotNull()).select("file_hash", "error")
        refused = rows.join(failed, "file_hash")
        eligible = eligible.join(failed, "file_hash", "left_anti")
    cleaned = apply_mapping(secure_rows(eligible), layout_records(mapped), options)

    next_memory = None
    if memory is not None:
        next_memory = save_memory(memory, mapped, F.current_timestamp() if as_of is None else as_of, options)
    return MappedBatch(_results(facts, mapped, suggestions, options), cleaned, mapped, next_memory, refused)


def _results(facts: DataFrame, mapped: DataFrame, suggestions: DataFrame | None, options: Options) -> DataFrame:
    """The 14-field result of every file."""
    entry = F.struct("position", "column", "standard_field")

    def in_order(condition: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(condition, entry)))

    def names(entries: str) -> Column:
        return F.transform(entries, lambda e: e["column"])

    per_layout = mapping_summary(mapped, ["layout_id"], options).select(
        "layout_id", "coverage", "has_date", "has_amount"
    )
    lists = mapped.groupBy("layout_id").agg(
        in_order(F.col("is_mapped")).alias("used"),
        in_order(F.col("needs_review")).alias("doubtful"),
        F.array_sort(
            F.collect_list(F.when(F.col("renamed"), F.struct("position", "original", "column")))
        ).alias("renames"),
        F.bool_or(F.col("match_method") == "llm_assist").alias("llm_used"),
    )
    described = per_layout.join(lists, "layout_id").select(
        "layout_id", "coverage", "has_date", "has_amount", "llm_used",
        F.to_json(_object("used", "column", "standard_field")).alias("column_mapping"),
        F.to_json(_object("renames", "original", "column")).alias("rename_map"),
        names("doubtful").alias("to_review"),
        F.transform("renames", lambda e: e["original"]).alias("renamed"),
    )
    if suggestions is None:
        described = described.withColumn("llm_rejected", F.array().cast("array<string>"))
    else:
        reasons = suggestions.select("layout_id", "reason").unionByName(
            conflicting_suggestions(suggestions, ["layout_id"]).select("layout_id", "reason")
        )
        refused = reasons.groupBy("layout_id").agg(F.sort_array(F.collect_set("reason")).alias("llm_rejected"))
        described = described.join(refused, "layout_id", "left")
    joined = lookup_join(facts, described, ["layout_id"], ["file_hash"], options)
    failed = F.col("error").isNotNull()
    listed = F.concat(F.lit("['"), F.array_join("renamed", "', '"), F.lit("']"))
    warnings = F.array_compact(
        F.array(
            F.col("gate"),
            F.when(~failed & (F.col("formula_count") > 0), F.format_string("%s formula cells neutralized", "formula_count")),
            F.when(~failed & (F.size("renamed") > 0), F.concat(F.lit("Reserved column names renamed: "), listed)),
        )
    )
    return joined.select(
        "file_hash",
        (~failed).alias("success"), "source_software", "batch_id",
        F.coalesce("column_mapping", F.lit("{}")).alias("column_mapping"),
        F.coalesce("rename_map", F.lit("{}")).alias("rename_map"),
        F.coalesce("to_review", "headers").alias("needs_user_review"),
        warnings.alias("security_warnings"),
        F.when(failed, 0).otherwise(F.col("formula_count")).alias("formula_count"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("has_date", F.lit(False)).alias("has_date"),
        F.coalesce("has_amount", F.lit(False)).alias("has_amount"),
        "error",
        F.coalesce("llm_used", F.lit(False)).alias("llm_used"),
        F.coalesce("llm_rejected", F.array().cast("array<string>")).alias("llm_rejected"),
    )


def _object(entries: str, key: str, value: str) -> Column:
    """Map of a list of structs; the last of equal keys wins."""
    return map_last_wins(F.transform(entries, lambda e: e[key]), F.transform(entries, lambda e: e[value]))


@dataclass
class RefinedBatch:
    """The clean and curated rows of a batch with everything set aside on the way."""

    mapped: MappedBatch
    silver: DataFrame
    quarantined: DataFrame
    gold: DataFrame


def refine(
    rows: DataFrame,
    memory: DataFrame | None = None,
    suggestions: DataFrame | None = None,
    prior: DataFrame | None = None,
    stored: DataFrame | None = None,
    options: Options = DEFAULTS,
) -> RefinedBatch:
    """Raw rows to curated transactions.

    ``rows`` as for ``map_batch``, with bronze_id and source_type, and raw_content and source_file where quarantined rows
    are to show them (raw_content is else made of ``raw``). Mapped and standardised rows are written down once: the
    duplicate check reads them twice and must not map them again. ``prior`` (silver_id, gold_version) numbers
    reprocessed rows. ``stored``: clean rows of earlier loads, whose copies are marked as well.
    """
    mapped = map_batch(rows, memory, suggestions, options=options)
    standard = materialize(standardize(mapped.rows, options))
    content = F.col("raw_content") if "raw_content" in rows.columns else row_to_json(F.col("raw"))
    source = F.col("source_file") if "source_file" in rows.columns else F.lit(None).cast("string")
    originals = rows.select("bronze_id", content.alias("raw_content"), source.alias("source_file"))
    sound, quarantined = quarantine(standard, originals)
    silver = materialize(mark_duplicates(sound, options, stored))
    return RefinedBatch(mapped, silver, quarantined, curate(silver, prior, options))


def store(ledger: Ledger, batch: RefinedBatch, load_id: str, options: Options = DEFAULTS) -> None:
    """Append a refined batch to the clean, quarantine, curated and audit tables, version the mapping memory and hand the
    status of every raw row over.

    Give ``refine`` the memory of ``ledger.version("bronze_schema_mappings", before=load_id)``.
    """
    ledger.append(batch.silver, "silver_transactions", load_id)
    ledger.append(batch.quarantined, "silver_quarantine", load_id)
    ledger.append(batch.gold, "gold_transactions", load_id)
    ledger.append_extra(row_statuses(batch.silver, batch.quarantined), "processing_status", load_id)
    ledger.append_extra(settled_steps(batch.silver, batch.quarantined), "status_events", load_id)
    if batch.mapped.memory is not None:
        ledger.append(batch.mapped.memory, "bronze_schema_mappings", load_id)
    results = batch.mapped.results
    mapped_columns = F.size(F.from_json("column_mapping", "map<string,string>"))
    events = results.select(
        *audit_event(
            "schema_mapping_complete", "silver", F.when(F.col("success"), "success").otherwise("failure"),
            F.format_string(
                "%s: %s mapped, %s need review, coverage=%s%%, llm_used=%s", "source_software", mapped_columns,
                F.size("needs_user_review"), F.round(F.col("coverage") * 100).cast("int"), "llm_used",
            ),
            mapped_columns,
            F.col("batch_id"),
        )
    )
    ledger.audit(events, f"{load_id}-mapping")


def summarize(ledger: Ledger, load_id: str, options: Options = DEFAULTS) -> None:
    """Write the period summaries of all curated rows as a new version."""
    ledger.append(period_summary(ledger.read_curated(), options=options), "gold_period_summaries", load_id)
