"""Mapping memory and external suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookflow.dictionary import STANDARD_FIELDS
from bookflow.functions.keys import uuid_of
from bookflow.functions.text import strip
from bookflow.functions.values import mask_pii
from bookflow.options import DEFAULTS, Options


def load_memory(memory: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Mappings to reuse: confirmed by a user or stored with at least ``options.auto_accept``.

    The threshold is compared in 32 bits, as it is stored: 0.85 as a double is above 0.85 as a float.
    """
    sure = F.col("confidence") >= F.lit(options.auto_accept).cast("float")
    return memory.filter(F.col("confirmed_by_user") | sure)


def save_memory(memory: DataFrame, mapped: DataFrame, as_of: Column, options: Options = DEFAULTS) -> DataFrame:
    """The next version of the memory after a batch.

    ``mapped`` has one row per layout and header; its column ``files``, where there is one, says how many sightings a
    row stands for. Headers with a target and at least ``options.suggest`` count; a known one only gains sightings,
    a new one is stored unconfirmed.
    """
    sightings = F.sum("files") if "files" in mapped.columns else F.count("*")
    seen = (
        mapped.filter(F.col("standard_field").isNotNull() & (F.col("confidence") >= options.suggest))
        .groupBy("source_software", F.col("column").alias("original_column"))
        .agg(
            sightings.cast("int").alias("sightings"),
            F.max(F.struct("confidence", "standard_field")).alias("new"),
        )
    )
    keys = ["source_software", "original_column"]
    is_new = F.col("standard_field").isNull()
    return memory.join(seen, keys, "full_outer").select(
        F.coalesce("mapping_id", uuid_of(*keys)).alias("mapping_id"),
        *keys,
        F.coalesce("standard_field", "new.standard_field").alias("standard_field"),
        F.coalesce(F.col("confidence"), F.col("new.confidence").cast("float")).alias("confidence"),
        F.coalesce("confirmed_by_user", F.lit(False)).alias("confirmed_by_user"),
        (F.coalesce("times_seen", F.lit(0)) + F.coalesce("sightings", F.lit(0))).alias("times_seen"),
        F.coalesce("created_at", as_of).alias("created_at"),
        F.when(is_new | F.col("sightings").isNotNull(), as_of).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def by_times_seen(memory: DataFrame) -> DataFrame:
    """Memory rows, the most often seen first."""
    return memory.orderBy(F.desc("times_seen"), "source_software", "original_column")


def sample_for_review(rows: DataFrame, unresolved: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Masked sample cells of unresolved headers: the first rows of a batch, cut to a length, then masked.

    ``rows`` has batch_id, source_row_number and raw; ``unresolved`` has batch_id and column. Row numbers start at
    1 in every batch, so the sample needs no ranking.
    """
    first = rows.filter(F.col("source_row_number") <= options.sample_rows)
    cells = first.select("batch_id", "source_row_number", F.explode("raw").alias("column", "value"))
    return (
        cells.filter(F.coalesce(F.col("value"), F.lit("")) != "")
        .join(unresolved.select("batch_id", "column").distinct(), ["batch_id", "column"], "left_semi")
        .withColumn("value", mask_pii(F.substring("value", 1, options.sample_chars)))
    )


def validate_suggestions(suggestions: DataFrame) -> DataFrame:
    """One row per suggested mapping with ``target`` when it holds, else ``reason``.

    ``suggestions`` has ``response`` (the text of a remote answer) and ``columns`` (the headers of the file); other
    columns are kept. An answer that is no JSON, or not of the form {"mappings": {...}}, gives one row with the
    reason and no column.
    """
    kept = [c for c in suggestions.columns if c not in ("response", "columns")]
    text = F.col("response")
    inner = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    parsed = suggestions.withColumn("answer", F.coalesce(F.try_parse_json(text), F.try_parse_json(inner)))
    top = F.schema_of_variant("answer")
    offered = F.try_variant_get("answer", "$.mappings", "variant")
    whole = (
        F.when(F.col("answer").isNull(), "LLM output was not valid JSON")
        .when(~top.startswith("OBJECT"), "LLM response is not a dict — rejected entirely")
        .when(
            offered.isNotNull() & ~F.schema_of_variant(offered).startswith("OBJECT"),
            "LLM mappings key is not a dict — rejected entirely",
        )
    )
    pairs = F.when(whole.isNull(), F.try_variant_get("answer", "$.mappings", "map<string,variant>"))
    target, column = F.col("value"), F.col("column")
    spoken = F.try_variant_get(target, "$", "string")
    clean = F.lower(strip(spoken))
    named = F.concat(F.lit("'"), column, F.lit("'"))
    arrow = F.concat(named, F.lit(" → '"), spoken, F.lit("'"))
    known = F.exists("columns", lambda c: F.lower(c) == F.lower(column))
    reason = (
        F.when(F.col("whole").isNotNull(), F.col("whole"))
        .when(~known, F.concat(named, F.lit(": not in original columns — possible injection")))
        .when(
            F.coalesce(F.schema_of_variant(target), F.lit("VOID")) != "STRING",
            F.concat(named, F.lit(": target is not a string")),
        )
        .when(~clean.isin(STANDARD_FIELDS), F.concat(arrow, F.lit(": not a valid standard field — rejected")))
        .when(spoken.rlike(r"[<>{};\n\r]"), F.concat(arrow, F.lit(": contains suspicious characters")))
    )
    rows = parsed.withColumn("whole", whole).select(*kept, "columns", "whole", F.explode_outer(pairs).alias("column", "value"))
    return (
        rows.filter(F.col("whole").isNotNull() | column.isNotNull())
        .withColumn("reason", reason)
        .select(*kept, "column", F.when(F.col("reason").isNull(), clean).alias("target"), "reason")
    )


def apply_suggestions(mapped: DataFrame, valid: DataFrame, by: list[str], options: Options = DEFAULTS) -> DataFrame:
    """``mapped`` with the valid suggestions applied by exact header name.

    ``by`` identifies the file or layout. Suggestions are asked for only where some header is unmapped or unsure,
    so a file without such a header keeps its mapping. Answers that contradict each other on a header are not used;
    ``conflicting_suggestions`` names them.
    """
    weak = F.col("standard_field").isNull() | ((F.col("confidence") < options.auto_accept) & ~F.col("confirmed"))
    asked = mapped.filter(weak).select(*by).distinct()
    offers = (
        valid.filter(F.col("target").isNotNull()).groupBy(*by, "column")
        .agg(F.min("target").alias("target"), F.max("target").alias("_other"))
        .filter("target = _other").drop("_other").join(asked, by, "left_semi")
    )
    hit = F.col("target").isNotNull()
    return (
        mapped.join(offers, [*by, "column"], "left")
        .withColumn("standard_field", F.coalesce("target", "standard_field"))
        .withColumn("confidence", F.when(hit, options.suggestion_confidence).otherwise(F.col("confidence")))
        .withColumn("match_method", F.when(hit, "llm_assist").otherwise(F.col("match_method")))
        .drop("target")
    )


def conflicting_suggestions(valid: DataFrame, by: list[str]) -> DataFrame:
    """(by, column, reason) of headers for which valid answers name different targets."""
    answers = valid.filter(F.col("target").isNotNull()).groupBy(*by, "column").agg(
        F.min("target").alias("one"), F.max("target").alias("other")
    )
    reason = F.format_string("'%s': answers name both '%s' and '%s' — none is used", "column", "one", "other")
    return answers.filter("one <> other").select(*by, "column", reason.alias("reason"))
