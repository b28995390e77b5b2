"""From mapped headers to standard fields.

A *layout* is a header row as one system writes it. Files share few layouts, so headers are matched once per layout
and rows pick their fields through a small per-layout record instead of a join per cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookflow.dictionary import STANDARD_FIELDS
from bookflow.functions.keys import uuid_of
from bookflow.functions.values import (
    AMOUNT_FIELDS, CAPPED_FIELDS, amount_number, amount_warning, is_reserved, null_values, rate_number, rate_warning,
    rename_reserved, truncation_warning,
)
from bookflow.options import DEFAULTS, Options
from bookflow.plans.joins import lookup_join

LAYOUT = ["layout_id", "sources", "mapped_headers", "mapping_confidence"]


def layout_id(source_software: str = "source_software", headers: str = "headers") -> Column:
    """Identifier of a header row of a system."""
    return uuid_of(source_software, F.to_json(F.col(headers)))


def layout_columns(layouts: DataFrame) -> DataFrame:
    """One row per layout and header with its position; reserved names are renamed, which ``original`` remembers.

    ``layouts``: layout_id, source_software, headers and ``files``, the number of files with that layout.
    """
    return (
        layouts.select("layout_id", "source_software", "files", F.posexplode("headers").alias("position", "original"))
        .withColumn("column", rename_reserved(F.col("original")))
        .withColumn("renamed", is_reserved(F.col("original")))
    )


def attach_mapping(columns: DataFrame, mapped: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """``columns`` with the mapping of their (source_software, column); a header such as "Date" may be in all of them."""
    return lookup_join(columns, mapped, ["source_software", "column"], ["layout_id", "position"], options)


def layout_records(mapped: DataFrame) -> DataFrame:
    """Per layout: which header feeds each standard field (the last one wins), the mapped headers, their confidence.

    ``mapped`` has layout_id, position, column, standard_field, confidence and is_mapped.
    """
    place = F.struct("position", "column")
    used = F.col("is_mapped")

    def source(field: str) -> Column:
        return F.max(F.when(used & (F.col("standard_field") == field), place))["column"].alias(field)

    return mapped.groupBy("layout_id").agg(
        F.struct(*[source(field) for field in STANDARD_FIELDS]).alias("sources"),
        F.collect_set(F.when(used, F.col("column"))).alias("mapped_headers"),
        F.avg(F.when(used, F.col("confidence"))).cast("float").alias("mapping_confidence"),
    )


def apply_mapping(rows: DataFrame, records: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Rows with the 20 standard fields cleaned by type, ``extras`` (unmapped cells as ``_raw_<name>``) and ``warnings``.

    ``rows`` has layout_id, source_row_number and raw. Amounts and rates are doubles, the rest text.
    """
    joined = lookup_join(rows, records, ["layout_id"], ["file_hash", "source_row_number"], options)
    numeric = [*AMOUNT_FIELDS, "tax_rate"]

    # Three projections: each text and each number is worked out once and then used by value and warning.
    texts = joined.withColumns(
        {f"_t_{f}": null_values(F.try_element_at("raw", F.col(f"sources.{f}"))) for f in STANDARD_FIELDS}
    )
    numbers = texts.withColumns(
        {
            f"_n_{f}": rate_number(F.col(f"_t_{f}")) if f == "tax_rate" else amount_number(F.col(f"_t_{f}"))
            for f in numeric
        }
    )

    def value(field: str) -> Column:
        text, number = F.col(f"_t_{field}"), F.col(f"_n_{field}") if field in numeric else None
        if field == "tax_rate":
            return F.when(number.between(0, 100), number)
        if field in AMOUNT_FIELDS:
            return number
        return F.substring(text, 1, options.max_text) if field in CAPPED_FIELDS else text

    def warning(field: str) -> Column | None:
        text, header = F.col(f"_t_{field}"), F.col(f"sources.{field}")
        if field == "tax_rate":
            return rate_warning(text, F.col(f"_n_{field}"))
        if field in AMOUNT_FIELDS:
            return amount_warning(text, F.col(f"_n_{field}"), header, options)
        return truncation_warning(text, header, options) if field in CAPPED_FIELDS else None

    warnings = [w for w in map(warning, STANDARD_FIELDS) if w is not None]
    spare = F.map_filter("raw", lambda key, _: ~F.coalesce(F.array_contains("mapped_headers", key), F.lit(False)))
    return numbers.select(
        *rows.columns,
        "mapping_confidence",
        *[value(field).alias(field) for field in STANDARD_FIELDS],
        F.transform_keys(spare, lambda key, _: F.concat(F.lit("_raw_"), key)).alias("extras"),
        F.array_compact(F.array(*warnings)).alias("warnings"),
    )
