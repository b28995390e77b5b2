"""Workbook reading over the long cells table.

``cells``: file_hash, sheet_idx, sheet, row_idx, col_idx, value, is_string (0-based places). Cells are shuffled once, by
file; a file's rows pass one task in their order, as numbering them needs anyway, and windows over them go to disk
beyond some thousand rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from bookflow.functions.text import is_blank, let, map_last_wins, strip
from bookflow.functions.values import looks_like_date
from bookflow.options import DEFAULTS, Options

# --- fixed values: cell texts read as null, of the reader itself and on top of it ----------------------
READER_NULLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
EXTRA_NULLS = [" ", "-", "--"]
BLANK_ROW_TEXTS = ["", "nan", "NaN", "None"]


def pick_sheet(cells: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """(file_hash, sheet_idx, sheet): the sheet with most non-empty rows at its top, the earliest on a tie."""
    top = F.when(F.col("row_idx") < options.sheet_scan_rows, F.col("row_idx"))
    sheets = cells.groupBy("file_hash", "sheet_idx", "sheet").agg(F.count_distinct(top).alias("filled"))
    place = F.struct("sheet_idx", "sheet")
    # Cells without a file are judged by nothing but their place.
    judged = (F.col("filled") > 0) & F.col("file_hash").isNotNull()
    best = F.max_by(place, F.when(judged, F.struct("filled", -F.col("sheet_idx"))))
    picked = sheets.groupBy("file_hash").agg(best.alias("b"), F.min(place).alias("s"))
    return picked.select("file_hash", F.coalesce("b", "s").alias("p")).select("file_hash", "p.*")


def _header_signs(options: Options) -> list[Column]:
    """Aggregates over the cells of a row: ``filled`` cells and ``texts`` among them, in the rows a header may stand in."""
    filled = (F.col("row_idx") < options.header_scan_rows) & ~is_blank(F.col("value"))
    texts = filled & F.col("is_string") & ~looks_like_date(F.col("value"))
    return [F.count_if(filled).alias("filled"), F.count_if(texts).alias("texts")]


def _may_be_header(options: Options) -> Column:
    return (F.col("filled") >= options.header_min_cells) & (F.col("texts") * 2 >= F.col("filled"))


def detect_header_row(sheet: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """(file_hash, header_row): the first top row with enough filled cells, half of them text that is no date."""
    top = F.when(F.col("row_idx") < options.header_scan_rows, F.col("row_idx"))
    # The rows below the top are one group.
    rows = sheet.withColumn("top", top).groupBy("file_hash", "top").agg(*_header_signs(options))
    fits = _may_be_header(options) & F.col("file_hash").isNotNull()
    found = F.min(F.when(fits, F.col("top")))
    return rows.groupBy("file_hash").agg(F.coalesce(found, F.lit(0)).alias("header_row"))


def null_tokens(value: Column) -> Column:
    """Cell text, null for the null spellings."""
    return F.when(~value.isin(READER_NULLS + EXTRA_NULLS), value)


def _earlier(entries: Column, place: Column, field: str, value: Column) -> Column:
    """How many entries before ``place`` have ``value`` in ``field``."""
    return F.size(F.filter(F.slice(entries, 1, place), lambda e: e[field].eqNullSafe(value)))


def _numbered(text: Column, sign: str, copy: Column) -> Column:
    return F.when(copy > 0, F.concat(text, F.lit(sign), copy.cast("string"))).otherwise(text)


def _clean_names(entries: Column) -> Column:
    """Header names of a file's columns: structs of col_idx and value in order to structs of col_idx and header."""

    def named(e: Column, i: Column) -> Column:
        read = _numbered(e["value"], ".", _earlier(entries, i, "value", e["value"]))
        position = F.concat(F.lit("Column_"), e["col_idx"].cast("string"))
        name = let(read, lambda r: F.when(is_blank(r) | r.startswith("Unnamed:"), position).otherwise(strip(r)))
        return F.struct(e["col_idx"].alias("col_idx"), name.alias("header"))

    def told_apart(names: Column) -> Column:
        def header(e: Column, i: Column) -> Column:
            text = _numbered(e["header"], "_", _earlier(names, i, "header", e["header"]))
            return F.struct(e["col_idx"].alias("col_idx"), text.alias("header"))

        return F.transform(names, header)

    return let(F.transform(entries, named), told_apart)


def _positional_names(entries: Column) -> Column:
    """The names of the tolerant reader: stripped text, Column_<i> for an empty cell."""

    def header(e: Column) -> Column:
        text = F.coalesce(strip(e["value"]), F.concat(F.lit("Column_"), e["col_idx"].cast("string")))
        return F.struct(e["col_idx"].alias("col_idx"), text.alias("header"))

    return F.transform(entries, header)


def clean_headers(header_cells: DataFrame) -> DataFrame:
    """(file_hash, col_idx, header): one name per column of the header row.

    ``header_cells`` has one row per file and column; ``value`` is null for an empty cell. Equal names get .1, .2 as
    the reader numbers them; then names are stripped, empty ones become Column_<i> and names equal after stripping get
    _1, _2.
    """
    listed = header_cells.groupBy("file_hash").agg(F.array_sort(F.collect_list(F.struct("col_idx", "value"))).alias("es"))
    return listed.select("file_hash", F.inline(_clean_names(F.col("es"))))


def sheet_rows(cells: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """A row per row of every sheet: file_hash, sheet_idx, row_idx, ``cells`` (col_idx, value) and the header signs.

    The cells are shuffled once, by file: all that follows for the rows of a workbook finds them sorted in one task,
    which holds a row at a time and a file's header list.
    """
    placed = cells.filter("file_hash IS NOT NULL AND sheet_idx IS NOT NULL AND row_idx IS NOT NULL").repartition("file_hash")
    return placed.groupBy("file_hash", "sheet_idx", "row_idx").agg(
        F.collect_list(F.struct("col_idx", "value")).alias("cells"), *_header_signs(options)
    )


def _of(*keys: str) -> WindowSpec:
    """All rows with the same ``keys`` (file_hash, or file_hash and sheet_idx), in the order of the file."""
    order = [c for c in ("sheet_idx", "row_idx") if c not in keys]
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def chosen_sheet(cells: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """``sheet_rows`` of the sheet that ``pick_sheet`` picks, with the file's ``header_row`` as of ``detect_header_row``."""
    sheet, file = _of("file_hash", "sheet_idx"), _of("file_hash")
    found = F.min(F.when((F.col("row_idx") < options.header_scan_rows) & _may_be_header(options), F.col("row_idx")))
    order = F.when(F.col("top_rows") > 0, F.struct("top_rows", -F.col("sheet_idx")))
    return (
        sheet_rows(cells, options)
        .withColumn("top_rows", F.count_if(F.col("row_idx") < options.sheet_scan_rows).over(sheet))
        .withColumn("header_row", F.coalesce(found.over(sheet), F.lit(0)))
        .withColumn("best", F.max_by("sheet_idx", order).over(file))
        .withColumn("first", F.min("sheet_idx").over(file))
        .filter(F.col("sheet_idx") == F.coalesce("best", "first"))
        .select("file_hash", "sheet_idx", "row_idx", "cells", "header_row")
    )


def header_cells(sheet: DataFrame) -> DataFrame:
    """One row per file and column up to the last used one, with the header cell's text or null."""
    width = sheet.filter(F.col("row_idx") >= F.col("header_row")).groupBy("file_hash").agg(
        F.max("col_idx").alias("last")
    )
    places = width.select("file_hash", F.explode(F.sequence(F.lit(0), "last")).alias("col_idx"))
    named = sheet.filter(F.col("row_idx") == F.col("header_row")).select("file_hash", "col_idx", "value")
    return places.join(named, ["file_hash", "col_idx"], "left")


def _header_entries(last: Column, cells: Column) -> Column:
    """``header_cells`` of one file as a sorted array: an entry per column up to ``last``, from the header row's ``cells``."""
    known = F.filter(F.coalesce(cells, F.array().cast("array<struct<col_idx:int,value:string>>")), lambda c: c["col_idx"].between(0, last))
    empty = F.transform(
        F.array_except(F.sequence(F.lit(0), last), F.transform(known, lambda c: c["col_idx"])),
        lambda i: F.struct(i.alias("col_idx"), F.lit(None).cast("string").alias("value")),
    )
    return F.array_sort(F.concat(known, empty))


def with_headers(sheet: DataFrame, mode: str = "clean") -> DataFrame:
    """Rows below the header row of ``chosen_sheet`` with ``hs`` (col_idx, header) and ``values``, their cells.

    ``mode="clean"`` takes null texts for empty cells, and empty columns and rows vanish. What is the same in all rows of
    a file is worked out in its first row and handed on.
    """
    file, clean = _of("file_hash"), mode == "clean"
    below = F.col("row_idx") > F.col("header_row")
    values = F.col("cells")
    if clean:
        values = F.filter(
            F.transform(values, lambda c: F.struct(c["col_idx"].alias("col_idx"), null_tokens(c["value"]).alias("value"))),
            lambda c: c["value"].isNotNull(),
        )
    last = F.max(F.when(F.col("row_idx") >= F.col("header_row"), F.array_max(F.transform("cells", lambda c: c["col_idx"]))))
    places = F.array_sort(F.transform("values", lambda c: c["col_idx"]))
    placed = (
        sheet.withColumn("values", F.when(below, values))
        .withColumn("last", last.over(file))
        .withColumn("head", F.first(F.when(F.col("row_idx") == F.col("header_row"), F.col("cells")), ignorenulls=True).over(file))
        .withColumn("number", F.row_number().over(Window.partitionBy("file_hash").orderBy("sheet_idx", "row_idx")))
    )
    names = (_clean_names if clean else _positional_names)(_header_entries(F.col("last"), F.col("head")))
    if clean:
        # Rows use few different sets of columns.
        placed = placed.withColumn("used", F.collect_set(places).over(file))
        names = let(F.flatten("used"), lambda used: F.filter(names, lambda h: F.array_contains(used, h["col_idx"])))
    once = F.when((F.col("number") == 1) & F.col("last").isNotNull(), names)
    listed = placed.withColumn("hs", once).withColumn("hs", F.first("hs", ignorenulls=True).over(file))
    return listed.filter(below & (F.size("values") > 0)).select("file_hash", "sheet_idx", "row_idx", "values", "hs")


def cells_to_rows(data: DataFrame) -> DataFrame:
    """Rows of ``with_headers`` with ``headers``, ``raw`` (string map in header order) and source_row_number from 1."""
    number = F.row_number().over(Window.partitionBy("file_hash").orderBy("sheet_idx", "row_idx"))
    return (
        data.withColumn("cells", F.map_from_entries("values"))
        .withColumn("headers", F.transform("hs", lambda h: h["header"]))
        .withColumn("vs", F.transform("hs", lambda h: F.try_element_at("cells", h["col_idx"])))
        .filter(F.exists("vs", lambda v: ~is_blank(v) & ~strip(v).isin(BLANK_ROW_TEXTS)))
        .select(
            "file_hash", number.cast("int").alias("source_row_number"), (F.col("row_idx") + 1).alias("sheet_row"),
            "headers", map_last_wins(F.col("headers"), F.col("vs")).alias("raw"),
        )
    )


def read_workbooks(cells: DataFrame, mode: str = "clean", options: Options = DEFAULTS) -> DataFrame:
    """Rows of workbooks given as cells. ``mode="raw"`` is the tolerant reader: no null texts, no empty-column drop."""
    return cells_to_rows(with_headers(chosen_sheet(cells, options), mode))


def workbook_metadata(rows: DataFrame, cells: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """(file_hash, parse_meta): JSON with sheet_name, header_row, total_rows, total_cols and parse_method."""
    counted = rows.groupBy("file_hash").agg(
        F.count("*").cast("int").alias("total_rows"), F.max(F.size("headers")).alias("total_cols")
    )
    picked = pick_sheet(cells, options)
    sheet = cells.join(picked.select("file_hash", "sheet_idx"), ["file_hash", "sheet_idx"], "left_semi")
    placed = picked.join(detect_header_row(sheet, options), "file_hash").join(counted, "file_hash", "left")
    meta = F.struct(
        F.col("sheet").alias("sheet_name"), "header_row", F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
        F.coalesce("total_cols", F.lit(0)).alias("total_cols"), F.lit("pandas_openpyxl").alias("parse_method"),
    )
    return placed.select("file_hash", F.to_json(meta).alias("parse_meta"))
