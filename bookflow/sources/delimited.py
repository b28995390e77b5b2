"""Delimited files: bytes to rows in one narrow pass.

A file is one input row (larger ones go through ``large_delimited``), everything up to the exploded records is a
column expression on that row, and nothing is shuffled: files parse in parallel and keep their row order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookflow.functions.text import let, map_last_wins, strip
from bookflow.options import DEFAULTS, Options

# --- fixed values (the sniffing patterns below are those of Python's csv.Sniffer) -----------------------
DELIMITERS = [",", "\t", ";", "|"]
SUMMARY_WORDS = [
    "total", "sub-total", "subtotal", "grand total", "sum", "balance", "closing balance", "opening balance",
    "kul", "majmua",
]
PARSE_METHOD = "chardet_csv"
# Bytes 0x80-0x9F of Windows-1252; the five undefined ones are left out.
CP1252_BYTES = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_UNDEFINED = "[\x81\x8d\x8f\x90\x9d]"

BOM = "\ufeff"


def _is_ascii(content: Column) -> Column:
    text = content.cast("string")
    return F.is_valid_utf8(text) & (F.octet_length(text) == F.char_length(text))


def _has_bom(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 3)) == "EFBBBF"


def detect_encoding(content: Column, options: Options = DEFAULTS) -> Column:
    """struct(encoding, confidence, decoder): what the bytes look like, and the decoder that reads all of them.

    ``encoding`` looks at all bytes, or at the first ``options.encoding_sample_bytes``; a guess below
    ``options.encoding_min_confidence`` is reported as utf-8-sig. ``decoder`` is the first of utf-8, cp1252 and
    latin-1 that reads the whole file without error. Guesses rest on strict validity, not on letter statistics.
    """
    limit = options.encoding_sample_bytes
    sample = content if limit is None else F.substring(content, 1, limit)
    valid = F.is_valid_utf8(content.cast("string"))
    latin = F.decode(content, "ISO-8859-1")

    def verdict(encoding: str, confidence: float, decoder: Column) -> Column:
        reported = encoding if confidence >= options.encoding_min_confidence else "utf-8-sig"
        return F.struct(
            F.lit(reported).alias("encoding"), F.lit(confidence).alias("confidence"), decoder.alias("decoder")
        )

    decoder = F.when(valid, "utf-8").when(~latin.rlike(CP1252_UNDEFINED), "cp1252").otherwise("latin-1")
    return (
        F.when(_has_bom(content), verdict("utf-8-sig", 1.0, decoder))
        .when(_is_ascii(sample), verdict("utf-8", 1.0, decoder))
        .when(valid, verdict("utf-8", 0.99, decoder))
        .otherwise(verdict("cp1252", 0.73, decoder))
    )


def decode_with_fallback(content: Column, decoder: Column) -> Column:
    """Text of the bytes, without byte-order mark, with every line end turned into \\n."""
    latin = F.decode(content, "ISO-8859-1")
    text = (
        F.when(decoder == "utf-8", content.cast("string"))
        .when(decoder == "cp1252", F.translate(latin, CP1252_BYTES, CP1252_CHARS))
        .otherwise(latin)
    )
    return F.regexp_replace(F.regexp_replace(text, f"^{BOM}", ""), "\r\n?", "\n")


def _occurrences(text: Column, char: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, char, F.lit("")))


def _best(score: Callable[[Column], Column], floor: int) -> Column:
    """The delimiter with the highest score of at least ``floor``, the first listed on a tie, else null."""
    listed = F.array(*[F.lit(d) for d in DELIMITERS])
    scored = F.transform(
        listed, lambda d, i: F.struct(score(d).cast("int").alias("score"), (-i).alias("place"), d.alias("delimiter"))
    )
    return let(F.array_max(scored), lambda best: F.when(best["score"] >= floor, best["delimiter"]))


def _beside_quotes(sample: Column) -> Column:
    """The delimiter most often found next to a quoted field, null without quoted fields."""
    patterns = [
        (r"""(?s)([^\w\n"'])( ?)(["']).*?\3\1""", 1),
        (r"""(?s)(?:^|\n)(["']).*?\1([^\w\n"'])""", 2),
        (r"""(?sm)([^\w\n"'])( ?)(["']).*?\3(?:$|\n)""", 1),
    ]
    found = F.coalesce(
        *[
            let(F.regexp_extract_all(sample, F.lit(p), group), lambda hits: F.when(F.size(hits) > 0, hits))
            for p, group in patterns
        ]
    )
    most = let(found, lambda hits: _best(lambda d: F.size(F.filter(hits, lambda char: char == d)), 1))
    return F.when(sample.contains('"') | sample.contains("'"), most)


def _by_regularity(lines: Column) -> Column:
    """The delimiter whose count per line is most regular, null when none is regular enough."""

    def score(delimiter: Column) -> Column:
        # 100 x (lines with the usual count - other lines) / lines, for a usual count above 0.
        def usual(counts: Column) -> Column:
            return F.array_max(
                F.transform(
                    F.array_distinct(F.filter(counts, lambda c: c > 0)),
                    lambda v: F.size(F.filter(counts, lambda c: c == v)),
                )
            )

        n = F.size(lines)
        regular = let(F.transform(lines, lambda line: _occurrences(line, delimiter)), usual)
        return F.coalesce(F.floor(100 * (2 * regular - n) / n), F.lit(0))

    return F.when(F.size(lines) > 0, _best(score, 90))


def detect_delimiter(text: Column, options: Options = DEFAULTS) -> Column:
    """Comma, tab, semicolon or pipe.

    In turn: the delimiter beside quoted fields; the one occurring equally often on the lines of the sample (the
    first ten, then all); the most frequent one in the first lines; comma.
    """

    def decide(sample: Column) -> Column:
        every_line = F.split(sample, "\n")
        head = F.array_join(F.slice(every_line, 1, options.delimiter_fallback_lines), "\n")
        regular = let(
            F.filter(every_line, lambda line: line != ""),
            lambda lines: F.coalesce(
                let(F.slice(lines, 1, 10), _by_regularity), F.when(F.size(lines) > 10, _by_regularity(lines))
            ),
        )
        frequent = let(head, lambda top: _best(lambda d: _occurrences(top, d), 1))
        return F.coalesce(_beside_quotes(sample), regular, frequent, F.lit(","))

    return let(F.substring(text, 1, options.delimiter_sample_chars), decide)


def _per_delimiter(delimiter: Column, pattern: str) -> Column:
    """``pattern`` with ~ standing for the delimiter; ~ is only used where a bare character is safe."""
    choice = F.when(F.lit(False), F.lit(""))
    for d in DELIMITERS:
        choice = choice.when(delimiter == d, F.lit(pattern.replace("~", d)))
    return choice


# A quote opens a quoted field only at the start of a field; "" is a quote; text behind the closing quote stays.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+(?:"[^~\n]*+)?'
_FIELD = rf" *+(?:{_QUOTED}|[^~\n]*+)"


def split_records(text: Column, delimiter: Column) -> Column:
    """Records of a text; a line end inside quotes does not end a record."""
    pattern = _per_delimiter(delimiter, rf"({_FIELD}(?:[~]{_FIELD})*+)(?:\n|\z)")
    return F.when(text.contains('"'), F.regexp_extract_all(text, pattern, 1)).otherwise(F.split(text, "\n"))


def _unquote(field: Column) -> Column:
    parts = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"?(.*)$'
    inner = F.replace(F.regexp_extract(field, parts, 1), F.lit('""'), F.lit('"'))
    return F.when(field.startswith('"'), F.concat(inner, F.regexp_extract(field, parts, 2))).otherwise(field)


def split_fields(record: Column, delimiter: Column) -> Column:
    """Fields of a record, unquoted, without leading spaces."""
    quoted = F.regexp_extract_all(
        F.concat(delimiter, record), _per_delimiter(delimiter, rf"[~]({_FIELD.replace(chr(92) + 'n', '')})"), 1
    )
    plain = F.when(delimiter == "|", F.split(record, r"\|"))
    for d in DELIMITERS[:3]:
        plain = plain.when(delimiter == d, F.split(record, d))
    fields = F.when(record.contains('"'), quoted).otherwise(plain)
    return F.transform(F.transform(fields, lambda field: F.ltrim(field)), _unquote)


def _last_places(headers: Column) -> Column:
    """Map from each distinct header to its last place (0-based)."""
    return map_last_wins(headers, F.sequence(F.lit(0), F.size(headers) - 1))


def parse_delimited(files: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """One row per file: its columns without ``content``, plus encoding, encoding_confidence, delimiter, headers,
    total_rows, total_cols, parse_method and ``records``, the rows that are neither blank nor summary rows.

    A record is struct(source_record_number, values, overflow): values stand in the order of the distinct headers
    (the last of equal headers counts), a short record ends in nulls, fields past the headers are the overflow.
    """
    kept = [c for c in files.columns if c != "content"]
    decoded = files.withColumn("detected", detect_encoding(F.col("content"), options)).select(
        *kept, "detected", decode_with_fallback(F.col("content"), F.col("detected.decoder")).alias("text")
    )
    split = (
        decoded.withColumn("delimiter", detect_delimiter(F.col("text"), options))
        .withColumn("lines", split_records(F.col("text"), F.col("delimiter")))
        .drop("text")
        .withColumn("top", F.get("lines", F.lit(0)))
        .withColumn(
            "headers",
            F.when(F.col("top") == "", F.array().cast("array<string>")).otherwise(
                F.transform(split_fields(F.col("top"), F.col("delimiter")), strip)
            ),
        )
        .withColumn("places", F.map_values(_last_places(F.col("headers"))))
    )

    def record(line: Column, position: Column) -> Column:
        width = F.size("headers")
        return let(
            split_fields(line, F.col("delimiter")),
            lambda fields: F.struct(
                (position + 2).alias("source_record_number"),
                F.transform("places", lambda place: strip(F.get(fields, place))).alias("values"),
                F.when(line == "", F.array().cast("array<string>"))
                .otherwise(F.slice(fields, width + 1, F.size(fields)))
                .alias("overflow"),
            ),
        )

    parsed = split.withColumn(
        "records", F.transform(F.slice("lines", F.lit(2), F.greatest(F.size("lines"), F.lit(1))), record)
    ).withColumn("records", F.filter("records", lambda r: ~is_blank_row(r) & ~is_summary_row(r)))
    return parsed.select(
        *kept,
        F.col("detected.encoding").alias("encoding"),
        F.col("detected.confidence").alias("encoding_confidence"),
        "delimiter",
        "headers",
        F.size("records").alias("total_rows"),
        F.size("headers").alias("total_cols"),
        F.lit(PARSE_METHOD).alias("parse_method"),
        "records",
    )


def is_blank_row(record: Column) -> Column:
    """Every (stripped) value is null or empty and there is no overflow."""
    return F.forall(record["values"], lambda v: v.isNull() | (v == "")) & (F.size(record["overflow"]) == 0)


def is_summary_row(record: Column) -> Column:
    """The first (stripped) value that is not empty is a word for totals."""
    first = F.get(F.filter(record["values"], lambda v: v != ""), F.lit(0))
    return F.coalesce(F.lower(first).isin(SUMMARY_WORDS), F.lit(False))


def explode_all(parsed: DataFrame) -> DataFrame:
    """One row per kept record with source_row_number, headers, ``raw`` and ``overflow``, and one without a number for a
    file that has none, so that every file is there with its metadata."""
    kept = [c for c in parsed.columns if c != "records"]
    # The outer form: the inner one makes the optimizer push "size(records) > 0" below the parser, which would then
    # run twice.
    exploded = parsed.select(*kept, F.posexplode_outer("records").alias("pos", "record"))
    return exploded.select(
        *kept,
        (F.col("pos") + 1).alias("source_row_number"),
        F.col("record.source_record_number"),
        F.when(F.col("pos").isNotNull(), F.map_from_arrays(F.array_distinct("headers"), "record.values")).alias("raw"),
        F.col("record.overflow").alias("overflow"),
    )


def split_surplus(exploded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected rows): one surplus field is kept as the overflow; a record with two or more is rejected with a
    reason, its number stays used."""
    rows = exploded.filter(F.col("source_row_number").isNotNull())
    surplus = F.size("overflow") > 1
    reason = F.concat(F.size("overflow").cast("string"), F.lit(" values past the last header"))
    return rows.filter(~surplus), rows.filter(surplus).withColumn("error", reason)


def explode_records(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected rows) of parsed files; rows are numbered from 1 over the kept records."""
    return split_surplus(explode_all(parsed))


META = ["encoding", "encoding_confidence", "delimiter", "total_rows", "total_cols", "parse_method"]


def parse_metadata(parsed: DataFrame) -> DataFrame:
    """Per file: encoding, encoding_confidence, delimiter, total_rows, total_cols, parse_method."""
    return parsed.select("file_hash", *META)
