"""Cell and field cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookflow.dictionary import RESERVED_NAMES, tx_type_rows
from bookflow.functions.text import WHITESPACE, map_last_wins, strip
from bookflow.options import DEFAULTS, Options

# --- fixed values -------------------------------------------------------------------------------------
FORMULA_PREFIX = "[=+\\-@]"
FORMULA_MARK = "FORMULA_REMOVED:"
DANGEROUS = r"(?i)<script|javascript:|data:text|HYPERLINK|=CMD\(|=SHELL\(|=EXEC\(|\.\./|\x00"
# What such content begins with; spares the list above at every other character.
DANGEROUS_AT = r"(?=[<=.\x00JjDdHh])"
DANGEROUS_MARK = "DANGEROUS_CONTENT_REMOVED"
NULL_TEXTS = ["", "nan", "NaN", "None", "N/A"]
CURRENCY_LABEL = r"(?i)^(pkr|rs\.?|rupees?)\s*"
AMOUNT_FIELDS = ["net_amount", "amount_debit", "amount_credit", "tax_amount"]
DATE_FIELDS = ["transaction_date", "due_date"]
CAPPED_FIELDS = ["vendor", "description", "account_code", "reference_number"]
DATE_LIKE = [
    r"\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4}",
    r"\d{4}[/\-\.]\d{1,2}[/\-\.]\d{1,2}",
    r"(?i)\d{1,2}\s+(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)",
]
# (pattern, mask) in the documented order: the longer personal numbers go first.
PII_MASKS = [
    (r"(?U)\b0\d{10}\b", "[PHONE]"),
    (r"(?U)\+92\d{10}\b", "[PHONE]"),
    (r"(?U)\b\d{5}-\d{7}-\d\b", "[CNIC]"),
    (r"(?U)\b\d{7}\b", "[NTN]"),
    (r"(?U)\b\d{10,16}\b", "[ACCOUNT]"),
]
# The historical order, in which the 7-digit rule fires inside a CNIC and "+92" needs a letter before it.
PII_MASKS_LEGACY = [
    (r"(?U)\b0\d{10}\b", "[PHONE]"),
    (r"(?U)\b\+92\d{10}\b", "[PHONE]"),
    (r"(?U)\b\d{7}\b", "[NTN]"),
    (r"(?U)\b\d{5}-\d{7}-\d\b", "[CNIC]"),
    (r"(?U)\b\d{10,16}\b", "[ACCOUNT]"),
]

# A decimal literal. Guards the cast: Spark also reads '5000d' and 'Infinity' as numbers.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(text: Column) -> Column:
    """Double of a plain decimal literal, else null."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def outcome(value: Column, warning: Column) -> Column:
    """struct(value, warning), the result of every field rule."""
    return F.struct(value.alias("value"), warning.alias("warning"))


def null_values(text: Column) -> Column:
    """Stripped text; the null spellings become null."""
    bare = strip(text)
    return F.when(~bare.isin(NULL_TEXTS), bare)


def amount_number(bare: Column) -> Column:
    """Double of a stripped amount text, null when it is no number.

    Reads a leading PKR / Rs / Rs. / Rupee(s), thousands commas and (5000) for -5000. Python's extra float spellings
    (1_000, inf, nan) count as no number.
    """
    digits = F.regexp_replace(F.regexp_replace(bare, CURRENCY_LABEL, ""), ",", "")
    return to_number(strip(F.regexp_replace(digits, r"(?s)^\((.*)\)$", "-$1")))


def amount_warning(bare: Column, number: Column, header: Column, options: Options = DEFAULTS) -> Column:
    """Warning about a text that is no number or an amount above ``options.large_amount``."""
    unread = F.concat(
        F.lit("Could not parse amount '"), bare, F.lit("' in '"), header, F.lit("' — value will be null")
    )
    large = F.concat(
        F.lit("Very large amount in '"), header, F.lit("': "), F.format_number(number, 2), F.lit(" — please verify")
    )
    return F.when(bare.isNotNull() & number.isNull(), unread).when(F.abs(number) > options.large_amount, large)


def rate_number(bare: Column) -> Column:
    """Double of a stripped percentage text, null when it is no number."""
    return to_number(strip(F.regexp_replace(bare, "%", "")))


def rate_warning(bare: Column, number: Column) -> Column:
    """Warning about a text that is no number or a rate outside 0-100."""
    shown = F.concat(F.lit("Tax rate '"), bare)
    return F.when(bare.isNotNull() & number.isNull(), F.concat(shown, F.lit("' is not numeric"))).when(
        ~number.between(0, 100), F.concat(shown, F.lit("' out of range (0–100)"))
    )


def parse_amount(text: Column, header: Column, options: Options = DEFAULTS) -> Column:
    """struct(value double, warning) of an amount text."""
    bare = null_values(text)
    number = amount_number(bare)
    return outcome(number, amount_warning(bare, number, header, options))


def parse_tax_rate(text: Column) -> Column:
    """struct(value double, warning) of a percentage; outside 0-100 the value is null."""
    bare = null_values(text)
    number = rate_number(bare)
    return outcome(F.when(number.between(0, 100), number), rate_warning(bare, number))


def truncation_warning(bare: Column, header: Column, options: Options = DEFAULTS) -> Column:
    """Warning about a text above ``options.max_text`` characters."""
    limit = options.max_text
    return F.when(
        F.length(bare) > limit, F.concat(F.lit(f"Value truncated to {limit} chars in '"), header, F.lit("'"))
    )


def truncate_text(text: Column, header: Column, options: Options = DEFAULTS) -> Column:
    """struct(value, warning): text cut to ``options.max_text`` characters."""
    bare = null_values(text)
    return outcome(F.substring(bare, 1, options.max_text), truncation_warning(bare, header, options))


def date_passthrough(text: Column) -> Column:
    """struct(value, warning): the stripped text; parsing belongs to the clean layer."""
    return outcome(null_values(text), F.lit(None).cast("string"))


def neutralize_cell(text: Column) -> Column:
    """Cell text with formulas marked and dangerous content replaced; other cells come back untouched."""
    formula = f"^[{WHITESPACE}]*{FORMULA_PREFIX}"
    return (
        F.when(text.rlike(formula), F.concat(F.lit(FORMULA_MARK), strip(text)))
        .when(text.rlike(f"{DANGEROUS_AT}(?:{DANGEROUS})"), F.lit(DANGEROUS_MARK))
        .otherwise(text)
    )


def neutralize_row(raw: Column) -> Column:
    """``neutralize_cell`` on every value of a string map."""
    return F.transform_values(raw, lambda _, value: neutralize_cell(value))


def neutralized_count(raw: Column) -> Column:
    """How many cells of a string map ``neutralize_cell`` changes."""
    return F.size(F.filter(F.map_values(raw), lambda value: ~value.eqNullSafe(neutralize_cell(value))))


def is_reserved(name: Column) -> Column:
    """The name, in any case, is one of the internal names."""
    return F.lower(name).isin(RESERVED_NAMES)


def rename_reserved(name: Column) -> Column:
    """``raw_<name>`` for reserved names, other names unchanged."""
    return F.when(is_reserved(name), F.concat(F.lit("raw_"), name)).otherwise(name)


def rename_reserved_keys(raw: Column) -> Column:
    """``rename_reserved`` on every key of a string map; maps without a reserved key are passed through.

    A file may hold a renamed key already; of two cells that end up under one key the later one stays.
    """
    renamed = map_last_wins(F.transform(F.map_keys(raw), rename_reserved), F.map_values(raw))
    return F.when(F.exists(F.map_keys(raw), is_reserved), renamed).otherwise(raw)


def normalize_tx_type(text: Column) -> Column:
    """Standard transaction type: blank gives unknown, a text outside the list its lower case."""
    bare = strip(text)
    standard = F.create_map(*[F.lit(part) for pair in tx_type_rows() for part in pair])
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("unknown")).otherwise(
        F.coalesce(F.try_element_at(standard, bare), F.lower(bare))
    )


def mask_pii(text: Column, legacy_order: bool = False) -> Column:
    """Phone, tax, identity-card and account numbers replaced by their mask. All of them have seven digits in a row."""
    masked = text
    for pattern, mask in PII_MASKS_LEGACY if legacy_order else PII_MASKS:
        masked = F.regexp_replace(masked, pattern, mask)
    return F.when(text.rlike(r"(?U)\d{7}"), masked).otherwise(text)


def looks_like_date(text: Column) -> Column:
    """Some part of the text reads like a date."""
    found = F.lit(False)
    for pattern in DATE_LIKE:
        found = found | text.rlike(pattern)
    return found


def row_to_json(raw: Column) -> Column:
    """JSON object of a string map; keeps names, null values and non-ASCII text."""
    return F.to_json(raw, {"ignoreNullFields": "false"})


def headers_to_json(headers: Column) -> Column:
    """JSON array of header names."""
    return F.to_json(headers)


def json_to_row(content: Column) -> Column:
    """String map of a JSON object."""
    return F.from_json(content, "map<string,string>")
