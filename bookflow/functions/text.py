"""Text functions over string columns. All but ``nfc`` are built-in expressions."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character Python's str.strip() removes; Spark's one-argument trim removes the ASCII space only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(code) for code in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Characters that can make a text differ from its NFC: all marks, the letters with a canonical decomposition that NFC
# does not restore, and Hangul jamo. Text without any of them is its own NFC.
COMPOSABLE = (
    r"[\p{M}\u0374\u037E\u0387\u0958-\u095F\u09DC-\u09DF\u0A33-\u0A36\u0A59-\u0A5E\u0B5C\u0B5D\u0F43-\u0F69"
    r"\u1100-\u11FF\u1F71-\u1FFD\u2000\u2001\u2126-\u212B\u2329\u232A\u2ADC\uF900-\uFAFF\uFB1D-\uFB4F"
    r"\x{1D15E}-\x{1D1C0}\x{2F800}-\x{2FA1D}\x{11000}-\x{11FFF}\x{16D00}-\x{16DFF}]"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Text without leading and trailing Unicode whitespace."""
    return F.trim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null and for text that is whitespace only."""
    return text.isNull() | (strip(text) == "")


@F.pandas_udf(T.StringType())
def _nfc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.str.normalize("NFC")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfc_array(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """NFC on the texts of a JSON array. Rows travel as text: Spark measures a batch at every row, and for a column of
    arrays it walks over all nulls before that row."""
    def compose(texts):
        return None if texts is None else [t and unicodedata.normalize("NFC", t) for t in json.loads(texts)]

    for batch in batches:
        yield batch.map(compose)


def nfc(text: Column) -> Column:
    """Unicode NFC. Spark has no such function; text that is its own NFC travels to Python as null."""
    return F.coalesce(_nfc(F.when(text.rlike(COMPOSABLE), text)), text)


def normalize_unicode(rows: DataFrame, column: str = "raw") -> DataFrame:
    """NFC on every key and value of a string-map column; only maps with something to compose travel to Python."""
    raw, texts = F.col(column), F.col("_texts")
    both = F.concat(F.map_keys(raw), F.map_values(raw))
    joined = F.array_join(both, " ")
    # Pure ASCII, which has as many characters as bytes, holds nothing to compose.
    composable = (F.octet_length(joined) != F.length(joined)) & joined.rlike(COMPOSABLE)
    composed = rows.withColumn("_texts", _nfc_array(F.when(composable, F.to_json(both))))
    width = F.size(raw)
    normal = map_last_wins(F.slice(texts, F.lit(1), width), F.slice(texts, width + 1, width))
    return composed.withColumn(column, F.when(texts.isNull(), raw).otherwise(normal)).drop("_texts")


def map_last_wins(keys: Column, values: Column) -> Column:
    """Map of two parallel arrays; a repeated key keeps its first place and its last value."""
    once = F.array_distinct(keys)
    backwards = F.reverse(keys)
    picked = F.transform(once, lambda k: F.get(values, F.size(keys) - F.array_position(backwards, k)))
    return F.map_from_arrays(once, picked)


def normalize_name(text: Column, composed: bool = False) -> Column:
    """Header text for comparison: NFC, lower case, no (...), no punctuation, single spaces; null gives "".

    ``composed`` says the text is in NFC already, which keeps the expression free of Python.
    """
    text = text if composed else nfc(text)
    outside = F.regexp_replace(F.lower(text), r"\([^)]*\)", "")
    words = F.regexp_replace(outside, r"(?U)[^\p{L}\p{N}_\s]", "")
    return F.coalesce(strip(F.regexp_replace(words, r"(?U)\s+", " ")), F.lit(""))


def grams(text: Column, n: int) -> Column:
    """Set of the character n-grams of a text; empty when the text is shorter than n."""
    return F.when(
        F.length(text) >= n,
        F.array_distinct(
            F.transform(F.sequence(F.lit(1), F.length(text) - F.lit(n - 1)), lambda i: F.substring(text, i, F.lit(n)))
        ),
    ).otherwise(F.array().cast("array<string>"))


def bigram_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of the character-bigram sets of two texts; 0.0 when either set is empty."""
    left, right = grams(a, 2), grams(b, 2)
    either = F.size(F.array_union(left, right))
    both = F.size(F.array_intersect(left, right))
    return F.when((F.size(left) > 0) & (F.size(right) > 0), both / either).otherwise(F.lit(0.0))


def round_half_even(value: Column, places: int) -> Column:
    """Round the exact binary value half to even (Spark's round() works on the shortest decimal text)."""
    return F.regexp_replace(F.format_number(value, places), ",", "").cast("double")
