import sys
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bookflow.functions import ledger as lx
from bookflow.functions import text as tx
from bookflow.functions import values as vx


def apply(spark, values, column, schema="s string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[1] for r in rows.select("i", column(F.col("s"))).orderBy("i").collect()]


def test_strip_is_pythons_strip(spark):
    padded = [f"{chr(c)}x{chr(c)}" for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    assert apply(spark, padded, tx.strip) == [p.strip() for p in padded]


def test_composable_covers_every_character_nfc_can_change(spark):
    seconds = set()
    for code in range(sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            seconds.add(int(parts[1], 16))
    texts = [
        chr(c) for c in range(sys.maxunicode + 1)
        if not 0xD800 <= c < 0xE000
        and (c in seconds or unicodedata.normalize("NFC", chr(c)) != chr(c) or 0x1161 <= c <= 0x1175 or 0x11A8 <= c <= 0x11C2)
    ]
    assert all(apply(spark, texts, lambda s: s.rlike(tx.COMPOSABLE)))


def test_nfc(spark):
    texts = ["plain", "café", "تاریخ", "آ", None, "한", "K"]
    assert apply(spark, texts, tx.nfc) == [t and unicodedata.normalize("NFC", t) for t in texts]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="aB(é) -_.٣ ر", max_size=12), min_size=20, max_size=40))
def test_normalize_name_model(texts):
    import re

    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()

    def model(t):
        t = re.sub(r"\([^)]*\)", "", unicodedata.normalize("NFC", t).lower())
        return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", t)).strip()

    assert apply(spark, texts, tx.normalize_name) == [model(t) for t in texts]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.text("abc ", max_size=8), st.text("abc ", max_size=8)), min_size=20, max_size=40))
def test_jaccard_model(pairs):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()

    def model(a, b):
        x, y = ({t[i : i + 2] for i in range(len(t) - 1)} for t in (a, b))
        return len(x & y) / len(x | y) if x and y else 0.0

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = df.select("i", tx.bigram_jaccard(F.col("a"), F.col("b"))).orderBy("i").collect()
    assert [r[1] for r in got] == [model(a, b) for a, b in pairs]


AMOUNTS = {
    "45,000": 45000.0, "PKR 5,000": 5000.0, "Rs. 12,500": 12500.0, "(5000)": -5000.0, "N/A": None, "5000d": None, "5f": None,
    "1_000": None, "inf": None, "(PKR 5,000)": None, "(-5)": None, "( 5 )": None, "rupees 7": 7.0, "-3.5": -3.5, ".5": 0.5,
    "5.": 5.0, "1e3": 1000.0, "": None, "FORMULA_REMOVED:-5000": None,
}


def test_amounts(spark):
    got = apply(spark, list(AMOUNTS), lambda s: vx.parse_amount(s, F.lit("Amt"))["value"])
    assert got == list(AMOUNTS.values())
    warnings = apply(spark, ["x", "2000000000", "N/A", "5"], lambda s: vx.parse_amount(s, F.lit("Amt"))["warning"])
    assert warnings == [
        "Could not parse amount 'x' in 'Amt' — value will be null",
        "Very large amount in 'Amt': 2,000,000,000.00 — please verify", None, None,
    ]


def test_cells(spark):
    cells = ["=SUM(A1:A10)", "+5000", " @cmd(x) ", "5000", "Shell Clifton", "01/01/2024", "a<SCRIPT>b", "../etc", "  ", None, "-5"]
    assert apply(spark, cells, vx.neutralize_cell) == [
        "FORMULA_REMOVED:=SUM(A1:A10)", "FORMULA_REMOVED:+5000", "FORMULA_REMOVED:@cmd(x)", "5000", "Shell Clifton",
        "01/01/2024", "DANGEROUS_CONTENT_REMOVED", "DANGEROUS_CONTENT_REMOVED", "  ", None, "FORMULA_REMOVED:-5",
    ]


def test_pii_orders(spark):
    texts = ["12345-1234567-1", "+923001234567", "03001234567", "1234567", "1234567890123456"]
    assert apply(spark, texts, vx.mask_pii) == ["[CNIC]", "[PHONE]", "[PHONE]", "[NTN]", "[ACCOUNT]"]
    assert apply(spark, texts, lambda s: vx.mask_pii(s, True)) == [
        "12345-[NTN]-1", "+[ACCOUNT]", "[PHONE]", "[NTN]", "[ACCOUNT]",
    ]


def test_tx_types(spark):
    texts = ["Payment", "Cash Payment", "BP", "Journal", "JV", "J/V", "SomeWeirdType", "payment ", "", None, "  "]
    assert apply(spark, texts, vx.normalize_tx_type) == [
        "payment", "payment", "payment", "journal", "journal", "journal", "someweirdtype", "payment", "unknown", "unknown", "",
    ]


def test_rounding_is_half_even_on_the_binary_value(spark):
    numbers = [0.0625, 0.1875, 0.7125, 0.41249999999999998, 0.8905, 0.5995]
    rounded = apply(spark, numbers, lambda s: tx.round_half_even(s, 3), "s double")
    assert rounded == [round(n, 3) for n in numbers]


@pytest.mark.parametrize("text, day, method", [
    ("15/01/2024", "2024-01-15", "d/M/y"), ("2024-1-5", "2024-01-05", "iso"), ("31/02/2024", None, None),
    ("3 Mar 2024", "2024-03-03", "d MMM y"), ("2024-01-15 00:00:00", "2024-01-15", "iso_timestamp"), ("soon", None, None),
])
def test_dates(spark, text, day, method):
    got = apply(spark, [text], lx.parse_date)[0]
    assert (str(got["date"]) if got["date"] else None, got["method"]) == (day, method)
