import csv
import io

import pytest
from pyspark.sql import functions as F

from bookflow.functions.values import row_to_json
from bookflow.plans.intake import raw_content
from bookflow.sources import delimited as dx


def parse(spark, **files):
    df = spark.createDataFrame([(n, bytearray(b)) for n, b in files.items()], "file_hash string, content binary")
    parsed = dx.parse_delimited(df)
    rows, rejected = dx.explode_records(parsed)
    meta = {r.file_hash: r for r in parsed.drop("records").collect()}
    found = {n: [] for n in files}
    for r in rows.orderBy("file_hash", "source_row_number").collect():
        found[r.file_hash].append(r)
    return meta, found, rejected.collect()


def test_fixture_files(spark):
    meta, rows, _ = parse(
        spark,
        utf8="Date,Amount,Vendor,Description\n15/01/2024,5000,Shell,Fuel\n16/01/2024,5000,Shell,Fuel\n".encode(),
        cp1252="Date,Amount,Vendor,Description\n15/01/2024,5000,Café,Fuel\n16/01/2024,1,Résumé Co “x”,y".encode("cp1252"),
        bom="﻿Date,Amount,Vendor\r\n15/01/2024,5000,Shell\r\n".encode(),
        semicolon=b"Date;Amount;Vendor;Type\n1;2;3;4\n5;6;7;8\n",
        tab=b"Date\tAmount\tVendor\n1\t2\t3\n",
        totals=b"Date,Amount,Vendor\n15/01/2024,5000,Shell\n16/01/2024,12000,PTCL\n,,\nTotal,17000,\n",
        padded=b"Date,Amount,Vendor\n15/01/2024,  5000  , Shell  \n",
        header_only=b"Date,Amount\n",
        latin=b"A,B\n\x81\xe9,1\n",
    )
    assert len(rows["utf8"]) == 2 and meta["utf8"].encoding == "utf-8"
    assert [r.raw["Vendor"] for r in rows["cp1252"]] == ["Café", "Résumé Co “x”"]
    assert meta["bom"].headers == ["Date", "Amount", "Vendor"] and meta["bom"].encoding == "utf-8-sig"
    assert meta["semicolon"].delimiter == ";" and len(rows["semicolon"]) == 2
    assert meta["tab"].delimiter == "\t"
    assert [r.raw["Vendor"] for r in rows["totals"]] == ["Shell", "PTCL"]
    assert rows["padded"][0].raw == {"Date": "15/01/2024", "Amount": "5000", "Vendor": "Shell"}
    assert rows["header_only"] == [] and meta["header_only"].total_rows == 0
    assert rows["latin"][0].raw["A"] == "\x81é"


def test_ragged_and_repeated_headers(spark):
    _, rows, rejected = parse(spark, f=b"A,B,A\n1,2,3,4\n1,2,3,4,5\n1\n\n9,8\n0,7,6\n")
    assert [(r.source_row_number, r.raw, r.overflow) for r in rows["f"]] == [
        (1, {"A": "3", "B": "2"}, ["4"]), (3, {"A": None, "B": "8"}, []), (4, {"A": "6", "B": "7"}, []),
    ]
    assert [(r.source_row_number, r.error) for r in rejected] == [(2, "2 values past the last header")]


def test_overflow_is_kept_under_none(spark):
    df = spark.createDataFrame([({"A": "1"}, ["x"]), ({"A": "1"}, [])], "raw map<string,string>, overflow array<string>")
    got = [r[0] for r in df.select(raw_content(F.col("raw"), F.col("overflow"))).collect()]
    assert got == ['{"A":"1","None":["x"]}', '{"A":"1"}']


def test_json_keeps_nulls_and_script(spark):
    df = spark.createDataFrame([({"تاریخ": None, "b": "é\n"},)], "raw map<string,string>")
    assert df.select(row_to_json(F.col("raw"))).first()[0] in ('{"تاریخ":null,"b":"é\\n"}', '{"b":"é\\n","تاریخ":null}')


TRICKY = [
    'a,b,c\n"x, y","say ""hi""",z\n"line\nbreak", "spaced" tail,5" pipe\n',
    'a,b\n"open quote,1\nrest\n',
    'a;b;c\n1;"2;3";4\n5;6;"7\n8"\n',
    'a|b\n1|"2|3"\n',
    "a\tb\n\"1\t2\"\t3\n",
    'a,b\n"",""""\n',
]


@pytest.mark.parametrize("text", TRICKY)
def test_records_like_the_csv_module(spark, text):
    delimiter = {"a;": ";", "a|": "|", "a\t": "\t"}.get(text[:2], ",")
    want = [
        [f.strip() for f in row] for row in csv.reader(io.StringIO(text), delimiter=delimiter, skipinitialspace=True)
    ]
    df = spark.createDataFrame([(text, delimiter)], "t string, d string")
    records = dx.split_records(F.col("t"), F.col("d"))
    got = df.select(F.transform(records, lambda r: dx.split_fields(r, F.col("d")))).first()[0]
    assert [[f.strip() for f in row] for row in got if row != [""]] == [row for row in want if row]


def test_delimiter_like_the_csv_module(spark):
    texts = ["a,b;c\n1,2;3\n4,5\n", "x\n1\n", "a;b\n1,5;2\n3,7;4\n", "'q';1\n'r';2\n", "k|v\n1|2\n3|4|5\n" * 3, "no\nsep here\n"]
    want = []
    for text in texts:
        try:
            want.append(csv.Sniffer().sniff(text, delimiters=",\t;|").delimiter)
        except csv.Error:
            head = "\n".join(text.split("\n")[:5])
            counts = {d: head.count(d) for d in ",\t;|"}
            best = max(counts, key=counts.get)
            want.append(best if counts[best] else ",")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in df.select("i", dx.detect_delimiter(F.col("t"))).orderBy("i").collect()]
    assert got == want
