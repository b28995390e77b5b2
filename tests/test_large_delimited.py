"""Split files give the rows that whole files give."""

import random

import pytest

from bookflow.sources import delimited as dx
from bookflow.sources import large_delimited as lx


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def content(rng, delimiter, end):
    def field():
        text = "".join(rng.choice(["a", "b", " ", "é", delimiter, "\n", '"', "7", "total"]) for _ in range(rng.randrange(9)))
        kind = rng.random()
        if kind < 0.4:
            return '"' + text.replace('"', '""') + '"' + rng.choice(["", "", "x", ' y"'])
        return text.replace("\n", "").replace(delimiter, "").lstrip('" ') + rng.choice(["", '"q'])

    lines = [delimiter.join(["Date", '"Amount', 'due"', "Vendor"][: 3 + (rng.random() < 0.5)])]
    for _ in range(rng.randrange(40, 160)):
        kind = rng.random()
        lines.append("" if kind < 0.05 else "Total" + delimiter if kind < 0.1 else delimiter.join(field() for _ in range(rng.choice([1, 2, 3, 3, 3, 3, 4, 5]))))
    if rng.random() < 0.3:
        lines.append('"' + "long text " * 300 + '"' + delimiter + "1")
        lines += ["1" + delimiter + "2"] * 30
    if rng.random() < 0.2:
        lines.append('"never closed' + "\nx" * 900)
    return end.join(line.replace("\n", end) for line in lines) + rng.choice(["", end])


def test_same_rows_as_whole_files(spark, small_splits, tmp_path):
    rng = random.Random(5)
    files = {}
    for n in range(24):
        text = content(rng, rng.choice([",", ";", "\t", "|"]), rng.choice(["\n", "\r\n", "\r"]))
        data = text.encode("utf-8-sig" if n % 5 == 0 else "cp1252" if n % 5 == 1 else "utf-8")
        (tmp_path / f"f {n}+.csv").write_bytes(data)
        files[f"f {n}+.csv"] = data
    (tmp_path / "head.csv").write_bytes(b"A,B\n")
    files["head.csv"] = b"A,B\n"
    df = spark.createDataFrame([(n, bytearray(b)) for n, b in files.items()], "file_path string, content binary")
    parsed = dx.parse_delimited(df)
    want = {}
    for r in dx.explode_all(parsed).filter("source_row_number IS NOT NULL").collect():
        want.setdefault(r.file_path, []).append((r.source_row_number, r.source_record_number, r.raw, r.overflow))
    meta = {r.file_path: tuple(r)[1:] for r in parsed.select("file_path", *dx.META, "headers").collect()}
    name = lambda path: path.rsplit("/", 1)[1]
    found = lx.parse_large(spark, [str(tmp_path)])
    assert found.failed.count() == 0
    assert {name(r.file_path): tuple(r)[1:] for r in found.meta.select("file_path", *dx.META, "headers").collect()} == meta
    got = {}
    for r in found.rows.collect():
        got.setdefault(name(r.file_path), []).append((r.source_row_number, r.source_record_number, r.raw, r.overflow))
    for key, rows in want.items():
        assert sorted(got[key], key=lambda r: r[0]) == sorted(rows, key=lambda r: r[0]), key
    assert set(got) == set(want)
    assert lx.scan_blocks(spark, [str(tmp_path)]).groupBy("file_path").count().agg({"count": "max"}).first()[0] > 3


def test_endless_header_is_reported(spark, small_splits, tmp_path):
    (tmp_path / "bad.csv").write_bytes(b'"A,B\n' + b"1,2\n" * 1000)
    found = lx.parse_large(spark, [str(tmp_path / "bad.csv")])
    assert found.rows.count() == 0 and found.failed.count() == 1
