"""Mixing, token files, archives and packing: round trips and plain versions."""

import gzip
import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import files, mixing, packing, tokenfile, tokens, warc
from llm.common import new_folder

ODD = [None, "", "  a", "a   b \n c", "don't  stop", "é  漢 😀", "<|endoftext|> a  <|endoftext|>b", "a\tb\r\n", "x" * 5000]


def frame(spark, texts, schema="doc_id bigint, text string"):
    return spark.createDataFrame(list(enumerate(texts)), schema)


def ids_of(text):
    own = tokens.encoder(tokens.default_vocabulary())
    return np.array(own.tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()


# --- mixing ------------------------------------------------------------------------------------------------------


def test_mixing_meets_the_weights(spark):
    rows = [(i, "x" * (10 + i % 50), "big" if i % 3 else f"s{i % 2}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mix_sources(docs, {"big": 1, "s0": 2, "s1": 1}).groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()
    total = sum(r["n"] for r in out)
    share = {r["source"]: r["n"] / total for r in out}
    assert abs(share["big"] - 0.25) < 0.03 and abs(share["s0"] - 0.5) < 0.03
    again = mixing.mix_sources(docs.repartition(7), {"big": 1, "s0": 2, "s1": 1}).select("doc_id", "copy_no")
    assert again.exceptAll(mixing.mix_sources(docs, {"big": 1, "s0": 2, "s1": 1}).select("doc_id", "copy_no")).count() == 0


def test_mixing_draws_are_poisson(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("ab").alias("text"), F.when(F.col("id") < 5000, "a").otherwise("b").alias("source"))
    n = {r["source"]: r["n"] for r in mixing.mix_sources(docs).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(n["a"] - 10000) < 500 and abs(n["b"] - 10000) < 500
    counts = mixing.mix_sources(docs).filter("source = 'a'").groupBy("doc_id").count().collect()
    twice = sum(r["count"] == 2 for r in counts) / 5000
    assert abs(twice - np.exp(-2) * 2) < 0.03


def test_mixing_odd_rows(spark):
    rows = [(1, None, None, 5), (None, "", "e", 5), (2, "abc", "f", 5), (2, "abc", "f", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copy_no int")
    out = mixing.mix_sources(docs)
    assert out.columns == docs.columns and {r["copy_no"] for r in out.collect()} <= {5}
    assert sum(r["doc_id"] == 2 for r in out.collect()) % 2 == 0
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert mixing.mix_sources(docs, {}).filter("source = 'f'").count() == 0


def test_large_rates_do_not_underflow(spark):
    steps = spark.range(1).select(mixing.poisson_steps(F.lit(2000.0)).alias("s")).first()["s"]
    assert abs(np.searchsorted(steps, 0.5) - 2000) < 3 and steps[-1] == pytest.approx(1)


def test_large_draws_equal_the_steps(spark):
    for rate in (1001.5, 2000.0):
        draws = spark.range(200).select((F.col("id") / 200 + 0.00123).alias("u"))
        steps = spark.range(1).select(mixing.poisson_steps(F.lit(rate)).alias("s")).first()["s"]
        got = draws.select("u", mixing.large_draw(F.lit(rate), F.col("u")).alias("n")).collect()
        assert [r["n"] for r in got] == [int(np.searchsorted(steps, r["u"], "right")) for r in got]


@pytest.mark.parametrize("length", [1, 20])
def test_a_rare_source_is_drawn_at_a_large_rate(spark, length):
    rate = 4_000_000 // 2 / length
    rows = [(1, "r" * length, "rare"), (2, "x" * (4_000_000 - length), "big")]
    out = mixing.mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    n, low, high, different = out.filter("doc_id = 1").agg(F.count("*"), F.min("copy_no"), F.max("copy_no"), F.count_distinct("copy_no")).first()
    assert abs(n - rate) < 6 * rate**0.5 and (low, high, different) == (1, n, n)


# --- tokens ------------------------------------------------------------------------------------------------------


def test_pieces_encode_like_whole_texts():
    own = tokens.WordEncoder(tokens.default_vocabulary(), bound=500)
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab1.,'! \n\t é <'s漢") for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    assert own.cuts and [x + b"\0\0\0\0" for x in own.encode_all(texts)] == [ids_of(t) for t in texts]


def test_runs_of_letters_and_marks_encode_like_whole_texts():
    own = tokens.WordEncoder(tokens.default_vocabulary(), bound=300)
    assert own.runs is not None
    rng = random.Random(2)
    parts = ["Stra\u00dfe", "\u00e9t\u00e9", "\u00f1", "word", "A", "\u00aa", "\u00b2", "\u00bc", "\u0250", "\u01c5", "\u0130", "\u03a9", "\u010a", "\u0120",
             ".", ",", "$$$", "&&&&&&&&&&", "'s", "'t", "'", "-", "_", "12", "\n", " ", "  ", "\r\n", "\xa0", "\x85", "\u200b", "\0", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(6000)]
    assert own.encode_all(texts) == [ids_of(t)[:-4] for t in texts]


def test_new_words_of_many_texts_are_encoded_in_one_call(monkeypatch):
    own = tokens.WordEncoder(tokens.default_vocabulary())
    calls = []

    class Counted:
        def __init__(self, kept):
            self.kept = kept

        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return self.kept.encode_batch_fast(texts, **options)

    own.runs = Counted(own.runs)
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcd\u00e9", k=7)) + rng.choice(["", ".", ",,"]) for _ in range(20)) for _ in range(640)]
    assert own.encode_all(texts) == [ids_of(t)[:-4] for t in texts] and len(calls) == 1
    monkeypatch.setattr(tokens, "SPAN", 300)
    again = tokens.WordEncoder(tokens.default_vocabulary(), bound=200)
    assert list(again.encode_rows(enumerate(texts))) == [(k, ids_of(t)[:-4]) for k, t in enumerate(texts)]
    assert len(again.words.slots) <= 400 and list(again.encode_rows([])) == []


def test_vocabulary_that_joins_control_characters_to_letters(tmp_path):
    with open(tokens.default_vocabulary()) as stream:
        spec = json.load(stream)
    usual = tokens.WordEncoder(tokens.default_vocabulary())
    assert usual.runs.pre_tokenizer is None and usual.part != 10
    entries = [(chr(c) + "\u0120", [chr(c), "\u0120"]) for c in range(0x100, 0x120)] + [("z\u010a", ["z", "\u010a"])]
    for entry, pair in entries:
        spec["model"]["vocab"][entry] = max(spec["model"]["vocab"].values()) + 1
        spec["model"]["merges"].insert(0, pair if isinstance(spec["model"]["merges"][0], list) else " ".join(pair))
    path = str(tmp_path / "joining.json")
    with open(path, "w") as stream:
        json.dump(spec, stream)
    own = tokens.WordEncoder(path)
    assert own.runs.pre_tokenizer is not None
    texts = ["a jazz\nbuzz fizz", "fizz\n fuzz\n\nz buzz\nz\nz"]
    assert own.encode_all(texts) == [own._whole(t) for t in texts]


def test_token_files_round_trip(spark):
    rows = [(i * 3 % 41, t) for i, t in enumerate(ODD + ["some words " * k for k in range(30)])] + [(None, "null id"), (7, "again")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("start", F.lit("x")).repartition(4)
    manifest = tokenfile.write_token_files(docs, new_folder(spark, "t"))
    got = sorted(tokenfile.read_token_files(manifest, with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda x: -1 if x is None else x)
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    assert sorted(bytes(r["ids"]) for r in got) == sorted(ids_of(t) for _, t in rows)
    assert all(r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and 4 * r["n_tokens"] == len(r["ids"]) for r in got)
    for row in manifest.collect():
        with files.reading(row["file"]) as stream:
            reader = tokenfile.FrameReader(stream)
            for doc_id in reader.doc_ids[~reader.no_id].tolist():
                wanted = {ids_of(t) for d, t in rows if d == doc_id}
                assert {reader.ids(p).tobytes() for p in reader.find(doc_id)} == wanted
    assert tokenfile.read_token_files(tokenfile.write_token_files(docs.limit(0), new_folder(spark, "t"))).count() == 0


def test_damaged_frames_are_noticed(spark, tmp_path):
    import zstandard

    name = str(tmp_path / "x")
    with open(name, "wb") as f:
        out = tokenfile.FrameWriter(f)
        out.add(1, ids_of("some text"))
        out.add(2, ids_of("other text"))
        out.close()
    data = bytearray(open(name, "rb").read())
    data[len(zstandard.ZstdCompressor(level=3).compress(ids_of("some text"))) - 3] ^= 0x10
    open(name, "wb").write(data)
    with open(name, "rb") as f:
        reader = tokenfile.FrameReader(f)
        assert reader.ids(1).tobytes() == ids_of("other text")
        with pytest.raises((ValueError, zstandard.ZstdError)):
            reader.ids(0)


# --- archives ----------------------------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    body = "<p>é same</p>"
    rows = [(5, "http://a/ü x\r\n", body), (2, None, body), (9, "http://b", None), (8, "http://c", ""), (1, "u", "own\r\n\r\nWARC/1.1\r\n"), (None, "n", body), (3, "r", "twice"), (3, "r", "twice")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("record_type", F.lit(1)).repartition(3)
    normal = warc.archive(spark, pages)
    got = warc.read_records(normal).collect()
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got)
    n = len(body.encode())
    assert kinds == [(0, "response", None, n), (1, "response", None, 17), (2, "response", None, n), (3, "response", None, 5), (3, "response", None, 5), (5, "revisit", 2, n), (8, "response", None, 0), (9, "revisit", 8, 0)]
    assert {r["payload_digest"] for r in got if r["page_id"] in (2, 5)} == {warc.digest_of(body.encode())}
    assert warc.read_records(warc.archive(spark, pages.limit(0))).count() == 0
    small = warc.read_records(warc.archive(spark, pages, min_bytes=1)).filter("record_type = 'revisit'").collect()
    assert [r["page_id"] for r in small] == [5]


def test_normaliser_keeps_bytes_and_reports_damage(spark, tmp_path):
    records = [warc.record(i, "u", b"x" * (i * 700_000), i * 700_000, "D", None, "d") for i in range(4)]
    whole, broken, text = (str(tmp_path / n) for n in ("whole", "broken", "text"))
    open(whole, "wb").write(gzip.compress(b"".join(records)))
    open(broken, "wb").write(gzip.compress(b"".join(records))[:-2000])
    open(text, "wb").write(gzip.compress(b"no archive\r\n\r\n"))
    out = warc.normalise(spark.createDataFrame([(whole,), (broken,), (text,)], "file string"), str(tmp_path / "out"))
    rows = sorted(out.collect(), key=lambda r: -r["records"])
    assert rows[0]["error"] is None and rows[0]["records"] == 4 and rows[-1]["records"] == 0 and all(r["error"] for r in rows[1:])
    with files.reading(rows[0]["file"]) as stream:
        data = stream.read()
    assert gzip.decompress(data) == b"".join(records)
    with files.reading(rows[0]["index"]) as stream:
        import json

        for line, record in zip(stream.read().splitlines(), records):
            start, length, _ = json.loads(line)
            assert zlib.decompress(data[start : start + length], 31) == record


def test_long_headers_lose_no_page(spark):
    long = "http://a/" + "é" * 600_000  # percent-encoded: 3.6 MB
    rows = [(i, long if i == 2 else f"u{i}", f"page {i}") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    got = {r["page_id"]: len(r["url"]) for r in warc.read_records(warc.archive(spark, pages)).collect()}
    assert got == {i: 9 + 6 * 600_000 if i == 2 else 2 for i in range(6)}


def test_lost_records_fail_the_job(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, "u", "x" * 5000 + str(i)) for i in range(4)], "page_id bigint, url string, html string").coalesce(1)
    normalise = warc.normalise

    def damaged(written, folder):
        for i, r in enumerate(written.collect()):
            with files.reading(r["file"]) as stream:
                data = stream.read()
            open(tmp_path / f"{i}", "wb").write(data[:-20])
        return normalise(spark.createDataFrame([(str(p),) for p in tmp_path.iterdir() if p.is_file()], "file string"), folder)

    monkeypatch.setattr(warc, "normalise", damaged)
    with pytest.raises(ValueError):
        warc.archive(spark, pages)
    monkeypatch.setattr(warc, "normalise", lambda files, folder: normalise(files.limit(0), folder))
    with pytest.raises(ValueError):
        warc.archive(spark, pages)
    monkeypatch.setattr(warc, "normalise", normalise)
    with pytest.raises(Exception, match="records in the index"):
        warc.read_records(warc.archive(spark, pages).withColumn("records", F.lit(9).cast("bigint"))).collect()


# --- packing -----------------------------------------------------------------------------------------------------


def check_packing(got, texts, capacity):
    by, pieces = {}, {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for places in by.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0] + [n for _, n in places])[:-1].tolist()
        assert sum(n for _, n in places) <= capacity
    for doc_id, text in texts:
        ids, at = ids_of(text), 0
        for k, (piece, start, length, crc) in enumerate(sorted(pieces[doc_id])):
            assert (piece, start) == (k, at) and crc == zlib.crc32(ids[4 * at : 4 * (at + length)])
            assert length == capacity or k == 0
            at += length
        assert 4 * at == len(ids)
    return len(by)


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 100)
    rng = random.Random(3)
    texts = list(enumerate(ODD + ["word " * rng.randint(0, 90) for _ in range(700)] + ["long " * 1000]))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("offset", F.lit("x")).repartition(4)
    got = packing.pack_documents(docs, capacity=128, with_ids=True).collect()
    used = check_packing(got, texts, 128)
    least = -(-sum(len(ids_of(t)) // 4 for _, t in texts) // 128)
    assert used <= least * 1.02 + 1
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in got)
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_packing_repeated_and_null_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], "doc_id bigint, text string")
    got = packing.pack_documents(docs).collect()
    assert len(got) == 4 and len({r["sequence_id"] for r in got}) == 1 and len({r["offset"] for r in got}) == 4


def test_crossover_keeps_every_item():
    rng = random.Random(2)
    lengths = [rng.randint(1, 100) for _ in range(300)]
    a = packing.best_fit(sorted(range(300), key=lambda i: -lengths[i]), lengths, 128)
    b = packing.best_fit(list(range(300)), lengths, 128)
    for _ in range(20):
        c = packing.crossover(a, b, lengths, 128, rng)
        assert sorted(i for x in c for i in x) == list(range(300)) and max(sum(lengths[i] for i in x) for x in c) <= 128
    best = packing.evolve(lengths, [], 1, 128)[0]
    assert len(best) <= len(a)
