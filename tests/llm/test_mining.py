"""Hard negatives, phrase collocations and dedup against history beside plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import history, lines, mixing, negatives, phrases
from llm.common import written
from llm.components import connected_components, extended_components
from llm.residues import Residues, primes_for


@pytest.mark.parametrize("columns,largest", [(0, 5), (1, 1), (64, 260), (700, 3000), (64, 300_000_000)])
def test_residue_products_are_exact(columns, largest):
    rng = np.random.default_rng(columns)
    a, b = (rng.integers(-largest, largest + 1, (9, columns)) for _ in range(2))
    a[0], b[0] = largest, -largest
    primes = primes_for(columns, largest)
    want = a.astype(object) @ b.astype(object).T if columns else np.zeros((9, 9), object)
    assert (Residues(a, primes).times(Residues(b, primes)).astype(object) == want).all()


def test_scores_beyond_64_bits_are_refused():
    with pytest.raises(ArithmeticError):
        primes_for(64, 1 << 30)


def plain_negatives(rows, anchor, positives=5, negatives=5, low=80, high=100):
    good = {}
    for vec_id, label, vector in sorted((r for r in rows if None not in r), key=lambda r: (r[0], r[1])):
        if all(x is not None and math.isfinite(x) for x in vector):
            good.setdefault(vec_id, (label, [math.floor(256 * x) for x in vector]))
    out = []
    for a, (label, v) in good.items():
        if not anchor(a):
            continue
        scores = {i: (lb, sum(x * y for x, y in zip(v, w))) for i, (lb, w) in good.items() if i != a and len(w) == len(v)}
        order = sorted(scores, key=lambda i: (-scores[i][1], i))
        for p in [i for i in order if scores[i][0] == label][:positives]:
            s = scores[p][1]
            found = [i for i in order if scores[i][0] != label and low * s <= 100 * scores[i][1] <= high * s]
            out += [(a, p, k, n, s, scores[n][1]) for k, n in enumerate(found[:negatives], 1)]
    return sorted(out)


def test_hard_negatives(spark, monkeypatch):
    rng = random.Random(4)
    center = [[rng.gauss(0, 0.3) for _ in range(6)] for _ in range(3)]
    rows = []
    for i in range(400):
        rows.append((i, rng.randrange(3), [round(c + rng.gauss(0, 0.05), 2) for c in center[rng.randrange(3)]]))
    rows += [(400 + i, i % 3, rows[20][2]) for i in range(60)]  # ties
    rows += [(500, None, [0.1] * 6), (501, 1, None), (None, 1, [0.1] * 6), (510, 1, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (520, 1, [float("nan")] * 6)]
    rows += [(530, 1, [float("inf")] * 6), (540, 1, []), (541, 2, []), (542, 1, []), (550, 0, [0.5, 0.25]), (551, 0, [0.5, 0.3]), (552, 1, [0.5, 0.2])]
    rows += [rows[10], rows[10], rows[11]]
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 600)
    monkeypatch.setattr(negatives, "UNIT_ROWS", 150)
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    df = df.withColumn("anchor", F.lit("x")).withColumn("unit", F.lit(7)).withColumn("scores", F.lit("y")).withColumn("kind", F.lit(None).cast("int"))
    got = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, lambda i: i % 10 == 0)
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_perfect_hash_is_minimal():
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000)), np.uint8).reshape(-1, 32)
    made = history.PerfectHash.build(digests[:3000])
    again = history.PerfectHash.from_bytes(*made.to_bytes())
    slots = again.slots(digests[:3000])
    assert sorted(slots.tolist()) == list(range(3000))
    others = again.slots(digests[3000:])
    assert others.min() >= -1 and others.max() < 3000
    assert len(history.PerfectHash.build(digests[:0]).slots(digests)) == 5000
    with pytest.raises(ValueError):
        history.PerfectHash.build(digests[[1, 1]])


def texts(rng, n):
    return [rng.choice(["Aa", "aA", "aa", "", None, "Ä", "ä", "x" * 50_000, f"t{rng.randrange(n)}"]) for _ in range(n)]


def folded(text):
    return hashlib.sha256("".join(c.lower() if c.isascii() else c for c in text or "").encode()).hexdigest()


def test_split_dedup(spark):
    rng = random.Random(3)
    rows = list(enumerate(texts(rng, 300))) + [(None, "Aa"), (None, "only"), (7, "again"), (7, "again")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("digest", F.lit(1)).withColumn("row", F.lit("r"))
    got = history.split_dedup(df).collect()
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(folded(text), []).append(doc_id)
    assert len(got) == len(rows)
    for digest, ids in groups.items():
        own = [r for r in got if r.text_sha256 == digest]
        best = max((i for i in ids if i is not None), default=None)
        assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in own)
        assert all(r.keep_id == best and r.group_size == len(ids) for r in own)
        assert [r.doc_id for r in own if r.kept] == [best]
    assert history.split_dedup(df.limit(0)).count() == 0


def test_dedup_of_a_later_batch(spark):
    rng = random.Random(8)
    old, new = list(enumerate(texts(rng, 200))), [(1000 + i, t) for i, t in enumerate(texts(rng, 200))] + [(None, "Aa")]
    schema = "doc_id bigint, text string"
    known = written(history.grouped(history.digested(spark.createDataFrame(old, schema))), "known")
    got = history.exact_dedup(spark.createDataFrame(new, schema), history.build_index(known)).collect()
    past = {folded(t): i for i, t in old}
    best = {folded(t): i for i, t in new if i is not None}
    assert len(got) == len(new)
    for r in got:
        assert r.known == (r.text_sha256 in past)
        assert r.keep_id == (past[r.text_sha256] if r.known else best[r.text_sha256])
        assert r.kept == (not r.known and r.doc_id == best[r.text_sha256])
    nothing = history.build_index(known.limit(0))
    assert {r.known for r in history.exact_dedup(spark.createDataFrame(new, schema), nothing).collect()} == {False}


def plain_phrases(docs, least, longest, top, percent):
    counts, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            counts.update((lang, tuple(words[i : i + m])) for m in range(1, longest + 1) for i in range(len(words) - m + 1))
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    gone = {
        (lang, p[x:y]) for (lang, p), a in candidates.items() for x in range(len(p)) for y in range(x + 2, len(p) + 1)
        if y - x < len(p) and 100 * a >= percent * counts[lang, p[x:y]]
    }
    rows = {}
    for (lang, p), a in candidates.items():
        if (lang, p) not in gone:
            score, k = min((1000 * a * n[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
            rows.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -s)
        for lang, own in rows.items() for rank, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1)
    )


@pytest.mark.parametrize("size,percent", [(40, 100), (100_000, 60)])
def test_phrase_collocations(spark, monkeypatch, size, percent):
    rng = random.Random(size)
    if size == 40:  # many buckets
        monkeypatch.setattr(phrases, "WORDS", 100)
        monkeypatch.setattr(phrases, "PAIRS", 300)
    base = ["the", "The", "quick", "fox", "of", "straße", "Ä", "a-b", "x"]
    fixed = "New York city hall is old"
    docs = []
    for _ in range(120):
        words = [rng.choice(base) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            words.insert(rng.randrange(len(words) + 1), fixed)
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! ", "\x1c"]) for w in words)
        docs.append((rng.choice(["en", "de", None, "und"]), text))
    docs += [("en", None), (None, ""), ("fr", " .,; "), ("long", "go on and on " * 400)]
    df = spark.createDataFrame(docs, "lang string, text string").withColumn("words", F.lit(1)).withColumn("id", F.lit(2)).withColumn("f", F.lit("f"))
    got = phrases.phrase_collocations(df, least=6, top=40, percent=percent, size=size)
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(docs, 6, 5, 40, percent)
    assert phrases.phrase_collocations(df.limit(0)).count() == 0


def test_extended_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    df = lambda rows: spark.createDataFrame(rows, "a bigint, b bigint")
    parts = connected_components(df(links[:60]))
    got = sorted(map(tuple, extended_components(parts, df(links[60:])).collect()))
    assert got == sorted(map(tuple, connected_components(df(links)).collect()))
    assert sorted(map(tuple, extended_components(parts, df([])).collect())) == sorted(map(tuple, parts.collect()))


def test_mixing_and_lines_keep_columns_of_any_name(spark):
    names = ["_draw", "_copies", "_order", "_rate", "_steps", "_source", "_from", "_copy", "_doc", "_gone", "gone", "row", "id", "draw", "rate", "order", "copy", "own", "own_id", "a.b"]
    text = "a line that stands in many texts and is long enough to be compared with others"
    docs = [(i, f"{text}\nown words of text {i} {'x' * i}", "en", f"s{i % 2}", 0) for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df = df.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for out in (mixing.mix_sources(df), lines.dedup_lines(df)):
        rows = out.collect()
        assert rows and [c for c in out.columns if c != "copy_no"] == df.columns
        assert all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)
    assert lines.dedup_lines(df).count() == 12
