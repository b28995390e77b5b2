"""The pipeline's stages against what each must do to its own input, and the registry."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import __spark_entry__ as entry
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import jaccard, lines, quality, tokens
from llm.common import table
from test_groups import plain_join
from test_texts import plain_lines

SF = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert {"op4_jaccard_join", "op5_embedding_near_dedup", "op6_mix_sources", "op8_warc_normaliser"} <= entry.oracle_sql().keys()


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out.append(docs)
    return out


def test_each_stage_on_its_input(spark, stages):
    start, good, lined, single, mixed, packed = stages
    columns = start.columns
    assert all(s.columns == columns for s in stages[:5])
    model = quality.train_quality(start, table(spark, SF, "labels"))
    kept = {r["doc_id"] for r in quality.quality_rules(start, model).filter("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept
    gone = {(r["doc_id"], r["line_no"]) for r in lines.line_components(good).filter("NOT kept").collect()}
    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    for r in lined.collect():
        want = [x for n, x in enumerate(texts[r["doc_id"]].split("\n")) if (r["doc_id"], n) not in gone]
        assert r["text"] == "\n".join(want) and r["n_chars"] == len(r["text"])
    parts = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(lined).collect()}
    assert {r["doc_id"] for r in single.collect()} == set(parts.values())
    assert {r["doc_id"] for r in mixed.collect()} <= set(parts.values())
    rows = packed.collect()
    assert len({(r["doc_id"], r["piece"]) for r in rows}) <= len(rows)
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m")).collect()
    assert all(r["n"] == r["m"] <= 2048 for r in fill) and np.mean([r["n"] for r in fill]) > 1700


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages[5].columns and got.count() == stages[5].count()


# --- against plain code ------------------------------------------------------------------------------------------


def plain_mix(docs):
    """The copies in order, by Poisson counts with the same mean number of characters for every source."""
    chars = Counter()
    for r in docs:
        chars[r[3]] += len(r[1])
    out = []
    for r in docs:
        rate = round(sum(chars.values()) / len(chars) / chars[r[3]], 9) if chars[r[3]] else 1.0
        draw = int(hashlib.md5(f"17|{r[0]}".encode()).hexdigest()[:13], 16) / 2**52
        copies, term = 0, math.exp(-rate)
        total = term
        while total <= draw:
            copies += 1
            term *= rate / copies
            total += term
            out.append((hashlib.md5(f"order 17|{r[0]}|{copies}".encode()).hexdigest(), r))
    return [r for _, r in sorted(out)]


def plain_pieces(docs, capacity=2048):
    """Full pieces, but for the first."""
    own, out = tokens.encoder(tokens.default_vocabulary()).tokenizer, Counter()
    for r in docs:
        ids = np.array(own.encode(r[1], add_special_tokens=False).ids + [0], "<u4")
        ends = range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)
        for piece, end in enumerate(ends):
            start = max(0, end - capacity)
            out[r[0], piece, start, end - start, zlib.crc32(ids[start:end].tobytes())] += 1
    return out


def pieces(packed):
    return Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed)


def places(packed):
    """Every sequence is filled from 0 without gaps and holds no more than it may."""
    by = defaultdict(list)
    for r in packed:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for row in by.values():
        at = 0
        for offset, length in sorted(row):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_and_run_against_plain_code(spark, stages):
    """All stages after the classifier, each from what plain code makes of the one before."""
    start, good, lined, single, mixed, packed = ([*s.collect()] for s in stages)
    assert {tuple(r) for r in good} <= {tuple(r) for r in start} and len(good) > len(start) / 2
    first = plain_lines([(r["doc_id"], r["text"]) for r in good])
    want = []
    for d, text, lang, source, _ in good:
        text = "\n".join(x for n, x in enumerate(text.split("\n")) if first.get((d, n), (d, n)) == (d, n))
        want.append((d, text, lang, source, len(text)))
    assert sorted(tuple(r) for r in lined) == sorted(want)
    parts = plain_join([r[:2] for r in want])
    want = [r for r in want if parts[r[0]][1] == r[0]]
    assert sorted(tuple(r) for r in single) == sorted(want)
    want = plain_mix(want)
    assert [tuple(r) for r in mixed] == want
    want = plain_pieces(want)
    assert pieces(packed) == want
    places(packed)
    whole = corpus_pipeline.run(spark, SF).collect()
    assert pieces(whole) == want
    places(whole)


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    # 12 MB of texts in one partition: by Spark's own bounds one batch.
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["bytes", "rows"])

    monkeypatch.setattr(corpus_pipeline, "dedup_lines", lambda docs: docs.mapInArrow(sizes, "bytes bigint, rows bigint"))
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 400).alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"), F.lit(4400).cast("bigint").alias("n_chars")
    ).coalesce(1)
    found = corpus_pipeline.line_dedup(spark, docs, SF).collect()
    assert sum(r["rows"] for r in found) == 3000
    assert max(r["bytes"] for r in found) < 6 << 20
