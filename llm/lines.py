"""Fuzzy line dedup: MinHash of character shingles, banding, exact verification, union-find, one line a component."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import mix, shuffle_tasks, small_batches, table, written
from llm.meeting import packed, packed_runs, parities, resolved
from llm.registry import query

#: Characters a shingle; minima a band; bands. Two lines at similarity s meet with 1 - (1 - s^4)^10: 99.5 % at 0.8,
#: 99.99 % at 0.88.
SHINGLE, ROWS, BANDS = 7, 4, 10
PERCENT = 80
BLANK = " \t\r\x0b\x0c"

_RANDOM = np.random.default_rng(20)
_TIMES = _RANDOM.integers(0, 2**32, ROWS * BANDS, np.uint32) | np.uint32(1)
_PLUS = _RANDOM.integers(0, 2**32, ROWS * BANDS, np.uint32)


def spans_of(text: str | None) -> list[tuple[int, int, int]]:
    """(line number, start, end) of the lines that hold more than white space, without the white space around them."""
    out, at = [], 0
    for number, line in enumerate(text.split("\n") if text else ()):
        body = line.strip(BLANK)
        if body:
            start = at + len(line) - len(line.lstrip(BLANK))
            out.append((number, start, start + len(body)))
        at += len(line) + 1
    return out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashes(points: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of n characters."""
    if len(points) < n:
        return np.zeros(0, np.uint64)
    out = points[: len(points) - n + 1].astype(np.uint64)
    for i in range(1, n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + points[i : len(points) - n + 1 + i]
    return mix(out)


def line_tokens(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of lines kept as UTF-8: of each sorted and distinct, one line behind the other; how many each has."""
    texts = [line.decode("utf-8", "surrogatepass") for line in lines]
    points = _points("\n".join(texts))
    length = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(length + 1) - length - 1
    hashes = _hashes(points, SHINGLE)
    sets = []
    for s, n in zip(start.tolist(), length.tolist()):
        if n < SHINGLE:
            sets.append(line_shingles(points[s : s + n]))
        else:
            sets.append(np.sort(hashes[s : s + n - SHINGLE + 1]))
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[keep], np.bincount(owner[keep], minlength=len(sets))


def line_shingles(points: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes; a line shorter than a shingle is one as a whole."""
    n = min(SHINGLE, len(points))
    return np.unique(_hashes(points, n) + np.uint64(n < SHINGLE) * np.uint64(n))


def band_keys(text: str, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """lines x BANDS."""
    points = _points(text)
    least = np.empty((ROWS * BANDS, len(spans)), np.uint32)
    long = np.array([k for k, (_, a, b) in enumerate(spans) if b - a >= SHINGLE], int)
    if len(long):
        hashes = (_hashes(points, SHINGLE) >> np.uint64(32)).astype(np.uint32)
        edges = np.array([(spans[k][1], spans[k][2] - SHINGLE + 1) for k in long]).reshape(-1)
        hashes = np.append(hashes, np.uint32(0))  # an end may stand right behind the last one
        for p in range(ROWS * BANDS):
            least[p, long] = np.minimum.reduceat(hashes * _TIMES[p] + _PLUS[p], edges)[::2]
    for k, (_, a, b) in enumerate(spans):
        if b - a < SHINGLE:
            least[:, k] = np.uint32(line_shingles(points[a:b])[0] >> np.uint64(32)) * _TIMES + _PLUS
    key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], len(spans), 1)
    for r in range(ROWS):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + least[r::ROWS])
    return key.T


def _facts(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: doc_id, line_no, id, more of every line that is not blank, and the bands of lines as ``packed``.

    id and more are the digest of a line, so equal lines have the same id in all tasks; of those in one task one has bands.
    """
    buckets = 8 * shuffle_tasks(docs.sparkSession)
    kinds = {"doc_id": pa.int64(), "line_no": pa.int32(), "id": pa.int64(), "more": pa.int64(), "bucket": pa.int32(), "sigs": pa.binary(), "docs": pa.binary()}

    def made(columns: dict):
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in kinds.items()], list(kinds))

    def read(batches):
        known, sigs, owners, n = set(), [], [], 0

        def bands():
            if n:
                yield made(dict(zip(("bucket", "sigs", "docs"), zip(*packed(np.concatenate(sigs), np.concatenate(owners), buckets)))))

        for batch in batches:
            for piece in small_batches(batch, 32):
                # Some documents at a time as one text: the arithmetic is on long arrays, and they fit the cache.
                texts = [t or "" for t in piece.column(1).to_pylist()]
                whole, docs, numbers, spans, at = "\n".join(texts), [], [], [], 0
                for doc_id, text in zip(piece.column(0).to_pylist(), texts):
                    for number, a, b in spans_of(text):
                        docs.append(doc_id)
                        numbers.append(number)
                        spans.append((number, a + at, b + at))
                    at += len(text) + 1
                if not spans:
                    continue
                digests = [xxhash.xxh3_128_digest(whole[a:b].encode("utf-8", "surrogatepass")) for _, a, b in spans]
                ids = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                fresh = []
                for k, digest in enumerate(digests):
                    if digest not in known:
                        fresh.append(k)
                        if len(known) > 1_000_000:
                            known.clear()
                        known.add(digest)
                if fresh:
                    keys = band_keys(whole, [spans[k] for k in fresh])
                    sigs.append(keys.reshape(-1))
                    owners.append(np.repeat(ids[fresh, 0], BANDS))
                    n += keys.size
                yield made({"doc_id": docs, "line_no": numbers, "id": ids[:, 0], "more": ids[:, 1] | 1})
                if n > 1_000_000:
                    yield from bands()
                    sigs, owners, n = [], [], 0
        yield from bands()

    schema = "doc_id bigint, line_no int, id bigint, more bigint, bucket int, sigs binary, docs binary"
    return written(docs.select("doc_id", "text").mapInArrow(read, schema), "lines")


def _line_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, tokens (the line itself, see ``line_tokens``), size, sketch of the wanted lines (doc_id, line_no, id), from the texts."""
    per_doc = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "id")).alias("_wanted"))
    own = docs.select(F.col("doc_id").alias("_doc"), "text")
    met = own.join(per_doc, F.col("_doc").eqNullSafe(F.col("doc_id"))).select("text", "_wanted")

    def cut(batches):
        for batch in (piece for whole in batches for piece in small_batches(whole, 500)):
            ids, tokens = [], []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines = text.split("\n") if text else []
                for item in wanted:
                    # Rows that share a doc_id may have other lines.
                    body = lines[item["line_no"]].strip(BLANK) if item["line_no"] < len(lines) else ""
                    if body:
                        ids.append(item["id"])
                        tokens.append(body.encode("utf-8", "surrogatepass"))
            for at in range(0, len(ids), 500):
                values, counts = line_tokens(tokens[at : at + 500])
                sketches = pa.array(parities(values, counts).tolist(), pa.list_(pa.int64()))
                columns = [pa.array(ids[at : at + 500], pa.int64()), pa.array(tokens[at : at + 500], pa.binary()), pa.array(counts, pa.int64()), sketches]
                yield pa.RecordBatch.from_arrays(columns, ["id", "tokens", "size", "sketch"])

    return written(met.mapInArrow(cut, "id bigint, tokens binary, size bigint, sketch array<bigint>"), "line-sets")


def line_components(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, first_doc_id, first_line_no, kept for every line of every text that is not blank.

    Lines whose sets of character shingles have a similarity of 0.8 or more are linked; of every class the line
    with the smallest (doc_id, line_no) is kept. Lines are compared without the white space around them. Equal lines
    are one line before anything is compared, so a line of a third of all texts costs a row per task. Lines that meet
    in a band of minima are verified exactly.

    Null doc_ids come first in the order. Rows that share a doc_id share its lines: equal (doc_id, line_no) are kept
    or removed alike. Null, empty and blank texts have no lines. Other columns are not read.
    """
    facts = _facts(docs)
    lines = facts.filter("bucket IS NULL").select("doc_id", "line_no", "id", "more")
    runs = written(packed_runs(facts.filter("bucket IS NOT NULL")), "line-runs")
    ids = runs.select(F.col("a").alias("id")).unionAll(runs.select(F.col("b").alias("id"))).distinct()
    # Should lines share an id without being equal, one of them stands for it and the others have no class.
    reps = lines.join(ids, "id", "left_semi").groupBy("id").agg(F.min(F.struct("more", "doc_id", "line_no")).alias("rep"))
    reps = written(reps.select("id", "rep.*"), "line-reps")
    parts = resolved(runs, _line_sets(docs, reps.select("doc_id", "line_no", "id")), PERCENT, line_tokens)
    classed = reps.select("id", "more").join(parts.withColumnRenamed("node", "id"), "id")
    # A class is named by a component and 0, other equal lines by their digest, whose second half is odd.
    named = written(lines.join(classed, ["id", "more"], "left").select(
        "doc_id", "line_no", F.coalesce("component", "id").alias("id"),
        F.when(F.col("component").isNull(), F.col("more")).otherwise(0).alias("more"),
    ), "line-names")
    own = F.struct("doc_id", "line_no")
    best = named.groupBy("id", "more").agg(F.min(own).alias("best"), F.count("*").alias("n")).filter("n > 1").drop("n")
    kept = F.coalesce("best", own)
    return named.join(best, ["id", "more"], "left").select(
        "doc_id", "line_no", kept["doc_id"].alias("first_doc_id"), kept["line_no"].alias("first_line_no"),
        (F.col("doc_id").eqNullSafe(kept["doc_id"]) & (F.col("line_no") == kept["line_no"])).alias("kept"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with every line removed that is not the kept one of its class; blank lines stay. Same rows, same columns;
    n_chars, where there is one, is counted anew. A text that loses all its lines is empty; null stays null."""
    gone = line_components(docs).filter("NOT kept").groupBy("doc_id").agg(F.collect_set("line_no").alias("gone"))
    columns = docs.columns
    # A row travels as one value and its cells by number, so its columns may have any names.
    rows = docs.select(F.col("doc_id").alias("own_id"), F.struct(*[docs[f"`{c}`"] for c in columns]).alias("row"))
    met = rows.join(gone, F.col("own_id").eqNullSafe(F.col("doc_id")), "left").select(
        *[F.col("row").getField(c).alias(f"cell{k}") for k, c in enumerate(columns)], "gone"
    )
    at = columns.index("text")

    def rewrite(batches):
        for batch in batches:
            texts = []
            for text, lines in zip(batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist()):
                if lines and text:
                    lines = set(lines)
                    text = "\n".join(line for n, line in enumerate(text.split("\n")) if n not in lines)
                texts.append(text)
            out = list(batch.columns[: len(columns)])
            out[at] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                k = columns.index("n_chars")
                out[k] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(out[k].type)
            yield pa.RecordBatch.from_arrays(out, columns)

    return met.mapInArrow(rewrite, docs.schema)


@query("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_components(table(spark, sf_dir, "documents"))
