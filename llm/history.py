"""Exact dedup against history: a minimal perfect hash over the digests known so far, checked byte by byte."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.plans.joins import salted_lookup
from llm.common import LOWER, as_bytes, mix, new_folder, shuffle_tasks, small_batches, table, written
from llm.registry import query

#: Digests a shard of the index, about; bits a digest in each level of its hash.
SHARD, GAMMA = 1 << 18, 2


def _lanes(digests: np.ndarray) -> np.ndarray:
    """n x 32 bytes as n x 4 unsigned numbers."""
    return np.ascontiguousarray(digests).view("<u8")


def _places(lanes: np.ndarray, level: int, size: int) -> np.ndarray:
    h = np.full(len(lanes), mix(np.array([level + 1], np.uint64))[0])
    for k in range(lanes.shape[1]):
        h = mix(h ^ lanes[:, k])
    return (h % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash: n distinct digests to the slots 0 .. n-1.

    Level by level, a digest alone on its place sets that place's bit; the others go to the next, smaller level. A
    slot is the rank of the bit. Digests that were not built in get an arbitrary slot or none (-1): the slot's own
    digest has to be compared.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = []
        before = 0
        for bits in levels:
            ranks = np.cumsum(bits, dtype=np.int64) + before
            self.ranks.append(ranks - 1)
            before = int(ranks[-1]) if len(ranks) else before

    @classmethod
    def build(cls, digests: np.ndarray) -> "PerfectHash":
        lanes, levels = _lanes(digests), []
        while len(lanes):
            if len(levels) == 200:
                raise ValueError("digests repeat")
            size = max(64, GAMMA * len(lanes))
            places = _places(lanes, len(levels), size)
            bits = np.bincount(places, minlength=size) == 1
            levels.append(bits)
            lanes = lanes[~bits[places]]
        return cls(levels)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        lanes, out = _lanes(digests), np.full(len(digests), -1, np.int64)
        open_ = np.arange(len(digests))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            places = _places(lanes[open_], level, len(bits))
            hit = bits[places]
            out[open_[hit]] = ranks[places[hit]]
            open_ = open_[~hit]
        return out

    def to_bytes(self) -> tuple[list[int], bytes]:
        return [len(b) for b in self.levels], b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def from_bytes(cls, sizes: list[int], data: bytes) -> "PerfectHash":
        levels, at = [], 0
        for size in sizes:
            end = at + -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data[at:end], np.uint8), count=size).astype(bool))
            at = end
        return cls(levels)


def _digests(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def digested(docs: DataFrame) -> DataFrame:
    """doc_id, digest (SHA-256 of the whole text in UTF-8 after lower-casing A-Z; null is empty), row (unique)."""

    def read(batches):
        for batch in batches:
            for piece in small_batches(batch, 256):
                found = [hashlib.sha256(as_bytes(t.as_py()).translate(LOWER)).digest() for t in piece.column(1)]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found, pa.binary())], ["doc_id", "digest"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(read, "doc_id bigint, digest binary")
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


def grouped(rows: DataFrame) -> DataFrame:
    """digest, n, doc_id, row: a row for every digest, with the largest doc_id (and its row) as the winner. Combined in
    every task before the shuffle, so a text of a third of all rows brings a row per task."""
    best = F.max(F.struct("doc_id", "row"))
    return rows.groupBy("digest").agg(F.count("*").alias("n"), best.alias("best")).select("digest", "n", "best.doc_id", "best.row")


def build_index(groups: DataFrame, folder: str | None = None) -> DataFrame:
    """The index over the digests of ``groups`` (distinct, from ``grouped``): a row per shard with the bits of its
    perfect hash and, by slot, the full digest, the winner's doc_id and row and the number of copies. It is written as
    parquet to ``folder`` (a new one in the shared folder if not given) and read from there; ``read.parquet`` takes it
    up again for a later batch. A shard holds about 2^18 digests however many there are in all. Null doc_ids are kept as
    such. Without groups the index is empty."""
    spark = groups.sparkSession
    shards = max(1, -(-groups.count() // SHARD), shuffle_tasks(spark))
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")
    keyed = groups.select(shard.alias("shard"), "digest", "n", "doc_id", "row")
    keyed = keyed.repartitionById(min(shards, 4 * shuffle_tasks(spark)), F.pmod("shard", F.lit(min(shards, 4 * shuffle_tasks(spark)))))

    def build(batches):
        def one(shard, parts):
            digests = np.concatenate([_digests(p.column("digest")) for p in parts])
            found = PerfectHash.build(digests)
            order = np.argsort(found.slots(digests))
            sizes, bits = found.to_bytes()
            columns = []
            for name in ("n", "doc_id", "row"):
                values = pa.concat_arrays([p.column(name) for p in parts])
                nulls = values.is_null().to_numpy(zero_copy_only=False)[order]
                columns.append((values.fill_null(0).to_numpy(zero_copy_only=False)[order].astype("<i8").tobytes(), nulls))
            return pa.RecordBatch.from_pylist(
                [{
                    "shard": shard, "shards": shards, "sizes": sizes, "bits": bits, "digests": digests[order].tobytes(), "copies": columns[0][0],
                    "winners": columns[1][0], "unnamed": np.packbits(columns[1][1]).tobytes(), "rows": columns[2][0],
                }],
                INDEX,
            )

        shard, parts = None, []
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False)
            edges = [0, *(np.nonzero(names[1:] != names[:-1])[0] + 1).tolist(), len(names)] if len(names) else []
            for start, end in zip(edges, edges[1:]):
                if names[start] != shard:
                    if parts:
                        yield one(shard, parts)
                    shard, parts = int(names[start]), []
                parts.append(batch.slice(start, end - start))
        if parts:
            yield one(shard, parts)

    schema = "shard int, shards int, sizes array<int>, bits binary, digests binary, copies binary, winners binary, unnamed binary, rows binary"
    path = folder or new_folder(spark, "digest-index")
    keyed.sortWithinPartitions("shard").mapInArrow(build, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


INDEX = pa.schema([
    ("shard", pa.int32()), ("shards", pa.int32()), ("sizes", pa.list_(pa.int32())), ("bits", pa.binary()), ("digests", pa.binary()),
    ("copies", pa.binary()), ("winners", pa.binary()), ("unnamed", pa.binary()), ("rows", pa.binary()),
])


def looked_up(groups: DataFrame, index: DataFrame) -> DataFrame:
    """``groups`` (digest, n, doc_id, row) with known, known_id, known_n: whether the index holds the very digest, and
    its winner's doc_id and number of copies. A slot whose 32 bytes differ says that the digest is not in the index.

    Every shard meets the digests that hash to it in one stream: the shard first, then they pass by. Digests are
    distinct, so shards get equal shares whatever texts repeat.
    """
    head = index.select("shards").first()
    if head is None:
        return groups.select("*", F.lit(False).alias("known"), F.lit(None).cast("bigint").alias("known_id"), F.lit(0).cast("bigint").alias("known_n"))
    shards, tasks = head["shards"], 4 * shuffle_tasks(groups.sparkSession)
    payload = ["sizes", "bits", "digests", "copies", "winners", "unnamed"]
    asked = ["digest", "n", "doc_id", "row"]
    left = index.select("shard", F.lit(0).alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in zip(asked, ("binary", "bigint", "bigint", "bigint"))], *payload)
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")
    kinds = ("array<int>", "binary", "binary", "binary", "binary", "binary")
    right = groups.select(shard, F.lit(1).alias("kind"), *asked, *[F.lit(None).cast(t).alias(c) for c, t in zip(payload, kinds)])
    parts = min(shards, tasks)
    both = left.unionAll(right).repartitionById(parts, F.pmod("shard", F.lit(parts))).sortWithinPartitions("shard", "kind")

    def find(batches):
        shard, held = None, None
        for batch in batches:
            names, kinds = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            turns = np.nonzero((names[1:] != names[:-1]) | (kinds[1:] != kinds[:-1]))[0] + 1
            edges = [0, *turns.tolist(), len(names)] if len(names) else []
            for start, end in zip(edges, edges[1:]):
                if names[start] != shard:
                    shard, held = names[start], None
                if kinds[start] == 0:
                    row = {c: batch.column(c)[start].as_py() for c in payload}
                    digests = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
                    unnamed = np.unpackbits(np.frombuffer(row["unnamed"], np.uint8), count=len(digests)).astype(bool)
                    held = (
                        PerfectHash.from_bytes(row["sizes"], row["bits"]), digests,
                        np.frombuffer(row["winners"], "<i8"), unnamed, np.frombuffer(row["copies"], "<i8"),
                    )
                    continue
                part = batch.slice(start, end - start)
                known = np.zeros(part.num_rows, bool)
                ids, copies, nulls = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64), np.ones(part.num_rows, bool)
                if held is not None:
                    hashes, digests, winners, unnamed, counts = held
                    wanted = _digests(part.column("digest"))
                    slots = hashes.slots(wanted)
                    at = np.nonzero(slots >= 0)[0]
                    at = at[(digests[slots[at]] == wanted[at]).all(1)]
                    known[at] = True
                    ids[at], copies[at], nulls[at] = winners[slots[at]], counts[slots[at]], unnamed[slots[at]]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in asked], pa.array(known), pa.array(ids, mask=nulls), pa.array(copies)],
                    [*asked, "known", "known_id", "known_n"],
                )

    return both.mapInArrow(find, "digest binary, n bigint, doc_id bigint, row bigint, known boolean, known_id bigint, known_n bigint")


def _named(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows with what ``groups`` (digest, keep_id, keep_row, group_size, known) says of their digest."""
    found = salted_lookup(rows, groups, ["digest"], ["row"])
    kept = ~F.col("known") & (F.col("row") == F.col("keep_row"))
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "known")


def dedup_batch(rows: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ``digested`` rows: (doc_id, keep_id, group_size, kept, text_sha256, known; the groups with what the index says).

    A text that the index knows is a repeat of the winner there and is not kept; the others group among themselves, and
    of equal texts the row with the largest doc_id is kept. group_size counts the copies in the index too.
    """
    looked = written(looked_up(grouped(rows), index), "digest-groups")
    groups = looked.select(
        "digest", F.when(F.col("known"), F.col("known_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.col("row").alias("keep_row"), (F.col("n") + F.col("known_n")).alias("group_size"), "known",
    )
    return _named(rows, groups), looked


def exact_dedup(docs: DataFrame, index: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, known for a new batch of documents against an index of earlier ones.

    Texts are equal when their SHA-256 after lower-casing A-Z are; null counts as empty. Null doc_ids come last in the
    choice of the winner and may stand in keep_id. Of rows that share text and doc_id one is kept. Without rows there is no
    result. Columns other than doc_id and text are not read.
    """
    return dedup_batch(digested(docs), index)[0]


def split_dedup(docs: DataFrame) -> DataFrame:
    """Exact dedup of one table by the same way: the upper half of the doc_ids is the history, indexed first; the rest
    is looked up in it, so a repeat points to the largest doc_id of all. Copies found there count for the history's
    groups too. Same columns and cases as ``exact_dedup``."""
    rows = digested(docs)
    middle = rows.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    old = F.coalesce(F.col("doc_id") > F.lit(middle).cast("bigint"), F.lit(False))
    history, fresh = rows.filter(old), rows.filter(~old)
    before = written(grouped(history), "history-groups")
    later, looked = dedup_batch(fresh, build_index(before))
    more = looked.filter("known").select("digest", F.col("n").alias("more"))
    groups = before.join(more, "digest", "left").select(
        "digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
        (F.col("n") + F.coalesce("more", F.lit(0))).alias("group_size"), F.lit(False).alias("known"),
    )
    return _named(history, groups).unionAll(later).drop("known")


SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


@query("op13_exact_dedup", SQL)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_dedup(table(spark, sf_dir, "documents"))
