"""Near-duplicate embeddings by binary codes of randomly rotated vectors."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table, written
from llm.components import connected_components
from llm.registry import query

#: Vectors of one bucket compared in one task: two blocks of this many.
BLOCK = 512


class Rotations:
    """Random rotations of a dimension, the same in every worker. The first makes the codes that estimate inner
    products; the signs of all of them, in slices of ``bits``, are the bucket numbers of the tables."""

    made: dict[tuple, "Rotations"] = {}

    def __init__(self, dim: int, tables: int, bits: int, seed: int):
        rng = np.random.default_rng([seed, dim])
        turns = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-tables * bits // dim) + 1)]
        self.turn, self.tables, self.bits = turns[0], tables, bits
        self.planes = np.concatenate(turns[1:])[: tables * bits]

    @classmethod
    def of(cls, dim: int, tables: int, bits: int, seed: int) -> "Rotations":
        key = (dim, tables, bits, seed)
        if key not in cls.made:
            cls.made[key] = cls(*key)
        return cls.made[key]

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """vectors x tables."""
        signs = (unit @ self.planes.T > 0).reshape(len(unit), self.tables, self.bits)
        return signs @ (1 << np.arange(self.bits, dtype=np.int64))


def table_count(bits: int, cosine: float, miss: float) -> int:
    """How many tables leave a pair at the threshold in no common bucket with probability ``miss``."""
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return max(1, math.ceil(math.log(miss) / math.log1p(-same)))


def _valid(vector) -> np.ndarray | None:
    if not vector or any(x is None for x in vector):
        return None
    out = np.array(vector, np.float64) + 0.0
    return out if np.isfinite(out).all() and out.any() else None


def _matrix(cells) -> np.ndarray:
    return np.stack([np.frombuffer(c, np.float64) for c in cells])


def _linked(a: np.ndarray, b: np.ndarray, rotations: Rotations, cosine: float, sigmas: float):
    """Index pairs of rows of ``a`` and ``b`` with a cosine of at least ``cosine``, and how many were recomputed.

    ``b`` is seen through its code (signs after the rotation, scaled to unit length) and its correction factor, the
    inner product of code and vector. Code times query over factor estimates the inner product without bias; its
    error is below ``sigmas`` * sqrt((1 - factor^2) / factor^2 / (dim - 1)) but for a probability that falls as
    exp(-sigmas^2 / 2). Pairs whose upper bound reaches the threshold are computed in double precision.
    """
    dim = a.shape[1]
    la, lb = np.sqrt(np.einsum("ij,ij->i", a, a)), np.sqrt(np.einsum("ij,ij->i", b, b))
    turned = (b / lb[:, None]) @ rotations.turn.T
    code = np.where(turned > 0, 1.0, -1.0) / math.sqrt(dim)
    factor = np.einsum("ij,ij->i", code, turned)
    estimate = ((a / la[:, None]) @ rotations.turn.T) @ code.T / factor
    error = sigmas * np.sqrt(np.maximum(0, 1 - factor**2) / factor**2 / max(1, dim - 1))
    i, j = np.nonzero(estimate + error[None, :] >= cosine - 1e-9)
    exact = np.concatenate(
        [np.einsum("ij,ij->i", a[i[k : k + 65536]], b[j[k : k + 65536]]) for k in range(0, len(i), 65536)] or [np.zeros(0)]
    ) / (la[i] * lb[j])
    near = exact >= cosine
    return i[near], j[near], len(i)


def embedding_links(
    vectors: DataFrame, cosine: float = 0.9, miss: float = 0.005, sigmas: float = 4.5, seed: int = 11
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding).

    Equal vectors are first counted as one. The signs of rotated vectors put every vector into a bucket of each
    table; buckets grow no larger with the input, since their number does, and the number of tables follows from
    ``miss``, the chance that a pair right at the threshold shares no bucket (it falls fast above). A bucket of many
    different vectors is cut into blocks, and each pair of blocks is a unit of work. Within a unit, codes and
    correction factors decide which pairs need the exact cosine. A pair is counted in the first table it shares; a
    unit reports counts and a forest, so a cluster of n vectors makes n rows and not n * n.

    No false links; recall against brute force is tested. Null, zero, empty and non-finite vectors link with nothing;
    vectors of different length don't link. Rows with a null vec_id take no part and get null component and kept.
    Equal rows are copies of each other; equal vec_ids with different vectors join their links.
    """

    def read(batches):
        for batch in batches:
            rows = []
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = _valid(vector)
                data = v.tobytes() if v is not None and vec_id is not None else None
                rows.append((vec_id, data, None if data is None else xxhash.xxh3_128_digest(data)))
            if rows:
                kinds = [pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["vec_id", "vector", "key"])

    rows = written(vectors.select("vec_id", "embedding").mapInArrow(read, "vec_id bigint, vector binary, key binary"), "vectors")
    groups = written(
        rows.filter("key IS NOT NULL").groupBy("key")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.min("vector").alias("vector")), "vector-groups",
    )
    count = groups.count()
    bits = max(4, math.ceil(math.log2(max(1, count) / 64)))
    tables = table_count(bits, cosine, miss)

    def place(batches):
        for batch in batches:
            cells = batch.column(1).to_pylist()
            out, dims = np.zeros((len(cells), tables), np.int64), np.array([len(c) // 8 for c in cells])
            for dim in np.unique(dims):
                at = np.nonzero(dims == dim)[0]
                m = _matrix([cells[k] for k in at])
                out[at] = Rotations.of(int(dim), tables, bits, seed).buckets(m)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, tables), pa.int32()), pa.array(out.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), flat], ["rep", "vector", "n", "buckets"])

    placed = groups.select("rep", "vector", "n").mapInArrow(place, "rep bigint, vector binary, n bigint, buckets array<bigint>")
    placed = placed.select("rep", "n", "vector", F.length("vector").alias("dim"), F.posexplode("buckets").alias("table", "bucket"))
    key = ["dim", "table", "bucket"]
    sizes = placed.groupBy(*key).agg(F.count("*").alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    units = (
        placed.join(sizes, key).withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(
            *key, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "block", "rep", "n", "vector",
        )
    )
    unit = [*key, "low", "high"]
    units = units.repartition(*unit).sortWithinPartitions(*unit, "rep")

    def compare(batches):
        from llm.components import Forest

        def work(name, rows):
            dim, shared, _, low, high = name
            rotations = Rotations.of(dim // 8, tables, bits, seed)
            first = [r for r in rows if r[0] == low]
            second = first if low == high else [r for r in rows if r[0] == high]
            if not first or not second:
                return
            a, b = _matrix([r[3] for r in first]), _matrix([r[3] for r in second])
            i, j, _ = _linked(a, b, rotations, cosine, sigmas)
            if low == high:
                i, j = i[i < j], j[i < j]
            if not len(i):
                return
            # Every link joins; a link counts only in the first table whose bucket the two share.
            forest = Forest(len(first) + (0 if low == high else len(second)))
            shift = 0 if low == high else len(first)
            for x, y in zip(i.tolist(), j.tolist()):
                forest.join(x, y + shift)
            ba, bb = rotations.buckets(a), rotations.buckets(b)
            new = np.concatenate([~(ba[i[k : k + 65536], :shared] == bb[j[k : k + 65536], :shared]).any(1) for k in range(0, len(i), 65536)])
            members = first if low == high else first + second
            weight = np.array([r[2] for r in members], np.int64)
            links = np.zeros(len(members), np.int64)
            np.add.at(links, i[new], weight[j[new] + shift])
            np.add.at(links, j[new] + shift, weight[i[new]])
            touched = np.unique(np.concatenate([i, j + shift])).tolist()
            for k in touched:
                yield members[k][1], members[forest.find(k)][1], int(links[k])

        def runs():
            name, held = None, []
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                for *now, block, rep, n, vector in zip(*columns):
                    if now != name:
                        if held:
                            yield name, held
                        name, held = now, []
                    held.append((block, rep, n, vector))
            if held:
                yield name, held

        out = []
        for name, rows in runs():
            out.extend(work(name, rows))
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b", "links"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b", "links"])

    found = written(units.mapInArrow(compare, "a bigint, b bigint, links bigint"), "vector-links")
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("_links"))
    parts = connected_components(found.select("a", "b")).withColumnRenamed("node", "rep")
    known = (
        groups.select("key", "rep", "n").join(links, "rep", "left").join(parts, "rep", "left")
        .select("key", (F.col("n") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    component = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id", "key").join(known, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_sum(list_transform(embedding, lambda x: x * x)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
),
reach AS (
  SELECT vec_id, vec_id AS root FROM embeddings
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.vec_id
),
parts AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM parts
"""


@query("op5_embedding_near_dedup", SQL)
def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))
