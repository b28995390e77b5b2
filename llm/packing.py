"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import bisect
import random
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table, written
from llm.registry import query
from llm.tokens import END, default_vocabulary, encoder, texts_of

CAPACITY = 2048
#: Pieces that are packed together; islands that pack the same ones; rounds with a migration between them.
BLOCK, ISLANDS, ROUNDS = 4096, 2, 2
POPULATION, CROSSOVERS = 4, 8
#: Sequences filled less than this are opened again and packed with those of other blocks.
OPEN_BELOW = 0.95


# --- one block on one island -------------------------------------------------------------------------------------


class Bins:
    """Open sequences by the room they have left; best fit is the smallest room that is enough."""

    def __init__(self, capacity: int):
        self.capacity, self.room, self.items = capacity, [], []

    def place(self, item: int, length: int) -> None:
        at = bisect.bisect_left(self.room, (length, -1))
        if at == len(self.room):
            self.items.append([item])
            number, left = len(self.items) - 1, self.capacity - length
        else:
            left, number = self.room.pop(at)
            left -= length
            self.items[number].append(item)
        if left:
            bisect.insort(self.room, (left, number))

    def take(self, items: list[int], length: int) -> None:
        """A whole sequence as it is."""
        self.items.append(list(items))
        if length < self.capacity:
            bisect.insort(self.room, (self.capacity - length, len(self.items) - 1))


def best_fit(order: list[int], lengths: list[int], capacity: int) -> list[list[int]]:
    bins = Bins(capacity)
    for item in order:
        bins.place(item, lengths[item])
    return bins.items


def total(items: list[int], lengths: list[int]) -> int:
    return sum(map(lengths.__getitem__, items))


def fitness(bins: list[list[int]], lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then uneven filling: full ones beside one with room left for more."""
    return -len(bins), sum([(total(b, lengths) / capacity) ** 2 for b in bins])


def crossover(giver, taker, lengths: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """The giver's well-filled sequences are injected whole; the taker's that share a document with them go; documents
    displaced by that are placed by best fit, long ones first."""
    fill = [total(b, lengths) for b in giver]
    bar = sorted(fill)[int(len(fill) * rng.uniform(0.3, 0.7))]
    injected = [(b, f) for b, f in zip(giver, fill) if f >= bar and (f == capacity or rng.random() < 0.8)]
    inside = set().union(*(b for b, _ in injected))
    out, loose = Bins(capacity), []
    for b, f in injected:
        out.take(b, f)
    for b in taker:
        if inside.isdisjoint(b):
            out.take(b, total(b, lengths))
        else:
            loose += [i for i in b if i not in inside]
    for i in sorted(loose, key=lengths.__getitem__, reverse=True):
        out.place(i, lengths[i])
    return out.items


def evolve(lengths: list[int], population: list[list[list[int]]], seed: int, capacity: int):
    """The population after a round, best first. A packing that reaches the bound of the sum ends the round."""
    rng, n = random.Random(seed), len(lengths)
    if not population:
        falling = sorted(range(n), key=lengths.__getitem__, reverse=True)
        population = [best_fit(falling, lengths, capacity)]
        for k in range(1, POPULATION):
            noisy = sorted(range(n), key=lambda i: -lengths[i] * rng.uniform(1 - 0.1 * k, 1))
            population.append(best_fit(noisy, lengths, capacity))
    least = -(-sum(lengths) // capacity)
    ranked = sorted(((fitness(p, lengths, capacity), k, p) for k, p in enumerate(population)), key=lambda x: (-x[0][0], -x[0][1], x[1]))
    for k in range(CROSSOVERS):
        if -ranked[0][0][0] <= least:
            break
        a, b = rng.sample(range(len(ranked)), 2) if len(ranked) > 1 else (0, 0)
        child = crossover(ranked[min(a, b)][2], ranked[max(a, b)][2], lengths, capacity, rng)
        ranked.append((fitness(child, lengths, capacity), len(population) + k, child))
        ranked.sort(key=lambda x: (-x[0][0], -x[0][1], x[1]))
        del ranked[POPULATION:]
    return [p for _, _, p in ranked]


def _genome(bins: list[list[int]], n: int) -> bytes:
    out = np.zeros(n, "<i4")
    for k, b in enumerate(bins):
        out[b] = k
    return out.tobytes()


def _bins(genome: bytes) -> list[list[int]]:
    where = np.frombuffer(genome, "<i4")
    out = [[] for _ in range(int(where.max()) + 1 if len(where) else 0)]
    for i, b in enumerate(where.tolist()):
        out[b].append(i)
    return out


# --- on Spark ----------------------------------------------------------------------------------------------------


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids as bytes), id of every piece. A document of more than
    ``capacity`` tokens becomes pieces of that length, after a shorter first one if it does not come out even."""
    path = vocabulary or default_vocabulary()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids

    def cut(batches):
        own = encoder(path)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            encoded = own.encode_rows(texts_of(batch))
            while some := list(islice(encoded, 256)):
                rows = []
                for doc_id, ids in some:
                    ids += END
                    n = len(ids) // 4
                    edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                        data = ids[4 * a : 4 * b]
                        rows.append((doc_id, piece, a, b - a, zlib.crc32(data), data)[: len(names)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    pieces = docs.select("doc_id", "text").mapInArrow(cut, schema)
    return written(pieces.withColumn("id", F.monotonically_increasing_id()), "pieces")


def _packed(items: DataFrame, blocks: int, capacity: int, seed: int) -> DataFrame:
    """block, ids, lengths, genome: the best packing of each block, after rounds of evolution and migration."""
    block = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(blocks)).cast("int")
    state = (
        items.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("id", "length"))).alias("i"))
        .select("block", F.col("i.id").alias("ids"), F.col("i.length").alias("lengths"), F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
        .withColumn("population", F.array().cast("array<binary>"))
    )
    schema = "block int, island int, ids array<bigint>, lengths array<bigint>, population array<binary>"

    def turn(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                b, island, _, lengths, population = (c[0].as_py() for c in row.columns)
                after = evolve(lengths, [_bins(g) for g in population], 7919 * b + 31 * island + len(population) + seed, capacity)
                genomes = [_genome(p, len(lengths)) for p in after]
                yield pa.RecordBatch.from_arrays([*row.columns[:4], pa.array([genomes], pa.list_(pa.binary()))], batch.schema.names)

    for k in range(ROUNDS):
        tasks = state.select("block", "island", "ids", "lengths", "population").repartition("block", "island")
        state = written(tasks.mapInArrow(turn, schema), "islands")
        if k + 1 < ROUNDS:  # the best of each island joins the next one
            elite = state.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("population")[0].alias("elite"))
            state = state.join(elite, ["block", "island"]).withColumn("population", F.array_union("population", F.array("elite"))).drop("elite")

    def count(batches):
        for batch in batches:
            best = [p[0] for p in batch.column(4).to_pylist()]
            n = [int(np.frombuffer(g, "<i4").max()) + 1 for g in best]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(best, pa.binary()), pa.array(n, pa.int32())], ["block", "island", "ids", "lengths", "genome", "n"])

    counted = state.mapInArrow(count, "block int, island int, ids array<bigint>, lengths array<bigint>, genome binary, n int")
    best = counted.groupBy("block").agg(F.min(F.struct("n", "island")).alias("least"))
    return counted.join(best, "block").filter("n = least.n AND island = least.island").select("block", "ids", "lengths", "genome")


def place_items(items: DataFrame, capacity: int = CAPACITY, seed: int = 3) -> DataFrame:
    """id, sequence_id, offset for items (id, length of at most ``capacity``).

    Items of full length are sequences of their own. The others are dealt by a hash into blocks of about BLOCK; each
    block is evolved on islands, and its poorly filled sequences are opened and packed with those of other blocks,
    until one block is left or most stay open. No task sees more than a block.
    """
    whole = items.filter(F.col("length") >= capacity).select("id", (-F.col("id") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest, out, level = items.filter(F.col("length") < capacity).select("id", F.col("length").cast("bigint").alias("length")), whole, 0
    count = rest.count()

    def unfold(batches):
        for batch in batches:
            for b, ids, lengths, genome in zip(*(c.to_pylist() for c in batch.columns)):
                where, lengths = np.frombuffer(genome, "<i4").astype(np.int64), np.array(lengths, np.int64)
                order = np.argsort(where, kind="stable")
                ends = np.cumsum(lengths[order])
                fill = np.bincount(where, lengths).astype(np.int64)
                before = np.cumsum(fill) - fill
                offset = ends - lengths[order] - before[where[order]]
                columns = [np.array(ids, np.int64)[order], np.full(len(ids), b, np.int32), where[order], offset, lengths[order], fill[where[order]]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "block", "bin", "offset", "length", "fill"])

    while count:
        blocks = -(-count // BLOCK)
        packed = _packed(rest, blocks, capacity, seed + level)
        placed = written(
            packed.mapInArrow(unfold, "id bigint, block int, bin bigint, offset bigint, length bigint, fill bigint"), "placed"
        )
        number = F.lit(level).cast("bigint") * F.lit(1 << 56) + F.col("block").cast("bigint") * F.lit(1 << 20) + F.col("bin")
        open_ = F.col("fill") < F.lit(OPEN_BELOW * capacity)
        left = placed.filter(open_).count() if blocks > 1 else 0
        again = 0 < left <= count // 2
        done = placed.filter(~open_) if again else placed
        out = out.unionAll(done.select("id", number.alias("sequence_id"), "offset"))
        rest, count, level = placed.filter(open_).select("id", "length"), left if again else 0, level + 1
    return out


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False, seed: int = 3
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids as bytes) for every piece of every row.

    Every document ends with id 0; a null or empty text is that id alone. Each row is packed by itself, so repeated
    rows and null ids are packed like others. An empty table gives no rows. Other columns are not read.
    """
    pieces = cut_pieces(docs, capacity, vocabulary, with_ids)
    places = place_items(pieces.select("id", "length"), capacity, seed)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return pieces.join(places, "id").select(*names)


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
