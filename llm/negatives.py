"""Hard-negative mining: exact integer scores of anchors against all rows, then the rows in a window below a positive."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import shuffle_tasks, table, written
from llm.registry import query
from llm.residues import Residues, primes_for

#: Bytes of the anchors of a unit of work, whole components counted; rows of a unit; anchors and rows multiplied at once.
ANCHOR_BYTES, UNIT_ROWS, TILE = 1 << 24, 1 << 20, (1024, 2048)
NONE = -(1 << 63)


class _Best:
    """The ``keep`` best rows of every anchor so far: the highest score first, then the smallest id."""

    def __init__(self, anchors: int, keep: int):
        self.ids, self.scores = np.zeros((anchors, keep), np.int64), np.full((anchors, keep), NONE, np.int64)

    def least(self) -> np.ndarray:
        """The score that a later row must pass; ids come in rising order, so an equal one is no better."""
        return self.scores[:, -1]

    def add(self, anchor: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(anchor):
            return
        touched = np.unique(anchor)
        keep = self.ids.shape[1]
        anchor = np.concatenate([np.repeat(touched, keep), anchor])
        ids = np.concatenate([self.ids[touched].reshape(-1), ids])
        scores = np.concatenate([self.scores[touched].reshape(-1), scores])
        order = np.lexsort((ids, -scores - 1, anchor))  # -(score + 1) has no overflow at NONE
        anchor, ids, scores = anchor[order], ids[order], scores[order]
        first = np.searchsorted(anchor, anchor)
        place = np.arange(len(anchor)) - first
        best = place < keep
        self.ids[anchor[best], place[best]], self.scores[anchor[best], place[best]] = ids[best], scores[best]

    def rows(self):
        at, place = np.nonzero(self.scores > NONE)
        return at, self.ids[at, place], self.scores[at, place]


class _Anchors:
    """The anchors of one unit that have the same number of components, and the best rows found for them."""

    def __init__(self, ids, labels, matrix, windows, primes, keep: int):
        self.ids, self.labels, self.residues, self.primes = ids, labels, Residues(matrix, primes), primes
        self.low, self.high = windows if windows is not None else (None, None)  # anchors x positives
        self.best = [_Best(len(ids), keep) for _ in range(1 if windows is None else self.low.shape[1])]

    def meet(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> None:
        rows = Residues(matrix, self.primes)
        for start in range(0, len(self.ids), TILE[0]):
            at = slice(start, min(start + TILE[0], len(self.ids)))
            scores = self.residues.rows(at.start, at.stop).times(rows)
            same = self.labels[at, None] == labels[None, :]
            if self.low is None:
                keep = self.best[0].ids.shape[1]
                scores[~same | (self.ids[at, None] == ids[None, :])] = NONE
                floor = self.best[0].least()[at]
                if scores.shape[1] > keep:  # no row below the batch's own keep-th best can stay
                    own = np.partition(scores, -keep, axis=1)[:, -keep]
                    floor = np.maximum(floor, np.maximum(own, NONE + 1) - 1)
                anchor, row = np.nonzero(scores > floor[:, None])
                self.best[0].add(anchor + start, ids[row], scores[anchor, row])
            else:
                wanted = ~same & (scores >= self.low[at].min(1)[:, None]) & (scores <= self.high[at].max(1)[:, None])
                anchor, row = np.nonzero(wanted)
                found, anchor = scores[anchor, row], anchor + start
                for place, best in enumerate(self.best):
                    fits = (found >= self.low[anchor, place]) & (found <= self.high[anchor, place]) & (found > best.least()[anchor])
                    best.add(anchor[fits], ids[row[fits]], found[fits])


def _bounds(scores: list[list[int]], places: int, percent: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score in the window of every positive; an anchor with fewer has empty windows."""
    low = np.full((len(scores), places), (1 << 63) - 1, np.int64)
    high = np.full((len(scores), places), NONE, np.int64)
    for k, own in enumerate(scores):
        for place, score in enumerate(own):
            low[k, place] = max(NONE, min((1 << 63) - 1, -(-percent[0] * score // 100)))
            high[k, place] = max(NONE, min((1 << 63) - 1, percent[1] * score // 100))
    return low, high


def _integers(column, scale: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix of floor(scale * x)) of the vectors of every length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    out = []
    for n in np.unique(lengths):
        at = np.nonzero(lengths == n)[0]
        out.append((at, values[starts[at][:, None] + np.arange(n)[None, :]]))
    return out


def _grid(rows: DataFrame, anchors: DataFrame, facts, keep: int, scale: int, percent: tuple[int, int] | None, places: int) -> DataFrame:
    """anchor_id, place, vec_id, score: the best ``keep`` rows of each anchor (and positive) within each unit.

    A unit of work is a block of anchors and a share of the rows. Rows stream through it in the order of their ids,
    past the anchors, which stay. Both numbers follow from counts; neither labels nor equal vectors decide where a row goes.
    """
    tasks = shuffle_tasks(rows.sparkSession)
    blocks = max(1, math.ceil(facts["anchors"] * max(1, facts["dim"]) * 8 / ANCHOR_BYTES))
    shares = max(1, math.ceil(facts["n"] / UNIT_ROWS), min(math.ceil(2 * tasks / blocks), math.ceil(facts["n"] / TILE[0])))
    largest = math.floor(scale * facts["largest"]) + 1
    block, share = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)), F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(shares))
    none = F.lit(None).cast("array<bigint>")
    left = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), block.alias("block"), F.lit(0).alias("kind"),
        "vec_id", "label", "embedding", "scores",
    )
    right = rows.select(
        share.alias("share"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"),
        "vec_id", "label", "embedding", none.alias("scores"),
    )
    unit = (F.col("block") * shares + F.col("share")).cast("bigint").alias("unit")
    columns = ["kind", "vec_id", "label", "embedding", "scores"]
    both = left.select(unit, *columns).unionAll(right.select(unit, *columns))
    parts = min(blocks * shares, max(2 * tasks, 2))
    both = both.repartitionById(parts, F.pmod("unit", F.lit(parts)).cast("int")).sortWithinPartitions("unit", "kind", "vec_id", "label", "embedding")
    primes = {}

    def primes_of(dim: int) -> list[int]:
        if dim not in primes:
            primes[dim] = primes_for(dim, largest)
        return primes[dim]

    def search(batches):
        def result(groups):
            for group in groups.values():
                for place, best in enumerate(group.best):
                    at, ids, scores = best.rows()
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(group.ids[at]), pa.array(np.full(len(at), place, np.int32)), pa.array(ids), pa.array(scores)],
                            ["anchor_id", "place", "vec_id", "score"],
                        )

        def built(pieces):
            """The anchors of a unit, by the number of their components."""
            held = {}
            for piece in pieces:
                ids, labels = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
                scores = piece.column("scores").to_pylist() if percent else None
                for at, matrix in _integers(piece.column("embedding"), scale):
                    own = held.setdefault(matrix.shape[1], ([], [], [], []))
                    for k, part in enumerate((ids[at], labels[at], matrix, [scores[i] for i in at] if percent else [])):
                        own[k].append(part)
            return {
                dim: _Anchors(
                    np.concatenate(i), np.concatenate(lb), np.concatenate(m),
                    _bounds([x for part in s for x in part], places, percent) if percent else None, primes_of(dim), keep,
                )
                for dim, (i, lb, m, s) in held.items()
            }

        unit, pieces, groups, last = None, [], None, None
        for batch in batches:
            units = batch.column(0).to_numpy(zero_copy_only=False)
            kinds = batch.column(1).to_numpy(zero_copy_only=False)
            ids = batch.column(2).to_numpy(zero_copy_only=False)
            turns = np.nonzero((units[1:] != units[:-1]) | (kinds[1:] != kinds[:-1]))[0] + 1
            edges = [0, *turns.tolist(), batch.num_rows] if batch.num_rows else []
            for start, end in zip(edges, edges[1:]):
                if units[start] != unit:
                    yield from result(groups or {})
                    unit, pieces, groups, last = units[start], [], None, None
                # Of the rows with one vec_id the first in the order counts.
                fresh = np.ones(end - start, bool)
                fresh[1:] = ids[start + 1 : end] != ids[start : end - 1]
                fresh[0] = last != (kinds[start], ids[start])
                last = (kinds[end - 1], ids[end - 1])
                part = batch.slice(start, end - start).filter(pa.array(fresh))
                if kinds[start] == 0:
                    pieces.append(part)
                    continue
                if groups is None:
                    groups, pieces = built(pieces), []
                for at in range(0, part.num_rows, TILE[1]):
                    tile = part.slice(at, TILE[1])
                    own, labels = (tile.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
                    for where, matrix in _integers(tile.column("embedding"), scale):
                        if matrix.shape[1] in groups:
                            groups[matrix.shape[1]].meet(own[where], labels[where], matrix)
        yield from result(groups or {})

    return both.mapInArrow(search, "anchor_id bigint, place int, vec_id bigint, score bigint")


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` of every anchor and place over all units, with their rank. Spark limits each task's part before
    the shuffle, so an anchor brings at most ``keep`` rows a task."""
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, percent: tuple[int, int] = (80, 100), scale: int = 256
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label (integer) and embedding (array of numbers); other columns are not read. A component x
    counts as floor(scale * x); a score is the exact integer inner product with the anchor. An anchor's positives are
    its best ``positives`` other rows of the same label; a positive's negatives are the best ``negatives`` rows of other
    labels with a score between ``percent`` of the positive's score. Higher scores come first, then smaller vec_ids.

    Scores come from a residue number system: component matrices are multiplied modulo several small primes in
    float32, and the signed scores are put together by Chinese remaindering (``llm.residues``). The search runs twice,
    for the positives and, with their windows, for the negatives; every unit keeps only what its windows let through.

    Rows with a null vec_id, a null label, a null vector, or a null or non-finite component take no part. Of rows that
    share a vec_id the first by (label, components) takes part. Vectors of different length don't meet; empty ones meet
    with score 0. An anchor without positives, and a positive without negatives, give no rows. Components so large that
    a score might pass 64 bits raise an ArithmeticError before anything is compared.
    """
    sound = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding", is_anchor.alias("anchor")
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    sound = sound.filter(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    sound = written(sound, "negatives-rows")
    facts = sound.agg(
        F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("dim"),
        F.coalesce(F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))), F.lit(0.0)).alias("largest"),
    ).first()
    primes_for(facts["dim"], math.floor(scale * facts["largest"]) + 1)  # refuses what 64 bits don't hold
    anchors = sound.filter("anchor")
    found = _grid(sound, anchors.withColumn("scores", F.lit(None).cast("array<bigint>")), facts, positives, scale, None, 1)
    best = written(_ranked(found, positives).select("anchor_id", "vec_id", "score", "rank"), "positives")
    windows = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("found"))
    windows = windows.select(F.col("anchor_id").alias("vec_id"), F.col("found.score").alias("scores"))
    found = _grid(sound, anchors.join(windows, "vec_id"), facts, negatives, scale, percent, positives)
    chosen = _ranked(found, negatives).select("anchor_id", (F.col("place") + 1).alias("at"), "rank", "vec_id", "score")
    named = best.select(F.col("anchor_id").alias("own"), F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return chosen.join(named, (F.col("anchor_id") == F.col("own")) & (F.col("at") == F.col("place"))).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same
),
n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
  WHERE p.place <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query("op11_hard_negatives", SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)
