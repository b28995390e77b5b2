"""N-gram Jaccard join by partitioning the universe of shingles into segments, and its connected components.

Two sets with a Jaccard similarity of at least t differ in at most H = (1 - t) / (1 + t) * (|x| + |y|) shingles. If a
hash deals all shingles to more than H segments, the two agree on some segment exactly; and if a segment also counts
as agreeing when one deletion makes it equal, it stands for two. Every set is indexed by its segments; as a query it
must look up segments worth H + 1 in all. The costs decide which: a set that has more segments leaves out those that
most others meet it in, by true counts over all texts, so segments that a frequent passage fills cost nothing; a set
that has fewer takes deletion neighbourhoods as well, those of segments with few shingles first.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import LOWER, PRIME, as_bytes, mix, shingles, small_batches, table, word_hashes, written
from llm.components import extended_components
from llm.meeting import BOTH, INDEX, PROBE, meetings, parity, resolved, runs_of
from llm.registry import query

# --- the partition of the universe ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Scheme:
    """n words a shingle; similarity of at least percent / 100. Bands of sizes grow by 100 / percent, so the partners
    of a set that are no larger lie in its own band or the one before."""

    n: int = 5
    percent: int = 80
    starts: np.ndarray = field(default=None, compare=False)

    def __post_init__(self):
        starts = [1]
        while starts[-1] < 1 << 40:
            starts.append(max(starts[-1] + 1, -(-starts[-1] * 100 // self.percent)))
        object.__setattr__(self, "starts", np.array(starts))

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def most_apart(self, x: int, y: int) -> int:
        """The largest number of different shingles of a linked pair of these sizes."""
        return (100 - self.percent) * (x + y) // (100 + self.percent)

    def segments(self, band: int) -> tuple[int, int]:
        """Number of segments of a band, and how many of them, the first ones, are indexed with one deletion."""
        top = int(self.starts[band + 1]) - 1
        m = self.most_apart(top, top * 100 // self.percent) + 1 + top // 40 + 1
        return m, min(m, 2 + m // 48)

    def linked(self, common: int, x: int, y: int) -> bool:
        return 100 * common >= self.percent * (x + y - common)


def _key(band: int, segment: np.ndarray, content: np.ndarray, kind: int) -> np.ndarray:
    """To be mixed, all keys of a set at once."""
    return content * PRIME + (segment.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(2 * band + kind))


def _cut(tokens: np.ndarray, band: int, scheme: Scheme):
    """The set's tokens by segment: order, starts of the segments that have any, their numbers."""
    m, _ = scheme.segments(band)
    odd = np.uint64((2 * band + 1) * int(PRIME) % 2**64)  # tokens are well mixed; the upper bits of a product are too
    segment = (((tokens * odd) >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    segment = segment.astype(np.uint16 if m < 1 << 16 else np.uint32)
    order = np.argsort(segment, kind="stable")
    ordered = segment[order]
    starts = np.concatenate([[0], np.nonzero(ordered[1:] != ordered[:-1])[0] + 1])
    return order, starts, ordered[starts].astype(np.int64)


def signatures(tokens: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, roles and spares of a set (sorted distinct hashes): ``spare`` is how many of the keys that the set looks up
    in a band it could do without. Sets too small to differ in anything have none."""
    size, keys, roles = len(tokens), [], []
    own = scheme.band(size)

    def give(key, role, spare):
        if len(key):
            keys.append(key)
            roles.append((len(key), role, spare))

    for band in (own, own - 1):
        if band < 0:
            continue
        top = int(scheme.starts[band + 1]) - 1
        need = scheme.most_apart(size if band == own else top, size) + 1
        if scheme.most_apart(top, top * 100 // scheme.percent) == 0 or (band != own and need == 1):
            continue  # only equal sets could link, and they are one already
        m, flexible = scheme.segments(band)
        order, starts, numbers = _cut(tokens, band, scheme)
        each = tokens[order] * np.uint64(0xA24BAED4963EE407)
        content = np.add.reduceat(each, starts)
        counts = np.empty(len(starts), np.int64)
        np.subtract(starts[1:], starts[:-1], counts[:-1])
        counts[-1] = size - starts[-1]
        full = _key(band, numbers, content, 0)
        # Flexible segments come first in the order of the tokens.
        n_flex = int(np.searchsorted(numbers, flexible))
        tail = int(counts[:n_flex].sum())
        less = np.repeat(content[:n_flex], counts[:n_flex]) - each[:tail]
        place = np.repeat(numbers[:n_flex], counts[:n_flex])
        missing = max(0, need - len(full))
        twice = np.argsort(counts[:n_flex], kind="stable")[:missing]  # a second unit each, for their deletions
        void = np.zeros(0, np.uint64)
        if missing > len(twice) or band == own:
            absent = np.ones(m, bool)
            absent[numbers] = False
            absent = np.nonzero(absent)[0]
            void = _key(band, absent, np.zeros(len(absent), np.uint64), 0)
        asked = min(len(void), missing - len(twice))  # only then are empty segments looked up
        spare = max(0, len(full) - need)
        if band == own:
            give(full, BOTH, spare)
            give(void[:asked], BOTH, spare)
            give(void[asked:], INDEX, 0)
            give(_key(band, place, less, 1), INDEX, 0)
        else:
            give(full, PROBE, spare)
            give(void[:asked], PROBE, spare)
        if len(twice):
            wanted = np.isin(place, numbers[twice])
            give(_key(band, numbers[twice], content[twice], 1), PROBE, 0)
            give(_key(band, place[wanted], less[wanted], 0), PROBE, 0)
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, np.int32)
    n, role, spare = np.array(roles).T
    return mix(np.concatenate(keys)), np.repeat(role.astype(np.int8), n), np.repeat(spare.astype(np.int32), n)


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the text's n-word shingles, A-Z in lower case."""
    return shingles(word_hashes(as_bytes(text).translate(LOWER)), n)


# --- the join --------------------------------------------------------------------------------------------------


def _facts(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, size, digest of every row."""

    def read(batches):
        for batch in batches:
            sets = [shingle_set(t, scheme.n) for piece in small_batches(batch, 500) for t in piece.column(1).to_pylist()]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            sizes = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())], ["doc_id", "size", "digest"])

    return written(docs.select("doc_id", "text").mapInArrow(read, "doc_id bigint, size bigint, digest binary"), "jaccard-facts")


def _signed(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """sig, doc, role, spare of the documents with words; of equal sets in a task one stands for all."""

    def sign(batches):
        known = set()
        for batch in batches:
            for piece in small_batches(batch, 500):
                parts, ids = [], []
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    tokens = shingle_set(text, scheme.n)
                    if not len(tokens) or doc_id is None:
                        continue
                    digest = xxhash.xxh3_128_digest(tokens.tobytes())
                    if digest in known:
                        continue
                    if len(known) > 500_000:
                        known.clear()
                    known.add(digest)
                    parts.append(signatures(tokens, scheme))
                    ids.append(np.full(len(parts[-1][0]), doc_id, np.int64))
                if parts:
                    key, role, spare = (np.concatenate(p) for p in zip(*parts))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.concatenate(ids)), pa.array(role), pa.array(spare)], ["sig", "doc", "role", "spare"]
                    )

    return docs.select("doc_id", "text").mapInArrow(sign, "sig bigint, doc bigint, role tinyint, spare int")


def _sets(docs: DataFrame, ids: DataFrame, scheme: Scheme) -> DataFrame:
    """id, tokens, size, sketch of the documents in ``ids`` (doc_id), made again from their texts."""

    def cut(batches):
        for batch in batches:
            for piece in small_batches(batch, 500):
                sets = [shingle_set(t, scheme.n) for t in piece.column(1).to_pylist()]
                columns = [
                    piece.column(0), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([parity(s) for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "tokens", "size", "sketch"])

    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    return written(texts.mapInArrow(cut, "id bigint, tokens binary, size bigint, sketch array<bigint>"), "jaccard-sets")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row: the classes of the links with a similarity of at least
    ``percent`` / 100 between sets of n-word shingles.

    Equal sets become one first. Pairs that share a signature are resolved exactly by ``resolved``, most of them
    without being made.

    A text with fewer words counts as one shingle; one without words has an empty set and its own class. Rows with a
    null doc_id link with nothing and get a null class. Rows that share a doc_id are one document if their sets are
    equal, else the id joins the links of all of them. An empty table gives no rows. Other columns are not read.
    """
    scheme = Scheme(n, percent)
    own = _facts(docs, scheme)
    sets = own.filter("size > 0 AND doc_id IS NOT NULL")
    classes = sets.join(sets.groupBy("digest").agg(F.min("doc_id").alias("rep")), "digest").groupBy("doc_id").agg(F.min("rep").alias("rep"))
    classes = written(classes, "jaccard-classes")

    met = runs_of(meetings(_signed(docs, scheme)))
    names = classes.select(F.col("doc_id").alias("b"), F.col("rep").alias("rep_b"))
    centres = classes.select(F.col("doc_id").alias("a"), F.col("rep").alias("rep_a"))
    runs = written(
        met.join(names, "b").join(centres, "a").filter("rep_a <> rep_b")
        .groupBy("run", F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).agg(F.max("asks").alias("asks")),
        "jaccard-runs",
    )
    ids = runs.select(F.col("a").alias("doc_id")).unionAll(runs.select(F.col("b").alias("doc_id"))).distinct()
    parts = resolved(runs, _sets(docs, ids, scheme), percent)
    same = classes.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    parts = extended_components(parts, same).withColumnRenamed("node", "doc_id")
    return own.join(parts, "doc_id", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its class, or null. Equal rows stay together."""
    classes = jaccard_components(docs, n, percent).select("doc_id", "component_id").distinct()
    gone = classes.filter("doc_id <> component_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words
),
cells AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS t FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM cells a JOIN cells b ON a.t = b.t AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id
)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.root) AS component_id
FROM sets s JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id, len(s.s)
"""


@query("op4_jaccard_join", SQL)
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
