"""Phrase collocations by relational mining: occurrence relations, extended by merge-joins on adjacent positions."""

from __future__ import annotations

from array import array
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookflow.plans.session import stage_folder
from llm.common import as_bytes, mix, shuffle_tasks, table, written
from llm.registry import query

#: Words a chunk of the occurrence relation, about; the pieces of a longer run of words are read so many bytes at once.
CHUNK, STEP = 750_000, 1 << 20
#: Groups of chunks that are counted in one task, about: words, and pairs of phrases.
WORDS, PAIRS = 200_000, 1_000_000
#: Totals are broadcast up to this many langs, counted first.
LANGS = 10_000

#: A-Z lower-cased, tabs as blanks, what ends a piece as line feeds.
READ = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 10)


class _Codes(dict):
    """The words of one lang in a chunk, numbered as they come by the chunk's own counter."""

    def __init__(self, names: list, lang: str):
        super().__init__()
        self.names, self.lang = names, lang

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self.names)
        self.names.append((self.lang, word))
        return code


class _Chunk:
    """Occurrences in order: the code of every word, and its place, which rises by one within a piece and by two after
    it. The first ``skip`` words only stand before what follows; they belong to the chunk before."""

    def __init__(self):
        self.codes, self.ends, self.names, self.langs, self.skip = array("i"), [], [], {}, 0

    def add(self, lang: str, words: list[bytes]) -> None:
        held = self.langs.get(lang)
        if held is None:
            held = self.langs[lang] = _Codes(self.names, lang)
        self.codes.extend(map(held.__getitem__, words))

    def row(self, number: int) -> pa.RecordBatch:
        codes = np.frombuffer(self.codes, np.int32)
        steps = np.ones(len(codes), np.int32)
        ends = np.array(self.ends, np.int64)
        steps[ends[ends < len(codes)]] = 2
        steps[0] = 0
        # Codes are handed out anew in the order of the words' hashes, so that a bucket is a stretch of them.
        keys = [lang.encode() + SEAM + word for lang, word in self.names]
        order = np.argsort(_word_hashes(keys), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        codes = place[codes]
        counts = np.bincount(codes[self.skip :], minlength=len(keys)).astype(np.int32)
        one = np.array([0, len(keys)], np.int32)
        words = pa.ListArray.from_arrays(one, pa.array([keys[k] for k in order.tolist()], pa.binary()))
        return _batch(RELATION_1, number, self.skip, _planes(steps), _planes(codes), words, _planes(counts))


#: Between lang and word in a key: a byte that UTF-8 never has.
SEAM = b"\xff"
RELATION_1 = pa.schema([
    ("chunk", pa.int64()), ("skip", pa.int32()), ("steps", pa.binary()), ("codes", pa.binary()), ("keys", pa.list_(pa.binary())), ("counts", pa.binary()),
])
RELATION = pa.schema([
    ("chunk", pa.int64()), ("skip", pa.int32()), ("steps", pa.binary()), ("codes", pa.binary()), ("heads", pa.binary()), ("tails", pa.binary()),
    ("counts", pa.binary()),
])
SQL_RELATION_1 = "chunk bigint, skip int, steps binary, codes binary, keys array<binary>, counts binary"
SQL_RELATION = "chunk bigint, skip int, steps binary, codes binary, heads binary, tails binary, counts binary"


def _batch(schema: pa.Schema, *values) -> pa.RecordBatch:
    """One row."""
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array([v], t) for v, t in zip(values, schema.types)], schema=schema)


def _word_hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) >> 32 for k in keys), np.uint64, len(keys))


def _pair_hashes(heads: np.ndarray, tails: np.ndarray) -> np.ndarray:
    return mix(heads.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + tails.astype(np.uint64)) >> np.uint64(32)


def _planes(values: np.ndarray) -> bytes:
    """The lowest bytes of all values, then the next ones, and so on: equal and empty bytes stand together, which the
    compression of files and shuffles makes small."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _from_planes(data, kind=np.int32) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def _packed(ids: np.ndarray) -> bytes:
    """Ids in four bytes each where they fit."""
    return _planes(ids.astype(np.uint32) if not len(ids) or ids.max() < 1 << 32 else ids.astype(np.int64))


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return _from_planes(data, np.uint32 if len(data) == 4 * n else np.int64).astype(np.int64)


def _runs(piece: bytes):
    """The words of a piece, in runs that are bounded however long the piece is."""
    if len(piece) <= STEP:
        yield piece.split()
        return
    at = 0
    while at < len(piece):
        end = piece.find(b" ", at + STEP)
        end = len(piece) if end < 0 else end
        yield piece[at:end].split()
        at = end


def _occurrences(docs: DataFrame, longest: int, size: int) -> DataFrame:
    """The occurrences of single words, sorted by piece and position within chunks."""

    def read(batches):
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        chunk = _Chunk()
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                lang = "und" if lang is None else lang
                for piece in as_bytes(text.as_py()).translate(READ).split(b"\n"):
                    before = []
                    for words in _runs(piece):
                        if len(chunk.codes) >= size:
                            yield chunk.row(number)
                            number, chunk = number + 1, _Chunk()
                            chunk.skip = len(before)
                            chunk.add(lang, before)
                        chunk.add(lang, words)
                        before = (before + words)[-(longest - 1) :]
                    if before:
                        chunk.ends.append(len(chunk.codes))
        if len(chunk.codes) > chunk.skip:
            yield chunk.row(number)

    return docs.select("lang", "text").mapInArrow(read, SQL_RELATION_1)


def _extended(batches, length: int):
    """From the occurrences of phrases of ``length`` words and the ids of the frequent ones, the occurrences of one word
    more: the semi-join drops what is not frequent, then neighbours in the sorted relation are joined where their places
    follow each other. Counts are per chunk."""
    for batch in batches:
        for chunk, skip, steps, codes, found in zip(*(batch.column(c) for c in ("chunk", "skip", "steps", "codes", "found"))):
            codes = _from_planes(codes.as_buffer())
            places = np.cumsum(_from_planes(steps.as_buffer()), dtype=np.int32)
            id_of = np.full(int(codes.max()) + 1, -1, np.int64)
            for part in found.as_py():
                at = _from_planes(part["codes"])
                ids = _unpacked(part["ids"], len(at))
                inside = at < len(id_of)
                id_of[at[inside]] = ids[inside]
            frequent = id_of[codes] >= 0
            codes, places = codes[frequent], places[frequent]
            joined = np.nonzero(places[1:] == places[:-1] + 1)[0]
            if not len(joined):
                continue
            pairs, new = np.unique(codes[joined].astype(np.int64) * len(id_of) + codes[joined + 1], return_inverse=True)
            heads, tails = id_of[pairs // len(id_of)], id_of[pairs % len(id_of)]
            order = np.argsort(_pair_hashes(heads, tails), kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            new, heads, tails, places = rank[new], heads[order], tails[order], places[joined]
            counts = np.bincount(new[places + length >= skip.as_py()], minlength=len(heads)).astype(np.int32)
            steps = np.diff(places, prepend=np.int32(0)).astype(np.int32)
            yield _batch(RELATION, chunk.as_py(), skip.as_py(), _planes(steps), _planes(new), _packed(heads), _packed(tails), _planes(counts))


COUNTED = pa.schema([
    ("kind", pa.int8()), ("chunk", pa.int64()), ("codes", pa.binary()), ("ids", pa.binary()), ("id", pa.int64()), ("lang", pa.string()),
    ("word", pa.string()), ("head", pa.int64()), ("tail", pa.int64()), ("f", pa.int64()),
])
SQL_COUNTED = "kind tinyint, chunk bigint, codes binary, ids binary, id bigint, lang string, word string, head bigint, tail bigint, f bigint"
GROUP, BACK, TOTAL = 0, 1, 2


def _columns(**columns) -> pa.RecordBatch:
    n = max(len(v) for v in columns.values())
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in COUNTED], schema=COUNTED
    )


def _counted_words(rows: list, bucket: int, buckets: int, least: int):
    """Frequent words of a bucket with ids, the codes of each chunk that they have, and the words of every lang."""
    totals: dict[bytes, int] = {}
    for _, _, keys, counts in rows:
        for key, n in zip(keys, counts.tolist()):
            totals[key] = totals.get(key, 0) + n
    langs: dict[bytes, int] = {}
    for key, n in totals.items():
        lang = key.partition(SEAM)[0]
        langs[lang] = langs.get(lang, 0) + n
    frequent = {key: k * buckets + bucket for k, key in enumerate(key for key, n in totals.items() if n >= least)}
    yield _columns(kind=[TOTAL] * len(langs), lang=[x.decode() for x in langs], f=list(langs.values()))
    if frequent:
        parts = [key.partition(SEAM) for key in frequent]
        yield _columns(
            kind=[GROUP] * len(parts), id=list(frequent.values()), lang=[p[0].decode() for p in parts], word=[p[2].decode() for p in parts],
            f=[totals[key] for key in frequent],
        )
    for chunk, base, keys, _ in rows:
        ids = np.array([frequent.get(key, -1) for key in keys], np.int64)
        at = np.nonzero(ids >= 0)[0]
        if len(at):
            yield _columns(kind=[BACK], chunk=[chunk], codes=[_planes((at + base).astype(np.int32))], ids=[_packed(ids[at])])


def _counted_pairs(rows: list, bucket: int, buckets: int, least: int):
    """Frequent pairs of head and tail of a bucket with ids, and the codes of each chunk that they have."""
    heads, tails, counts = (np.concatenate([r[k] for r in rows]) for k in (2, 3, 4))
    order = np.lexsort((tails, heads))
    first = np.ones(len(order), bool)
    first[1:] = (heads[order[1:]] != heads[order[:-1]]) | (tails[order[1:]] != tails[order[:-1]])
    group = np.cumsum(first) - 1
    f = np.bincount(group, counts[order]).astype(np.int64)
    frequent = f >= least
    if not frequent.any():
        return
    id_of = np.where(frequent, (np.cumsum(frequent) - 1) * buckets + bucket, -1)
    at = order[first][frequent]
    yield _columns(kind=np.full(len(at), GROUP), id=id_of[frequent], head=heads[at], tail=tails[at], f=f[frequent])
    ids = np.empty(len(order), np.int64)
    ids[order] = id_of[group]
    start = 0
    for chunk, base, own, *_ in rows:
        mine = ids[start : start + len(own)]
        start += len(own)
        kept = np.nonzero(mine >= 0)[0]
        if len(kept):
            yield _columns(kind=[BACK], chunk=[chunk], codes=[_planes((kept + base).astype(np.int32))], ids=[_packed(mine[kept])])


def _grouped(relation: DataFrame, least: int, folder: str) -> DataFrame:
    """The groups of all chunks counted: rows of kind GROUP (id and f of every frequent one), BACK (for a chunk: which of its
    codes are frequent, and their ids) and, for words, TOTAL (n of a lang).

    The groups of a chunk go, packed by the hash of their key, to buckets, so many that a bucket gets a bounded number
    of groups; a group stands once a chunk, however often it occurs there. Keys are compared whole.
    """
    words = "keys" in relation.columns
    size = F.coalesce(F.sum((F.octet_length("counts") / 4).cast("bigint")), F.lit(0))
    buckets = max(1, -(-relation.agg(size).first()[0] // (WORDS if words else PAIRS)))
    edges = np.array([-(-(k << 32) // buckets) for k in range(1, buckets)], np.uint64)

    def deal(batches):
        for batch in batches:
            chunks, packed = batch.column(0).to_pylist(), batch.column(batch.num_columns - 1)
            for k, chunk in enumerate(chunks):
                counts = _from_planes(packed[k].as_buffer())
                if words:
                    keys = batch.column(1)[k].as_py()
                    cuts = [0, *np.searchsorted(_word_hashes(keys), edges).tolist(), len(counts)]
                else:
                    heads, tails = (_unpacked(batch.column(c)[k].as_py(), len(counts)) for c in (1, 2))
                    cuts = [0, *np.searchsorted(_pair_hashes(heads, tails), edges).tolist(), len(counts)]
                for bucket, (start, end) in enumerate(zip(cuts, cuts[1:])):
                    if start == end:
                        continue
                    own = [[keys[start:end]]] if words else [[_packed(heads[start:end])], [_packed(tails[start:end])]]
                    kinds = [pa.list_(pa.binary())] if words else [pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([bucket], pa.int32()), pa.array([chunk]), pa.array([start], pa.int32()),
                            *[pa.array(c, t) for c, t in zip(own, kinds)], pa.array([_planes(counts[start:end])], pa.binary()),
                        ],
                        ["bucket", "chunk", "base", *(["keys"] if words else ["heads", "tails"]), "counts"],
                    )

    def count(batches):
        work = _counted_words if words else _counted_pairs
        bucket, rows = None, []
        for batch in batches:
            for now, chunk, base, *own, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if now != bucket:
                    if rows:
                        yield from work(rows, bucket, buckets, least)
                    bucket, rows = now, []
                counts = _from_planes(counts)
                rows.append((chunk, base, *(own if words else (_unpacked(x, len(counts)) for x in own)), counts))
        if rows:
            yield from work(rows, bucket, buckets, least)

    keys, types = (["keys"], "keys array<binary>") if words else (["heads", "tails"], "heads binary, tails binary")
    dealt = relation.select("chunk", *keys, "counts").mapInArrow(deal, f"bucket int, chunk bigint, base int, {types}, counts binary")
    tasks = min(buckets, 4 * shuffle_tasks(relation.sparkSession))
    dealt = dealt.repartitionById(tasks, F.col("bucket") % tasks).sortWithinPartitions("bucket", "chunk")
    return written(dealt.mapInArrow(count, SQL_COUNTED), "groups", folder)


def frequent_phrases(docs: DataFrame, least: int, longest: int, folder: str, size: int = CHUNK) -> tuple[list[DataFrame], DataFrame]:
    """By length: id, lang, words, f, heads and tails (f of the first, and last, 1, 2, .. words), head and tail (ids of the
    phrases without the last, and first, word). Beside them lang, n: all word occurrences.

    The relation of a length is stored sorted by piece and place. It is extended by a merge-join with itself where two
    frequent phrases overlap but for a word, grouped and counted (chunks bring counts, which are added up), and
    reduced to the frequent groups before the next length. Groups are keyed by words and ids, not by hashes, so counts
    are exact. A relation and its groups are removed when the next relation is stored.
    """
    none = F.lit(None).cast("bigint")
    with ExitStack() as held:
        here = held.enter_context(stage_folder(docs.sparkSession))
        relation = written(_occurrences(docs, longest, size), "occurrences", here)
        groups = _grouped(relation, least, here)
        totals = written(groups.filter(F.col("kind") == TOTAL).groupBy("lang").agg(F.sum("f").alias("n")), "totals", folder)
        frequent = groups.filter(F.col("kind") == GROUP)
        levels = [written(
            frequent.select("id", "lang", F.array("word").alias("words"), "f", F.array("f").alias("heads"), F.array("f").alias("tails"), none.alias("head"), none.alias("tail")),
            "phrases", folder,
        )]
        for length in range(1, longest):
            found = groups.filter(F.col("kind") == BACK).groupBy("chunk").agg(F.collect_list(F.struct("codes", "ids")).alias("found"))
            met = relation.select("chunk", "skip", "steps", "codes").join(found, "chunk")
            before = held.pop_all()
            here = held.enter_context(stage_folder(docs.sparkSession))
            with before:
                relation = written(met.mapInArrow(lambda batches, n=length: _extended(batches, n), SQL_RELATION), "occurrences", here)
            groups = _grouped(relation, least, here)
            counted = groups.filter(F.col("kind") == GROUP).select("id", "head", "tail", "f")
            last = levels[-1]
            head = last.select(F.col("id").alias("head"), "lang", F.col("words").alias("first"), "heads")
            tail = last.select(F.col("id").alias("tail"), F.element_at("words", -1).alias("last"), "tails")
            levels.append(written(
                counted.join(head, "head").join(tail, "tail").select(
                    "id", "lang", F.concat("first", F.array("last")).alias("words"), "f", F.concat("heads", F.array("f")).alias("heads"),
                    F.concat("tails", F.array("f")).alias("tails"), "head", "tail",
                ), "phrases", folder,
            ))
    return levels, totals


def phrase_collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, scale: int = 1000, percent: int = 100, top: int = 2000, size: int = CHUNK
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each lang's first ``top`` collocations.

    ``docs`` has text and lang; other columns are not read. Texts are lower-cased (A-Z) and split at .,;:!? and line ends
    into pieces, these at blanks and tabs into words. A candidate is a phrase of 2 to ``longest`` words found ``least``
    times (a) within pieces, overlaps included. A cut has counts l and r of its two parts and the score
    floor(scale * a * n / (l * r)), n being all words of the lang; the lowest cut counts, the first of equal ones.
    A candidate goes if a longer one holds it and has at least ``percent`` of its count: as counts only fall
    with length, it is enough to look one word further. Order: score, then a, both falling, then the phrase by its bytes.

    Products are decimals of 38 digits. Null lang is 'und', null text empty; texts without words add nothing; repeated
    rows count each. A piece of any length is read in runs, with the words before a run at hand. Langs without
    candidates, and an empty table, give no rows.
    """
    with stage_folder(docs.sparkSession) as folder:
        levels, totals = frequent_phrases(docs, least, longest, folder, size)
        parts = []
        for words, level in enumerate(levels[1:], 2):
            if words < longest:
                longer = levels[words]
                held = longer.select(F.col("head").alias("id"), F.col("f").alias("over")).unionAll(longer.select(F.col("tail").alias("id"), F.col("f").alias("over")))
                held = held.groupBy("id").agg(F.max("over").alias("over"))
                level = level.join(held, "id", "left").filter(F.col("over").isNull() | (F.lit(100) * F.col("over") < F.lit(percent) * F.col("f")))
            parts.append(level.select("lang", "words", "f", "heads", "tails"))
        found = parts[0]
        for part in parts[1:]:
            found = found.unionAll(part)
        wide = "decimal(38,0)"
        scored = F.expr(
            f"array_min(transform(sequence(1, size(words) - 1), k -> struct((cast({scale} as decimal(10,0)) * cast(f as {wide}) * cast(n as {wide})) div "
            f"(cast(element_at(heads, k) as {wide}) * cast(element_at(tails, size(words) - k) as {wide})) as score, k as k, "
            "element_at(heads, k) as l, element_at(tails, size(words) - k) as r)))"
        )
        found = found.join(F.broadcast(totals) if totals.count() <= LANGS else totals, "lang").withColumn("best", scored)
        found = found.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "best.l", "best.r", "n", "best.score")
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        return written(ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "collocations")


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM p),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS x0 FROM w),
o AS (
  SELECT lang, m, array_to_string(list_slice(ws, x0, x0 + m - 1), ' ') AS phrase
  FROM i, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE x0 + m - 1 <= len(ws)
),
f AS (SELECT lang, m, phrase, count(*) AS a FROM o GROUP BY ALL),
t AS (SELECT lang, sum(a) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND a >= 100),
cut AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, l.a AS l, r.a AS r, t.n,
    (1000::HUGEINT * c.a::HUGEINT * t.n::HUGEINT) // (l.a::HUGEINT * r.a::HUGEINT) AS score
  FROM cut c JOIN t USING (lang)
  JOIN f l ON l.lang = c.lang AND l.m = c.k AND l.phrase = array_to_string(list_slice(c.ws, 1, c.k), ' ')
  JOIN f r ON r.lang = c.lang AND r.m = c.m - c.k AND r.phrase = array_to_string(list_slice(c.ws, c.k + 1, c.m), ' ')
),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM s),
sub AS (
  SELECT d.lang, array_to_string(list_slice(d.ws, x, x + y - 1), ' ') AS phrase, max(d.a) AS most
  FROM c d, (SELECT unnest([1, 2, 3, 4]) AS x), (SELECT unnest([2, 3, 4]) AS y)
  WHERE x + y - 1 <= d.m AND y < d.m GROUP BY ALL
),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN sub ON sub.lang = b.lang AND sub.phrase = b.phrase
  WHERE b.pick = 1 AND NOT coalesce(100 * sub.most >= 100 * b.a, false)
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""


@query("op12_phrase_collocations", SQL)
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_collocations(table(spark, sf_dir, "documents"))
