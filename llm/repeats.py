"""Removal of repeated byte strings by interval expansion on Burrows-Wheeler transforms of bounded blocks.

The question is which 100-byte strings of the corpus also start earlier. Equal strings hold the same 24-byte gram of
least hash at the same place, so grams of least hash ("anchors") bring them together:

1. Every text gives its anchors with a hash of their surroundings, all bytes that a string with the anchor can
   cover. An anchor whose surroundings occur earlier is settled: all its strings are repeats. One whose gram occurs in no
   other surroundings is settled too. What is left are the edges of repeated passages.
2. Around those the text is cut out. Anchors that lie close together anywhere share a leader, and leaders are packed into
   blocks by counted anchors, so neighbouring cuts are one. A leader of more than a block is split by anchor. An anchor
   in very many surroundings leads no other and is resolved string by string.
3. In a block the suffixes are sorted, and common prefixes come from the Burrows-Wheeler transform by breadth-first
   backward extension: intervals of strings of length l give those of length l + 1, and a boundary that is new then
   has a common prefix of l. At 100 the expansion stops; boundaries not met by then part no equal strings.
4. Ranges from all steps are joined by document.

No step needs a whole document group, passage or corpus in one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import as_bytes, small_batches, table, written
from llm.registry import query

MIN_BYTES, GRAM = 100, 24
REACH = MIN_BYTES - GRAM
#: An anchor in more different surroundings than this is resolved string by string.
HOT = 4096
#: Distinct surroundings of an anchor in one batch from which its rows are dealt over SALTS partitions.
HOT_IN_BATCH, SALTS = 64, 64
#: Anchors cut out for one block, on average: about 0.6 MB of text. No block has more than 2 * BLOCK + HOT.
BLOCK = 8192

_BASE = 0x9E3779B97F4A7C15


# --- anchors -------------------------------------------------------------------------------------------------------


def window_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` bytes, by doubling."""
    def power(k):
        return np.uint64(pow(_BASE, k, 2**64))

    part = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    part ^= part >> np.uint64(31)
    part *= np.uint64(0xBF58476D1CE4E5B9)
    out, have, size = None, 0, 1
    count = len(data) - n + 1
    while True:
        if n & size:
            out = part[:count] if out is None else out * power(size) + part[have : have + count]
            have += size
        if have == n:
            break
        part = part[:-size] * power(size) + part[size:]
        size *= 2
    out = out ^ (out >> np.uint64(33))
    out = out * np.uint64(0xFF51AFD7ED558CCD)
    return out ^ (out >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    out, size = values, 1
    while size * 2 <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    return pick(out[: len(out) - (width - size)], out[width - size :]) if width > size else out


def anchors(grams: np.ndarray) -> np.ndarray:
    """Places of the grams that are the least of some string of MIN_BYTES."""
    width = REACH + 1
    least = _sliding(grams, width, np.minimum)
    around = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    around[width - 1 : width - 1 + len(least)] = least
    return np.nonzero(grams == _sliding(around, width, np.maximum))[0]


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges sorted by start as maximal runs."""
    if not len(start):
        return start, end
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], reach[np.concatenate([new[1:], [True]])]


ROWS = "kind tinyint, key bigint, ctx bigint, doc bigint, pos bigint"
_NAMES = ["kind", "key", "ctx", "doc", "pos"]


def _rows(kind, key, ctx, doc, pos):
    columns = [np.full(len(key), kind, np.int8) if np.isscalar(kind) else kind, key, ctx, doc, pos]
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], _NAMES)


def settle(key, ctx, doc, pos, left: int, right: int, salt: bool):
    """One batch's occurrences of (key, ctx): the first of each goes on (kind 0, or 2 if its key is frequent here), the
    others' ranges are known to be repeats (kind 1: ctx is the end, pos the start; the key only deals them out)."""
    order = np.lexsort((pos, doc, ctx, key))
    key, ctx, doc, pos = key[order], ctx[order], doc[order], pos[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])
    group = np.cumsum(first) - 1
    heads = np.nonzero(first)[0]
    again = ~first & ((doc != doc[heads[group]]) | (pos != pos[heads[group]]))
    if again.any():
        d, a = doc[again], pos[again]
        by = np.lexsort((a, d))
        d, a = d[by], a[by]
        for one in _per_doc(d, np.maximum(a - left, 0), a + right):
            yield one
    key, ctx, doc, pos = key[first], ctx[first], doc[first], pos[first]
    kind = np.zeros(len(key), np.int8)
    if salt and len(key):
        starts = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
        size = np.diff(np.append(starts, len(key)))
        frequent = np.repeat(size >= HOT_IN_BATCH, size)
        kind[frequent] = 2
        witness = np.concatenate([starts[size >= HOT_IN_BATCH], starts[size >= HOT_IN_BATCH] + 1])
        if len(witness):  # other batches must see that the key has several surroundings
            yield _rows(0, key[witness], ctx[witness], doc[witness], pos[witness])
    if len(key):
        yield _rows(kind, key, ctx, doc, pos)


def _per_doc(doc, start, end):
    """Ranges (sorted by doc, start) as rows of kind 1, joined where they touch."""
    reach = end.copy()
    new = np.concatenate([[True], doc[1:] != doc[:-1]])
    # Ranges of one document grow to the right with their start, so a running comparison with the one before is enough.
    new[1:] |= start[1:] > reach[:-1]
    a, b, d = start[new], reach[np.concatenate([new[1:], [True]])], doc[new]
    if len(d):
        yield _rows(1, d * np.int64(1_000_003), b, d, a)


def _stream(left: int, right: int, candidates: bool):
    """Over rows sorted by key, ctx, doc, pos: later occurrences become ranges (kind 1); first ones of a key with
    several surroundings stay (kind 0). Holds a batch and one row."""

    def run(batches):
        last = None  # (key, ctx, doc, pos of the first with that ctx, surroundings of the key so far, held row or None)
        for batch in batches:
            kind, key, ctx, doc, pos = (c.to_numpy() for c in batch.columns)
            known = kind == 1
            if known.any():
                yield batch.filter(pa.array(known))
                kind, key, ctx, doc, pos = (x[~known] for x in (kind, key, ctx, doc, pos))
            if not len(key):
                continue
            same_key = np.concatenate([[last is not None and key[0] == last[0]], key[1:] == key[:-1]])
            same = same_key & np.concatenate([[last is not None and ctx[0] == last[1]], ctx[1:] == ctx[:-1]])
            first = ~same
            head = np.maximum.accumulate(np.where(first, np.arange(len(key)), -1))
            head_doc = np.where(head >= 0, doc[head], last[2] if last else 0)
            head_pos = np.where(head >= 0, pos[head], last[3] if last else 0)
            again = same & ((doc != head_doc) | (pos != head_pos))
            if again.any():
                d, a = doc[again], pos[again]
                by = np.lexsort((a, d))
                yield from _per_doc(d[by], np.maximum(a[by] - left, 0), a[by] + right)
            runs = np.cumsum(~same_key)  # run 0 goes on from the batch before
            count = np.bincount(runs, weights=first, minlength=runs[-1] + 1).astype(np.int64)
            hot = np.bincount(runs, weights=kind == 2, minlength=runs[-1] + 1) > 0
            if last is not None:
                count[0] += last[4]
            if candidates:
                several = (count >= 2) | hot
                out = first & several[runs]
                if last is not None and last[5] is not None and several[0] and count[0] > last[4]:
                    yield _rows(0, *last[5])
                if out.any():
                    yield _rows(0, key[out], ctx[out], doc[out], pos[out])
            end = runs[-1]
            held = None
            if count[end] == 1 and not hot[end]:
                at = np.nonzero(first & (runs == end))[0]
                held = (key[at], ctx[at], doc[at], pos[at]) if len(at) else (last[5] if last else None)
            last = (key[-1], ctx[-1], head_doc[-1], head_pos[-1], int(count[end]) if not hot[end] else max(2, int(count[end])), held)

    return run


def _dealt(rows: DataFrame, run) -> DataFrame:
    part = F.when(F.col("kind") == 2, F.xxhash64("key", F.pmod(F.col("ctx"), F.lit(SALTS)))).otherwise(F.col("key"))
    return rows.repartition(part).sortWithinPartitions("key", "ctx", "doc", "pos").mapInArrow(run, ROWS)


def _anchor_rows(batches):
    for batch in batches:
        for piece in small_batches(batch, 2000):
            keys, ctxs, docs, places = [], [], [], []
            for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                data = as_bytes(text)
                if len(data) < MIN_BYTES or doc_id is None:
                    continue
                grams = window_hashes(np.frombuffer(data, np.uint8), GRAM)
                at = anchors(grams)
                keys.append(grams[at].view(np.int64))
                spans = [(max(0, p - REACH), p) for p in at.tolist()]
                digest = xxhash.xxh3_64_intdigest
                ctxs.append(np.array([digest(data[a : p + MIN_BYTES], p - a) for a, p in spans], np.uint64).view(np.int64))
                docs.append(np.full(len(at), doc_id, np.int64))
                places.append(at.astype(np.int64))
            if keys:
                yield from settle(*(np.concatenate(x) for x in (keys, ctxs, docs, places)), REACH, MIN_BYTES, True)


# --- blocks --------------------------------------------------------------------------------------------------------

_SEPARATOR = b"\xff"  # no byte of UTF-8


def sorted_suffixes(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of at least their first ``depth`` bytes, and the common prefix with the one before where that is
    shorter than 8 (else -1)."""
    n = len(data)
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = data
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | wide[k : n + k]
    order = np.argsort(word)
    ordered = word[order]
    differ = ordered[1:] ^ ordered[:-1]
    common = np.full(n + 1, -1, np.int16)
    for k in range(8):
        common[1:n][(common[1:n] < 0) & ((differ >> np.uint64(56 - 8 * k)) != 0)] = k
    common[0] = common[n] = 0
    rank = np.empty(n, np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(differ != 0)])
    have = 8
    while have < depth and rank.max() < n - 1:
        key = rank * np.int64(n + 1)
        key[: n - have] += rank[have:] + 1
        order = np.argsort(key)
        ordered = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        have *= 2
    return order, common


def classes_of_equal(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the class of each: suffixes of a class share their first ``length`` bytes.

    Breadth-first backward extension. ``last`` maps a place in the order to the place of the suffix one byte longer;
    that byte is the Burrows-Wheeler transform. Strings of length l are intervals; the queue holds those whose right
    boundary was found to have a common prefix of l - 1. Their extensions by a byte are again intervals, and a right
    boundary of those that is not known yet has a common prefix of l.
    """
    n = len(data)
    order, common = sorted_suffixes(data, length)
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    before = np.where(order > 0, inverse[order - 1], -1)
    head = np.append(data[order], 0)
    bounds = np.nonzero(common >= 0)[0]  # between strings of length 8
    right = bounds[1:][common[bounds[1:]] == 7]
    low = bounds[np.searchsorted(bounds, right) - 1]
    owner = np.full(n + 2, -1, np.int64)  # shifted by one
    for level in range(8, length):
        if not len(low):
            break
        size = right - low
        which = np.repeat(np.arange(len(low)), size)
        at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]
        longer = before[at]
        use = longer >= 0
        longer, which = longer[use], which[use]
        owner[longer + 1] = which
        starts = longer[(owner[longer] != which) | (head[longer - 1] != head[longer])]
        ends = longer[(owner[longer + 2] != which) | (head[longer + 1] != head[longer])]
        owner[longer + 1] = -1
        starts, ends = np.sort(starts), np.sort(ends) + 1
        new = common[ends] < 0
        common[ends[new]] = level
        low, right = starts[new], ends[new]
    return order, np.cumsum(common[:n] >= 0) - 1


def repeats_in(segments: list[tuple[int, int, bytes]], length: int = MIN_BYTES):
    """(doc, start, end) of ranges covered by strings that also start in an earlier segment, or earlier in the same.
    Segments are (doc, start, bytes), sorted."""
    data = np.frombuffer(_SEPARATOR.join(s[2] for s in segments) + _SEPARATOR, np.uint8)
    sizes = np.array([len(s[2]) for s in segments], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    order, group = classes_of_equal(data, length)
    first = np.minimum.reduceat(order, np.nonzero(np.concatenate([[True], group[1:] != group[:-1]]))[0])
    repeated = np.sort(order[order != first[group]])
    inside = np.searchsorted(starts, repeated, "right") - 1
    fits = repeated + length <= starts[inside] + sizes[inside]
    repeated, inside = repeated[fits], inside[fits]
    if not len(repeated):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.concatenate([[True], (inside[1:] != inside[:-1]) | (repeated[1:] > repeated[:-1] + length)])
    ends = np.concatenate([new[1:], [True]])
    shift = np.array([s[1] for s in segments], np.int64) - starts
    doc = np.array([s[0] for s in segments], np.int64)[inside[new]]
    return doc, repeated[new] + shift[inside[new]], repeated[ends] + shift[inside[ends]] + length


# --- the whole -----------------------------------------------------------------------------------------------------


def blocks_of(edges: DataFrame) -> DataFrame:
    """key, block for every key of ``edges`` (doc, pos, key): -1 for a key with more than HOT edges.

    Any dealing of keys gives the same repeats, since equal strings share the key. Leaders only save cuts, so they are
    dropped where they would gather more than BLOCK edges; a key alone has at most HOT. Leaders are dealt over as many
    bins as there are full blocks, and a running sum parts each bin.
    """
    counts = written(edges.groupBy("key").agg(F.count("*").alias("n")), "keys")
    hot = counts.filter(F.col("n") > HOT).select("key")
    near = Window.partitionBy("doc").orderBy("pos").rangeBetween(-MIN_BYTES, MIN_BYTES)
    cold = edges.join(hot, "key", "left_anti").withColumn("least", F.min("key").over(near))
    led = written(cold.groupBy("key").agg(F.min("least").alias("leader"), F.count("*").alias("n")), "leaders")
    size = led.groupBy("leader").agg(F.sum("n").alias("size"))
    lead = F.when(F.col("size") > BLOCK, F.col("key")).otherwise(F.col("leader"))
    led = written(led.join(size, "leader").select("key", "n", lead.alias("leader")), "leaders")
    bins = max(1, -(-(led.agg(F.sum("n")).first()[0] or 0) // BLOCK))
    groups = led.groupBy("leader").agg(F.sum("n").alias("size")).withColumn("bin", F.pmod(F.xxhash64("leader"), F.lit(bins)))
    before = F.sum("size").over(Window.partitionBy("bin").orderBy("leader")) - F.col("size")
    blocks = groups.select("leader", (F.col("bin") * (1 << 20) + F.floor(before / BLOCK)).alias("block"))
    return led.join(blocks, "leader").select("key", "block").unionAll(hot.select("key", F.lit(-1).cast("bigint").alias("block")))


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """doc, start, end: ranges of bytes covered by strings that also start earlier. Ranges may overlap."""
    found = written(_dealt(docs.mapInArrow(_anchor_rows, ROWS), _stream(REACH, MIN_BYTES, True)), "anchors")
    ranges = found.filter("kind = 1").select("doc", F.col("pos").alias("start"), F.col("ctx").alias("end"))
    edges = found.filter("kind = 0").select("doc", "pos", "key").distinct()
    if edges.isEmpty():
        return ranges
    per_doc = (
        edges.join(blocks_of(edges), "key").select("doc", F.struct("pos", "block").alias("edge"))
        .groupBy("doc").agg(F.collect_list("edge").alias("edges"))  # bounded by the text's length
    )
    cut_schema = "block bigint, doc bigint, start bigint, data binary"

    def cut(batches):
        for batch in batches:
            rows = []
            for doc, text, edges in zip(*(c.to_pylist() for c in batch.columns)):
                data, by = as_bytes(text), {}
                for edge in edges:
                    by.setdefault(edge["block"], []).append(edge["pos"])
                for number, places in by.items():
                    at = np.array(sorted(places), np.int64)
                    a, b = merged(np.maximum(at - REACH, 0), np.minimum(at + MIN_BYTES, len(data)))
                    rows += [(number, doc, s, data[s:e]) for s, e in zip(a.tolist(), b.tolist())]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["block", "doc", "start", "data"])

    pieces = written(docs.join(per_doc, F.col("doc_id") == F.col("doc")).select("doc", "text", "edges").mapInArrow(cut, cut_schema), "pieces")

    def expand(batches):
        def work(segments):
            doc, start, end = repeats_in(segments)
            return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(end)], ["doc", "start", "end"])

        name, held = None, []
        for batch in batches:
            for number, doc, start, data in zip(*(c.to_pylist() for c in batch.columns)):
                if number != name:
                    if held:
                        yield work(held)
                    name, held = number, []
                held.append((doc, start, data))
        if held:
            yield work(held)

    in_blocks = pieces.filter("block >= 0").repartition("block").sortWithinPartitions("block", "doc", "start")
    ranges = ranges.unionAll(in_blocks.mapInArrow(expand, "doc bigint, start bigint, end bigint"))

    def strings(batches):
        for batch in batches:
            for piece in small_batches(batch, 4000):
                keys, ctxs, docs_, places = [], [], [], []
                for _, doc, start, data in zip(*(c.to_pylist() for c in piece.columns)):
                    b = np.frombuffer(data, np.uint8)
                    one = window_hashes(b, MIN_BYTES)
                    keys.append(one.view(np.int64))
                    ctxs.append(window_hashes(b[::-1], MIN_BYTES)[::-1].view(np.int64))  # 128 bits in all
                    docs_.append(np.full(len(one), doc, np.int64))
                    places.append(np.arange(start, start + len(one), dtype=np.int64))
                if keys:
                    yield from settle(*(np.ascontiguousarray(np.concatenate(x)) for x in (keys, ctxs, docs_, places)), 0, MIN_BYTES, False)

    hot = _dealt(pieces.filter("block < 0").mapInArrow(strings, ROWS), _stream(0, MIN_BYTES, False))
    return ranges.unionAll(hot.filter("kind = 1").select("doc", F.col("pos").alias("start"), F.col("ctx").alias("end")))


def remove_repeats(docs: DataFrame, with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end; and the kept bytes) for every row.

    A byte goes if a 100-byte string that covers it also starts earlier: in a smaller doc_id or earlier in the same text,
    overlaps included, judged on the input. Texts are UTF-8; null is empty. Rows with a null doc_id are not judged and
    serve no other. Equal rows are one document. Rows that share a doc_id but not the text have no order between them:
    they stay whole as well. An empty table gives no rows. Other columns are not read.
    """
    own = docs.select("doc_id", "text")
    text = F.xxhash64("text")
    unclear = written(own.groupBy("doc_id").agg(F.min(text).alias("a"), F.max(text).alias("b")).filter("a <> b AND doc_id IS NOT NULL").select("doc_id"), "unclear")
    judged = own if unclear.isEmpty() else own.join(unclear, "doc_id", "left_anti").select("doc_id", "text")
    per_doc = repeated_ranges(judged).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>" + ", kept binary" * with_kept

    def apply(batches):
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"] + ["kept"] * with_kept
        kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        for batch in batches:
            rows = []
            for doc_id, text, ranges in zip(*(c.to_pylist() for c in batch.columns)):
                data = as_bytes(text)
                pairs = np.array(sorted((r["start"], r["end"]) for r in ranges or ()), np.int64).reshape(-1, 2)
                a, b = (x.tolist() for x in merged(pairs[:, 0], np.minimum(pairs[:, 1], len(data))))
                edges = [0, *(e for ab in zip(a, b) for e in ab), len(data)]
                kept = b"".join(data[s:e] for s, e in zip(edges[::2], edges[1::2])) if a else data
                spans = [{"start": s, "end": e} for s, e in zip(a, b)]
                rows.append((doc_id, len(data), len(data) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), spans, kept)[: len(names)])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    met = own.join(per_doc, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "text", "ranges")
    return met.mapInArrow(apply, schema)


@query("op2_repeated_strings")
def op2_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
