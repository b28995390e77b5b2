"""Documents that met in a signature: from signatures to links, without making all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import mix, small_batches, written
from llm.components import connected_components, extended_components

#: Rows of one centre that are verified in one task.
UNIT = 2_000
#: Members of a block of a large meeting, and values in their sets.
BLOCK, BLOCK_VALUES = 400, 1_000_000
#: Pairs a member of two blocks that are compared one by one, however many meetings they have in common. Of more, the
#: blocks are.
FEW = 4
#: Roles of a document in a signature: found there, looking there, or both.
INDEX, PROBE, BOTH = 1, 2, 3


MET = "run bigint, centre bigint, doc bigint, role tinyint, spare int, size int, times int"


def meetings(signed: DataFrame) -> DataFrame:
    """Who met in a signature: from (sig bigint, doc bigint, role tinyint, spare int) to rows of three kinds.

    * Two that met alone: run 0, centre, doc.
    * A member of a larger meeting: run, doc, role, spare, size. ``run`` names the set of members, so that equal sets
      from many signatures are one meeting.
    * How often a task saw the meeting: run, times (doc is null).

    A signature nobody looks up says nothing. Rows stream through in the order of their signatures; a signature with
    very many rows is passed on as it comes.
    """
    ordered = signed.repartition("sig").sortWithinPartitions("sig", F.desc("role"), "doc")
    names = [part.split()[0] for part in MET.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int8(), pa.int32(), pa.int32(), pa.int32()]

    def out(n, **columns):
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds)], names
        )

    def members(run, doc, role, spare, size):
        n = len(doc)
        return out(n, run=np.full(n, run), doc=doc, role=role, spare=spare, size=np.full(n, size, np.int32))

    def meet(batches):
        known, rest = {}, None
        large = None  # (signature, run) of a meeting that is being passed on as it comes

        def counts():
            if known:
                yield out(len(known), run=np.array(list(known), np.int64), times=np.array(list(known.values()), np.int32))
                known.clear()

        def handle(sig, doc, role, spare):
            starts = np.concatenate([[0], np.nonzero(sig[1:] != sig[:-1])[0] + 1])
            size = np.diff(np.append(starts, len(sig)))
            useful = (size > 1) & (role[starts] > INDEX)  # queries come first in a run
            starts, size = starts[useful], size[useful]
            two = starts[size == 2]
            two = two[doc[two] != doc[two + 1]]
            if len(two):
                a, b = np.minimum(doc[two], doc[two + 1]), np.maximum(doc[two], doc[two + 1])
                pairs = np.unique(np.stack([a, b], 1), axis=0)
                yield out(len(pairs), run=np.zeros(len(pairs), np.int64), centre=pairs[:, 0], doc=pairs[:, 1])
            if len(known) > 500_000:
                yield from counts()
            more = size > 2
            starts, ends = starts[more], starts[more] + size[more]
            # The name is a sum over the members, so that it can be made for all meetings of a batch at once.
            weight = np.concatenate([[np.uint64(0)], np.cumsum(mix(doc.astype(np.uint64) * np.uint64(8) + role.astype(np.uint64)))])
            run_names = ((weight[ends] - weight[starts]) >> np.uint64(1)).tolist()
            for name, s, e in zip(run_names, starts.tolist(), ends.tolist()):
                name = name or 1
                if name in known:
                    known[name] += 1
                    continue
                known[name] = 1
                yield members(name, doc[s:e], role[s:e], spare[s:e], e - s)

        def gathered(batches_):
            held, n = [], 0
            for batch in batches_:
                held.append(batch)
                n += batch.num_rows
                if n > 20_000:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, n = [], 0
            if held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(k).to_numpy() for k in range(4)]
            if large is not None:
                n = int(np.searchsorted(now[0], large[0], "right"))
                if n:
                    yield members(large[1], *(x[:n] for x in now[1:]), 2**31 - 1)
                now = [x[n:] for x in now]
                if not len(now[0]):
                    continue
                yield out(1, run=np.array([large[1]]), times=np.array([1], np.int32))
                large = None
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            last = int(np.searchsorted(now[0], now[0][-1], "left"))
            if last:
                yield from gathered(handle(*(x[:last] for x in now)))
            rest = [x[last:] for x in now]
            if rest[2][0] == INDEX:  # nobody asks for this signature
                rest = [x[:1] for x in rest]
            elif len(rest[0]) > 100_000:
                large = int(rest[0][0]), (int(rest[0][0]) & (2**62 - 1)) | 1
                yield members(large[1], *rest[1:], 2**31 - 1)
                rest = None
        if large is not None:
            yield out(1, run=np.array([large[1]]), times=np.array([1], np.int32))
        if rest is not None and len(rest[0]):
            yield from gathered(handle(*rest))
        yield from counts()

    return written(ordered.mapInArrow(meet, MET), "meetings")


def runs_of(met: DataFrame) -> DataFrame:
    """run, a (centre), b, asks: what must be compared, from ``meetings``.

    A document that looked up more signatures than it must leaves out its largest meetings, as many as it can spare:
    whoever it is linked to meets it in one of the others. Those who are left with nobody asking are not a meeting.
    ``asks`` says that b, or the centre, still looks this signature up.
    """
    pairs = met.filter("run = 0").select("run", F.col("centre").alias("a"), F.col("doc").alias("b")).distinct()
    times = met.filter("doc IS NULL").groupBy("run").agg(F.sum("times").alias("times"))
    rows = met.filter("run <> 0 AND doc IS NOT NULL").groupBy("run", "doc", "role").agg(F.max("spare").alias("spare"), F.max("size").alias("size"))
    # Per document: bounded by its own number of signatures.
    largest = Window.partitionBy("doc", "role").orderBy(F.desc("size"), "run")
    used = F.sum("times").over(largest.rowsBetween(Window.unboundedPreceding, 0))
    asking = rows.filter(F.col("role") > INDEX).join(times, "run").withColumn("used", used)
    kept = rows.join(
        asking.filter(F.col("used") > F.col("spare")).select("run", "doc", "role", F.lit(True).alias("asks")), ["run", "doc", "role"], "left"
    ).groupBy("run", "doc").agg(F.max(F.coalesce("asks", F.lit(False))).alias("asks"))
    kept = written(kept, "members")
    centres = kept.filter("asks").groupBy("run").agg(F.min("doc").alias("a"))
    met_there = kept.join(centres, "run").filter("a <> doc").select("run", "a", F.col("doc").alias("b"), "asks")
    return pairs.withColumn("asks", F.lit(True)).unionByName(met_there)


def packed(sigs: np.ndarray, docs: np.ndarray, buckets: int) -> list[tuple[int, bytes, bytes]]:
    """(bucket, sigs, docs) of the buckets that signatures (uint64) and their documents (int64) fall into."""
    bucket = ((sigs >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, sigs, docs = bucket[order], sigs[order], docs[order]
    edges = np.concatenate([[0], np.nonzero(np.diff(bucket))[0] + 1, [len(bucket)]]).tolist()
    return [(int(bucket[s]), sigs[s:e].tobytes(), docs[s:e].tobytes()) for s, e in zip(edges, edges[1:]) if s < e]


def packed_runs(rows: DataFrame, held: int = 2_000_000, large: int = 100_000) -> DataFrame:
    """run, a (centre), b, asks as from ``runs_of``, where everyone asks for all signatures and these come ``packed``:
    bucket int, sigs binary, docs binary. Most signatures have one document, and sorting those in a task as numbers
    costs far less than a row for each of them.

    A task holds one bucket. In one of more than ``held`` entries, signatures of more than ``large`` documents are
    passed on as they come.
    """
    ordered = rows.select("bucket", "sigs", "docs").repartition("bucket").sortWithinPartitions("bucket")

    def found(run, a, b):
        columns = [pa.array(x, pa.int64()) for x in (run, a, b)]
        return pa.RecordBatch.from_arrays(columns, ["run", "a", "b"])

    def meet(batches):
        seen = set()
        bucket, sigs, docs, n, most, hot = None, [], [], 0, held, {}

        def gathered():
            """The held entries in order, each once; of signatures known to be large they are passed on."""
            sig, doc = np.concatenate(sigs), np.concatenate(docs)
            order = np.lexsort((doc, sig))
            sig, doc = sig[order], doc[order]
            keep = np.concatenate([[True], (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])])
            sig, doc = sig[keep], doc[keep]
            out = []
            for s, (run, centre) in hot.items():
                at, to = np.searchsorted(sig, np.uint64(s)), np.searchsorted(sig, np.uint64(s), "right")
                others = doc[at:to][doc[at:to] != centre]
                if len(others):
                    out.append(found(np.full(len(others), run), np.full(len(others), centre), others))
                sig, doc = np.delete(sig, slice(at, to)), np.delete(doc, slice(at, to))
            return sig, doc, out

        def meetings_of(sig, doc):
            starts = np.concatenate([[0], np.nonzero(sig[1:] != sig[:-1])[0] + 1])
            size = np.diff(np.append(starts, len(sig)))
            two = starts[size == 2]
            if len(two):
                pairs = np.unique(np.stack([doc[two], doc[two + 1]], 1), axis=0)
                yield found(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
            starts, size = starts[size > 2], size[size > 2]
            # The name of a meeting is a sum over its members, so equal sets from many signatures are one.
            weight = np.concatenate([[np.uint64(0)], np.cumsum(mix(doc.astype(np.uint64) * np.uint64(8) + np.uint64(BOTH)))])
            names = np.maximum((weight[starts + size] - weight[starts]) >> np.uint64(1), np.uint64(1)).astype(np.int64)
            if len(seen) > 500_000:
                seen.clear()
            new = np.unique(names, return_index=True)[1]
            new = new[[name not in seen for name in names[new].tolist()]] if len(new) else new
            if len(new):
                seen.update(names[new].tolist())
                many = size[new] - 1
                at = np.repeat(starts[new] + 1 - (np.cumsum(many) - many), many) + np.arange(many.sum())
                yield found(np.repeat(names[new], many), np.repeat(doc[starts[new]], many), doc[at])

        def ended():
            if sigs:
                sig, doc, out = gathered()
                yield from out
                if len(sig):
                    yield from meetings_of(sig, doc)

        for batch in batches:
            for k, s, d in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if k != bucket:
                    yield from ended()
                    bucket, sigs, docs, n, most, hot = k, [], [], 0, held, {}
                sigs.append(np.frombuffer(s, np.uint64))
                docs.append(np.frombuffer(d, np.int64))
                n += len(sigs[-1])
                if n <= most:
                    continue
                sig, doc, out = gathered()
                yield from out
                values, at, many = np.unique(sig, return_index=True, return_counts=True)
                rest = np.ones(len(sig), bool)
                for v, s, m in zip(values[many > large].tolist(), at[many > large].tolist(), many[many > large].tolist()):
                    hot[v] = run, centre = (v & (2**62 - 1)) | 1, int(doc[s])
                    yield found(np.full(m - 1, run), np.full(m - 1, centre), doc[s + 1 : s + m])
                    rest[s : s + m] = False
                sigs, docs = [sig[rest]], [doc[rest]]
                n = len(sigs[0])
                most = max(held, 2 * n)
        yield from ended()

    met = ordered.mapInArrow(meet, "run bigint, a bigint, b bigint").distinct()
    return met.withColumn("asks", F.lit(True))


def parity(tokens: np.ndarray) -> list[int]:
    """512 bits: of each, whether an odd number of the set's values falls on it. Shared values cancel out, so two sets
    differ in at least as many values as their bits."""
    return parities(tokens, np.array([len(tokens)]))[0].tolist()


def parities(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``parity`` of many sets, a row each; ``values``: theirs one behind the other, ``counts``: how many each has."""
    at = np.repeat(np.arange(len(counts)) * 512, counts) + (values >> np.uint64(55)).astype(np.int64)
    bits = (np.bincount(at, minlength=512 * len(counts)) & 1).astype(np.uint8)
    return np.packbits(bits.reshape(-1, 512), axis=1).view(np.int64)


def stored_tokens(sets: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Values that were stored as they are, one set behind the other, and how many each set has."""
    return np.frombuffer(b"".join(sets), np.uint64), np.array([len(x) // 8 for x in sets], np.int64)


def _pieces(batch, column: int, rows: int = 500, size: int = 1 << 22):
    """An Arrow batch in slices of at most ``rows`` rows, and of not much more than ``size`` bytes in a binary column."""
    for piece in small_batches(batch, rows):
        ends = np.cumsum([len(x) if x is not None else 0 for x in piece.column(column).to_pylist()])
        at = 0
        while at < piece.num_rows:
            start = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, start + size, "right")))
            yield piece.slice(at, to - at)
            at = to


#: Many sets as they are stored to their sorted distinct uint64 values, one set behind the other, and how many each has.
Parse = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def compared(pairs: DataFrame, sets: DataFrame, parse: Parse = stored_tokens) -> DataFrame:
    """Exact overlap of the sets of pairs (a, b): a, b, common, size_a, size_b. ``sets``: id, tokens (see ``Parse``). A
    pair whose id has several sets gives a row for each combination."""
    # The rows of a centre that has many are dealt over tasks, each with a copy of the centre's set.
    units = pairs.groupBy("a").agg(F.ceil(F.count("*") / UNIT).cast("int").alias("units"))
    unit = F.pmod(F.xxhash64("b"), F.col("units")).cast("int")
    others = pairs.join(units, "a").withColumn("unit", unit).join(sets.withColumnRenamed("id", "b"), "b")
    centres = units.withColumn("unit", F.explode(F.expr("sequence(0, units - 1)"))).join(sets.withColumnRenamed("id", "a"), "a")
    both = others.select("a", "unit", "b", "tokens").unionByName(
        centres.select("a", "unit", F.lit(None).cast("bigint").alias("b"), "tokens")
    )
    both = both.repartition("a", "unit").sortWithinPartitions("a", "unit", F.col("b").asc_nulls_first())

    def compare(batches):
        centre, own = None, []
        for piece in (x for batch in batches for x in _pieces(batch, 3)):
            values, counts = parse(piece.column(3).to_pylist())
            ends = np.cumsum(counts)
            rows = []
            for k, (a, unit, b) in enumerate(zip(*(piece.column(c).to_pylist() for c in range(3)))):
                tokens = values[ends[k] - counts[k] : ends[k]]
                if b is None:
                    own = [*own, tokens] if centre == (a, unit) else [tokens]
                    centre = a, unit
                    continue
                for mine in own:
                    both = np.concatenate((mine, tokens))
                    both.sort()  # a value of both sets stands twice
                    rows.append((a, b, int(np.count_nonzero(both[1:] == both[:-1])), len(mine), len(tokens)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["a", "b", "common", "size_a", "size_b"])

    return both.mapInArrow(compare, "a bigint, b bigint, common bigint, size_a bigint, size_b bigint")


def _linked(percent: int) -> Column:
    """Whether a pair that was ``compared`` is a link."""
    return (F.col("common") > 0) & (100 * F.col("common") >= percent * (F.col("size_a") + F.col("size_b") - F.col("common")))


def _unseen(pairs: DataFrame, seen: list[DataFrame]) -> DataFrame:
    """The distinct pairs (a, b) that are in none of ``seen``."""
    pairs = pairs.distinct()
    for known in seen:
        pairs = pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")
    return written(pairs, "more-pairs")


def resolved(
    runs: DataFrame, sets: DataFrame, percent: int, parse: Parse = stored_tokens
) -> DataFrame:
    """node, component: the classes of links with a similarity of at least ``percent`` / 100, without members alone.

    ``runs``: run, a (centre), b, asks. ``sets``: id, tokens (see ``compared``), size and sketch (see ``parity``).
    Only classes are wanted, so a pair within a class that is known by then needs no comparison:

    1. Every member of a meeting is compared with its centre.
    2. In meetings that still hold several classes, the first member outside the centre's class is a second centre.
    3. What is left, pairs of different classes, is found by sketches in tasks that hold two blocks of a meeting. Few pairs
       are compared one by one, each once for all its meetings; of many, the two blocks are, with their sets.

    Left out in 2 and 3 are pairs of which nobody asks, and pairs whose sizes, sketches, or distances to the centre
    differ by more than a link allows: 1 - similarity is a metric. So no link between classes is lost, and n near copies cost
    about n comparisons a centre.
    """
    pairs = runs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = written(compared(pairs, sets, parse), "pairs")
    link, union = _linked(percent), F.col("size_a") + F.col("size_b") - F.col("common")
    far = F.when(union > 0, 1 - F.col("common") / union).otherwise(1.0)
    judged = first.groupBy(F.col("a").alias("l"), F.col("b").alias("g")).agg(F.min(far).alias("far"))
    held = runs.filter("run <> 0").select("run", F.col("a").alias("centre"), "b", "asks", F.least("a", "b").alias("l"), F.greatest("a", "b").alias("g"))
    held = held.join(judged, ["l", "g"]).select("run", "centre", "b", "asks", "far")
    sketches = sets.select(F.col("id").alias("b"), "size", "sketch")
    apart = (100 - percent) / 100 + 1e-9

    def still_open(members: DataFrame, parts: DataFrame) -> DataFrame:
        """Members of the meetings that hold several classes, with their class and the centre's."""
        own, its = (parts.select(F.col("node").alias(n), F.col("component").alias(c)) for n, c in (("b", "part"), ("centre", "centre_part")))
        members = members.join(own, "b", "left").join(its, "centre", "left").withColumns(
            {"part": F.coalesce("part", "b"), "centre_part": F.coalesce("centre_part", "centre")}
        )
        several = members.groupBy("run").agg(F.max(F.col("part") != F.col("centre_part")).alias("several")).filter("several")
        open_ = members.join(several.select("run"), "run", "left_semi")
        return written(open_ if "sketch" in members.columns else open_.join(sketches, "b"), "held")

    def worth(x: str, y: str):
        small, large = F.least(f"{x}.size", f"{y}.size"), F.greatest(f"{x}.size", f"{y}.size")
        differ = sum(F.bit_count(F.col(f"{x}.sketch")[k].bitwiseXOR(F.col(f"{y}.sketch")[k])) for k in range(8))
        return (
            (F.col(f"{x}.part") != F.col(f"{y}.part")) & (F.col(f"{x}.asks") | F.col(f"{y}.asks"))
            & (F.abs(F.col(f"{x}.far") - F.col(f"{y}.far")) <= apart) & (100 * small >= percent * large)
            & (differ * (100 + percent) <= (100 - percent) * (small + large))
        )

    parts = written(connected_components(first.filter(link).select("a", "b")), "parts")
    held = still_open(held, parts)
    if held.isEmpty():
        return parts
    columns = F.struct("b", "asks", "far", "size", "part", "sketch")
    second = held.filter("part <> centre_part").groupBy("run").agg(F.min(columns).alias("x"))
    met = held.select("run", columns.alias("y")).join(second, "run").filter(worth("x", "y"))
    met = met.select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b"))
    second = written(compared(_unseen(met, [first]), sets, parse), "pairs")
    parts = written(extended_components(parts, second.filter(link).select("a", "b")), "parts")
    held = still_open(held.drop("part", "centre_part"), parts)
    links = written(_links_between(held, sets, percent, parse, [first, second]), "more-links")
    if not links.isEmpty():
        parts = written(extended_components(parts, links), "parts")
    return parts


def _worthwhile(held: DataFrame, percent: int) -> DataFrame:
    """What is left to compare of open meetings, from members (run, b, asks, far, size, part, sketch), told by sizes and
    sketches alone, without sets. Rows of two kinds:

    * A pair of members of different classes that a link may join: a, b (run is null).
    * A member that has such a partner, of two blocks with more than ``FEW`` such pairs a member: run, i, j, own, b, asks,
      far, part (a is null).

    A large meeting is dealt into blocks, and any two of them meet in a task.
    """
    blocks = held.groupBy("run").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_VALUES)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int")
    dealt = held.join(blocks, "run").withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "run", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "b", "asks", "far", "part", "size", "sketch"
    )
    dealt = dealt.repartition("run", "i", "j").sortWithinPartitions("run", "i", "j", "b")
    apart = (100 - percent) / 100 + 1e-9
    kinds = {"run": pa.int64(), "i": pa.int32(), "j": pa.int32(), "own": pa.int32(), "a": pa.int64(), "b": pa.int64(), "asks": pa.bool_(), "far": pa.float64(), "part": pa.int64()}

    def made(columns: dict):
        n = len(columns["b"])
        return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in kinds.items()], list(kinds))

    def partners(own, asks, far, part, size, sketch):
        """Places of the pairs, some members at a time against those behind them."""
        n, across = len(own), own.min() != own.max()
        step = max(1, 100_000 // n)
        for at in range(0, n - 1, step):
            x, y = slice(at, at + step), slice(at, None)
            small, large = np.minimum.outer(size[x], size[y]), np.maximum.outer(size[x], size[y])
            worth = (
                np.not_equal.outer(part[x], part[y]) & np.logical_or.outer(asks[x], asks[y])
                & (np.abs(np.subtract.outer(far[x], far[y])) <= apart) & (100 * small >= percent * large)
            )
            if across:
                worth &= np.not_equal.outer(own[x], own[y])
            one, other = np.nonzero(np.triu(worth, 1))
            differ = np.bitwise_count(sketch[x][one] ^ sketch[y][other]).sum(1, np.int64)
            near = differ * (100 + percent) <= (100 - percent) * (small + large)[one, other]
            yield one[near] + at, other[near] + at

    def choose(batches):
        rest = None

        def chosen(now, starts, ends):
            pairs, members = [], []
            for s, e in zip(starts, ends):
                _, _, _, own, b, asks, far, part, size, sketch = (c[s:e] for c in now)
                if (part == part[0]).all():
                    continue
                one, other = (np.concatenate(p) for p in zip(*partners(own, asks, far, part, size, sketch)))
                if len(one) <= FEW * len(b):
                    pairs.append(np.stack([np.minimum(b[one], b[other]), np.maximum(b[one], b[other])], 1))
                else:
                    members.append(s + np.unique(np.concatenate([one, other])))
            if pairs:
                a, b = np.unique(np.concatenate(pairs), axis=0).T
                yield made({"a": a, "b": b})
            if members:
                yield made(dict(zip(("run", "i", "j", "own", "b", "asks", "far", "part"), (c[np.concatenate(members)] for c in now))))

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(9)]
            now.append(batch.column(9).flatten().to_numpy().view(np.uint64).reshape(-1, 8))
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            starts = [0, *(np.nonzero(np.any([c[1:] != c[:-1] for c in now[:3]], axis=0))[0] + 1).tolist()]
            yield from chosen(now, starts[:-1], starts[1:])
            rest = [c[starts[-1] :] for c in now]
        if rest is not None:
            yield from chosen(rest, [0], [len(rest[0])])

    return dealt.mapInArrow(choose, "run bigint, i int, j int, own int, a bigint, b bigint, asks boolean, far double, part bigint")


def _links_between(held: DataFrame, sets: DataFrame, percent: int, parse: Parse, seen: list[DataFrame] = []) -> DataFrame:
    """Links (a, b) that join classes of the same meeting, of members (run, b, asks, far, size, part): exact, every pair of
    classes that a link may join, but for pairs in ``seen`` (a, b). Sets travel with the few pairs of a meeting, once for
    all its meetings, and with the members of two blocks that have many: a task holds two blocks of bounded size and
    gives at most a link for each member."""
    if "sketch" not in held.columns:
        held = held.join(sets.select(F.col("id").alias("b"), "sketch"), "b")
    left = written(_worthwhile(held, percent), "left")
    few = compared(_unseen(left.filter("run IS NULL").select("a", "b"), seen), sets, parse).filter(_linked(percent)).select("a", "b")
    dealt = left.filter("run IS NOT NULL").drop("a").join(sets.withColumnRenamed("id", "b"), "b").select("run", "i", "j", "own", "b", "asks", "far", "part", "tokens", "sketch")
    dealt = dealt.repartition("run", "i", "j").sortWithinPartitions("run", "i", "j", "b")
    apart = (100 - percent) / 100 + 1e-9

    def links_of(rows):
        own, ids, asks, far, parts, tokens, sketches = zip(*rows)
        if len(set(parts)) == 1:
            return
        values, counts = parse(list(tokens))
        ends = np.cumsum(counts)
        own, asks, far, sketches = np.array(own), np.array(asks), np.array(far), np.array(sketches).view(np.uint64)
        classes, part = np.unique(np.array(parts), return_inverse=True)
        across = own.min() != own.max()
        for x in range(len(ids) - 1):
            y = slice(x + 1, None)
            small, large = np.minimum(counts[x], counts[y]), np.maximum(counts[x], counts[y])
            worth = (
                (part[y] != part[x]) & (asks[y] | asks[x]) & (np.abs(far[y] - far[x]) <= apart) & (100 * small >= percent * large)
                & (np.bitwise_count(sketches[y] ^ sketches[x]).sum(1, np.int64) * (100 + percent) <= (100 - percent) * (small + large))
            )
            if across:
                worth &= own[y] != own[x]
            for k in (np.nonzero(worth)[0] + x + 1).tolist():
                if part[k] == part[x]:  # by now
                    continue
                both = np.concatenate([values[ends[n] - counts[n] : ends[n]] for n in (x, k)])
                both.sort()  # a value of both sets stands twice
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                if common and 100 * common >= percent * (len(both) - common):
                    part[part == part[k]] = part[x]
                    yield ids[x], ids[k]

    def link(batches):
        group, rows = None, []

        def found(rows):
            links = list(links_of(rows)) if rows else []
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])

        for piece in (x for batch in batches for x in small_batches(batch, 500)):
            for run, i, j, *row in zip(*(c.to_pylist() for c in piece.columns)):
                if group != (run, i, j):
                    yield from found(rows)
                    group, rows = (run, i, j), []
                rows.append(row)
        yield from found(rows)

    return few.unionAll(dealt.mapInArrow(link, "a bigint, b bigint"))
