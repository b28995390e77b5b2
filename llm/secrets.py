"""Secret scans: fixed patterns, and a battery of randomness tests on other long runs of characters."""

from __future__ import annotations

import functools
import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import as_bytes, table, written
from llm.registry import query

#: Fixed patterns by kind, in this order; and the least length of what must be long.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")  # runs are maximal, so the length may stand in the pattern
BASE_KINDS = ("assign", "access", "hex")
RANDOM = "random"
KINDS = (*BASE_KINDS, RANDOM)

#: What the battery looks at: runs of at least 20 of these characters.
RUN = re.compile(rb"[A-Za-z0-9+/_-]{20,}")
#: Alphabets from small to large; a run is tested in the first that holds it.
ALPHABETS = (
    b"0123456789",
    b"0123456789abcdef",
    b"0123456789ABCDEF",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
)
#: Upper ends of the length bands, and the bins of -log10 of the combined p-value.
LENGTHS = (24, 28, 32, 40, 48, 64, 96, 128)
BINS, BIN = 60, 0.1
#: Bins of p-values over 0.001. A run beyond fails the battery and is never reported.
PASSING = 30
#: So many names as people write them, in each length band, tell how often ordinary runs pass where texts have few.
NAMES = 200
WORDS = (
    "user profile settings page final report draft index image assets static build module config service handler request "
    "response order customer invoice payment archive backup summer winter release notes version update guide tutorial "
    "install linux windows server client network router switch table column field value"
).split()


def base_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes. Matches are leftmost and do not overlap within a kind; too short ones go after
    that."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(data) if m.end(2) - m.start(2) >= 12]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(data) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(data)]
    return out


# --- the battery -------------------------------------------------------------------------------------------------


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def uniformity(values: np.ndarray, size: int) -> float:
    """Chi-squared test that all characters are equally frequent (Wilson and Hilferty's cube root for the tail)."""
    counts = np.bincount(values, minlength=size)
    expected = len(values) / size
    chi, df = float(((counts - expected) ** 2).sum() / expected), size - 1
    z = ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def runs_test(values: np.ndarray, size: int) -> float:
    """Wald and Wolfowitz: the number of runs of the alphabet's upper and lower half."""
    high = values >= size // 2
    n, a = len(values), int(high.sum())
    b = n - a
    if not a or not b:
        return max(2.0 ** (1 - n), 1e-300)
    mean = 2 * a * b / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + int((high[1:] != high[:-1]).sum())
    return _two_sided((runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0


def serial_correlation(values: np.ndarray) -> float:
    """Correlation of neighbours; about normal with mean -1/n and variance 1/n for random characters."""
    v = values - values.mean()
    whole = float((v * v).sum())
    if whole == 0:
        return 1e-300
    return _two_sided((float((v[1:] * v[:-1]).sum()) / whole + 1 / len(v)) * math.sqrt(len(v)))


def randomness(run: bytes) -> float:
    """Fisher's combination of the three tests in the run's inferred alphabet: small if it is not random."""
    alphabet = next(a for a in ALPHABETS if not run.translate(None, a))
    place = np.zeros(256, np.int64)
    place[list(alphabet)] = np.arange(len(alphabet))
    values = place[np.frombuffer(run, np.uint8)]
    each = (uniformity(values, len(alphabet)), runs_test(values, len(alphabet)), serial_correlation(values))
    x = -sum(math.log(max(p, 1e-300)) for p in each)
    return math.exp(-x) * (1 + x + x * x / 2)


def band_of(length: int) -> int:
    return sum(length > end for end in LENGTHS)


def level_of(run: bytes) -> int:
    return min(BINS - 1, int(-math.log10(max(randomness(run), 1e-9)) / BIN))


def candidates(data: bytes) -> list[tuple[int, int, bool, int, int]]:
    """(start, end, target, length band, bin). Runs with digits and letters are targets; those with letters but no digit,
    with or without separators, are what ordinary text is made of, and serve as the decoys that tell how often it passes.
    Runs without a letter are neither."""
    out = []
    for m in RUN.finditer(data):
        run = m[0]
        letters, digits = run.translate(None, b"0123456789+/_-"), run.translate(None, ALPHABETS[6] + b"+/_-")
        if letters:
            out.append((m.start(), m.end(), bool(digits), band_of(len(run)), level_of(run)))
    return out


@functools.cache
def ordinary() -> dict[tuple[int, int], int]:
    """(length band, bin): number, of NAMES fixed names in every band, most with a digit."""
    rng, out = random.Random(1), {}
    for band, least in enumerate((20, *(end + 1 for end in LENGTHS))):
        for _ in range(NAMES):
            length, separator = rng.randint(least, (*LENGTHS, 2 * LENGTHS[-1])[band]), rng.choice(("_", "-", "/", ""))
            words = [rng.choice(("v2", "2024", "01", "7"))]
            while len(separator.join(words)) < length:
                words.insert(rng.randint(0, len(words)), rng.choice(WORDS))
            name = separator.join(words).encode()[:length]
            key = band, level_of(name)
            out[key] = out.get(key, 0) + 1
    return out


def cutoffs(histogram: dict[tuple[int, bool, int], int], rate: float) -> dict[int, int]:
    """For each length band the highest bin up to which the ordinary runs among the targets are estimated at no more
    than ``rate`` of the targets, and at most PASSING bins. Decoys and fixed names give the share of ordinary runs that
    pass up to a bin, and the targets that fail the battery, over the share that fails, the number of ordinary ones.
    Short runs, where the tests have little power, thus need to look more random, or are not reported at all."""
    out, names = {}, ordinary()
    for band in range(len(LENGTHS) + 1):
        targets = [histogram.get((band, True, level), 0) for level in range(BINS)]
        decoys = [histogram.get((band, False, level), 0) + names.get((band, level), 0) for level in range(BINS)]
        failing, failed = sum(targets[PASSING:]), sum(decoys[PASSING:])
        for level in range(PASSING):
            reported, passed = sum(targets[: level + 1]), sum(decoys[: level + 1]) + 1
            # failing / (failed / all) ordinary targets, of which passed / all pass
            if reported and failing * passed <= rate * reported * failed:
                out[band] = level
    return out


def secret_spans(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """doc_id, spans: an array of (kind, start, end), in code points, by start, then kind as listed in KINDS.

    The battery's statistics are counts by length band and bin over all texts: at most 1,080 rows, whatever the
    input. Every row of ``docs`` gives a row, also null and empty texts (no spans), null ids and repeated rows.
    Columns besides doc_id and text are not read. A text is scanned once; the second pass reads spans only.
    """
    span = "array<struct<kind:int,start:bigint,end:bigint,band:int,level:int,target:boolean>>"

    def scan(batches):
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                data = as_bytes(text)
                rows = [(s, e, k, None, None, None) for s, k, e in base_spans(data)]
                rows += [(s, e, 3, band, level, target) for s, e, target, band, level in candidates(data)]
                if rows and len(data) != len(text):
                    points = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
                    rows = [(int(points[s]), int(points[e]), *rest) for s, e, *rest in rows]
                found.append([dict(zip(("start", "end", "kind", "band", "level", "target"), r)) for r in sorted(rows, key=lambda r: (r[0], r[2]))])
            kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("band", pa.int32()), ("level", pa.int32()), ("target", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(found, kind)], ["doc_id", "found"])

    scanned = written(docs.select("doc_id", "text").mapInArrow(scan, f"doc_id bigint, found {span}"), "secrets")
    counts = scanned.select(F.explode("found").alias("f")).filter("f.kind = 3").groupBy("f.band", "f.target", "f.level").agg(F.count("*").alias("n"))
    histogram = {(r["band"], r["target"], r["level"]): r["n"] for r in counts.collect()}
    chosen = cutoffs(histogram, rate)
    passed = F.lit(False)
    names = F.array(*[F.lit(k) for k in KINDS])

    def stays(f):
        test = passed
        for band, level in chosen.items():
            test = test | ((f["band"] == band) & (f["level"] <= level))
        return (f["kind"] < 3) | (f["target"] & test)

    kept = F.transform(F.filter("found", stays), lambda f: F.struct(F.element_at(names, f["kind"] + 1).alias("kind"), f["start"].alias("start"), f["end"].alias("end")))
    return scanned.select("doc_id", kept.alias("spans"))


@query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def digest(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    base = F.filter("spans", lambda s: s["kind"] != RANDOM)
    return found.select(
        "doc_id", *[count(k) for k in BASE_KINDS], F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans")
    )
