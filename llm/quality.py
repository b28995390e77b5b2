"""Quality rules: base rules on words, and a calibrated classifier on hashed word and character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import PRIME, WordHashes, as_bytes, mix, table, windows, words_of
from llm.registry import query

#: Fixed values. Feature families: words, word pairs, and byte sequences of each length. Each has 2 ** BITS weights.
BITS = 16
BYTE_LENGTHS = (2, 3, 4)
FAMILIES = 2 + len(BYTE_LENGTHS)
SYMBOLS = b"#*$%&|<>"
#: Fixed thresholds: below the first a text is rejected, from the second on it is good; between them it is kept and
#: marked 'unsure'.
REJECT_BELOW, GOOD_FROM = 0.7, 0.9

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


# --- what is measured on a text ----------------------------------------------------------------------------


def features(data: bytes, hashes: np.ndarray) -> list[np.ndarray]:
    """For each family the buckets of its n-grams in the text, repeats included."""
    shift = np.uint64(64 - BITS)
    out = [mix(hashes) >> shift, mix(hashes[:-1] * PRIME + hashes[1:]) >> shift]
    b = np.frombuffer(data, np.uint8).astype(np.uint32) + np.uint32(1)
    for n in BYTE_LENGTHS:
        if len(b) < n:
            out.append(b[:0])
            continue
        key = b[: len(b) - n + 1] * _MULTIPLIERS[0]
        for i in range(1, n):
            key = (key ^ (key >> np.uint32(15))) * _MULTIPLIERS[i] + b[i : len(b) - n + 1 + i]
        key = (key ^ (key >> np.uint32(13))) * _MULTIPLIERS[0]
        out.append(key >> np.uint32(32 - BITS))
    return out


def repeated_words(hashes: np.ndarray, n: int = 5) -> int:
    """How many words stand in an n-word window that occurs twice or more in the text."""
    if len(hashes) <= n:
        return 0
    keys = windows(hashes, n)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    repeated = np.zeros(len(keys), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int32)
    starts = np.nonzero(repeated)[0]
    edges[starts] += 1
    edges[starts + n] -= 1
    return int((np.cumsum(edges) > 0).sum())


def base_measures(text: str | None, data: bytes, hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    blanks = sum(map(data.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbols = sum(data.count(bytes([s])) for s in SYMBOLS)
    return len(hashes), len(text or "") - blanks, symbols, len(lines) - len(set(lines)), repeated_words(hashes)


# --- the classifier ----------------------------------------------------------------------------------------


@dataclass
class QualityModel:
    """weights: families x buckets. The score is bias + the mean weight of each family's n-grams; slope and offset
    turn it into a probability."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, found: list[np.ndarray]) -> float:
        score = self.bias + sum(float(w[k].mean()) for w, k in zip(self.weights, found) if len(k))
        return float(1 / (1 + np.exp(-np.clip(self.slope * score + self.offset, -500, 500))))


def _sparse(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, shares = [], []
    for family, buckets in enumerate(found):
        if len(buckets):
            key, n = np.unique(buckets, return_counts=True)
            keys.append(key.astype(np.int64) + (family << BITS))
            shares.append(n / len(buckets))
    if not keys:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    return np.concatenate(keys).astype(np.int32), np.concatenate(shares).astype(np.float32)


def _fit(rows: list[tuple[int, np.ndarray, np.ndarray]], weight: np.ndarray, steps: int = 120):
    """Logistic regression by Adam over all rows; ``weight`` sums to 1. Features are divided by their root mean square
    plus 0.01, which leaves n-grams that few texts have without a say."""
    y = np.array([r[0] for r in rows], float)
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    used, column = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
    value = np.concatenate([r[2] for r in rows]).astype(float)
    scale = np.sqrt(np.bincount(column, value * value, len(used)) / len(rows)) + 0.01
    value = value / scale[column]
    w, b = np.zeros(len(used)), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(row, value * w[column], len(rows)) + b
        d = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        g, gb = np.bincount(column, value * d[row], len(used)) + 1e-4 * w, d.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        k, l = 1 - 0.9**t, 1 - 0.99**t
        w = w - 0.005 * (m / k) / (np.sqrt(v / l) + 1e-6)
        b = b - 0.005 * (mb / k) / (np.sqrt(vb / l) + 1e-6)
    weights = np.zeros(FAMILIES << BITS, np.float32)
    weights[used] = w / scale
    return weights.reshape(FAMILIES, -1), float(b)


def _calibrate(scores: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Platt's slope and offset on held-out scores, with his smoothed targets, by Newton's method."""
    good, bad = weight[y == 1].sum(), weight[y == 0].sum()
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * scores + c, -500, 500)))
        d, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-9)
        g = np.array([(d * scores).sum() + 1e-6 * (a - 1) * (good + bad), d.sum()])
        hess = np.array([[(h * scores * scores).sum() + 1e-6 * (good + bad), (h * scores).sum()], [(h * scores).sum(), h.sum()]])
        step = np.linalg.solve(hess + 1e-9 * np.eye(2), g)
        step *= min(1.0, 5 / (np.abs(step).max() + 1e-12))
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(c)


def train_quality(
    docs: DataFrame, labels: DataFrame, per_class: int = 1200, seed: int = 5
) -> QualityModel | None:
    """Fits the classifier on at most ``per_class`` labelled documents of each quality, chosen by a hash of the id.

    ``labels``: doc_id, quality (1 good, 0 bad). Rows with nulls are left out; a document labelled both ways counts as
    bad. A quarter of the sample is held out for the calibration, weighted so that classes have the shares of all
    labels. One task fits the hashed counts of the bounded sample; only the model reaches the driver. Without texts of both
    classes: None.
    """
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality")).dropna()
        .groupBy("doc_id").agg(F.min("quality").alias("_quality")).filter("_quality IN (0, 1)")
    )
    n = {r["_quality"]: r["n"] for r in known.groupBy("_quality").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    sample = [
        known.filter(F.col("_quality") == q).orderBy(order, "doc_id").limit(per_class).withColumn("_held", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(4)) == 0)
        for q in (0, 1)
    ]

    def measure(batches):
        words = WordHashes()
        for batch in batches:
            rows = []
            for text, quality, held, doc_id in zip(*(c.to_pylist() for c in batch.columns)):
                data = as_bytes(text)
                keys, shares = _sparse(features(data, words.of(words_of(data))))
                rows.append((doc_id, quality, held, keys.tobytes(), shares.tobytes()))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "held", "keys", "shares"])

    # The sample has at most 2 * per_class rows: a proven bound for the broadcast and for what is collected.
    texts = (
        docs.select("doc_id", "text").join(F.broadcast(sample[0].unionAll(sample[1])), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("_quality").alias("q"), F.first("_held").alias("h"))
        .select("text", "q", "h", "doc_id")
    )
    schema = "doc_id bigint, quality int, held boolean, keys binary, shares binary"

    def fit(batches):
        rows = sorted((r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))), key=lambda r: r[0])
        model = _trained(rows, n)
        if model is not None:
            numbers = [pa.array([x]) for x in (model.bias, model.slope, model.offset)]
            yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), *numbers], ["weights", "bias", "slope", "offset"])

    # The bounded sample is measured where it lies and fitted in one task; the driver gets the model alone.
    found = texts.mapInArrow(measure, schema).repartition(1).mapInArrow(fit, "weights binary, bias double, slope double, offset double").collect()
    if not found:
        return None
    weights = np.frombuffer(found[0]["weights"], np.float32).reshape(FAMILIES, -1)
    return QualityModel(weights, found[0]["bias"], found[0]["slope"], found[0]["offset"])


def _trained(rows: list[tuple], n: dict[int, int]) -> QualityModel | None:
    """The model of measured rows (doc_id, quality, held, keys, shares); ``n`` counts the labels of each class."""
    parsed = [(r[1], np.frombuffer(r[3], np.int32), np.frombuffer(r[4], np.float32)) for r in rows]
    held = np.array([r[2] for r in rows], bool)
    y = np.array([r[0] for r in parsed])
    if len(set(y.tolist())) < 2:
        return None
    if not all(((y == q) & (held == h)).any() for q in (0, 1) for h in (False, True)):
        held = np.zeros(len(rows), bool)
    train = [p for p, h in zip(parsed, held) if not h]
    ty = np.array([p[0] for p in train])
    weights, bias = _fit(train, np.where(ty == 1, 0.5 / max(1, (ty == 1).sum()), 0.5 / max(1, (ty == 0).sum())))
    flat, judged = weights.reshape(-1), [p for p, h in zip(parsed, held) if h] or train
    scores = np.array([bias + float(flat[k] @ s) for _, k, s in judged])
    jy = np.array([p[0] for p in judged])
    prior = np.where(jy == 1, n[1] / max(1, (jy == 1).sum()), n[0] / max(1, (jy == 0).sum())) / (n[0] + n[1])
    return QualityModel(weights, bias, *_calibrate(scores, jy, prior * len(jy)))


MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
VERDICT = "base_failed boolean, probability double, verdict string, kept boolean"


def quality_rules(docs: DataFrame, model: QualityModel | None, keep_columns: list[str] = []) -> DataFrame:
    """Every row judged by the base rules and by the model, on its whole text.

    Returns doc_id, the base measures, base_failed, probability (that the text is good), verdict ('rules', 'reject',
    'unsure' or 'good') and kept, then ``keep_columns`` of ``docs``, whose names must differ from these. Rows are
    judged one by one, so repeated rows and null ids are rows like others; a null or empty text has no words and
    fails. Without a model (null) only the base rules decide. Other columns of ``docs`` are not read.
    """
    own = ["doc_id"] + [p.split()[0] for p in f"{MEASURES}, {VERDICT}".split(", ")]
    types = dict(docs.select(*keep_columns).dtypes) if keep_columns else {}
    schema = ", ".join(["doc_id bigint", MEASURES, VERDICT, *(f"`{c}` {types[c]}" for c in keep_columns)])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 1.3 MB at any input size

    def judge(batches):
        words, scorer = WordHashes(), shared.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = as_bytes(text)
                hashes = words.of(words_of(data))
                base = base_measures(text, data, hashes)
                failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
                p = scorer.probability(features(data, hashes)) if scorer else None
                verdict = "rules" if failed else "good" if p is None or p >= GOOD_FROM else "unsure" if p >= REJECT_BELOW else "reject"
                rows.append((doc_id, *base, failed, p, verdict, verdict in ("good", "unsure")))
            if rows:
                kinds = [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.string(), pa.bool_()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([*columns, *batch.columns[2:]], [*own, *keep_columns])

    return docs.select("doc_id", "text", *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep_columns)]).mapInArrow(judge, schema)


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, train_quality(docs, table(spark, sf_dir, "labels")))
