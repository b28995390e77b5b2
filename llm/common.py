"""Helpers shared by the operators: the shared folder, text as bytes and words as hashes."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.plans.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the folder that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` written as parquet to the shared folder and read again: its lineage ends there, so a lost executor
    costs a read, and later steps read only the columns they use. ``folder`` is a ``stage_folder`` below the shared one,
    which its user removes when no DataFrame that reads it is left."""
    spark = df.sparkSession
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else new_folder(spark, name)
    with _shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """Spark removes the shuffle files of what is written here at its end: nothing reads them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffle_tasks(spark: SparkSession) -> int:
    """How many tasks a keyed shuffle gets: the session's own setting, which follows the size of its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts, which SQL engines compute alike. Null parts count as ''."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


# --- text ----------------------------------------------------------------------------------------------

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def as_bytes(text: str | None) -> bytes:
    """UTF-8; null is empty; a lone surrogate becomes '?' as in the JVM."""
    return text.encode("utf-8", "replace") if text else b""


class WordHashes(dict):
    """64-bit hashes of words. Holds at most ``bound`` words, which bounds the memory of a worker."""

    def __init__(self, bound: int = 400_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.bound:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_RANDOM = np.random.default_rng(2024)
_BYTE = _RANDOM.integers(0, 2**64, 256, np.uint64)
_POWER = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of an odd base and of its inverse, as far as needed so far
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    while len(_POWER[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            _POWER[k] = np.concatenate([_POWER[k], _POWER[k] * np.uint64(pow(base, len(_POWER[k]), 2**64))])
    return _POWER[0], _POWER[1]


def word_hashes(data: bytes, piece: int = 1 << 18) -> np.ndarray:
    """64-bit hashes of the words of a text, without making the words: a polynomial over random values of the bytes.

    The text is taken in pieces that end between words, so a worker holds powers for the longest piece or word only.
    """
    out, at = [], 0
    whole = np.frombuffer(data, np.uint8)
    while at < len(whole):
        end = min(len(whole), at + piece)
        while end < len(whole):
            back = np.nonzero(SPACE[whole[at:end]])[0]
            if len(back):
                end = at + int(back[-1]) + 1
                break
            end = min(len(whole), end + piece)
        b = whole[at:end]
        at = end
        inside = np.concatenate([[False], ~SPACE[b], [False]])
        edges = np.nonzero(inside[1:] != inside[:-1])[0]
        starts, ends = edges[::2], edges[1::2]
        if len(starts):
            power, inverse = _powers(len(b) + 1)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[b] * power[: len(b)])])
            value = (sums[ends] - sums[starts]) * inverse[starts]
            out.append(mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def words_of(data: bytes) -> list[bytes]:
    """Runs of bytes other than 0x20 and 0x09-0x0D; bytes.split() splits at just these."""
    return data.split()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


PRIME = np.uint64(0x9E3779B97F4A7C15)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every window of ``n`` neighbouring values."""
    if len(hashes) < n:
        return hashes[:0]
    out = hashes[: len(hashes) - n + 1].copy()
    for i in range(1, n):
        out = out * PRIME + hashes[i : len(hashes) - n + 1 + i]
    return mix(out)


def shingles(hashes: np.ndarray, n: int = 5) -> np.ndarray:
    """The sorted distinct hashes of the ``n``-word windows; fewer words count as one window; none give none."""
    if not len(hashes):
        return hashes
    if len(hashes) < n:
        out = hashes[:1].copy()
        for h in hashes[1:]:
            out = out * PRIME + h
        return mix(out + np.uint64(len(hashes)))
    return np.unique(windows(hashes, n))


def small_batches(batch, rows: int):
    """An Arrow batch in slices, so that what a task makes of it stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
