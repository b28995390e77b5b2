"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookflow.options import DEFAULTS, Options


def fits_broadcast(df: DataFrame, options: Options = DEFAULTS) -> bool:
    """Measured row count and text size of ``df`` are inside the broadcast bounds. Runs one small job."""
    size = F.octet_length(F.to_json(F.struct("*")))
    seen = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return seen["n"] <= options.broadcast_rows and seen["bytes"] <= options.broadcast_bytes


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    # Fields of a struct compare null-safe, so null keys meet like any other value.
    return df.withColumn("_key", F.struct(*keys))


def _salted(left: DataFrame, right: DataFrame, counts: DataFrame, salt_by: list[str], options: Options) -> DataFrame:
    """Left join on ``_key``. Rows of hot keys are spread over copies of their right row, a copy for every
    ``hot_key_rows`` rows, so that a task sees about that many however frequent the key is.

    ``counts`` holds (_key, _n) of the left side. A key is hot from ``hot_key_rows`` rows on, if these are at least a
    ``hot_keys``-th of all rows: there can be no more than that many, which bounds the broadcast.
    """
    enough = F.col("_n") * F.lit(options.hot_keys) >= counts.agg(F.sum("_n")).scalar()
    hot = counts.filter((F.col("_n") >= options.hot_key_rows) & enough).select(
        "_key", F.ceil(F.col("_n") / options.hot_key_rows).cast("int").alias("_splits")
    )
    splits = F.coalesce("_splits", F.lit(1))
    left = left.join(F.broadcast(hot), "_key", "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_by), splits).cast("int"))
    right = right.join(F.broadcast(hot), "_key", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), splits - 1)))
    joined = left.drop("_splits").join(right.drop("_splits"), ["_key", "_salt"], "left")
    return joined.drop("_key", "_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    salt_by: list[str] | None = None,
    options: Options = DEFAULTS,
) -> DataFrame:
    """Left join to a relation with unique ``keys``: broadcast when measured small, else shuffled and salted.

    ``right`` is computed for the measurement and again for the join; pass it materialized when that is costly.
    ``salt_by`` names columns that tell the left rows of one key apart (a row id).
    """
    if fits_broadcast(right, options):
        return _keyed(left, keys).join(F.broadcast(_keyed(right, keys).drop(*keys)), "_key", "left").drop("_key")
    return salted_lookup(left, right, keys, salt_by, options)


def salted_lookup(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    salt_by: list[str] | None = None,
    options: Options = DEFAULTS,
) -> DataFrame:
    """Left join to a large relation with unique ``keys`` while some keys may be hot on the left."""
    keyed = _keyed(left, keys)
    counts = keyed.groupBy("_key").agg(F.count("*").alias("_n"))
    return _salted(keyed, _keyed(right, keys).drop(*keys), counts, salt_by or left.columns, options)


def attach_totals(
    df: DataFrame,
    keys: list[str],
    totals: dict[str, Column],
    salt_by: list[str] | None = None,
    options: Options = DEFAULTS,
) -> DataFrame:
    """Every row with aggregates over its key group; the window-free form of ``agg over (partition by keys)``.

    The aggregates are combined map-side, so a group of any size reaches one task only as partial results, and
    the way back is salted.
    """
    keyed = _keyed(df, keys)
    grouped = keyed.groupBy("_key").agg(
        F.count("*").alias("_n"), *[column.alias(name) for name, column in totals.items()]
    )
    counts = grouped.select("_key", "_n")
    return _salted(keyed, grouped.drop("_n"), counts, salt_by or df.columns, options)
