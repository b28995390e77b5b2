"""Mixing sources to target weights by Poisson replication, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import uniform, written
from llm.registry import query

#: A table of sources is broadcast only if it was counted and has at most this many rows.
BROADCAST_SOURCES = 10_000
#: Up to this rate a source's cumulative probabilities are one array; beyond, each document sums its own.
LARGE = 1000
#: Copies of a document that are numbered at a time.
COPIES = 1 << 16


def replication_rates(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """source, n_docs, source_chars, rate: how often a document of the source is to occur on average.

    ``weights`` are the wanted shares of all characters (any positive scale; a source not named gets none);
    by default every source gets the same share. The mix has as many characters as the input. A source without any
    character gets rate 1, since no rate can change its share. A null source is a source of its own.
    """
    sizes = written(
        docs.groupBy("source").agg(
            F.count("*").alias("n_docs"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("source_chars")
        ),
        "sources",
    )
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for source, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(value))).otherwise(weight)
    sizes = sizes.withColumn("weight", weight)
    whole = sizes.agg(F.sum("source_chars").alias("chars"), F.sum("weight").alias("weights")).first()
    chars, total = float(whole["chars"] or 0), float(whole["weights"] or 0) or 1.0
    share = F.col("weight") / F.lit(total)
    rate = F.when(F.col("source_chars") == 0, F.lit(1.0)).otherwise(
        F.round(F.lit(chars) * share / F.col("source_chars"), 9)
    )
    return sizes.select("source", "n_docs", "source_chars", rate.alias("rate"))


def poisson_steps(rate: Column) -> Column:
    """The cumulative Poisson probabilities of 0, 1, 2, ... up to far beyond the mean, as an array.

    Terms are made in logarithms, so a large mean does not underflow.
    """
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(
        (-rate).alias("log_term"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps")
    )

    def step(state: Column, i: Column) -> Column:
        log_term = state["log_term"] + F.log(rate) - F.log(i.cast("double"))
        total = state["sum"] + F.exp(log_term)
        return F.struct(
            log_term.alias("log_term"), total.alias("sum"), F.concat(state["steps"], F.array(total)).alias("steps")
        )

    steps = F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["steps"])
    return F.when(rate > 0, steps).otherwise(F.array(F.lit(2.0) - 1.0))


def large_draw(rate: Column, draw: Column) -> Column:
    """How many cumulative Poisson probabilities are at most ``draw``, for rates over LARGE.

    The sum starts 10 standard deviations and 20 below the mean, under which lies less than 1e-20, with Stirling's
    series for the factorial, and holds no array of sums: the cost grows with the root of the rate.
    """
    first = F.floor(rate - 10 * F.sqrt(rate) - 20)
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20)
    term = (
        (first - rate) + first * F.log1p((rate - first) / first) - F.log(2 * math.pi * first) / 2
        - 1 / (12 * first) + 1 / (360 * F.pow(first.cast("double"), F.lit(3.0)))
    )

    def state(log_term: Column, total: Column, count: Column) -> Column:
        met = F.when(total <= draw, count + 1).otherwise(count)
        return F.struct(log_term.alias("log_term"), total.alias("sum"), met.alias("count"))

    def step(now: Column, i: Column) -> Column:
        log_term = now["log_term"] + F.log(rate / i)
        return state(log_term, now["sum"] + F.exp(log_term), now["count"])

    return F.aggregate(F.sequence(first + 1, last), state(term, F.exp(term), first), step, lambda s: s["count"])


def mix_sources(
    docs: DataFrame, weights: dict[str | None, float] | None = None, seed: int = 17
) -> DataFrame:
    """The rows of ``docs`` replicated so that sources meet their weights, in a random global order.

    Every document draws a number from a hash of the seed and its doc_id, and the inverse of the Poisson distribution
    with its source's rate turns that into a count: the count does not depend on partitions or order, and a rerun
    draws the same. The document is exploded by its count (0 leaves it out: that is the mixing), and the copies
    are sorted by another hash, which deals every source evenly over all files.

    Columns: those of ``docs`` (all of them) and copy_no int (from 1), unless ``docs`` has a column of that name,
    which is then kept. Null doc_ids draw like the id ''; equal rows draw alike. Null or empty texts count no
    characters and are replicated like any other. An empty table gives no rows.
    """
    rates = replication_rates(docs, weights)
    few = rates.count() <= BROADCAST_SOURCES
    steps = F.when(F.col("rate") <= LARGE, poisson_steps(F.col("rate")))
    rates = rates.select("source", "rate", steps.alias("steps"))
    # A row travels as one value, so the columns of docs may have any names.
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("own"), uniform(F.lit(seed), F.col("doc_id")).alias("draw"),
    )
    # A source that holds a third of all rows meets one row: broadcast after counting, else an inner join, whose
    # skewed partitions the adaptive plan splits.
    joined = rows.join(F.broadcast(rates) if few else rates, F.col("own").eqNullSafe(F.col("source")))
    few_copies = F.size(F.filter("steps", lambda c: c <= F.col("draw"))).cast("bigint")
    copies = F.when(F.col("rate") <= LARGE, few_copies).otherwise(large_draw(F.col("rate"), F.col("draw")))
    order = F.md5(F.concat_ws("|", F.lit(f"order {seed}"), F.coalesce("id", F.lit("")), F.col("copy")))
    return (
        joined.withColumn("copies", copies).filter("copies > 0")
        .withColumn("from", F.explode(F.expr(f"sequence(1, greatest(1, int(copies)), {COPIES})")))
        .withColumn("copy", F.explode(F.expr(f"sequence(`from`, least(int(copies), `from` + {COPIES - 1}))")))
        .select("row", F.col("copy").alias("copy"), order.alias("order")).orderBy("order")
        .select("row.*", *([] if "copy_no" in docs.columns else [F.col("copy").alias("copy_no")]))
    )


SQL = """
WITH sizes AS (SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS n FROM documents GROUP BY source),
whole AS (SELECT sum(n) AS chars, CAST(count(*) AS DOUBLE) AS k FROM sizes),
rates AS (SELECT source, CASE WHEN n = 0 THEN 1.0 ELSE round(chars * (1.0 / k) / n, 9) END AS rate FROM sizes, whole),
terms AS (
  SELECT source, i, exp(-rate + i * ln(rate) - CASE WHEN i < 1 THEN 0 ELSE lgamma(i + 1) END) AS p
  FROM (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 10 * sqrt(rate) + 20) AS BIGINT) + 1)) AS i FROM rates)
),
steps AS (SELECT source, i, sum(p) OVER (PARTITION BY source ORDER BY i) AS c FROM terms),
draws AS (
  SELECT *, CAST(CAST('0x' || substr(md5('17|' || doc_id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM documents
),
counts AS (
  SELECT d.doc_id, count(s.i) AS copies FROM draws d JOIN steps s
    ON d.source IS NOT DISTINCT FROM s.source AND s.c <= d.u GROUP BY d.doc_id
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, CAST(unnest(range(1, copies + 1)) AS INTEGER) AS copy_no
FROM documents d JOIN counts USING (doc_id)
"""


@query("op6_mix_sources", SQL)
def op6_mix_sources(spark, sf_dir):
    from llm.common import table

    return mix_sources(table(spark, sf_dir, "documents"))
