"""The status of raw rows as an ordered fold over an append-only log of steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookflow.operators.clean import row_statuses

#: The status of a row as it is written, and the steps that may follow each status.
START = "pending"
NEXT = {
    "pending": ["processing", "error"],
    "processing": ["normalised", "quarantined", "error"],
    "normalised": ["processing"],
    "quarantined": ["processing"],
    "error": ["pending", "processing"],
}


def _after(state: Column, step: Column) -> Column:
    """The state (status, refused) after a step."""
    legal = F.array(*[F.lit(f"{a}>{b}") for a, steps in NEXT.items() for b in steps])
    moves = F.array_contains(legal, F.concat(state["status"], F.lit(">"), step))
    moved = F.struct(step.alias("status"), state["refused"].alias("refused"))
    stays = F.struct(state["status"].alias("status"), (state["refused"] + 1).alias("refused"))
    return F.when(moves, moved).when(state["status"] == step, state).otherwise(stays)


def fold_statuses(events: DataFrame, slot_seconds: int = 86_400) -> DataFrame:
    """(bronze_id, processing_status, steps, refused) of every row in ``events``: bronze_id, status, at, place.

    Steps are taken in the order of ``at``, ``place`` and status, nulls first. A step that may not follow the status
    reached changes nothing and is counted in ``refused``, as is an unknown or null status; the status reached once
    more says nothing new. Equal rows of the log are one step, so a load that is run again counts once.

    The steps of a time slot are reduced to what they do to each status a row may come from, and these effects are
    chained: a row with very many steps sends one effect per slot, whatever order its steps were stored in.
    """
    steps = events.select("bronze_id", F.coalesce("status", F.lit("")).alias("status"), "at", "place").distinct()
    slot = F.floor(F.unix_micros(F.col("at").cast("timestamp")) / (slot_seconds * 1_000_000))
    ordered = F.array_sort(F.collect_list(F.struct("at", "place", "status")))
    slots = steps.groupBy("bronze_id", slot.alias("slot")).agg(ordered.alias("ordered"), F.count("*").alias("n"))
    zero = F.lit(0).cast("bigint")
    unmoved = F.array(*[F.struct(F.lit(s).alias("status"), zero.alias("refused")) for s in NEXT])
    effect = F.aggregate("ordered", unmoved, lambda states, e: F.transform(states, lambda s: _after(s, e["status"])))
    chain = (
        slots.select("bronze_id", "slot", effect.alias("effect"), "n").groupBy("bronze_id")
        .agg(F.array_sort(F.collect_list(F.struct("slot", "effect"))).alias("chain"), F.sum("n").alias("steps"))
    )

    def through(state: Column, link: Column) -> Column:
        at = F.array_position(F.array(*[F.lit(s) for s in NEXT]), state["status"]).cast("int")
        to = F.get(link["effect"], at - 1)
        return F.struct(to["status"].alias("status"), (state["refused"] + to["refused"]).alias("refused"))

    first = F.struct(F.lit(START).alias("status"), zero.alias("refused"))
    return chain.withColumn("state", F.aggregate("chain", first, through)).select(
        "bronze_id", F.col("state.status").alias("processing_status"), "steps", F.col("state.refused").alias("refused")
    )


def steps_of(rows: DataFrame, *statuses: str | Column, at: Column | None = None) -> DataFrame:
    """Log entries that take every row (bronze_id) through ``statuses``, one after the other."""
    path = F.array(*[F.lit(s) if isinstance(s, str) else s for s in statuses])
    moment = F.current_timestamp() if at is None else at
    return rows.select("bronze_id", moment.alias("at"), F.posexplode(path).alias("place", "status")).select(
        "bronze_id", "status", "at", "place"
    )


def settled_steps(silver: DataFrame, quarantined: DataFrame, at: Column | None = None) -> DataFrame:
    """Log entries of the rows that a run has settled."""
    return steps_of(row_statuses(silver, quarantined), "processing", F.col("processing_status"), at=at)
