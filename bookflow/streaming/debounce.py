"""Quiet-period detection: one event per key after a time of silence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookflow.options import DEFAULTS

QUIET_SECONDS = DEFAULTS.debounce_seconds


def debounce(events: DataFrame, key: str, ts: str, quiet_seconds: float = QUIET_SECONDS) -> DataFrame:
    """(key, first_ts, last_ts, events, fires_at) of every burst; an event ends the wait of the one before it when it
    comes less than ``quiet_seconds`` later.

    Events of a key inside one time slot as long as the quiet period belong together whatever comes between, so
    they are merged first, map-side. What reaches the window per key is one row per slot, also for a key that holds a
    third of all events.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    quiet = int(quiet_seconds * 1_000_000)
    slots = (
        events.select(F.col(key).alias("key"), micros.alias("at"))
        .groupBy("key", F.floor(F.col("at") / quiet).alias("slot"))
        .agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n"))
    )
    order = Window.partitionBy("key").orderBy("slot")
    starts = F.coalesce(F.col("first") - F.lag("last").over(order) >= quiet, F.lit(True))
    bursts = slots.withColumn("starts", starts.cast("int")).withColumn("burst", F.sum("starts").over(order))
    return bursts.groupBy("key", "burst").agg(
        F.timestamp_micros(F.min("first")).alias("first_ts"),
        F.timestamp_micros(F.max("last")).alias("last_ts"),
        F.sum("n").alias("events"),
        F.timestamp_micros(F.max("last") + quiet).alias("fires_at"),
    ).drop("burst")


def debounce_stream(
    events: DataFrame, key: str, ts: str, quiet_seconds: float = QUIET_SECONDS, late: str = "10 seconds"
) -> DataFrame:
    """The same over a stream: a burst is emitted once the watermark has passed its quiet period. When a stream has ended
    for good, ``debounce_rest`` gives the bursts that nothing came after."""
    session = F.session_window(ts, f"{int(quiet_seconds * 1000)} milliseconds")
    return (
        events.withWatermark(ts, late)
        .groupBy(F.col(key).alias("key"), session.alias("burst"))
        .agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count("*").alias("events"))
        .select("key", "first_ts", "last_ts", "events", F.col("burst.end").alias("fires_at"))
    )


def debounce_rest(
    events: DataFrame, emitted: DataFrame, key: str, ts: str, quiet_seconds: float = QUIET_SECONDS
) -> DataFrame:
    """Bursts that a finished stream has not emitted: those of the events behind each key's last emitted burst."""
    last = emitted.groupBy(F.col("key").alias("_key")).agg(F.max("last_ts").alias("_last"))
    met = events.join(last, F.col(key).eqNullSafe(F.col("_key")), "left")
    rest = met.filter(F.col("_last").isNull() | (F.col(ts) > F.col("_last"))).select(*events.columns)
    return debounce(rest, key, ts, quiet_seconds)


def windowed_totals(
    events: DataFrame, ts: str, by: list[str], measure: str, size: str = "1 hour", late: str = "10 seconds"
) -> DataFrame:
    """(window_start, by, events, total) of tumbling windows, over a stream or a table.

    On a stream a window is emitted once the watermark has passed its end; its state is a row per open window and key,
    combined before the shuffle.
    """
    timed = events.withWatermark(ts, late) if events.isStreaming else events
    return (
        timed.groupBy(F.window(ts, size).alias("w"), *by).agg(F.count("*").alias("events"), F.sum(measure).alias("total"))
        .select(F.col("w.start").alias("window_start"), *by, "events", "total")
    )


def windowed_rest(
    events: DataFrame, emitted: DataFrame, ts: str, by: list[str], measure: str, size: str = "1 hour"
) -> DataFrame:
    """Windows that a finished stream has not emitted. Windows close in the order of time, so these are the ones behind the
    last emitted window, and only events from there on are read."""
    closed = emitted.agg((F.max("window_start") + F.expr(f"INTERVAL {size}")).alias("at")).first()["at"]
    return windowed_totals(events if closed is None else events.filter(F.col(ts) >= F.lit(closed)), ts, by, measure, size)
