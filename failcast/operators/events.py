"""Failure events from metric streams: (pod_uid, container, event_ts, source)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from failcast.functions.scalars import micros, null_if_nan
from failcast.operators.windows import MICRO
from failcast.schema import ENTITY, HEARTBEAT, HEARTBEATS, LONG_COLUMNS, OOM_COUNTER, OOM_GAUGE, SATURATED_PERCENT, SILENCE_SECONDS, TIME, require

# What an event's source column says; the first wins where both are seen at once.
FROM_COUNTER = "oom_events_total"
FROM_GAUGE = "ksm_last_terminated_reason"
FROM_SILENCE = "alibaba_disappearance+mem="


def _with_previous(long: DataFrame, metric: str) -> DataFrame:
    rows = long.where(F.col("metric_name") == metric)
    order = Window.partitionBy("metric_name", *ENTITY).orderBy(micros(long, TIME))
    value = null_if_nan("value")
    return rows.select(*ENTITY, F.col(TIME).alias("event_ts"), value.alias("now"), F.lag(value).over(order).alias("before"))


def counter_increases(long: DataFrame, metric: str = OOM_COUNTER) -> DataFrame:
    """A counter that grew. The first sample never fires, nor does a reset."""
    rows = _with_previous(long, metric).where(F.col("now") > F.col("before"))
    return rows.select(*ENTITY, "event_ts", F.lit(FROM_COUNTER).alias("source"))


def gauge_edges(long: DataFrame, metric: str = OOM_GAUGE) -> DataFrame:
    """A gauge that rose to 1. A first sample of 1 fires: before it counts as 0."""
    rows = _with_previous(long, metric).where((F.col("now") >= 1) & (F.coalesce("before", F.lit(0.0)) < 1))
    return rows.select(*ENTITY, "event_ts", F.lit(FROM_GAUGE).alias("source"))


def preferred(events: DataFrame, sources=(FROM_COUNTER, FROM_GAUGE)) -> DataFrame:
    """One event per entity and time; earlier ``sources`` win. An aggregate, not a window: partial before the exchange."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source")), F.lit(len(sources) + 1))
    return events.groupBy(*ENTITY, "event_ts").agg(F.min_by("source", rank).alias("source"))


def detect_oom_events(long: DataFrame) -> DataFrame:
    """Counter increases and gauge edges, once each."""
    require(long, LONG_COLUMNS, "detect_oom_events")
    return preferred(counter_increases(long).unionByName(gauge_edges(long)))


def disappeared(long: DataFrame, *, metric: str = HEARTBEAT, silence_seconds: float = SILENCE_SECONDS, saturated: float = SATURATED_PERCENT, heartbeats: int = HEARTBEATS) -> DataFrame:
    """Entities whose heartbeat ended over ``silence_seconds`` before the trace did, while the
    mean of its last samples was at least ``saturated``. The event is the last heartbeat.

    The trace's end is the last time of any heartbeat, one number joined to every row.
    """
    require(long, LONG_COLUMNS, "disappeared")
    beats = long.where(F.col("metric_name") == metric).select(*ENTITY, TIME, null_if_nan("value").alias("value"))
    us = micros(beats, TIME)
    newest = Window.partitionBy(*ENTITY).orderBy(us.desc(), F.desc("value"))
    last = beats.withColumn("__n", F.row_number().over(newest)).where(F.col("__n") <= heartbeats)
    ends = last.groupBy(*ENTITY).agg(F.max(TIME).alias("event_ts"), F.avg("value").alias("level"))
    trace_end = beats.agg(F.max(us).alias("trace_end"))
    rows = ends.crossJoin(F.broadcast(trace_end))  # one row
    silent = F.col("trace_end") - micros(ends, "event_ts") > F.lit(int(silence_seconds * MICRO))
    rows = rows.where(silent & (F.col("level") >= saturated))
    return rows.select(*ENTITY, "event_ts", F.concat(F.lit(FROM_SILENCE), F.format_string("%.1f", F.bround("level", 1))).alias("source"))
