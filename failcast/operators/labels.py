"""Look-ahead labels and censoring around events.

A row is positive if an event follows within ``lead``: [T - lead, T). A row from an event to
``cooldown`` after it, both ends included, is censored and dropped, even if it is positive for
a later event. Membership in a union of such intervals is a matter of the nearest event on
either side, which two running windows give: no join of rows with intervals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from failcast.functions.scalars import micros
from failcast.operators.events import detect_oom_events, disappeared
from failcast.operators.histories import sliced, time_cuts
from failcast.operators.reshape import to_wide
from failcast.operators.windows import width
from failcast.schema import COOLDOWN_MINUTES, ENTITY, LABEL, LEAD_MINUTES, LONG_COLUMNS, TIME, require


def near_events(rows: DataFrame, events: DataFrame, *, by=ENTITY, time: str = TIME, rows_per_slice: int | None = None) -> DataFrame:
    """``rows`` with next_event_us (after the row) and last_event_us (at or before it).

    With ``rows_per_slice`` longer entities are cut into slices of time, each with the nearest event on either side.
    """
    mine = rows.select(F.struct(*[F.col(c) for c in rows.columns]).alias("__row"), *by, micros(rows, time).alias("__us"))
    marks = events.select(*by, micros(events, "event_ts").alias("__us"), F.lit(True).alias("__event"))
    both = mine.unionByName(marks, allowMissingColumns=True)
    keys, wanted = list(by), F.col("__row").isNotNull()
    cuts = None if rows_per_slice is None else time_cuts(both, by=by, time_col=None, longest=0, rows_per_slice=rows_per_slice)
    if cuts is not None:
        both = sliced(both, cuts, by=by, time_col=None, carried=F.col("__event"), ahead=F.col("__event"), first=False)
        keys, wanted = [*by, "__slice"], wanted & F.col("__own")
    over = Window.partitionBy(*keys).orderBy("__us")
    at = F.when(F.col("__event"), F.col("__us"))
    # Running frames: each is one pass, forwards or (by descending order) backwards.
    back = Window.partitionBy(*keys).orderBy(F.desc("__us"))
    after = F.min(at).over(back.rangeBetween(Window.unboundedPreceding, -1))
    before = F.max(at).over(over.rangeBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("next_event_us", after).withColumn("last_event_us", before).where(wanted)
    return found.select("__row.*", "next_event_us", "last_event_us")


def labelled(rows: DataFrame, events: DataFrame, *, lead="30min", cooldown="5min", by=ENTITY, time: str = TIME, label: str = LABEL, rows_per_slice: int | None = None) -> DataFrame:
    """``rows`` without the censored ones, with the label."""
    found = near_events(rows, events, by=by, time=time, rows_per_slice=rows_per_slice)
    us = micros(rows, time)
    ahead = F.coalesce(F.col("next_event_us") - us <= width(lead), F.lit(False))
    censored = F.coalesce(us - F.col("last_event_us") <= width(cooldown), F.lit(False))
    return found.where(~censored).withColumn(label, ahead.cast("tinyint")).drop("next_event_us", "last_event_us")


def _generate(long: DataFrame, events: DataFrame, lead_minutes: float, cooldown_minutes: float, metrics) -> DataFrame:
    return labelled(to_wide(long, metrics), events, lead=lead_minutes * 60, cooldown=cooldown_minutes * 60)


def generate_labels(long: DataFrame, *, lead_minutes: float = LEAD_MINUTES, cooldown_minutes: float = COOLDOWN_MINUTES, metrics=None) -> DataFrame:
    """Long frame -> labelled wide frame, from counters and gauges."""
    require(long, LONG_COLUMNS, "generate_labels")
    return _generate(long, detect_oom_events(long), lead_minutes, cooldown_minutes, metrics)


def generate_trace_labels(long: DataFrame, *, lead_minutes: float = LEAD_MINUTES, cooldown_minutes: float = COOLDOWN_MINUTES, metrics=None, **detector) -> DataFrame:
    """Long frame of the trace -> labelled wide frame, from disappearances."""
    require(long, LONG_COLUMNS, "generate_trace_labels")
    return _generate(long, disappeared(long, **detector), lead_minutes, cooldown_minutes, metrics)


def summary_columns(label: str = LABEL) -> dict[str, Column]:
    """Aggregates of a label summary that can be observed while a frame is written."""
    return {"n_positive": F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)), "n_labelled": F.count(label)}


def summarised(n_rows: int, n_positive: int, n_labelled: int, n_entities: int) -> dict:
    return {"n_rows": n_rows, "n_positive": int(n_positive), "positive_rate": round(n_positive / n_labelled, 4) if n_labelled else 0.0, "n_entities": n_entities}


def label_summary(rows: DataFrame, label: str = LABEL) -> dict:
    """Rows, positives, rate and entities, in one aggregate."""
    out = rows.agg(F.count("*").alias("n_rows"), *[c.alias(name) for name, c in summary_columns(label).items()], F.count_distinct(*ENTITY).alias("n_entities")).first()
    return summarised(out["n_rows"], out["n_positive"], out["n_labelled"], out["n_entities"])
