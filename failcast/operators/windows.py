"""Left-closed time windows, as-of lookups and growth, as window expressions.

A left-closed window of width w at time t holds the rows with t - w <= time < t: rows tied at
t never see each other. All expressions over the same keys and time share one exchange and
one sort when they are selected together, so put them into one ``withColumns``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from failcast.functions.scalars import MICRO, micros, null_if_nan, null_if_not_finite
from failcast.schema import require

AGGREGATES = ("mean", "max", "min", "std", "sum", "median", "count")
TINY = 1e-12
_UNITS = {"s": 1, "sec": 1, "min": 60, "h": 3600, "d": 86_400}


def width(text: str | int | float) -> int:
    """'5min', '1h', '7d', '90s' or seconds -> microseconds."""
    if isinstance(text, (int, float)):
        return int(text * MICRO)
    found = re.fullmatch(r"\s*(\d+)\s*([a-z]+)\s*", text)
    if not found or found[2] not in _UNITS:
        raise ValueError(f"unknown width {text!r}")
    return int(found[1]) * _UNITS[found[2]] * MICRO


def keyed(df: DataFrame, by, time: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(micros(df, time))


def rolled(value: str | Column, over: WindowSpec, window: str | int, agg: str) -> Column:
    """An aggregate over [t - window, t); null where no row is in it."""
    if agg not in AGGREGATES:
        raise ValueError(f"unknown aggregate {agg!r}")
    frame = over.rangeBetween(-width(window), -1)
    v = null_if_not_finite(value)
    if agg == "count":
        seen = F.count(null_if_nan(value)).over(frame)
        return F.when(F.count(F.lit(1)).over(frame) > 0, seen.cast("double"))
    made = {
        "mean": F.avg,
        "max": F.max,
        "min": F.min,
        "std": F.stddev_samp,
        "sum": F.sum,
        "median": lambda c: F.percentile(c, F.lit(0.5)),
    }[agg](v)
    return made.over(frame)


def value_before(value: str | Column, over: WindowSpec, window: str | int) -> Column:
    """The value of the last row at or before t - window, whether null or not."""
    return F.last(null_if_nan(value)).over(over.rangeBetween(Window.unboundedPreceding, -width(window)))


def growth(value: str | Column, over: WindowSpec, window: str | int) -> Column:
    """(v(t) - v(t - w)) / v(t - w); null where the earlier value is missing or about 0."""
    old, new = value_before(value, over, window), null_if_nan(value)
    return F.when(F.abs(old) > TINY, (new - old) / old)


def grouped_time_rolling(df: DataFrame, *, by, time_col: str, value_col: str, window: str | int, agg: str, new_col: str, rows_per_slice: int | None = None) -> DataFrame:
    """``df`` with a left-closed rolling aggregate. Medians come from ``long_frame_rolling``, whose time does not grow with the frames'.

    With ``rows_per_slice`` the histories of longer entities are cut into slices (see ``histories``).
    """
    from failcast.operators import histories

    require(df, [*by, time_col, value_col], "grouped_time_rolling")
    if agg == "median":
        return histories.long_frame_rolling(df, {new_col: (value_col, window, agg)}, by=by, time_col=time_col, rows_per_slice=rows_per_slice)
    return histories.with_windows(df, lambda over: {new_col: rolled(value_col, over, window, agg)}, by=by, time_col=time_col, longest=window, rows_per_slice=rows_per_slice)


def grouped_time_growth_rate(df: DataFrame, *, by, time_col: str, value_col: str, window: str | int, new_col: str, rows_per_slice: int | None = None) -> DataFrame:
    from failcast.operators import histories

    require(df, [*by, time_col, value_col], "grouped_time_growth_rate")
    return histories.with_windows(df, lambda over: {new_col: growth(value_col, over, window)}, by=by, time_col=time_col, longest=window, rows_per_slice=rows_per_slice)


def asof_join(left: DataFrame, right: DataFrame, *, by, time_col: str, values, tolerance: str | int | None = None, rows_per_slice: int | None = None) -> DataFrame:
    """Each row of ``left`` with the values of the last row of ``right`` at or before it, by key.

    One union and one window instead of an inequality join: rows are never paired. A row of
    ``right`` at the same time counts. Null values are taken as they are. With ``rows_per_slice``
    longer keys are cut into slices, each of which starts with the last row of ``right`` before it.
    """
    from failcast.operators import histories

    mine = left.withColumn("__side", F.lit(1)).withColumn("__row", F.struct(*[F.col(c) for c in left.columns]))
    packed = F.struct(micros(right, time_col).alias("us"), *[F.col(c) for c in values])
    theirs = right.select(*by, micros(right, time_col).alias("__us"), F.lit(0).alias("__side"), packed.alias("__found"))
    both = mine.select(*by, micros(left, time_col).alias("__us"), "__side", "__row").unionByName(theirs, allowMissingColumns=True)
    keys, wanted = list(by), F.col("__side") == 1
    cuts = None if rows_per_slice is None else histories.time_cuts(both, by=by, time_col=None, longest=0, rows_per_slice=rows_per_slice)
    if cuts is not None:
        both = histories.sliced(both, cuts, by=by, time_col=None, carried=F.col("__side") == 0, first=False)
        keys, wanted = [*by, "__slice"], wanted & F.col("__own")
    order = Window.partitionBy(*keys).orderBy("__us", "__side").rowsBetween(Window.unboundedPreceding, 0)
    matched = both.withColumn("__last", F.last("__found", ignorenulls=True).over(order)).where(wanted)
    near = F.lit(True) if tolerance is None else F.col("__us") - F.col("__last.us") <= width(tolerance)
    return matched.select("__row.*", *[F.when(near, F.col(f"__last.`{c}`")).alias(c) for c in values])


def merged_intervals(df: DataFrame, *, by, start: str, end: str) -> DataFrame:
    """Unions of intervals that touch or overlap, per key."""
    order = Window.partitionBy(*by).orderBy(start, end)
    reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0)
    marked = df.withColumn("__fresh", fresh)
    islands = marked.withColumn("__island", F.sum("__fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*by, "__island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__island")
