"""Windows over entities with very long histories, in slices of time.

A window that is partitioned by entity alone is one task for one entity, however long its history.
Entities with more than ``rows_per_slice`` rows are cut into slices of time at quantiles of their own
times, and windows are partitioned by (entity, slice). So that every frame sees what it would
see without the cut, a slice also gets, marked as not its own:

* halo rows: those of the slice before that are within the longest frame of its start. Slices are no
  shorter than the longest frame, so a row is copied once at most;
* carried rows: the last row before the halo (for lookups of a last value) and the entity's first
  row (for running minima of time); for lookups ahead, the first row of later slices.

The rows of other entities stay in one slice each. Cuts are found by counts and by quantile sketches, both
summed up before they move. They are at most ``MOST_CUTS`` numbers, which is why they
may be brought to the driver and broadcast: beyond, slices get longer instead.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from failcast.deploy import ship
from failcast.functions.scalars import micros
from failcast.operators import frames
from failcast.operators.windows import AGGREGATES, keyed, width
from failcast.schema import require

SLICE_ROWS = 1_000_000
MOST_CUTS = 500_000
#: Slices that one entity is cut into at most.
MOST_SLICES = 8_192
_OWN, _SLICE, _US, _CUTS = "__own", "__slice", "__us", "__cuts"


def _same(by, prefix: str) -> Column:
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return same


def _named(df: DataFrame, by, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in by})


def thinned(cuts: list[int], least: int) -> list[int]:
    """Increasing cuts, none nearer to the one before than ``least``."""
    out: list[int] = []
    for c in sorted(set(cuts)):
        if not out or c - out[-1] >= least:
            out.append(c)
    return out


def time_cuts(df: DataFrame, *, by, time_col: str | None, longest: int, rows_per_slice: int = SLICE_ROWS) -> DataFrame | None:
    """(by..., __cuts array<long>) for every entity of more than ``rows_per_slice`` rows; None if there is none.

    ``longest`` is the longest frame in microseconds. A row at a cut is in the slice after it. With
    ``time_col`` None there is a __us already.
    """
    keys = df.select(*by, (F.col(_US) if time_col is None else micros(df, time_col)).alias(_US))
    hot = keys.groupBy(*by).agg(F.count("*").alias("__n")).where(F.col("__n") > rows_per_slice)
    largest, total = hot.agg(F.max("__n"), F.sum("__n")).first()
    if largest is None:
        return None
    rows = max(rows_per_slice, math.ceil(total / MOST_CUTS))
    n = min(MOST_SLICES, math.ceil(largest / rows))
    # At most total / rows_per_slice entities.
    own = keys.join(F.broadcast(_named(hot, by, "__h_")), _same(by, "__h_")).groupBy(*by, "__n").agg(F.percentile_approx(_US, [i / n for i in range(1, n)] or [0.5], 20 * n).alias("__grid"))
    # An entity of fewer rows than the largest keeps every so many of the grid's quantiles.
    every = F.greatest(F.lit(1), F.floor(F.lit(n * rows) / F.col("__n"))).cast("int")
    found = own.select(*by, F.filter("__grid", lambda c, i: (i + 1) % every == 0).alias(_CUTS)).collect()
    made = [(*[r[c] for c in by], thinned(r[_CUTS], max(1, longest))) for r in found]
    return df.sparkSession.createDataFrame(made, df.select(*by).schema.add(_CUTS, T.ArrayType(T.LongType())))


def _with_cuts_up_to(df: DataFrame, name: str, us: Column, most: int) -> DataFrame:
    """``df`` with the number of a row's cuts at or before a time, by halving; 0 without cuts.

    Each step is a projection of its own that generated code runs through, so no row copies its cuts.
    """
    out = df.withColumn(name, F.lit(0))
    for step in (1 << k for k in reversed(range(max(1, most).bit_length()))):
        out = out.withColumn(name, F.col(name) + F.when(F.get(_CUTS, F.col(name) + step - 1) <= us, step).otherwise(0))
    return out


def sliced(df: DataFrame, cuts: DataFrame, *, by, time_col: str | None, longest: int = 0, carried: Column | None = None, ahead: Column | None = None, first: bool = True) -> DataFrame:
    """``df`` with __us, __slice and __own, and the halo and carried rows of every slice.

    ``carried`` says which rows a lookup back may need, all by default; rows that a lookup ahead
    may need are those of ``ahead``; ``first`` carries the entity's first row. With ``time_col`` None there is a __us already.
    """
    rows = df if time_col is None else df.withColumn(_US, micros(df, time_col))
    most = cuts.agg(F.max(F.size(_CUTS))).first()[0] or 0
    marked = rows.join(F.broadcast(_named(cuts, by, "__c_")), _same(by, "__c_"), "left").drop(*[f"__c_{c}" for c in by])
    # Slices 0 to b of a row have it in reach or before them; b is where the halo of the next begins.
    marked = _with_cuts_up_to(marked, _SLICE, F.col(_US), most)
    marked = _with_cuts_up_to(marked, "__b", F.col(_US) + longest, most) if longest else marked.withColumn("__b", F.col(_SLICE))
    # An entity's cuts are far larger than a row: they go before anything sorts, moves or explodes it.
    marked = marked.withColumn("__n", F.when(F.col(_CUTS).isNotNull(), F.size(_CUTS))).drop(_CUTS)
    place = lambda k, own: F.struct(k.alias(_SLICE), F.lit(own).alias(_OWN))
    here = F.array(place(F.col(_SLICE), True))
    both = F.concat(here, F.array(place(F.col(_SLICE) + 1, False)))
    placed = marked.withColumn("__at", F.explode(F.when(F.col("__b") > F.col(_SLICE), both).otherwise(here)) if longest else here[0])
    out = placed.select(*rows.columns, f"__at.{_SLICE}", f"__at.{_OWN}")

    held = marked.where(F.col("__n").isNotNull())
    row = F.struct(*[F.col(c) for c in rows.columns])
    order = Window.partitionBy(*by).orderBy("__b")
    spans = []
    back = held.where(carried) if carried is not None else held
    back = back.groupBy(*by, "__b").agg(F.max_by(row, _US).alias("__row"), F.max("__n").alias("__n"))
    spans.append(back.withColumns({"__from": F.col("__b") + 1, "__to": F.coalesce(F.lead("__b").over(order), F.col("__n"))}))
    if first:
        start = held.groupBy(*by).agg(F.min_by(row, _US).alias("__row"), F.max("__n").alias("__n"), F.min("__b").alias("__b"))
        spans.append(start.withColumns({"__from": F.col("__b") + 1, "__to": F.col("__n")}))
    if ahead is not None:
        later = held.where(ahead).groupBy(*by, F.col(_SLICE).alias("__b")).agg(F.min_by(row, _US).alias("__row"))
        spans.append(later.withColumns({"__from": F.coalesce(F.lag("__b").over(order), F.lit(0)), "__to": F.col("__b") - 1}))
    for s in spans:
        more = s.where(F.col("__from") <= F.col("__to")).withColumn(_SLICE, F.explode(F.sequence("__from", "__to")))
        out = out.unionByName(more.select("__row.*", _SLICE, F.lit(False).alias(_OWN)))
    return out


def with_windows(df: DataFrame, columns: Callable[[WindowSpec], dict[str, Column]], *, by, time_col: str, longest: str | int, rows_per_slice: int | None = SLICE_ROWS) -> DataFrame:
    """``df`` with the window columns that ``columns`` makes for a window over an entity's time.

    Frames may reach back by ``longest`` at most, or be lookups of a last row, or running minima of time.
    With ``rows_per_slice`` None, or where no entity has more rows, this is a plain window.
    """
    require(df, [*by, time_col], "with_windows")
    cuts = None if rows_per_slice is None else time_cuts(df, by=by, time_col=time_col, longest=width(longest), rows_per_slice=rows_per_slice)
    if cuts is None:
        return df.withColumns(columns(keyed(df, by, time_col)))
    rows = sliced(df, cuts, by=by, time_col=time_col, longest=width(longest))
    over = Window.partitionBy(*by, _SLICE).orderBy(_US)
    return rows.withColumns(columns(over)).where(_OWN).drop(_OWN, _SLICE, _US)


def long_frame_rolling(df: DataFrame, specs: dict[str, tuple[str, str | int, str]], *, by, time_col: str, rows_per_slice: int | None = SLICE_ROWS // 4, age_col: str | None = None) -> DataFrame:
    """``df`` with left-closed rolling aggregates whose frames may hold very many rows: new column -> (value, window, aggregate).

    ``age_col`` names a column of seconds since the entity's first row.

    Frames are not evaluated row by row: each slice of an entity is one Arrow table, in which sums and
    extremes come from blocks of doubling length and medians from a wavelet matrix, all in
    time near linear. Results are those of ``rolled``.
    """
    require(df, [*by, time_col, *[v for v, _, _ in specs.values()]], "long_frame_rolling")
    for _, _, agg in specs.values():
        if agg not in AGGREGATES:
            raise ValueError(f"unknown aggregate {agg!r}")
    ship(df.sparkSession)
    longest = max(width(w) for _, w, _ in specs.values())
    cuts = None if rows_per_slice is None else time_cuts(df, by=by, time_col=time_col, longest=longest, rows_per_slice=rows_per_slice)
    if cuts is None:
        rows = df.withColumns({_US: micros(df, time_col), _SLICE: F.lit(0), _OWN: F.lit(True)})
    else:
        # Frames end within the halo, so only the first row is carried.
        rows = sliced(df, cuts, by=by, time_col=time_col, longest=longest, carried=F.lit(False), first=age_col is not None)
    columns = list(dict.fromkeys(v for v, _, _ in specs.values()))
    names = [f"__v{i}" for i in range(len(columns))]
    asked = [(name, names[columns.index(v)], width(w), agg) for name, (v, w, agg) in specs.items()]
    schema = T.StructType([*df.schema.fields, *[T.StructField(name, T.DoubleType()) for name in [*specs, *([age_col] if age_col else [])]]])

    def run(part: pa.Table) -> pa.Table:
        us = part.column(_US).to_numpy()
        own = part.column(_OWN)
        numbers = {c: part.column(c).to_numpy().astype(float) for c in names}
        found = frames.rolled(us, [(numbers[c], w, agg) for _, c, w, agg in asked])
        out = part.drop_columns([_US, _SLICE, _OWN, *names])
        for (name, *_), column in zip(asked, found, strict=True):
            out = out.append_column(name, pa.array(column, pa.float64(), from_pandas=True))
        if age_col:
            out = out.append_column(age_col, pa.array((us - (pc.min(part.column(_US)).as_py() or 0)) / 1e6, pa.float64(), from_pandas=True))
        return out.filter(own)

    return rows.withColumns({n: F.col(c).cast("double") for n, c in zip(names, columns, strict=True)}).groupBy(*by, _SLICE).applyInArrow(run, schema)
