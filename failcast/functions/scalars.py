"""Column expressions: time keys, null rules, guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICRO = 1_000_000


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since the epoch, whatever the session's time zone is."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    return F.unix_micros(F.col(ts))


def null_if_nan(c: str | Column) -> Column:
    """NaN counts as missing everywhere in the engine."""
    return F.when(~F.isnan(col_(c)), col_(c))


def null_if_not_finite(c: str | Column) -> Column:
    """Sliding aggregates but the count leave out infinities too."""
    return F.when(F.abs(col_(c)) < float("inf"), col_(c))


def guarded_ratio(top: str | Column, bottom: str | Column) -> Column:
    """top / bottom where bottom is over 0, else null."""
    return F.when(col_(bottom) > 0, col_(top) / col_(bottom))


def fraction(percent: str | Column) -> Column:
    return col_(percent) / F.lit(100.0)


def clip(c: str | Column, low: float | None = None, high: float | None = None) -> Column:
    """Clip that keeps null (greatest and least would skip it)."""
    out = col_(c)
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(col_(c).isNotNull(), out)


def sigmoid(c: str | Column) -> Column:
    return 1 / (1 + F.exp(-col_(c)))


def prior_corrected(p: str | Column, sample_ratio: float, *, clipped: bool = True) -> Column:
    """Probability under the true prior after negatives were kept at ``sample_ratio``.

    ``p`` is clipped to [1e-12, 1 - 1e-12]; with ``clipped`` False the formula takes any number as it is, and is infinite
    where it divides by 0.
    """
    if not 0 < sample_ratio <= 1:
        raise ValueError("sample_ratio must be over 0 and at most 1")
    if sample_ratio == 1:
        return col_(p).cast("double")
    p = col_(p).cast("double")
    safe = clip(p, 1e-12, 1 - 1e-12) if clipped else p
    below = safe + (1 - safe) / F.lit(float(sample_ratio))
    return safe / below if clipped else F.when(below == 0, F.signum(safe) * F.lit(float("inf"))).otherwise(safe / below)


def lineage(pod: str | Column) -> Column:
    """A pod's name without its last ``-`` segment."""
    return F.regexp_replace(col_(pod), "-[^-]*$", "")


def calendar(ts: str | Column) -> dict[str, Column]:
    """Hour, weekday (Monday 0), weekend and business-hours flags."""
    hour, day = F.hour(col_(ts)), F.weekday(col_(ts))
    return {
        "feat_hour_of_day": hour.cast("tinyint"),
        "feat_day_of_week": day.cast("tinyint"),
        "feat_is_weekend": (day >= 5).cast("tinyint"),
        "feat_is_business_hours": ((day < 5) & (hour >= 9) & (hour < 18)).cast("tinyint"),
    }
