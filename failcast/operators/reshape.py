"""Long to wide and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from failcast.functions.scalars import null_if_nan
from failcast.schema import ENTITY, LONG_COLUMNS, LONG_SCHEMA, METRIC_COLUMNS, STATUS_PREFIX, TIME, require

KEYS = (TIME, *ENTITY)
CARRIED = ("namespace", "pod", "node")


def to_wide(long: DataFrame, metrics=None, order: Column | None = None) -> DataFrame:
    """One row per (time, pod_uid, container), one double column per metric.

    One aggregate makes values and carried labels, with partial aggregation before its only
    exchange. Repeated samples are settled by ``order`` (the smallest is taken; by default
    the value itself), so the result does not depend on how rows are dealt. A key with no value at all
    has no row; catalogue metrics that do not occur are null columns. Without ``metrics``, the
    names are looked up in the data once.
    """
    require(long, LONG_COLUMNS, "to_wide")
    if metrics is None:
        found = [r[0] for r in long.where(F.col("metric_name").isNotNull()).select("metric_name").distinct().collect()]
        metrics = sorted(set(found) | set(METRIC_COLUMNS))
    value = null_if_nan("value")
    by = value if order is None else order
    picked = [F.min_by(value, F.when((F.col("metric_name") == m) & value.isNotNull(), by)).alias(m) for m in metrics]
    carried = [F.min(c).alias(c) for c in CARRIED]
    keyed = long.where(F.col(TIME).isNotNull() & F.col("pod_uid").isNotNull() & F.col("container").isNotNull())
    wide = keyed.groupBy(*KEYS).agg(*carried, *picked, F.count(value).alias("__values"))
    return wide.where("__values > 0").drop("__values")


def unpivoted(rows: DataFrame, ids, names: dict[str, str]) -> DataFrame:
    """One wide row -> one row per metric that has a value; text that is no number has none."""
    wide = rows.select(*ids, *[F.col(c).try_cast("double").alias(m) for c, m in names.items()])
    return wide.unpivot(list(ids), list(names.values()), "metric_name", "value").where(null_if_nan("value").isNotNull())


def one_hot(rows: DataFrame, column: str, prefix: str = STATUS_PREFIX) -> DataFrame:
    """Every row with every value of ``column`` seen: a metric row that is 1 where they agree, else 0.

    The distinct values are one row, an array of them, so no rows are shuffled against each other.
    """
    seen = rows.agg(F.array_sort(F.collect_set(column)).alias("__all"))
    paired = rows.crossJoin(F.broadcast(seen)).withColumn("__seen", F.explode("__all")).drop("__all")
    return paired.withColumn("metric_name", F.concat(F.lit(prefix), F.col("__seen"))).withColumn("value", (F.col(column) == F.col("__seen")).cast("double")).drop("__seen")


def to_long_schema(df: DataFrame) -> DataFrame:
    """Columns, order and types of the long frame."""
    require(df, LONG_COLUMNS, "to_long_schema")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LONG_SCHEMA])
