"""The cluster trace's header-less CSVs as long frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from failcast.operators.reshape import one_hot, to_long_schema, unpivoted
from failcast.schema import ALIGNED_DAYS, CONTAINER_META_COLS, CONTAINER_USAGE_COLS, DAY_SECONDS, DISK_SENTINELS, META_METRICS, TIME, TRACE_NAMESPACE, TRACE_ORIGIN_SECONDS, USAGE_METRICS, ContractError
from failcast.sources.files import exists, read_headless_csv, write_parquet


def trace_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.cast("long") + TRACE_ORIGIN_SECONDS)


def aligned_days(rows: DataFrame, seconds: str = "time_stamp") -> DataFrame:
    """Days that all of the trace's tables cover: [first day, day after the last)."""
    at = F.col(seconds).try_cast("double")
    return rows.where((at >= ALIGNED_DAYS[0] * DAY_SECONDS) & (at < (ALIGNED_DAYS[1] + 1) * DAY_SECONDS))


def _identified(rows: DataFrame) -> DataFrame:
    container = F.col("container_id")
    return rows.withColumns({TIME: trace_time(F.col("time_stamp").try_cast("double")), "namespace": F.lit(TRACE_NAMESPACE), "pod": container, "pod_uid": container, "container": container, "node": F.col("machine_id")})


_IDS = (TIME, "namespace", "pod", "pod_uid", "container", "node")


def usage_long(rows: DataFrame) -> DataFrame:
    """Usage rows -> eight metric rows each; invalid disk values go, the row's other metrics stay."""
    long = unpivoted(_identified(aligned_days(rows)), _IDS, USAGE_METRICS)
    disk = F.col("metric_name") == USAGE_METRICS["disk_io_percent"]
    return to_long_schema(long.where(~(disk & F.col("value").isin(*DISK_SENTINELS))))


def meta_long(rows: DataFrame) -> DataFrame:
    """Meta rows -> three numeric metrics and one 0/1 metric for each status seen."""
    own = _identified(aligned_days(rows))
    numbers = unpivoted(own, _IDS, META_METRICS)
    return to_long_schema(numbers).unionByName(to_long_schema(one_hot(own, "status")))


def harmonise(spark: SparkSession, source: str, out: str | None = None) -> dict[str, DataFrame]:
    """container_usage.csv and container_meta.csv under ``source`` -> long frames, written under ``out`` if given."""
    made = {}
    for name, columns, shape in (("container_usage", CONTAINER_USAGE_COLS, usage_long), ("container_meta", CONTAINER_META_COLS, meta_long)):
        if exists(spark, f"{source}/{name}.csv"):
            made[name] = shape(read_headless_csv(spark, f"{source}/{name}.csv", columns))
            if out:
                write_parquet(made[name], f"{out}/{name}.parquet")
    if not made:
        raise ContractError(f"harmonise: no trace table under {source}")
    return made
