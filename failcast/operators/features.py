"""The 28 model features as window expressions over three keys.

All features of an entity are selected at once and share one exchange and one sort. Node
pressure is one aggregate per (time, node) joined back. Lineage history is aggregated to
(lineage, time) first, so a lineage of many pods is no larger a window than one of few; its
counts are whole numbers, so differences of running sums are exact.

``dispatch`` says which source a memory or CPU value comes from where both have columns:
"frame" takes the trace's column for all rows, "row" takes the first that has a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from failcast.functions.scalars import MICRO, calendar, clip, fraction, guarded_ratio, lineage, micros, null_if_nan
from failcast.operators.histories import with_windows
from failcast.operators.windows import growth, keyed, rolled, width
from failcast.schema import ENTITY, IDENTITY, LABEL, TIME, USAGE_METRICS, ContractError, require

WORKING_SET, RSS, FAILURES = "container_memory_working_set_bytes", "container_memory_rss", "container_memory_failcnt"
MEMORY_LIMIT = "kube_pod_container_resource_limits_memory_bytes"
CPU, THROTTLED, PERIODS = "container_cpu_usage_seconds_rate", "container_cpu_throttled_periods_rate", "container_cpu_periods_rate"
RESTARTS = "kube_pod_container_status_restarts_total"
TRACE_MEMORY, TRACE_CPU = USAGE_METRICS["mem_util_percent"], USAGE_METRICS["cpu_util_percent"]
MEMORY_WINDOWS, CPU_WINDOWS = ("5min", "15min", "30min"), ("5min", "15min")
#: The longest frame of an entity's features, that of restarts.
LONGEST = "1h"
PREFIX = "feat_"


def value_of(df: DataFrame, name: str) -> Column:
    return null_if_nan(F.col(name).cast("double")) if name in df.columns else F.lit(None).cast("double")


def _dispatched(df: DataFrame, trace_column: str, trace: Column, own: Column, dispatch: str) -> Column:
    if dispatch not in ("frame", "row"):
        raise ValueError("dispatch must be 'frame' or 'row'")
    if trace_column not in df.columns:
        return own
    return trace if dispatch == "frame" else F.coalesce(trace, own)


def memory_share(df: DataFrame, dispatch: str = "frame") -> Column:
    own = guarded_ratio(value_of(df, WORKING_SET), value_of(df, MEMORY_LIMIT))
    return _dispatched(df, TRACE_MEMORY, fraction(value_of(df, TRACE_MEMORY)), own, dispatch)


def cpu_share(df: DataFrame, dispatch: str = "frame") -> Column:
    return _dispatched(df, TRACE_CPU, fraction(value_of(df, TRACE_CPU)), value_of(df, CPU), dispatch)


def add_temporal_features(df: DataFrame) -> DataFrame:
    require(df, [TIME], "add_temporal_features")
    return df.withColumns(calendar(TIME))


def add_mem_pct_of_limit(df: DataFrame, dispatch: str = "frame") -> DataFrame:
    return df.withColumn("feat_mem_pct_of_limit", memory_share(df, dispatch))


def _spread(df: DataFrame, over: WindowSpec, name: str, window: str) -> Column:
    """Largest less smallest in the window."""
    return rolled(value_of(df, name), over, window, "max") - rolled(value_of(df, name), over, window, "min")


def _memory(df: DataFrame, over: WindowSpec) -> dict[str, Column]:
    share = "feat_mem_pct_of_limit"
    out = {f"{share}__{w}_{a}": rolled(share, over, w, a) for w in MEMORY_WINDOWS for a in ("mean", "max")}
    out |= {f"feat_mem_growth_rate__{w}": growth(share, over, w) for w in MEMORY_WINDOWS}
    return out | _lab_memory(df, over)


def rss_gap(df: DataFrame) -> Column:
    return guarded_ratio(value_of(df, WORKING_SET) - value_of(df, RSS), value_of(df, MEMORY_LIMIT))


def _lab_memory(df: DataFrame, over: WindowSpec) -> dict[str, Column]:
    return {
        "feat_mem_ws_rss_gap_pct": rss_gap(df),
        "feat_mem_failcnt__5min_rate": _spread(df, over, FAILURES, "5min") if FAILURES in df.columns else F.lit(None).cast("double"),
    }


def _cpu(over: WindowSpec) -> dict[str, Column]:
    return {f"{c}__{w}_mean": rolled(c, over, w, "mean") for w in CPU_WINDOWS for c in ("feat_cpu_util", "feat_cpu_throttle_ratio")}


def _lifecycle(df: DataFrame, over: WindowSpec) -> dict[str, Column]:
    us = micros(df, TIME)
    first = F.min(us).over(over.rangeBetween(Window.unboundedPreceding, 0))
    return {
        "feat_pod_age_sec": (us - first) / F.lit(float(MICRO)),
        "feat_restart_rate_1h": clip(_spread(df, over, RESTARTS, "1h"), low=0.0) if RESTARTS in df.columns else F.lit(None).cast("double"),
    }


def add_synth_only_features(df: DataFrame) -> DataFrame:
    return df.withColumns(_lab_memory(df, keyed(df, ENTITY, TIME)))


def add_memory_features(df: DataFrame, dispatch: str = "frame") -> DataFrame:
    out = add_mem_pct_of_limit(df, dispatch)
    return out.withColumns(_memory(out, keyed(out, ENTITY, TIME)))


def throttle_ratio(df: DataFrame) -> Column:
    return guarded_ratio(value_of(df, THROTTLED), value_of(df, PERIODS))


def add_cpu_throttle_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("feat_cpu_throttle_ratio", throttle_ratio(df))


def add_cpu_features(df: DataFrame, dispatch: str = "frame") -> DataFrame:
    out = add_cpu_throttle_ratio(df.withColumn("feat_cpu_util", cpu_share(df, dispatch)))
    return out.withColumns(_cpu(keyed(out, ENTITY, TIME)))


def add_lifecycle_features(df: DataFrame) -> DataFrame:
    return df.withColumns(_lifecycle(df, keyed(df, ENTITY, TIME)))


def add_node_cotenant_features(df: DataFrame) -> DataFrame:
    """Sum, maximum and number of memory shares on the row's node at its time; null without a node."""
    require(df, [TIME, "node", "feat_mem_pct_of_limit"], "add_node_cotenant_features")
    share = F.col("feat_mem_pct_of_limit")
    per_node = df.where(F.col("node").isNotNull()).groupBy(F.col(TIME).alias("__time"), F.col("node").alias("__node")).agg(
        F.coalesce(F.sum(share), F.lit(0.0)).alias("feat_node_mem_pct_sum"),
        F.max(share).alias("feat_node_mem_pct_max"),
        F.count(share).alias("feat_node_n_containers"),
    )
    return df.join(per_node, (F.col(TIME) == F.col("__time")) & (F.col("node") == F.col("__node")), "left").drop("__time", "__node")


def lineage_key(df: DataFrame) -> Column:
    named = lineage("pod")
    return F.coalesce(F.col("app_du").cast("string"), F.col("pod")) if "app_du" in df.columns and not df.where("app_du is not null").isEmpty() else named


def lineage_rate(df: DataFrame, *, key: Column, time: str = TIME, label: str = LABEL, window: str = "24h") -> DataFrame:
    """``df`` with the share of positive rows of the same lineage in the window before; null where there are none."""
    keyed_rows = df.withColumn("__lineage", key).withColumn("__us", micros(df, time))
    known = F.col(label).isNotNull()
    sums = keyed_rows.where(F.col("__lineage").isNotNull()).groupBy(F.col("__lineage").alias("__l"), F.col("__us").alias("__u")).agg(F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("__p"), F.count_if(known).alias("__n"))
    over = Window.partitionBy("__l").orderBy("__u")

    def running(c: str, to: int) -> Column:
        return F.coalesce(F.sum(c).over(over.rangeBetween(Window.unboundedPreceding, to)), F.lit(0))

    w = width(window)
    rates = sums.select("__l", "__u", (running("__p", -1) - running("__p", -w - 1)).alias("__pw"), (running("__n", -1) - running("__n", -w - 1)).alias("__nw"))
    out = keyed_rows.join(rates, (F.col("__lineage") == F.col("__l")) & (F.col("__us") == F.col("__u")), "left")
    rate = F.when(F.col("__nw") > 0, F.col("__pw") / F.col("__nw"))
    return out.withColumn("feat_lineage_24h_oom_rate", rate).drop("__lineage", "__us", "__l", "__u", "__pw", "__nw")


def add_aggregation_features(df: DataFrame, label: str = LABEL) -> DataFrame:
    require(df, [label, "pod"], "add_aggregation_features")
    out = add_node_cotenant_features(df)
    return lineage_rate(out, key=lineage_key(out), label=label)


def build_features(wide: DataFrame, *, dispatch: str = "frame", label: str = LABEL, check_empty: bool = True, rows_per_slice: int | None = None) -> DataFrame:
    """Labelled wide frame -> the same with all features.

    With ``rows_per_slice`` entities of longer histories are worked on in slices of time (see ``histories``).
    """
    require(wide, [*IDENTITY, label], "build_features")
    if check_empty and wide.isEmpty():
        raise ContractError("build_features: the frame is empty")
    shares = {"feat_mem_pct_of_limit": memory_share(wide, dispatch), "feat_cpu_util": cpu_share(wide, dispatch)}
    out = add_cpu_throttle_ratio(wide.withColumns(calendar(TIME) | shares))
    own = out
    out = with_windows(own, lambda over: _memory(own, over) | _cpu(over) | _lifecycle(own, over), by=ENTITY, time_col=TIME, longest=LONGEST, rows_per_slice=rows_per_slice)
    return add_aggregation_features(out, label)


def feature_columns(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if c.startswith(PREFIX))


def select_model_columns(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Identity, sorted features, label; raw metrics go, and so does their scan."""
    require(df, [*IDENTITY, label], "select_model_columns")
    return df.select(*IDENTITY, *feature_columns(df), label)


# Columns that are known only after an event and must not be features.
DENIED = frozenset({"restart_count_post", "future_oom_count", "post_event_memory_mb", "termination_reason", "exit_code", "last_terminated_reason", "container_oom_events_post"})


def denied_features(names) -> set[str]:
    return set(names) & DENIED
