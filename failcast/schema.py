"""Column contracts, the metric catalogue and constants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class ContractError(ValueError):
    """An input lacks columns or rows that an operator needs."""


@dataclass(frozen=True)
class MetricSpec:
    column: str
    query: str
    family: str


# Metric columns and the range queries that fill them.
_REAL = '{container!="",container!="POD"}'
ALL_METRICS = (
    MetricSpec("container_memory_working_set_bytes", "container_memory_working_set_bytes" + _REAL, "memory"),
    MetricSpec("container_memory_rss", "container_memory_rss" + _REAL, "memory"),
    MetricSpec("container_memory_cache", "container_memory_cache" + _REAL, "memory"),
    MetricSpec("container_memory_failcnt", "container_memory_failcnt" + _REAL, "memory"),
    MetricSpec("container_memory_max_usage_bytes", "container_memory_max_usage_bytes" + _REAL, "memory"),
    MetricSpec("container_cpu_usage_seconds_rate", f"rate(container_cpu_usage_seconds_total{_REAL}[1m])", "cpu"),
    MetricSpec("container_cpu_throttled_periods_rate", f"rate(container_cpu_cfs_throttled_periods_total{_REAL}[1m])", "cpu"),
    MetricSpec("container_cpu_periods_rate", f"rate(container_cpu_cfs_periods_total{_REAL}[1m])", "cpu"),
    MetricSpec("container_oom_events_total", "container_oom_events_total" + _REAL, "ground_truth"),
    MetricSpec("kube_pod_container_status_last_terminated_reason_oomkilled", 'kube_pod_container_status_last_terminated_reason{reason="OOMKilled"}', "ground_truth"),
    MetricSpec("kube_pod_container_status_restarts_total", "kube_pod_container_status_restarts_total", "ground_truth"),
    MetricSpec("kube_pod_container_resource_requests_memory_bytes", 'kube_pod_container_resource_requests{resource="memory"}', "metadata"),
    MetricSpec("kube_pod_container_resource_limits_memory_bytes", 'kube_pod_container_resource_limits{resource="memory"}', "metadata"),
    MetricSpec("kube_pod_info", "kube_pod_info", "metadata"),
)
METRIC_COLUMNS = tuple(m.column for m in ALL_METRICS)

# Columns of the header-less trace tables, in file order.
CONTAINER_META_COLS = ("container_id", "machine_id", "time_stamp", "app_du", "status", "cpu_request", "cpu_limit", "mem_size")
CONTAINER_USAGE_COLS = ("container_id", "machine_id", "time_stamp", "cpu_util_percent", "mem_util_percent", "cpi", "mem_gps", "mpki", "net_in", "net_out", "disk_io_percent")

# Trace columns and the metric names they become.
USAGE_METRICS = {
    "cpu_util_percent": "alibaba_container_cpu_util_pct",
    "mem_util_percent": "alibaba_container_mem_util_pct",
    "cpi": "alibaba_container_cpi",
    "mem_gps": "alibaba_container_mem_gps_pct",
    "mpki": "alibaba_container_mpki",
    "net_in": "alibaba_container_net_in_pct",
    "net_out": "alibaba_container_net_out_pct",
    "disk_io_percent": "alibaba_container_disk_io_pct",
}
META_METRICS = {
    "cpu_request": "alibaba_container_cpu_request",
    "cpu_limit": "alibaba_container_cpu_limit",
    "mem_size": "alibaba_container_mem_size_pct",
}
STATUS_PREFIX = "alibaba_container_status__"
TRACE_NAMESPACE = "alibaba_2018"

# Events, labels, windows, splits, decisions.
OOM_COUNTER = "container_oom_events_total"
OOM_GAUGE = "kube_pod_container_status_last_terminated_reason_oomkilled"
HEARTBEAT = USAGE_METRICS["mem_util_percent"]
LABEL = "event_within_30min"
LEAD_MINUTES = 30
COOLDOWN_MINUTES = 5
STEP_SECONDS = 15
CHUNK_MINUTES = 15
DAY_SECONDS = 86_400
ALIGNED_DAYS = (2, 8)
TRACE_ORIGIN_SECONDS = 1_514_764_800
DISK_SENTINELS = (-1.0, 101.0)
SILENCE_SECONDS = 300
SATURATED_PERCENT = 95.0
HEARTBEATS = 10
TRAIN_FRACTION, VALIDATION_FRACTION = 0.6, 0.2
BASELINE_THRESHOLD = 0.9
DECISION_THRESHOLD = 0.7
HORIZONS_MINUTES = (5, 10, 15, 30)
LEAST_SLICE_ROWS = 100
POSITIVE_RATE = 0.1

TIME = "scrape_timestamp"
ENTITY = ("pod_uid", "container")
IDENTITY = (TIME, "namespace", "pod", "pod_uid", "container", "node")
LONG_SCHEMA = T.StructType(
    [T.StructField(TIME, T.TimestampType()), T.StructField("metric_name", T.StringType()), T.StructField("value", T.DoubleType())]
    + [T.StructField(c, T.StringType()) for c in ("namespace", "pod", "pod_uid", "container", "node")]
)
LONG_COLUMNS = tuple(LONG_SCHEMA.names)


def require(df: DataFrame, columns, what: str) -> None:
    """Raise if ``df`` lacks any of ``columns``; looks at the plan alone."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ContractError(f"{what}: missing columns {missing}")
