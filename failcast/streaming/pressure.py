"""Near-line variants on Structured Streaming.

Range frames do not exist on streams. Node pressure is a tumbling window with a watermark;
left-closed rolling values keep a bounded ring of recent samples per entity in a state store.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from failcast.schema import ENTITY, HEARTBEAT, TIME

LATE = "2 minutes"


def deduplicated(long: DataFrame, late: str = LATE) -> DataFrame:
    """Samples once each, though chunks of a scrape overlap."""
    return long.withWatermark(TIME, late).dropDuplicatesWithinWatermark([TIME, "metric_name", *ENTITY])


def node_pressure(long: DataFrame, *, metric: str = HEARTBEAT, every: str = "1 minute", late: str = LATE) -> DataFrame:
    """Sum, maximum and number of samples per node and tumbling window."""
    rows = long.where((F.col("metric_name") == metric) & F.col("value").isNotNull() & ~F.isnan("value"))
    grouped = rows.withWatermark(TIME, late).groupBy(F.window(TIME, every), "node")
    return grouped.agg(F.sum("value").alias("value_sum"), F.max("value").alias("value_max"), F.count("value").alias("n_samples")).select(F.col("window.start").alias("window_start"), "node", "value_sum", "value_max", "n_samples")


def rolling_mean(long: DataFrame, *, seconds: int, late: str = LATE) -> DataFrame:
    """Each sample with the mean of its entity's and metric's samples in [t - seconds, t), in order of time within a batch.

    A row may come ``late`` behind the newest and look ``seconds`` back, so state holds the
    samples of both lengths before the newest and nothing else; it is dropped when no sample
    came for that long in event time.
    """
    keys = ["metric_name", *ENTITY]
    width = seconds * 1_000_000
    behind = long.sparkSession.sql(f"SELECT unix_micros(TIMESTAMP '1970-01-01 00:00:00 UTC' + INTERVAL {late})").first()[0]
    rows = long.where(F.col("value").isNotNull() & ~F.isnan("value")).withWatermark(TIME, late)
    rows = rows.select(*keys, TIME, F.unix_micros(TIME).alias("us"), "value")

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        old_times, old_values = state.get if state.exists else ([], [])
        new = pd.concat(list(batches)).sort_values("us", kind="stable")
        us = new["us"].to_numpy(np.int64)
        times = np.concatenate((np.array(old_times, np.int64), us))
        values = np.concatenate((np.array(old_values, float), new["value"].to_numpy(float)))
        order = np.argsort(times, kind="stable")
        times, values = times[order], values[order]
        sums = np.concatenate(([0], np.cumsum(values, dtype=np.longdouble)))
        low, high = np.searchsorted(times, us - width), np.searchsorted(times, us)
        means = ((sums[high] - sums[low]) / np.maximum(high - low, 1)).astype(float)
        newest = int(times[-1])
        kept = times >= newest - behind - width
        state.update((times[kept].tolist(), values[kept].tolist()))
        state.setTimeoutTimestamp(max((newest + behind + width) // 1000, state.getCurrentWatermarkMs() + 1))
        out = {k: [v] * len(new) for k, v in zip(keys, key, strict=True)}
        yield pd.DataFrame(out | {"us": us, "value": new["value"].to_numpy(), "mean_before": pd.arrays.FloatingArray(means, high <= low)})

    schema = "metric_name string, pod_uid string, container string, us long, value double, mean_before double"
    return rows.groupBy(*keys).applyInPandasWithState(step, schema, "times array<long>, vals array<double>", "append", GroupStateTimeout.EventTimeTimeout)


def run_to_end(stream: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Process what is available into an in-memory table and return it."""
    query = stream.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
