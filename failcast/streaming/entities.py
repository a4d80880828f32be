"""Entity features and scores of a stream, equal to the batch plan's on the same rows.

A row's features need every row before it, and rows may come late. So a row waits until the
watermark has passed its time: from then on nothing older can come. Each entity keeps, in
keyed state, its rows of the longest frame, the last one before them (for growth, which looks back without
limit) and the time of its first row. A timer at the earliest waiting row brings what has become final;
state is written for rows that come and rows that go, never as a whole.

Node pressure and lineage history need other entities and stay batch features; a model for streams is
trained without them (``ENTITY_FEATURES`` names what there is).

The state store must be RocksDB's (``use_state_store``). ``write_scores`` replaces the folder of a batch as a
whole, so a batch that is repeated after a failure leaves nothing twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from failcast.deploy import ship
from failcast.functions.scalars import MICRO, calendar
from failcast.operators import features as FE
from failcast.operators import frames
from failcast.operators.windows import TINY, width
from failcast.schema import ENTITY, IDENTITY, TIME, require
from failcast.streaming.pressure import LATE

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_VALUES = ("share", "cpu", "throttle", "failures", "restarts", "gap")
#: Values of the row itself that are features as they are.
_OWN = {"feat_mem_pct_of_limit": "share", "feat_cpu_util": "cpu", "feat_cpu_throttle_ratio": "throttle", "feat_mem_ws_rss_gap_pct": "gap"}
_TEXTS = ("namespace", "pod", "node")
_KEY = "us long, n int"
_ROW = ", ".join([*(f"{c} string" for c in _TEXTS), *(f"{c} double" for c in _VALUES)])
_SHARE = "feat_mem_pct_of_limit"
#: New column -> (value, window, aggregate), and -> (value, window) of growth and of spreads.
_ROLLED = {f"{_SHARE}__{w}_{a}": ("share", w, a) for w in FE.MEMORY_WINDOWS for a in ("mean", "max")} | {f"{c}__{w}_mean": (v, w, "mean") for w in FE.CPU_WINDOWS for c, v in (("feat_cpu_util", "cpu"), ("feat_cpu_throttle_ratio", "throttle"))}
_GROWN = {f"feat_mem_growth_rate__{w}": ("share", w) for w in FE.MEMORY_WINDOWS}
_SPREADS = {"feat_mem_failcnt__5min_rate": ("failures", "5min"), "feat_restart_rate_1h": ("restarts", FE.LONGEST)}
_OF_HISTORY = [*_ROLLED, *_GROWN, *_SPREADS, "feat_pod_age_sec"]
_OUT = T.StructType([T.StructField(c, T.StringType()) for c in (*ENTITY, *_TEXTS)] + [T.StructField("us", T.LongType())] + [T.StructField(c, T.DoubleType()) for c in (*_OWN, *_OF_HISTORY)])
_CALENDAR = ("feat_hour_of_day", "feat_day_of_week", "feat_is_weekend", "feat_is_business_hours")
ENTITY_FEATURES = sorted([*_CALENDAR, *_OWN, *_OF_HISTORY])


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def features_at(us: np.ndarray, values: dict[str, np.ndarray], first: int) -> dict[str, np.ndarray]:
    """Features of all rows of an entity's sorted history; NaN where undefined."""
    low_high = {w: frames.frame_bounds(us, width(w)) for w in {w for _, w, _ in _ROLLED.values()} | {w for _, w in _SPREADS.values()}}
    out = {name: frames.over_frames(values[v], *low_high[w], a) for name, (v, w, a) in _ROLLED.items()}
    for name, (v, w) in _GROWN.items():
        at = np.searchsorted(us, us - width(w), "right") - 1
        old = np.where(at >= 0, values[v][np.maximum(at, 0)], np.nan)
        out[name] = np.where(np.abs(old) > TINY, (values[v] - old) / np.where(np.abs(old) > TINY, old, 1), np.nan)
    for name, (v, w) in _SPREADS.items():
        out[name] = frames.over_frames(values[v], *low_high[w], "max") - frames.over_frames(values[v], *low_high[w], "min")
    out["feat_restart_rate_1h"] = np.where(np.isnan(out["feat_restart_rate_1h"]), np.nan, np.maximum(out["feat_restart_rate_1h"], 0))
    return out | {"feat_pod_age_sec": (us - first) / MICRO}


class EntityHistory(StatefulProcessor):
    """The rows that an entity's next features need, by time; rows that are out are no longer waiting."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", _KEY, _ROW)
        self.state = handle.getValueState("state", "first long, out_to long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, out_to = self.state.get() if self.state.exists() else (None, -(2**63))
        earliest = None
        for pdf in rows:
            for us, *row in zip(pdf["us"].tolist(), *[pdf[c].astype(object).where(pdf[c].notna(), None) for c in (*_TEXTS, *_VALUES)], strict=True):
                n = 0
                while self.rows.containsKey((us, n)):  # rows that are tied in time
                    n += 1
                self.rows.updateValue((us, n), tuple(row))
                first, earliest = min(us, us if first is None else first), min(us, us if earliest is None else earliest)
        self.state.update((first, out_to))
        self._wake(earliest)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        final = timerValues.getCurrentWatermarkInMs() * 1000
        first, out_to = self.state.get()
        kept = sorted(((k[0], k[1]), tuple(v)) for k, v in self.rows.iterator())
        us = np.array([k[0] for k, _ in kept], np.int64)
        ready = (us > out_to) & (us <= final)
        if ready.any():
            values = {c: np.array([np.nan if r[len(_TEXTS) + i] is None else r[len(_TEXTS) + i] for _, r in kept], float) for i, c in enumerate(_VALUES)}
            found = features_at(us, values, first)
            at = np.flatnonzero(ready)
            made = {c: [key[i]] * len(at) for i, c in enumerate(ENTITY)} | {c: [kept[k][1][i] for k in at] for i, c in enumerate(_TEXTS)} | {"us": us[at]}
            made |= {c: values[v][at] for c, v in _OWN.items()} | {c: found[c][at] for c in _OF_HISTORY}
            out_to = int(us[at].max())
            self.state.update((first, out_to))
            # What no later row looks back to goes; of the rows before the longest frame the last stays.
            before = np.flatnonzero(us <= out_to - width(FE.LONGEST))
            for k in before[:-1]:
                self.rows.removeKey(kept[k][0])
            yield pd.DataFrame(made)[[f.name for f in _OUT]]
        waiting = us[us > max(out_to, final)]
        self._wake(int(waiting.min()) if len(waiting) else None)

    def _wake(self, us: int | None) -> None:
        if us is not None:
            self.handle.registerTimer(us // 1000 + 1)

    def close(self) -> None:
        pass


def entity_features(wide: DataFrame, *, late: str = LATE, dispatch: str = "frame") -> DataFrame:
    """A stream of wide rows -> identity columns and ``ENTITY_FEATURES``, each row once its time is behind the watermark."""
    require(wide, IDENTITY, "entity_features")
    ship(wide.sparkSession)
    shares = {"share": FE.memory_share(wide, dispatch), "cpu": FE.cpu_share(wide, dispatch), "failures": FE.value_of(wide, FE.FAILURES), "restarts": FE.value_of(wide, FE.RESTARTS), "throttle": FE.throttle_ratio(wide), "gap": FE.rss_gap(wide)}
    rows = wide.withWatermark(TIME, late).select(*ENTITY, *[F.col(c) for c in _TEXTS], F.unix_micros(TIME).alias("us"), TIME, *[v.cast("double").alias(n) for n, v in shares.items()])
    made = rows.groupBy(*ENTITY).transformWithStateInPandas(EntityHistory(), _OUT, "Append", "EventTime")
    defined = {f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in _OUT if f.dataType == T.DoubleType()}
    timed = made.withColumn(TIME, F.timestamp_micros("us")).drop("us").withColumns(defined)
    return timed.withColumns(calendar(TIME)).select(*IDENTITY, *ENTITY_FEATURES)


def write_scores(rows: DataFrame, path: str, checkpoint: str, *, available_now: bool = False) -> StreamingQuery:
    """Start writing a stream under ``path``, a folder batch=N for each batch; a repeated batch replaces its own."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
