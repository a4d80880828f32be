import math

import pytest

from failcast.operators import events as E
from failcast.operators import labels as L
from failcast.operators.reshape import to_wide
from failcast.schema import HEARTBEAT, LABEL, LONG_SCHEMA, OOM_COUNTER, OOM_GAUGE, TIME, ContractError
from helpers import at, long_rows

WS = "container_memory_working_set_bytes"


def naive(t):
    return t.replace(tzinfo=None)


def found(df):
    return sorted((r.pod_uid, r.event_ts, r.source) for r in df.collect())


def test_counter_and_gauge_edges(spark):
    rows = [(at(seconds=s), OOM_COUNTER, v) for s, v in ((0, 0.0), (15, 0.0), (30, 1.0), (45, 0.0))]
    assert found(E.detect_oom_events(long_rows(spark, rows))) == [("uid-1", naive(at(seconds=30)), "oom_events_total")]
    rows = [(at(seconds=s), OOM_GAUGE, v) for s, v in ((0, 0.0), (15, 1.0), (30, 1.0))]
    assert found(E.detect_oom_events(long_rows(spark, rows))) == [("uid-1", naive(at(seconds=15)), "ksm_last_terminated_reason")]


def test_first_samples_and_missing_previous(spark):
    rows = [(at(0), OOM_COUNTER, 5.0), (at(0), OOM_GAUGE, 1.0, "uid-2"), (at(1), OOM_GAUGE, math.nan, "uid-2"), (at(2), OOM_GAUGE, 1.0, "uid-2")]
    got = found(E.detect_oom_events(long_rows(spark, rows)))
    assert [(u, t) for u, t, _ in got] == [("uid-2", naive(at(0))), ("uid-2", naive(at(2)))]


def test_both_signals_count_once_and_entities_are_apart(spark):
    rows = [(at(seconds=s), m, v) for m in (OOM_COUNTER, OOM_GAUGE) for s, v in ((0, 0.0), (30, 1.0))]
    rows += [(at(seconds=s), OOM_COUNTER, 5.0, "uid-2") for s in (0, 30)]
    assert found(E.detect_oom_events(long_rows(spark, rows))) == [("uid-1", naive(at(seconds=30)), "oom_events_total")]


def ramp(minutes, uid="uid-1"):
    return [(at(seconds=30 * i), WS, 100.0 * i, uid) for i in range(minutes * 2 + 1)]


def counter(*event_minutes):
    return [(at(0), OOM_COUNTER, 0.0)] + [(at(m), OOM_COUNTER, float(i + 1)) for i, m in enumerate(event_minutes)]


def labels_of(spark, rows, **options):
    return {r[TIME]: r[LABEL] for r in L.generate_labels(long_rows(spark, rows), **options).collect()}


def test_lead_window_and_censoring(spark):
    got = labels_of(spark, ramp(60) + counter(50))
    assert got[naive(at(19, 30))] == 0 and got[naive(at(20))] == 1 and got[naive(at(25))] == 1
    assert not any(naive(at(50)) <= t <= naive(at(55)) for t in got)
    assert got[naive(at(55, 30))] == 0


def test_overlapping_windows_and_no_event(spark):
    got = labels_of(spark, ramp(70) + counter(45, 60))
    assert got[naive(at(30))] == 1 and got[naive(at(55))] == 1
    assert naive(at(47)) not in got  # censored though positive for the later event
    assert set(labels_of(spark, ramp(10)).values()) == {0}


def test_wide_frame(spark):
    rows = [(at(0), WS, 1.0), (at(0), "container_memory_rss", 2.0), (at(1), WS, 3.0), (at(1), WS, 3.0), (at(2), WS, math.nan)]
    wide = to_wide(long_rows(spark, rows)).orderBy(TIME).collect()
    assert [(r[WS], r["container_memory_rss"], r["node"]) for r in wide] == [(1.0, 2.0, "node-1"), (3.0, None, "node-1")]
    assert "kube_pod_info" in wide[0].asDict()


def test_empty_and_bad_frames(spark):
    empty = spark.createDataFrame([], LONG_SCHEMA)
    out = L.generate_labels(empty)
    assert out.count() == 0 and LABEL in out.columns
    with pytest.raises(ContractError, match="missing columns"):
        L.generate_labels(empty.select(TIME))


def beats(values, uid, step=10, start=0):
    return [(at(seconds=start + step * i), HEARTBEAT, float(v), uid) for i, v in enumerate(values)]


@pytest.mark.parametrize(
    ("level", "options", "n"),
    [(98, {}, 1), (20, {}, 0), (80, {}, 0), (80, {"saturated": 70}, 1)],
)
def test_disappearance(spark, level, options, n):
    rows = beats([level] * 10, "gone") + beats([40] * 80, "alive", step=30)
    got = found(E.disappeared(long_rows(spark, rows), **options))
    assert len(got) == n
    if n:
        assert got[0][:2] == ("gone", naive(at(seconds=90))) and got[0][2].startswith(f"alibaba_disappearance+mem={level}")


def test_saturated_to_the_end_is_no_event(spark):
    assert not found(E.disappeared(long_rows(spark, beats([99] * 80, "busy", step=30))))
    assert not found(E.disappeared(long_rows(spark, ramp(3))))


def test_trace_labels(spark):
    rows = beats([99] * 80, "gone", step=30) + beats([40] * 180, "alive", step=30)
    out = L.generate_trace_labels(long_rows(spark, rows))
    got = {(r.pod_uid, r[TIME]): r[LABEL] for r in out.collect()}
    assert got["gone", naive(at(20))] == 1 and got["gone", naive(at(5))] == 0
    assert {v for (u, _), v in got.items() if u == "alive"} == {0}
    assert ("gone", naive(at(39, 30))) not in got
