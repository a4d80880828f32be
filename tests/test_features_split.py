import json
import math
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from failcast.operators import features as FE
from failcast.operators import split as SP
from failcast.schema import LABEL, TIME, ContractError
from helpers import at

BASE = "scrape_timestamp timestamp, namespace string, pod string, pod_uid string, container string, node string, event_within_30min int"


def wide(spark, rows, metrics=()):
    """rows: dicts with t and anything else."""
    out = []
    for r in rows:
        base = (r["t"], "workloads", r.get("pod", "p"), r.get("uid", "u"), "c", r.get("node", "n1"), r.get("label", 0))
        out.append((*base, *[None if r.get(m) is None else float(r[m]) for m in metrics]))
    return spark.createDataFrame(out, ", ".join([BASE, *[f"{m} double" for m in metrics]]))


def column(df, name, order=TIME):
    return [r[name] for r in df.orderBy(order).collect()]


def test_calendar(spark):
    rows = [{"t": datetime(2026, 5, 18, 14, tzinfo=UTC)}, {"t": datetime(2026, 5, 23, 3, tzinfo=UTC)}]
    got = FE.add_temporal_features(wide(spark, rows)).orderBy(TIME).collect()
    assert [(r.feat_hour_of_day, r.feat_day_of_week, r.feat_is_weekend, r.feat_is_business_hours) for r in got] == [(14, 0, 0, 1), (3, 5, 1, 0)]


def test_sources_and_dispatch(spark):
    trace = wide(spark, [{"t": at(0), FE.TRACE_MEMORY: 80}], [FE.TRACE_MEMORY])
    assert column(FE.add_mem_pct_of_limit(trace), "feat_mem_pct_of_limit") == [0.8]
    lab = wide(spark, [{"t": at(0), FE.WORKING_SET: 400, FE.MEMORY_LIMIT: 500}, {"t": at(1), FE.WORKING_SET: 400, FE.MEMORY_LIMIT: 0}], [FE.WORKING_SET, FE.MEMORY_LIMIT])
    assert column(FE.add_mem_pct_of_limit(lab), "feat_mem_pct_of_limit") == [0.8, None]
    both = trace.unionByName(lab, allowMissingColumns=True)
    assert sorted(column(FE.add_mem_pct_of_limit(both), "feat_mem_pct_of_limit"), key=str) == [0.8, None, None]
    assert sorted(column(FE.add_mem_pct_of_limit(both, dispatch="row"), "feat_mem_pct_of_limit"), key=str) == [0.8, 0.8, None]
    none = FE.add_mem_pct_of_limit(wide(spark, [{"t": at(0)}]))
    assert column(none, "feat_mem_pct_of_limit") == [None]


def test_cpu_age_and_node(spark):
    cpu = FE.add_cpu_features(wide(spark, [{"t": at(0), FE.TRACE_CPU: 50}], [FE.TRACE_CPU]))
    assert column(cpu, "feat_cpu_util") == [0.5]
    ages = FE.add_lifecycle_features(wide(spark, [{"t": at(seconds=s)} for s in (0, 60, 300, 3600)]))
    assert column(ages, "feat_pod_age_sec") == [0.0, 60.0, 300.0, 3600.0]
    rows = [{"t": at(0), "uid": u, "node": n, FE.TRACE_MEMORY: v} for u, n, v in (("a", "n1", 40), ("b", "n1", 30), ("c", "n2", 10), ("d", None, 50), ("e", "n3", None))]
    out = FE.add_node_cotenant_features(FE.add_mem_pct_of_limit(wide(spark, rows, [FE.TRACE_MEMORY])))
    got = {r.pod_uid: (r.feat_node_mem_pct_sum, r.feat_node_mem_pct_max, r.feat_node_n_containers) for r in out.collect()}
    assert math.isclose(got["a"][0], 0.7) and got["a"][1:] == (0.4, 2) and got["c"] == (0.1, 0.1, 1)
    assert got["d"] == (None, None, None) and got["e"] == (0.0, None, 0)


def test_lineage_sees_the_past_alone(spark):
    rows = [{"t": at(0), "pod": "lf-a", "uid": "a", "label": 1}, {"t": at(0), "pod": "lf-b", "uid": "b"}, {"t": at(60), "pod": "lf-a", "uid": "a"}, {"t": at(60 * 25), "pod": "lf-a", "uid": "a"}]
    out = FE.add_aggregation_features(FE.add_mem_pct_of_limit(wide(spark, rows)))
    assert column(out, "feat_lineage_24h_oom_rate") == [None, None, 0.5, 0.0]


def test_build_and_select(spark):
    metrics = [FE.WORKING_SET, FE.MEMORY_LIMIT, FE.RSS, FE.FAILURES, FE.RESTARTS]
    rows = [{"t": at(i), "uid": u, FE.WORKING_SET: 10 * i + 10, FE.MEMORY_LIMIT: 100, FE.RSS: 5, FE.FAILURES: i, FE.RESTARTS: i % 2, "label": i % 2} for i in range(4) for u in "ab"]
    built = FE.build_features(wide(spark, rows, metrics))
    out = FE.select_model_columns(built)
    names = FE.feature_columns(out)
    assert len(names) == 28 and names == sorted(names) and LABEL in out.columns and FE.WORKING_SET not in out.columns
    assert out.count() == 8 and not FE.denied_features(names)
    last = [r for r in out.collect() if r[TIME].minute == 3][0]
    assert math.isclose(last["feat_mem_pct_of_limit__5min_mean"], 0.2) and last["feat_mem_failcnt__5min_rate"] == 2.0 and last["feat_restart_rate_1h"] == 1.0
    with pytest.raises(ContractError, match="empty"):
        FE.build_features(wide(spark, []))
    with pytest.raises(ContractError, match=LABEL):
        FE.build_features(wide(spark, rows, metrics).drop(LABEL))


def frame(spark, minutes):
    return spark.createDataFrame([(at(m), f"u{i % 7}", float(i), int(i % 10 == 0)) for i, m in enumerate(minutes)], f"{TIME} timestamp, pod_uid string, feat_x double, {LABEL} int")


def test_temporal_split(spark):
    train, val, test, metrics = SP.temporal_split(frame(spark, range(1000)))
    assert (train.count(), val.count(), test.count()) == (600, 200, 200)
    edges = [d.agg(F.min(TIME), F.max(TIME)).first() for d in (train, val, test)]
    assert edges[0][1] < edges[1][0] and edges[1][1] < edges[2][0]
    assert all(0.05 < r.positive_rate < 0.2 for r in metrics.collect())


def test_ties_go_to_the_earlier_part_and_errors(spark):
    train, val, test, _ = SP.temporal_split(frame(spark, [*range(595), *[595] * 10, *range(596, 991)]))
    assert train.count() == 605 and train.where(F.col(TIME) == F.lit(at(595))).count() == 10 and val.count() + test.count() == 395
    for bad in ((0.8, 0.3), (1.5, 0.2), (0, 0.2)):
        with pytest.raises(ValueError):
            SP.temporal_split(frame(spark, range(10)), train_frac=bad[0], val_frac=bad[1])
    with pytest.raises(ContractError, match="empty"):
        SP.temporal_split(frame(spark, []))
    with pytest.raises(ContractError, match="collapsed"):
        SP.temporal_split(frame(spark, [1] * 50))


def test_overlap_and_opt_in(spark, tmp_path):
    train, _, test, _ = SP.temporal_split(frame(spark, range(100)))
    assert SP.entity_overlap(train, test).count() == 7
    assert json.loads(SP.write_entity_overlap_opt_in(tmp_path / "x").read_text()) == ["pod_uid"]


def test_downsampling_is_exact_and_repeatable(spark):
    df = spark.range(1000).selectExpr("id", f"cast(id < 10 as int) as {LABEL}")
    one, ratio = SP.downsample_negatives(df)
    two, _ = SP.downsample_negatives(df.repartition(7))
    assert one.count() == 100 and one.where(f"{LABEL} = 1").count() == 10 and math.isclose(ratio, 90 / 990)
    assert {r.id for r in one.collect()} == {r.id for r in two.collect()}
    ties = spark.range(300).selectExpr("1 as same", f"cast(id < 10 as int) as {LABEL}")
    assert SP.downsample_negatives(ties)[0].count() == 100
    same, ratio = SP.downsample_negatives(df.where("id < 12"), target_positive_rate=0.5)
    assert same.count() == 12 and ratio == 1.0
    with pytest.raises(ContractError):
        SP.downsample_negatives(df.where("id > 20"))
    with pytest.raises(ValueError):
        SP.downsample_negatives(df, target_positive_rate=1.5)
