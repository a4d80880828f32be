import json
import random

import numpy as np
import pytest

from failcast.__main__ import main
from failcast.operators.features import FAILURES, MEMORY_LIMIT, RESTARTS, RSS, WORKING_SET
from failcast.operators.metrics import prediction_counts
from failcast.plans import jobs
from failcast.schema import HEARTBEAT, LONG_SCHEMA, OOM_COUNTER, TIME
from failcast.sources.files import write_hourly
from failcast.streaming import pressure
from helpers import at, long_rows


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    rng = random.Random(3)
    rows = []
    for u in range(12):
        dies = [rng.randrange(60, 400) for _ in range(2)] if u % 2 else []
        for m in range(0, 420, 2):
            near = any(0 <= d - m <= 30 for d in dies)
            for metric, v in ((WORKING_SET, 90 if near else 50 + rng.random() * 20), (MEMORY_LIMIT, 100), (RSS, 40), (FAILURES, m // 10), (RESTARTS, 0), (OOM_COUNTER, sum(d <= m for d in dies))):
                rows.append((at(m), metric, float(v), f"u{u}"))
    write_hourly(long_rows(spark, rows), f"{root}/long").collect()
    assert main(["label", "--source", f"{root}/long", "--out", f"{root}/wide.parquet"], spark) == 0
    assert main(["features", "--inputs", f"{root}/wide.parquet", f"{root}/missing", "--out", f"{root}/features"], spark) == 0
    assert main(["train", "--source", f"{root}/features", "--out", f"{root}/model", "--trials", "1"], spark) == 0
    return root


def test_records(built):
    read = lambda p: json.load(open(f"{built}/{p}"))
    assert read("wide.parquet.metrics.json")["n_positive"] > 0
    assert len(read("features/feature_list.json")) == 28 and read("features/feature_metrics.json")["n_features"] == 28
    assert set(read("features/split_metrics.json")) == {"train", "val", "test"}
    test = read("model/test_metrics.json")
    assert test["metrics"]["pr_auc"] > 0.5 and set(test["gates"]) == {"brier_le_0_10", "precision_at_recall_0_8_ge_0_5"}
    assert "## Gates" in read("model/model_card.json")["text"] and read("model/baseline_test_metrics.json")["family"] == "rule_baseline"


def test_scorer_and_missing_features(spark, built):
    scorer = jobs.Scorer(spark, f"{built}/model", version="v1")
    whole = {n: 0.5 for n in scorer.names} | {"unknown": 1.0}
    requests = spark.createDataFrame([("u", "c", whole), ("v", "c", {"unknown": 1.0})], "pod_uid string, container string, features map<string,double>")
    good, bad = scorer.predict(requests).orderBy("pod_uid").collect()
    assert 0 <= good.prediction <= 1 and len(good.top_contributors) == 3 and good.error is None and good.model_version == "v1"
    counts = {r.status: (r.top_feature, r.n) for r in prediction_counts(scorer.predict(requests)).collect()}
    assert counts["ok"] == (good.top_contributors[0].feature, 1) and counts["error"] == (None, 1)
    assert bad.prediction is None and bad.error == f"missing feature: {scorer.names[0]}"


def test_runs(spark):
    with pytest.raises(ValueError, match="stage"):
        jobs.Run("f", "d", stage="other")
    assert jobs.Run("f", "d").name.startswith("f__d__") and jobs.info(spark)["failcast"]


def test_streams(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(at(seconds=15 * i), HEARTBEAT, float(rng.integers(0, 100)), f"u{i % 3}", f"n{i % 2}") for i in range(90)]
    source = f"{tmp_path}/in"
    long = long_rows(spark, rows)
    long.repartition(3, TIME).write.parquet(source)
    stream = lambda: spark.readStream.schema(LONG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    late = "1 hour"
    out = pressure.run_to_end(pressure.deduplicated(stream(), late), "dedup", f"{tmp_path}/c0")
    assert out.count() == 90
    finished = {(r.window_start, r.node): r for r in pressure.run_to_end(pressure.node_pressure(stream(), late="0 seconds"), "pressure", f"{tmp_path}/c1").collect()}
    whole = pressure.node_pressure(long).collect()
    assert finished and all(k in {(r.window_start, r.node) for r in whole} for k in finished)
    rolled = pressure.run_to_end(pressure.rolling_mean(spark.readStream.schema(LONG_SCHEMA).parquet(source), seconds=120, late=late), "rolled", f"{tmp_path}/c2").collect()
    assert len(rolled) == 90
    flat = [(r[3], int(r[0].timestamp() * 1e6), r[2]) for r in rows]
    for r in rolled:
        inside = [v for u, t, v in flat if u == r.pod_uid and r.us - 120_000_000 <= t < r.us]
        assert r.mean_before == (pytest.approx(sum(inside) / len(inside)) if inside else None)


def test_late_rows_see_all_their_samples(spark, tmp_path):
    """A row behind the newest by less than the allowed lateness still gets the samples of its whole window."""
    source = f"{tmp_path}/in"
    for n, seconds in enumerate(([150], [300], [200])):
        long_rows(spark, [(at(seconds=s), HEARTBEAT, float(s), "u1") for s in seconds]).coalesce(1).write.parquet(f"{source}/{n}")
    rows = [r for n in range(3) for r in spark.read.parquet(f"{source}/{n}").collect()]
    stream = f"{tmp_path}/stream"
    for n, r in enumerate(rows):
        spark.createDataFrame([r], LONG_SCHEMA).coalesce(1).write.mode("append").parquet(stream)
        frame = spark.readStream.schema(LONG_SCHEMA).parquet(stream)
        query = pressure.rolling_mean(frame, seconds=60, late="5 minutes").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        query.awaitTermination()
    means = {r.value: r.mean_before for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert means == {150.0: None, 300.0: None, 200.0: 150.0}
