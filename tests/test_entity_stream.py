import math
import random

import pytest

from failcast.operators import features as FE
from failcast.operators import ml
from failcast.schema import LABEL, TIME
from failcast.streaming import entities
from helpers import at

SCHEMA = f"{TIME} timestamp, pod_uid string, container string, namespace string, pod string, node string, `{FE.WORKING_SET}` double, `{FE.RSS}` double, `{FE.MEMORY_LIMIT}` double, `{FE.FAILURES}` double, `{FE.CPU}` double, `{FE.RESTARTS}` double, {LABEL} int"


def made(n=240):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        u = f"u{i % 3}"
        rows.append((at(seconds=40 * i + rng.randint(0, 9)), u, "c", "ns", f"pod-{u}-x", "n", rng.choice([None, math.nan, 10 + rng.random() * 50]), 5.0, rng.choice([100.0, 0.0, 80.0]), float(i // 7), rng.random(), float(i // 50), int(rng.random() < 0.2)))
    return rows[:6] + rows[5:]  # one row twice


def alike(a, b):
    return a == b or (a is None) == (b is None) and isinstance(a, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Batches that hold late rows, each in a query of its own that goes on from the checkpoint, and a last row that lets all others out."""
    place = str(tmp_path_factory.mktemp("entities"))
    rows = made()
    batches = [rows[:90], rows[100:170] + rows[90:100], rows[180:205], rows[170:180] + rows[205:]]
    last = (at(minutes=600), "end", "c", "ns", "pod", "n", 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    entities.use_state_store(spark)
    table = spark.createDataFrame(rows, SCHEMA)
    model = ml.train(*[FE.build_features(table).select(*entities.ENTITY_FEATURES, LABEL)] * 2, trials=1, max_trees=3)
    for batch in [*batches, [last], [last]]:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{place}/in")
        stream = entities.entity_features(spark.readStream.schema(SCHEMA).parquet(f"{place}/in"), late="30 minutes")
        entities.write_scores(model.score(stream), f"{place}/out", f"{place}/c", available_now=True).awaitTermination()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return table, model, spark.read.parquet(f"{place}/out").where("pod_uid <> 'end'")


def test_stream_equals_batch(run):
    table, model, out = run
    want = model.score(FE.build_features(table)).select(TIME, "pod_uid", *entities.ENTITY_FEATURES, "score")
    got = out.select(*want.columns).collect()
    assert len(got) == table.count()
    key = lambda r: tuple(map(str, (r[TIME], r.pod_uid, r.score)))
    for x, y in zip(sorted(got, key=key), sorted(want.collect(), key=key), strict=True):
        assert all(alike(a, b) for a, b in zip(x, y, strict=True)), (x, y)


def test_a_repeated_batch_leaves_nothing_twice(spark, run, tmp_path):
    table, _, _ = run
    source = spark.readStream.schema(SCHEMA).parquet
    table.coalesce(1).write.parquet(f"{tmp_path}/in")
    for checkpoint in ("a", "b"):  # the second starts anew, with the numbers of the first
        query = entities.write_scores(source(f"{tmp_path}/in").select("pod_uid"), f"{tmp_path}/out", f"{tmp_path}/{checkpoint}", available_now=True)
        query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == table.count()


def test_features_of_a_history_alone():
    import numpy as np

    us = np.array([0, 60, 60, 400]) * 1_000_000
    values = {c: np.array([1.0, 2.0, np.nan, 4.0]) for c in ("share", "cpu", "throttle", "failures", "restarts", "gap")}
    out = entities.features_at(us, values, 0)
    assert out["feat_mem_pct_of_limit__15min_mean"].tolist()[1:] == [1.0, 1.0, 1.5] and math.isnan(out["feat_mem_pct_of_limit__15min_mean"][0])
    assert out["feat_pod_age_sec"].tolist() == [0.0, 60.0, 60.0, 400.0] and out["feat_restart_rate_1h"][3] == 1.0
    assert math.isnan(out["feat_mem_growth_rate__30min"][3]) and math.isnan(out["feat_mem_growth_rate__5min"][3])
