import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from failcast.operators import features as FE
from failcast.operators import frames, histories
from failcast.operators import labels as L
from failcast.operators import windows as W
from failcast.plans import catalogue
from failcast.schema import IDENTITY, LABEL, TIME
from helpers import at

SLICED = 60


def uneven(spark, n=900, seed=1):
    """One entity has half of the rows, most of them in a burst; there are ties, gaps and missing values."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = None if i % 90 == 0 else ("hot" if i % 2 else f"e{i % 14}")
        second = rng.choice([rng.randint(0, 40_000), rng.randint(20_000, 21_000), 20_500 + i % 3])
        rows.append((i, key, at(seconds=second), rng.choice([None, math.nan, math.inf, float(rng.randint(0, 9)), rng.random()])))
    return spark.createDataFrame(rows, "i int, k string, t timestamp, v double").repartition(5)


def same(a, b):
    assert len(a) == len(b)
    for x, y in zip(sorted(a, key=lambda r: r.i), sorted(b, key=lambda r: r.i), strict=True):
        for p, q in zip(x, y, strict=True):
            assert p == q or (isinstance(p, float) and (math.isclose(p, q, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(p) and math.isnan(q)))), (x, y)


@pytest.mark.parametrize("window", ["30s", "10min", "3h"])
def test_slices_change_no_window(spark, window):
    df = uneven(spark)
    made = lambda over: {a: W.rolled("v", over, window, a) for a in W.AGGREGATES if a != "median"} | {"first": F.min("t").over(over.rangeBetween(Window.unboundedPreceding, 0))}
    options = {"by": ["k"], "time_col": "t", "longest": window}
    cut = histories.with_windows(df, made, rows_per_slice=SLICED, **options)
    same(cut.collect(), histories.with_windows(df, made, rows_per_slice=None, **options).collect())
    # Of rows tied in time any may be the last, so growth is compared without ties.
    single = df.dropDuplicates(["k", "t"]).cache()
    grown = [W.grouped_time_growth_rate(single, by=["k"], time_col="t", value_col="v", window=window, new_col="g", rows_per_slice=n).collect() for n in (SLICED, None)]
    same(*grown)


def test_no_slice_is_large_and_rows_are_copied_once(spark):
    df = uneven(spark, 6000)
    cuts = histories.time_cuts(df, by=["k"], time_col="t", longest=W.width("1s"), rows_per_slice=SLICED)
    rows = histories.sliced(df, cuts, by=["k"], time_col="t", longest=W.width("1s"))
    sizes = [r["count"] for r in rows.where("k = 'hot'").groupBy("__slice").count().collect()]
    hot = df.where("k = 'hot'").count()
    assert len(sizes) >= hot / SLICED / 2 and sum(sizes) <= 2 * hot + 2 * len(sizes)
    assert max(sizes) <= 20 * SLICED  # three seconds have a third of the rows, and times are not split
    assert rows.where("__own").count() == 6000
    calm = spark.range(6000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id")).alias("t"))
    cuts = histories.time_cuts(calm, by=["k"], time_col="t", longest=W.width("10s"), rows_per_slice=SLICED)
    sizes = [r["count"] for r in histories.sliced(calm, cuts, by=["k"], time_col="t", longest=W.width("10s")).groupBy("__slice").count().collect()]
    assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]


def test_cuts_keep_their_distance():
    assert histories.thinned([5, 1, 3, 3, 10], 2) == [1, 3, 5, 10]
    assert histories.thinned([1, 2, 3, 4, 5], 3) == [1, 4] and histories.thinned([], 3) == []


def test_asof_join_in_slices(spark):
    df = uneven(spark)
    left, right = df.where("i % 3 > 0"), df.where("i % 30 = 0 or i in (1, 31)").dropDuplicates(["k", "t"]).withColumnRenamed("i", "j").withColumn("x", F.col("j") * 2)
    for tolerance in (None, "5min"):
        joined = [W.asof_join(left, right, by=["k"], time_col="t", values=["j", "x"], tolerance=tolerance, rows_per_slice=n).drop("v").collect() for n in (SLICED, None)]
        same(*joined)


def moved(df):
    """What sorts, exchanges and aggregates of the plan say of themselves."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [x for x in lines if x.lstrip(" :+-*()0123456789").startswith(("Sort", "Exchange", "ObjectHashAggregate", "HashAggregate"))]


def test_asof_join_moves_no_cuts(spark):
    """Cuts of a long history are thousands of numbers: a row that is sorted with them is larger by as many."""
    df = uneven(spark)
    plan = moved(W.asof_join(df.where("i % 3 > 0"), df.where("i % 3 = 0").withColumnRenamed("i", "j"), by=["k"], time_col="t", values=["j"], rows_per_slice=SLICED))
    assert plan and not [x for x in plan if "__cuts" in x]


def test_nearest_events_in_slices(spark):
    df = uneven(spark)
    for share in (1, 7, 200):
        events = df.where(f"i % {share} = 0").select("k", F.col("t").alias("event_ts"))
        near = [L.near_events(df, events, by=["k"], time="t", rows_per_slice=n).drop("v").collect() for n in (SLICED, None)]
        same(*near)


def test_nearest_events_move_no_cuts(spark):
    df = uneven(spark)
    plan = moved(L.near_events(df, df.where("i % 7 = 0").select("k", F.col("t").alias("event_ts")), by=["k"], time="t", rows_per_slice=SLICED))
    assert plan and not [x for x in plan if "__cuts" in x]


@pytest.mark.parametrize("rows_per_slice", [SLICED, None])
def test_long_frames_equal_windows(spark, rows_per_slice):
    df = uneven(spark, 600).withColumn("w", F.when(F.col("i") % 4 > 0, F.col("i") % 5))
    specs = {f"{a}_{w}_{c}": (c, w, a) for a in W.AGGREGATES for w in ("1min", "2h") for c in ("v", "w")}
    over = W.keyed(df, ["k"], "t")
    want = df.withColumns({name: W.rolled(F.col(c).cast("double"), over, w, a) for name, (c, w, a) in specs.items()})
    same(histories.long_frame_rolling(df, specs, by=["k"], time_col="t", rows_per_slice=rows_per_slice).collect(), want.collect())


@pytest.mark.parametrize("rows_per_slice", [SLICED, None])
def test_long_frames_know_the_first_row(spark, rows_per_slice):
    df = uneven(spark).drop("v").withColumn("v", F.col("i").cast("double"))
    got = histories.long_frame_rolling(df, {"s": ("v", "1min", "sum")}, by=["k"], time_col="t", rows_per_slice=rows_per_slice, age_col="age")
    first = F.min(F.unix_micros("t")).over(Window.partitionBy("k"))
    want = df.withColumn("s", W.rolled("v", W.keyed(df, ["k"], "t"), "1min", "sum")).withColumn("age", (F.unix_micros("t") - first) / 1e6)
    same(got.collect(), want.collect())


def test_dense_frames_of_a_hot_entity_are_not_gone_through_row_by_row(spark, tmp_path):
    """40,000 rows in two hours: window expressions would go through 400 million."""
    rows = spark.range(40_000).select(F.col("id").alias("event_id"), F.lit(0).cast("bigint").alias("user_id"), F.timestamp_seconds(F.col("id") * 0.18).alias("ts"), (F.col("id") % 7).cast("double").alias("value"))
    rows.write.parquet(f"{tmp_path}/events.parquet")
    out = catalogue.QUERIES["hot_entity_windows"](spark, str(tmp_path))
    assert not [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if x.lstrip(" :+-").startswith("Window [sum")]
    last = out.where("event_id = 39998").first()
    assert (last.total, last.most) == (float(sum(i % 7 for i in range(39_998))), 6.0) and abs(last.age_sec - 39_998 * 0.18) < 1e-5


def test_long_frames_of_empty_and_wrong(spark):
    df = uneven(spark, 10)
    out = histories.long_frame_rolling(df.limit(0), {"m": ("v", "1h", "median")}, by=["k"], time_col="t", rows_per_slice=5)
    assert out.count() == 0 and dict(out.dtypes)["m"] == "double"
    with pytest.raises(ValueError):
        histories.long_frame_rolling(df, {"m": ("v", "1h", "mode")}, by=["k"], time_col="t")


@pytest.mark.parametrize("seed", range(6))
def test_frames_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 200))
    us = np.sort(rng.integers(0, 150, n))
    v = rng.choice([np.nan, np.inf, 1.0, 2.0, -3.5], n) + rng.choice([0.0, 0.25, 1e6], n)
    low, high = frames.frame_bounds(us, 20)
    for agg in W.AGGREGATES:
        got = frames.over_frames(v, low, high, agg)
        for i in range(n):
            inside = v[(us >= us[i] - 20) & (us < us[i])]
            x = inside[np.isfinite(inside)]
            if agg == "count":
                want = float((~np.isnan(inside)).sum()) if len(inside) else np.nan
            elif len(x) < (2 if agg == "std" else 1):
                want = np.nan
            else:
                want = {"mean": np.mean, "max": np.max, "min": np.min, "sum": np.sum, "median": np.median, "std": lambda x: np.std(x, ddof=1)}[agg](x)
            assert (np.isnan(got[i]) and np.isnan(want)) or math.isclose(got[i], want, rel_tol=1e-9, abs_tol=1e-6), (agg, i)


def test_long_frames_take_time_near_linear():
    """Frames of 10,000 rows: four times the rows in well under sixteen times the time."""
    took = []
    for n in (40_000, 160_000):
        us, v = np.arange(n), np.random.default_rng(0).random(n)
        began = time.perf_counter()
        frames.rolled(us, [(v, 10_000, a) for a in ("median", "max", "min", "mean", "std")])
        took.append(time.perf_counter() - began)
    assert took[1] < 10 * took[0] + 0.2


def test_small_spread_far_from_zero_does_not_cancel():
    v = 1e9 + np.random.default_rng(1).random(5000)
    low, high = frames.frame_bounds(np.arange(5000), 400)
    got = frames.over_frames(v, low, high, "std")
    assert abs(got[4000] - np.std(v[3600:4000], ddof=1)) < 1e-6


def test_features_in_slices(spark):
    rows = [(at(seconds=15 * (i // 2)), "u1" if i % 4 else f"u{i % 3}", "c", "ns", "pod-a-1", "n", float(i % 17), float(i % 13 + 1), 40.0, float(i // 9), int(i % 50 == 0)) for i in range(1200)]
    df = spark.createDataFrame(rows, f"{TIME} timestamp, pod_uid string, container string, namespace string, pod string, node string, `{FE.WORKING_SET}` double, `{FE.CPU}` double, `{FE.MEMORY_LIMIT}` double, `{FE.RESTARTS}` double, {LABEL} int").dropDuplicates([TIME, "pod_uid"]).cache()
    plain, cut = [FE.build_features(df, rows_per_slice=n) for n in (None, 100)]
    assert plain.columns == cut.columns and set(IDENTITY) <= set(cut.columns)
    key = lambda r: (r[TIME], r.pod_uid)
    for x, y in zip(sorted(plain.collect(), key=key), sorted(cut.collect(), key=key), strict=True):
        for p, q in zip(x, y, strict=True):
            assert p == q or (isinstance(p, float) and math.isclose(p, q, rel_tol=1e-9, abs_tol=1e-12)), (x, y)
