import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from failcast.operators import windows as W
from failcast.schema import ContractError
from helpers import at

SPECIAL = st.one_of(st.floats(-1e3, 1e3), st.none(), st.just(math.nan), st.just(math.inf))


def brute(rows, width, agg):
    """rows: (key, second, value); NaN and None are missing, infinities too but for count."""
    out = []
    for key, t, _ in rows:
        inside = [v for k, s, v in rows if k == key and t - width <= s < t]
        numbers = sorted(v for v in inside if v is not None and math.isfinite(v))
        if agg == "count":
            out.append(float(sum(v is not None and not math.isnan(v) for v in inside)) if inside else None)
        elif not numbers or (agg == "std" and len(numbers) < 2):
            out.append(None)
        else:
            mean, mid = sum(numbers) / len(numbers), len(numbers) // 2
            out.append(
                {
                    "mean": mean,
                    "max": numbers[-1],
                    "min": numbers[0],
                    "sum": sum(numbers),
                    "median": numbers[mid] if len(numbers) % 2 else (numbers[mid - 1] + numbers[mid]) / 2,
                    "std": math.sqrt(sum((v - mean) ** 2 for v in numbers) / (len(numbers) - 1)) if agg == "std" else None,
                }[agg]
            )
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40), SPECIAL), min_size=1, max_size=25))
def test_rolling_equals_brute_force(spark, rows):
    df = spark.createDataFrame([(i, k, at(seconds=s), v) for i, (k, s, v) in enumerate(rows)], "i int, k string, t timestamp, v double")
    over = W.keyed(df, ["k"], "t")
    got = df.select("i", *[W.rolled("v", over, "10s", a).alias(a) for a in W.AGGREGATES]).orderBy("i").collect()
    for a in W.AGGREGATES:
        for x, y in zip([r[a] for r in got], brute(rows, 10, a), strict=True):
            assert (x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-6, abs_tol=1e-6)), a


def test_the_future_changes_nothing(spark):
    rng = random.Random(0)
    rows = [(k, s, rng.random()) for k in "ab" for s in range(0, 60, 3)]
    later = [(k, s, v if s < 30 else v + 100) for k, s, v in rows]

    def features(data):
        df = spark.createDataFrame([(k, at(seconds=s), float(v)) for k, s, v in data], "k string, t timestamp, v double")
        over = W.keyed(df, ["k"], "t")
        out = df.select("k", "t", W.rolled("v", over, "20s", "mean").alias("m"), W.value_before("v", over, "5s").alias("b"))
        return {(r.k, r.t): (r.m, r.b) for r in out.collect()}

    a, b = features(rows), features(later)
    for k, s, _ in rows:
        if s <= 30:
            key = next(x for x in a if x[0] == k and x[1].second == s and x[1].minute == 0)
            assert a[key] == b[key]


def test_growth_and_guard(spark):
    df = spark.createDataFrame([("a", at(seconds=s), v) for s, v in ((0, 10.0), (60, 15.0), (120, 0.0), (180, 5.0))], "k string, t timestamp, v double")
    got = [r.g for r in W.grouped_time_growth_rate(df, by=["k"], time_col="t", value_col="v", window="1min", new_col="g").orderBy("t").collect()]
    assert got == [None, 0.5, -1.0, None]


def test_left_closed_mean_and_errors(spark):
    df = spark.createDataFrame([("a", at(seconds=30 * i), 0.1 * (i + 1)) for i in range(6)], "k string, t timestamp, v double")
    got = [r.m for r in W.grouped_time_rolling(df, by=["k"], time_col="t", value_col="v", window=90, agg="mean", new_col="m").orderBy("t").collect()]
    assert got[0] is None and math.isclose(got[2], 0.15)
    with pytest.raises(ContractError, match="missing columns"):
        W.grouped_time_rolling(df, by=["k"], time_col="t", value_col="x", window=90, agg="mean", new_col="m")
    with pytest.raises(ValueError):
        W.grouped_time_rolling(df, by=["k"], time_col="t", value_col="v", window=90, agg="mode", new_col="m")
    empty = W.grouped_time_rolling(df.limit(0), by=["k"], time_col="t", value_col="v", window="5min", agg="max", new_col="m")
    assert empty.count() == 0 and dict(empty.dtypes)["m"] == "double"


def test_asof_join_takes_the_last_at_or_before(spark):
    left = spark.createDataFrame([("a", at(1), 1), ("a", at(5), 2), ("b", at(5), 3)], "k string, t timestamp, i int")
    right = spark.createDataFrame([("a", at(1), 10), ("a", at(4), 11), ("a", at(9), 12)], "k string, t timestamp, x int")
    got = W.asof_join(left, right, by=["k"], time_col="t", values=["x"]).orderBy("i").collect()
    assert [r.x for r in got] == [10, 11, None]
    near = W.asof_join(left, right, by=["k"], time_col="t", values=["x"], tolerance="30s").orderBy("i").collect()
    assert [r.x for r in near] == [10, None, None]


def test_windows_share_one_exchange(spark):
    df = spark.createDataFrame([("a", at(1), 1.0)], "k string, t timestamp, v double")
    over = W.keyed(df, ["k"], "t")
    out = df.select(*[W.rolled("v", over, w, a).alias(f"{a}{i}") for i, w in enumerate(("5min", "15min")) for a in ("mean", "max")], W.growth("v", over, "5min"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_merged_intervals(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 3, 5), ("a", 7, 8), ("a", 2, 4), ("b", 1, 2)], "k string, s int, e int")
    got = sorted(map(tuple, W.merged_intervals(df, by=["k"], start="s", end="e").select("k", "s", "e").collect()))
    assert got == [("a", 1, 5), ("a", 7, 8), ("b", 1, 2)]
    assert W.merged_intervals(df.where(F.lit(False)), by=["k"], start="s", end="e").count() == 0
