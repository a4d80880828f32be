import dataclasses
import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from failcast.functions.scalars import prior_corrected
from failcast.operators import metrics as M
from failcast.operators import ml
from failcast.operators.calibrate import Calibrator, isotonic_pools
from failcast.schema import LABEL, TIME, ContractError
from helpers import at


def pairs(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p, strict=True)], f"{LABEL} int, score double")


def brute(y, p):
    y, p = np.asarray(y), np.asarray(p)
    points = [(int(((p >= t) & (y == 1)).sum()), int((p >= t).sum())) for t in sorted(set(p), reverse=True)]
    n, ap, before = y.sum(), 0.0, 0
    for tp, k in points:
        ap += (tp - before) / n * tp / k
        before = tp
    auc = np.mean([(a > b) + 0.5 * (a == b) for a, b in itertools.product(p[y == 1], p[y == 0])])
    at_recall = lambda r: max(tp / k for tp, k in points if tp / n >= r)
    return {"pr_auc": ap, "roc_auc": auc, "brier_score": float(((p - y) ** 2).mean()), "precision_at_recall_0_5": at_recall(0.5), "precision_at_recall_0_8": at_recall(0.8)}


@pytest.mark.parametrize("seed", [0, 1])
def test_headline_equals_brute_force_with_ties(spark, seed):
    rng = np.random.default_rng(seed)
    p = rng.integers(0, 12, 150) / 11
    y = (rng.random(150) < p).astype(int)
    got = M.headline_metrics(pairs(spark, y, p))
    for k, v in brute(y, p).items():
        assert math.isclose(got[k], v, abs_tol=1e-12), k


def test_perfect_single_class_and_empty(spark):
    got = M.headline_metrics(pairs(spark, [0, 0, 1, 1], [0, 0, 1, 1]))
    assert (got["brier_score"], got["pr_auc"], got["precision_at_recall_0_8"], got["roc_auc"]) == (0, 1, 1, 1)
    assert M.acceptance(got) == {"brier_le_0_10": True, "precision_at_recall_0_8_ge_0_5": True}
    assert M.headline_metrics(pairs(spark, [1, 1], [0.2, 0.9]))["roc_auc"] is None
    with pytest.raises(ContractError):
        M.headline_metrics(pairs(spark, [], []))


def test_lead_time(spark):
    rows = [(at(seconds=30 * i), "u", "c", int(i == 59), 0.9 if i >= 20 else 0.1) for i in range(60)]
    df = spark.createDataFrame(rows, f"{TIME} timestamp, pod_uid string, container string, {LABEL} int, score double")
    got = M.lead_time_metrics(df)
    assert got["detection_rate_at_5min"] == 1.0 and got["lead_time_p50_min_at_5min"] == 19.5 and got["detection_rate_at_30min"] == 0.0
    none = M.lead_time_metrics(df.withColumn(LABEL, F.lit(0)))
    assert set(none) == {f"lead_time_p50_min_at_{h}min" for h in (5, 10, 15, 30)}


def test_small_slices_go_and_slices_without_positives_keep_brier(spark):
    rows = [("big", int(i % 5 == 0), 0.5, "x") for i in range(200)] + [("tiny", 1, 0.5, "y")] * 5 + [("none", 0, 0.5, "y")] * 150
    df = spark.createDataFrame(rows, f"namespace string, {LABEL} int, score double, node string")
    got = {(r.slice_col, r.slice_value): r for r in M.slice_metrics(df).collect()}
    assert set(got) == {("namespace", "big"), ("namespace", "none"), ("node", "x"), ("node", "y")}
    assert got["namespace", "none"].pr_auc is None and got["namespace", "none"].brier_score == 0.25


def test_rule(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 0.85, 0.91, 0.99, 0.9, None)], "feat_mem_pct_of_limit__5min_max double")
    assert [r.p for r in df.select(M.baseline_rule(df).alias("p")).collect()] == [0, 0, 1, 1, 1, 0]
    other = df.withColumnRenamed("feat_mem_pct_of_limit__5min_max", "feat_mem_pct_of_limit")
    assert other.select(M.two_class(M.baseline_rule(other)).alias("p")).first().p == [1.0, 0.0]
    with pytest.raises(KeyError):
        M.baseline_rule(df.withColumnRenamed("feat_mem_pct_of_limit__5min_max", "x"))


def test_prior_correction(spark):
    df = spark.createDataFrame([(0.5,)], "p double")
    assert math.isclose(df.select(prior_corrected("p", 0.1)).first()[0], 1 / 11)
    assert df.select(prior_corrected("p", 1.0)).first()[0] == 0.5
    for bad in (0, 1.5):
        with pytest.raises(ValueError):
            prior_corrected("p", bad)


@pytest.mark.parametrize("method", ["isotonic", "platt"])
def test_calibration(spark, tmp_path, method):
    rng = np.random.default_rng(0)
    p = rng.random(1000)
    df = pairs(spark, rng.random(1000) < p**2, p)
    made = Calibrator.fit(df, method=method)
    made.save(str(tmp_path))
    rows = Calibrator.load(str(tmp_path), method).transform(df).orderBy("score").collect()
    c = [r.calibrated for r in rows]
    assert all(a <= b + 1e-12 for a, b in itertools.pairwise(c)) and 0 <= c[0] and c[-1] <= 1
    assert abs(np.mean(c) - np.mean([r[LABEL] for r in rows])) < 0.02


def test_calibration_errors(spark):
    for y, p in (([0, 0], [0.1, 0.2]), ([0, 1], [0.1, 1.2]), ([], [])):
        with pytest.raises(ContractError):
            Calibrator.fit(pairs(spark, y, p))
    with pytest.raises(ValueError):
        Calibrator.fit(pairs(spark, [0, 1], [0.1, 0.2]), method="other")


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, 5))
    y = rng.random(500) < 1 / (1 + np.exp(-2 * x[:, 0] + x[:, 1]))
    rows = [(*map(float, r), int(t)) for r, t in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, ", ".join([*(f"feat_{i} double" for i in range(5)), f"{LABEL} int"]))
    return df, ml.train(df, df, trials=1, max_trees=4)


def test_explanations_add_up_and_are_ranked(trained):
    df, made = trained
    rows = made.explain(df.limit(40), k=3).collect()
    scores = [r.score for r in made.score(df.limit(40)).collect()]
    for r, s in zip(rows, scores, strict=True):
        assert math.isclose(r.prediction, s, abs_tol=1e-9)
        top = r.top_contributors
        assert [t["rank"] for t in top] == [1, 2, 3]
        assert all(abs(a["contribution_logodds"]) >= abs(b["contribution_logodds"]) for a, b in itertools.pairwise(top))
        for t in top:
            assert t["direction"] == ("up" if t["contribution_logodds"] > 0 else "down")
            without = 1 / (1 + math.exp(-(r.prediction_logodds - t["contribution_logodds"])))
            assert math.isclose(t["contribution_prob_delta"], r.prediction - without, abs_tol=1e-9)
    assert made.pr_auc > 0.7


def test_shapley_equals_the_definition(trained):
    _, made = trained
    trees = ml.exported(made.model)
    x = np.random.default_rng(3).standard_normal((3, 5))

    def value(tree, row, known, at=0):
        f = int(tree["feature"][at])
        if f < 0:
            return tree["value"][at]
        left, right = int(tree["left"][at]), int(tree["right"][at])
        if f in known:
            return value(tree, row, known, left if row[f] <= tree["threshold"][at] else right)
        return sum(tree["cover"][c] / tree["cover"][at] * value(tree, row, known, c) for c in (left, right))

    phi, base = ml.shapley(trees, x)
    for i, row in enumerate(x):
        game = {s: sum(value(t, row, s) for t in trees) for n in range(6) for s in map(frozenset, itertools.combinations(range(5), n))}
        assert math.isclose(base, game[frozenset()], abs_tol=1e-9)
        for j in range(5):
            want = sum(math.factorial(len(s)) * math.factorial(4 - len(s)) / 120 * (game[s | {j}] - game[s]) for s in game if j not in s)
            assert math.isclose(phi[i, j], want, abs_tol=1e-9)


def test_long_paths_have_no_table_and_the_same_values(trained, monkeypatch):
    _, made = trained
    trees, x = ml.exported(made.model), np.random.default_rng(4).standard_normal((50, 5))
    want, base = ml.shapley(trees, x)
    monkeypatch.setattr(ml, "TABLE_FEATURES", 1)
    got, same = ml.shapley(trees, x)
    assert np.allclose(got, want, atol=1e-12) and base == same
    assert any(leaf.table is None for leaf in ml.leaf_tables(trees)[0])


def test_tables_are_faster_than_subsets():
    """100 trees of depth 6 over 12 features."""
    rng = np.random.default_rng(5)

    def grown(depth):
        nodes = {k: [] for k in ("feature", "threshold", "left", "right", "value", "cover")}

        def add(level, cover):
            at = len(nodes["feature"])
            for k, v in (("feature", int(rng.integers(12)) if level else -1), ("threshold", float(rng.normal())), ("left", -1), ("right", -1), ("value", float(rng.normal())), ("cover", cover)):
                nodes[k].append(v)
            if level:
                nodes["left"][at], nodes["right"][at] = add(level - 1, cover * 0.6), add(level - 1, cover * 0.4)
            return at

        add(depth, 1000.0)
        return {k: np.array(v) for k, v in nodes.items()}

    trees, x = [grown(6) for _ in range(100)], rng.normal(size=(400, 12))
    leaves, _ = ml.leaf_tables(trees)
    began = time.perf_counter()
    fast = ml.shapley_by_tables(leaves, x)
    middle = time.perf_counter()
    slow = ml.shapley_by_tables([dataclasses.replace(leaf, table=None) for leaf in leaves], x)
    assert np.allclose(fast, slow, atol=1e-9) and time.perf_counter() - middle > 3 * (middle - began)


def test_isotonic_pools_equal_adjacent_violators(spark):
    rng = np.random.default_rng(7)
    for scores, ranges in ((rng.random(1500) * 1e-4, 64), (rng.integers(0, 30, 800) / 30, 1024), (rng.random(300), 2), (np.full(9, 0.5), 8)):
        y = (rng.random(len(scores)) < scores / scores.max()).astype(int)
        blocks = []  # [sum, n, low, high] of pools, merged while they fall
        for p in sorted(set(scores)):
            blocks.append([int(y[scores == p].sum()), int((scores == p).sum()), p, p])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                s, n, _, high = blocks.pop()
                blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2], high]
        df = pairs(spark, y, scores)
        got = [tuple(r) for r in isotonic_pools(df, ranges=ranges).orderBy("low").collect()]
        assert got == [(low, high, s / n, n) for s, n, low, high in blocks]


def test_ranges_of_rare_scores_are_even(spark):
    """All scores below 0.0002, half of them nearly the same."""
    rng = np.random.default_rng(9)
    p = np.concatenate((rng.random(20_000) * 2e-4, 1e-5 + rng.random(20_000) * 1e-9))
    df = pairs(spark, (rng.random(40_000) < 0.01).astype(int), p)
    sizes = [r["count"] for r in M.with_score_ranges(df.withColumnRenamed("score", "p")).groupBy("slice").count().collect()]
    assert len(sizes) > 900 and max(sizes) < 3 * 40_000 / M.SLICES
    few = df.limit(1500).cache()
    got = M.headline_metrics(few)
    rows = few.collect()
    for k, v in brute([r[LABEL] for r in rows], [r.score for r in rows]).items():
        assert math.isclose(got[k], v, abs_tol=1e-12), k


def test_feature_checks(spark, trained):
    df, _ = trained
    with pytest.raises(ContractError, match="no feat_"):
        ml.features_and_target(df.select(LABEL))
    with pytest.raises(ContractError, match="different"):
        ml.same_features(df, df.drop("feat_0"))
    got = {r.feature: r for r in M.label_correlations(df.withColumn("feat_leak", F.col(LABEL) * 2), ["feat_0", "feat_leak"]).collect()}
    assert got["feat_leak"].suspicious and not got["feat_0"].suspicious


def test_search_prunes_stops_early_and_refits(spark):
    rng = random.Random(1)
    rows = [(float(i % 7), rng.random(), int(i % 7 > 4 or rng.random() < 0.05)) for i in range(600)]
    df = spark.createDataFrame(rows, f"feat_a double, feat_b double, {LABEL} int")
    learn, check = df.limit(400), df.exceptAll(df.limit(400))
    made = ml.train(learn, check, trials=5, max_trees=16, refit=True)
    assert len(made.trials) == 5 and 1 <= sum(not t["pruned"] for t in made.trials) < 5
    assert all(("16" in t["pr_auc_by_trees"]) == (not t["pruned"]) for t in made.trials)
    assert made.trees == made.model.getNumTrees <= 16
    assert made.pr_auc == max(t["pr_auc_by_trees"].get("16", 0) for t in made.trials) > 0.8
