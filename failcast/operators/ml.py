"""Gradient-boosted trees: search, scores, and exact per-row explanations.

The search (see ``search``) proposes parameter sets from what earlier ones scored and fits them in brackets
of successive halving, with trees as the resource; a score is the average precision on validation rows, after
the prior correction. A fit of all trees stops early once validation rows no longer gain.
The best one's number of trees is kept, and a model of so many trees is fitted again on
training and validation rows together if asked.

Explanations are Shapley values of the trees' log-odds for the distribution of training rows
that the trees hold (node counts). For each tree a leaf's value is shared over the distinct
features on its path by the weighted sum over their subsets, which is exact. Which of a path's splits a
row follows is one of few sets, so each leaf has a table of what it adds for every such set, made
once for a model; a row costs one lookup for each leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.functions.scalars import prior_corrected
from failcast.operators.features import feature_columns
from failcast.operators.metrics import headline_by
from failcast.operators.search import Choice, Range, search
from failcast.schema import LABEL, ContractError, require

# The response's contributor rows.
CONTRIBUTORS = "array<struct<feature:string,contribution_logodds:double,contribution_prob_delta:double,direction:string,rank:int>>"
EXPLAINED = f"prediction double, prediction_logodds double, base_value double, top_contributors {CONTRIBUTORS}"
#: What a missing feature is for the trees: below every value.
MISSING = -1e30


def features_and_target(df: DataFrame, label: str = LABEL) -> list[str]:
    """The sorted features; raises without features or label."""
    require(df, [label], "features_and_target")
    names = feature_columns(df)
    if not names:
        raise ContractError("features_and_target: no feat_ columns")
    return names


def same_features(*splits: DataFrame) -> list[str]:
    names = features_and_target(splits[0])
    if any(features_and_target(s) != names for s in splits[1:]):
        raise ContractError("the splits have different features")
    return names


def assembled(df: DataFrame, names: list[str]) -> DataFrame:
    filled = df.withColumns({f"__f{i}": F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for i, c in enumerate(names)})
    columns = [f"__f{i}" for i in range(len(names))]
    return VectorAssembler(inputCols=columns, outputCol="__features").transform(filled).drop(*columns)


@dataclass
class Trained:
    model: GBTClassificationModel
    names: list[str]
    params: dict
    sample_ratio: float
    pr_auc: float
    trees: int = 0
    trials: list[dict] = field(default_factory=list)

    def score(self, df: DataFrame, output: str = "score", correct: bool = True) -> DataFrame:
        """``df`` with the probability, under the true prior if ``correct``."""
        out = self.model.transform(assembled(df, self.names)).withColumn("__p", vector_to_array("probability")[1])
        p = prior_corrected("__p", self.sample_ratio) if correct else F.col("__p")
        return out.withColumn(output, p).drop("__p", "__features", "rawPrediction", "probability", "prediction")

    def explain(self, df: DataFrame, k: int = 3) -> DataFrame:
        return explained(df, self.model, self.names, k)


#: What the search may choose.
SPACE = {
    "maxDepth": Choice((3, 4, 5, 6)),
    "stepSize": Range(10**-1.5, 10**-0.3, log=True),
    "subsamplingRate": Range(0.6, 1.0),
    "minInstancesPerNode": Choice((1, 5, 20, 50)),
    "maxBins": Choice((32, 64)),
    "featureSubsetStrategy": Choice(("all", "0.7")),
}


#: Paths of more features have no table, which would double with each.
TABLE_FEATURES = 10
#: Of the trees, what the first rung of the widest bracket has.
FIRST_SHARE = 0.125
#: Less gain than this share on validation rows ends a fit.
LEAST_GAIN = 0.001


def train(train_df: DataFrame, val_df: DataFrame, *, sample_ratio: float = 1.0, trials: int = 50, max_trees: int = 100, label: str = LABEL, seed: int = 42, refit: bool = False) -> Trained:
    """Search for the parameters of the best average precision on validation rows.

    ``trials`` of the result say for each its parameters, its score after so many trees in each rung, and whether it was pruned.
    """
    if trials < 1:
        raise ValueError("trials must be at least 1")
    names = same_features(train_df, val_df)
    learn = assembled(train_df, names).select("__features", F.col(label).cast("double").alias("label"), F.lit(False).alias("__check")).cache()
    check = assembled(val_df, names).select("__features", F.col(label).cast("double").alias("label"), F.lit(True).alias("__check")).cache()
    both = learn.unionByName(check)
    whole: list[tuple[float, dict, GBTClassificationModel]] = []

    def fit(params: dict, trees: int, rows: DataFrame, stops: bool) -> GBTClassificationModel:
        stop = {"validationIndicatorCol": "__check", "validationTol": LEAST_GAIN} if stops else {}
        return GBTClassifier(featuresCol="__features", labelCol="label", maxIter=trees, seed=seed, **params, **stop).fit(rows)

    def judged(params: dict, trees: int) -> float:
        model = fit(params, trees, both if trees == max_trees else learn, trees == max_trees)
        scored = model.transform(check).select(F.col("label").cast("int").alias(label), prior_corrected(vector_to_array("probability")[1], sample_ratio).alias("score"))
        pr_auc = float(headline_by(scored, label=label).first()["pr_auc"] or 0.0)
        if trees == max_trees and (not whole or pr_auc > whole[0][0]):
            whole[:] = [(pr_auc, params, model)]
        return pr_auc

    try:
        done = search(SPACE, judged, trials=trials, most=max_trees, least=max(1, int(max_trees * FIRST_SHARE)), seed=seed)
        pr_auc, params, model = whole[0]
        best = Trained(model, names, params, sample_ratio, pr_auc, model.getNumTrees)
        if refit:
            best.model = fit(params, best.trees, both, False)
    finally:
        learn.unpersist()
        check.unpersist()
    best.trials = [t.params | {"pr_auc_by_trees": {str(k): v for k, v in t.scores.items()}, "pruned": t.pruned} for t in done]
    return best


def exported(model: GBTClassificationModel) -> list[dict]:
    """Trees as arrays: feature (-1 at leaves), threshold, left, right, value in log-odds, cover."""
    out = []
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        nodes: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "value": [], "cover": []}

        def walk(node) -> int:
            at = len(nodes["feature"])
            leaf = node.numDescendants() == 0
            stats = node.impurityStats()
            for key, v in (("feature", -1 if leaf else node.split().featureIndex()), ("threshold", 0.0 if leaf else node.split().threshold()), ("left", -1), ("right", -1), ("value", 2.0 * weight * node.prediction() if leaf else 0.0), ("cover", float(stats.count()))):
                nodes[key].append(v)
            if not leaf:
                nodes["left"][at] = walk(node.leftChild())
                nodes["right"][at] = walk(node.rightChild())
            return at

        walk(tree._java_obj.rootNode())
        out.append({k: np.array(v) for k, v in nodes.items()})
    return out


def _paths(tree: dict) -> list[tuple[float, list[tuple[int, float, float, float]]]]:
    """Leaves: value and, per distinct feature on the path, (feature, low, high, share of rows that follow)."""
    out = []

    def go(at: int, seen: dict[int, tuple[float, float, float]]) -> None:
        f = int(tree["feature"][at])
        if f < 0:
            out.append((float(tree["value"][at]), [(k, *v) for k, v in seen.items()]))
            return
        low, high, share = seen.get(f, (-np.inf, np.inf, 1.0))
        t, cover = float(tree["threshold"][at]), max(float(tree["cover"][at]), 1e-12)
        for child, bounds in ((tree["left"][at], (low, min(high, t))), (tree["right"][at], (max(low, t), high))):
            go(int(child), seen | {f: (*bounds, share * float(tree["cover"][child]) / cover)})

    go(0, {})
    return out


@dataclass(frozen=True)
class Leaf:
    """A leaf's value, and the features on its path with their bounds and the share of rows that follow each."""

    value: float
    features: list[int]
    low: list[float]
    high: list[float]
    share: np.ndarray
    #: (m, 2^m): what the leaf adds to each feature for every set of splits that a row may follow, as bits; None where m is large.
    table: np.ndarray | None


def _added(value: float, share: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """(m, rows): what a leaf adds to the features on its path, for 0/1 rows of the splits followed."""
    m = len(share)
    out = np.empty(follows.shape)
    weight = np.array([factorial(s) * factorial(m - 1 - s) / factorial(m) for s in range(m)])
    for j in range(m):
        # Elementary sums over subsets of the other features, by subset size.
        sums = np.zeros(follows.shape)
        sums[0] = 1
        for i in range(m):
            if i != j:
                sums[1:] = sums[1:] * share[i] + sums[:-1] * follows[i]
                sums[0] = sums[0] * share[i]
        out[j] = value * (follows[j] - share[j]) * (weight @ sums)
    return out


def _leaf(value: float, path: list[tuple[int, float, float, float]]) -> Leaf:
    m, share = len(path), np.array([p[3] for p in path])
    table = None
    if m <= TABLE_FEATURES:
        table = _added(value, share, ((np.arange(1 << m) >> np.arange(m)[:, None]) & 1).astype(float))
    return Leaf(value, [p[0] for p in path], [p[1] for p in path], [p[2] for p in path], share, table)


def leaf_tables(trees: list[dict]) -> tuple[list[Leaf], float]:
    """Every leaf below a split, and the base value; made once for a model."""
    leaves, base = [], 0.0
    for tree in trees:
        for value, path in _paths(tree):
            base += value * float(np.prod([p[3] for p in path]))
            if path:
                leaves.append(_leaf(value, path))
    return leaves, base


def shapley_by_tables(leaves: list[Leaf], x: np.ndarray) -> np.ndarray:
    """Contributions (rows x features) in log-odds: one lookup for each row, leaf and feature on its path."""
    phi = np.zeros((x.shape[1], len(x)))  # features first: a leaf adds to whole columns
    columns = np.ascontiguousarray(x.T)
    for leaf in leaves:
        follows = [(columns[f] > low) & (columns[f] <= high) for f, low, high in zip(leaf.features, leaf.low, leaf.high, strict=True)]
        if leaf.table is None:
            found = _added(leaf.value, leaf.share, np.stack(follows).astype(float))
        else:
            found = leaf.table[:, sum(f.astype(np.int64) << bit for bit, f in enumerate(follows))]
        for f, own in zip(leaf.features, found, strict=True):
            phi[f] += own
    return phi.T


def shapley(trees: list[dict], x: np.ndarray) -> tuple[np.ndarray, float]:
    """Contributions (rows x features) and the base value, in log-odds."""
    tables, base = leaf_tables(trees)
    return shapley_by_tables(tables, x), base


def top_contributors(phi: np.ndarray, logodds: np.ndarray, names: list[str], k: int) -> list[list[dict]]:
    """The k largest contributions of each row, by size."""
    p = 1 / (1 + np.exp(-logodds))
    out = []
    for i, order in enumerate(np.argsort(-np.abs(phi), axis=1, kind="stable")[:, :k]):
        row = []
        for rank, j in enumerate(order.tolist(), 1):
            c = float(phi[i, j])
            row.append({"feature": names[j], "contribution_logodds": c, "contribution_prob_delta": float(p[i] - 1 / (1 + np.exp(-(logodds[i] - c)))), "direction": "up" if c > 0 else "down", "rank": rank})
        out.append(row)
    return out


def explained(df: DataFrame, model: GBTClassificationModel, names: list[str], k: int = 3) -> DataFrame:
    """``df`` with prediction, log-odds, base value and the top contributors of each row."""
    return explained_by(df, exported(model), names, k)


def as_trees(nodes: list[dict]) -> list[dict]:
    """Trees from plain lists, in the form of ``exported``."""
    return [{k: np.array(v) for k, v in tree.items()} for tree in nodes]


def explained_by(df: DataFrame, trees: list[dict], names: list[str], k: int = 3) -> DataFrame:
    """``explained`` for trees that were exported before."""
    spark = df.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(leaf_tables(trees))  # as large as the model, whatever the data
    vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in names])

    @F.pandas_udf(EXPLAINED)
    def explain(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables, base = held.value
        for x in batches:
            matrix = np.array(x.tolist(), float).reshape(len(x), len(names))
            phi = shapley_by_tables(tables, matrix)
            logodds = base + phi.sum(1)
            yield pd.DataFrame({"prediction": 1 / (1 + np.exp(-logodds)), "prediction_logodds": logodds, "base_value": base, "top_contributors": top_contributors(phi, logodds, names, k)})

    return df.withColumn("__e", explain(vector)).select(*df.columns, "__e.*")


def top_k_by_size(values: Column, k: int = 3) -> Column:
    """Array of (feature, contribution) structs -> the k largest by size, with ranks; built-in functions alone."""
    ordered = F.array_sort(values, lambda a, b: F.when(F.abs(a["contribution"]) > F.abs(b["contribution"]), -1).when(F.abs(a["contribution"]) < F.abs(b["contribution"]), 1).when(a["feature"] < b["feature"], -1).otherwise(1))
    return F.transform(F.slice(ordered, 1, k), lambda x, i: F.struct(x["feature"].alias("feature"), x["contribution"].alias("contribution"), F.when(x["contribution"] > 0, "up").otherwise("down").alias("direction"), (i + 1).cast("int").alias("rank")))
