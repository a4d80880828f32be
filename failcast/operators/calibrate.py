"""Probability calibration: isotonic steps or a logistic curve over the score.

Isotonic regression is the slope of the greatest convex minorant of cumulated labels over cumulated
rows, in the order of scores. Labels are summed up for each distinct score; ranges of scores get
the totals of those below; each range keeps the corners of its own minorant, and ranges are put together
``FAN`` at a time, each time dropping what is no corner any more. What is left are the pools. With labels of 0 and 1
corners are whole-numbered points of a convex chain, so n rows with p positive ones have a small multiple
of (n p)^(1/3) pools at most, however many scores there are: that bounds the last merge, and the model.
"""

from __future__ import annotations

import pandas as pd
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from failcast.deploy import ship
from failcast.functions.scalars import clip
from failcast.operators.metrics import with_score_ranges
from failcast.schema import LABEL, ContractError, require

METHODS = ("isotonic", "platt")
RANGES, FAN = 1024, 32
_CORNER = "range int, rows long, positives long, score double, next_score double, rows_before long, positives_before long"


def convex_corners(start: tuple[int, int], points: list[tuple[int, int]]) -> list[int]:
    """Which of the points, ascending in x, are corners of the greatest convex minorant from ``start`` on; the last always is."""
    chain, kept = [start], [-1]
    for i, (x, y) in enumerate(points):
        while len(chain) > 1 and (chain[-1][1] - chain[-2][1]) * (x - chain[-2][0]) >= (y - chain[-2][1]) * (chain[-1][0] - chain[-2][0]):
            chain.pop()
            kept.pop()
        chain.append((x, y))
        kept.append(i)
    return kept[1:]


def _corners_of(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("rows", kind="stable").reset_index(drop=True)
    start = (int(pdf["rows_before"].iloc[0]), int(pdf["positives_before"].iloc[0]))
    out = pdf.iloc[convex_corners(start, list(zip(pdf["rows"].tolist(), pdf["positives"].tolist(), strict=True)))].copy()
    out["rows_before"], out["positives_before"] = start
    return out


def isotonic_pools(rows: DataFrame, *, score: str = "score", label: str = LABEL, ranges: int = RANGES) -> DataFrame:
    """(low, high, value, n): the pools of scores, ascending, with their share of positive labels.

    Labels other than 1 count as 0; rows without a score are left out.
    """
    ship(rows.sparkSession)
    p = F.col(score).cast("double")
    counts = rows.where(p.isNotNull() & ~F.isnan(p)).groupBy(p.alias("p")).agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("s"))
    counts = with_score_ranges(counts, output="range", ranges=ranges)
    over = Window.orderBy("range")  # of at most ``ranges`` rows
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("range").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("p").alias("low"))
    zero = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    totals = totals.select(F.col("range").alias("__range"), zero("n").alias("rows_before"), zero("s").alias("positives_before"), F.lead("low").over(over).alias("after"))
    own = Window.partitionBy("range").orderBy("p")
    up = own.rowsBetween(Window.unboundedPreceding, 0)
    points = counts.join(F.broadcast(totals), F.col("range") == F.col("__range")).select(
        "range",
        (F.col("rows_before") + F.sum("n").over(up)).alias("rows"),
        (F.col("positives_before") + F.sum("s").over(up)).alias("positives"),
        F.col("p").alias("score"),
        F.coalesce(F.lead("p").over(own), "after").alias("next_score"),
        "rows_before",
        "positives_before",
    )
    corners, left = points.groupBy("range").applyInPandas(_corners_of, _CORNER), ranges
    while left > 1:
        corners = corners.withColumn("range", F.floor(F.col("range") / FAN).cast("int")).groupBy("range").applyInPandas(_corners_of, _CORNER)
        left = -(-left // FAN)
    order = Window.orderBy("rows")  # of the pools
    lag = lambda c, first: F.coalesce(F.lag(c).over(order), first)
    n, s = F.col("rows") - lag("rows", F.lit(0)), F.col("positives") - lag("positives", F.lit(0))
    least = counts.agg(F.min("p")).scalar()
    return corners.select(F.lag("next_score").over(order).alias("low"), F.col("score").alias("high"), (s / n).alias("value"), n.alias("n")).withColumn("low", F.coalesce("low", least))


class Calibrator:
    """``fit`` on (score, label) rows, ``transform`` adds the calibrated score."""

    def __init__(self, method: str, model, score: str):
        self.method, self.model, self.score = method, model, score

    @classmethod
    def fit(cls, df: DataFrame, *, score: str = "score", label: str = LABEL, method: str = "isotonic") -> Calibrator:
        if method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}")
        require(df, [score, label], "Calibrator.fit")
        rows = df.select(F.col(score).cast("double").alias("p"), F.col(label).cast("double").alias("y"))
        low, high, n_pos = rows.agg(F.min("p"), F.max("p"), F.sum("y")).first()
        if low is None:
            raise ContractError("Calibrator.fit: no rows")
        if low < 0 or high > 1:
            raise ContractError("Calibrator.fit: scores must be between 0 and 1")
        if not n_pos:
            raise ContractError("Calibrator.fit: no positive rows")
        if method == "isotonic":
            pools = isotonic_pools(rows, score="p", label="y")
            # Pools rise already, so this only builds the model of them, from both ends of each.
            ends = pools.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("p"), F.col("value").alias("y"), F.col("n").cast("double").alias("n"))
            model = IsotonicRegression(featuresCol="p", labelCol="y", weightCol="n").fit(ends)
        else:
            model = LogisticRegression(featuresCol="v", labelCol="y", regParam=0.0, maxIter=500, tol=1e-12).fit(VectorAssembler(inputCols=["p"], outputCol="v").transform(rows))
        return cls(method, model, score)

    def transform(self, df: DataFrame, output: str = "calibrated") -> DataFrame:
        rows = df.withColumn("__p", F.col(self.score).cast("double"))
        if self.method == "isotonic":
            out = self.model.setFeaturesCol("__p").setPredictionCol("__c").transform(rows)
        else:
            with_vector = VectorAssembler(inputCols=["__p"], outputCol="__v").transform(rows)
            model = self.model.setFeaturesCol("__v").setProbabilityCol("__pr").setRawPredictionCol("__raw").setPredictionCol("__hard")
            out = model.transform(with_vector).withColumn("__c", vector_to_array("__pr")[1]).drop("__v", "__pr", "__raw", "__hard")
        return out.withColumn(output, clip("__c", 0.0, 1.0)).drop("__p", "__c")

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/{self.method}")

    @classmethod
    def load(cls, path: str, method: str, score: str = "score") -> Calibrator:
        model = (IsotonicRegressionModel if method == "isotonic" else LogisticRegressionModel).load(f"{path}/{method}")
        return cls(method, model, score)
