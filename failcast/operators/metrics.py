"""Ranking, calibration, lead-time and slice metrics as aggregates.

Scores are counted per distinct value first. Running sums over the distinct scores of a group
then give precision and recall at every threshold; average precision, ROC area and the best
precision at a recall are sums and maxima over them. Running sums go through ``SLICES`` ranges of
scores, cut at quantiles of the distinct scores that there are, so that scores of a rare event, which
are nearly all close to 0, spread as evenly as others: totals of the ranges are carried from
one to the next first, then the scores inside each are summed up, so no task orders all scores of a
group. Ties count together. NULL stands for an undefined number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from failcast.functions.scalars import MICRO, micros
from failcast.schema import DECISION_THRESHOLD, ENTITY, HORIZONS_MINUTES, LABEL, LEAST_SLICE_ROWS, TIME, ContractError, require

SLICES = 1024
HEADLINE = ("brier_score", "pr_auc", "roc_auc", "precision_at_recall_0_5", "precision_at_recall_0_8", "recall_at_threshold", "precision_at_threshold")


def with_score_ranges(counts: DataFrame, score: str = "p", output: str = "slice", ranges: int = SLICES) -> DataFrame:
    """``counts`` with the number of the score's range, ascending; ranges hold about as many rows each. Null scores are in the first."""
    cuts = counts.agg(F.percentile_approx(score, [i / ranges for i in range(1, ranges)], 20 * ranges)).scalar()
    steps = F.array(*[F.lit(1 << k) for k in reversed(range((ranges - 1).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get("__cuts", at + step - 1) <= F.col(score), step).otherwise(F.lit(0)))
    return counts.withColumn("__cuts", cuts).withColumn(output, found).drop("__cuts")


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def headline_by(df: DataFrame, by=(), *, label: str = LABEL, score: str = "score", threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """One row of headline metrics for each group (one row in all without ``by``)."""
    require(df, [label, score, *by], "headline_by")
    p, y = F.col(score).cast("double"), (F.col(label) == 1).cast("long")
    counts = df.groupBy(*by, p.alias("p")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    counts = with_score_ranges(counts)
    slices = counts.groupBy(*by, "slice").agg(F.sum("pos").alias("s_pos"), F.sum("neg").alias("s_neg"))
    group = [F.col(c) for c in by] or [F.lit(0)]
    above = Window.partitionBy(*group).orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*group)
    sums = {"up_pos": F.coalesce(F.sum("s_pos").over(above), F.lit(0)), "up_neg": F.coalesce(F.sum("s_neg").over(above), F.lit(0)), "all_pos": F.sum("s_pos").over(every), "all_neg": F.sum("s_neg").over(every)}
    offsets = slices.withColumns(sums).select(*[F.col(c).alias(f"__{c}") for c in (*by, "slice")], *sums)
    same = F.col("slice") == F.col("__slice")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    down = Window.partitionBy(*group, "slice").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)
    run = counts.join(offsets, same).withColumns({"tp": F.sum("pos").over(down) + F.col("up_pos"), "fp": F.sum("neg").over(down) + F.col("up_neg")})
    precision, recall = F.col("tp") / (F.col("tp") + F.col("fp")), _ratio(F.col("tp"), F.col("all_pos"))
    alarm = F.col("p") >= threshold
    tp, fp = F.coalesce(F.sum(F.when(alarm, F.col("pos"))), F.lit(0)), F.coalesce(F.sum(F.when(alarm, F.col("neg"))), F.lit(0))
    n_pos, n_neg = F.sum("pos"), F.sum("neg")
    aggregates = [
        (n_pos + n_neg).alias("n_rows"),
        n_pos.alias("n_positive"),
        (F.sum(F.col("pos") * (F.col("p") - 1) ** 2 + F.col("neg") * F.col("p") ** 2) / (n_pos + n_neg)).alias("brier_score"),
        F.sum(_ratio(F.col("pos"), F.col("all_pos")) * precision).alias("pr_auc"),
        F.sum(F.when((F.col("all_pos") > 0) & (F.col("all_neg") > 0), F.col("neg") * (F.col("tp") - F.col("pos") / 2) / (F.col("all_pos") * F.col("all_neg")))).alias("roc_auc"),
        F.max(F.when(recall >= 0.5, precision)).alias("precision_at_recall_0_5"),
        F.max(F.when(recall >= 0.8, precision)).alias("precision_at_recall_0_8"),
        _ratio(tp, n_pos).alias("recall_at_threshold"),
        _ratio(tp, tp + fp).alias("precision_at_threshold"),
    ]
    out = run.groupBy(*by).agg(*aggregates) if by else run.agg(*aggregates)
    return out.withColumn("threshold_used", F.lit(float(threshold)))


def headline_metrics(df: DataFrame, **options) -> dict:
    row = headline_by(df, **options).first().asDict()
    if not row["n_rows"]:
        raise ContractError("headline_metrics: no rows")
    return row


def slice_metrics(df: DataFrame, *, slice_cols=("namespace", "node"), label: str = LABEL, score: str = "score", threshold: float = DECISION_THRESHOLD, min_rows: int = LEAST_SLICE_ROWS) -> DataFrame:
    """Headline metrics for every value of every slice column with enough rows. A slice without positives keeps the Brier score alone."""
    require(df, [label, score, *slice_cols], "slice_metrics")
    pairs = F.array(*[F.struct(F.lit(c).alias("slice_col"), F.col(c).cast("string").alias("slice_value")) for c in slice_cols])
    long = df.select(F.explode(pairs).alias("s"), label, score).select("s.*", label, score).where("slice_value is not null")
    out = headline_by(long, ["slice_col", "slice_value"], label=label, score=score, threshold=threshold).where(F.col("n_rows") >= min_rows)
    some = F.col("n_positive") > 0
    return out.withColumns({c: F.when(some, F.col(c)) for c in (*HEADLINE[1:], "threshold_used")})


def first_alerts(df: DataFrame, *, label: str = LABEL, score: str = "score", time: str = TIME, by=ENTITY, threshold: float = DECISION_THRESHOLD, horizons=HORIZONS_MINUTES) -> DataFrame:
    """Per entity with an event: minutes from its first alert at least each horizon ahead to its last positive row; null without one."""
    us = micros(df, time)
    event = F.max(F.when(F.col(label) == 1, us)).over(Window.partitionBy(*by))
    rows = df.select(*by, us.alias("us"), F.col(score).alias("p"), event.alias("event")).where("event is not null")
    alert = F.col("p") >= threshold
    first = [F.min(F.when(alert & (F.col("us") <= F.col("event") - h * 60 * MICRO), F.col("us"))).alias(f"first_{h}") for h in horizons]
    per = rows.groupBy(*by, "event").agg(*first)
    return per.select(*by, *[((F.col("event") - F.col(f"first_{h}")) / F.lit(60.0 * MICRO)).alias(f"lead_{h}") for h in horizons])


def lead_time_by_horizon(df: DataFrame, *, horizons=HORIZONS_MINUTES, **options) -> DataFrame:
    """One row of exact lead-time percentiles and detection rates; all null where there is no event."""
    leads = first_alerts(df, horizons=horizons, **options)
    made = []
    for h in horizons:
        lead = F.col(f"lead_{h}")
        made += [F.percentile(lead, F.lit(0.5)).alias(f"lead_time_p50_min_at_{h}min"), F.percentile(lead, F.lit(0.25)).alias(f"lead_time_p25_min_at_{h}min"), _ratio(F.count(lead), F.count(F.lit(1))).alias(f"detection_rate_at_{h}min")]
    return leads.agg(*made)


def lead_time_metrics(df: DataFrame, *, horizons=HORIZONS_MINUTES, **options) -> dict:
    require(df, [TIME, *ENTITY, LABEL] if not options else [], "lead_time_metrics")
    row = lead_time_by_horizon(df, horizons=horizons, **options).first().asDict()
    nan = float("nan")
    if row[f"detection_rate_at_{horizons[0]}min"] is None:
        return {f"lead_time_p50_min_at_{h}min": nan for h in horizons}
    return {k: nan if v is None else v for k, v in row.items()}


def acceptance(metrics: dict) -> dict[str, bool]:
    """The two gates: Brier score at most 0.10, precision at recall 0.8 at least 0.5."""
    precision = metrics["precision_at_recall_0_8"]
    return {"brier_le_0_10": metrics["brier_score"] <= 0.10, "precision_at_recall_0_8_ge_0_5": precision is not None and precision >= 0.5}


def label_correlations(df: DataFrame, columns, label: str = LABEL, limit: float = 0.95) -> DataFrame:
    """(feature, r, suspicious) for every column, from one pass."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature", "r").withColumn("suspicious", F.coalesce(F.abs("r") > limit, F.lit(False)))


def baseline_rule(df: DataFrame, threshold: float = 0.9, column: str = "feat_mem_pct_of_limit__5min_max", fallback: str = "feat_mem_pct_of_limit") -> Column:
    """1.0 where the memory share is at or over the threshold, else (also where unknown) 0.0."""
    name = next((c for c in (column, fallback) if c in df.columns), None)
    if name is None:
        raise KeyError(f"baseline_rule: neither {column} nor {fallback} is there")
    return F.coalesce((F.col(name) >= threshold).cast("double"), F.lit(0.0))


def two_class(p: Column) -> Column:
    return F.array(1 - p, p)


# Upper bounds of the buckets of predicted probabilities.
SCORE_BOUNDS = (0.01, 0.05, 0.10, 0.25, 0.50, 0.70, 0.90, 0.99)


def score_histogram(df: DataFrame, score: str = "score", by=(), bounds=SCORE_BOUNDS) -> DataFrame:
    """Cumulative counts of scores up to each bound and in all, with their sum; one pass, one row for each group."""
    p = F.col(score)
    counts = [F.count_if(p <= b).alias(f"le_{b:g}".replace(".", "_")) for b in bounds]
    return df.groupBy(*by).agg(*counts, F.count(p).alias("n"), F.sum(p).alias("total"))


def prediction_counts(predictions: DataFrame) -> DataFrame:
    """Predictions by model version and status, and how often each feature contributed most."""
    status = F.when(F.col("error").isNull(), "ok").otherwise("error")
    top = F.try_element_at("top_contributors", F.lit(1))["feature"]
    return predictions.groupBy("model_version", status.alias("status"), top.alias("top_feature")).agg(F.count("*").alias("n"))
