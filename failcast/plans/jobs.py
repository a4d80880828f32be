"""The batch jobs: scrape and label, trace, features, train, score."""

from __future__ import annotations

import platform
import subprocess
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from failcast import __version__
from failcast.operators import features as FE
from failcast.operators import metrics as M
from failcast.operators import ml
from failcast.operators.calibrate import Calibrator
from failcast.operators.histories import SLICE_ROWS
from failcast.operators.labels import generate_labels, generate_trace_labels, summarised, summary_columns
from failcast.operators.split import downsample_negatives, temporal_split
from failcast.schema import BASELINE_THRESHOLD, COOLDOWN_MINUTES, DECISION_THRESHOLD, ENTITY, LEAD_MINUTES, TIME, TRACE_NAMESPACE, ContractError
from failcast.sources import files, trace
from failcast.sources.range_query import read_range

# The stages a run can be in.
STAGES = ("experiment", "candidate", "challenger", "champion")


def scrape(spark: SparkSession, out: str, **options) -> list[dict]:
    """Fetch a span into hour partitions; rows per partition, none for an empty span."""
    long = read_range(spark, **options).persist()
    try:
        if long.isEmpty():
            return []
        return [r.asDict() for r in files.write_hourly(long, out).orderBy("dt", "hour").collect()]
    finally:
        long.unpersist()


def label(spark: SparkSession, source: str, out: str, *, lead_minutes: float = LEAD_MINUTES, cooldown_minutes: float = COOLDOWN_MINUTES, trace_events: bool = False, namespace: str | None = None, table: str | None = None) -> dict:
    """Long frames -> one labelled wide frame and its summary, which is counted while the frame is written.

    With ``table`` the frame is also kept as a table laid out by entity, which ``features`` reads without an exchange.
    """
    long = files.read_long(spark, source)
    if namespace:
        long = long.where(F.col("namespace") == namespace)
    make = generate_trace_labels if trace_events else generate_labels
    made, seen = files.counted(make(long, lead_minutes=lead_minutes, cooldown_minutes=cooldown_minutes), **summary_columns())
    files.write_parquet(made, out)
    n_entities = spark.read.parquet(out).select(*ENTITY).distinct().count()  # two columns of what was written
    summary = summarised(n_entities=n_entities, **seen.get)
    if table:
        files.write_entity_table(spark.read.parquet(out), table)
    files.write_json(spark, f"{out}.metrics.json", summary)
    return summary


def label_trace(spark: SparkSession, source: str, work: str, out: str, **options) -> dict:
    """Trace CSVs -> long frames -> labelled wide frame."""
    made = trace.harmonise(spark, source, work)
    if "container_usage" not in made:
        raise ContractError("label_trace: container_usage.csv is missing")
    return label(spark, f"{work}/*.parquet", out, trace_events=True, namespace=TRACE_NAMESPACE, **options)


def features(spark: SparkSession, inputs: list[str], out: str, dispatch: str = "frame", *, table: str | None = None, rows_per_slice: int | None = SLICE_ROWS) -> dict:
    """Labelled frames, or a table of them, -> train, val and test feature frames with their JSON records.

    Entities of more than ``rows_per_slice`` rows are worked on in slices of time.
    """
    wide = spark.table(table) if table else files.read_union(spark, inputs)
    n_in = wide.count()  # reads no column
    model, seen = files.counted(FE.select_model_columns(FE.build_features(wide, dispatch=dispatch, rows_per_slice=rows_per_slice)))
    files.write_parquet(model, f"{out}/all.parquet")
    model = spark.read.parquet(f"{out}/all.parquet")
    train, val, test, metrics = temporal_split(model)
    for name, part in (("train", train), ("val", val), ("test", test)):
        files.write_parquet(part, f"{out}/{name}.parquet")
    names = FE.feature_columns(model)
    record = {"n_input_rows": n_in, "n_output_rows": seen.get["n_rows"], "n_features": len(names)}
    files.write_json(spark, f"{out}/feature_list.json", names)
    files.write_json(spark, f"{out}/feature_metrics.json", record)
    files.write_json(spark, f"{out}/split_metrics.json", {r["split"]: r.asDict() for r in metrics.collect()})
    files.write_json(spark, f"{out}/entity_overlap.json", ["pod_uid"])
    return record


@dataclass
class Run:
    """A record of one training run."""

    family: str
    dataset: str
    stage: str = "experiment"
    params: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.stage not in STAGES:
            raise ValueError(f"stage must be one of {STAGES}")
        try:
            self.git = subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, check=True).stdout.strip()
        except (OSError, subprocess.CalledProcessError):
            self.git = ""
        self.started = datetime.now(tz=UTC)

    @property
    def name(self) -> str:
        return f"{self.family}__{self.dataset}__{self.git[:7] or 'nogit'}__{self.started:%Y%m%dT%H%M}"

    def as_dict(self) -> dict:
        return {"name": self.name, "family": self.family, "dataset": self.dataset, "stage": self.stage, "git_sha": self.git, "version": __version__, "params": self.params, "metrics": self.metrics}


def evaluate(df: DataFrame, threshold: float = DECISION_THRESHOLD) -> dict:
    """Headline and lead-time metrics of a frame with ``score``."""
    return M.headline_metrics(df, threshold=threshold) | M.lead_time_metrics(df, threshold=threshold)


def train(spark: SparkSession, source: str, out: str, *, dataset: str = "unversioned", trials: int = 50, max_trees: int = 100, threshold: float = DECISION_THRESHOLD, method: str = "isotonic", seed: int = 42) -> dict:
    """Baseline and boosted trees on the splits under ``source``; artefacts and records under ``out``."""
    parts = {name: spark.read.parquet(f"{source}/{name}.parquet") for name in ("train", "val", "test")}
    ml.same_features(*parts.values())
    test = parts["test"]
    baseline = Run("rule_baseline", dataset, params={"threshold": BASELINE_THRESHOLD})
    baseline.metrics = evaluate(test.withColumn("score", M.baseline_rule(test, BASELINE_THRESHOLD)), threshold)
    files.write_json(spark, f"{out}/baseline_test_metrics.json", baseline.as_dict())

    kept, ratio = downsample_negatives(parts["train"], keys=[TIME, "pod_uid", "container"], random_state=seed)
    made = ml.train(kept, parts["val"], sample_ratio=ratio, trials=trials, max_trees=max_trees, seed=seed)
    calibrator = Calibrator.fit(made.score(parts["val"]), method=method)
    scored = calibrator.transform(made.score(test), "calibrated").drop("score").withColumnRenamed("calibrated", "score").cache()
    run = Run("gradient_boosted_trees", dataset, params=made.params | {"sample_ratio": ratio, "trials": trials, "method": method})
    run.metrics = evaluate(scored, threshold)
    slices = [r.asDict() for r in M.slice_metrics(scored, threshold=threshold).collect()]
    scored.unpersist()
    made.model.write().overwrite().save(f"{out}/model")
    calibrator.save(f"{out}/calibrator")
    gates = M.acceptance(run.metrics)
    files.write_json(spark, f"{out}/feature_list.json", made.names)
    files.write_json(spark, f"{out}/test_metrics.json", run.as_dict() | {"gates": gates})
    files.write_json(spark, f"{out}/slice_metrics.json", slices)
    files.write_json(spark, f"{out}/trials.json", made.trials)
    files.write_json(spark, f"{out}/model_card.json", {"text": model_card(run, made.names, slices, gates)})
    return {"run": run.as_dict(), "baseline": baseline.as_dict(), "slices": slices, "gates": gates}


def model_card(run: Run, names: list[str], slices: list[dict], gates: dict) -> str:
    """What a reader must know of a model, as Markdown."""
    number = lambda v: "undefined" if v is None or v != v else f"{v:.4f}" if isinstance(v, float) else str(v)
    lines = [f"# {run.name}", "", "Probability that a container is killed for memory within 30 minutes.", "", f"Data: {run.dataset}. Code: {run.git[:7] or 'nogit'}. Features: {len(names)}.", "", "## Test metrics", ""]
    lines += [f"- {k}: {number(v)}" for k, v in run.metrics.items()]
    lines += ["", "## Gates", "", *[f"- {k}: {'pass' if v else 'fail'}" for k, v in gates.items()], "", "## Slices", ""]
    lines += [f"- {s['slice_col']}={s['slice_value']}: rows {s['n_rows']}, positives {s['n_positive']}, Brier {number(s['brier_score'])}" for s in slices]
    lines += ["", "## Parameters", "", *[f"- {k}: {number(v)}" for k, v in run.params.items()]]
    return "\n".join(lines) + "\n"


class Scorer:
    """Batch and streaming predictions of saved artefacts, with the same plan.

    A request row has pod_uid, container and features (a map by name); names that the model does
    not know are ignored, a missing one makes ``error`` say which, and the row has no prediction.
    """

    def __init__(self, spark: SparkSession, path: str, method: str = "isotonic", version: str = "unversioned"):
        self.names = files.read_json(spark, f"{path}/feature_list.json")
        self.ratio = files.read_json(spark, f"{path}/test_metrics.json")["params"]["sample_ratio"]
        self.model = ml.GBTClassificationModel.load(f"{path}/model")
        self.calibrator = Calibrator.load(f"{path}/calibrator", method)
        self.version = version

    def predict(self, requests: DataFrame, k: int = 3) -> DataFrame:
        missing = F.filter(F.array(*[F.lit(n) for n in self.names]), lambda n: ~F.map_contains_key("features", n))
        rows = requests.withColumn("__first", F.get(missing, F.lit(0)))
        flat = rows.select("pod_uid", "container", "__first", *[F.try_element_at("features", F.lit(n)).alias(n) for n in self.names])
        made = ml.explained(flat, self.model, self.names, k)
        scored = made.withColumn("score", ml.prior_corrected("prediction", self.ratio))
        out = self.calibrator.transform(scored, "calibrated")
        ok = F.col("__first").isNull()
        keep = {"prediction": F.col("calibrated"), "prediction_logodds": F.col("prediction_logodds"), "base_value": F.col("base_value"), "top_contributors": F.col("top_contributors")}
        return out.select("pod_uid", "container", *[F.when(ok, v).alias(n) for n, v in keep.items()], F.lit(self.version).alias("model_version"), F.when(~ok, F.concat(F.lit("missing feature: "), F.col("__first"))).alias("error"))


def info(spark: SparkSession) -> dict:
    return {"failcast": __version__, "python": platform.python_version(), "spark": spark.version, "platform": f"{platform.system()} {platform.release()}"}

