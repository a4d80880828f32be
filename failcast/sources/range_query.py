"""Range queries of a metric server as a Spark source.

``spark.read.format("range_query")`` has one input partition for each metric and time chunk, so
a long span is fetched by many tasks and a failed request is retried by Spark alone.
Options: url, start, end (ISO, with a time zone), step (seconds), chunk_minutes, timeout,
metrics (columns of the catalogue, by commas; all by default).

Filters on the metric's name and on time reach the source: metrics and chunks that they rule out are not asked
for. Chunks are kept or left out as a whole, so samples lie on the same grid with and without a filter.

``spark.readStream.format("range_query")`` goes on where it stopped: an offset is a time on the grid of
steps, and a batch asks for [offset, next offset), in chunks as well. Samples younger than ``lag`` seconds
(a step by default) wait for the next batch; with ``end`` the stream stops there.

``flatten_payload`` does the same to responses that are stored as JSON text, with built-in
functions alone.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from urllib.error import URLError
from urllib.parse import urlencode
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from failcast.functions.scalars import null_if_nan
from failcast.schema import ALL_METRICS, CHUNK_MINUTES, LONG_COLUMNS, LONG_SCHEMA, STEP_SECONDS, TIME


class FetchError(RuntimeError):
    """A range query failed."""


#: Labels that are kept, and the columns they become; a missing label is an empty string.
LABEL_COLUMNS = {"namespace": "namespace", "pod": "pod", "uid": "pod_uid", "container": "container", "node": "node"}


def parsed_time(text: str) -> datetime:
    """ISO text; without a zone it is UTC."""
    at = datetime.fromisoformat(text.replace("Z", "+00:00"))
    return at if at.tzinfo else at.replace(tzinfo=UTC)


def chunks(start: datetime, end: datetime, width: timedelta) -> list[tuple[datetime, datetime]]:
    """Consecutive chunks of a span; the last may be short."""
    if start.tzinfo is None or end.tzinfo is None:
        raise ValueError("a span needs times with a zone")
    if end <= start:
        raise ValueError("a span cannot end before it has begun")
    if width <= timedelta(0):
        raise ValueError("the chunk width must be over 0")
    n = -(-(end - start) // width)
    return [(start + i * width, min(end, start + (i + 1) * width)) for i in range(n)]


def chunk_windows(spans: DataFrame, width_seconds: int, *, start: str = "start", end: str = "end") -> DataFrame:
    """``spans`` with a row for each chunk (chunk_start, chunk_end), by built-in functions."""
    step = F.make_dt_interval(secs=F.lit(width_seconds))
    out = spans.where(F.col(end) > F.col(start)).withColumn("chunk_start", F.explode(F.sequence(F.col(start), F.col(end), step)))
    return out.where(F.col("chunk_start") < F.col(end)).withColumn("chunk_end", F.least(F.col("chunk_start") + step, F.col(end)))


def series_to_rows(series: list[dict], metric: str) -> Iterator[tuple]:
    """Samples of a response as long rows; what is no number is skipped."""
    for one in series:
        labels = one.get("metric", {})
        carried = {column: labels.get(label, "") for label, column in LABEL_COLUMNS.items()}
        for at, raw in one.get("values", []):
            try:
                value = float(raw)
            except (TypeError, ValueError):
                continue
            yield datetime.fromtimestamp(float(at), UTC), metric, value, *(carried[c] for c in LONG_COLUMNS[3:])


@dataclass
class _Part(InputPartition):
    metric: str
    query: str
    start: float
    end: float


def _micros(at: datetime) -> int:
    """A filter's time: with a zone, or in that of the process."""
    return round(at.timestamp() * 1_000_000)


class _Server:
    """What both readers need to ask for a part."""

    def __init__(self, options: dict):
        self.url = options["url"].rstrip("/")
        self.step = float(options.get("step", STEP_SECONDS))
        self.timeout = float(options.get("timeout", 30))
        self.width = timedelta(minutes=float(options.get("chunk_minutes", CHUNK_MINUTES)))
        self.known = {m.column: m.query for m in ALL_METRICS}
        self.metrics = [m.strip() for m in options.get("metrics", ",".join(self.known)).split(",")]

    def parts(self, spans: list[tuple[float, float]]) -> list[_Part]:
        return [_Part(m, self.known.get(m, m), a, b) for m in self.metrics for a, b in spans]

    def read(self, partition: _Part) -> Iterator[tuple]:
        asked = urlencode({"query": partition.query, "start": partition.start, "end": partition.end, "step": self.step})
        try:
            with urlopen(f"{self.url}/api/v1/query_range?{asked}", timeout=self.timeout) as answer:
                body = json.load(answer)
        except (URLError, OSError, ValueError) as error:
            raise FetchError(f"{partition.metric}: {error}") from error
        if body.get("status") != "success":
            raise FetchError(f"{partition.metric}: {body.get('error', 'no success')}")
        yield from series_to_rows(body["data"]["result"], partition.metric)


class _Reader(_Server, DataSourceReader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.spans = [(a.timestamp(), b.timestamp()) for a, b in chunks(parsed_time(options["start"]), parsed_time(options["end"]), self.width)]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Leave out metrics and chunks that a filter rules out; Spark still checks every row."""
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("metric_name",) and isinstance(f, EqualTo):
                self.metrics = [m for m in self.metrics if m == f.value]
            elif column == ("metric_name",) and isinstance(f, In):
                self.metrics = [m for m in self.metrics if m in f.value]
            elif column == (TIME,) and isinstance(getattr(f, "value", None), datetime):
                at = _micros(f.value)
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.spans = [(a, b) for a, b in self.spans if b * 1_000_000 >= at]
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.spans = [(a, b) for a, b in self.spans if a * 1_000_000 <= at]
            yield f

    def partitions(self) -> list[_Part]:
        return self.parts(self.spans) or [_Part("", "", 0.0, 0.0)]  # nothing to ask for

    def read(self, partition: _Part) -> Iterator[tuple]:
        return super().read(partition) if partition.metric else iter(())


class _StreamReader(_Server, DataSourceStreamReader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.start = parsed_time(options["start"]).timestamp()
        self.end = parsed_time(options["end"]).timestamp() if "end" in options else None
        self.lag = float(options.get("lag", self.step))

    def initialOffset(self) -> dict:
        return {"steps": 0}

    def latestOffset(self) -> dict:
        """Steps from the start on that are over."""
        until = datetime.now(UTC).timestamp() - self.lag
        until = until if self.end is None else min(until, self.end)
        return {"steps": max(0, int((until - self.start) // self.step))}

    def partitions(self, start: dict, end: dict) -> list[_Part]:
        """[start, end) in chunks; a range query returns both ends, so each ends a step before the next begins."""
        per_chunk = max(1, int(self.width.total_seconds() // self.step))
        firsts = range(start["steps"], end["steps"], per_chunk)
        at = lambda k: self.start + k * self.step
        return self.parts([(at(k), at(min(k + per_chunk, end["steps"]) - 1)) for k in firsts])

    def commit(self, end: dict) -> None:
        pass


class RangeQuerySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "range_query"

    def schema(self):
        return LONG_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options))


def read_range(spark: SparkSession, **options) -> DataFrame:
    """A lazy long frame of a span. Repeated samples at chunk edges stay; ``to_wide`` settles them."""
    _Reader({k: str(v) for k, v in options.items()})  # bad options raise here, not in a task
    _register(spark)
    return spark.read.format("range_query").options(**options).load()


def stream_range(spark: SparkSession, **options) -> DataFrame:
    """A streaming long frame from ``start`` on, every sample once."""
    _StreamReader({k: str(v) for k, v in options.items()})
    _register(spark)
    return spark.readStream.format("range_query").options(**options).load()


def _register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # or a reader that takes filters is refused
    spark.dataSource.register(RangeQuerySource)


_PAYLOAD = "array<struct<metric:map<string,string>,values:array<array<string>>>>"


def flatten_payload(payloads: DataFrame, *, payload: str = "payload", metric: str = "metric_name") -> DataFrame:
    """JSON text of each response's result list -> the long frame."""
    series = payloads.select(F.col(metric).alias("metric_name"), F.explode(F.from_json(payload, _PAYLOAD)).alias("s"))
    samples = series.select("metric_name", "s.metric", F.explode("s.values").alias("v"))
    label = lambda name: F.coalesce(F.element_at("metric", F.lit(name)), F.lit(""))
    rows = samples.select(
        F.timestamp_micros((F.get("v", F.lit(0)).try_cast("double") * 1_000_000).cast("long")).alias(TIME),
        "metric_name",
        F.get("v", F.lit(1)).try_cast("double").alias("value"),
        *[label(name).alias(column) for name, column in LABEL_COLUMNS.items()],
    )
    return rows.where(F.col("value").isNotNull()).select(*LONG_COLUMNS)


def cleaned(long: DataFrame) -> DataFrame:
    """NaN becomes null, which every operator takes for missing."""
    return long.withColumn("value", null_if_nan("value"))
