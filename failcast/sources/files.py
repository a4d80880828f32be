"""Parquet, CSV and JSON sources and sinks."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from failcast.schema import ENTITY, LONG_COLUMNS, LONG_SCHEMA, TIME, ContractError, require


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place))


def with_hours(long: DataFrame, time: str = TIME) -> DataFrame:
    """Partition columns dt (yyyy-MM-dd) and hour (HH)."""
    return long.withColumns({"dt": F.date_format(time, "yyyy-MM-dd"), "hour": F.date_format(time, "HH")})


def write_hourly(long: DataFrame, root: str, time: str = TIME) -> DataFrame:
    """Write dt=/hour= partitions; hours in ``long`` are replaced, others stay. Returns rows per hour."""
    require(long, [time], "write_hourly")
    keyed = with_hours(long, time)
    # One hash exchange puts an hour's rows into few files without sorting the span.
    keyed.repartition("dt", "hour").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "hour").parquet(root)
    return keyed.groupBy("dt", "hour").agg(F.count("*").alias("n_rows"))


def hourly_counts(long: DataFrame, time: str = TIME) -> DataFrame:
    return with_hours(long, time).groupBy("dt", "hour").agg(F.count("*").alias("n_rows"))


def read_long(spark: SparkSession, root: str) -> DataFrame:
    """A long frame; partition columns serve pruning through ``read_hours`` and are dropped here."""
    return _micro_times(spark.read.parquet(root)).select(*LONG_COLUMNS)


def read_hours(spark: SparkSession, root: str, first_dt: str, last_dt: str) -> DataFrame:
    """Days first_dt to last_dt; other partitions are not listed as input."""
    return _micro_times(spark.read.parquet(root).where(F.col("dt").between(first_dt, last_dt))).select(*LONG_COLUMNS)


def _micro_times(df: DataFrame) -> DataFrame:
    """Nanosecond integers, as read with spark.sql.legacy.parquet.nanosAsLong, become timestamps."""
    wide = [f.name for f in df.schema if f.name == TIME and isinstance(f.dataType, T.LongType)]
    return df.withColumns({c: F.timestamp_micros(F.expr(f"`{c}` div 1000")) for c in wide}) if wide else df


def read_union(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """All inputs that exist, missing columns as null."""
    found = [p for p in paths if exists(spark, p)]
    if not found:
        raise ContractError("read_union: none of the inputs exists")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (_micro_times(spark.read.parquet(p)) for p in found))


def read_headless_csv(spark: SparkSession, path: str, columns: Iterable[str], numbers: Iterable[str] = ()) -> DataFrame:
    """A CSV without a header, with columns by position. All is read as text; ``numbers`` are cast, bad ones to null."""
    if not exists(spark, path):
        raise ContractError(f"read_headless_csv: {path} does not exist")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    text = spark.read.schema(schema).csv(path, header=False, mode="PERMISSIVE")
    return text.withColumns({c: F.col(c).try_cast("double") for c in numbers}) if numbers else text


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_entity_table(df: DataFrame, name: str, *, buckets: int = 64, by=ENTITY, time: str = TIME) -> None:
    """A table whose files hold an entity each as a whole, sorted by time: windows over entities read it without an exchange.

    The table lies in the warehouse, which all executors must share.
    """
    require(df, [*by, time], "write_entity_table")
    df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by, time).saveAsTable(name)


def counted(df: DataFrame, **sums) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its rows (n_rows) and of ``sums``, made in the pass that writes it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[c.alias(name) for name, c in sums.items()]), seen


def empty_long(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LONG_SCHEMA)


def plain(value):
    """Numbers JSON can hold: what is undefined becomes null."""
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value if isinstance(value, (int, float, str, bool, type(None))) else str(value)


def write_json(spark: SparkSession, path: str, value) -> None:
    """One JSON document, through Spark's file systems."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(json.dumps(plain(value), indent=2).encode()))
    out.close()


def read_json(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def within_size(spark: SparkSession, path: str, low_mib: float, high_mib: float) -> DataFrame:
    """Files under ``path`` with their size and whether it is in the expected band; contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    mib = F.col("length") / F.lit(1024.0 * 1024.0)
    return files.withColumns({"mib": mib, "in_band": mib.between(low_mib, high_mib)})
