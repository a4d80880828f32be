"""Shared helpers: text columns, written tables, exact global order."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from failcast.deploy import runs_in_one_process, ship

# The six ASCII white-space characters that separate words.
WHITE_SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


_own_dirs: dict[str, str] = {}
_tables: list[str] = []
_folders: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is set and all runs in one process (tests)."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not place:
        if not runs_in_one_process(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_dirs:
            _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="failcast-")
        place = _own_dirs[app]
    return place.rstrip("/")


def _clean_up() -> None:
    """At the end of the driver: drop what operators kept between their phases."""
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    for name in _tables:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    for folder in _folders:
        _delete(spark, folder)


def temporary_table(kind: str) -> str:
    """A name for a table that goes when the driver ends."""
    if not _tables and not _folders:
        atexit.register(_clean_up)
    _tables.append(f"failcast_{kind}_{uuid.uuid4().hex}")
    return _tables[-1]


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors.

    Lazy results read these tables, so they go when the driver ends, or by ``forget``.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}"
    if folder not in _folders:
        if not _tables and not _folders:
            atexit.register(_clean_up)
        _folders.append(folder)
    ship(spark)
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path  # type: ignore[attr-defined]
    return out


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def forget(df: DataFrame) -> None:
    """Delete a table made by ``written`` once nothing reads it any more."""
    path = getattr(df, "_written_to", None)
    if path:
        _delete(df.sparkSession, path)


def free_shuffles(spark: SparkSession) -> None:
    """Let the driver drop the shuffle files of plans that are done, between the phases of an operator."""
    import gc

    for _ in range(2):  # the last plan is held until events of another have passed
        spark.range(1).collect()
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def give_back() -> None:
    """In a Python worker, at the end of a task: freed memory goes back, for workers are used again by later stages."""
    with contextlib.suppress(OSError, AttributeError):  # other C libraries need no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def value_once(sent) -> object:
    """A broadcast's value, which the worker does not keep beside what is made of it."""
    value = sent.value
    if getattr(sent, "_path", None):  # it can be read again
        vars(sent).pop("_value", None)
    return value


def dealt_by(df: DataFrame, groups: int, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` to as many tasks as there are groups, within bounds.

    Groups that are small to move but long to work on would otherwise be put together in few
    tasks, by their size.
    """
    most = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, min(groups, most)), *keys)


def small_side(df: DataFrame, most: int = 100_000) -> DataFrame:
    """A written table as the broadcast side of a join if it has at most ``most`` rows, else as it is."""
    return F.broadcast(df) if df.count() <= most else df


#: Keys with at least this share of all rows are hot; there are at most 1 / ``HOT_SHARE`` of them.
HOT_SHARE = 1e-4


def hot_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Written (keys...): the hot keys of written ``rows``."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__n"))
    return written(counts.where(F.col("__n") >= max(2.0, rows.count() * HOT_SHARE)).select(*keys))


def hot_join(rows: DataFrame, unique: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of written ``rows`` with written ``unique``, which has each key once.

    Rows of hot keys meet their partner by broadcast, so no key's rows go to one task; the others are joined as usual.
    """
    hot = hot_keys(rows, keys)
    partner = written(unique.join(F.broadcast(hot), keys, "left_semi"))
    if partner.isEmpty():
        return rows.join(unique, keys)
    rest = rows.join(F.broadcast(partner.select(*keys)), keys, "left_anti").join(unique, keys)
    return rows.join(F.broadcast(partner), keys).unionByName(rest)


def whole_text(text: str | Column = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z alone."""
    return F.translate(c, UPPER, LOWER)


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def spread(scan: DataFrame) -> DataFrame:
    """A scan with a task for each core at least, where a small table's files give fewer; larger ones stay as they are."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan._jdf.queryExecution().toRdd().getNumPartitions() >= cores else scan.repartition(cores)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def rank_of(df: DataFrame, keys: list[Column], name: str, parts: int = 64) -> DataFrame:
    """Add the exact 0-based position of each row in the order of ``keys``.

    Range partitions are written once; only one count per partition (at most ``parts``
    numbers) is brought together, so no task ever sees the whole table.
    """
    from pyspark.sql import Window

    ranged = written(df.repartitionByRange(parts, *keys).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    order = Window.partitionBy("__part").orderBy(*keys)
    return ranged.withColumn("__row", F.row_number().over(order)).join(F.broadcast(before), "__part").withColumn(name, F.col("__before") + F.col("__row") - 1).drop("__part", "__row", "__before")
