import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from failcast.llm import common


def test_rank_of_is_the_global_order(spark):
    rng = random.Random(6)
    rows = [(rng.choice([None, *range(40)]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(6)
    got = {r.b: r.at for r in common.rank_of(df, [F.col("a").isNull().cast("int"), F.col("a"), F.col("b")], "at", parts=7).collect()}
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [b for _, b in want] == sorted(got, key=got.get) and sorted(got.values()) == list(range(500))


def test_written_tables_are_read_back_and_forgotten(spark):
    out = common.written(spark.range(9))
    assert out.count() == 9
    common.forget(out)
    with pytest.raises(Exception, match="(?i)exist"):
        spark.read.parquet(out._written_to)


def test_small_sides_are_broadcast_up_to_their_bound(spark):
    table = common.written(spark.range(9))
    plan = lambda side: spark.range(100).join(side, "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(common.small_side(table, 9)) and "broadcast" not in plan(common.small_side(table, 8))


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    none = SimpleNamespace(get=lambda *a: None)
    spark = SimpleNamespace(conf=none, sparkContext=SimpleNamespace(getConf=lambda: none, master="spark://host:7077", applicationId="app-without-folder"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(spark)
