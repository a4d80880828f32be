import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from failcast.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    want = duck.sql(catalogue.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())


def test_elkan_correct_of_values_that_are_no_probabilities(spark, tmp_path):
    values = [0.0, 250.0, 500.0, 508.9, 540.11, 555.5555555555555, 555.5555555555557, 1e6, -20.0, math.nan, None]
    spark.createDataFrame(list(enumerate(values)), "event_id long, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = catalogue.QUERIES["elkan_correct"](spark, str(tmp_path)).select("event_id", "p").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr(r) for r in con.sql(catalogue.ORACLE_SQL["elkan_correct"]).fetchall())


def test_entry_and_names(spark):
    assert entry.entry(spark).columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
