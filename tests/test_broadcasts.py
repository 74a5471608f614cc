"""Tables that are small as files and large as rows are not sent through the driver."""

import pytest

from tonearm.operators import lookup as L
from tonearm.sources.keyed import DELETED, RESET, KeyedTable


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def half_mb(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "512k")
    yield 512 * 1024
    spark.conf.set(key, before)


def test_a_dimension_that_compresses_well_is_shuffled(spark, tmp_path, half_mb):
    dim = spark.range(0, 20_000, 1, 1).selectExpr("id AS song_id", "repeat('a', 100) AS name")
    dim.write.parquet(f"{tmp_path}/d")
    dim = L.Dimension(spark.read.parquet(f"{tmp_path}/d"), "song_id")
    assert L.planned_bytes(dim.table) < half_mb < 2_000_000 < dim.bytes
    fact = spark.range(3).selectExpr("id", "if(id = 2, NULL, id * 30000) AS song_id")
    for spread in (None, ["id"]):
        out = L.lookup(fact, dim, "song_id", {"name": "name"}, spread)
        assert "Broadcast" not in plan(out)
        assert sorted((r["id"], r["name"]) for r in out.collect()) == [(0, "a" * 100), (1, None), (2, None)]


def test_a_small_dimension_is_broadcast(spark, tmp_path, half_mb):
    spark.range(100).selectExpr("id AS song_id", "string(id) AS name").write.parquet(f"{tmp_path}/d")
    dim = L.Dimension(spark.read.parquet(f"{tmp_path}/d"), "song_id")
    assert "BroadcastHashJoin" in plan(L.lookup(spark.range(3).selectExpr("id AS song_id"), dim, "song_id", {"name": "name"}))


def test_changes_are_merged_by_shuffle(spark, tmp_path):
    table = KeyedTable(str(tmp_path), "k long, v long", ["k"])
    rows = f"k long, v long, {DELETED} boolean"
    old = spark.createDataFrame([(1, 1, False), (None, 2, False)], rows)
    fresh = spark.createDataFrame([(1, 5, False)], rows).selectExpr("*", f"false AS {RESET}")
    for both in (table._replaced(old, fresh), table._patched(old, fresh)):
        assert "Broadcast" not in plan(both)
    assert [tuple(r) for r in table._replaced(old, fresh).collect()] == [(None, 2, False)]
