"""Dimension lookups: misses, empty texts, and the shuffled join for large dimensions."""

import pytest

from tonearm.operators import lookup as L
from tonearm.plans import bridge, facts


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_shuffled_lookup_equals_broadcast(spark, sf_dir, no_broadcast):
    log = bridge.log(spark, sf_dir, ["play"])
    large = facts.build_fact(log, facts.PLAY, bridge.dims(spark, sf_dir))
    assert "BroadcastHashJoin" not in plan(large)
    mine = rows(large)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    small = facts.build_fact(log, facts.PLAY, bridge.dims(spark, sf_dir))
    assert plan(small).count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in plan(small)
    assert mine == rows(small)


def test_dimensions_are_not_repeated(spark, sf_dir, no_broadcast):
    dims = bridge.dims(spark, sf_dir)
    text = plan(facts.build_fact(bridge.log(spark, sf_dir, ["play"]), facts.PLAY, dims))
    assert "explode" not in text
    # The join of songs and singers is stored once; the fact meets it twice, and the users.
    assert text.count("SortMergeJoin") == 3
    assert dims.song_with_singer() is dims.song_with_singer()


def test_a_third_of_rows_on_one_key_and_a_third_without(spark, no_broadcast):
    fact = spark.range(3200).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7L WHEN id % 3 = 1 THEN NULL ELSE id END AS song_id"
    )
    dim = L.Dimension(spark.createDataFrame([(7, "a"), (-5, "b")], "song_id long, name string"), "song_id")
    out = L.lookup(fact, dim, "song_id", {"name": "name"}, ["id"])
    assert out.count() == 3200
    assert out.where("name = 'a'").count() == fact.where("song_id = 7").count()
    assert out.where("song_id IS NULL AND name IS NULL").count() == fact.where("song_id IS NULL").count()
    # Rows without a key are dealt to all tasks.
    dealt = out.where("song_id IS NULL").selectExpr("spark_partition_id() AS p")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert dealt.distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_report_lookup_never_shuffles_the_dimension(spark, no_broadcast):
    rows = spark.createDataFrame([(7, 1), (8, 2)], "song_id long, n long")
    big = spark.range(100_000).selectExpr("id AS song_id", "concat('s', id) AS name")
    out = L.lookup_few(rows, L.Dimension(big, "song_id"), "song_id", {"name": "name"}, limit=2)
    assert "Exchange hashpartitioning" not in plan(out)
    assert sorted((r["song_id"], r["name"]) for r in out.collect()) == [(7, "s7"), (8, "s8")]


def test_misses_keep_the_row(spark):
    user = spark.createDataFrame([(1, "ann", "F", 5000)], "user_id long, user_name string, "
                                 "gender string, vip_end long")
    song = spark.createDataFrame([(1, "s1", 9, "3", "200"), (2, "s2", None, "1", "100")],
                                 "song_id long, song_name string, singer_id long, "
                                 "song_type_id string, song_duration string")
    singer = spark.createDataFrame([(9, "x", "M", "N1")], "singer_id long, singer_name string, "
                                   "gender string, nationality string")
    province = spark.createDataFrame([(1, "P")], "province_id long, province_name string")
    dims = L.Dims.of(user, song, singer, province)
    fact = spark.createDataFrame(
        [(1, 1, 2, 1), (2, 99, None, 8)],
        "play_id long, song_id long, lead_song_id long, user_id long",
    )
    out = facts.enrich(fact, facts.PLAY, dims).orderBy("play_id").collect()
    hit, miss = out
    assert (hit["song_name"], hit["singer_name"], hit["singer_nationality"]) == ("s1", "x", "N1")
    assert (hit["lead_song_name"], hit["lead_singer_id"], hit["lead_song_type"]) == ("s2", "", "1")
    assert (miss["song_name"], miss["user_name"]) == (None, None)
    assert (miss["lead_song_name"], miss["lead_song_duration"]) == ("", "")
    vip = L.add_vip_user(fact, dims, ["play_id"]).orderBy("play_id").collect()
    assert [r["vip_end"] for r in vip] == [5, 0]


def test_threshold_texts(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        for text, size in (("10485760", 10485760), ("1m", 1 << 20), ("2KB", 2048), ("1tb", 1 << 40), ("-1", -1)):
            spark.conf.set(key, text)
            assert L.broadcast_limit(spark.range(1)) == size
    finally:
        spark.conf.set(key, before)
