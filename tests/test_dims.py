"""Dimension upkeep against a sequential replay of the change feed."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tonearm.operators import changes as C
from tonearm.operators import dims
from tonearm.schemas import DIM_USER, change_schema
from tonearm.streaming.dims import DimTable, dim_sink

FIELDS = ["user_id", "user_name", "gender", "vip_end"]


def feed(seed, n=200, keys=12):
    rnd = random.Random(seed)
    out = []
    for pos in range(n):
        key = str(rnd.randrange(keys))
        row = {
            "user_id": key,
            "user_name": rnd.choice([None, f"n{pos}"]),
            "gender": rnd.choice([None, "F", "M"]),
            "vip_end": rnd.choice([None, str(pos)]),
        }
        op = rnd.choices("rcud", [1, 3, 5, 2])[0]
        before, after = (row, None) if op == "d" else (None, row)
        # Several changes share a time; the feed position orders them.
        out.append((op, before, after, ("music", "ods_user", pos), 1000 + pos // 5))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, change_schema(FIELDS))


def replay(rows, start=None):
    table = {k: dict(v) for k, v in (start or {}).items()}
    for op, before, after, source, ts in sorted(rows, key=lambda r: (r[4], r[3][2])):
        if op == "d":
            table.pop(int(before["user_id"]), None)
            continue
        row = table.setdefault(int(after["user_id"]), dict.fromkeys(FIELDS[1:]))
        for f in FIELDS[1:]:
            if after[f] is not None:
                row[f] = int(after[f]) if f == "vip_end" else after[f]
    return table


def as_dict(df):
    return {r["user_id"]: {f: r[f] for f in FIELDS[1:]} for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_whole_feed_equals_replay(spark, seed):
    rows = feed(seed)
    shuffled = random.Random(seed).sample(rows, len(rows))
    assert as_dict(dims.current_rows(frame(spark, shuffled), DIM_USER, "user_id")) == replay(rows)


def conf_change(op, table, pos, ts, columns=None):
    row = (table, table.replace("ods", "dim"), columns, "info", "user_id")
    return (op, row if op == "d" else None, None if op == "d" else row, ("c", "conf", pos), ts)


CONF = ("op string, before struct<source_table:string,sink_table:string,sink_columns:string,"
        "sink_family:string,sink_row_key:string>, after struct<source_table:string,"
        "sink_table:string,sink_columns:string,sink_family:string,sink_row_key:string>, "
        "source struct<db:string,table:string,pos:bigint>, ts_ms bigint")


class Upkeep:
    """A dimension sink whose config feed can be added to between batches."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.conf = [conf_change("r", "ods_user", 1, 1)]
        load = lambda: spark.createDataFrame(self.conf, CONF)
        self.sink = dim_sink(self.root, {"dim_user": DIM_USER}, load)

    def put(self, rows, batch_id):
        self.sink(frame(self.spark, rows), batch_id)

    def table(self):
        return as_dict(DimTable(self.root, "dim_user", DIM_USER, "user_id").current(self.spark))


@pytest.fixture
def upkeep(spark, tmp_path):
    return Upkeep(spark, tmp_path)


def test_batches_equal_replay(upkeep):
    rows = feed(9, n=240)
    for batch_id, at in enumerate(range(0, 240, 60)):
        upkeep.put(rows[at:at + 60], batch_id)
        upkeep.put(rows[at:at + 60], batch_id)  # a replayed batch changes nothing
        assert upkeep.table() == replay(rows[:at + 60])


def test_what_a_batch_reads_does_not_grow_with_the_batches(upkeep):
    rows, files = feed(12, n=120), []
    for batch_id, at in enumerate(range(0, 120, 10)):
        upkeep.put(rows[at:at + 10], batch_id)
        assert upkeep.table() == replay(rows[:at + 10])
        stored = [*pathlib.Path(upkeep.root, "tables").rglob("*.parquet"), *pathlib.Path(upkeep.root, "lifecycle").rglob("*.parquet")]
        files.append(sum("/rows/" in str(f) for f in stored))
    assert max(files) <= 8 + 1


def test_a_batch_lost_between_two_tables_counts_once(upkeep, monkeypatch):
    rows = feed(21, n=90)
    upkeep.put(rows[:30], 0)
    upkeep.conf.append(conf_change("u", "ods_user", 2, 2))
    with monkeypatch.context() as m:
        m.setattr(DimTable, "put", lambda *a: 1 / 0)  # the config's change is stored, the rows are not
        with pytest.raises(ZeroDivisionError):
            upkeep.put(rows[30:60], 1)
    upkeep.put(rows[30:60], 1)
    assert upkeep.table() == replay(rows[30:60])
    upkeep.put(rows[60:], 2)
    assert upkeep.table() == replay(rows[30:])


def test_delete_and_return(upkeep):
    row = {"user_id": "1", "user_name": "a", "gender": None, "vip_end": None}
    upkeep.put([("c", None, row, ("m", "ods_user", 1), 1)], 0)
    assert len(upkeep.table()) == 1
    upkeep.put([("d", row, None, ("m", "ods_user", 2), 2)], 1)
    assert upkeep.table() == {}
    upkeep.put([("u", None, row | {"user_name": None}, ("m", "ods_user", 3), 3)], 2)
    assert upkeep.table() == {1: dict.fromkeys(FIELDS[1:])}


def test_config_of_each_batch_routes_and_clears(upkeep):
    rows = feed(5, n=90)
    upkeep.put(rows[:30], 0)
    # A change clears the table before the rows of its batch, once.
    upkeep.conf.append(conf_change("u", "ods_user", 2, 2))
    upkeep.put(rows[30:60], 1)
    assert upkeep.table() == replay(rows[30:60])
    upkeep.put(rows[60:], 2)
    assert upkeep.table() == replay(rows[30:])
    upkeep.put(rows[60:], 2)
    assert upkeep.table() == replay(rows[30:])
    # A deleted config row drops the table and ends routing; a new one starts it anew.
    upkeep.conf.append(conf_change("d", "ods_user", 3, 3))
    upkeep.put(rows[:30], 3)
    assert upkeep.table() == {}
    upkeep.conf.append(conf_change("u", "ods_user", 4, 4, "user_id,user_name"))
    upkeep.put(rows[:30], 4)
    assert upkeep.table() == {
        k: v | {"gender": None, "vip_end": None} for k, v in replay(rows[:30]).items()
    }


def test_other_tables_are_routed_away(upkeep):
    rows = feed(3, n=40)
    other = [(op, b, a, ("music", "ods_banner", 500 + i), ts)
             for i, (op, b, a, _, ts) in enumerate(feed(4, n=20))]
    upkeep.put(rows + other, 0)
    assert upkeep.table() == replay(rows)


def test_keys_of_their_own_type_and_unusable_keys(spark, upkeep):
    text_key = StructType([StructField("user_id", StringType()), StructField("user_name", StringType())])
    row = lambda key: {"user_id": key, "user_name": "n", "gender": None, "vip_end": None}
    rows = [("c", None, row(k), ("m", "ods_user", i), i) for i, k in enumerate(["AB1", "77", None])]
    got = dims.current_rows(frame(spark, rows), text_key, "user_id").collect()
    assert sorted(r["user_id"] for r in got) == ["77", "AB1"]
    upkeep.put(rows, 0)
    assert set(upkeep.table()) == {77}
    skipped = spark.read.parquet(f"{upkeep.root}/skipped/dim_user").collect()
    assert {r["reason"]: r["changes"] for r in skipped} == {"no key": 1, "key of another type": 1}


def test_upkeep_plans_shuffle_once_and_never_sort_aggregate(spark):
    effect = dims.net_effect(frame(spark, feed(1, n=20)), DIM_USER, "user_id")
    text = effect._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and text.count("Exchange hashpartitioning") == 1
    conf = C.current_config(spark.createDataFrame([conf_change("r", "ods_a", 1, 1)], CONF))
    assert "SortAggregate" not in conf._jdf.queryExecution().executedPlan().toString()


def config(spark, rows):
    return spark.createDataFrame(
        rows, "source_table string, sink_table string, sink_columns string, sink_row_key string"
    )


def test_config_last_change_wins_and_delete_ends_routing(spark):
    rows = [conf_change("r", "ods_a", 1, 1), conf_change("u", "ods_a", 3, 2),
            conf_change("r", "ods_b", 2, 1), conf_change("d", "ods_b", 4, 2)]
    got = C.current_config(spark.createDataFrame(rows, CONF)).collect()
    assert [r["source_table"] for r in got] == ["ods_a"]


def test_configured_columns_only_are_written(spark):
    rows = feed(6, n=60)
    for listed in ("user_id, user_name,vip_end", "", None):
        conf = config(spark, [("ods_user", "dim_user", listed, "user_id")])
        routed = C.route(frame(spark, rows), conf)
        got = as_dict(dims.current_rows(routed, DIM_USER, "user_id"))
        want = replay(rows)
        if listed:
            want = {k: v | {"gender": None} for k, v in want.items()}
        assert got == want


def test_row_key(spark):
    row = spark.range(1).select(C.row_key(F.lit("user_id"), F.lit(7)).alias("k")).first()
    assert row["k"] == "user_id7"
