"""Quality routing on hand-written records."""

import json

import pytest

from tonearm.operators.quality import Rule, dirty_type, is_clean
from tonearm.plans import facts
from tonearm.sources import changefeed, logs


def line(kind, common, **more):
    return json.dumps({"common": common, "channel": "APP", "mac_id": "1", "type": kind, "ts": 1}
                      | more)


PLAY = {"play_id": 41, "song_id": 7, "user_id": 12, "channel": "inner",
        "lead_song_id": None, "start_ts": 1_700_006_400_000}
LOGIN = {"login_id": 1, "user_id": 5, "province_id": 3, "login_ts": 1}

CASES = [
    ("good", line("play", PLAY), None),
    ("user zero", line("play", PLAY | {"user_id": 0}), "1"),
    ("user negative", line("play", PLAY | {"user_id": -4}), "1"),
    ("user zero, song missing: the first rule decides",
     line("play", {"play_id": 1, "user_id": 0}), "1"),
    ("song missing", line("play", {"play_id": 1, "user_id": 5}), "2"),
    ("user zero, song text: casts come first", line("play", PLAY | {"user_id": 0, "song_id": "x"}),
     "2"),
    ("quoted number", line("play", PLAY | {"song_id": "12"}), None),
    ("empty text is missing", line("play", PLAY | {"song_id": ""}), "2"),
    ("empty text after a failed range", line("play", PLAY | {"user_id": 0, "song_id": ""}), "1"),
    ("fraction", line("play", PLAY | {"song_id": 1.7}), "2"),
    ("no common", line("play", None), "2"),
    ("common is a text", line("play", "oops"), "2"),
    ("lead song text", line("play", PLAY | {"lead_song_id": "abc"}), None),
    ("play id zero", line("play", PLAY | {"play_id": 0}), "1"),
    ("province 0", line("login", LOGIN | {"province_id": 0}), "1"),
    ("province 34", line("login", LOGIN | {"province_id": 34}), None),
    ("province 35", line("login", LOGIN | {"province_id": 35}), "1"),
    ("province too large for an int", line("login", LOGIN | {"province_id": 99999999999}), "2"),
    ("province missing", line("login", {"login_id": 1, "user_id": 5}), "2"),
]


@pytest.fixture(scope="module")
def verdicts(spark):
    rows = spark.createDataFrame([(text,) for _, text, _ in CASES], "value string")
    tagged = facts.tag_log(logs.parse_log(rows.coalesce(1)))
    return [r["dirty_type"] for r in tagged.collect()]


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] for c in CASES])
def test_verdict(verdicts, i):
    assert verdicts[i] == CASES[i][2]


def test_clean_test_agrees_with_the_chain(spark):
    rules = [Rule("a"), Rule("b", "int", 35), Rule("c", present_only=True)]
    values = [None, "", "null", "0", "-1", "1", "34", "35", "x", "1.5", " 7 ", "99999999999"]
    rows = [(a, b, c) for a in values for b in values for c in (None, "", "101")]
    df = spark.createDataFrame(rows, "a string, b string, c string").selectExpr("struct(*) AS r")
    odd = df.where(f"({is_clean(rules, 'r')}) <> (({dirty_type(rules, 'r')}) IS NULL)")
    assert odd.count() == 0


def test_unusable_lines_are_dropped_and_counted(spark):
    texts = ["not json", '{"common":{}}', line("play", PLAY), line("dance", PLAY)]
    rows = logs.parse_log(spark.createDataFrame([(t,) for t in texts], "value string"))
    counts = {r["reason"]: r["dropped"] for r in facts.dropped(rows).collect()}
    assert counts == {"no type": 2, "unknown type": 1}
    assert facts.clean_fact(rows, facts.PLAY).count() == 1
    assert facts.dirty_log_records(rows).count() == 0


def test_outer_channel_wins_and_bad_lead_song_is_null(spark):
    text = line("play", PLAY | {"lead_song_id": "abc"})
    rows = logs.parse_log(spark.createDataFrame([(text,)], "value string"))
    row = facts.clean_fact(rows, facts.PLAY).first()
    assert row["channel"] == "APP"
    assert row["lead_song_id"] is None


def test_raw_layer_keeps_any_field(spark):
    df = spark.createDataFrame([(line("play", PLAY | {"new": 1}),), ("bad",)], "value string")
    (row,) = logs.parse_raw_log(df).collect()
    assert row["common"]["new"] == "1" and row["type"] == "play"


ORDER = {"order_id": 1, "user_id": 8, "album_id": 77, "amount": 25, "order_num": 3,
         "status_type_id": "101", "pay_type": "card", "channel_id": 2, "create_ts": 1_700_006_400}


def change(op, after, table="ods_album_order"):
    return json.dumps({"op": op, "after": after, "ts_ms": 9,
                       "source": {"db": "music", "table": table, "pos": 1}})


def test_order_statuses_and_faults(spark):
    texts = [
        change("r", ORDER),
        change("r", ORDER | {"order_id": 2, "status_type_id": "103"}),
        change("r", ORDER | {"order_id": 3, "status_type_id": None}),
        change("r", ORDER | {"order_id": 4, "amount": "x"}),
        change("r", ORDER | {"order_id": 5, "amount": 0}),
        change("d", None),
        change("r", ORDER | {"order_id": 6}, table="ods_other"),
        "not json",
    ]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    feed = changefeed.of_table(changefeed.parse_changes(lines, list(ORDER)), "music")
    good = facts.clean_fact(feed, facts.ALBUM).collect()
    assert [(r["order_id"], r["dt"], r["album_id"]) for r in good] == [(1, "20231115", "77")]
    bad = facts.dirty_trade_records(feed, facts.ALBUM).collect()
    found = {json.loads(r["record"])["after"]["order_id"]: r["dirty_type"] for r in bad}
    assert found == {3: "1", 4: "2", 5: "1"}
    assert {r["record"] for r in bad} == set(texts[2:5])
    assert changefeed.of_table(feed, "music", "ods_other").count() == 1
