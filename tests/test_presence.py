"""Listeners per song against a sequential replay."""

import random

import pytest

from tonearm.operators import presence, ranking

PLAYS = "play_id long, song_id long, lead_song_id long, user_id long, start_ts long"


def plays(seed, n=300, songs=6, users=8):
    rnd = random.Random(seed)
    last, out = {}, []
    for i in range(n):
        user, song = rnd.randrange(users), rnd.randrange(songs)
        lead = last.get(user) if rnd.random() < 0.9 else rnd.randrange(songs)
        out.append((i + 1, song, lead, user, 1000 + rnd.randrange(3) + i // 3 * 3))
        last[user] = song
    rnd.shuffle(out)
    return out


def replay(rows):
    inside = {}
    for _, song, lead, user, _ in sorted(rows, key=lambda r: (r[4], r[0])):
        inside.setdefault(song, set()).add(user)
        if lead is not None:
            inside.setdefault(lead, set()).discard(user)
    return {song: len(users) for song, users in inside.items()}


def online(spark, rows):
    df = spark.createDataFrame(rows, PLAYS)
    got = presence.online_listeners(presence.presence_changes(df)).collect()
    return {r["song_id"]: r["current_online_count"] for r in got}


@pytest.mark.parametrize("seed", range(4))
def test_equals_sequential_replay(spark, seed):
    rows = plays(seed)
    assert online(spark, rows) == replay(rows)


def test_same_song_twice_nets_to_leave(spark):
    assert online(spark, [(1, 5, None, 1, 10), (2, 5, 5, 1, 20)]) == {5: 0}


def test_a_song_only_left_appears_with_zero(spark):
    assert online(spark, [(1, 5, 4, 1, 10)]) == {5: 1, 4: 0}


def test_large_ids_and_times_keep_their_order(spark):
    big = 9_223_372_036_854_775_000
    rows = [(big, 5, None, 1, 1748511173000), (big + 1, 6, 5, 1, 1748511173000)]
    assert online(spark, rows) == {5: 0, 6: 1}
    assert online(spark, [(1, 5, None, 1, None), (2, 6, 5, 1, 1)]) == {5: 0, 6: 1}
    far = 2 * 10**17
    assert online(spark, [(9, 5, None, 1, far), (2, 6, 5, 1, far + 5)]) == {5: 0, 6: 1}
    assert online(spark, [(1, 5, None, 1, -far), (2, 6, 5, 1, -far - 5)]) == {5: 1, 6: 1}


def test_top_n_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(3, 7), (1, 7), (2, 9), (4, 1)], "song_id long, n long")
    got = ranking.top_n(df, "n", "song_id", 3).collect()
    assert sorted((r["rank"], r["song_id"]) for r in got) == [(1, 2), (2, 1), (3, 3)]
