"""Conversation repair against a plain dynamic program over all edits."""

import hashlib
import random
import zlib

import pytest

from tonearm.llm import conversations as C
from tonearm.llm.queries import op11_conversation_repair

SPACES = " \t\n\x0b\x0c\r"
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain_repair(rows):
    """(cost, audit, lines) by keeping the least of all audits per row and role last written."""
    ways = {C.NOTHING: (0, "", [])}

    def offer(to, state, way):
        if state not in to or way[:2] < to[state][:2]:
            to[state] = way

    def with_inserts(now):
        for _ in range(3):
            for state, (cost, audit, lines) in list(now.items()):
                role = C.DUE[state]
                offer(now, C.FOLLOWS[state][role[0]], (cost + 5, audit + "I", [*lines, f"{role}:"]))
        return now

    for role, text, fault in rows:
        onward = {}
        for state, (cost, audit, lines) in with_inserts(ways).items():
            offer(onward, state, (cost + 2, audit + "D", lines))
            if fault in (C.BLANK, C.DUPLICATE):
                continue
            more = 5 if fault == C.TRUNCATED else 0
            if role[:1] in C.FOLLOWS[state]:
                offer(onward, C.FOLLOWS[state][role[:1]], (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
            due = C.DUE[state]
            offer(onward, C.FOLLOWS[state][due[0]], (cost + more + 1, audit + "R", [*lines, f"{due}:{text}"]))
        ways = onward
    ends = with_inserts(ways)
    return min(ends[s] for s in C.LEGAL_ENDS if s in ends)


def judged(rows):
    """(role, text, fault) of (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        body = text.rstrip(SPACES)
        fault = C.BLANK if not body else C.DUPLICATE if (role, text) in seen else C.FINE if body[-1] in ".!?" else C.TRUNCATED
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        held = by.setdefault(conv, [])
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if what == 1:
            text = ""
        if what == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if what == 4:
            role = "user"
        held += [(turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    out = {}
    for conv, held in by.items():
        found = judged(held)
        faults = [f for _, _, f in found]
        turns = {t for t, _, _ in held if t is not None}
        cost, audit, lines = plain_repair(found)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(found, found[1:])]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(C.BLANK), faults.count(C.DUPLICATE),
            faults.count(C.TRUNCATED), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def made_up(seed, conversations=60, longest=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \n", None, "What?", "Well, then!", "and so", "Yes. ", "a long one. " * 40]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = []
    for conv in [*range(conversations), None, 10**15 + 1]:
        for turn in range(rng.randint(0 if conv else 1, longest)):
            turn = rng.choice([turn, turn, turn, turn + 3, None, 2])
            role = rng.choice(roles[:2] if rng.random() < 0.5 else roles)
            rows.append((conv, turn, role, rng.choice(texts)))
    return rows + rows[:9]


SCHEMA = "conv_id long, turn long, role string, text string, fault int, part string, again string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def test_search_equals_dynamic_program():
    rng = random.Random(3)
    for _ in range(1500):
        rows = [(rng.choice("usatx") if rng.random() < 0.95 else "", rng.choice([0, 0, 0, 1, 2, 3, 3])) for _ in range(rng.randint(0, 9))]
        cost, audit, _ = plain_repair([(r, "", f) for r, f in rows])
        assert C.cheapest(rows, C.NOTHING, C.LEGAL_ENDS)[:2] == (cost, audit)


@pytest.mark.parametrize("most_rows", [3, 512])
def test_repair_of_damaged_conversations(spark, most_rows):
    rows = made_up(most_rows)
    audits, turns = C.repair_conversations(C.damaged(frame(spark, rows)), segment_rows=most_rows)
    hashes = {r["conv_id"]: r["sha256"] for r in C.turn_digests(turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    found = {r["conv_id"]: (*(r[f] for f in FIELDS[:-1]), hashes.get(r["conv_id"], empty)) for r in audits.collect()}
    wanted = expected(rows)
    kept = {c for c, w in wanted.items() if w != (0, 0, 0, 0, 0, 0, "", empty)}
    assert {c: found[c] for c in kept} == {c: wanted[c] for c in kept}
    assert all(found[c] == wanted[c] for c in found)


def test_one_long_conversation_is_cut_and_put_together(spark):
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"Turn {rng.randint(0, 900)}{rng.choice(['.', '', '!'])}") for t in range(900)]
    audits, turns = C.repair_conversations(frame(spark, rows), segment_rows=50)
    cost, audit, lines = plain_repair(judged([r[1:] for r in rows]))
    (found,) = audits.collect()
    assert (found["cost"], found["audit"]) == (cost, audit)
    in_order = turns.orderBy("part", "seq", "place").collect()
    assert [f"{t['role']}:{t['text']}" for t in in_order] == lines


def test_empty_table(spark):
    audits, turns = C.repair_conversations(frame(spark, []))
    assert audits.collect() == [] and turns.collect() == [] and C.turn_digests(turns).collect() == []


def test_every_conversation_is_in_the_result(spark, tmp_path):
    rows = made_up(5, 40, 3)
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert found == expected(rows)
