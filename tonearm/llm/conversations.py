"""Conversation structure repair: the cheapest edits that make a conversation's roles legal.

Legal are no turns at all, or user and assistant in turn from a user to an assistant, with
at most one system turn before them. A row is kept, given the other role, or deleted; empty
turns may be inserted anywhere. Edits of a conversation are paths over a lattice of (rows
taken, role last written). Bidirectional Dijkstra finds the cheapest: a heap from the
start and one from the end meet, all crossings of the least cost are finished, and the one
with the least concatenated audit is taken.

Rows are sorted in ranges and cut into segments of bounded size, so that a conversation of
any length is repaired by many tasks. A segment that is a whole conversation is one search;
a part of one is searched for each pair of roles that it may begin and end with, and the
parts are put together from these answers. That is exact: of two audits of equal cost
between the same two nodes none begins with the other, as both hold a letter for each row.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.llm.common import stash

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
LEGAL_ENDS = (NOTHING, ASSISTANT)
#: Which role may follow what has been written.
FOLLOWS = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: The one role that an inserted or re-roled turn can have.
DUE = {NOTHING: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
LEGAL_PAIRS = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
#: Rows and characters of a segment; one row may be longer.
SEGMENT_ROWS, SEGMENT_CHARS = 512, 1_000_000
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
NOT_SPACE = r"[^\x20\x09-\x0D]"

Row = tuple[str, int]  # the role's initial, the fault


@cache
def row_edges(initial: str, fault: int) -> tuple[dict, dict]:
    """What may be done to a row: (state, cost, letter) by the state before it, and by the state after it."""
    ahead: dict[int, list] = {s: [(s, DELETE_COST, DELETE)] for s in STATES}
    if fault not in (BLANK, DUPLICATE):
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        for state in STATES:
            if initial in FOLLOWS[state]:
                ahead[state].append((FOLLOWS[state][initial], more, KEEP))
            ahead[state].append((FOLLOWS[state][DUE[state][0]], more + REROLE_COST, REROLE))
    return ahead, _turned(ahead)


def _turned(ahead: dict[int, list]) -> dict[int, list]:
    back: dict[int, list] = {s: [] for s in STATES}
    for state, edges in ahead.items():
        for after, cost, letter in edges:
            back[after].append((state, cost, letter))
    return back


INSERTS = {s: [(FOLLOWS[s][DUE[s][0]], INSERT_COST, INSERT)] for s in STATES}
INSERTED = _turned(INSERTS)


def cheapest(rows: list[Row], entry: int, ends: Iterable[int]) -> tuple[int, str, int] | None:
    """(cost, audit, end state) of the cheapest edits from ``entry`` to one of ``ends``; of equal
    costs the least audit. None if no edits lead there.

    Labels leave a heap by cost, then by how far they are, then by audit: edges without a
    cost go on to the next row, so a node's first label is its cheapest with the least audit.
    """
    n = len(rows)
    edges = [row_edges(*r) for r in rows]
    ahead: dict[tuple[int, int], tuple] = {}
    behind: dict[tuple[int, int], tuple] = {}
    forward = [(0, 0, "", entry)]
    backward = [(0, 0, "", state, state) for state in ends]
    heapq.heapify(backward)
    best: tuple = (math.inf, "", -1)

    def settle_forward() -> None:
        nonlocal best
        cost, at, audit, state = heapq.heappop(forward)
        if (at, state) in ahead:
            return
        ahead[at, state] = (cost, audit)
        if met := behind.get((at, state)):
            best = min(best, (cost + met[0], audit + met[1], met[2]))
        steps = [(at, *e) for e in INSERTS[state]]
        if at < n:
            steps += [(at + 1, *e) for e in edges[at][0][state]]
        for to, after, more, letter in steps:
            if met := behind.get((to, after)):
                best = min(best, (cost + more + met[0], audit + letter + met[1], met[2]))
            if (to, after) not in ahead:
                heapq.heappush(forward, (cost + more, to, audit + letter, after))

    def settle_backward() -> None:
        nonlocal best
        cost, left, audit, state, end = heapq.heappop(backward)
        at = n - left
        if (at, state) in behind:
            return
        behind[at, state] = (cost, audit, end)
        if met := ahead.get((at, state)):
            best = min(best, (met[0] + cost, met[1] + audit, end))
        steps = [(left, *e) for e in INSERTED[state]]
        if at > 0:
            steps += [(left + 1, *e) for e in edges[at - 1][1][state]]
        for to, before, more, letter in steps:
            if met := ahead.get((n - to, before)):
                best = min(best, (met[0] + more + cost, met[1] + letter + audit, end))
            if (n - to, before) not in behind:
                heapq.heappush(backward, (cost + more, to, letter + audit, before, end))

    settle_forward()
    for _ in ends:
        settle_backward()
    # A cheapest path has a node or an edge where the settled parts meet once the tops are beyond its cost.
    while forward and backward and forward[0][0] + backward[0][0] <= best[0]:
        if forward[0][0] <= backward[0][0]:
            settle_forward()
        else:
            settle_backward()
    return None if best[0] == math.inf else best


def apply_audit(audit: str, entry: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that remain."""
    rows, state = iter(zip(roles, texts)), entry
    for letter in audit:
        role, text = (DUE[state], "") if letter == INSERT else next(rows)
        if letter == DELETE:
            continue
        if letter == REROLE:
            role = DUE[state]
        state = FOLLOWS[state][role[:1]]
        yield letter, role, text


def with_faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, fault, again): null role and text are one space; ``again`` marks rows
    whose role and text a smaller turn of the conversation has, which is their fault unless they are blank."""
    base = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    ends_well = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    marked = base.select(
        "*",
        F.when(~F.col("text").rlike(NOT_SPACE), BLANK).when(ends_well, FINE).otherwise(TRUNCATED).alias("fault"),
        F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("turn"), "text", "role").alias("h2"),
        F.struct(F.col("turn").isNotNull().alias("known"), "turn").alias("place"),
    )
    first = (
        marked.where(F.col("fault") != BLANK).groupBy(F.col("conv_id").alias("of_conv"), F.col("h1").alias("of_h1"), F.col("h2").alias("of_h2"))
        .agg(F.min("place").alias("first"), F.max("place").alias("last")).where(F.col("first") != F.col("last"))
    )
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("h1") == F.col("of_h1")) & (F.col("h2") == F.col("of_h2"))
    again = F.coalesce(F.col("place") > F.col("first"), F.lit(False)) & (F.col("fault") != BLANK)
    return marked.join(first, same, "left").select("conv_id", "turn", "role", "text", "fault", again.alias("again"))


SEGMENTS = """conv_id long, part int, seq int, first_turn long, last_turn long, turns long, first_initial string,
    last_initial string, blank long, duplicate long, truncated long, illegal long, costs array<long>,
    audits array<string>, roles array<string>, texts array<string>"""
SEGMENT_TYPE = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
    ("turns", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("costs", pa.list_(pa.int64())),
    ("audits", pa.list_(pa.string())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
])


@dataclass
class Segment:
    """Rows of one conversation that follow each other."""

    conv_id: int | None
    whole: bool = False  # nothing of the conversation lies outside
    rows: list[dict] = field(default_factory=list)
    chars: int = 0

    def record(self, part: int, seq: int) -> dict:
        turns = [r["turn"] for r in self.rows if r["turn"] is not None]
        initials = [r["role"][:1] for r in self.rows]
        faults = [r["fault"] for r in self.rows]
        costs: list[int | None] = [None] * 16
        audits: list[str | None] = [None] * 16
        steps = list(zip(initials, faults))
        tasks = [(NOTHING, LEGAL_ENDS)] if self.whole else [(a, (b,)) for a in STATES for b in STATES]
        for entry, ends in tasks:
            if found := cheapest(steps, entry, ends):
                costs[entry * 4 + found[2]], audits[entry * 4 + found[2]] = found[:2]
        return {
            "conv_id": self.conv_id, "part": part, "seq": seq, "first_turn": min(turns, default=None),
            "last_turn": max(turns, default=None), "turns": len(set(turns)), "first_initial": initials[0],
            "last_initial": initials[-1], "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE),
            "truncated": faults.count(TRUNCATED), "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:])),
            "costs": costs, "audits": audits, "roles": [r["role"] for r in self.rows], "texts": [r["text"] for r in self.rows],
        }


def _cut(rows: Iterable[dict], most_rows: int, most_chars: int) -> Iterator[Segment]:
    """Sorted rows of a range in segments. The first and the last conversation of a range may go on outside."""
    held: Segment | None = None
    before: dict | None = None
    number = 0
    for row in rows:
        same = before is not None and row["conv_id"] == before["conv_id"]
        if same and row["fault"] != BLANK and all(row[k] == before[k] for k in ("turn", "role", "text")):
            row["again"] = True
        before = row
        if row["again"]:
            row["fault"] = DUPLICATE
        size = len(row["text"])
        if held and not same:
            held.whole = number > 0 and held.whole
            yield held
            held, number = None, number + 1
        elif held and (len(held.rows) >= most_rows or held.chars + size > most_chars):
            held.whole = False
            yield held
            held = Segment(row["conv_id"])
        if held is None:
            held = Segment(row["conv_id"], whole=True)
        held.rows.append(row)
        held.chars += size
    if held:
        held.whole = False
        yield held


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from batch.slice(at, 256).to_pylist()


def _batched(records: Iterable[dict], schema: pa.Schema, text: str | None = None, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded size; ``text`` names the column that a record's size goes by."""
    held, size = [], 0
    for r in records:
        held.append(r)
        own = r[text] if text else ""
        size += 200 + (sum(map(len, own)) if isinstance(own, list) else len(own))
        if size > chars:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _segments(most_rows: int, most_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        cut = _cut(_records(batches), most_rows, most_chars)
        yield from _batched((s.record(part, i) for i, s in enumerate(cut)), SEGMENT_TYPE, "texts")

    return run


AUDITS = """conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,
    path array<struct<part:int,seq:int,entry:int,leaves:int>>"""
AUDIT_TYPE = pa.schema([
    *((name, pa.int64()) for name in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()),
    ("path", pa.list_(pa.struct([(name, pa.int32()) for name in ("part", "seq", "entry", "leaves")]))),
])


def _chain(segments: Iterable[dict]) -> Iterator[dict]:
    """Conversations out of their segments, which come in order: the cheapest way through all of them."""
    total: dict = {}
    ways: dict[int, tuple] = {}
    turns = first = last = initial = None

    def done() -> dict:
        cost, audit, way = min(ways[s] for s in LEGAL_ENDS if s in ways)
        path = []
        while way:
            way, step = way
            path.append(step)
        gaps = 0 if first is None else last - first + 1 - turns
        return {**total, "gaps": gaps, "cost": cost, "audit": audit, "path": path[::-1]}

    for s in segments:
        if not total or s["conv_id"] != total["conv_id"]:
            if total:
                yield done()
            total = {"conv_id": s["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
            ways, turns, first, last, initial = {NOTHING: (0, "", None)}, 0, None, None, None
        for name in ("blank", "duplicate", "truncated", "illegal"):
            total[name] += s[name]
        total["illegal"] += initial is not None and initial + s["first_initial"] not in LEGAL_PAIRS
        initial = s["last_initial"]
        if s["turns"]:
            turns += s["turns"] - (last == s["first_turn"])
            first, last = s["first_turn"] if first is None else first, s["last_turn"]
        onward: dict[int, tuple] = {}
        for entry, (cost, audit, way) in ways.items():
            for leaves in STATES:
                more = s["costs"][entry * 4 + leaves]
                if more is None:
                    continue
                step = (way, {"part": s["part"], "seq": s["seq"], "entry": entry, "leaves": leaves})
                new = (cost + more, audit + s["audits"][entry * 4 + leaves], step)
                if leaves not in onward or new[:2] < onward[leaves][:2]:
                    onward[leaves] = new
        ways = onward
    if total:
        yield done()


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batched(_chain(_records(batches)), AUDIT_TYPE, "audit")


TURNS = "conv_id long, part int, seq int, place int, edit string, role string, text string"
TURN_TYPE = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("place", pa.int32()),
    ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()),
])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each() -> Iterator[dict]:
        for s in _records(batches):
            kept = apply_audit(s["audit"], s["entry"], s["roles"], s["texts"])
            for place, (edit, role, text) in enumerate(kept):
                yield {**{k: s[k] for k in ("conv_id", "part", "seq")}, "place": place, "edit": edit, "role": role, "text": text}

    yield from _batched(each(), TURN_TYPE, "text")


def repair_conversations(
    rows: DataFrame, segment_rows: int = SEGMENT_ROWS, segment_chars: int = SEGMENT_CHARS
) -> tuple[DataFrame, DataFrame]:
    """(audits, turns) of ``rows`` (conv_id, turn, role, text; other columns are left out).

    Audits: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, a row per
    conversation. Turns: the repaired conversations, ordered in each by part, seq and place.

    Rows go by turn, nulls first, and rows of one turn by role and text. Null roles and
    texts are one space, so such a role is never legal and such a text is blank. Roles
    count by their first character, an empty role is never legal. A null conv_id is one
    conversation. Repeated rows are duplicates of the first. An empty table has no
    conversations. Texts of any length stay whole. An audit is one value, so a
    conversation may have as many rows as a string can have letters.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ready = stash(with_faults(rows), "conversation-rows")
    in_order = ready.repartitionByRange(n, "conv_id", "turn", "role").sortWithinPartitions("conv_id", "turn", "role", "text")
    segments = stash(in_order.mapInArrow(_segments(segment_rows, segment_chars), SEGMENTS), "conversation-segments")
    answers = segments.drop("roles", "texts").repartition(n, "conv_id").sortWithinPartitions("conv_id", "part", "seq")
    audits = stash(answers.mapInArrow(_audits, AUDITS), "conversation-audits")
    steps = audits.select(F.explode("path").alias("step")).select("step.*")
    chosen = segments.join(steps, ["part", "seq"]).select(
        "conv_id", "part", "seq", "entry", F.get("audits", F.col("entry") * 4 + F.col("leaves")).alias("audit"), "roles", "texts"
    )
    return audits.drop("path"), chosen.mapInArrow(_turns, TURNS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def each() -> Iterator[dict]:
        current, hashed = None, None
        for t in _records(batches):
            line = f"{t['role']}:{t['text']}".encode("utf-8", "surrogatepass")
            if hashed is not None and t["conv_id"] == current:
                hashed.update(b"\n" + line)
                continue
            if hashed is not None:
                yield {"conv_id": current, "sha256": hashed.hexdigest()}
            current, hashed = t["conv_id"], hashlib.sha256(line)
        if hashed is not None:
            yield {"conv_id": current, "sha256": hashed.hexdigest()}

    yield from _batched(each(), pa.schema([("conv_id", pa.int64()), ("sha256", pa.string())]))


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of ``role:text`` of a conversation's turns, joined by newlines.

    One hash over a whole conversation has one order, so its turns stream through one
    task; the task holds a batch of them at a time."""
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = turns.repartition(n, "conv_id").sortWithinPartitions("conv_id", "part", "seq", "place")
    return in_order.mapInArrow(_digests, "conv_id long, sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults made by a hash of id and turn: of 20 rows one each is dropped, emptied,
    robbed of its sentence ends, repeated, made a user's. Nulls are one space."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    changed: Column = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.translate(text, ".!?", "")).otherwise(text)
    return (
        rows.select("conv_id", "turn", "role", "text", what.alias("what")).where("what <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(role).alias("role"), changed.alias("text"),
            F.explode(F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        ).drop("copy")
    )
