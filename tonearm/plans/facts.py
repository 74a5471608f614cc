"""The ten cleaned fact tables as specifications over one builder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.functions.casting import lenient
from tonearm.functions.timefmt import seconds_to_partition_date
from tonearm.operators import lookup as L
from tonearm.operators.quality import Rule, dirty_type, is_clean, province
from tonearm.sources.logs import parse_records

Enrich = Callable[[DataFrame, "L.Dims", "L.Spread"], DataFrame]


@dataclass(frozen=True)
class FactSpec:
    """What one fact reads, checks, looks up and writes.

    `record` is the log type, or the change-feed table when `change_feed` is set.
    `columns` are the fields taken from the record with their types.
    """

    name: str
    record: str
    id: str
    rules: list[Rule]
    columns: dict[str, str]
    enrich: list[Enrich] = field(default_factory=list)
    change_feed: bool = False
    keep_status: str | None = None
    dated_by: str | None = None

    @property
    def body(self) -> str:
        return "after" if self.change_feed else "common"

    def is_clean(self) -> str:
        return is_clean(self.rules, self.body)

    def dirty_type(self) -> str:
        return dirty_type(self.rules, self.body)


PLAY = FactSpec(
    "dwd_play", "play", "play_id",
    [Rule("user_id"), Rule("song_id"), Rule("play_id")],
    {"play_id": "bigint", "song_id": "bigint", "user_id": "bigint", "lead_song_id": "bigint",
     "start_ts": "bigint"},
    [L.add_song_and_singer, L.add_lead_song_and_singer, L.add_user],
)
SEARCH = FactSpec(
    "dwd_search", "search", "search_id",
    [Rule("user_id"), Rule("song_id"), Rule("search_id"), province()],
    {"search_id": "bigint", "song_id": "bigint", "user_id": "bigint", "province_id": "int",
     "s_ts": "bigint"},
    [L.add_user, L.add_province, L.add_song_and_singer],
)
COLLECT = FactSpec(
    "dwd_collect", "collect", "collect_id",
    [Rule("user_id"), Rule("song_id"), Rule("collect_id")],
    {"collect_id": "bigint", "song_id": "bigint", "user_id": "bigint", "c_ts": "bigint"},
    [L.add_user, L.add_song],
)
COMMENT = FactSpec(
    "dwd_comment", "comment", "comment_id",
    [Rule("user_id"), Rule("song_id"), Rule("comment_id"), province()],
    {"comment_id": "bigint", "song_id": "bigint", "user_id": "bigint", "content": "string",
     "province_id": "int", "comment_date": "bigint"},
    [L.add_user, L.add_province, L.add_song],
)
SINGER_FOLLOW = FactSpec(
    "dwd_singer_follow", "singer_follow", "follow_id",
    [Rule("user_id"), Rule("singer_id"), Rule("follow_id")],
    {"follow_id": "bigint", "singer_id": "bigint", "user_id": "bigint", "c_ts": "bigint"},
    [L.add_user, L.add_singer],
)
LOGIN = FactSpec(
    "dwd_login", "login", "login_id",
    [Rule("user_id"), Rule("login_id"), province()],
    {"login_id": "bigint", "user_id": "bigint", "province_id": "int", "login_ts": "bigint"},
    [L.add_user, L.add_province],
)
REGISTER = FactSpec(
    "dwd_register", "register", "register_id",
    [Rule("user_id"), Rule("register_id"), province()],
    {"register_id": "bigint", "user_id": "bigint", "province_id": "int", "channel_ts": "bigint"},
    [L.add_user, L.add_province],
)

ORDER_RULES = [
    Rule("user_id"), Rule("order_id"), Rule("order_num"), Rule("amount"),
    Rule("status_type_id", present_only=True),
]
VIP = FactSpec(
    "dwd_trade_vip", "ods_vip_order", "order_id", ORDER_RULES,
    {"user_id": "bigint", "order_id": "bigint", "order_num": "bigint", "amount": "bigint",
     "status_type_id": "string", "pay_type": "string", "vip_type": "string",
     "channel_id": "bigint", "create_ts": "bigint"},
    [L.add_vip_user], change_feed=True, keep_status="101", dated_by="create_ts",
)
ALBUM = FactSpec(
    "dwd_trade_album", "ods_album_order", "order_id", ORDER_RULES,
    {"user_id": "bigint", "order_id": "bigint", "order_num": "bigint", "amount": "bigint",
     "status_type_id": "string", "pay_type": "string", "album_id": "string",
     "channel_id": "bigint", "create_ts": "bigint"},
    [L.add_user], change_feed=True, keep_status="101", dated_by="create_ts",
)
CANCEL = FactSpec(
    "dwd_trade_cancel", "ods_cancel_order", "order_cancel_id",
    [Rule("order_cancel_id"), Rule("order_id")],
    {"order_cancel_id": "bigint", "order_id": "bigint", "order_type": "bigint",
     "cancel_reason": "string", "cancel_ts": "bigint", "status": "string"},
    change_feed=True, dated_by="cancel_ts",
)

LOG_FACTS = [PLAY, SEARCH, COLLECT, COMMENT, SINGER_FOLLOW, LOGIN, REGISTER]
TRADE_FACTS = [VIP, ALBUM, CANCEL]


def records(source: DataFrame, spec: FactSpec) -> DataFrame:
    """The records of one fact: log rows of its type, or live rows of its change table."""
    if not spec.change_feed:
        return source.where(F.col("type") == spec.record)
    mine = source.where((F.col("source.table") == spec.record) & (F.col("op") != "d"))
    return mine.where(F.col("after").isNotNull())


def typed_columns(spec: FactSpec) -> list[str]:
    cols = []
    for name, type_name in spec.columns.items():
        leaf = f"{spec.body}.{name}"
        cols.append(f"{leaf if type_name == 'string' else lenient(leaf, type_name)} AS {name}")
    return cols if spec.change_feed else [*cols, "channel"]


def dated(rows: DataFrame, spec: FactSpec) -> DataFrame:
    if spec.dated_by:
        rows = rows.withColumn("dt", seconds_to_partition_date(F.col(spec.dated_by)))
    return rows


def typed(clean: DataFrame, spec: FactSpec) -> DataFrame:
    return dated(clean.selectExpr(*typed_columns(spec)), spec)


def clean_fact(source: DataFrame, spec: FactSpec) -> DataFrame:
    """Clean typed rows of one fact, without dimension columns."""
    rows = records(source, spec).where(spec.is_clean())
    if spec.keep_status is not None:
        rows = rows.where(F.col(f"{spec.body}.status_type_id") == spec.keep_status)
    return typed(rows, spec)


def enrich(clean: DataFrame, spec: FactSpec, dims: L.Dims) -> DataFrame:
    for step in spec.enrich:
        clean = step(clean, dims, [spec.id])
    return clean


def build_fact(source: DataFrame, spec: FactSpec, dims: L.Dims) -> DataFrame:
    return enrich(clean_fact(source, spec), spec, dims)


def of_lines(lines: DataFrame, spec: FactSpec) -> DataFrame:
    """The records of one log fact from log texts, of which only its own are parsed, and
    only to the fields that it checks or keeps."""
    fields = list(dict.fromkeys([*(r.field for r in spec.rules), *spec.columns]))
    return parse_records(lines, spec.record, fields)


# All log facts check the same few fields in the same order, each fact some of them.
# `_id` is the id field of the row's own type.
_CHECKED = ["user_id", "song_id", "singer_id", "_id", "province_id"]


def _checked_field(spec: FactSpec, rule: Rule) -> str:
    return "_id" if rule.field == spec.id else rule.field


def _log_rules() -> list[Rule]:
    """The rules of all log facts as one list, each limited to the types it is for. One
    short chain for all types is far smaller in generated code than a chain per type."""
    for spec in LOG_FACTS:
        order = [_CHECKED.index(_checked_field(spec, r)) for r in spec.rules]
        if order != sorted(order):
            raise ValueError(f"{spec.name} checks its fields in another order")
    rules = []
    for name in _CHECKED:
        hits = [(s, r) for s in LOG_FACTS for r in s.rules if _checked_field(s, r) == name]
        if len({(r.type_name, r.below, r.present_only) for _, r in hits}) != 1:
            raise ValueError(f"the facts check {name} by different rules")
        types = ", ".join(f"'{spec.record}'" for spec, _ in hits)
        only = None if len(hits) == len(LOG_FACTS) else f"type IN ({types})"
        leaf = name if name == "_id" else f"common.{name}"
        rules.append(replace(hits[0][1], field=leaf, only=only))
    return rules


def _by_type(value: Callable[[FactSpec], str]) -> str:
    cases = " ".join(f"WHEN '{spec.record}' THEN {value(spec)}" for spec in LOG_FACTS)
    return f"CASE type {cases} END"


_FACT = _by_type(lambda s: f"'{s.name}'")
_OWN_ID = _by_type(lambda s: f"common.{s.id}")
_RULES = _log_rules()


def record_text(rows: DataFrame, body: str | None = None) -> Column:
    """The text a record came as. Rows that never were text are written as one."""
    if "value" in rows.columns:
        return F.col("value")
    return F.to_json(F.col(body) if body else F.struct("common", "channel", "mac_id", "type", "ts"))


def tag_log(log: DataFrame) -> DataFrame:
    """Every log row with the verdict of its own type's rules, in one pass.

    Rows without a known type get no fact name; `dropped` counts them. Clean rows are
    told by the cheap test; only the others go through the full chain of verdicts.
    """
    known = log.selectExpr("*", f"{_FACT} AS fact", f"{_OWN_ID} AS _id")
    verdict = (f"CASE WHEN fact IS NOT NULL AND NOT {is_clean(_RULES, '')}"
               f" THEN {dirty_type(_RULES, '')} END")
    return known.selectExpr(*log.columns, "fact", f"{verdict} AS dirty_type")


def dirty_log_records(log: DataFrame) -> DataFrame:
    """The dirty table of the log facts: the record as it came, its fact and its fault."""
    known = log.selectExpr("*", f"{_FACT} AS fact", f"{_OWN_ID} AS _id")
    bad = known.where(f"fact IS NOT NULL AND NOT {is_clean(_RULES, '')}")
    return bad.select(
        "fact", F.expr(dirty_type(_RULES, "")).alias("dirty_type"), record_text(log).alias("record"), "ts"
    )


def dirty_trade_records(changes: DataFrame, spec: FactSpec) -> DataFrame:
    bad = records(changes, spec).where(f"NOT {spec.is_clean()}")
    return bad.select(
        F.lit(spec.name).alias("fact"), F.expr(spec.dirty_type()).alias("dirty_type"),
        record_text(changes, "after").alias("record"), F.col("ts_ms").alias("ts"),
    )


def judge_trade(changes: DataFrame, spec: FactSpec) -> DataFrame:
    """What the fact table and the dirty table take of a change feed, in one pass and without the
    texts of clean rows: the typed columns, `_dirty` (the fault, null for a clean row), and for
    dirty rows `_record` and `_ts`. Clean rows of another status are in neither table."""
    rows = records(changes, spec).withColumn("_clean", F.expr(spec.is_clean()))
    if spec.keep_status is not None:
        rows = rows.where(~F.col("_clean") | (F.col(f"{spec.body}.status_type_id") == spec.keep_status))
    return rows.select(
        *[F.expr(c) for c in typed_columns(spec)], "_clean",
        F.when(~F.col("_clean"), F.expr(spec.dirty_type())).alias("_dirty"),
        F.when(~F.col("_clean"), record_text(changes, "after")).alias("_record"),
        F.when(~F.col("_clean"), F.col("ts_ms")).alias("_ts"),
    )


def judged_clean(judged: DataFrame, spec: FactSpec) -> DataFrame:
    """The same rows as `clean_fact` gives."""
    return dated(judged.where("_clean").select(*spec.columns), spec)


def judged_dirty(judged: DataFrame, spec: FactSpec) -> DataFrame:
    """The same rows as `dirty_trade_records` gives."""
    return judged.where("NOT _clean").select(
        F.lit(spec.name).alias("fact"), F.col("_dirty").alias("dirty_type"),
        F.col("_record").alias("record"), F.col("_ts").alias("ts"),
    )


def dropped(log: DataFrame) -> DataFrame:
    """How many log rows no fact takes: unparsable ones and ones without a known type."""
    known = F.col("type").isin([s.record for s in LOG_FACTS])
    return (
        log.select(
            F.when(F.col("type").isNull(), "no type").when(~known, "unknown type").alias("reason")
        )
        .where(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count("*").alias("dropped"))
    )
