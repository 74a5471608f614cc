"""The driver tables in the shapes the warehouse reads.

Every mapping is row-local: shaping the tables costs no shuffle. Faults are planted
by fixed rules on the id, so that each quality branch occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.functions.unroll import once, unroll
from tonearm.operators.lookup import Dims
from tonearm.schemas import LOG_FIELDS

# Which log records an event stands for.
EVENT_RECORDS = {
    "view": ["play"],
    "click": ["collect", "singer_follow"],
    "purchase": ["search"],
    "error": ["comment"],
    "signup": ["login", "register"],
}
DAY_MS = 86_400_000
VIP_BASE_MS = 820_454_400_000  # 1996-01-01
LINES_A_FILE = 500_000
GENDER = "if(c_mktsegment IN ('BUILDING', 'MACHINERY'), 'M', 'F')"


# The driver tables' columns. Stated, so that no job has to infer them.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def dims(spark: SparkSession, sf_dir: str) -> Dims:
    user = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id",
        "c_name AS user_name",
        f"{GENDER} AS gender",
        f"CASE WHEN c_custkey % 10 <> 0 THEN {VIP_BASE_MS}L + c_custkey * 37 % 1900 * {DAY_MS}L END"
        " AS vip_end",
    )
    song = table(spark, sf_dir, "part").where("p_partkey % 25 <> 24").selectExpr(
        "p_partkey AS song_id",
        "p_name AS song_name",
        "p_partkey % 10 AS singer_id",
        "p_type AS song_type_id",
        "string(p_size) AS song_duration",
    )
    singer = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS singer_id",
        "s_name AS singer_name",
        "if(s_suppkey % 2 = 0, 'F', 'M') AS gender",
        "concat('N', s_nationkey) AS nationality",
    )
    province = table(spark, sf_dir, "nation").selectExpr(
        "bigint(n_nationkey) AS province_id", "n_name AS province_name"
    )
    return Dims.of(user, song, singer, province)


def log(spark: SparkSession, sf_dir: str, types: list[str] | None = None) -> DataFrame:
    """Log records from `events`; only the event kinds of the asked types are scanned."""
    return log_of(table(spark, sf_dir, "events"), types)


# The texts a log record is made of, from the columns of `events`.
EVENT_VALUES = {
    "id_text": "string(event_id)",
    "at": "unix_millis(timestamp(ts))",
    "k": "bigint(get_json_object(props, '$.k'))",
}
RECORD_VALUES = {
    "user": "CASE WHEN event_id % 89 = 0 THEN '-1' ELSE string(user_id) END",
    "song": "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'x'"
            " WHEN event_id % 103 = 0 THEN '1.7' ELSE string(k) END",
    "lead": "CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 79 = 0 THEN 'abc'"
            " WHEN event_id % 20 = 1 THEN string(k) ELSE string((k + 37) % 100) END",
    "province": "CASE WHEN event_id % 83 = 0 THEN '35' ELSE string(user_id % 25) END",
    "channel": "if(event_id % 2 = 0, 'APP', 'PC')",
    # Records reach the log up to six seconds late, one in 53 two days late.
    "arrival": f"at + if(event_id % 53 = 0, {2 * DAY_MS}L, event_id % 7 * 1000)",
}
# Which value each field of a record type takes, besides `user_id` and `channel`.
RECORD_FIELDS = {
    "play": {"play_id": "id_text", "song_id": "song", "lead_song_id": "lead",
             "start_ts": "string(at)"},
    "search": {"search_id": "id_text", "song_id": "song", "province_id": "province",
               "s_ts": "string(at)"},
    "collect": {"collect_id": "id_text", "song_id": "song", "c_ts": "string(at)"},
    "comment": {"comment_id": "id_text", "song_id": "song", "province_id": "province",
                "content": "concat('comment on ', k)", "comment_date": "string(at)"},
    "singer_follow": {"follow_id": "id_text", "singer_id": "string(k % 10)",
                      "c_ts": "string(at)"},
    "login": {"login_id": "id_text", "province_id": "province", "login_ts": "string(at)"},
    "register": {"register_id": "id_text", "province_id": "province",
                 "channel_ts": "string(at)"},
}


def _leaf(field: str, types: list[str]) -> str:
    """One field of `common` over the given record types."""
    if field == "user_id":
        return "user"
    if field == "channel":
        return "'inner'"
    by_value: dict[str, list[str]] = {}
    for t in types:
        if field in RECORD_FIELDS[t]:
            by_value.setdefault(RECORD_FIELDS[t][field], []).append(t)
    if not by_value:
        return "string(NULL)"
    if sum(len(ts) for ts in by_value.values()) == len(types) and len(by_value) == 1:
        return next(iter(by_value))
    cases = [
        "WHEN type IN (" + ", ".join(f"'{t}'" for t in ts) + f") THEN {value}"
        for value, ts in by_value.items()
    ]
    return "CASE " + " ".join(cases) + " END"


def log_of(events: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Log records of the given types."""
    kinds = {
        kind: [t for t in made if types is None or t in types]
        for kind, made in EVENT_RECORDS.items()
    }
    kinds = {kind: made for kind, made in kinds.items() if made}
    wanted = [t for made in kinds.values() for t in made]
    events = events.where(F.col("event_type").isin(list(kinds)))
    cases = " ".join(
        f"WHEN '{kind}' THEN array(" + ", ".join(f"'{t}'" for t in made) + ")"
        for kind, made in kinds.items()
    )
    one = len(wanted) == 1
    made = f"'{wanted[0]}'" if one else f"CASE event_type {cases} END"
    base = events.selectExpr(
        "event_id", "user_id", f"{made} AS made",
        *[f"{value} AS {name}" for name, value in EVENT_VALUES.items()],
    ).selectExpr(
        "event_id", "user_id", *EVENT_VALUES, "made AS type" if one else "explode(made) AS type"
    )
    values = base.selectExpr(
        "type", "user_id", "id_text", "at", "k",
        *[f"{value} AS {name}" for name, value in RECORD_VALUES.items()],
    )
    leaves = ", ".join(f"'{f}', {_leaf(f, wanted)}" for f in LOG_FIELDS)
    return once(values, {
        "common": f"named_struct({leaves})",
        "channel": "channel",
        "mac_id": "concat('m', user_id)",
        "type": "type",
        "ts": "arrival",
    })


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as JSON text, with lines that do not parse, lines without a type, lines whose
    `common` is no record, and lines with unknown fields and nulls."""
    return timed_log_lines(spark, sf_dir).select("value")


def timed_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the time of arrival, `at`."""
    text = "to_json(struct(common, channel, mac_id, type, ts))"
    return log_of(table(spark, sf_dir, "events")).selectExpr(
        "CASE WHEN ts % 71 = 0 THEN concat('not json ', mac_id)"
        " WHEN ts % 73 = 0 THEN to_json(struct(common, channel, mac_id, ts))"
        " WHEN ts % 67 = 0 THEN concat('{\"common\":\"oops\",\"type\":\"', type, '\",\"ts\":', ts, ',\"extra\":\"z\"}')"
        f" WHEN ts % 61 = 0 THEN concat('{{\"extra\":null,\"more\":{{\"a\":[1,2.50]}},', substring({text}, 2))"
        f" ELSE {text} END AS value",
        "ts AS at",
    )


def change_lines(changes: DataFrame) -> DataFrame:
    """A change feed as JSON texts, with the time of the change, `at`."""
    return changes.selectExpr("to_json(struct(*)) AS value", "ts_ms AS at")


def cuts_in_turn(
    lines: DataFrame, path: str, files: int = 3, bounds: list[int] | None = None, keep: bool = True
) -> Iterator[bool]:
    """Put texts (value, at) into a folder cut by cut, earlier ones first; tells of each whether
    it is the last. They are cut at `bounds`, or into `files` of like size. A cut has as many
    files as it has tasks, so a stream over the folder takes it as one micro-batch if it is run
    after each cut."""
    if bounds is None:
        marks = ", ".join(str(i / files) for i in range(1, files))
        bounds = lines.selectExpr(f"percentile_approx(at, array({marks})) AS b").first()["b"] or []
    ends = [None, *bounds, None]
    for i, (low, high) in enumerate(zip(ends, ends[1:])):
        part = lines
        if low is not None:
            part = part.where(F.col("at") >= low)
        if high is not None:
            part = part.where((F.col("at") < high) | F.col("at").isNull() & F.lit(low is None))
        writer = part.select("value").write.mode("append" if keep else "overwrite").option("maxRecordsPerFile", LINES_A_FILE)
        writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)
        yield i == len(bounds)


def _status(key: str, flag: str) -> str:
    return (f"CASE WHEN {key} % 113 = 0 THEN NULL WHEN {flag} = 'F' THEN '101'"
            f" WHEN {flag} = 'O' THEN '102' ELSE '103' END")


def _changes(rows: DataFrame, table_name: str, key: str, seconds: str, op: str,
             after: dict[str, str]) -> DataFrame:
    """Rows as change records of one table; a delete carries no row here."""
    image = ", ".join(f"'{name}', {value}" for name, value in after.items())
    return once(rows, {
        "op": op,
        "after": f"CASE WHEN {op} <> 'd' THEN named_struct({image}) END",
        "source": f"named_struct('db', 'music', 'table', '{table_name}', 'pos', {key})",
        "ts_ms": f"{seconds} * 1000",
    })


def vip_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vip_orders_of(table(spark, sf_dir, "orders"))


def vip_orders_of(o: DataFrame) -> DataFrame:
    seconds = "unix_seconds(timestamp(o_orderdate))"
    return _changes(
        o, "ods_vip_order", "o_orderkey", seconds, "if(o_orderkey % 50 = 0, 'd', 'r')",
        {
            "order_id": "string(o_orderkey)",
            "order_num": "'1'",
            "user_id": "if(o_orderkey % 97 = 0, NULL, string(o_custkey))",
            "amount": "if(o_orderkey % 101 = 0, 'x', string(floor(o_totalprice)))",
            "vip_type": "if(o_orderkey % 3 = 0, 'year', 'month')",
            "status_type_id": _status("o_orderkey", "o_orderstatus"),
            "pay_type": "o_orderpriority",
            "channel_id": "string(o_orderkey % 4)",
            "create_ts": f"string({seconds})",
        },
    )


def album_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = "unix_seconds(timestamp(l_shipdate))"
    return _changes(
        table(spark, sf_dir, "lineitem"),
        "ods_album_order", "l_orderkey", seconds, "if(l_orderkey % 50 = 0, 'd', 'r')",
        {
            "order_id": "string(l_orderkey)",
            "order_num": "string(floor(l_quantity))",
            "user_id": "if(l_orderkey % 97 = 0, NULL, string(l_orderkey div 10))",
            "album_id": "string(l_partkey)",
            "amount": "if(l_orderkey % 101 = 0, 'x', string(floor(l_extendedprice)))",
            "status_type_id": _status("l_orderkey", "l_linestatus"),
            "pay_type": "l_returnflag",
            "channel_id": "string(l_linenumber)",
            "create_ts": f"string({seconds})",
        },
    )


def cancelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = "unix_seconds(timestamp(o_orderdate))"
    return _changes(
        table(spark, sf_dir, "orders").where("o_orderstatus = 'P'"),
        "ods_cancel_order", "o_orderkey", seconds, "'r'",
        {
            "order_cancel_id": "if(o_orderkey % 97 = 0, 'n/a', string(o_orderkey + 40000))",
            "order_id": "string(o_orderkey)",
            "order_type": "string(o_orderkey % 2 + 1)",
            "cancel_reason": "o_orderpriority",
            "cancel_ts": f"string({seconds})",
            "status": "'103'",
        },
    )


USER_COLUMNS = ["user_id", "user_name", "gender", "vip_end"]


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source table of the user dimension as a full read finds it."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id", "c_name AS user_name", f"{GENDER} AS gender",
        "if(c_custkey % 10 <> 0, c_custkey * 1000, NULL) AS vip_end",
    )


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_changes_of(table(spark, sf_dir, "customer"))


def user_changes_of(customers: DataFrame) -> DataFrame:
    """A change feed of the user dimension: up to four changes per customer.

    Snapshot for all; an update that carries only the name (other columns null) for
    every third; a delete for every seventh; a return without gender for every 14th.
    A change of another table per fifth customer has to be routed away.
    """

    def image(name: str, sex: str, vip: str) -> str:
        # `nullif` makes every column nullable, as the images of one feed must be alike.
        return (f"named_struct('user_id', nullif(string(c_custkey), ''),"
                f" 'user_name', nullif({name}, ''), 'gender', nullif(string({sex}), ''),"
                f" 'vip_end', nullif(string({vip}), ''))")

    full = image("c_name", GENDER, "if(c_custkey % 10 <> 0, c_custkey * 1000, NULL)")
    renamed = image("concat(c_name, '-v2')", "NULL", "NULL")
    back = image("concat(c_name, '-back')", "NULL", "c_custkey * 2000")
    noise = image("'noise'", "'X'", "c_custkey")

    none = f"if(true, NULL, {full})"

    def event(step: int, op: str, table_name: str, before: str, after: str, every: int):
        return {
            "op": f"if(c_custkey % {every} = 0, '{op}', NULL)",
            "before": before,
            "after": after,
            "source": f"named_struct('db', 'music', 'table', '{table_name}',"
                      f" 'pos', c_custkey * 8 + {step})",
            "ts_ms": f"1700000000000L + {step}",
        }

    return unroll(customers, [], [
        event(1, "r", "ods_user", none, full, 1),
        event(2, "u", "ods_user", full, renamed, 3),
        event(3, "d", "ods_user", full, none, 7),
        event(4, "c", "ods_user", none, back, 14),
        event(5, "u", "ods_banner", none, noise, 5),
    ]).where("op IS NOT NULL")


def user_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension config with one row per nation; the first routes the user table."""
    return table(spark, sf_dir, "nation").selectExpr(
        "if(n_nationkey = 0, 'ods_user', concat('ods_', n_name)) AS source_table",
        "if(n_nationkey = 0, 'dim_user', concat('dim_', n_name)) AS sink_table",
        "'' AS sink_columns",
        "if(n_nationkey = 0, 'user_id', 'id') AS sink_row_key",
    )


def user_config_changes(spark: SparkSession, sf_dir: str, changed: bool = False) -> DataFrame:
    """The same config as its change feed: a row per nation, and perhaps a later change of the
    user table's, after which only its name is written."""
    config = user_config(spark, sf_dir)
    row = "named_struct('source_table', source_table, 'sink_table', sink_table, 'sink_columns', {},"
    row += " 'sink_family', 'info', 'sink_row_key', sink_row_key)"
    source = "named_struct('db', 'conf', 'table', 'dim_conf', 'pos', {}L) AS source"
    first = config.selectExpr(
        "'r' AS op", f"if(true, NULL, {row.format('sink_columns')}) AS before",
        f"{row.format('sink_columns')} AS after", source.format(1), "1000L AS ts_ms",
    )
    if not changed:
        return first
    later = config.where("sink_table = 'dim_user'").selectExpr(
        "'u' AS op", f"{row.format('sink_columns')} AS before",
        f"{row.format(chr(39) + 'user_id, user_name' + chr(39))} AS after", source.format(2), "2000L AS ts_ms",
    )
    return first.union(later)


def config_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A config change feed from `part`: 50 source tables, each changed many times."""
    row = ("named_struct('source_table', concat('ods_t', p_partkey % 50), 'sink_table',"
           " concat('dim_t', p_partkey % 50), 'sink_columns', p_name, 'sink_family', 'info',"
           " 'sink_row_key', 'id')")
    return table(spark, sf_dir, "part").selectExpr(
        "element_at(array('r', 'c', 'u', 'd'), p_size % 4 + 1) AS op",
        f"if(p_size % 4 = 3, {row}, NULL) AS before",
        f"if(p_size % 4 <> 3, {row}, NULL) AS after",
        "named_struct('db', 'conf', 'table', 'dim_conf', 'pos', p_partkey) AS source",
        "1700000000000L + p_partkey div 60 AS ts_ms",
    )
