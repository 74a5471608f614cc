"""The registered queries as plain SQL, written from the record rules."""

from __future__ import annotations

DAY_MS = 86_400_000

REC = f"""
ev AS (
  SELECT event_id, user_id, event_type, (epoch_us(ts) // 1000) AS t_ms,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
rec AS (
  SELECT t.type, event_id AS id, t_ms, k, user_id AS raw_user,
         CASE WHEN event_id % 89 = 0 THEN -1 ELSE user_id END AS user_id,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'x'
              WHEN event_id % 103 = 0 THEN '1.7' ELSE CAST(k AS VARCHAR) END AS song_text,
         CASE WHEN event_id % 10 = 0 OR event_id % 79 = 0 THEN NULL
              WHEN event_id % 20 = 1 THEN k ELSE (k + 37) % 100 END AS lead_song_id,
         CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 79 = 0 THEN 'abc'
              WHEN event_id % 20 = 1 THEN CAST(k AS VARCHAR)
              ELSE CAST((k + 37) % 100 AS VARCHAR) END AS lead_text,
         CAST(CASE WHEN event_id % 83 = 0 THEN 35 ELSE user_id % 25 END AS INTEGER) AS province_id,
         k % 10 AS singer_id,
         CASE WHEN event_id % 2 = 0 THEN 'APP' ELSE 'PC' END AS channel,
         t_ms + CASE WHEN event_id % 53 = 0 THEN {2 * DAY_MS} ELSE (event_id % 7) * 1000 END AS arrival
  FROM ev JOIN (VALUES ('view','play'), ('click','collect'), ('click','singer_follow'),
                       ('purchase','search'), ('error','comment'), ('signup','login'),
                       ('signup','register')) t(kind, type) ON event_type = kind),
judged AS (
  SELECT *,
    CASE WHEN song_text NOT IN ('x', '1.7') THEN CAST(song_text AS BIGINT) END AS song_id,
    CASE
      WHEN type IN ('play', 'search', 'collect', 'comment') THEN
        CASE WHEN song_text IN ('x', '1.7') THEN '2'
             WHEN user_id <= 0 THEN '1'
             WHEN song_text IS NULL THEN '2'
             WHEN song_text = '0' OR id <= 0 THEN '1'
             WHEN type IN ('search', 'comment') AND (province_id <= 0 OR province_id >= 35) THEN '1'
        END
      WHEN type = 'singer_follow' THEN
        CASE WHEN user_id <= 0 OR singer_id <= 0 OR id <= 0 THEN '1' END
      ELSE
        CASE WHEN user_id <= 0 OR id <= 0 OR province_id <= 0 OR province_id >= 35 THEN '1' END
    END AS dirty_type
  FROM (SELECT type, id, t_ms, k, raw_user, user_id,
               song_text, lead_song_id, lead_text, province_id, singer_id, channel, arrival
        FROM rec)),
clean AS (SELECT * FROM judged WHERE dirty_type IS NULL)"""

DIMS = """
d_user AS (
  SELECT c_custkey AS user_id, c_name AS user_name,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'M' ELSE 'F' END AS user_gender,
         CASE WHEN c_custkey % 10 <> 0
              THEN 820454400000 + (c_custkey * 37 % 1900) * 86400000 END AS vip_end_ms
  FROM customer),
d_singer AS (
  SELECT s_suppkey AS singer_id, s_name AS singer_name,
         CASE WHEN s_suppkey % 2 = 0 THEN 'F' ELSE 'M' END AS singer_gender,
         'N' || s_nationkey AS singer_nationality
  FROM supplier),
d_song AS (
  SELECT p_partkey AS song_id, p_name AS song_name, p_partkey % 10 AS singer_id,
         p_type AS song_type, CAST(p_size AS VARCHAR) AS song_duration
  FROM part WHERE p_partkey % 25 <> 24),
d_wide AS (SELECT * FROM d_song LEFT JOIN d_singer USING (singer_id)),
d_province AS (SELECT CAST(n_nationkey AS BIGINT) AS province_id, n_name AS province_name FROM nation)"""

HEAD = f"WITH {REC},{DIMS}"

USER = "u.user_name, u.user_gender"
SONG = "s.song_name, s.singer_id, s.song_type, s.song_duration"
SINGER = "s.singer_name, s.singer_gender, s.singer_nationality"
JOIN_USER = "LEFT JOIN d_user u ON u.user_id = c.user_id"
JOIN_SONG = "LEFT JOIN d_song s ON s.song_id = c.song_id"
JOIN_WIDE = "LEFT JOIN d_wide s ON s.song_id = c.song_id"
JOIN_PROVINCE = "LEFT JOIN d_province p ON p.province_id = c.province_id"


def time_text(us: str, pattern: str = "%Y-%m-%d %H:%M:%S") -> str:
    return f"strftime(make_timestamp(CAST({us} AS BIGINT)), '{pattern}')"


def fact(kind: str, columns: str, joins: str) -> str:
    return f"{HEAD} SELECT {columns}, c.channel FROM clean c {joins} WHERE c.type = '{kind}'"


PLAY = fact("play", f"""c.id AS play_id, c.song_id, c.user_id, c.lead_song_id, c.t_ms AS start_ts,
  {SONG}, {SINGER}, {USER},
  coalesce(l.song_name, '') AS lead_song_name,
  coalesce(CAST(l.singer_id AS VARCHAR), '') AS lead_singer_id,
  coalesce(l.song_type, '') AS lead_song_type,
  coalesce(l.song_duration, '') AS lead_song_duration,
  coalesce(l.singer_name, '') AS lead_singer_name,
  coalesce(l.singer_gender, '') AS lead_singer_gender,
  coalesce(l.singer_nationality, '') AS lead_singer_nationality""",
  f"{JOIN_WIDE} LEFT JOIN d_wide l ON l.song_id = c.lead_song_id {JOIN_USER}")
SEARCH = fact("search", f"""c.id AS search_id, c.song_id, c.user_id, c.province_id, c.t_ms AS s_ts,
  {USER}, p.province_name, {SONG}, {SINGER}""", f"{JOIN_USER} {JOIN_PROVINCE} {JOIN_WIDE}")
COLLECT = fact("collect", f"c.id AS collect_id, c.song_id, c.user_id, c.t_ms AS c_ts, {USER}, {SONG}",
               f"{JOIN_USER} {JOIN_SONG}")
COMMENT = fact("comment", f"""c.id AS comment_id, c.song_id, c.user_id, 'comment on ' || c.k AS content,
  c.province_id, c.t_ms AS comment_date, {USER}, p.province_name, {SONG}""",
  f"{JOIN_USER} {JOIN_PROVINCE} {JOIN_SONG}")
FOLLOW = fact("singer_follow", f"""c.id AS follow_id, c.singer_id, c.user_id, c.t_ms AS c_ts, {USER},
  {SINGER}""", f"{JOIN_USER} LEFT JOIN d_singer s ON s.singer_id = c.singer_id")
LOGIN = fact("login", f"""c.id AS login_id, c.user_id, c.province_id, c.t_ms AS login_ts, {USER},
  p.province_name""", f"{JOIN_USER} {JOIN_PROVINCE}")
REGISTER = fact("register", f"""c.id AS register_id, c.user_id, c.province_id, c.t_ms AS channel_ts,
  {USER}, p.province_name""", f"{JOIN_USER} {JOIN_PROVINCE}")


def _pair(name: str, value: str, when: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {when} THEN '\"{name}\":\"' || {text} || '\"' END"


def _type(*kinds: str) -> str:
    return "type IN (" + ", ".join(f"'{k}'" for k in kinds) + ")"


RECORD = (
    "'{\"common\":{' || concat_ws(',', "
    + ", ".join([
        _pair("play_id", "id", _type("play")),
        _pair("search_id", "id", _type("search")),
        _pair("collect_id", "id", _type("collect")),
        _pair("comment_id", "id", _type("comment")),
        _pair("follow_id", "id", _type("singer_follow")),
        _pair("login_id", "id", _type("login")),
        _pair("register_id", "id", _type("register")),
        _pair("user_id", "user_id", "true"),
        _pair("song_id", "song_text",
              _type("play", "search", "collect", "comment") + " AND song_text IS NOT NULL"),
        _pair("singer_id", "singer_id", _type("singer_follow")),
        _pair("lead_song_id", "lead_text", _type("play") + " AND lead_text IS NOT NULL"),
        _pair("province_id", "province_id", _type("search", "comment", "login", "register")),
        "'\"channel\":\"inner\"'",
        _pair("content", "'comment on ' || k", _type("comment")),
        _pair("start_ts", "t_ms", _type("play")),
        _pair("s_ts", "t_ms", _type("search")),
        _pair("c_ts", "t_ms", _type("collect", "singer_follow")),
        _pair("comment_date", "t_ms", _type("comment")),
        _pair("login_ts", "t_ms", _type("login")),
        _pair("channel_ts", "t_ms", _type("register")),
    ])
    + ") || '},\"channel\":\"' || channel || '\",\"mac_id\":\"m' || raw_user || "
    "'\",\"type\":\"' || type || '\",\"ts\":' || arrival || '}'"
)

# Lines of the log as text: some are no JSON or have no type, some have no `common`, some
# carry fields that nobody knows.
LINE = "arrival % 71 <> 0 AND arrival % 73 <> 0"
LINE_VERDICT = "CASE WHEN arrival % 67 = 0 THEN '2' ELSE dirty_type END"
LINE_TEXT = f"""CASE
  WHEN arrival % 67 = 0 THEN '{{"common":"oops","type":"' || type || '","ts":' || arrival || ',"extra":"z"}}'
  WHEN arrival % 61 = 0 THEN '{{"extra":null,"more":{{"a":[1,2.50]}},' || substr({RECORD}, 2)
  ELSE {RECORD} END"""
DIRTY = f"""{HEAD} SELECT 'dwd_' || type AS fact, {LINE_VERDICT} AS dirty_type, {LINE_TEXT} AS record,
  arrival AS ts
FROM judged WHERE {LINE} AND {LINE_VERDICT} IS NOT NULL"""


def of_lines(sql: str) -> str:
    """A fact's SQL limited to the records that are lines with a `common`."""
    return f"{sql} AND {LINE} AND arrival % 67 <> 0"


def trade(source: str, key: str, user: str, amount: str, flag: str, rest: str) -> str:
    """Clean orders of the kept status with their user; `rest` are further columns."""
    return f"""WITH {DIMS}, o AS (
  SELECT *, {key} AS order_id, CAST(floor({amount}) AS BIGINT) AS money, {user} AS buyer
  FROM {source}
  WHERE {key} % 50 <> 0 AND {key} % 97 <> 0 AND {key} % 101 <> 0 AND {key} % 113 <> 0
    AND {flag} = 'F' AND {key} > 0 AND {user} > 0 AND floor({amount}) > 0)
SELECT {rest} FROM o LEFT JOIN d_user u ON u.user_id = o.buyer"""


def seconds(column: str) -> str:
    return f"epoch_ms({column}) // 1000"


VIP_COLUMNS = f"""o.buyer AS user_id, o.order_id, CAST(1 AS BIGINT) AS order_num, o.money AS amount,
  '101' AS status_type_id, o.o_orderpriority AS pay_type,
  CASE WHEN o.order_id % 3 = 0 THEN 'year' ELSE 'month' END AS vip_type,
  o.order_id % 4 AS channel_id, {seconds('o.o_orderdate')} AS create_ts,
  strftime(o.o_orderdate, '%Y%m%d') AS dt, u.user_name, u.user_gender,
  coalesce(u.vip_end_ms // 1000, 0) AS vip_end"""
VIP = trade("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", VIP_COLUMNS)
ALBUM = trade("lineitem", "l_orderkey", "l_orderkey // 10", "l_extendedprice", "l_linestatus", f"""
  o.buyer AS user_id, o.order_id, CAST(floor(o.l_quantity) AS BIGINT) AS order_num,
  o.money AS amount, '101' AS status_type_id, o.l_returnflag AS pay_type,
  CAST(o.l_partkey AS VARCHAR) AS album_id, CAST(o.l_linenumber AS BIGINT) AS channel_id,
  {seconds('o.l_shipdate')} AS create_ts, strftime(o.l_shipdate, '%Y%m%d') AS dt,
  u.user_name, u.user_gender""")
CANCEL = f"""SELECT o_orderkey + 40000 AS order_cancel_id, o_orderkey AS order_id,
  o_orderkey % 2 + 1 AS order_type, o_orderpriority AS cancel_reason,
  {seconds('o_orderdate')} AS cancel_ts, '103' AS status, strftime(o_orderdate, '%Y%m%d') AS dt
FROM orders WHERE o_orderstatus = 'P' AND o_orderkey > 0 AND o_orderkey % 97 <> 0"""

TRADE_VERDICT = """CASE WHEN {key} % 101 = 0 THEN '2' WHEN {key} % 97 = 0 THEN '2'
  WHEN {user} <= 0 OR {key} <= 0 OR floor({amount}) <= 0 OR {key} % 113 = 0 THEN '1' END"""


def _field(name: str, value: str, when: str = "true") -> str:
    return f"CASE WHEN {when} THEN length('\"{name}\":\"' || {value} || '\"') END"


def _length(*fields: str) -> str:
    """Length of a JSON object of the fields that are there: braces, fields, commas."""
    there = " + ".join(f"coalesce({f} + 1, 0)" for f in fields)
    return f"CAST({there} + 1 AS INTEGER)"


def trade_dirty(name: str, source: str, key: str, user: str, amount: str, flag: str, at: str, fields: list) -> str:
    verdict = TRADE_VERDICT.format(key=key, user=user, amount=amount)
    status = f"CASE {flag} WHEN 'F' THEN '101' WHEN 'O' THEN '102' ELSE '103' END"
    money = f"CASE WHEN {key} % 101 = 0 THEN 'x' ELSE CAST(CAST(floor({amount}) AS BIGINT) AS VARCHAR) END"
    length = _length(
        _field("order_id", key), _field("user_id", user, f"{key} % 97 <> 0"), _field("amount", money),
        _field("status_type_id", status, f"{key} % 113 <> 0"), _field("create_ts", seconds(at)), *fields,
    )
    return f"""SELECT '{name}' AS fact, {key} AS order_id, {verdict} AS dirty_type, {seconds(at)} * 1000 AS ts,
  CASE WHEN {key} % 97 <> 0 THEN CAST({user} AS VARCHAR) END AS user_id, {money} AS amount,
  CASE WHEN {key} % 113 <> 0 THEN {status} END AS status_type_id, {length} AS text_length
FROM {source} WHERE {key} % 50 <> 0 AND {verdict} IS NOT NULL"""


TRADE_DIRTY = (
    trade_dirty("dwd_trade_vip", "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate", [
        _field("order_num", "'1'"), _field("vip_type", "CASE WHEN o_orderkey % 3 = 0 THEN 'year' ELSE 'month' END"),
        _field("pay_type", "o_orderpriority"), _field("channel_id", "o_orderkey % 4"),
    ])
    + " UNION ALL "
    + trade_dirty("dwd_trade_album", "lineitem", "l_orderkey", "l_orderkey // 10", "l_extendedprice", "l_linestatus", "l_shipdate", [
        _field("order_num", "CAST(floor(l_quantity) AS BIGINT)"), _field("album_id", "l_partkey"),
        _field("pay_type", "l_returnflag"), _field("channel_id", "l_linenumber"),
    ])
    + f""" UNION ALL SELECT 'dwd_trade_cancel', o_orderkey,
  CASE WHEN o_orderkey % 97 = 0 THEN '2' ELSE '1' END, {seconds('o_orderdate')} * 1000, NULL, NULL, NULL, """
    + _length(
        _field("order_cancel_id", "CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(o_orderkey + 40000 AS VARCHAR) END"),
        _field("order_id", "o_orderkey"), _field("order_type", "o_orderkey % 2 + 1"), _field("cancel_reason", "o_orderpriority"),
        _field("cancel_ts", seconds("o_orderdate")), _field("status", "'103'"),
    )
    + """ FROM orders WHERE o_orderstatus = 'P' AND (o_orderkey % 97 = 0 OR o_orderkey <= 0)"""
)

ALBUM_SALES = f"""SELECT album_id, dt, count(order_num) AS sales, CAST(sum(amount) AS BIGINT) AS amount
FROM ({ALBUM}) GROUP BY album_id, dt"""
RENEWAL = f"""SELECT dt, CAST(sum(CASE WHEN abs(create_ts - vip_end) < 259200 THEN 1 ELSE 0 END) AS DOUBLE)
  / count(*) AS renew_rate FROM ({VIP}) GROUP BY dt"""
RENEWAL_LITERAL = f"""SELECT dt, CAST(count(CASE WHEN abs(create_ts - vip_end) < 259200 THEN 1 ELSE 0 END)
  AS DOUBLE) / count(*) AS renew_rate FROM ({VIP}) GROUP BY dt"""
ALBUM_MESSAGE = f"""SELECT '{{"album_id":"' || album_id || '","sales":' || sales || ',"amount":' || amount
  || ',"dt":"' || dt || '"}}' AS value FROM ({ALBUM_SALES})"""


def windows(
    kind: str, key: str, panes: int, measure: str, closed: bool = False, last: str | None = None,
    at: str = "t_ms", source: str = "clean",
) -> str:
    """Intervals of equal count by counting at every point where it may change; all of them, or
    those up to `last` or up to what the watermark of the last record has closed. Rows of
    `source` count from their time `at`."""
    if closed:
        last = f"(SELECT (max(t_ms) - 3000) // 5000 FROM clean WHERE type = '{kind}')"
    last = last or "t_"
    head = HEAD if source == "clean" else source
    rows = "clean" if source == "clean" else "stamped"
    return f"""{head},
e AS (SELECT {key} AS k_, user_id AS m_, {at} // 5000 + 1 AS i_ FROM {rows} WHERE type = '{kind}'),
pts AS (SELECT k_, i_ AS w_ FROM e UNION SELECT k_, i_ + {panes} FROM e
        UNION SELECT k_, (i_ // {panes} + 1) * {panes} FROM e),
cnt AS (SELECT p.k_, p.w_, {measure} AS n_ FROM pts p
        LEFT JOIN e ON e.k_ = p.k_ AND e.i_ <= p.w_ AND e.i_ > p.w_ - {panes} GROUP BY p.k_, p.w_),
kept AS (SELECT * FROM (SELECT *, lag(n_) OVER (PARTITION BY k_, w_ // {panes} ORDER BY w_) AS b_
         FROM cnt) WHERE b_ IS NULL OR b_ <> n_),
runs AS (SELECT k_, n_, w_ AS f_,
         coalesce(lead(w_) OVER (PARTITION BY k_, w_ // {panes} ORDER BY w_),
                  (w_ // {panes} + 1) * {panes}) - 1 AS t_ FROM kept),
spans AS (SELECT k_, n_, {time_text('f_ * 5000000')} AS first_window_end,
          {time_text('e_ * 5000000')} AS last_window_end, e_ - f_ + 1 AS windows,
          {time_text('f_ * 5000000', '%Y-%m-%d')} AS d_
          FROM (SELECT *, least(t_, {last}) AS e_ FROM runs) WHERE n_ > 0 AND f_ <= e_)
"""


SPAN = "first_window_end, last_window_end, windows"
SONG_SEARCH = windows("search", "song_id", 17280, "count(e.i_)") + f"""
SELECT k_ AS song_id, n_ AS search_count, {SPAN}, d_ AS partition_time, s.song_name, s.singer_id,
  s.singer_name FROM spans LEFT JOIN d_wide s ON s.song_id = k_"""
SONG_COLLECT = windows("collect", "song_id", 17280, "count(e.i_)") + f"""
SELECT k_ AS song_id, n_ AS collect_count, {SPAN}, d_ AS partition_date, {SONG}
FROM spans LEFT JOIN d_song s ON s.song_id = k_"""
SINGER_FOLLOW = windows("singer_follow", "singer_id", 17280, "count(e.i_)") + f"""
SELECT k_ AS singer_id, n_ AS follow_count, {SPAN}, d_ AS partition_date, {SINGER}
FROM spans LEFT JOIN d_singer s ON s.singer_id = k_"""
PROVINCE_ACTIVE = windows("login", "province_id", 720, "count(DISTINCT e.m_)") + f"""
SELECT k_ AS province_id, n_ AS active_user_count, {SPAN}, d_ AS partition_date, p.province_name
FROM spans LEFT JOIN d_province p ON p.province_id = k_"""



def emitted(kind: str, key: str, panes: int, measure: str, count: str) -> str:
    """What a summary stream has emitted once all records are in."""
    spans = windows(kind, key, panes, measure, closed=True)
    return f"{spans} SELECT k_ AS {key}, n_ AS {count}, {SPAN}, d_ AS partition_date FROM spans"


SEARCH_EMITTED = emitted("search", "song_id", 17280, "count(e.i_)", "search_count")
COLLECT_EMITTED = emitted("collect", "song_id", 17280, "count(e.i_)", "collect_count")
FOLLOW_EMITTED = emitted("singer_follow", "singer_id", 17280, "count(e.i_)", "follow_count")
ACTIVE_EMITTED = emitted("login", "province_id", 720, "count(DISTINCT e.m_)", "active_user_count")

ONLINE_CTE = f"""{HEAD},
moves AS (SELECT song_id, user_id, t_ms, id, 0 AS seq FROM clean WHERE type = 'play'
          UNION ALL SELECT lead_song_id, user_id, t_ms, id, 1 FROM clean
          WHERE type = 'play' AND lead_song_id IS NOT NULL),
last AS (SELECT song_id, user_id, seq,
         row_number() OVER (PARTITION BY song_id, user_id ORDER BY t_ms DESC, id DESC, seq DESC) AS rn
         FROM moves),
online AS (SELECT song_id, count(*) FILTER (WHERE seq = 0) AS current_online_count
           FROM last WHERE rn = 1 GROUP BY song_id)
"""
ONLINE = ONLINE_CTE + """SELECT o.song_id, current_online_count, s.song_name, s.singer_name
FROM online o LEFT JOIN d_wide s ON s.song_id = o.song_id"""
TOP10 = ONLINE_CTE + """, best AS (SELECT *, CAST(row_number() OVER
  (ORDER BY current_online_count DESC, song_id) AS INTEGER) AS rank FROM online)
SELECT o.song_id, current_online_count, rank, s.song_name, s.singer_name
FROM best o LEFT JOIN d_wide s ON s.song_id = o.song_id WHERE rank <= 10"""
PRESENCE_CHANGES = ONLINE_CTE + """SELECT song_id, user_id, t_ms AS ts, id AS play_id, seq FROM moves"""

DIRTY_HOUR = f"""{HEAD},
p AS (SELECT 'dwd_' || type AS fact, arrival // 60000 + 1 AS i_, dirty_type FROM judged),
w AS (SELECT fact, dirty_type, i_ + g.n AS w_ FROM p, generate_series(0, 59) g(n)),
t AS (SELECT fact, w_, count(*) AS total_count FROM w GROUP BY ALL),
d AS (SELECT fact, w_, dirty_type, count(*) AS dirty_count FROM w
      WHERE dirty_type IS NOT NULL GROUP BY ALL)
SELECT {time_text('(w_ - 60) * 60000000')} AS window_start, {time_text('w_ * 60000000')} AS window_end,
  fact, dirty_type, dirty_count, total_count, CAST(dirty_count AS DOUBLE) / total_count AS dirty_share
FROM d JOIN t USING (fact, w_)"""

LATE = f"""{HEAD} SELECT id AS collect_id, song_id, t_ms AS c_ts,
  (t_ms // 5000 + 17280) * 5000 + 23000 <= 1705708800000 AS is_late FROM clean WHERE type = 'collect'"""

USER_CURRENT = """SELECT c_custkey AS user_id,
  c_name || CASE WHEN c_custkey % 14 = 0 THEN '-back' WHEN c_custkey % 3 = 0 THEN '-v2' ELSE '' END
    AS user_name,
  CASE WHEN c_custkey % 14 = 0 THEN NULL
       WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'M' ELSE 'F' END AS gender,
  CASE WHEN c_custkey % 14 = 0 THEN c_custkey * 2000
       WHEN c_custkey % 10 <> 0 THEN c_custkey * 1000 END AS vip_end
FROM customer WHERE c_custkey % 7 <> 0 OR c_custkey % 14 = 0"""
STREAM_FACTS = f"""{HEAD}
SELECT 'dwd_' || c.type AS output, c.id, c.user_id, u.user_name, CAST(NULL AS VARCHAR) AS dirty_type,
  CAST(NULL AS VARCHAR) AS record
FROM clean c {JOIN_USER} WHERE {LINE} AND arrival % 67 <> 0
UNION ALL SELECT 'dirty dwd_' || type, NULL, NULL, NULL, {LINE_VERDICT}, {LINE_TEXT}
FROM judged WHERE {LINE} AND {LINE_VERDICT} IS NOT NULL"""
USER_RECONFIGURED = """SELECT c_custkey AS user_id,
  c_name || CASE WHEN c_custkey % 14 = 0 THEN '-back' ELSE '-v2' END AS user_name,
  CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS BIGINT) AS vip_end
FROM customer WHERE c_custkey % 14 = 0 OR (c_custkey % 3 = 0 AND c_custkey % 7 <> 0)"""
USER_ROUTED = """SELECT 'dim_user' AS sink_table, 'user_id' || c_custkey AS row_key, op,
  c_custkey * 8 + step AS pos,
  c_name || CASE WHEN step = 2 THEN '-v2' WHEN step = 4 THEN '-back' ELSE '' END AS user_name
FROM customer, (VALUES (1, 'r', 1), (2, 'u', 3), (3, 'd', 7), (4, 'c', 14)) v(step, op, every)
WHERE c_custkey % every = 0"""
CHANGES_PARSED = """SELECT op, 1700000000000 + step AS ts_ms, source_table,
  c_custkey * 8 + step AS pos, c_custkey AS user_id,
  CASE step WHEN 5 THEN 'noise' WHEN 2 THEN c_name || '-v2' WHEN 4 THEN c_name || '-back'
    ELSE c_name END AS user_name
FROM customer, (VALUES (1, 'r', 1, 'ods_user'), (2, 'u', 3, 'ods_user'), (3, 'd', 7, 'ods_user'),
  (4, 'c', 14, 'ods_user'), (5, 'u', 5, 'ods_banner')) v(step, op, every, source_table)
WHERE c_custkey % every = 0"""
CANCEL_STORED = f"SELECT *, substr(dt, 1, 6) AS month FROM ({CANCEL})"
CANCEL_MONTHS = f"{CANCEL_STORED} WHERE substr(dt, 1, 4) IN ('1996', '1997', '1998')"
CONFIG_CURRENT = """SELECT source_table, replace(source_table, 'ods', 'dim') AS sink_table,
  p_name AS sink_columns, 'info' AS sink_family, 'id' AS sink_row_key
FROM (SELECT 'ods_t' || (p_partkey % 50) AS source_table, p_name, p_size,
      row_number() OVER (PARTITION BY p_partkey % 50 ORDER BY p_partkey // 60 DESC, p_partkey DESC) AS rn
      FROM part) WHERE rn = 1 AND p_size % 4 <> 3"""
CONFIG_LIFECYCLE = """SELECT 'dim_t' || (p_partkey % 50) AS sink_table, p_partkey AS pos,
  1700000000000 + p_partkey // 60 AS ts_ms,
  CASE p_size % 4 WHEN 2 THEN 'recreate' WHEN 3 THEN 'drop' ELSE 'create' END AS action FROM part"""

LOG_PARSED = f"""{HEAD}
SELECT type, CASE WHEN arrival % 67 <> 0 THEN channel END AS channel,
  CASE WHEN arrival % 67 <> 0 THEN 'm' || raw_user END AS mac_id, arrival AS ts,
  CASE WHEN arrival % 67 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN arrival % 67 <> 0 AND {_type('play', 'search', 'collect', 'comment')} THEN song_text END AS song_id
FROM rec WHERE {LINE}"""
LOG_DROPPED = f"""{HEAD} SELECT 'no type' AS reason, count(*) AS dropped FROM rec
WHERE arrival % 71 = 0 OR arrival % 73 = 0"""
RAW_FIELDS = f"""{HEAD}, parts AS (
  SELECT type, unnest([
    CASE type WHEN 'singer_follow' THEN 'follow_id' ELSE type || '_id' END, 'user_id', 'channel',
    CASE WHEN {_type('play', 'search', 'collect', 'comment')} AND song_text IS NOT NULL THEN 'song_id' END,
    CASE WHEN type = 'play' AND lead_text IS NOT NULL THEN 'lead_song_id' END,
    CASE WHEN type = 'singer_follow' THEN 'singer_id' END,
    CASE WHEN {_type('search', 'comment', 'login', 'register')} THEN 'province_id' END,
    CASE WHEN type = 'comment' THEN 'content' END,
    CASE type WHEN 'play' THEN 'start_ts' WHEN 'search' THEN 's_ts' WHEN 'comment' THEN 'comment_date'
              WHEN 'login' THEN 'login_ts' WHEN 'register' THEN 'channel_ts' ELSE 'c_ts' END
    ]) AS field
  FROM rec WHERE {LINE} AND arrival % 67 <> 0)
SELECT type, field, count(*) AS records FROM parts WHERE field IS NOT NULL GROUP BY type, field"""
TIME_FORMATS = f"""SELECT event_id, {time_text('epoch_us(ts)', '%Y-%m-%d')} AS day,
  {time_text('epoch_us(ts)')} AS moment, {time_text('epoch_us(ts)', '%Y%m%d')} AS partition_day,
  (epoch_us(ts) // 1000) // 1000 * 1000 AS moment_ms, (epoch_us(ts) // 1000) // {DAY_MS} * {DAY_MS} AS day_ms,
  ((epoch_us(ts) // 1000) // 5000 + 1) * 5000 AS next_tick_ms, (epoch_us(ts) // 1000) // 1000 AS seconds,
  'event_id' || event_id AS row_key FROM events"""
SEARCHES = f"{HEAD} SELECT song_id, count(*) AS search_count FROM clean WHERE type = 'search' GROUP BY song_id"
WINDOW_AT = f"""{HEAD} SELECT song_id, count(*) AS collect_count FROM clean
WHERE type = 'collect' AND t_ms >= 1705276800000 AND t_ms < 1705363200000 GROUP BY song_id"""

DIRTY_HOUR_CLOSED = f"""SELECT * FROM ({DIRTY_HOUR}) WHERE window_end <= (
  SELECT {time_text("(max((epoch_us(ts) // 1000) + CASE WHEN event_id % 53 = 0 THEN 172800000"
                    " ELSE (event_id % 7) * 1000 END) - 3000) * 1000")} FROM events)"""

ORACLES: dict[str, str] = {
    "stream_dwd_facts": STREAM_FACTS,
    "stream_dwd_play": of_lines(PLAY),
    "stream_dwd_search": of_lines(SEARCH),
    "stream_dwd_dirty": DIRTY,
    "stream_dwd_trade_album": ALBUM,
    "stream_dwd_trade_cancel": CANCEL,
    "stream_dwd_trade_vip": VIP,
    "stream_song_online": ONLINE,
    "stream_song_collect_24h": SONG_COLLECT,
    "stream_province_active_1h": PROVINCE_ACTIVE,
    "stream_song_collect_at": WINDOW_AT,
    "stream_song_search_arrivals": SEARCHES,
    "stream_dwd_trade_cancel_olap": CANCEL,
    "stream_song_search_windows": SEARCH_EMITTED,
    "stream_song_collect_windows": COLLECT_EMITTED,
    "stream_singer_follow_windows": FOLLOW_EMITTED,
    "stream_province_active_windows": ACTIVE_EMITTED,
    "stream_dirty_1h": DIRTY_HOUR_CLOSED,
    "stream_dim_user": USER_CURRENT,
    "stream_dim_user_reconfigured": USER_RECONFIGURED,
    "ads_song_online_top10": TOP10,
    "dws_song_online": ONLINE,
    "dws_presence_changes": PRESENCE_CHANGES,
    "dwd_play": PLAY,
    "dwd_search": SEARCH,
    "dwd_collect": COLLECT,
    "dwd_comment": COMMENT,
    "dwd_singer_follow": FOLLOW,
    "dwd_login": LOGIN,
    "dwd_register": REGISTER,
    "dwd_dirty_records": DIRTY,
    "dwd_trade_vip": VIP,
    "dwd_trade_album": ALBUM,
    "dwd_trade_cancel": CANCEL,
    "dwd_trade_dirty": TRADE_DIRTY,
    "dws_album_sales": ALBUM_SALES,
    "dws_album_sales_message": ALBUM_MESSAGE,
    "dws_vip_renewal_rate": RENEWAL,
    "dws_vip_renewal_rate_literal": RENEWAL_LITERAL,
    "dws_song_search_24h": SONG_SEARCH,
    "dws_song_collect_24h": SONG_COLLECT,
    "dws_song_collect_at": WINDOW_AT,
    "dws_singer_follow_24h": SINGER_FOLLOW,
    "dws_province_active_1h": PROVINCE_ACTIVE,
    "dws_dirty_1h": DIRTY_HOUR,
    "late_split": LATE,
    "ods_changes_parsed": CHANGES_PARSED,
    "dwd_trade_cancel_stored": CANCEL_STORED,
    "dwd_trade_cancel_months": CANCEL_MONTHS,
    "dws_album_sales_exported": ALBUM_SALES,
    "dwd_play_of_lines": of_lines(PLAY),
    "dwd_search_of_lines": of_lines(SEARCH),
    "dwd_collect_of_lines": of_lines(COLLECT),
    "dwd_comment_of_lines": of_lines(COMMENT),
    "dwd_singer_follow_of_lines": of_lines(FOLLOW),
    "dwd_login_of_lines": of_lines(LOGIN),
    "dwd_register_of_lines": of_lines(REGISTER),
    "dim_user_current": USER_CURRENT,
    "dim_user_merged": USER_CURRENT,
    "dim_user_of_snapshot": USER_CURRENT,
    "dim_changes_routed": USER_ROUTED,
    "dim_config_current": CONFIG_CURRENT,
    "dim_config_lifecycle": CONFIG_LIFECYCLE,
    "ods_log_parsed": LOG_PARSED,
    "ods_log_dropped": LOG_DROPPED,
    "ods_log_raw_fields": RAW_FIELDS,
    "scalar_time_formats": TIME_FORMATS,
}
