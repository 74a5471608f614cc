"""The stream queries that depend on the order of arrival, as plain SQL.

Their input is cut into micro-batches by the time of arrival, at equal steps between the
first and the last, which the SQL repeats.
"""

from __future__ import annotations

from tonearm.plans.oracle_sql import (
    COLLECT, COMMENT, DAY_MS, FOLLOW, HEAD, LOGIN, ONLINE, REGISTER, SEARCH, SPAN, USER_CURRENT, of_lines, time_text, windows,
)

CUTS = 6
DIM_CUTS = 4
#: The clock of the arrival windows: the first reading, and how far apart batches are.
CLOCK_START_MS, CLOCK_STEP_MS = 1_717_200_003_000, 7 * 3_600_000
PANES = 17_280


def in_cuts(kind: str, cuts: int = CUTS, bounds: list[str] | None = None) -> str:
    """`mine`: the rows of one record type with the number `b` of their batch."""
    bounds = bounds or [f"lo_ + (hi_ - lo_) * {i} // {cuts}" for i in range(1, cuts)]
    batch = " + ".join(f"CAST(c.arrival >= {b} AS INTEGER)" for b in bounds)
    return f"""{HEAD},
cut AS (SELECT min(arrival) AS lo_, max(arrival) AS hi_, greatest(lo_, hi_ - {2 * DAY_MS}) AS on_ FROM rec WHERE type = '{kind}'),
mine AS (SELECT c.*, CAST({batch} AS BIGINT) AS b FROM clean c, cut WHERE type = '{kind}')"""


#: The last two days bring only records that are two days late; half the cuts lie there.
LATE_CUTS = [
    "lo_ + (on_ - lo_) // 3", "lo_ + (on_ - lo_) * 2 // 3", "on_", f"on_ + {DAY_MS // 4}", f"on_ + {DAY_MS // 2}",
]


# A row is late if Spark's watermark for it, set by the batch before last, has passed its windows.
JUDGED = f"""{in_cuts("collect", bounds=LATE_CUTS)},
high AS (SELECT g.b, (SELECT max(t_ms) FROM mine m WHERE m.b <= g.b - 2) AS w_ FROM range(0, {CUTS}) g(b)),
told AS (SELECT mine.*, coalesce((t_ms // 5000 + {PANES}) * 5000 + 23000 <= w_, false) AS late
         FROM mine JOIN high USING (b))"""
LATE_ROWS = f"""{JUDGED}
SELECT id AS collect_id, song_id, user_id, t_ms AS c_ts, channel, b AS batch_id FROM told WHERE late"""
# Each batch emits the windows that it closes and the last four again; a window is as the last
# batch that emitted it had it.
CORRECTED = f"""{JUDGED},
tops AS (SELECT g.b, (SELECT max(t_ms) FROM told m WHERE m.b <= g.b) AS top_ FROM range(0, {CUTS}) g(b)),
bounds AS (SELECT b, (top_ - 3000) // 5000 AS closed_,
           coalesce(lag((top_ - 3000) // 5000) OVER (ORDER BY b) - 3, (SELECT min(t_ms // 5000 + 1) FROM told WHERE b = 0)) AS low_
           FROM tops),
own AS (SELECT b, low_, least(closed_, coalesce(lead(low_) OVER (ORDER BY b) - 1, closed_)) AS until_ FROM bounds),
e AS (SELECT song_id AS k_, t_ms // 5000 + 1 AS i_, own.b, low_, until_ FROM told JOIN own ON told.b <= own.b WHERE NOT late),
pts AS (SELECT DISTINCT k_, b, low_, until_, w_ FROM (
          SELECT *, i_ AS w_ FROM e UNION ALL SELECT *, i_ + {PANES} FROM e UNION ALL SELECT *, low_ FROM e
          UNION ALL SELECT *, (i_ // {PANES} + 1) * {PANES} FROM e) WHERE w_ BETWEEN low_ AND until_),
cnt AS (SELECT p.k_, p.b, p.until_, p.w_, count(e.i_) AS n_ FROM pts p
        LEFT JOIN e ON e.k_ = p.k_ AND e.b = p.b AND e.i_ <= p.w_ AND e.i_ > p.w_ - {PANES} GROUP BY ALL),
runs AS (SELECT k_, n_, w_ AS f_, least(until_,
           coalesce(lead(w_) OVER (PARTITION BY k_, b, w_ // {PANES} ORDER BY w_), (w_ // {PANES} + 1) * {PANES}) - 1) AS t_ FROM cnt),
marked AS (SELECT *, f_ // {PANES} AS c_, CASE WHEN lag(t_) OVER o + 1 = f_ AND lag(n_) OVER o = n_ THEN 0 ELSE 1 END AS new_
           FROM runs WHERE n_ > 0 WINDOW o AS (PARTITION BY k_, f_ // {PANES} ORDER BY f_)),
islands AS (SELECT *, sum(new_) OVER (PARTITION BY k_, c_ ORDER BY f_) AS island_ FROM marked),
spans AS (SELECT k_, n_, min(f_) AS f_, max(t_) AS t_ FROM islands GROUP BY k_, c_, island_, n_)
SELECT k_ AS song_id, n_ AS collect_count, {time_text('f_ * 5000000')} AS first_window_end,
  {time_text('t_ * 5000000')} AS last_window_end, t_ - f_ + 1 AS windows,
  {time_text('f_ * 5000000', '%Y-%m-%d')} AS partition_date FROM spans"""


def by_the_clock(kind: str, key: str, count: str) -> str:
    stamped = f"{in_cuts(kind)}, stamped AS (SELECT *, {CLOCK_START_MS} + b * {CLOCK_STEP_MS} AS at_ FROM mine)"
    last = str((CLOCK_START_MS + (CUTS - 1) * CLOCK_STEP_MS) // 5000)
    spans = windows(kind, key, PANES, "count(e.i_)", last=last, at="at_", source=stamped)
    return f"{spans} SELECT k_ AS {key}, n_ AS {count}, {SPAN}, d_ AS partition_date FROM spans"


# The last batch knows the watermark of the batch before it, set two batches before that.
DAYS = f"""{in_cuts("collect")},
over AS (SELECT max(t_ms) - 3000 AS w_ FROM mine WHERE b <= {CUTS - 3})
SELECT id AS collect_id, song_id, user_id, t_ms AS c_ts, channel, {time_text('t_ms * 1000', '%Y%m%d')} AS dt, b AS batch_id
FROM mine, over WHERE (t_ms // 86400000 + 1) * 86400000 + 600000 <= w_"""


def with_versions(seen: str) -> str:
    """Searches whose province has the name of version `seen` of the dimension."""
    cut = in_cuts("search", DIM_CUTS)
    return f"""{cut} SELECT s.* REPLACE (province_name || ' v' || {seen} AS province_name)
FROM ({SEARCH}) s JOIN mine ON mine.id = s.search_id"""


STREAM_ORACLES: dict[str, str] = {
    "stream_dwd_collect": of_lines(COLLECT),
    "stream_dwd_comment": of_lines(COMMENT),
    "stream_dwd_singer_follow": of_lines(FOLLOW),
    "stream_dwd_login": of_lines(LOGIN),
    "stream_dwd_register": of_lines(REGISTER),
    "stream_song_online_beats": ONLINE,
    "stream_song_collect_corrected": CORRECTED,
    "stream_song_collect_late": LATE_ROWS,
    "stream_song_search_clock": by_the_clock("search", "song_id", "search_count"),
    "stream_singer_follow_clock": by_the_clock("singer_follow", "singer_id", "follow_count"),
    "stream_collect_days": DAYS,
    "stream_dim_user_handover": f"SELECT *, CASE WHEN user_id % 14 = 0 THEN 2 ELSE 0 END::BIGINT AS applied FROM ({USER_CURRENT})",
    "stream_search_dims_fresh": with_versions("b"),
    "stream_search_dims_held": with_versions("b // 2 * 2"),
}
