"""SQL twins of the registered queries, for an independent engine to check against.

Each text is written from the definition of the figure, not from the Spark plan:
brute-force joins instead of grids, sorted lists instead of histograms, a
recursive walk instead of a fold.
"""

from __future__ import annotations

import math

from headway.plans.stand_ins import AS_OF

ORACLE: dict[str, str] = {}


def _with(ctes: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


# --- stand-ins in SQL ---------------------------------------------------------


def _visits(name: str, time: str, patterns: int) -> str:
    return f"""{name} AS (
  SELECT event_type AS rt,
         CAST((user_id // 15) % {patterns} AS VARCHAR) AS pid,
         CAST(user_id % 25 AS VARCHAR) AS stop_id,
         event_type || '-' || CAST(user_id // 15 AS VARCHAR) || '-' || CAST(CAST(t AS DATE) AS VARCHAR) AS trip_id,
         event_id AS stop_sequence, t AS bus_stop_time
  FROM (SELECT *, {time} AS t FROM events))"""


VA = _visits("va", "ts", 4)
VS = _visits("vs", "ts + to_minutes(CAST(((event_id % 7) - 3) * 17 AS INTEGER))", 5)


def _timed(name: str, source: str, daytime: bool = True, row: str = "pid") -> str:
    """``row`` ends the order within a trip: rows alike up to there must be equal, or two windows may sort them apart."""
    where = "WHERE hour(bus_stop_time) BETWEEN 6 AND 20" if daytime else ""
    return f"""{name}_d AS (SELECT * FROM {source} {where}),
{name}_g AS (
  SELECT *,
    date_sub('second', bus_stop_time, lead(bus_stop_time) OVER (PARTITION BY rt, stop_id ORDER BY bus_stop_time, trip_id, pid, stop_sequence)) AS time_till_next_bus,
    coalesce(date_sub('second', lag(bus_stop_time) OVER (PARTITION BY rt, trip_id ORDER BY bus_stop_time, stop_sequence, stop_id, {row}), bus_stop_time), 0) AS time_to_previous_stop
  FROM {name}_d),
{name} AS (
  SELECT *, CAST(sum(time_to_previous_stop) OVER (PARTITION BY rt, trip_id ORDER BY bus_stop_time, stop_sequence, stop_id, {row} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_trip_time
  FROM {name}_g)"""


_FIRST = f"date_trunc('month', DATE '{AS_OF}')"
_PERIOD = {
    "hour": "CAST(hour({t}) AS VARCHAR)",
    "weekday": "CAST(isodow({t}) AS VARCHAR)",
    "month": "CAST(month({t}) AS VARCHAR)",
    "year": "CAST(year({t}) AS VARCHAR)",
    "month_abs": "CAST(CAST(date_trunc('month', {t}) AS DATE) AS VARCHAR)",
    "year_hour": "CAST(year({t}) AS VARCHAR) || '-' || CAST(hour({t}) AS VARCHAR)",
    "year_weekday": "CAST(year({t}) AS VARCHAR) || '-' || CAST(isodow({t}) AS VARCHAR)",
    "last_full_month": "'last_full_month'",
    "dayofyear": "CAST(dayofyear({t}) AS VARCHAR)",
    "week": "CAST(week({t}) AS VARCHAR)",
    "week_abs": "CAST(CAST(date_trunc('week', {t}) AS DATE) AS VARCHAR)",
}
_SLOT = {
    "hour": "hour", "weekday": "day", "month": "month", "year": "year", "month_abs": "month",
    "year_hour": "hour", "year_weekday": "day", "last_full_month": "month", "dayofyear": "day",
    "week": "week", "week_abs": "week",
}
_LIVE = list(_PERIOD)[:8]
_OLDER = ["hour", "weekday", "dayofyear", "week", "month", "year", "week_abs", "month_abs"]


def _in_period(period: str, time: str) -> str:
    if period != "last_full_month":
        return "TRUE"
    return f"{time} >= {_FIRST} - INTERVAL 1 MONTH AND {time} < {_FIRST}"


def _spread(name: str, source: str, time: str, periods: list[str], columns: str) -> str:
    parts = [
        f"SELECT {columns}, '{p}' AS period, {_PERIOD[p].format(t=time)} AS period_value FROM {source} WHERE {_in_period(p, time)}"
        for p in periods
    ]
    return f"{name} AS (" + "\n  UNION ALL ".join(parts) + ")"


def _slots(name: str, source: str, periods: list[str], keys: str = "rt, pid, stop_id") -> str:
    """Bus counts per slot with the period value of the slot."""
    parts = []
    for p in periods:
        slot = f"date_trunc('{_SLOT[p]}', bus_stop_time)"
        parts.append(
            f"SELECT {keys}, '{p}' AS period, {_PERIOD[p].format(t='slot')} AS period_value, n AS num_buses FROM "
            f"(SELECT {keys}, {slot} AS slot, count(*) AS n FROM {source} "
            f"WHERE {_in_period(p, 'bus_stop_time')} GROUP BY {keys}, {slot})"
        )
    return f"{name} AS (" + "\n  UNION ALL ".join(parts) + ")"


def _nearest(v: str, q: str) -> str:
    ordered = f"list_sort(list({v}) FILTER ({v} IS NOT NULL))"
    return f"CAST({ordered}[1 + CAST(floor((count({v}) - 1) * {q} + 0.5e0) AS BIGINT)] AS DOUBLE)"


def _stats(v: str, name: str, which: tuple[str, ...] = ("count", "median", "q25", "q75"), places: int = 6) -> str:
    exprs = {
        "count": f"count({v})",
        "median": f"median({v})",
        "q25": _nearest(v, "0.25e0"),
        "q75": _nearest(v, "0.75e0"),
        "mean": f"avg({v})",
        "max": f"CAST(max({v}) AS DOUBLE)",
        "min": f"CAST(min({v}) AS DOUBLE)",
        "std": f"stddev_samp({v})",
    }
    cols = [
        f"CAST({exprs[s]} AS BIGINT) AS count_{name}" if s == "count" else f"round({exprs[s]}, {places}) AS {s}_{name}"
        for s in which
    ]
    return ", ".join(cols)


_K5 = "rt, pid, stop_id, period, period_value"
_TIMES = ("time_till_next_bus", "time_to_previous_stop", "cum_trip_time")
_SHORT = ("count", "median", "q25", "q75")


def _table(kind: str, source: str, periods: list[str], which: tuple[str, ...] = _SHORT, row: str = "pid") -> list[str]:
    """CTEs ending in ``m_<kind>``: all four metrics."""
    k = kind
    return [
        _timed(f"tm_{k}", source, row=row),
        _spread(f"sp_{k}", f"tm_{k}", "bus_stop_time", periods, "rt, pid, stop_id, " + ", ".join(_TIMES)),
        _slots(f"sl_{k}", f"tm_{k}_d", periods),
        f"mt_{k} AS (SELECT {_K5}, " + ", ".join(_stats(m, f"{k}_{m}", which) for m in _TIMES) + f" FROM sp_{k} GROUP BY {_K5})",
        f"mb_{k} AS (SELECT {_K5}, {_stats('num_buses', f'{k}_num_buses', which)} FROM sl_{k} GROUP BY {_K5})",
        f"m_{k} AS (SELECT * FROM mt_{k} FULL JOIN mb_{k} USING ({_K5}))",
    ]


def _both(periods: list[str], which: tuple[str, ...] = _SHORT) -> list[str]:
    return [
        VA, VS, *_table("actual", "va", periods, which), *_table("schedule", "vs", periods, which),
        f"m AS (SELECT *, median_actual_time_till_next_bus - median_schedule_time_till_next_bus AS time_till_next_bus_delay "
        f"FROM m_schedule FULL JOIN m_actual USING ({_K5}))",
    ]


# --- keys and clocks ----------------------------------------------------------

_BASE_LAT = "4.1e1 + 1.37e-2 * ({p} % 50)"
_BASE_LON = "-8.85e1 + 1e-2 * ({p} // 50)"

PINGS = f"""ev AS (
  SELECT event_id, ts, event_id // 8 AS t, event_id % 8 AS k FROM events),
ev2 AS (
  SELECT *, CASE WHEN t % 3 = 0 THEN 0 ELSE t // 20 + 1 END AS p,
    CASE WHEN t % 60 = 7 THEN 0e0
         WHEN t % 10 = 1 AND k = 1 THEN 3e-1 * (t % 4)
         ELSE 2.9e0 * k + 3e-1 * (t % 4) END AS u
  FROM ev),
pg AS (
  SELECT event_id AS ping_id, 1000 + t % 40 AS vid, strftime(ts, '%Y%m%d %H:%M') AS tmstmp,
    {_BASE_LAT.format(p='p')} + 2e-3 * u + 1e-4 * (((event_id // 2) % 3) - 1) AS lat,
    {_BASE_LON.format(p='p')}
      + 1e-3 * ((CAST(floor(u) AS BIGINT) % 4) + (u - floor(u)) * (((CAST(floor(u) AS BIGINT) + 1) % 4) - (CAST(floor(u) AS BIGINT) % 4)))
      + CASE WHEN event_id % 97 = 0 OR (t % 35 = 3 AND k >= t % 2) THEN 1e-2 ELSE 0e0 END AS lon,
    CAST(100 + p AS VARCHAR) AS pid, 'R' || CAST(p % 3 AS VARCHAR) AS rt, event_id % 11 = 0 AS dly,
    CAST(t AS VARCHAR) || CASE WHEN t % 50 = 0 THEN '-' || CAST(k AS VARCHAR) ELSE '' END AS tatripid,
    date_trunc('minute', ts) AS data_time, CAST(ts AS DATE) AS data_date
  FROM ev2),
pings AS (
  SELECT *, rt || pid || '.0' || tatripid || CAST(vid AS VARCHAR) || CAST(data_date AS VARCHAR) AS trip FROM pg)"""

POINTS = f"""pts AS (
  SELECT CAST(100 + p AS VARCHAR) AS pid, j + 1 AS seq, j,
    {_BASE_LAT.format(p='p')} + 2e-3 * j AS lat, {_BASE_LON.format(p='p')} + 1e-3 * (j % 4) AS lon,
    CASE WHEN j % 3 = 2 THEN 'W' ELSE 'S' END AS typ,
    CASE WHEN j % 3 <> 2 THEN CAST(1000 + 100 * p + j AS VARCHAR) END AS stpid
  FROM (SELECT DISTINCT p FROM ev2) CROSS JOIN (SELECT CAST(range AS BIGINT) AS j FROM range(24)))"""

KNOWN = "known AS (SELECT DISTINCT CAST(100 + 2 * c_nationkey AS VARCHAR) AS pid FROM customer)"


def _xy(name: str, source: str) -> str:
    """EPSG:26971 forward, written out from the standard series."""
    a, f = 6378137.0, 1 / 298.257222101
    e2 = 2 * f - f * f
    ep2 = e2 / (1 - e2)
    c0 = 1 - e2 / 4 - 3 * e2 * e2 / 64 - 5 * e2**3 / 256
    c2 = 3 * e2 / 8 + 3 * e2 * e2 / 32 + 45 * e2**3 / 1024
    c4 = 15 * e2 * e2 / 256 + 45 * e2**3 / 1024
    c6 = 35 * e2**3 / 3072
    p0 = (36 + 40 / 60) * math.pi / 180
    m0 = a * (c0 * p0 - c2 * math.sin(2 * p0) + c4 * math.sin(4 * p0) - c6 * math.sin(6 * p0))
    n = lambda v: f"{v:.17e}"
    return f"""{name}_1 AS (
  SELECT *, radians(lat) AS phi_, (radians(lon) - radians({n(-(88 + 20 / 60))})) * cos(radians(lat)) AS a_ FROM {source}),
{name}_2 AS (
  SELECT *, tan(phi_) * tan(phi_) AS t_, {n(ep2)} * cos(phi_) * cos(phi_) AS c_,
    {n(a)} / sqrt(1e0 - {n(e2)} * sin(phi_) * sin(phi_)) AS n_,
    {n(a)} * ({n(c0)} * phi_ - {n(c2)} * sin(2 * phi_) + {n(c4)} * sin(4 * phi_) - {n(c6)} * sin(6 * phi_)) - {n(m0)} AS m_
  FROM {name}_1),
{name} AS (
  SELECT * EXCLUDE (phi_, a_, t_, c_, n_, m_),
    3e5 + 9.99975e-1 * n_ * (a_ + (1e0 - t_ + c_) * a_ ** 3 / 6e0
      + (5e0 - 18e0 * t_ + t_ * t_ + 72e0 * c_ - 58e0 * {n(ep2)}) * a_ ** 5 / 12e1) AS x_m,
    9.99975e-1 * (m_ + n_ * tan(phi_) * (a_ * a_ / 2e0 + (5e0 - t_ + 9e0 * c_ + 4e0 * c_ * c_) * a_ ** 4 / 24e0
      + (61e0 - 58e0 * t_ + t_ * t_ + 600e0 * c_ - 330e0 * {n(ep2)}) * a_ ** 6 / 72e1)) AS y_m
  FROM {name}_2)"""


def _dist(px: str, py: str, x0: str, y0: str, x1: str, y1: str) -> str:
    """Point to segment."""
    dx, dy = f"({x1} - {x0})", f"({y1} - {y0})"
    l2 = f"({dx} * {dx} + {dy} * {dy})"
    s = f"CASE WHEN {l2} > 0 THEN greatest(0e0, least(1e0, (({px} - {x0}) * {dx} + ({py} - {y0}) * {dy}) / {l2})) ELSE 0e0 END"
    return f"sqrt(({px} - ({x0} + ({s}) * {dx})) ** 2 + ({py} - ({y0} + ({s}) * {dy})) ** 2)"


LEGS = [
    _xy("pxy", "pts"),
    """legs AS (
  SELECT pid, j AS segments, coalesce(lag(x_m) OVER w, x_m) AS x0, coalesce(lag(y_m) OVER w, y_m) AS y0, x_m AS x1, y_m AS y1
  FROM pxy WINDOW w AS (PARTITION BY pid ORDER BY seq))""",
]
CLEAN = [
    _xy("gxy", "pings"),
    """steps AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY pid, trip) AS n_all,
    (max(x_m) OVER (PARTITION BY pid, trip) - min(x_m) OVER (PARTITION BY pid, trip))
      * (max(y_m) OVER (PARTITION BY pid, trip) - min(y_m) OVER (PARTITION BY pid, trip)) AS box,
    sqrt((lead(x_m) OVER w - x_m) ** 2 + (lead(y_m) OVER w - y_m) ** 2) AS step
  FROM gxy WINDOW w AS (PARTITION BY pid, trip ORDER BY data_time, ping_id))""",
    """starts AS (
  SELECT pid, trip, min(CASE WHEN step >= 5 OR step IS NULL THEN i END) AS first_move FROM steps GROUP BY pid, trip)""",
    """judged AS (
  SELECT s.*, CASE WHEN box <= 20 THEN 'stationary_trip' WHEN i < first_move THEN 'leading_standstill'
    WHEN n_all - first_move + 1 <= 1 THEN 'one_ping' END AS drop_reason
  FROM steps s JOIN starts USING (pid, trip))""",
    "cleaned AS (SELECT * FROM judged WHERE drop_reason IS NULL)",
]


def _match(offset: str) -> list[str]:
    return [
        f"""cand AS (
  SELECT c.ping_id, c.pid, c.trip, c.rt, c.vid, c.data_time, c.x_m, c.y_m,
    list_sort(list(l.segments + {offset})) AS ps,
    row_number() OVER (PARTITION BY c.pid, c.trip ORDER BY c.data_time, c.ping_id) AS n
  FROM cleaned c JOIN legs l ON c.pid = l.pid
  WHERE {_dist('c.x_m', 'c.y_m', 'l.x0', 'l.y0', 'l.x1', 'l.y1')} <= 50
  GROUP BY c.ping_id, c.pid, c.trip, c.rt, c.vid, c.data_time, c.x_m, c.y_m)""",
        """walk AS (
  SELECT pid, trip, CAST(0 AS BIGINT) AS n, CAST(0 AS DOUBLE) AS pos, CAST(NULL AS DOUBLE) AS took FROM (SELECT DISTINCT pid, trip FROM cand)
  UNION ALL
  SELECT pid, trip, n, coalesce(nxt, pos), nxt FROM (
    SELECT w.pid, w.trip, c.n, w.pos, (SELECT min(q) FROM (SELECT unnest(c.ps) AS q) WHERE q > w.pos) AS nxt
    FROM walk w JOIN cand c ON c.pid = w.pid AND c.trip = w.trip AND c.n = w.n + 1))""",
        """matched AS (
  SELECT c.*, w.took AS seg FROM walk w JOIN cand c ON c.pid = w.pid AND c.trip = w.trip AND c.n = w.n WHERE w.took IS NOT NULL)""",
    ]


_PIPE = [PINGS, POINTS, *LEGS, *CLEAN]


def _interpolate(offset: str, anchor_next: bool) -> list[str]:
    acc = (
        "sum(dn) OVER (PARTITION BY pid, trip, b ORDER BY seg ROWS UNBOUNDED PRECEDING)"
        if anchor_next
        else "coalesce(sum(dn) OVER (PARTITION BY pid, trip, b ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )
    return [
        *_PIPE, *_match(offset),
        "two AS (SELECT pid, trip, min(rt) AS rt, min(vid) AS vid FROM matched GROUP BY pid, trip HAVING count(*) > 1)",
        """mixed AS (
  SELECT m.pid, m.trip, m.seg, 'B' AS typ, CAST(NULL AS VARCHAR) AS stpid, m.x_m, m.y_m, m.data_time FROM matched m JOIN two USING (pid, trip)
  UNION ALL
  SELECT t.pid, t.trip, CAST(p.j AS DOUBLE), p.typ, p.stpid, p.x_m, p.y_m, NULL FROM two t JOIN pxy p ON p.pid = t.pid)""",
        """m1 AS (
  SELECT *, sum(CASE WHEN typ = 'B' THEN 1 ELSE 0 END) OVER w AS b, sum(CASE WHEN typ = 'S' THEN 1 ELSE 0 END) OVER w AS s,
    sqrt((lead(x_m) OVER w0 - x_m) ** 2 + (lead(y_m) OVER w0 - y_m) ** 2) AS dn
  FROM mixed WINDOW w0 AS (PARTITION BY pid, trip ORDER BY seg), w AS (PARTITION BY pid, trip ORDER BY seg ROWS UNBOUNDED PRECEDING))""",
        "pt AS (SELECT pid, trip, b, data_time AS t0, lead(data_time) OVER (PARTITION BY pid, trip ORDER BY seg) AS t1, count(*) OVER (PARTITION BY pid, trip) AS nb FROM m1 WHERE typ = 'B')",
        f"""m2 AS (
  SELECT *, coalesce({acc}, 0) AS acc, coalesce(sum(dn) OVER (PARTITION BY pid, trip, b), 0) AS ping_dist,
    coalesce(sum(dn) OVER (PARTITION BY pid, trip, s), 0) AS stop_dist FROM m1)""",
        """st AS (
  SELECT m2.*, pt.t0, date_diff('second', pt.t0, pt.t1) AS gap, pt.nb,
    max(pt.nb) OVER (PARTITION BY m2.pid, m2.trip) AS pings
  FROM m2 LEFT JOIN pt USING (pid, trip, b) WHERE typ = 'S')""",
        """sp AS (
  SELECT *, CASE WHEN mph BETWEEN 1 AND 115 THEN mph END AS ok_mph, CASE WHEN stop_dist >= 1 THEN stop_dist END AS ok_dist FROM (
    SELECT *, (ping_dist / 1609e0) / (CASE WHEN coalesce(gap, 0) = 0 THEN 1e-9 ELSE gap END / 3600e0) AS mph FROM st))""",
        """sf AS (
  SELECT *, coalesce(last_value(ok_mph IGNORE NULLS) OVER f, first_value(ok_mph IGNORE NULLS) OVER r) AS speed,
    last_value(ok_dist IGNORE NULLS) OVER f AS dist
  FROM sp WINDOW f AS (PARTITION BY pid, trip ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    r AS (PARTITION BY pid, trip ORDER BY seg ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
        "sd AS (SELECT *, dist / (speed / 2.23694e0) AS td FROM sf)",
        "ends AS (SELECT pid, trip, min(t0) AS first_t, max(t0) AS last_t, max(nb) AS nb FROM pt GROUP BY pid, trip)",
        """chain AS (
  SELECT sd.*, e.first_t, e.last_t, e.nb AS n_pings,
    sum(td) OVER bwd AS back, count(*) OVER bwd - count(td) OVER bwd AS back_gap,
    sum(td) OVER fwd AS ahead, count(*) OVER fwd - count(td) OVER fwd AS ahead_gap
  FROM sd JOIN ends e USING (pid, trip)
  WINDOW bwd AS (PARTITION BY pid, trip, b ORDER BY seg ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    fwd AS (PARTITION BY pid, trip, b ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
        """timed AS (
  SELECT *, CASE
    WHEN b = 0 THEN CASE WHEN back_gap = 0 THEN epoch(first_t) - back END
    WHEN b = n_pings THEN CASE WHEN ahead_gap = 0 THEN epoch(last_t) + ahead END
    ELSE epoch(t0) + gap * acc / nullif(ping_dist, 0) END AS et FROM chain)""",
    ]


_STOP_TIMES_SELECT = """SELECT trip AS unique_trip_vehicle_day, two.rt, pid, CAST(two.vid AS VARCHAR) AS vid, stpid, pid || '-' || stpid AS p_stp_id,
  CAST(s AS BIGINT) AS stop_sequence,
  strftime(make_timestamp(CAST(round(et * 1e6) AS BIGINT) + 370000), '%Y-%m-%d %H:%M:%S') AS bus_stop_time, round(speed, 4) AS speed_mph
FROM timed JOIN two USING (pid, trip)"""

ORACLE["trip_keys"] = _with([PINGS], """SELECT ping_id, pid, trip AS unique_trip_vehicle_day,
  concat_ws('_', rt, pid || '.0', tatripid, CAST(vid AS VARCHAR), CAST(data_date AS VARCHAR)) AS key_sep FROM pings""")
ORACLE["trip_keys_null_parts"] = """SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END || CAST(o_custkey AS VARCHAR) AS k FROM orders"""
ORACLE["pid_normalised"] = """SELECT event_id,
  CASE WHEN event_id % 5 IN (0, 1, 3) THEN CAST(user_id AS VARCHAR) END AS pid,
  CASE WHEN event_id % 5 IN (0, 1, 3) THEN lpad(CAST(user_id AS VARCHAR), 5, '0') END AS padded FROM events"""
ORACLE["shape_pids"] = """SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, lpad(CAST(100 + o_orderkey % 60 AS VARCHAR), 5, '0') AS pid,
  CAST(100 + o_orderkey % 60 AS VARCHAR) AS bare FROM orders"""

_ARRIVAL = """lpad(CAST(({s}) // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST((({s}) // 60) % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(({s}) % 60 AS VARCHAR), 2, '0')""".format(
    s="(l_orderkey % 50) * 1860 + l_linenumber * 127"
)
DATED = f"""dated AS (
  SELECT 'R' || CAST(l_suppkey % 10 AS VARCHAR) AS route_id, CAST(l_partkey % 7 AS VARCHAR) AS pid, CAST(l_suppkey AS VARCHAR) AS schd_trip_id,
    CAST(l_partkey % 40 AS VARCHAR) AS stop_id, CAST(l_linenumber AS VARCHAR) AS stop_sequence,
    CAST(l_shipdate AS DATE) + CAST((l_linenumber % 3) * 700 AS INTEGER) AS d, {_ARRIVAL} AS arrival_time,
    (l_orderkey % 50) * 1860 + l_linenumber * 127 AS secs,
    CAST(l_orderkey AS VARCHAR) AS trip_id, 'v' || CAST(l_linenumber % 3 AS VARCHAR) AS sha1, l_linenumber % 3 AS v
  FROM lineitem)"""
ORACLE["schedule_clock"] = _with([DATED], """SELECT trip_id, stop_id, stop_sequence, schd_trip_id,
  strftime(CAST(d AS TIMESTAMP) + to_seconds(secs), '%Y-%m-%d %H:%M:%S') AS bus_stop_time,
  CASE WHEN secs < 86400 THEN CAST(d AS VARCHAR) || ' ' || arrival_time
       WHEN secs < 90000 THEN CAST(d + 1 AS VARCHAR) || ' ' || replace(arrival_time, '24', '00') END AS strict_time FROM dated""")

# --- visits and metrics -------------------------------------------------------

ORACLE["visit_metrics"] = _with([VA, _timed("tm", "va")], """SELECT rt, pid, stop_id, trip_id, stop_sequence AS event_id,
  time_till_next_bus, time_to_previous_stop, cum_trip_time, CAST(hour(bus_stop_time) AS INTEGER) AS hour,
  CAST(month(bus_stop_time) AS INTEGER) AS month, CAST(year(bus_stop_time) AS INTEGER) AS year, CAST(day(bus_stop_time) AS INTEGER) AS day FROM tm""")
ORACLE["headway_within_day"] = _with([VA], """SELECT stop_sequence,
  CASE WHEN CAST(nx AS DATE) = CAST(bus_stop_time AS DATE) THEN date_sub('second', bus_stop_time, nx) END AS time_till_next_bus
FROM (SELECT *, lead(bus_stop_time) OVER (PARTITION BY rt, stop_id ORDER BY bus_stop_time, trip_id) AS nx
      FROM va WHERE hour(bus_stop_time) BETWEEN 6 AND 20)""")


def _one_period(name: str, period: str, metric: str) -> None:
    if metric == "num_buses":
        ctes = [VA, _timed("tm", "va"), _slots("sp", "tm_d", [period])]
    else:
        ctes = [VA, _timed("tm", "va"), _spread("sp", "tm", "bus_stop_time", [period], f"rt, pid, stop_id, {metric}")]
    ORACLE[name] = _with(ctes, f"SELECT {_K5}, {_stats(metric, metric)} FROM sp GROUP BY {_K5}")


for _p in ("hour", "weekday", "year_hour", "month_abs", "last_full_month"):
    _one_period(f"headway_by_{_p}", _p, "time_till_next_bus")
_one_period("segment_time_by_weekday", "weekday", "time_to_previous_stop")
_one_period("cum_trip_time_by_year_weekday", "year_weekday", "cum_trip_time")
_one_period("bus_counts_by_hour", "hour", "num_buses")
_one_period("bus_counts_by_weekday", "weekday", "num_buses")
ORACLE["bus_counts_two_level"] = _with(
    [VA, _timed("tm", "va"), _slots("sp", "tm_d", _LIVE)],
    f"SELECT {_K5}, {_stats('num_buses', 'num_buses')} FROM sp GROUP BY {_K5}",
)
ORACLE["stop_metrics_actual"] = _with([VA, *_table("actual", "va", _LIVE)], "SELECT * FROM m_actual")
ORACLE["stop_metrics_schedule"] = _with([VS, *_table("schedule", "vs", _LIVE)], "SELECT * FROM m_schedule")
ORACLE["stop_metrics_compare"] = _with(_both(_LIVE), "SELECT * FROM m")
ORACLE["stop_metrics_joined"] = _with(_both(["weekday"]), "SELECT * FROM m")


def _durations(name: str, source: str) -> str:
    return f"""{name} AS (SELECT trip_id, rt, pid, min(bus_stop_time) AS start_trip,
  date_sub('second', min(bus_stop_time), max(bus_stop_time)) AS trip_duration FROM {source} GROUP BY trip_id, rt, pid)"""


_K4 = "rt, pid, period, period_value"


def _trip_table(kind: str, source: str, periods: list[str], which: tuple[str, ...] = _SHORT) -> list[str]:
    return [
        _durations(f"du_{kind}", source),
        _spread(f"ds_{kind}", f"du_{kind}", "start_trip", periods, "rt, pid, trip_duration"),
        f"dm_{kind} AS (SELECT {_K4}, {_stats('trip_duration', f'{kind}_trip_duration', which)} FROM ds_{kind} GROUP BY {_K4})",
    ]


def _trips_both(periods: list[str]) -> list[str]:
    return [
        *_trip_table("actual", "va", periods), *_trip_table("schedule", "vs", periods),
        f"tr AS (SELECT * FROM dm_schedule FULL JOIN dm_actual USING ({_K4}))",
    ]


ORACLE["trip_durations"] = _with([VA, _durations("du", "va")], "SELECT trip_id, rt, pid, trip_duration FROM du")
ORACLE["trip_metrics_actual"] = _with([VA, *_trip_table("actual", "va", _LIVE)], "SELECT * FROM dm_actual")
ORACLE["trip_duration_compare"] = _with([VA, VS, *_trips_both(_LIVE)], "SELECT * FROM tr")
ORACLE["long_metric_pack"] = _with(
    [VA, _timed("tm", "va"), _spread("sp", "tm", "bus_stop_time", _OLDER, "rt, pid, stop_id, time_till_next_bus")],
    f"SELECT {_K5}, "
    + _stats("time_till_next_bus", "time_till_next_bus", ("count", "median", "mean", "max", "min", "std", "q25", "q75"), 4)
    + f" FROM sp GROUP BY {_K5}",
)
ORACLE["hourly_counts_both"] = _with([VA, VS], """SELECT rt, stop_id, strftime(h, '%Y-%m-%d %H') AS hour, s.n AS num_trips_sched, a.n AS num_trips_actual
FROM (SELECT rt, stop_id, date_trunc('hour', bus_stop_time) AS h, count(*) AS n FROM va GROUP BY ALL) a
JOIN (SELECT rt, stop_id, date_trunc('hour', bus_stop_time) AS h, count(*) AS n FROM vs GROUP BY ALL) s USING (rt, stop_id, h)""")
ORACLE["metrics_state"] = _with(_both(["month_abs", "hour"]), """SELECT count(*) AS total_rows,
  count(DISTINCT CASE WHEN period = 'month_abs' THEN period_value END) AS total_months,
  max(CASE WHEN period = 'month_abs' THEN period_value END) AS max_month,
  max(CASE WHEN period = 'month_abs' AND median_actual_time_till_next_bus IS NOT NULL THEN period_value END) AS max_month_actual FROM m""")
ORACLE["reused_trip_split"] = """SELECT rt, schd_trip_id, stop_id, stop_sequence,
  CAST(schd_trip_id AS VARCHAR) || '-' || CAST((rn - 1) // total AS VARCHAR) AS trip_id FROM (
  SELECT *, row_number() OVER (PARTITION BY rt, schd_trip_id ORDER BY t, stop_sequence, stop_id) AS rn,
    max(stop_sequence) OVER (PARTITION BY rt, schd_trip_id) AS total FROM (
    SELECT 'R' || CAST(l_suppkey % 3 AS VARCHAR) AS rt, l_suppkey AS schd_trip_id, l_partkey AS stop_id, l_linenumber AS stop_sequence,
      l_shipdate + to_seconds(l_orderkey % 86400) AS t FROM lineitem))"""

# --- roll-ups -----------------------------------------------------------------

SAREA = "sarea AS (SELECT r_name AS community, CAST(n_nationkey AS VARCHAR) AS stop_id FROM nation JOIN region ON n_regionkey = r_regionkey)"
_CMS = ("count", "median", "std")


def _weighted(source: str, group: str, value: str, weight: str, where: str) -> str:
    return f"""SELECT period_value, {group}, round(min({value}) / 60, 6) AS median_minutes FROM (
  SELECT *, sum({weight}) OVER (PARTITION BY period_value, {group} ORDER BY {value} RANGE UNBOUNDED PRECEDING) AS cum,
    sum({weight}) OVER (PARTITION BY period_value, {group}) AS total
  FROM {source} WHERE {where} AND {weight} > 0) WHERE 2 * cum >= total GROUP BY period_value, {group}"""


ORACLE["weighted_median_rt"] = _with(
    _both(["month_abs"], _CMS),
    _weighted("m", "rt", "median_actual_time_till_next_bus", "count_actual_time_till_next_bus", "period = 'month_abs'"),
)
ORACLE["weighted_median_area"] = _with(
    [*_both(["hour"], _CMS), SAREA, "mc AS (SELECT * FROM m JOIN sarea USING (stop_id))"],
    _weighted("mc", "community", "median_actual_cum_trip_time", "count_actual_cum_trip_time", "period_value <> '6'"),
)
ORACLE["weight_shares"] = _with(_both(["weekday"], _CMS), """SELECT rt, pid, stop_id, period_value, n,
  CAST(sum(n) OVER (PARTITION BY rt, period_value) AS BIGINT) AS total_weight, round(n / sum(n) OVER (PARTITION BY rt, period_value), 6) AS weight_share
FROM (SELECT rt, pid, stop_id, period_value, count_actual_num_buses AS n FROM m WHERE count_actual_num_buses > 0)""")

_STOP_COLS = [
    "median_actual_time_till_next_bus", "std_actual_time_till_next_bus", "time_till_next_bus_delay",
    "median_schedule_time_till_next_bus", "std_schedule_time_till_next_bus", "median_schedule_num_buses",
    "median_actual_num_buses",
]


def _medians(cols: list[str]) -> str:
    return ", ".join(
        f"median({c}) AS {c}" if "num_buses" in c else f"median({c}) / 60 AS {c}" for c in cols
    )


def _round_all(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 4) AS {c}" for c in cols)


def _summary(keys: str, source: str, where: str, trips: bool) -> str:
    ss = f"ss AS (SELECT {keys}, {_medians(_STOP_COLS)} FROM {source} WHERE {where} GROUP BY {keys})"
    out = f"{keys}, {_round_all(_STOP_COLS)}, round(median_actual_num_buses - median_schedule_num_buses, 4) AS bus_excess"
    if not trips:
        return ss + f"\nSELECT {out} FROM ss"
    dur = ["median_actual_trip_duration", "median_schedule_trip_duration"]
    tt = f"tt AS (SELECT {keys}, {_medians(dur)} FROM tr WHERE {where} GROUP BY {keys})"
    return (
        ss + ",\n" + tt + f"\nSELECT {out}, {_round_all(dur)}, "
        f"round(median_actual_trip_duration - median_schedule_trip_duration, 4) AS trip_delay FROM ss LEFT JOIN tt USING ({keys})"
    )


def _summary_query(ctes: list[str], *args) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + _summary(*args)


ORACLE["summary_by_rt"] = _summary_query(
    [*_both(["weekday"], _CMS), *_trips_both(["weekday"])], "rt, period_value", "m", "rt <> 'error'", True
).replace("FROM tr WHERE rt <> 'error'", "FROM tr WHERE TRUE")
ORACLE["summary_by_area"] = _summary_query(
    [*_both(["hour"], _CMS), SAREA, "mc AS (SELECT * FROM m JOIN sarea USING (stop_id))"],
    "community, period_value", "mc", "TRUE", False,
)
ORACLE["summary_one_value"] = _summary_query(_both(["dayofyear"], _CMS), "rt", "m", "TRUE", False)
ORACLE["summary_one_year"] = _summary_query(
    [*_both(["year"], _CMS), *_trips_both(["year"])], "rt", "m", "period_value = '2024'", True
)

BPH = """bph AS (SELECT rt, pid, stop_id, date_trunc('hour', bus_stop_time) AS h, count(*) AS bus_per_hour, 60e0 / count(*) AS wait
  FROM va GROUP BY rt, pid, stop_id, date_trunc('hour', bus_stop_time))"""
_AVG = "round(avg(bus_per_hour), 6) AS avg_bus_per_hour, round(avg(wait), 6) AS avg_wait_time_minutes"
ORACLE["buses_per_hour_wait"] = _with([VA, BPH], """SELECT rt, pid, stop_id, strftime(h, '%Y-%m-%d %H') AS hour, bus_per_hour,
  round(wait, 6) AS wait_time_minutes, CAST(year(h) AS INTEGER) AS year, CAST(month(h) AS INTEGER) AS month FROM bph""")
ORACLE["average_service_by_route"] = _with([VA, BPH], f"SELECT stop_id, rt, CAST(year(h) AS INTEGER) AS year, {_AVG} FROM bph GROUP BY stop_id, rt, year(h)")
ORACLE["average_service_by_day"] = _with([VA, BPH], f"SELECT strftime(h, '%Y-%m-%d') AS day, CAST(hour(h) AS INTEGER) AS clock_hour, {_AVG} FROM bph GROUP BY 1, 2")
ORACLE["area_service"] = _with([VA, BPH, SAREA], """SELECT community, round(sum(b), 6) AS sum_bus_per_hour, round(avg(b), 6) AS avg_bus_per_hour,
  round(avg(w), 6) AS avg_wait_time_minutes FROM sarea
JOIN (SELECT stop_id, rt, year(h) AS y, avg(bus_per_hour) AS b, avg(wait) AS w FROM bph GROUP BY 1, 2, 3) USING (stop_id) GROUP BY community""")
TOP = """top AS (SELECT rt, pid, trips FROM (SELECT *, row_number() OVER (PARTITION BY rt ORDER BY trips DESC, pid) AS rn
  FROM (SELECT rt, pid, count(DISTINCT trip_id) AS trips FROM {src} GROUP BY rt, pid)) WHERE rn = 1)"""
ORACLE["busiest_pattern"] = _with([VA, TOP.format(src="va")], "SELECT rt, pid, trips FROM top")
ORACLE["trip_profiles"] = _with([VA, _timed("tm", "va"), TOP.format(src="tm_d")],
    "SELECT rt, pid, trip_id, stop_id, stop_sequence, cum_trip_time FROM tm JOIN top USING (rt, pid)")
ORACLE["sampled_trip_profiles"] = _with([VA, _timed("tm", "va"), TOP.format(src="tm_d"),
    """chosen AS (SELECT rt, trip_id FROM (SELECT DISTINCT rt, trip_id FROM tm JOIN top USING (rt, pid))
  QUALIFY row_number() OVER (PARTITION BY rt ORDER BY md5(trip_id || ':7'), trip_id) <= 100)"""],
    "SELECT rt, pid, trip_id, stop_id, stop_sequence, cum_trip_time FROM tm JOIN top USING (rt, pid) JOIN chosen USING (rt, trip_id)")
ORACLE["median_profile"] = _with(_both(["year"], _CMS), """SELECT rt, pid, stop_id, median_actual_cum_trip_time, median_schedule_cum_trip_time
FROM m WHERE period_value = '2024'""")

# --- schedule -----------------------------------------------------------------

SDAYS = """sdays AS (
  SELECT DISTINCT CAST(s AS VARCHAR) AS service_id, d FROM (
    SELECT r_regionkey AS s, CAST(DATE '2024-01-01' + CAST(i AS INTEGER) AS DATE) AS d FROM region CROSS JOIN (SELECT range AS i FROM range(14))
    WHERE (r_regionkey + isodow(DATE '2024-01-01' + CAST(i AS INTEGER))) % 3 <> 0
    UNION ALL SELECT r_regionkey, CAST(DATE '2024-01-01' + CAST(3 * r_regionkey AS INTEGER) AS DATE) FROM region WHERE r_regionkey % 2 = 0)
  WHERE NOT (s % 2 = 1 AND d = DATE '2024-01-01' + CAST(3 * s AS INTEGER)))"""
GTRIPS = """gtrips AS (SELECT 'R' || CAST(o_custkey % 25 AS VARCHAR) AS route_id, CAST(o_orderkey % 5 AS VARCHAR) AS service_id,
  CAST(o_orderkey AS VARCHAR) AS trip_id, '6430' || lpad(CAST(100 + o_orderkey % 60 AS VARCHAR), 5, '0') AS shape_id FROM orders)"""
ORACLE["service_days"] = _with([SDAYS, GTRIPS], """SELECT service_id, CAST(d AS VARCHAR) AS date, trips FROM sdays
JOIN (SELECT service_id, count(*) AS trips FROM gtrips GROUP BY 1) USING (service_id)""")
ORACLE["active_trips"] = _with([SDAYS, GTRIPS], "SELECT trip_id, route_id, CAST(d AS VARCHAR) AS date FROM gtrips JOIN sdays USING (service_id)")
ORACLE["trips_on_date"] = _with([SDAYS, GTRIPS], "SELECT trip_id, service_id, shape_id FROM gtrips JOIN sdays USING (service_id) WHERE d = DATE '2024-01-04'")
EXPANDED = f"""expanded AS (
  SELECT g.route_id, right(shape_id, 5) AS pid, CAST(CAST(g.trip_id AS BIGINT) % 600 AS VARCHAR) AS schd_trip_id, g.service_id, g.trip_id, d, sequence, secs,
    stop_id, arrival_time
  FROM gtrips g JOIN sdays USING (service_id)
  JOIN nation ON g.route_id = 'R' || CAST(n_nationkey AS VARCHAR) AND n_regionkey <> 2
  JOIN (SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_partkey % 40 AS VARCHAR) AS stop_id, l_linenumber AS sequence, {_ARRIVAL} AS arrival_time,
      (l_orderkey % 50) * 1860 + l_linenumber * 127 AS secs FROM lineitem) USING (trip_id))"""
ORACLE["expand_schedule"] = _with([SDAYS, GTRIPS, EXPANDED], """SELECT route_id, pid, schd_trip_id, stop_id, CAST(sequence AS VARCHAR) AS stop_sequence,
  CAST(d AS VARCHAR) AS date, arrival_time, arrival_time AS departure_time, service_id, trip_id, 'v1' AS sha1 FROM expanded""")
ORACLE["clean_schedule"] = _with([SDAYS, GTRIPS, EXPANDED], """SELECT route_id, pid, schd_trip_id, stop_id, CAST(sequence AS VARCHAR) AS stop_sequence, service_id, trip_id,
  strftime(CAST(d AS TIMESTAMP) + to_seconds(secs), '%Y-%m-%d %H:%M:%S') AS bus_stop_time FROM expanded""")
_SCHEDULED = """vsched AS (
  SELECT rt, pid, stop_id, schd || '-' || CAST((rn - 1) // mx AS VARCHAR) AS trip_id, sequence AS stop_sequence, t AS bus_stop_time, rn FROM (
    SELECT *, row_number() OVER (PARTITION BY rt, schd ORDER BY t, sequence, stop_id, pid) AS rn, max(sequence) OVER (PARTITION BY rt, schd) AS mx FROM (
      SELECT route_id AS rt, CAST(CAST(pid AS INTEGER) AS VARCHAR) AS pid, stop_id, schd_trip_id AS schd, sequence, CAST(d AS TIMESTAMP) + to_seconds(secs) AS t FROM expanded)))"""
ORACLE["metrics_from_schedule"] = _with(
    [SDAYS, GTRIPS, EXPANDED, _SCHEDULED, VA, *_table("actual", "va", ["hour"]), *_table("schedule", "vsched", ["hour"], row="rn")],
    f"SELECT *, median_actual_time_till_next_bus - median_schedule_time_till_next_bus AS time_till_next_bus_delay FROM m_schedule FULL JOIN m_actual USING ({_K5})")
ORACLE["schedule_merge"] = _with([DATED, "cur AS (SELECT route_id, min(d) AS since FROM dated WHERE v = 2 GROUP BY 1)"], """
SELECT route_id, schd_trip_id, stop_id, stop_sequence, trip_id, strftime(CAST(d AS TIMESTAMP) + to_seconds(secs), '%Y-%m-%d %H:%M:%S') AS bus_stop_time
FROM dated LEFT JOIN cur USING (route_id) WHERE v = 2 OR CAST(d AS TIMESTAMP) + to_seconds(secs) < since""")
FWIN = """fwin AS (SELECT route_id, v, min(d) AS min_date, lead(min(d)) OVER (PARTITION BY route_id ORDER BY v) AS valid_to FROM dated GROUP BY route_id, v)"""
ORACLE["feed_windows"] = _with([DATED, FWIN], "SELECT route_id, 'v' || CAST(v AS VARCHAR) AS sha1, CAST(min_date AS VARCHAR) AS min_date, CAST(valid_to AS VARCHAR) AS valid_to FROM fwin")
ORACLE["feed_version_dedupe"] = _with([DATED, FWIN], """SELECT route_id, sha1, strftime(d, '%Y%m%d') AS date, trip_id, stop_id, stop_sequence, schd_trip_id
FROM dated JOIN fwin USING (route_id, v) WHERE valid_to IS NULL OR d < valid_to""")
ORACLE["schedule_state"] = _with([DATED], """SELECT count(*) AS total_rows, count(DISTINCT CAST(t AS DATE)) AS total_days, CAST(max(CAST(t AS DATE)) AS VARCHAR) AS max_day
FROM (SELECT CAST(d AS TIMESTAMP) + to_seconds(secs) AS t FROM dated)""")

# --- geometry, pings to stop times --------------------------------------------

ORACLE["project_points"] = _with([PINGS, _xy("gxy", "pings")], "SELECT ping_id, round(x_m, 3) AS x_m, round(y_m, 3) AS y_m FROM gxy")
ORACLE["pattern_legs"] = _with([PINGS, POINTS, *LEGS], "SELECT pid, segments, round(sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) * 3.280839895e0, 3) AS length_ft FROM legs")
ORACLE["pattern_stops"] = _with([PINGS, POINTS, _xy("pxy", "pts")], """SELECT pid, j AS segment, typ, stpid, pid || '-' || stpid AS p_stp_id,
  round(x_m, 3) AS x_m, round(y_m, 3) AS y_m FROM pxy""")
ORACLE["stops_per_pattern"] = _with([PINGS, POINTS], "SELECT pid, count(*) FILTER (typ = 'S') AS stops FROM pts GROUP BY pid")
ORACLE["current_or_historic"] = _with([PINGS, POINTS, KNOWN], "SELECT pid, seq, CASE WHEN pid IN (SELECT pid FROM known) THEN 'current' ELSE 'historic' END AS version FROM pts")
ORACLE["clean_pings"] = _with([PINGS, *CLEAN], "SELECT ping_id, trip AS unique_trip_vehicle_day, drop_reason FROM judged")
NEAR = f"""near AS (SELECT c.ping_id, l.segments + 5e-1 AS seg_combined FROM gxy c JOIN legs l ON c.pid = l.pid
  WHERE {_dist('c.x_m', 'c.y_m', 'l.x0', 'l.y0', 'l.x1', 'l.y1')} <= 50)"""
ORACLE["ping_candidates"] = _with([PINGS, POINTS, *LEGS, _xy("gxy", "pings"), NEAR], "SELECT ping_id, seg_combined FROM near")
ORACLE["off_route_pings"] = _with([PINGS, POINTS, *LEGS, _xy("gxy", "pings"), NEAR], "SELECT ping_id FROM pings WHERE ping_id NOT IN (SELECT ping_id FROM near)")
ORACLE["match_legs"] = _with([*_PIPE, *_match("5e-1")], "SELECT ping_id, pid, trip AS unique_trip_vehicle_day, seg AS seg_combined FROM matched")
LONG = f"""cleaned0 AS (
  SELECT *, u - floor(u) AS fr, CAST(floor(u) AS BIGINT) AS j FROM (SELECT event_id, 5.5e-3 * (event_id % 4096) AS u FROM events WHERE (event_id // 8) % 3 = 0)),
cleaned1 AS (
  SELECT event_id AS ping_id, '100' AS pid, 'R0100.0long12024-01-01' AS trip, 'R0' AS rt, 1 AS vid, TIMESTAMP '2024-01-01' + to_seconds(event_id) AS data_time,
    {_BASE_LAT.format(p='0')} + 2e-3 * u AS lat, {_BASE_LON.format(p='0')} + 1e-3 * ((j % 4) + fr * (((j + 1) % 4) - (j % 4))) AS lon FROM cleaned0)"""
ORACLE["match_long_trip"] = _with([PINGS, POINTS, *LEGS, LONG, _xy("cleaned", "cleaned1"), *_match("5e-1")],
    "SELECT ping_id, pid, trip AS unique_trip_vehicle_day, seg AS seg_combined FROM matched")
STATUS = """status AS (
  SELECT pid, trip, pings, coalesce(placed, 0) AS placed, CASE coalesce(placed, 0) WHEN 0 THEN 'no_match' WHEN 1 THEN 'one_match' ELSE 'ok' END AS status
  FROM (SELECT pid, trip, count(*) AS pings FROM cleaned GROUP BY pid, trip)
  LEFT JOIN (SELECT pid, trip, count(*) AS placed FROM matched GROUP BY pid, trip) USING (pid, trip))"""
ORACLE["match_status"] = _with([*_PIPE, *_match("5e-1"), STATUS], "SELECT pid, trip AS unique_trip_vehicle_day, pings, placed, status FROM status")
ORACLE["rejected_trips"] = _with([*_PIPE, *_match("5e-1"), STATUS], "SELECT pid, trip AS unique_trip_vehicle_day, status AS reason FROM status WHERE status <> 'ok'")
ORACLE["reject_report"] = _with([*_PIPE, *_match("5e-1"), STATUS], """SELECT pid, original_trips, coalesce(kept_trips, 0) AS kept_trips,
  coalesce(processed_trips, 0) AS processed_trips, coalesce(one_match_trips, 0) AS one_match_trips, coalesce(no_match_trips, 0) AS no_match_trips
FROM (SELECT pid, count(DISTINCT trip) AS original_trips FROM pings GROUP BY pid)
LEFT JOIN (SELECT pid, count(DISTINCT trip) AS kept_trips FROM cleaned GROUP BY pid) USING (pid)
LEFT JOIN (SELECT pid, count(*) FILTER (status = 'ok') AS processed_trips, count(*) FILTER (status = 'one_match') AS one_match_trips,
  count(*) FILTER (status = 'no_match') AS no_match_trips FROM status GROUP BY pid) USING (pid)""")
ORACLE["interpolate_stops"] = _with(_interpolate("5e-1", True), _STOP_TIMES_SELECT)
ORACLE["interpolate_corrected"] = _with(_interpolate("-5e-1", False), _STOP_TIMES_SELECT)
ORACLE["leg_times"] = _with([*_PIPE, *_match("5e-1"),
    """al AS (SELECT *, sum(ft) OVER (PARTITION BY pid ORDER BY segments ROWS UNBOUNDED PRECEDING) AS fin FROM (
  SELECT *, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) * 3.280839895e0 AS ft FROM legs))""",
    """onleg AS (SELECT m.pid, m.trip, m.seg, m.data_time, a.segments, a.fin - a.ft
    + a.ft * CASE WHEN a.ft > 0 THEN greatest(0e0, least(1e0, ((m.x_m - x0) * (x1 - x0) + (m.y_m - y0) * (y1 - y0)) / ((x1 - x0) ** 2 + (y1 - y0) ** 2))) ELSE 0e0 END AS pos
  FROM matched m JOIN al a ON a.pid = m.pid AND a.segments = CAST(m.seg - 5e-1 AS BIGINT))""",
    """hop AS (SELECT *, lead(pos) OVER w AS pos2, lead(segments) OVER w AS seg2, date_diff('second', data_time, lead(data_time) OVER w) AS dt
  FROM onleg WINDOW w AS (PARTITION BY pid, trip ORDER BY seg))"""],
    """SELECT pid, segments, round(sum(c * dt / (pos2 - pos)), 3) AS seconds, round(sum(c), 3) AS feet, count(*) AS occurrences FROM (
  SELECT a.pid, a.segments, h.dt, h.pos, h.pos2, least(a.fin, h.pos2) - greatest(a.fin - a.ft, h.pos) AS c
  FROM hop h JOIN al a ON a.pid = h.pid AND a.segments BETWEEN h.segments AND h.seg2 WHERE h.pos2 > h.pos) WHERE c > 0 GROUP BY pid, segments""")
SHAPES = """shp AS (
  SELECT pid, 2 * j + c + 1 AS seq, lat + CASE c WHEN 0 THEN 2e-5 * (j % 4) ELSE 1e-5 * (j % 3) END AS lat, lon, j * 700e0 AS pdist, j
  FROM pts CROSS JOIN (SELECT CAST(range AS BIGINT) AS c FROM range(2))
  WHERE CAST(pid AS BIGINT) IN (SELECT 100 + o_orderkey % 60 FROM orders))"""
GSTOPS = """gst AS (SELECT pid, seq, stpid, lat, lon FROM pts WHERE stpid IS NOT NULL
  UNION ALL SELECT pid, seq, stpid || 'b', lat, lon FROM pts WHERE stpid IS NOT NULL AND seq % 9 = 4)"""
ORACLE["patterns_from_gtfs"] = _with([PINGS, POINTS, SHAPES, GSTOPS], """SELECT lpad(s.pid, 5, '0') AS pid, s.seq, CASE WHEN p.stpid IS NULL THEN 'W' ELSE 'S' END AS typ, p.stpid, s.pdist
FROM shp s LEFT JOIN gst p ON p.stpid IS NOT NULL AND p.lat = s.lat AND p.lon = s.lon""")
ORACLE["nearest_stop_points"] = _with([PINGS, POINTS, SHAPES, GSTOPS, _xy("sxy", "shp"), _xy("pxy", "gst"),
    """prs AS (SELECT s.pid, s.seq, p.stpid, sqrt((s.x_m - p.x_m) ** 2 + (s.y_m - p.y_m) ** 2) AS d FROM sxy s JOIN pxy p
  ON p.stpid IS NOT NULL AND p.seq > 2 AND abs(s.lat - p.lat) < 1e-3 WHERE sqrt((s.x_m - p.x_m) ** 2 + (s.y_m - p.y_m) ** 2) <= 5)""",
    "n1 AS (SELECT * FROM prs QUALIFY d = min(d) OVER (PARTITION BY pid, seq))",
    "n2 AS (SELECT * FROM n1 QUALIFY row_number() OVER (PARTITION BY pid, stpid ORDER BY d, seq) = 1)"],
    """SELECT lpad(s.pid, 5, '0') AS pid, s.seq, CASE WHEN n2.stpid IS NULL THEN 'W' ELSE 'S' END AS typ, n2.stpid, 'stop ' || n2.stpid AS stpnm
FROM shp s LEFT JOIN n2 ON n2.pid = s.pid AND n2.seq = s.seq""")
ORACLE["stop_pattern_catalogue"] = _with([GTRIPS], """SELECT DISTINCT route_id, CAST(CAST(right(shape_id, 5) AS INTEGER) AS VARCHAR) AS pid, CAST(l_partkey % 40 AS VARCHAR) AS stop_id,
  CAST(l_linenumber AS VARCHAR) AS stop_sequence FROM lineitem JOIN gtrips ON trip_id = CAST(l_orderkey AS VARCHAR)""")

# --- areas --------------------------------------------------------------------

AREAS = """area AS (SELECT n_name AS community, n_nationkey % 3 AS kind, -8.78e1 + 5e-2 * (n_nationkey % 5) AS x0, 4.17e1 + 5e-2 * (n_nationkey // 5) AS y0 FROM nation)"""


def _scatter(name: str, key: str, source: str, extra: str) -> str:
    return (
        f"{name} AS (SELECT {extra}, -8.78197e1 + 1e-3 * (({key} * 53) % 290) AS lon, "
        f"4.16903e1 + 1e-3 * (({key} * 37) % 270) AS lat FROM {source})"
    )


# Plain shape tests in place of ray casting.
_IN_AREA = """lon > x0 AND lon < x0 + 5e-2 AND lat > y0 AND lat < y0 + 5e-2
  AND NOT (kind = 0 AND lon > x0 + 2.5e-2 AND lat > y0 + 2.5e-2)
  AND NOT (kind = 2 AND lon > x0 + 2e-2 AND lon < x0 + 3e-2)
  AND NOT (kind = 1 AND lon > x0 + 1.25e-2 AND lon < x0 + 3.75e-2 AND lat > y0 + 1.25e-2 AND lat < y0 + 3.75e-2)"""
ASTOPS = _scatter("astop", "s_suppkey", "supplier", "CAST(s_suppkey AS VARCHAR) AS stop_id")
TRACTS = _scatter("tract", "c_custkey", "customer", "c_custkey % 1000 AS pop")
CORNERS = """corner AS (
  SELECT community, ring, i, x0 + dx AS lon, y0 + dy AS lat FROM area JOIN (VALUES
    (0, 0, 0, 0e0, 0e0), (0, 0, 1, 5e-2, 0e0), (0, 0, 2, 5e-2, 2.5e-2), (0, 0, 3, 2.5e-2, 2.5e-2), (0, 0, 4, 2.5e-2, 5e-2), (0, 0, 5, 0e0, 5e-2),
    (1, 0, 0, 0e0, 0e0), (1, 0, 1, 5e-2, 0e0), (1, 0, 2, 5e-2, 5e-2), (1, 0, 3, 0e0, 5e-2),
    (1, 1, 0, 1.25e-2, 1.25e-2), (1, 1, 1, 3.75e-2, 1.25e-2), (1, 1, 2, 3.75e-2, 3.75e-2), (1, 1, 3, 1.25e-2, 3.75e-2),
    (2, 0, 0, 0e0, 0e0), (2, 0, 1, 2e-2, 0e0), (2, 0, 2, 2e-2, 5e-2), (2, 0, 3, 0e0, 5e-2),
    (2, 2, 0, 3e-2, 0e0), (2, 2, 1, 5e-2, 0e0), (2, 2, 2, 5e-2, 5e-2), (2, 2, 3, 3e-2, 5e-2)) AS c(kind, ring, i, dx, dy) USING (kind))"""
EDGES = [
    CORNERS, _xy("cxy", "corner"),
    """edge AS (SELECT community, ring, x_m AS x0, y_m AS y0,
    coalesce(lead(x_m) OVER w, first_value(x_m) OVER w) AS x1, coalesce(lead(y_m) OVER w, first_value(y_m) OVER w) AS y1
  FROM cxy WINDOW w AS (PARTITION BY community, ring ORDER BY i))""",
]
ORACLE["stops_in_areas"] = _with([AREAS, ASTOPS], f"SELECT community, stop_id FROM area LEFT JOIN astop ON {_IN_AREA}")
ORACLE["area_counts_buffer"] = _with([AREAS, ASTOPS, *EDGES, _xy("sxy", "astop")], f"""SELECT community,
  (SELECT count(*) FROM astop WHERE {_IN_AREA}) AS n_stops_strict, coalesce(nb, 0) AS n_stops_buffer
FROM area LEFT JOIN (
  SELECT community, count(DISTINCT stop_id) AS nb FROM (
    SELECT e.community, s.stop_id FROM edge e CROSS JOIN sxy s WHERE {_dist('s.x_m', 's.y_m', 'e.x0', 'e.y0', 'e.x1', 'e.y1')} <= 1609.34e0 / 8
    UNION ALL SELECT community, stop_id FROM area JOIN astop ON {_IN_AREA}) GROUP BY community) USING (community)""")
ORACLE["population_by_area"] = _with([AREAS, TRACTS], f"SELECT community, CAST(coalesce(sum(pop), 0) AS BIGINT) AS pop FROM area LEFT JOIN tract ON {_IN_AREA} GROUP BY community")
_CLOSED = "lon AS x0, lat AS y0, coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS x1, coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS y1"
TRACT_AREAS = [
    _scatter("tbase", "c_custkey", "customer", "CAST(c_custkey AS VARCHAR) AS geoid, c_custkey % 1000 AS pop, c_custkey % 3 AS kind, "
             "CASE WHEN c_custkey % 50 = 0 THEN 8.31e-2 ELSE 3.1e-3 + 2e-4 * (c_custkey % 7) END AS r"),
    """tcorner AS (
  SELECT geoid, ring, i, tbase.lon + r * dx AS lon, tbase.lat + r * dy AS lat FROM tbase JOIN (
    SELECT kind, ring, i, mid + s * ux AS dx, s * uy AS dy FROM
      (VALUES (0, 0, 0e0, 1e0), (1, 0, 0e0, 1e0), (1, 1, 0e0, 5e-1), (2, 0, 0e0, 1e0), (2, 2, 3e0, 1e0)) AS a(kind, ring, mid, s),
      (VALUES (0, 1e0, 0e0), (1, 0e0, 1e0), (2, -1e0, 0e0), (3, 0e0, -1e0)) AS b(i, ux, uy)) USING (kind))""",
    f"tedge AS (SELECT geoid, {_CLOSED} FROM tcorner WINDOW w AS (PARTITION BY geoid, ring ORDER BY i))",
    f"aedge AS (SELECT community, {_CLOSED} FROM corner WINDOW w AS (PARTITION BY community, ring ORDER BY i))",
]


def _side(s: str, px: str, py: str) -> str:
    return f"sign(({s}.x1 - {s}.x0) * ({py} - {s}.y0) - ({s}.y1 - {s}.y0) * ({px} - {s}.x0))"


def _within(edges: str, key: str, px: str, py: str) -> str:
    """Whether a point crosses an odd number of a shape's edges to its right."""
    return f"""(SELECT count(*) FROM {edges} e WHERE e.{key} AND (e.y0 > {py}) <> (e.y1 > {py})
    AND {px} < (e.x1 - e.x0) * ({py} - e.y0) / (e.y1 - e.y0) + e.x0) % 2 = 1"""


MEET = [
    AREAS, CORNERS, *TRACT_AREAS,
    f"""meet AS (
  SELECT a.community, t.geoid FROM aedge a JOIN tedge t
    ON least(a.x0, a.x1) <= greatest(t.x0, t.x1) AND least(t.x0, t.x1) <= greatest(a.x0, a.x1)
    AND least(a.y0, a.y1) <= greatest(t.y0, t.y1) AND least(t.y0, t.y1) <= greatest(a.y0, a.y1)
    AND {_side('a', 't.x0', 't.y0')} * {_side('a', 't.x1', 't.y1')} <= 0 AND {_side('t', 'a.x0', 'a.y0')} * {_side('t', 'a.x1', 'a.y1')} <= 0
  UNION SELECT area.community, t.geoid FROM area JOIN tcorner t ON t.ring <> 1 AND t.i = 0 AND {_within('aedge', 'community = area.community', 't.lon', 't.lat')}
  UNION SELECT c.community, tbase.geoid FROM tbase JOIN corner c ON c.ring <> 1 AND c.i = 0
    AND abs(c.lon - tbase.lon) < 5 * r AND abs(c.lat - tbase.lat) < 5 * r AND {_within('tedge', 'geoid = tbase.geoid', 'c.lon', 'c.lat')})""",
]
ORACLE["tracts_meeting_areas"] = _with(MEET, "SELECT community, geoid FROM meet")
ORACLE["population_by_overlap"] = _with(MEET, """SELECT community, CAST(coalesce(sum(pop), 0) AS BIGINT) AS pop, count(geoid) AS tracts
FROM area LEFT JOIN (SELECT * FROM meet JOIN tbase USING (geoid)) USING (community) GROUP BY community""")
ORACLE["dissolved_areas"] = _with([
    AREAS, CORNERS,
    """snapped AS (
  SELECT n_regionkey AS region, community, ring, i, CAST(round(lon / 1e-9) AS BIGINT) AS x, CAST(round(lat / 1e-9) AS BIGINT) AS y
  FROM corner JOIN nation ON n_name = community)""",
    # Outlines are listed to the left, holes as well.
    """side AS (
  SELECT region, CASE ring WHEN 1 THEN d ELSE a END AS a, CASE ring WHEN 1 THEN e ELSE b END AS b, CASE ring WHEN 1 THEN a ELSE d END AS c, CASE ring WHEN 1 THEN b ELSE e END AS d
  FROM (SELECT region, ring, x AS a, y AS b, coalesce(lead(x) OVER w, first_value(x) OVER w) AS d, coalesce(lead(y) OVER w, first_value(y) OVER w) AS e
    FROM snapped WINDOW w AS (PARTITION BY community, ring ORDER BY i)))""",
    """stop_at AS (
  SELECT DISTINCT s.region, s.a, s.b, s.c, s.d, p.x, p.y, (p.x - s.a) * (s.c - s.a) + (p.y - s.b) * (s.d - s.b) AS far FROM side s
  JOIN (SELECT DISTINCT region, x, y FROM snapped) p ON p.region = s.region AND (s.c - s.a) * (p.y - s.b) = (s.d - s.b) * (p.x - s.a)
    AND p.x BETWEEN least(s.a, s.c) AND greatest(s.a, s.c) AND p.y BETWEEN least(s.b, s.d) AND greatest(s.b, s.d))""",
    """piece AS (
  SELECT DISTINCT region, x AS a, y AS b, c2 AS c, d2 AS d FROM (
    SELECT *, lead(x) OVER w AS c2, lead(y) OVER w AS d2 FROM stop_at WINDOW w AS (PARTITION BY region, a, b, c, d ORDER BY far)) WHERE c2 IS NOT NULL)""",
    """rim AS (
  SELECT row_number() OVER (ORDER BY region, a, b, c, d) AS id, * FROM piece p
  WHERE NOT EXISTS (SELECT 1 FROM piece q WHERE q.region = p.region AND q.a = p.c AND q.b = p.d AND q.c = p.a AND q.d = p.b))""",
    """follow AS (
  SELECT p.id, p.region, p.a, p.b, p.c, p.d, q.id AS nxt, (p.c - p.a) * (q.d - q.b) - (p.d - p.b) * (q.c - q.a) AS bend
  FROM rim p JOIN rim q ON q.region = p.region AND q.a = p.c AND q.b = p.d
  QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY atan2(CAST((p.c - p.a) * (q.d - q.b) - (p.d - p.b) * (q.c - q.a) AS DOUBLE),
    CAST((p.c - p.a) * (q.c - q.a) + (p.d - p.b) * (q.d - q.b) AS DOUBLE)) DESC) = 1)""",
    """tour AS (
  SELECT id AS start, id AS cur FROM follow
  UNION SELECT t.start, f.nxt FROM tour t JOIN follow f ON f.id = t.cur)""",
    """ringed AS (SELECT f.*, label FROM follow f JOIN (SELECT start, min(cur) AS label FROM tour GROUP BY start) ON start = f.id)""",
    """ring_sums AS (SELECT label, sum(CAST(a AS HUGEINT) * d - CAST(c AS HUGEINT) * b) AS twice, count(*) FILTER (bend <> 0) AS size FROM ringed GROUP BY label)""",
], "SELECT region, twice < 0 AS hole, CAST(size AS INTEGER) AS ring_size, c AS x, d AS y FROM ringed JOIN ring_sums USING (label) WHERE bend <> 0")
ORACLE["stops_per_capita"] = _with([AREAS, TRACTS, ASTOPS], f"""SELECT community, pop, n_stops, round(n_stops * 1000e0 / nullif(pop, 0), 6) AS stops_percap FROM (
  SELECT community, CAST(coalesce((SELECT sum(pop) FROM tract WHERE {_IN_AREA}), 0) AS BIGINT) AS pop,
    (SELECT count(*) FROM astop WHERE {_IN_AREA}) AS n_stops FROM area)""")
ORACLE["area_sizes"] = _with([AREAS, TRACTS, *EDGES], f"""SELECT community, round(area_m2, 1) AS area_m2, round(cx, 1) AS centroid_x, round(cy, 1) AS centroid_y, pop FROM (
  SELECT community, sum(CASE ring WHEN 1 THEN -a ELSE a END) AS area_m2,
    sum(CASE WHEN ring <> 1 THEN a * cx END) / sum(CASE WHEN ring <> 1 THEN a END) AS cx,
    sum(CASE WHEN ring <> 1 THEN a * cy END) / sum(CASE WHEN ring <> 1 THEN a END) AS cy
  FROM (SELECT community, ring, abs(sum(x0 * y1 - x1 * y0)) / 2 AS a,
      sum((x0 + x1) * (x0 * y1 - x1 * y0)) / (3 * sum(x0 * y1 - x1 * y0)) AS cx,
      sum((y0 + y1) * (x0 * y1 - x1 * y0)) / (3 * sum(x0 * y1 - x1 * y0)) AS cy
    FROM edge GROUP BY community, ring) GROUP BY community)
JOIN (SELECT community, CAST(coalesce(sum(pop), 0) AS BIGINT) AS pop FROM area LEFT JOIN tract ON {_IN_AREA} GROUP BY community) USING (community)""")
ORACLE["coverage_share"] = _with([AREAS, ASTOPS, *EDGES, _xy("sxy", "astop"),
    """box AS (SELECT community, min(floor(x_m / 100)) AS a, max(floor(x_m / 100)) AS b, min(floor(y_m / 100)) AS c, max(floor(y_m / 100)) AS d FROM cxy GROUP BY community)""",
    """grid AS (SELECT community, (gx + 5e-1) * 100 AS px, (gy + 5e-1) * 100 AS py FROM (
  SELECT community, unnest(range(CAST(a AS BIGINT), CAST(b AS BIGINT) + 1)) AS gx, c, d FROM box), unnest(range(CAST(c AS BIGINT), CAST(d AS BIGINT) + 1)) AS u(gy))""",
    """inn AS (SELECT g.community, px, py FROM grid g JOIN edge e ON e.community = g.community
  GROUP BY g.community, px, py HAVING count(*) FILTER ((e.y0 > py) <> (e.y1 > py) AND px < (e.x1 - e.x0) * (py - e.y0) / (e.y1 - e.y0) + e.x0) % 2 = 1)""",
    "dst AS (SELECT community, px, py, min(sqrt((px - x_m) ** 2 + (py - y_m) ** 2)) AS d FROM inn CROSS JOIN sxy GROUP BY community, px, py)"],
    "SELECT community, count(*) AS cells, " + ", ".join(
        f"round(count(*) FILTER (d <= {b} * 1609.34e0 / 8) / count(*), 6) AS percent_{b}b" for b in (1, 2, 3, 4)
    ) + " FROM dst GROUP BY community")

_LINE = "(j + 5e-1) * 2e1"
ORACLE["coverage_by_lines"] = _with([AREAS, ASTOPS, *EDGES, _xy("sxy", "astop"),
    f"""hits AS (
  SELECT community, j, (x1 - x0) * ({_LINE} - y0) / (y1 - y0) + x0 AS a FROM (
    SELECT *, unnest(range(CAST(floor(least(y0, y1) / 2e1) AS BIGINT), CAST(floor(greatest(y0, y1) / 2e1) AS BIGINT) + 1)) AS j FROM edge)
  WHERE (y0 > {_LINE}) <> (y1 > {_LINE}))""",
    """stretch AS (
  SELECT community, j, a, b FROM (SELECT *, lead(a) OVER w AS b, row_number() OVER w AS n FROM hits WINDOW w AS (PARTITION BY community, j ORDER BY a))
  WHERE n % 2 = 1 AND b > a)""",
    f"""chord AS (
  SELECT block, j, x_m - sqrt(r * r - ({_LINE} - y_m) ** 2) AS lo, x_m + sqrt(r * r - ({_LINE} - y_m) ** 2) AS hi FROM (
    SELECT DISTINCT x_m, y_m, block, r, unnest(range(CAST(floor((y_m - r) / 2e1) AS BIGINT), CAST(floor((y_m + r) / 2e1) AS BIGINT) + 1)) AS j
    FROM sxy CROSS JOIN (SELECT k AS block, k * (1609.34e0 / 8) AS r FROM (VALUES (1), (2), (3), (4)) AS v(k)))
  WHERE abs({_LINE} - y_m) < r)""",
    """adds AS (
  SELECT block, j, greatest(lo, coalesce(max(hi) OVER (PARTITION BY block, j ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lo)) AS lo, hi FROM chord)""",
    """got AS (
  SELECT community, block, sum(least(b, hi) - greatest(a, lo)) AS m FROM stretch JOIN adds ON stretch.j = adds.j AND lo < hi AND lo < b AND hi > a GROUP BY community, block)"""],
    "SELECT community, round(20 * total, 1) AS area_m2, " + ", ".join(
        f"round(coalesce((SELECT m FROM got WHERE got.community = s.community AND block = {b}), 0) / total, 6) AS percent_{b}b" for b in (1, 2, 3, 4)
    ) + " FROM (SELECT community, sum(b - a) AS total FROM stretch GROUP BY community) s")


def _utm16() -> str:
    """UTM zone 16 on WGS 84 by the same series, written out; degrees are those that went in."""
    n = 1 / 298.257223563 / (2 - 1 / 298.257223563)
    a1, a2 = n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440
    a3, a4 = 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280
    e, r = 2 * math.sqrt(n) / (1 + n), 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    v = lambda x: f"{x:.17e}"
    series = lambda f, g: " + ".join(f"{v(c)} * {f}(2 * {j} * xi) * {g}(2 * {j} * eta)" for j, c in enumerate((a1, a2, a3, a4), 1))
    return f"""SELECT ping_id, round(5e5 + {v(r)} * (eta + {series('cos', 'sinh')}), 3) AS x_m, round({v(r)} * (xi + {series('sin', 'cosh')}), 3) AS y_m,
  round(lat, 8) AS lat, round(lon, 8) AS lon FROM (
  SELECT *, atan2(t, cos(w)) AS xi, atanh(sin(w) / sqrt(1 + t * t)) AS eta FROM (
    SELECT *, radians(lon + 87) AS w, sinh(atanh(sin(radians(lat))) - {v(e)} * atanh({v(e)} * sin(radians(lat)))) AS t FROM pings))"""


ORACLE["projected_both_ways"] = _with([PINGS], _utm16())
ORACLE["stored_headways"] = _with([VA, _timed("tm", "va")], "SELECT rt, pid, stop_id, trip_id, stop_sequence AS event_id, time_till_next_bus FROM tm")

# --- reach --------------------------------------------------------------------

REACH = [VA, *_table("actual", "va", ["year"]),
    """path AS (
  SELECT rt, pid, stop_id, CAST(stop_id AS INTEGER) AS sq, sum(median_actual_time_to_previous_stop) OVER (PARTITION BY rt, pid ORDER BY CAST(stop_id AS INTEGER)) AS el,
    row_number() OVER (PARTITION BY rt, pid ORDER BY CAST(stop_id AS INTEGER)) AS ix FROM m_actual WHERE period_value = '2024')""",
]
_LABELS = [(5, "5 minutes"), (10, "10 minutes"), (15, "15 minutes"), (30, "30 minutes"), (60, "1 hour"), (90, "1 hour 30 minutes"), (120, "2 hours")]
BUDGET = "budget(minutes, time_label, time_rank) AS (VALUES " + ", ".join(f"({m}, '{l}', {i})" for i, (m, l) in enumerate(_LABELS)) + ")"
RB = """rb AS (
  SELECT o.rt, o.pid, o.stop_id AS origin_stop, o.sq AS from_sequence, minutes, time_label, time_rank, max(d.sq) AS to_sequence,
    CAST(count(*) AS INTEGER) AS stops_reached, max(d.el) - min(o.el) AS seconds_used
  FROM path o JOIN path d ON o.rt = d.rt AND o.pid = d.pid AND d.ix >= o.ix CROSS JOIN budget
  WHERE d.el - o.el <= minutes * 60 GROUP BY 1, 2, 3, 4, 5, 6, 7)"""
ORACLE["reach_budgets"] = _with([*REACH, BUDGET, RB], """SELECT rt, pid, origin_stop, from_sequence, minutes, time_label, time_rank,
  CAST(to_sequence AS VARCHAR) AS last_stop, to_sequence, stops_reached, round(seconds_used, 6) AS seconds_used, rt AS route FROM rb""")
ORACLE["reach_minutes"] = _with([*REACH, AREAS, ASTOPS, f"orig AS (SELECT DISTINCT stop_id FROM area JOIN astop ON {_IN_AREA})"],
    """SELECT o.rt, o.pid, o.stop_id AS origin_stop, d.stop_id, d.sq AS stop_sequence, round(d.el - o.el, 6) AS travel_seconds,
  CAST(floor((d.el - o.el) / 60) AS INTEGER) AS minutes, o.rt AS route
FROM path o JOIN orig USING (stop_id) JOIN path d ON o.rt = d.rt AND o.pid = d.pid AND d.ix >= o.ix""")
ORACLE["reach_paths"] = _with([*REACH, BUDGET, RB], """SELECT rb.rt, rb.pid, origin_stop, minutes,
  string_agg(v.stop_id || '/' || v.stop_id, ',' ORDER BY CAST(v.stop_id AS INTEGER)) AS path
FROM rb JOIN (SELECT DISTINCT pid, stop_id FROM va) v ON v.pid = rb.pid AND CAST(v.stop_id AS INTEGER) BETWEEN from_sequence AND to_sequence
GROUP BY rb.rt, rb.pid, origin_stop, minutes""")

# --- quality and audits -------------------------------------------------------

QCIN = """qcin AS (SELECT pid, trip_id AS trip, stop_sequence AS seg,
  CASE WHEN stop_sequence % 41 = 0 THEN NULL WHEN stop_sequence % 3 = 0 THEN date_trunc('day', bus_stop_time) ELSE bus_stop_time END AS t,
  stop_sequence % 160 AS mph FROM va)"""


def _checks(source: str, top: int) -> str:
    return f"""chk AS (
  SELECT pid, trip, max(mph) > {top} AS avg_speed_trips, count(*) > count(t) AS na_times_trips,
    count(DISTINCT t) + CASE WHEN count(*) > count(t) THEN 1 ELSE 0 END <> count(*) AS same_time_trips,
    coalesce(max(CASE WHEN a = 1 THEN t END) <> min(t) OR max(CASE WHEN z = 1 THEN t END) <> max(t)
      OR max(CASE WHEN a = 1 THEN t END) IS NULL OR max(CASE WHEN z = 1 THEN t END) IS NULL, TRUE) AS min_max_time_issue_trips,
    coalesce(date_diff('microsecond', min(t), max(t)) >= CAST(28801000000 AS BIGINT), FALSE) AS very_long_trips
  FROM (SELECT *, row_number() OVER (PARTITION BY pid, trip ORDER BY seg) AS a, row_number() OVER (PARTITION BY pid, trip ORDER BY seg DESC) AS z FROM {source})
  GROUP BY pid, trip)"""


_CHECKS = ["avg_speed_trips", "na_times_trips", "same_time_trips", "min_max_time_issue_trips", "very_long_trips"]
_QC = [VA, QCIN, _checks("qcin", 150)]
_LONG = "issues AS (" + " UNION ALL ".join(f"SELECT pid, '{c}' AS issue, trip FROM chk WHERE {c}" for c in _CHECKS) + ")"
ORACLE["qc_trips"] = _with(_QC, "SELECT pid, trip AS unique_trip_vehicle_day, " + ", ".join(_CHECKS) + " FROM chk")
ORACLE["qc_summary"] = _with(_QC, "SELECT pid, " + ", ".join(f"count(*) FILTER ({c}) AS {c}" for c in _CHECKS) + " FROM chk GROUP BY pid")
ORACLE["qc_examples"] = _with([*_QC, _LONG], """SELECT pid, issue, trip AS unique_trip_vehicle_day, example FROM (
  SELECT *, row_number() OVER (PARTITION BY pid, issue ORDER BY trip) AS example FROM issues) WHERE example <= 5""")
ORACLE["qc_error_rate"] = _with([*_QC, _LONG], """SELECT pid, total_trips, issues, round(issues / total_trips * 100, 6) AS perc
FROM (SELECT pid, count(*) AS issues FROM issues GROUP BY pid) JOIN (SELECT pid, count(*) AS total_trips FROM chk GROUP BY pid) USING (pid)""")
ORACLE["qc_stop_times"] = _with(
    [*_interpolate("5e-1", True), "qst AS (SELECT pid, trip, seg, make_timestamp(CAST(round(et * 1e6) AS BIGINT)) AS t, speed AS mph FROM timed)",
     _checks("qst", 75)],
    "SELECT pid, trip AS unique_trip_vehicle_day, coalesce(avg_speed_trips, FALSE) AS avg_speed_trips, " + ", ".join(_CHECKS[1:]) + " FROM chk")
ORACLE["qc_actual_without_schedule"] = _with(_both(["year_hour"]), "SELECT rt, pid, stop_id, period_value, " + " OR ".join(
    f"({s}_actual_{x} IS NOT NULL AND {s}_schedule_{x} IS NULL)" for s in _SHORT for x in (*_TIMES, "num_buses")
) + " AS actual_nulls_not_in_schedule FROM m")
PPT = "ppt AS (SELECT rt, pid, trip, count(*) AS n FROM pings GROUP BY rt, pid, trip)"
ORACLE["one_ping_share"] = _with([PINGS, PPT], """SELECT count(*) AS total_trips, count(*) FILTER (n = 1) AS single_row_trips,
  round(count(*) FILTER (n = 1) / count(*) * 100, 3) AS percentage_single_row_trips FROM ppt""")
ORACLE["one_ping_by_pattern"] = _with([PINGS, PPT], """SELECT rt, pid, count(*) FILTER (n = 1) AS single_row_trips,
  round(count(*) FILTER (n = 1) / count(*) * 100, 6) AS percentage_single_row_trips FROM ppt GROUP BY rt, pid""")
ORACLE["pings_per_pattern"] = _with([PINGS, POINTS, PPT], """SELECT rt, pid, count, mean, stops FROM (SELECT rt, pid, count(*) AS count, round(avg(n), 6) AS mean FROM ppt GROUP BY rt, pid)
LEFT JOIN (SELECT pid, count(*) FILTER (typ = 'S') AS stops FROM pts GROUP BY pid) USING (pid)""")
GAPS = "gaps AS (SELECT *, date_diff('second', lag(data_time) OVER (PARTITION BY pid, trip ORDER BY data_time, ping_id), data_time) AS gap_seconds FROM pings)"
ORACLE["ping_gap"] = _with([PINGS, GAPS], "SELECT pid, trip AS unique_trip_vehicle_day, round(avg(gap_seconds), 6) AS avg_time FROM gaps GROUP BY pid, trip HAVING count(*) > 1")
ORACLE["ping_steps"] = _with([PINGS, GAPS], "SELECT ping_id, gap_seconds FROM gaps")
ORACLE["missing_patterns"] = _with([PINGS, KNOWN], "SELECT DISTINCT pid FROM pings WHERE pid NOT IN (SELECT pid FROM known)")
ORACLE["pattern_sets"] = _with([PINGS, KNOWN, "hist AS (SELECT DISTINCT CAST(100 + o_orderkey % 60 AS VARCHAR) AS pid FROM orders)"], """SELECT pid,
  pid IN (SELECT pid FROM pings) AS seen, pid IN (SELECT pid FROM known) AS current, pid IN (SELECT pid FROM hist) AS historic
FROM (SELECT pid FROM pings UNION SELECT pid FROM known UNION SELECT pid FROM hist)""")
ORACLE["pings_without_pattern"] = _with([PINGS, KNOWN], "SELECT ping_id, pid FROM pings WHERE pid NOT IN (SELECT pid FROM known)")
RECON = [PINGS, KNOWN, *CLEAN, """recon AS (
  SELECT rt, pid, og_trips, coalesce(actual_trips, 0) AS actual_trips,
    CASE WHEN coalesce(actual_trips, 0) <> 0 THEN og_trips - actual_trips ELSE 0 END AS missing_trips_errors,
    CASE WHEN coalesce(actual_trips, 0) = 0 THEN og_trips ELSE 0 END AS missing_trips_missing_pids
  FROM (SELECT rt, pid, count(DISTINCT trip) AS og_trips FROM pings GROUP BY rt, pid)
  LEFT JOIN (SELECT rt, pid, count(DISTINCT trip) AS actual_trips FROM cleaned WHERE pid IN (SELECT pid FROM known) GROUP BY rt, pid) USING (rt, pid))"""]
ORACLE["trip_reconciliation"] = _with(RECON, "SELECT * FROM recon")
ORACLE["worst_routes"] = _with(RECON, "SELECT * FROM recon ORDER BY missing_trips_errors DESC, rt, pid LIMIT 20")
ORACLE["losses_by_route"] = _with(RECON, """SELECT *, round(missing_trips_missing_pids / og_trips * 100, 6) AS missing_pid_percent, round(missing_trips_errors / og_trips * 100, 6) AS error_percent FROM (
  SELECT rt, CAST(sum(missing_trips_errors) AS BIGINT) AS missing_trips_errors, CAST(sum(missing_trips_missing_pids) AS BIGINT) AS missing_trips_missing_pids,
    CAST(sum(og_trips) AS BIGINT) AS og_trips, CAST(sum(actual_trips) AS BIGINT) AS actual_trips, string_agg(DISTINCT pid, ',' ORDER BY pid) AS pids FROM recon GROUP BY rt)""")
ORACLE["run_stats"] = _with([VA, QCIN], """SELECT count(*) AS total_rows, count(DISTINCT trip) AS total_trips, count(DISTINCT pid) AS total_pids,
  count(DISTINCT CAST(t AS DATE)) AS total_days, CAST(max(CAST(t AS DATE)) AS VARCHAR) AS max_date FROM qcin""")
ORACLE["rt_pid_xwalk"] = _with([PINGS, VS], "SELECT rt, pid FROM vs UNION SELECT rt, pid FROM pings")
ORACLE["trips_per_pattern"] = _with([PINGS, PPT], "SELECT pid, count(*) AS count FROM ppt GROUP BY pid")

# --- sources, sinks, exports --------------------------------------------------

ORACLE["snapshot_explode"] = _with([PINGS], """SELECT CAST(vid AS VARCHAR) AS vid, tmstmp, lat, lon, pid || '.0' AS pid, rt, dly, tatripid,
  'poll-' || CAST(ping_id AS VARCHAR) AS scrape_file, strftime(data_time, '%Y-%m-%d %H:%M:%S') AS data_time, hour(data_time) AS data_hour,
  CAST(data_date AS VARCHAR) AS data_date FROM pings""")
ORACLE["snapshot_errors"] = _with([PINGS], "SELECT rt, 'No data found for parameter' AS msg, 'poll-' || CAST(ping_id AS VARCHAR) AS scrape_file FROM pings WHERE ping_id % 113 = 0")
ORACLE["points_json"] = _with([PINGS], "SELECT vid AS id, strftime(data_time, '%Y-%m-%d %H:%M:%S') AS tmstmp, dly AS delayed, round(lat, 6) AS lat, round(lon, 6) AS lon FROM pings")
ORACLE["trip_trace"] = _with([PINGS, VA], """SELECT rt, pid, stpid, trip_id, type, strftime(t, '%H:%M:%S') AS bus_stop_time, CAST(CAST(t AS DATE) AS VARCHAR) AS bus_stop_date FROM (
  SELECT rt, pid, CAST(NULL AS VARCHAR) AS stpid, trip AS trip_id, 'B' AS type, data_time AS t FROM pings
  UNION ALL SELECT rt, pid, stop_id, trip_id, 'S', date_trunc('second', bus_stop_time + INTERVAL 500 MILLISECOND) FROM va)""")
ORACLE["append_merge"] = _with([VA, VS], """SELECT CAST(day AS VARCHAR) AS day, rt, count(*) AS rows, count(DISTINCT trip_id) AS trips, max(pid) AS max_pid FROM (
  SELECT *, CAST(bus_stop_time AS DATE) AS day FROM va WHERE CAST(bus_stop_time AS DATE) NOT IN (SELECT CAST(bus_stop_time AS DATE) FROM vs WHERE bus_stop_time >= DATE '2024-01-16')
  UNION ALL SELECT *, CAST(bus_stop_time AS DATE) FROM vs WHERE bus_stop_time >= DATE '2024-01-16') GROUP BY 1, 2""")
ORACLE["union_all_append"] = _with([VA, VS], "SELECT rt, pid, count(*) AS rows FROM (SELECT * FROM va UNION ALL SELECT * FROM vs) GROUP BY rt, pid")
ORACLE["split_by_pattern"] = _with([PINGS], "SELECT pid, CAST(CAST(data_time AS DATE) AS VARCHAR) AS day, count(*) AS pings FROM pings GROUP BY 1, 2")
DAYS = "wanted AS (SELECT CAST(DATE '2023-12-25' + CAST(range AS INTEGER) AS DATE) AS d FROM range(40))"
ORACLE["missing_days"] = _with([PINGS, DAYS], "SELECT CAST(d AS VARCHAR) AS data_date FROM wanted WHERE d NOT IN (SELECT data_date FROM pings)")
ORACLE["day_report"] = _with([PINGS, DAYS], """SELECT CAST(d AS VARCHAR) AS data_date, coalesce(n, 0) AS rows, CASE WHEN n > 0 THEN 'success' ELSE 'failed' END AS status
FROM wanted LEFT JOIN (SELECT data_date AS d, count(*) AS n FROM pings GROUP BY 1) USING (d)""")
ORACLE["high_water_mark"] = _with([PINGS], "SELECT CAST(max(data_date) AS VARCHAR) AS max_date, CAST(max(data_date) + 1 AS VARCHAR) AS next_date FROM pings")
ORACLE["segment_times_bucketed"] = _with([VA, _timed("tm", "va")], "SELECT rt, trip_id, stop_sequence, time_to_previous_stop, cum_trip_time FROM tm")
ORACLE["incomplete_feeds"] = _with([PINGS, GTRIPS], """SELECT feed_id, CASE WHEN NOT in_shapes THEN 'shapes' ELSE 'trips' END AS missing FROM (
  SELECT feed_id, bool_or(t = 'shapes') AS in_shapes, bool_or(t = 'trips') AS in_trips FROM (
    SELECT shape_id AS feed_id, 'trips' AS t FROM gtrips
    UNION ALL SELECT '6430' || lpad(pid, 5, '0'), 'shapes' FROM pings) GROUP BY feed_id)
WHERE NOT (in_shapes AND in_trips)""")
ORACLE["streamed_hourly_pings"] = _with([PINGS], """SELECT strftime(date_trunc('hour', data_time), '%Y-%m-%d %H') AS hour, rt, count(*) AS pings
FROM (SELECT DISTINCT vid, tmstmp, rt, data_time FROM pings) GROUP BY 1, 2""")
ORACLE["first_candidates"] = _with([PINGS, POINTS, *LEGS, _xy("gxy", "pings"), NEAR], "SELECT ping_id, min(seg_combined) AS seg_combined FROM near GROUP BY ping_id")
ORACLE["metrics_from_pings"] = _with(
    [*_interpolate("5e-1", True),
     """vp AS (SELECT two.rt, pid, stpid AS stop_id, trip AS trip_id, s AS stop_sequence,
  date_trunc('second', make_timestamp(CAST(round(et * 1e6) AS BIGINT) + 370000)) AS bus_stop_time
FROM timed JOIN two USING (pid, trip) WHERE et IS NOT NULL)""", *_table("actual", "vp", ["hour"])],
    "SELECT * FROM m_actual")
ORACLE["trip_stop_geometry"] = _with([PINGS, POINTS], """SELECT g.ping_id, g.stpid, round(p.lat, 6) AS lat, round(p.lon, 6) AS lon FROM (
  SELECT ping_id, pid, CAST(CAST(pid AS BIGINT) * 100 - 9000 + ping_id % 26 AS VARCHAR) AS stpid FROM pings) g
LEFT JOIN pts p ON p.pid = g.pid AND p.stpid = g.stpid""")
ORACLE["community_stops"] = _with([AREAS, ASTOPS], f"SELECT community, stop_id FROM area JOIN astop ON {_IN_AREA}")
ORACLE["stops_of_one_community"] = _with([AREAS, ASTOPS], f"SELECT community, stop_id FROM area JOIN astop ON {_IN_AREA} WHERE community = 'NATION_7'")
ORACLE["reach_with_catalogue"] = _with([*REACH, BUDGET, RB], """SELECT rt, rb.pid, origin_stop, CAST(to_sequence AS VARCHAR) AS last_stop, c.route
FROM rb LEFT JOIN (
  SELECT CAST(o_orderkey % 5 AS VARCHAR) AS pid, CAST(l_partkey % 40 AS VARCHAR) AS stop_id, min('R' || CAST(o_custkey % 25 AS VARCHAR)) AS route
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) c ON c.pid = rb.pid AND c.stop_id = origin_stop WHERE minutes = 15""")
ORACLE["reach_segments"] = _with([*REACH, AREAS, ASTOPS, f"orig AS (SELECT DISTINCT stop_id FROM area JOIN astop ON {_IN_AREA})",
    "vpt AS (SELECT DISTINCT pid, CAST(stop_id AS INTEGER) AS sq, CAST(stop_id AS INTEGER) * 2e-3 + 4.18e1 AS lat, CAST(stop_id AS INTEGER) * -1e-3 - 8.76e1 AS lon FROM va)",
    _xy("vxy", "vpt"),
    """vleg AS (SELECT pid, sq, coalesce(sqrt((x_m - lag(x_m) OVER w) ** 2 + (y_m - lag(y_m) OVER w) ** 2), 0) * 3.280839895e0 AS ft
  FROM vxy WINDOW w AS (PARTITION BY pid ORDER BY sq))"""],
    """SELECT o.rt, o.pid, o.stop_id AS origin_stop, d.stop_id, CAST(floor((d.el - o.el) / 60) AS INTEGER) AS minutes, round(ft, 2) AS length_ft
FROM path o JOIN orig USING (stop_id) JOIN path d ON o.rt = d.rt AND o.pid = d.pid AND d.ix >= o.ix JOIN vleg v ON v.pid = d.pid AND v.sq = d.sq""")
ORACLE["unreadable_snapshots"] = "SELECT 'poll-' || CAST(event_id AS VARCHAR) AS scrape_file FROM events WHERE CAST(event_id AS VARCHAR) LIKE '%77'"
ORACLE["visits_on_day"] = _with([VA], """SELECT rt, pid, stop_id, trip_id, CAST(stop_sequence AS VARCHAR) AS stop_sequence FROM va
WHERE CAST(bus_stop_time AS DATE) = DATE '2024-01-18'""")

# --- what is written comes back -----------------------------------------------

ORACLE["pings_csv"] = _with([PINGS], "SELECT vid, tmstmp, lat, lon, CAST(pid AS BIGINT) AS pid, rt, dly, tatripid, CAST(data_date AS VARCHAR) AS data_date FROM pings")
ORACLE["pings_by_pattern"] = _with([PINGS], "SELECT ping_id, vid, pid FROM pings")
ORACLE["pulls_by_day"] = _with([PINGS], """SELECT ping_id, CAST(CAST(data_time AS DATE) AS VARCHAR) AS day,
  CASE ping_id % 2 WHEN 0 THEN '2024-02-01' ELSE '2024-02-02' END AS pull_date FROM pings""")
ORACLE["published_versions"] = _with([ASTOPS], "SELECT stop_id, lon, lat, '2024-02-01' AS latest, '2024-01-01' AS previous FROM astop")
ORACLE["gtfs_feeds"] = _with([GTRIPS], "SELECT 'feed' || service_id AS feed_id, trip_id, route_id, shape_id, service_id, CAST(NULL AS VARCHAR) AS schd_trip_id FROM gtrips")
ORACLE["feed_catalogue"] = """SELECT CAST(o_orderkey AS VARCHAR) || v AS sha1, CAST(d AS VARCHAR) AS earliest_calendar_date FROM (
  SELECT o_orderkey, v, CAST(DATE '2022-01-01' + CAST(o_orderkey % 700 + plus AS INTEGER) AS DATE) AS d FROM orders CROSS JOIN (VALUES ('a', 0), ('b', 90)) AS t(v, plus))
WHERE d >= DATE '2023-01-01'"""
ORACLE["pattern_inventory"] = _with([PINGS], "SELECT DISTINCT pid FROM pings")
ORACLE["points_json_file"] = ORACLE["points_json"]
ORACLE["areas_geojson"] = _with([AREAS, ASTOPS], f"SELECT community, stop_id, CASE kind WHEN 2 THEN 2 ELSE 1 END AS parts FROM area LEFT JOIN astop ON {_IN_AREA}")
ORACLE["stops_csv"] = _with([ASTOPS], "SELECT stop_id, lon, lat FROM astop")
ORACLE["file_keys"] = _with([PINGS, POINTS], "SELECT pid, seq FROM pts")
ORACLE["incremental_append"] = _with(_interpolate("5e-1", True), """SELECT trip AS unique_trip_vehicle_day, pid || '-' || stpid AS p_stp_id, CAST(data_date AS VARCHAR) AS service_date,
  strftime(make_timestamp(CAST(round(et * 1e6) AS BIGINT) + 370000), '%Y-%m-%d %H:%M:%S') AS bus_stop_time, round(speed, 4) AS speed_mph
FROM timed JOIN two USING (pid, trip) JOIN (SELECT DISTINCT trip, data_date FROM pings) USING (trip)""")
ORACLE["incremental_metrics"] = _with(
    [VA, VS, """vi AS (SELECT * FROM va WHERE bus_stop_time < DATE '2024-01-16' UNION ALL SELECT * FROM vs WHERE bus_stop_time >= DATE '2024-01-16')""",
     *_table("actual", "vi", _LIVE)], "SELECT * FROM m_actual")
