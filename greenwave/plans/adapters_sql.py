"""The same domain tables as common table expressions, for checking results in plain SQL."""

from __future__ import annotations

import re

from greenwave.sources.adapters import EVENT_SLOTS

PHASE = "CASE l_linenumber % 4 WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 6 ELSE 8 END"
WEEK = "CAST(trunc(date_diff('day', DATE '2016-12-25', {d}) / 7.0) AS INTEGER)"
DOW = "CAST(dayofweek({d}) + 1 AS INTEGER)"
SHIFTED = "CAST(CAST({c} AS DATE) + 9131 AS DATE)"


def week(d: str) -> str:
    return WEEK.format(d=d)


def dow(d: str) -> str:
    return DOW.format(d=d)


def _slot(i: int) -> str:
    return f"[{', '.join(str(s[i]) for s in EVENT_SLOTS)}][event_id % {len(EVENT_SLOTS)} + 1]"


ADAPTERS: dict[str, str] = {
    "ev0": """SELECT event_id, ts, event_type, value, user_id, CAST(user_id // 5 + 1 AS INTEGER) AS SignalID,
        TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) // 10) AS "Timestamp",
        CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events""",
    "controller_events": f"""SELECT SignalID, "Timestamp", EventCode, CAST(CASE WHEN EventCode = 132 AND SignalID % 3 = 0 THEN 0 ELSE a + s * (k * m % d) END AS INTEGER) AS EventParam,
        CAST("Timestamp" AS DATE) AS date FROM (SELECT *, {_slot(0)} AS EventCode, {_slot(1)} AS a, {_slot(2)} AS s, {_slot(3)} AS m, {_slot(4)} AS d FROM ev0)""",
    "ramp_events": """SELECT SignalID, "Timestamp", CASE event_type WHEN 'click' THEN 1058 WHEN 'view' THEN 1371
        WHEN 'purchase' THEN 1372 WHEN 'signup' THEN 1373 ELSE 1013 END AS EventCode, k % 60 AS EventParam FROM ev0""",
    "camera_log": """SELECT 'CAM-' || CAST(user_id // 2 AS VARCHAR) AS CameraID, ts AS "Timestamp", CAST(ts AS DATE) AS Date,
        CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS Size FROM ev0""",
    "cam_config": """SELECT 'CAM-' || CAST(user_id // 2 AS VARCHAR) AS CameraID, min(SignalID) AS SignalID,
        'Location CAM-' || CAST(user_id // 2 AS VARCHAR) AS Location, DATE '2024-01-03' AS As_of_Date FROM ev0 GROUP BY user_id // 2""",
    "line": f"""SELECT CAST(l_suppkey // 5 + 1 AS INTEGER) AS SignalID, l_linenumber AS Detector, {PHASE} AS CallPhase,
        l_suppkey, l_orderkey, l_partkey, l_quantity, l_discount, l_tax, l_returnflag,
        TIMESTAMP '2024-01-17 00:00:00' + to_minutes(15 * date_diff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE))) AS quarter_hour,
        TIMESTAMP '2024-01-17 00:00:00' + to_hours(date_diff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE))) AS hour_ts,
        {SHIFTED.format(c='l_shipdate')} AS Date,
        CAST({SHIFTED.format(c='l_shipdate')} AS TIMESTAMP) + to_hours(l_orderkey % 24) AS Date_Hour FROM lineitem""",
    "counts_15min": """SELECT SignalID, quarter_hour AS Timeperiod, Detector, CallPhase, CAST(sum(l_quantity * 5) AS BIGINT) AS vol
        FROM line GROUP BY ALL""",
    "counts_1hr": """SELECT SignalID, date_trunc('hour', quarter_hour) AS Timeperiod, Detector, CallPhase, CAST(sum(l_quantity * 5) AS BIGINT) AS vol
        FROM line GROUP BY ALL""",
    "metrics_hourly": f"""SELECT SignalID, CallPhase, Date, Date_Hour,
        CASE WHEN sum(Detector) % 11 <> 0 THEN avg(l_discount) * 10 END AS aog, CASE WHEN sum(Detector) % 11 <> 0 THEN avg(l_tax) * 20 END AS pr,
        sum(l_quantity) AS vol, avg(l_discount) AS sf_freq, avg(l_tax) AS qs_freq, CAST(count(*) AS DOUBLE) AS cycles,
        sum(l_quantity * 3) AS paph, {week('Date')} AS Week, {dow('Date')} AS DOW FROM line GROUP BY SignalID, CallPhase, Date, Date_Hour""",
    "metrics_daily": f"""SELECT SignalID, CallPhase, Date, CASE WHEN sum(Detector) % 13 <> 0 THEN sum(l_quantity) END AS vpd,
        sum(l_quantity * 2) AS papd, max(l_quantity) * 4 AS vph, avg(l_discount * 10) AS uptime, CAST(count(*) AS DOUBLE) AS "all",
        {week('Date')} AS Week, {dow('Date')} AS DOW FROM line GROUP BY SignalID, CallPhase, Date""",
    "det_config": """SELECT DISTINCT SignalID, Detector, CallPhase, Detector % 3 AS CountPriority, CAST(Detector * 0.5 AS DOUBLE) AS TimeFromStopBar,
        CASE WHEN Detector <> 5 THEN CAST(Detector * 20.0 AS DOUBLE) END AS DistanceFromStopBar,
        CASE WHEN Detector % 2 = 0 THEN 'NB Mainline' ELSE 'EB Side' END AS ApproachDesc, Detector AS LaneNumber,
        CASE Detector % 4 WHEN 0 THEN 'Advanced Count' WHEN 1 THEN 'Stop Bar Presence' WHEN 2 THEN 'Advanced Count, Advanced Speed' ELSE 'Exit' END
        AS DetectionTypeDesc FROM line""",
    "presses": f"""SELECT CAST(l_suppkey // 5 + 1 AS INTEGER) AS SignalID, l_linenumber AS Detector, {PHASE} AS CallPhase, l_quantity,
        CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE)) // 5 AS INTEGER) AS DATE) AS Date, l_orderkey % 24 AS h FROM lineitem""",
    "ped_daily": "SELECT SignalID, Detector, CallPhase, Date, sum(l_quantity) AS papd FROM presses GROUP BY ALL",
    "ped_hourly": "SELECT SignalID, Detector, CallPhase, Date, CAST(Date AS TIMESTAMP) + to_hours(h) AS Hour, sum(l_quantity) * 8 AS paph FROM presses GROUP BY ALL",
    "travel_times": """SELECT 'Corridor ' || CAST(l_suppkey // 10 AS VARCHAR) AS Corridor, CAST(l_suppkey // 5 AS VARCHAR) || '-' || CAST(Detector AS VARCHAR) AS tmc_code, hour_ts AS Hour,
        1.0 + l_tax * 10 AS miles, CAST(30 + Detector AS DOUBLE) AS reference_speed, l_quantity / 5 + 1.0 AS travel_time_minutes,
        l_quantity + 10.0 AS speed FROM line""",
    "segments": """SELECT DISTINCT CAST(l_suppkey // 5 AS VARCHAR) || '-' || CAST(Detector AS VARCHAR) AS tmc_code, 'Corridor ' || CAST(l_suppkey // 10 AS VARCHAR) AS Corridor,
        CASE WHEN Detector = 7 THEN 'None' ELSE 'Sub ' || CAST(l_suppkey // 5 AS VARCHAR) END AS Subcorridor, CAST(0.5 + Detector * 0.25 AS DOUBLE) AS miles FROM line""",
    "delay_costs": f"""SELECT 'Zone ' || CAST(o_custkey // 100 % 5 AS VARCHAR) AS Zone, 'Corridor ' || CAST(o_custkey // 100 AS VARCHAR) AS Corridor,
        CAST({SHIFTED.format(c='o_orderdate')} AS TIMESTAMP) + to_hours(o_orderkey % 24) AS date, o_totalprice AS delay_cost FROM orders""",
    "health_input": """SELECT Zone_Group, Zone, Corridor, Subcorridor, Month, SignalID % 6 + 1 AS Context, round(d * 12, 4) AS du, round(x * 16, 4) AS pau, round(0.92::DOUBLE + x, 4) AS cu,
        CASE WHEN s % 5 <> 0 THEN round(d * 14, 4) END AS cctv, CASE WHEN s % 3 <> 0 THEN n % 12 END AS flash_events, CASE WHEN s % 7 <> 0 THEN round(0.9::DOUBLE + d * 4, 4) END AS pr,
        round(q * 6, 4) AS pd, round(x * 5, 4) AS sf_freq, CASE WHEN s % 11 <> 0 THEN round(1 + d * 10, 4) END AS tti, round(1 + d * 10 + x * 3, 4) AS pti,
        CASE WHEN s % 4 <> 0 THEN round(q / 5, 4) END AS cri, round(q * 18, 4) AS kabco, round(0.8::DOUBLE + d * 6, 4) AS rsi, round(x * 15, 4) AS bpsi
        FROM (SELECT SignalID, CAST(date_trunc('month', Date) AS DATE) AS Month, avg(l_discount) AS d, avg(l_tax) AS x, avg(l_quantity) AS q, count(*) AS n, sum(Detector) AS s FROM line GROUP BY ALL) JOIN corridors USING (SignalID)""",
    "corridors": """SELECT CAST(s_suppkey // 5 + 1 AS INTEGER) AS SignalID, r_name AS Zone_Group, n_name AS Zone,
        'Corridor ' || CAST(s_suppkey // 10 AS VARCHAR) AS Corridor, 'Sub ' || CAST(s_suppkey // 5 AS VARCHAR) AS Subcorridor,
        min(s_name) AS Name, CASE WHEN (s_suppkey // 5 + 1) % 4 = 0 THEN DATE '2024-01-20' ELSE DATE '2000-01-01' END AS "Asof",
        CAST(33.0 + (s_suppkey // 5 + 1) * 0.01 AS DOUBLE) AS Latitude, CAST(-84.0 - (s_suppkey // 5 + 1) * 0.01 AS DOUBLE) AS Longitude,
        CAST(s_suppkey // 5 + 1 AS VARCHAR) || ': ' || min(s_name) AS Description
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY s_suppkey // 5, s_suppkey // 10, r_name, n_name""",
    "speed_limits": """SELECT DISTINCT 'Corridor ' || CAST(s_suppkey // 10 AS VARCHAR) AS Corridor,
        CAST(30 + s_suppkey // 10 % 4 * 5 AS DOUBLE) AS Speed_Limit FROM supplier""",
    "locations": """SELECT c_custkey AS LocationId, CAST(33.01 + (c_custkey // 50) * 0.01 + (c_custkey % 7) * 0.0002 AS DOUBLE) AS Latitude,
        CAST(-84.01 - (c_custkey // 50) * 0.01 AS DOUBLE) AS Longitude, c_name AS Custom_Identifier FROM customer""",
    "tasks": f"""SELECT o_orderkey AS TaskID, CAST(o_custkey // 50 + 1 AS INTEGER) AS SignalID, o_orderpriority AS Priority,
        CASE o_orderstatus WHEN 'F' THEN 'Repair' WHEN 'O' THEN 'Inspect' ELSE 'Other' END AS Task_Type,
        CASE WHEN o_orderkey % 5 <> 0 THEN 'Sub ' || CAST(o_orderkey % 5 AS VARCHAR) END AS Task_Subtype,
        CASE WHEN o_orderkey % 3 = 0 THEN 'Field' ELSE 'Desk' END AS Task_Source, {SHIFTED.format(c='o_orderdate')} AS Date_Reported,
        CASE WHEN o_orderstatus <> 'O' THEN CAST({SHIFTED.format(c='o_orderdate')} + CAST(o_orderkey % 120 AS INTEGER) AS DATE) END AS Date_Resolved FROM orders""",
    "crashes": f"""SELECT CAST(o_custkey // 50 + 1 AS INTEGER) AS SignalID, CAST(date_trunc('month', {SHIFTED.format(c='o_orderdate')}) AS DATE) AS Month,
        count(*) FILTER (o_orderpriority = '1-URGENT') AS crashes_k, count(*) FILTER (o_orderpriority = '2-HIGH') AS crashes_a,
        count(*) FILTER (o_orderpriority = '3-MEDIUM') AS crashes_b, count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS crashes_c,
        count(*) FILTER (o_orderpriority = '5-LOW') AS crashes_o, count(*) AS crashes_total, sum(o_totalprice) AS cost FROM orders GROUP BY 1, 2""",
}


def with_adapters(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a statement with the adapter expressions it (transitively) names."""
    known = {**ADAPTERS, **(extra or {})}
    order: list[str] = []

    def visit(text: str, me: str | None = None):
        words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text))
        for name in known:
            if name in words and name != me and name not in order:
                visit(known[name], name)
                order.append(name)

    visit(sql)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({known[n]})" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
