"""Alert and ramp-meter queries."""

from pyspark.sql import functions as F

from greenwave.operators import alerts as al, counts as ct, ramp as rp, uptime as up
from greenwave.plans.catalog.counts import FILTERED_SQL, filtered
from greenwave.plans.catalog.ped_uptime import CAM, PAU, cams, pau
from greenwave.operators import ped
from greenwave.plans.registry import register

AL = {**FILTERED_SQL, **PAU, **CAM,
      "a_det": """SELECT Zone_Group, Zone, Corridor, CAST(b.SignalID AS VARCHAR) AS SignalID, CAST(d.CallPhase AS VARCHAR) AS CallPhase, CAST(b.Detector AS VARCHAR) AS Detector, Date, Name,
        'Bad Vehicle Detection' AS Alert, CASE WHEN ApproachDesc IS NULL THEN '' ELSE trim(ApproachDesc) || ' Lane ' || CAST(LaneNumber AS VARCHAR) END AS ApproachDesc
        FROM (SELECT DISTINCT SignalID, Detector, Date FROM filtered_1hr WHERE Good_Day = 0) b LEFT JOIN det_config d ON b.SignalID = d.SignalID AND b.Detector = d.Detector JOIN corridors c ON b.SignalID = c.SignalID""",
      "a_ped": """SELECT Zone_Group, Zone, Corridor, CAST(p.SignalID AS VARCHAR) AS SignalID, CAST(NULL AS VARCHAR) AS CallPhase, CAST(Detector AS VARCHAR) AS Detector, Date, Name, 'Bad Ped Pushbuttons' AS Alert,
        CAST(NULL AS VARCHAR) AS ApproachDesc FROM pau p LEFT JOIN corridors c ON p.SignalID = c.SignalID WHERE uptime = 0""",
      "a_cam": """SELECT Zone_Group, Zone, Corridor, a.CameraID AS SignalID, '0' AS CallPhase, '0' AS Detector, Date, Location AS Name, 'No Camera Image' AS Alert, CAST(NULL AS VARCHAR) AS ApproachDesc
        FROM (SELECT CameraID, Date FROM activity WHERE Size = 0) a JOIN camtree c ON a.CameraID = c.CameraID WHERE Date > As_of_Date"""}
TODAY = "2024-06-01"


def streaks(src):
    return f"""SELECT * FROM (WITH d AS (SELECT DISTINCT * FROM (SELECT * REPLACE (coalesce(CAST(Detector AS VARCHAR), '0') AS Detector, coalesce(CAST(CallPhase AS VARCHAR), '0') AS CallPhase) FROM ({src}) WHERE Corridor IS NOT NULL) WHERE Date > DATE '{TODAY}' - 180),
    e AS (SELECT * REPLACE (coalesce(first_value(ApproachDesc IGNORE NULLS) OVER (PARTITION BY SignalID, Detector ORDER BY Alert, CallPhase NULLS FIRST, Date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), '') AS ApproachDesc) FROM d),
    r1 AS (SELECT *, max(ApproachDesc) OVER (PARTITION BY SignalID, Detector) AS txt FROM e WHERE Zone = 'Ramp Meters'),
    r2 AS (SELECT * EXCLUDE (txt) REPLACE (CASE WHEN regexp_extract(txt, '^[^ -]+') IN ('Mainline', 'Passage', 'Demand', 'Queue') THEN regexp_extract(txt, '^[^ -]+') ELSE 'Other' END AS CallPhase,
      regexp_replace(txt, 'Mainline-\\S+', 'Mainline', 'g') AS ApproachDesc) FROM r1),
    dets AS (SELECT SignalID, ApproachDesc, string_agg(DISTINCT Detector, '/' ORDER BY Detector) AS together FROM r2 GROUP BY ALL),
    f AS (SELECT * FROM e WHERE Zone IS DISTINCT FROM 'Ramp Meters' UNION ALL SELECT DISTINCT * EXCLUDE (together) REPLACE (together AS Detector) FROM r2 JOIN dets USING (SignalID, ApproachDesc)),
    g AS (SELECT *, CASE WHEN Date - lag(Date) OVER w <= 1 THEN 0 ELSE 1 END AS nw FROM f WINDOW w AS (PARTITION BY Zone_Group, Zone, SignalID, CallPhase, Detector, Alert ORDER BY Date, Corridor NULLS FIRST, Name NULLS FIRST, ApproachDesc)),
    h AS (SELECT *, sum(nw) OVER (PARTITION BY Zone_Group, Zone, SignalID, CallPhase, Detector, Alert ORDER BY Date, Corridor NULLS FIRST, Name NULLS FIRST, ApproachDesc) AS run FROM g)
    SELECT * EXCLUDE (nw, run), least(row_number() OVER (PARTITION BY Zone_Group, Zone, SignalID, CallPhase, Detector, Alert, run ORDER BY Date, Corridor NULLS FIRST, Name NULLS FIRST, ApproachDesc), 90) AS streak FROM h)"""


# every fourth signal taken as a ramp meter: its zone, and detectors at the approaches of a ramp, two to a lane
_RAMP_APPROACH = "CASE WHEN SignalID % 4 <> 1 THEN ApproachDesc WHEN Detector = 7 THEN 'Exit' WHEN Detector % 4 = 1 THEN 'Mainline-Lead' WHEN Detector % 4 = 2 THEN 'Mainline-Trail' WHEN Detector % 4 = 3 THEN 'Passage' ELSE 'Demand' END"
_RAMP_LANE = "CASE WHEN SignalID % 4 = 1 THEN CAST(floor((Detector + 1) / 2) AS INTEGER) ELSE LaneNumber END"
_RAMP_ZONE = "CASE WHEN SignalID % 4 = 1 THEN 'Ramp Meters' ELSE Zone END"
_as_ramps = lambda sql: (sql.replace("LEFT JOIN det_config d", f"LEFT JOIN (SELECT * REPLACE ({_RAMP_APPROACH} AS ApproachDesc, {_RAMP_LANE} AS LaneNumber) FROM det_config) d")
                         .replace("JOIN corridors c", f"JOIN (SELECT * REPLACE ({_RAMP_ZONE} AS Zone) FROM corridors) c"))
AL["alerts_ramp"] = streaks(f"{_as_ramps(AL['a_det'])} UNION ALL {_as_ramps(AL['a_ped'])}")
AL["alerts_all"] = streaks("SELECT * FROM a_det UNION ALL SELECT * FROM a_ped UNION ALL SELECT * FROM a_cam")


def kept_bad_detectors(t):
    """Days of bad detectors, kept in place of the hourly rows that tell them."""
    return t.kept("bad_detectors", lambda: ct.bad_detectors(filtered(t)), packed=True)


def det_alerts(t):
    return al.bad_detector_alerts(kept_bad_detectors(t), t.det_config, t.corridors)


def kept_bad_inputs(t):
    return t.kept("bad_ped_inputs", lambda: ped.bad_ped_inputs(pau(t)), packed=True)


def ped_alerts(t):
    return al.bad_ped_alerts(kept_bad_inputs(t), t.corridors)


def cam_alerts(t):
    return al.camera_alerts(up.camera_activity(t.camera_log), cams(t))


def all_alerts(t):
    return al.alerts([det_alerts(t), ped_alerts(t), cam_alerts(t)], TODAY)


def kept_alerts(t):
    return t.kept("alerts", lambda: all_alerts(t), packed=True)


register("l1_bad_detector_alerts", det_alerts, "SELECT * FROM a_det", extra=AL)
register("l2_bad_ped_alerts", ped_alerts, "SELECT * FROM a_ped", extra=AL)
register("l2_camera_alerts", cam_alerts, "SELECT * FROM a_cam", extra=AL)
register("l3_alert_streaks", all_alerts, "SELECT * FROM alerts_all", extra=AL)


def ramp_alerts(t):
    """Vehicle and push-button alerts with ramp meters among the signals."""
    config = t.det_config.withColumns({"ApproachDesc": F.expr(_RAMP_APPROACH), "LaneNumber": F.expr(_RAMP_LANE)})
    corridors = t.corridors.withColumn("Zone", F.expr(_RAMP_ZONE))
    return al.alerts([al.bad_detector_alerts(kept_bad_detectors(t), config, corridors), al.bad_ped_alerts(kept_bad_inputs(t), corridors)], TODAY)


register("l3_ramp_alert_streaks", ramp_alerts, "SELECT * FROM alerts_ramp", extra=AL)


def table_sql(alert, cond, floor, keep_approach):
    keys = "Zone, Corridor, SignalID, CallPhase, Detector, ApproachDesc, Name, Alert"
    tab = f"""SELECT {keys}, count(*) AS Occurrences, max(CASE WHEN Date = (SELECT max(Date) FROM alerts_all WHERE Alert = '{alert}') THEN streak ELSE 0 END) AS Streak
    FROM alerts_all WHERE Alert = '{alert}' AND ({cond}) GROUP BY {keys}"""
    return f"SELECT * {'' if keep_approach else 'EXCLUDE (ApproachDesc)'} FROM ({tab}) WHERE Streak > {floor}"


register("l4_alert_table", lambda t: al.filter_alerts(kept_alerts(t), "Bad Vehicle Detection", zone_group="ASIA")["table"],
         table_sql("Bad Vehicle Detection", "Zone_Group = 'ASIA' OR Zone = 'ASIA'", -1, True), extra=AL)
register("l4_active_alert_table", lambda t: al.filter_alerts(kept_alerts(t), "Bad Ped Pushbuttons", pattern="corridor [2-6]", active="Active 3-days")["table"],
         table_sql("Bad Ped Pushbuttons", "regexp_matches(coalesce(Name, ''), '(?i)corridor [2-6]') OR regexp_matches(coalesce(Corridor, ''), '(?i)corridor [2-6]') OR regexp_matches(SignalID, '(?i)corridor [2-6]')", 2, False), extra=AL)
register("l4_alert_rows_by_phase", lambda t: al.alerts_between(al.filter_alerts(kept_alerts(t), "Bad Vehicle Detection", corridor="Corridor 3", phase="4")["rows"], "2024-01-20", "2024-02-05"),
         "SELECT * FROM alerts_all WHERE Alert = 'Bad Vehicle Detection' AND Corridor = 'Corridor 3' AND CallPhase = '4' AND Date BETWEEN DATE '2024-01-20' AND DATE '2024-02-05'", extra=AL)

# ---- ramp meters ------------------------------------------------------------
RM = {"rslice": """SELECT SignalID, "Timestamp" AS ts, EventCode, EventParam, CAST("Timestamp" AS DATE) AS date, CASE WHEN hour("Timestamp") < 12 THEN 'AM' ELSE 'PM' END AS per FROM ramp_events WHERE EventCode >= 1000""",
      "rtraffic": """SELECT SignalID, date, ts, per, vol, occ / 10.0 AS occ, spd / 1.609344::DOUBLE AS spd FROM (SELECT SignalID, date, ts, per, min(EventParam) FILTER (EventCode = 1371) AS vol,
        min(EventParam) FILTER (EventCode = 1372) AS occ, min(EventParam) FILTER (EventCode = 1373) AS spd FROM rmerged WHERE EventCode IN (1371, 1372, 1373) GROUP BY ALL) WHERE vol IS NOT NULL AND spd > 0""",
      "rmerged": """SELECT SignalID, date_trunc('hour', ts) AS ts, EventCode, EventParam, date, per FROM rslice"""}


def merged(t):
    """Reports of one hour share a time, as a meter's three reports do."""
    return rp.ramp_slice(t.ramp_events.withColumn("Timestamp", F.date_trunc("hour", "Timestamp").cast("timestamp_ntz")))


ts = 'ts AS "Timestamp"'
register("g1_ramp_slice", lambda t: rp.ramp_slice(t.ramp_events, ("AM",)), f"SELECT * EXCLUDE (ts), {ts} FROM rslice WHERE per = 'AM'", extra=RM)
register("g2_flush_events", lambda t: rp.flush_events(rp.ramp_slice(t.ramp_events), t.corridors.select("SignalID", "Corridor").distinct()),
         f"SELECT c.SignalID, c.Corridor, date, {ts}, per FROM (SELECT * FROM rslice WHERE EventCode = 1058 AND EventParam = 0) r RIGHT JOIN (SELECT DISTINCT SignalID, Corridor FROM corridors) c ON r.SignalID = c.SignalID", extra=RM)
register("g2_metering_rates", lambda t: rp.metering_rates(rp.ramp_slice(t.ramp_events)), f"""
SELECT SignalID, date, {ts}, per, EventCode, EventParam AS rate, t2 AS Timestamp2 FROM (SELECT *, lead(ts) OVER (PARTITION BY SignalID, date ORDER BY ts, EventCode, EventParam) AS t2 FROM rslice
WHERE EventCode = 1058 OR (EventCode = 1013 AND EventParam = 1)) WHERE EventCode = 1058 AND EventParam > 0""", extra=RM)
register("g3_mainline_traffic", lambda t: rp.mainline_traffic(merged(t)), f"SELECT * EXCLUDE (ts), {ts} FROM rtraffic", "occ spd", extra=RM)
register("g3_speed_intervals", lambda t: rp.traffic_intervals(rp.mainline_traffic(merged(t)), "spd"),
         f"SELECT * EXCLUDE (ts), {ts}, lead(ts) OVER (PARTITION BY SignalID, date ORDER BY ts) AS Timestamp2 FROM rtraffic WHERE spd IS NOT NULL", "occ spd", extra=RM)
register("g4_traffic_by_metering_rate", lambda t: rp.traffic_by_rate(rp.ramp_slice(t.ramp_events)), f"""
WITH w AS (SELECT SignalID, date, ts, CAST(min(EventParam) FILTER (EventCode = 1371) AS DOUBLE) AS avg_flow_rate, min(EventParam) FILTER (EventCode = 1372) / 10.0 AS avg_occ,
  nullif(min(EventParam) FILTER (EventCode = 1373), 0) / 1.609344::DOUBLE AS avg_speed FROM rslice WHERE EventCode IN (1371, 1372, 1373) GROUP BY ALL)
SELECT w.SignalID, w.date, w.ts AS "Timestamp", avg_flow_rate, avg_occ, avg_speed, nullif(r.EventParam, 0) AS metering_rate FROM w
ASOF LEFT JOIN (SELECT SignalID, date, ts, EventParam FROM rslice WHERE EventCode = 1058) r ON w.SignalID = r.SignalID AND w.date = r.date AND w.ts >= r.ts""",
         "avg_flow_rate avg_occ avg_speed", extra=RM)
