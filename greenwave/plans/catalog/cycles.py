"""Pairing, cycle and signal-timing queries."""

from pyspark.sql import functions as F

from greenwave.operators import config as cfg, cycles as cy, rollup as ru
from greenwave.plans import rollup_sql as rs
from greenwave.plans.adapters_sql import dow, week
from greenwave.plans.registry import register

KEYS = "SignalID, date, EventParam"


def secs(a, b):
    return f"date_diff('microsecond', {a}, {b}) / 1000000.0"


def pair_sql(a, b):
    cmp = ">=" if a != b else ">"
    return f"""SELECT b.SignalID, b.date, b.EventParam, {a} AS EventCode, a.ts AS StartTimeStamp, min(b.ts) AS EndTimeStamp, {secs('a.ts', 'min(b.ts)')} AS Duration
    FROM (SELECT DISTINCT {KEYS}, "Timestamp" AS ts FROM controller_events WHERE EventCode = {b}) b
    ASOF JOIN (SELECT DISTINCT {KEYS}, "Timestamp" AS ts FROM controller_events WHERE EventCode = {a}) a
    ON a.SignalID = b.SignalID AND a.date = b.date AND a.EventParam = b.EventParam AND b.ts {cmp} a.ts GROUP BY b.SignalID, b.date, b.EventParam, a.ts"""


CY = {
    "gyr0": " UNION ALL ".join(pair_sql(a, b) for a, b in ((1, 8), (8, 9), (9, 1))),
    "barriers": """SELECT DISTINCT SignalID, date, "Timestamp" AS CycleStart FROM controller_events WHERE EventCode = 31 AND EventParam = 1""",
    "gyr": f"""SELECT g.* EXCLUDE (EventParam), g.EventParam AS Phase, c.CycleStart, {secs('c.CycleStart', 'g.StartTimeStamp')} AS TimeInCycle
        FROM gyr0 g ASOF JOIN barriers c ON g.SignalID = c.SignalID AND g.date = c.date AND g.StartTimeStamp >= c.CycleStart""",
    "cfg_count": "SELECT *, CountPriority = min(CountPriority) OVER (PARTITION BY SignalID, CallPhase) AS CountDetector FROM det_config",
    "dets": f"""SELECT p.SignalID, p.date, c.CallPhase AS Phase, p.EventParam AS Detector, CountDetector,
        StartTimeStamp + to_microseconds(CAST(round(coalesce(TimeFromStopBar, 0) * 1000000) AS BIGINT)) AS DetTimeStamp, Duration AS DetDuration
        FROM ({pair_sql(82, 81)}) p JOIN cfg_count c ON p.SignalID = c.SignalID AND p.EventParam = c.Detector""",
    "found": f"""SELECT d.*, g.StartTimeStamp AS PhaseStart, g.CycleStart, g.EventCode, {secs('g.CycleStart', 'd.DetTimeStamp')} AS DetTimeInCycle,
        {secs('g.StartTimeStamp', 'd.DetTimeStamp')} AS DetTimeInPhase
        FROM dets d ASOF JOIN gyr g ON d.SignalID = g.SignalID AND d.date = g.date AND d.Phase = g.Phase AND d.DetTimeStamp >= g.StartTimeStamp""",
    "cyc": """SELECT g.SignalID, g.date, g.Phase, g.CycleStart, g.StartTimeStamp AS PhaseStart, g.EndTimeStamp AS PhaseEnd, g.EventCode,
        coalesce(t.EventCode, 0) AS TermType, g.Duration, coalesce(v.Volume, 0) AS Volume FROM gyr g
        LEFT JOIN (SELECT SignalID, date, Phase, EventCode, PhaseStart, count(*) AS Volume FROM found WHERE CountDetector GROUP BY ALL) v
          ON g.SignalID = v.SignalID AND g.date = v.date AND g.Phase = v.Phase AND g.EventCode = v.EventCode AND g.StartTimeStamp = v.PhaseStart
        LEFT JOIN (SELECT DISTINCT SignalID, EventParam, "Timestamp" AS ts, EventCode FROM controller_events WHERE EventCode IN (4, 5, 6)) t
          ON g.SignalID = t.SignalID AND g.Phase = t.EventParam AND g.EndTimeStamp = t.ts""",
    "detn": """SELECT SignalID, date, Phase, Detector, CycleStart, PhaseStart, EventCode, DetTimeStamp, DetDuration, DetTimeInCycle, DetTimeInPhase
        FROM found WHERE CAST(DetTimeStamp AS DATE) <= date""",
}
_pair_cols = "Duration"
register("c1_c2_phase_intervals", lambda t: cy.phase_intervals(t.controller_events), "SELECT * FROM gyr0", _pair_cols, extra=CY)
register("c2_phase_cycles", lambda t: cy.phase_cycles(t.controller_events), pair_sql(1, 1), _pair_cols)
register("c1_detector_on_off", lambda t: cy.event_pairs(t.controller_events, ((82, 81),)), pair_sql(82, 81), _pair_cols)
register("c3_intervals_in_cycle", lambda t: cy.intervals_in_cycle(t.controller_events),
         "SELECT * FROM gyr", "Duration TimeInCycle", extra=CY)


def count_config(t):
    return cfg.count_detectors(t.det_config, None)


def etl(t):
    return cy.event_etl(t.controller_events, count_config(t))


register("c4_detector_pairs", lambda t: cy.detector_pairs(t.controller_events, count_config(t)), "SELECT * FROM dets", "DetDuration", extra=CY)
register("c6_cycles", lambda t: etl(t)[0], "SELECT * FROM cyc", "Duration", extra=CY)
register("c5_c6_detections", lambda t: etl(t)[1], "SELECT * FROM detn", "DetDuration DetTimeInCycle DetTimeInPhase", extra=CY)


def aog_sql(minutes):
    trunc = f"time_bucket(INTERVAL '{minutes} minutes', {{c}})"
    return f"""SELECT * FROM (WITH d AS (SELECT DISTINCT n.* FROM detn n SEMI JOIN (SELECT * FROM det_config WHERE DetectionTypeDesc LIKE '%Advanced Count%') c
      ON n.SignalID = c.SignalID AND n.Detector = c.Detector),
    arr AS (SELECT SignalID, Phase, {trunc.format(c='DetTimeStamp')} AS Hour, count(*) FILTER (EventCode = 1) AS g, count(*) AS vol FROM d GROUP BY ALL HAVING g > 0),
    st AS (SELECT DISTINCT SignalID, date, Phase, PhaseStart AS ts, EventCode FROM d),
    e AS (SELECT SignalID, date, Phase, unnest(generate_series(CAST(date AS TIMESTAMP), CAST(date AS TIMESTAMP) + INTERVAL {1440 - minutes} MINUTE, INTERVAL {minutes} MINUTE)) AS ts, NULL AS EventCode
      FROM (SELECT DISTINCT SignalID, date, Phase FROM st)),
    r AS (SELECT * FROM st UNION ALL SELECT * FROM e),
    f AS (SELECT *, last_value(EventCode IGNORE NULLS) OVER w AS iv, lead(ts) OVER w AS nx FROM r
      WINDOW w AS (PARTITION BY SignalID, date, Phase ORDER BY ts, EventCode IS NULL)),
    x AS (SELECT SignalID, Phase, {trunc.format(c='ts')} AS Hour, iv, coalesce({secs('ts', 'nx')}, 0) AS s FROM f WHERE iv IS NOT NULL),
    gc AS (SELECT SignalID, Phase, Hour, sum(s) FILTER (iv = 1) AS g, sum(s) AS tot FROM x GROUP BY ALL HAVING g IS NOT NULL)
    SELECT arr.SignalID, arr.Phase AS CallPhase, arr.Hour AS Date_Hour, CAST(arr.g AS DOUBLE) / vol AS aog,
      (CAST(arr.g AS DOUBLE) / vol) / nullif(gc.g / nullif(gc.tot, 0), 0) AS pr, vol
    FROM arr JOIN gc ON arr.SignalID = gc.SignalID AND arr.Phase = gc.Phase AND arr.Hour = gc.Hour)"""


for unit, m in (("1 hour", 60), ("15 min", 15)):
    register(f"c9_arrivals_on_green_{'1hr' if m == 60 else '15min'}",
             lambda t, unit=unit: cy.arrivals_on_green(etl(t)[1], t.det_config, unit), aog_sql(m), "aog pr", extra=CY)


def occ_sql(which, span):
    return f"""SELECT i.SignalID, i.Phase, i.CycleStart, coalesce(max(o.occ), 0) AS occ FROM (SELECT DISTINCT SignalID, Phase, CycleStart FROM {which}) i
    LEFT JOIN (SELECT d.SignalID, d.Phase, i.CycleStart, d.Detector, sum({secs('greatest(DetOn, IntervalStart)', 'least(DetOff, IntervalEnd)')}) / nullif(max({secs('IntervalStart', 'IntervalEnd')}), 0) AS occ
      FROM sfdet d JOIN {which} i ON d.SignalID = i.SignalID AND d.Phase = i.Phase AND DetOn <= IntervalEnd AND DetOff >= IntervalStart GROUP BY ALL) o
    ON i.SignalID = o.SignalID AND i.Phase = o.Phase AND i.CycleStart = o.CycleStart GROUP BY ALL"""


SF = {**CY,
      "sfdet": """SELECT SignalID, Phase, Detector, DetTimeStamp AS DetOn, DetTimeStamp + to_microseconds(CAST(round(DetDuration * 1000000) AS BIGINT)) AS DetOff
        FROM detn SEMI JOIN (SELECT SignalID, CallPhase AS Phase, Detector FROM det_config WHERE DetectionTypeDesc LIKE '%Stop Bar Presence%' AND TimeFromStopBar IS NOT NULL) c USING (SignalID, Phase, Detector)
        WHERE Phase IN (3, 4, 7, 8)""",
      "grn": "SELECT SignalID, Phase, CycleStart, PhaseStart AS IntervalStart, PhaseEnd AS IntervalEnd FROM cyc WHERE EventCode = 1 AND Phase IN (3, 4, 7, 8)",
      "sor": "SELECT SignalID, Phase, CycleStart, PhaseStart AS IntervalStart, PhaseStart + INTERVAL 5 SECOND AS IntervalEnd FROM cyc WHERE EventCode = 9 AND Phase IN (3, 4, 7, 8)",
      "grocc": occ_sql("grn", ""), "srocc": occ_sql("sor", "")}
SF["sfc"] = """SELECT *, CASE WHEN gr_occ > {T} AND sr_occ > {T} THEN 1 ELSE 0 END AS sf FROM (SELECT SignalID, Phase, CycleStart, coalesce(g.occ, 0) AS gr_occ, coalesce(s.occ, 0) AS sr_occ
    FROM grocc g FULL JOIN srocc s USING (SignalID, Phase, CycleStart))"""
SF["sfa"] = "SELECT SignalID, Phase, CycleStart, gr_occ, sr_occ, sf FROM sfc UNION ALL SELECT SignalID, 0, CycleStart, NULL, NULL, max(sf) FROM sfc GROUP BY SignalID, CycleStart"


def sf_extra(threshold):
    return {**SF, "sfc": SF["sfc"].replace("{T}", str(threshold))}


def sf_cycles(t, threshold=0.8):
    cycles, det = etl(t)
    return cy.split_failures_by_cycle(det, cycles, t.det_config, threshold=threshold)


def sf_sql(minutes):
    h = f"time_bucket(INTERVAL '{minutes} minutes', CycleStart)"
    return (f"SELECT SignalID, Phase AS CallPhase, {h} AS Date_Hour, CAST(sum(sf) AS INTEGER) AS sf, count(*) AS cycles, CAST({h} AS DATE) AS Date, {dow(h)} AS DOW, "
            f"{week(f'CAST({h} AS DATE)')} AS Week, sum(sf) / CAST(count(*) AS DOUBLE) AS sf_freq FROM sfa GROUP BY SignalID, Phase, {h}")


def c10(t):
    cycles, det = etl(t)
    d = det.join(cfg.sf_detectors(t.det_config).select("SignalID", F.col("CallPhase").alias("Phase"), "Detector"), ["SignalID", "Phase", "Detector"], "left_semi")
    from greenwave.functions import timeparts as tp
    d = d.where(F.col("Phase").isin(3, 4, 7, 8)).select("SignalID", "Phase", "Detector", F.col("DetTimeStamp").alias("DetOn"), tp.add_seconds("DetTimeStamp", F.col("DetDuration")).alias("DetOff"))
    g = cycles.where((F.col("EventCode") == 1) & F.col("Phase").isin(3, 4, 7, 8)).select(
        "SignalID", "Phase", "CycleStart", F.col("PhaseStart").alias("IntervalStart"), F.col("PhaseEnd").alias("IntervalEnd"))
    return cy.occupancy(d, g)


register("c10_green_occupancy", c10, "SELECT * FROM grocc", "occ", extra=SF)
register("c11_split_failures_by_cycle", lambda t: sf_cycles(t), "SELECT * FROM sfa", "gr_occ sr_occ", extra=sf_extra(0.8))
# a low threshold so that failures occur in thin data
register("c11_split_failures_1hr", lambda t: cy.split_failures(sf_cycles(t, 0.01)), sf_sql(60), "sf_freq", extra=sf_extra(0.01))
register("c11_split_failures_15min", lambda t: cy.split_failures(sf_cycles(t, 0.01), "15 min"), sf_sql(15), "sf_freq", extra=sf_extra(0.01))
for half, cond in (("peak", rs.PEAK.format(c="Date_Hour")), ("off_peak", "NOT (" + rs.PEAK.format(c="Date_Hour") + ")")):
    register(f"c12_split_failures_{half}", lambda t, h=half: cy.peak_split_failures(t.metrics_hourly)[h],
             f"SELECT SignalID, CAST(Date_Hour AS DATE) AS Period, {rs.wmean('sf_freq', 'cycles')} AS sf_freq, sum(cycles) AS cycles FROM metrics_hourly WHERE {cond} GROUP BY ALL",
             "sf_freq cycles")

QS = {**CY, "qsc": """SELECT SignalID, date, Phase, CycleStart, max(o) AS occ FROM (SELECT SignalID, date, Phase, CycleStart, Detector, quantile_cont(DetDuration, 0.95) AS o FROM detn
    SEMI JOIN (SELECT SignalID, CallPhase AS Phase, Detector FROM det_config WHERE (DetectionTypeDesc LIKE '%Advanced Count%' OR DetectionTypeDesc LIKE '%Advanced Speed%')
      AND DistanceFromStopBar IS NOT NULL AND TimeFromStopBar IS NOT NULL) c USING (SignalID, Phase, Detector) GROUP BY ALL) GROUP BY ALL"""}
for unit, m in (("1 hour", 60), ("15 min", 15)):
    h = f"time_bucket(INTERVAL '{m} minutes', CycleStart)"
    register(f"c13_queue_spillback_{'1hr' if m == 60 else '15min'}",
             lambda t, unit=unit: cy.queue_spillback(cy.spillback_by_cycle(etl(t)[1], t.det_config), unit),
             f"SELECT SignalID, Phase AS CallPhase, date AS Date, {h} AS Date_Hour, CAST(count(*) FILTER (occ > 3) AS INTEGER) AS qs, CAST(count(*) AS INTEGER) AS cycles, {dow('date')} AS DOW, {week('date')} AS Week, "
             f"count(*) FILTER (occ > 3) / CAST(count(*) AS DOUBLE) AS qs_freq FROM qsc GROUP BY SignalID, Phase, date, {h}", "qs_freq", extra=QS)

PED = f"""WITH pe AS (SELECT SignalID, date, "Timestamp" AS ts, EventCode, EventParam, CASE WHEN EventCode = 132 THEN EventParam END AS cl0 FROM controller_events WHERE EventCode IN (45, 21, 22, 132)),
k AS (SELECT SignalID, date, coalesce(max(cl0), 0) > 0 AS coord FROM pe GROUP BY ALL),
f AS (SELECT *, last_value(cl0 IGNORE NULLS) OVER (PARTITION BY SignalID, date ORDER BY ts, EventCode, EventParam) AS cl FROM pe),
g AS (SELECT f.*, coord FROM f JOIN k USING (SignalID, date) WHERE EventCode <> 132 AND (NOT coord OR coalesce(cl, 0) > 0)),
n AS (SELECT *, lead(EventCode) OVER w AS nc, lead(ts) OVER w AS nt FROM g WINDOW w AS (PARTITION BY SignalID, date, EventParam ORDER BY ts, EventCode)),
d AS (SELECT *, {secs('ts', 'nt')} AS delay FROM n WHERE nc = 21)
SELECT SignalID, date AS Date, CASE WHEN coord THEN 'Coordinated' ELSE 'Free' END AS Pattern, avg(delay) AS Avg_Max_Ped_Delay, count(*) AS Events FROM d
WHERE (NOT coord AND EventCode = 45 AND delay <= {{free}}) OR (coord AND EventCode = 22 AND delay <= cl) GROUP BY ALL"""
# the stretched clock of the test events needs limits stretched alike
register("c14_ped_delay", lambda t: cy.ped_delay(t.controller_events.withColumn(
    "EventParam", F.when(F.col("EventCode") == 132, F.col("EventParam") * 60).otherwise(F.col("EventParam"))), 18000),
    PED.format(free=18000).replace("THEN EventParam END AS cl0", "THEN EventParam * 60 END AS cl0"), "Avg_Max_Ped_Delay")
FLASH = {"flash": f"""SELECT SignalID, date AS Date, ts AS TimeStamp, EventParam, {secs('ts', 'nt')} AS FlashDuration, coalesce(np, 0) AS EndParam FROM (
  SELECT *, lead(ts) OVER w AS nt, lead(EventParam) OVER w AS np FROM (SELECT SignalID, date, "Timestamp" AS ts, EventParam,
    lag(EventParam) OVER (PARTITION BY SignalID, date ORDER BY "Timestamp", EventParam) AS pv FROM controller_events WHERE EventCode = 173)
  WHERE EventParam IS DISTINCT FROM pv WINDOW w AS (PARTITION BY SignalID, date ORDER BY ts, EventParam)) WHERE EventParam NOT IN (2, 3, 4)"""}
register("c15_flash_events", lambda t: cy.flash_events(t.controller_events), "SELECT * FROM flash", "FlashDuration", extra=FLASH)
_fl = rs.monthly_avg_by_day("SELECT SignalID, 0 AS CallPhase, CAST(date_trunc('month', Date) AS DATE) AS Date, CAST(count(*) AS DOUBLE) AS flash FROM flash GROUP BY ALL", "flash")
register("c16_monthly_flash", lambda t: cy.monthly_flash_count(cy.flash_events(t.controller_events)), _fl, "flash delta", extra=FLASH)
register("r11_cor_monthly_flash", lambda t: ru.cor_monthly_avg_by_day(cy.monthly_flash_count(cy.flash_events(t.controller_events)), t.corridors, "flash"),
         rs.corridor_rollup(_fl, "flash", "Month"), "flash delta", extra=FLASH)
STATE = """SELECT SignalID, date AS Date, "Timestamp" AS ts, coalesce(last_value(CASE WHEN EventCode = 150 THEN EventParam END IGNORE NULLS) OVER
  (PARTITION BY SignalID, date ORDER BY "Timestamp", EventCode, EventParam), -1) AS CoordState FROM controller_events"""


def state_rows(t):
    from greenwave.functions.ordered import carry
    return carry(t.controller_events, ["SignalID", "date"], "Timestamp",
                 {"CoordState": F.when(F.col("EventCode") == 150, F.col("EventParam"))}, order=["EventCode", "EventParam"])


register("c17_time_in_state", lambda t: cy.time_in_state(state_rows(t)), f"""
SELECT SignalID, Date, CoordState, sum({secs('ts', 'coalesce(nt, CAST(Date AS TIMESTAMP) + INTERVAL 1 DAY)')}) AS duration
FROM (SELECT *, lead(ts) OVER (PARTITION BY SignalID, Date ORDER BY ts) AS nt FROM (SELECT DISTINCT * FROM ({STATE}))) GROUP BY ALL""", "duration")
register("w10_state_sessions", lambda t: cy.state_sessions(state_rows(t).select(
    "SignalID", F.col("date").alias("Date"), "Timestamp", F.coalesce("CoordState", F.lit(-1)).alias("CoordState")).distinct(), "CoordState"), f"""
WITH s AS (SELECT *, lag(CoordState) OVER (PARTITION BY SignalID, Date ORDER BY ts, CoordState) AS pv FROM (SELECT DISTINCT * FROM ({STATE}))),
c AS (SELECT *, coalesce(lead(ts) OVER (PARTITION BY SignalID, Date ORDER BY ts, CoordState), CAST(Date AS TIMESTAMP) + INTERVAL 1 DAY) AS nt FROM s WHERE pv IS DISTINCT FROM CoordState)
SELECT SignalID, Date, CoordState, ts AS start, nt AS "end", {secs('ts', 'nt')} AS duration FROM c""", "duration")
