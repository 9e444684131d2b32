"""Counts, count quality, volume (and configuration) queries."""

from pyspark.sql import functions as F

from greenwave.functions import timeparts as tp
from greenwave.operators import config as cfg, counts as ct
from greenwave.plans.adapters_sql import dow, week
from greenwave.plans.registry import register
from greenwave.session import new_table_path
from greenwave.sources import incremental as inc

GRID_HOURS = "SELECT unnest(range(24)) AS h"

# ---- raw counts -------------------------------------------------------------
RAW = """SELECT e.SignalID, {trunc} AS Timeperiod, e.EventParam AS Detector, count(*) AS vol
FROM (SELECT DISTINCT SignalID, "Timestamp", EventParam FROM controller_events WHERE EventCode = {code}{where}) e GROUP BY ALL"""
HOUR = """date_trunc('hour', "Timestamp")"""
QUARTER = """time_bucket(INTERVAL '15 minutes', "Timestamp")"""

for name, code, unit, trunc in (("m1_counts_1hr", 82, "1 hour", HOUR), ("m1_counts_15min", 82, "15 min", QUARTER),
                                ("m1_counts_ped_1hr", 90, "1 hour", HOUR), ("m1_counts_ped_15min", 90, "15 min", QUARTER)):
    register(name, lambda t, code=code, unit=unit: ct.counts_by_phase(t.controller_events, t.det_config, code, unit),
             f"SELECT r.SignalID, Timeperiod, r.Detector, c.CallPhase, vol FROM ({RAW.format(trunc=trunc, code=code, where='')}) r "
             "LEFT JOIN det_config c ON r.SignalID = c.SignalID AND r.Detector = c.Detector")
register("m1_counts_midweek", lambda t: ct.counts_by_phase(t.controller_events, t.det_config, midweek_only=True),
         f"""SELECT r.SignalID, Timeperiod, r.Detector, c.CallPhase, vol FROM ({RAW.format(trunc=HOUR, code=82,
         where=' AND dayofweek("Timestamp") IN (2, 3, 4)')}) r LEFT JOIN det_config c ON r.SignalID = c.SignalID AND r.Detector = c.Detector""")
register("m1_raw_counts", lambda t: ct.raw_counts(t.controller_events), RAW.format(trunc=HOUR, code=82, where=""))
register("m1_zero_filled_hourly", lambda t: ct.hourly_grid_counts(ct.raw_counts(t.controller_events)), f"""
WITH raw AS ({RAW.format(trunc=HOUR, code=82, where='')}),
span AS (SELECT date_trunc('day', min(Timeperiod)) lo, date_trunc('day', max(Timeperiod)) + INTERVAL 23 HOUR hi FROM raw),
g AS (SELECT DISTINCT SignalID, Detector, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS Timeperiod FROM raw, span)
SELECT g.SignalID, g.Timeperiod, g.Detector, coalesce(vol, 0) AS vol FROM g LEFT JOIN raw USING (SignalID, Detector, Timeperiod)""")

# ---- communications ---------------------------------------------------------
COMM = f"""
SELECT SignalID, 0 AS CallPhase, date AS Date, CAST(date AS TIMESTAMP) AS Date_Hour, {dow('date')} AS DOW, {week('date')} AS Week,
  CAST(count(*) FILTER (EventCode = 502 AND EventParam < 100) AS DOUBLE) / nullif(count(*) FILTER (EventCode = 502 AND EventParam > -1), 0) AS uptime,
  avg(EventParam) FILTER (EventCode = 503) AS response_ms
FROM (SELECT DISTINCT * FROM controller_events WHERE EventCode IN (502, 503)) GROUP BY SignalID, date"""
register("m3_comm_uptime", lambda t: ct.comm_uptime(t.controller_events), COMM, "uptime response_ms")
register("m3_comm_uptime_1hr", lambda t: ct.comm_uptime_by_period(t.controller_events, "1 hour"), f"""
SELECT SignalID, 0 AS CallPhase, {HOUR} AS Timeperiod,
  CASE WHEN count(*) FILTER (EventCode = 502 AND EventParam < 100) > 0 THEN
  CAST(count(*) FILTER (EventCode = 502 AND EventParam < 100) AS DOUBLE) / count(*) FILTER (EventCode = 502 AND EventParam >= 0) END AS uptime,
  avg(EventParam) FILTER (EventCode = 503) AS response_ms
FROM controller_events WHERE EventCode IN (502, 503) GROUP BY ALL""", "uptime response_ms")
GAPS = """WITH m AS (SELECT DISTINCT SignalID, date_trunc('minute', "Timestamp") AS ts FROM controller_events),
span AS (SELECT CAST(min(date) AS TIMESTAMP) lo, CAST(max(date) AS TIMESTAMP) + INTERVAL '23:59' HOUR TO MINUTE hi FROM controller_events),
r AS (SELECT * FROM m UNION SELECT DISTINCT SignalID, lo FROM m, span UNION SELECT DISTINCT SignalID, hi FROM m, span),
rr AS ({pick}),
g AS (SELECT SignalID, CAST(ts AS DATE) AS Date, date_diff('minute', lag(ts) OVER (PARTITION BY SignalID, CAST(ts AS DATE) ORDER BY ts), ts) AS span FROM rr)
"""
GAPS = GAPS.replace("INTERVAL '23:59' HOUR TO MINUTE", "INTERVAL 1439 MINUTE")
register("m4_gap_uptime", lambda t: ct.gap_uptime(t.controller_events), GAPS.format(pick="SELECT * FROM r") +
         "SELECT SignalID, Date, 1 - sum(CASE WHEN span > 15 THEN span ELSE 0 END) / 1440.0 AS uptime FROM g WHERE span IS NOT NULL GROUP BY ALL", "uptime")
register("m4_gap_uptime_system", lambda t: ct.gap_uptime(t.controller_events, by_signal=False),
         GAPS.format(pick="SELECT DISTINCT 0 AS SignalID, ts FROM r") +
         "SELECT Date, 1 - sum(CASE WHEN span > 15 THEN span ELSE 0 END) / 1440.0 AS uptime_all FROM g WHERE span IS NOT NULL GROUP BY ALL", "uptime_all")


# ---- filtered and adjusted --------------------------------------------------
def filtered_sql(counts: str, minutes: int, vmax: int, vmain: int, dmax: int, dmain: int, flat: int, high: int) -> str:
    return f"""
    SELECT * FROM (WITH days AS (SELECT DISTINCT CAST(Timeperiod AS DATE) AS Date FROM {counts}),
    grid AS (SELECT SignalID, Detector, CallPhase, Date, CASE WHEN ApproachDesc LIKE '%Mainline%' THEN 1 ELSE 0 END AS main,
      unnest(generate_series(CAST(Date AS TIMESTAMP), CAST(Date AS TIMESTAMP) + INTERVAL {1440 - minutes} MINUTE, INTERVAL {minutes} MINUTE)) AS Timeperiod
      FROM (SELECT DISTINCT SignalID, Detector, CallPhase, ApproachDesc FROM det_config), days),
    e AS (SELECT coalesce(g.SignalID, c.SignalID) AS SignalID, coalesce(g.Detector, c.Detector) AS Detector, coalesce(g.CallPhase, c.CallPhase) AS CallPhase,
      coalesce(g.Timeperiod, c.Timeperiod) AS Timeperiod, g.main, CAST(coalesce(c.vol, 0) AS DOUBLE) AS vol
      FROM grid g FULL JOIN (SELECT * FROM {counts} WHERE CallPhase IS NOT NULL) c
      ON g.SignalID = c.SignalID AND g.Detector = c.Detector AND g.CallPhase = c.CallPhase AND g.Timeperiod = c.Timeperiod),
    d AS (SELECT *, CAST(Timeperiod AS DATE) AS Date, hour(Timeperiod) < 5 AS early FROM e),
    a AS (SELECT *, vol - lag(vol) OVER w AS delta_vol,
      CASE WHEN (CASE WHEN early THEN -1 ELSE vol END) IS DISTINCT FROM lag(CASE WHEN early THEN -1 ELSE vol END) OVER w THEN 1 ELSE 0 END AS chg
      FROM d WINDOW w AS (PARTITION BY SignalID, Date, CallPhase, Detector ORDER BY Timeperiod)),
    b AS (SELECT *, sum(chg) OVER (PARTITION BY SignalID, Date, CallPhase, Detector ORDER BY Timeperiod) AS run FROM a),
    c1 AS (SELECT *, CASE WHEN early THEN 0.0 ELSE CAST(row_number() OVER (PARTITION BY SignalID, Date, CallPhase, Detector, run ORDER BY Timeperiod) AS DOUBLE) END AS flatlined FROM b),
    f AS (SELECT *, CAST(ceil(avg(abs(delta_vol)) OVER p) AS INTEGER) AS mean_abs_delta, CAST(max(flatlined) OVER p AS INTEGER) AS flat_strk,
      sum(CASE WHEN vol > {vmain} THEN 1 ELSE 0 END) OVER p AS om, sum(CASE WHEN vol > {vmax} THEN 1 ELSE 0 END) OVER p AS oa
      FROM c1 WINDOW p AS (PARTITION BY SignalID, Date, CallPhase, Detector)),
    x AS (SELECT *, CASE WHEN flat_strk > {flat} THEN 1 ELSE 0 END AS flat_flag,
      CASE WHEN main = 1 THEN CAST(om > {high} AS INTEGER) WHEN main = 0 THEN CAST(oa > {high} AS INTEGER) END AS maxvol_flag,
      CASE WHEN main = 1 THEN CAST(mean_abs_delta > {dmain} AS INTEGER) WHEN main = 0 THEN CAST(mean_abs_delta > {dmax} AS INTEGER) END AS mad_flag FROM f),
    y AS (SELECT *, CASE WHEN flat_flag > 0 OR maxvol_flag > 0 OR mad_flag > 0 THEN 0
      WHEN flat_flag = 0 AND maxvol_flag = 0 AND mad_flag = 0 THEN 1 END AS Good_Day FROM x)
    SELECT SignalID, Date, Timeperiod, Detector, CallPhase, CASE WHEN Good_Day = 1 THEN vol END AS vol, delta_vol, mean_abs_delta, flatlined, flat_strk,
      flat_flag, maxvol_flag, mad_flag, Good_Day, Timeperiod - to_days(CAST(day(Timeperiod) - 1 AS INTEGER)) AS Month_Hour,
      Timeperiod - to_days(CAST(day(Timeperiod) - 1 AS INTEGER)) - to_months(CAST(month(Timeperiod) - 1 AS INTEGER)) AS Hour FROM y)"""


FILTERED_SQL = {
    "filtered_1hr": filtered_sql("counts_1hr", 60, 1200, 3000, 200, 500, 5, 5),
    "filtered_15min": filtered_sql("counts_15min", 15, 300, 750, 50, 125, 20, 20),
    "filtered_events": filtered_sql("event_counts", 60, 1200, 3000, 200, 500, 5, 5),
    "event_counts": f"SELECT r.SignalID, Timeperiod, r.Detector, c.CallPhase, vol FROM ({RAW.format(trunc=HOUR, code=82, where='')}) r "
                    "LEFT JOIN det_config c ON r.SignalID = c.SignalID AND r.Detector = c.Detector",
    "filtered_events_15min": filtered_sql("event_counts_15min", 15, 300, 750, 50, 125, 20, 20),
    "event_counts_15min": f"SELECT r.SignalID, Timeperiod, r.Detector, c.CallPhase, vol FROM ({RAW.format(trunc=QUARTER, code=82, where='')}) r "
                          "LEFT JOIN det_config c ON r.SignalID = c.SignalID AND r.Detector = c.Detector",
    **{f"event_ped_{unit}": f"SELECT r.SignalID, Timeperiod, r.Detector, c.CallPhase, vol FROM ({RAW.format(trunc=trunc, code=90, where='')}) r "
                            "JOIN det_config c ON r.SignalID = c.SignalID AND r.Detector = c.Detector WHERE c.CallPhase IS NOT NULL"
       for unit, trunc in (("1hr", HOUR), ("15min", QUARTER))},
}


def filtered(t):
    return ct.filtered_counts(t.counts_1hr, t.det_config)


register("m5_filtered_counts_1hr", filtered, "SELECT * FROM filtered_1hr", extra=FILTERED_SQL)
register("m5_filtered_counts_15min", lambda t: ct.filtered_counts(t.counts_15min, t.det_config, ct.QUARTER_HOURLY),
         "SELECT * FROM filtered_15min", extra=FILTERED_SQL)


def caps(t):
    d = t.det_config
    return d.where(F.col("CallPhase") == 4).select("SignalID", "Detector", F.lit(240.0).alias("max_vol"))


register("m6_detector_caps", lambda t: ct.cap_detectors(filtered(t), caps(t)), """
WITH caps AS (SELECT SignalID, Detector, 240.0 AS max_vol FROM det_config WHERE CallPhase = 4),
peak AS (SELECT SignalID, Detector, max(vol) AS peak FROM filtered_1hr GROUP BY ALL),
r AS (SELECT f.* EXCLUDE (vol, Good_Day), CASE WHEN c.max_vol IS NOT NULL AND p.peak > c.max_vol THEN NULL ELSE f.vol END AS vol, c.max_vol, f.Good_Day AS g
  FROM filtered_1hr f LEFT JOIN caps c USING (SignalID, Detector) LEFT JOIN peak p USING (SignalID, Detector))
SELECT * EXCLUDE (max_vol, g), CASE WHEN max_vol IS NULL THEN g WHEN vol IS NULL THEN 0 ELSE 1 END AS Good_Day FROM r""", extra=FILTERED_SQL)


def adjusted_sql(src: str) -> str:
    return f"""SELECT * FROM (WITH fc AS (SELECT SignalID, CallPhase, Detector, Timeperiod, Month_Hour, {dow('Timeperiod')} AS DOW, date_trunc('month', Timeperiod) AS mon, vol FROM {src}),
    m AS (SELECT *, count(*) FILTER (vol IS NULL) OVER (PARTITION BY SignalID, CallPhase, Timeperiod) AS na FROM fc),
    v AS (SELECT SignalID, CallPhase, mon, Detector, sum(vol) AS v FROM m WHERE na = 0 GROUP BY ALL),
    s AS (SELECT SignalID, CallPhase, mon, Detector, v / nullif(sum(v) OVER (PARTITION BY SignalID, CallPhase, mon), 0) AS contr FROM v),
    j AS (SELECT fc.*, contr FROM fc LEFT JOIN s USING (SignalID, CallPhase, mon, Detector)),
    w AS (SELECT *, CASE WHEN count(*) FILTER (vol > 0 AND contr = 0) OVER p = 0 THEN avg(vol / nullif(contr, 0)) OVER p END AS whole
      FROM j WINDOW p AS (PARTITION BY SignalID, CallPhase, Timeperiod)),
    z AS (SELECT *, coalesce(vol, trunc(round((CASE WHEN whole <= 3000 THEN whole END) * contr, 6))) AS vol2 FROM w),
    t AS (SELECT *, median(vol2) OVER (PARTITION BY SignalID, CallPhase, Detector, DOW, Month_Hour) AS typ FROM z)
    SELECT SignalID, CallPhase, Detector, Timeperiod, CAST(trunc(coalesce(vol2, typ)) AS INTEGER) AS vol FROM t WHERE coalesce(vol2, typ) IS NOT NULL)"""


ADJ_SQL = {**FILTERED_SQL, "adjusted_1hr": adjusted_sql("filtered_1hr"), "adjusted_15min": adjusted_sql("filtered_15min"),
           "vol_detectors": "SELECT SignalID, CallPhase, Detector FROM (SELECT *, min(CountPriority) OVER (PARTITION BY SignalID, CallPhase) AS m FROM det_config) WHERE CountPriority = m",
           "filtered_vol": "SELECT * FROM filtered_1hr SEMI JOIN vol_detectors USING (SignalID, CallPhase, Detector)",
           "prepared_adj": adjusted_sql("filtered_vol")}


def adjusted(t):
    return ct.adjusted_counts(filtered(t))


def adjusted_15min(t):
    return ct.adjusted_counts(ct.filtered_counts(t.counts_15min, t.det_config, ct.QUARTER_HOURLY))


register("m7_adjusted_counts_1hr", adjusted, "SELECT * FROM adjusted_1hr", extra=ADJ_SQL)
register("m7_adjusted_counts_15min", adjusted_15min, "SELECT * FROM adjusted_15min", extra=ADJ_SQL)
register("m8_prepared_adjusted_counts", lambda t: ct.prepared_adjusted_counts(filtered(t), t.det_config),
         "SELECT * FROM prepared_adj", extra=ADJ_SQL)

register("m9_detector_uptime", lambda t: ct.detector_uptime(filtered(t)), """
WITH d AS (SELECT DISTINCT Date, SignalID, Detector, Good_Day FROM filtered_1hr),
g AS (SELECT SignalID, Detector, CAST(unnest(generate_series(CAST((SELECT min(Date) FROM d) AS TIMESTAMP), CAST((SELECT max(Date) FROM d) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS Date
  FROM (SELECT DISTINCT SignalID, Detector FROM d))
SELECT g.SignalID, g.Detector, g.Date, Good_Day FROM g LEFT JOIN d USING (SignalID, Detector, Date)""", extra=FILTERED_SQL)
register("m9_bad_detectors", lambda t: ct.bad_detectors(filtered(t)),
         "SELECT DISTINCT SignalID, Detector, Date, Good_Day FROM filtered_1hr WHERE Good_Day = 0", extra=FILTERED_SQL)
UPTIME_SQL = {**ADJ_SQL, "det_uptime": """SELECT SignalID, CallPhase, Date, Timeperiod AS Date_Hour,
    CASE WHEN CallPhase IN (2, 6) THEN 'Setback' ELSE 'Presence' END AS setback, CAST(coalesce(sum(Good_Day), 0) AS DOUBLE) / count(*) AS uptime, CAST(count(*) AS DOUBLE) AS "all"
    FROM filtered_1hr ANTI JOIN (SELECT SignalID, Timeperiod FROM filtered_1hr GROUP BY ALL HAVING coalesce(sum(vol), 0) = 0) USING (SignalID, Timeperiod)
    GROUP BY SignalID, CallPhase, Date, Timeperiod"""}
register("m10_daily_detector_uptime", lambda t: ct.daily_detector_uptime(filtered(t)), "SELECT * FROM det_uptime", "uptime all", extra=UPTIME_SQL)


def wm(x, w, cond="true"):
    return f'sum({x} * {w}) FILTER ({cond}) / nullif(sum({w}) FILTER ({cond} AND {x} IS NOT NULL), 0)'


register("m11_avg_daily_detector_uptime", lambda t: ct.avg_daily_detector_uptime(ct.daily_detector_uptime(filtered(t))), f"""
WITH a AS (SELECT SignalID, Date, {wm('uptime', '"all"')} AS uptime, sum("all") AS "all",
  {wm('uptime', '"all"', "setback = 'Setback'")} AS uptime_sb, sum("all") FILTER (setback = 'Setback') AS all_sb,
  {wm('uptime', '"all"', "setback = 'Presence'")} AS uptime_pr, sum("all") FILTER (setback = 'Presence') AS all_pr FROM det_uptime GROUP BY ALL)
SELECT *, (uptime - lag(uptime) OVER w) / nullif(lag(uptime) OVER w, 0) AS delta FROM a WINDOW w AS (PARTITION BY SignalID ORDER BY Date)""",
         "uptime uptime_sb uptime_pr delta", extra=UPTIME_SQL)

# ---- volumes ----------------------------------------------------------------
VPD = """SELECT SignalID, CallPhase, CAST(Timeperiod AS DATE) AS Date, CAST(sum(vol) AS DOUBLE) AS {n}, {w} AS Week, {d} AS DOW FROM {src} {where} GROUP BY SignalID, CallPhase, CAST(Timeperiod AS DATE)"""
_wd = dict(w=week("CAST(Timeperiod AS DATE)"), d=dow("CAST(Timeperiod AS DATE)"))
register("m12_vehicles_per_day", lambda t: ct.daily_volume(adjusted(t)),
         VPD.format(n="vpd", src="adjusted_1hr", where="WHERE CallPhase IN (2, 6)", **_wd), extra=ADJ_SQL)
register("m12_ped_actuations_per_day", lambda t: ct.daily_volume(t.counts_1hr, False, "papd"),
         VPD.format(n="papd", src="counts_1hr", where="", **_wd))
VPH = """SELECT SignalID, {t} AS {p}, CAST(sum(vol) AS DOUBLE) AS {n}, {w} AS Week, {d} AS DOW FROM {src} {where} GROUP BY SignalID, {t}"""


def vph_sql(name, src, trunc, period, where):
    tr = {"hour": "date_trunc('hour', Timeperiod)", "15": "time_bucket(INTERVAL '15 minutes', Timeperiod)"}[trunc]
    return VPH.format(t=tr, p=period, n=name, src=src, where=where, w=week(f"CAST({tr} AS DATE)"), d=dow(tr))


register("m13_vehicles_per_hour", lambda t: ct.period_volume(adjusted(t), period="Hour"),
         vph_sql("vph", "adjusted_1hr", "hour", "Hour", "WHERE CallPhase IN (2, 6)"), extra=ADJ_SQL)
register("m13_vehicles_per_15min", lambda t: ct.period_volume(adjusted_15min(t), "15 min", name="vp15"),
         vph_sql("vp15", "adjusted_15min", "15", "Timeperiod", "WHERE CallPhase IN (2, 6)"), extra=ADJ_SQL)
register("m13_ped_actuations_per_hour", lambda t: ct.period_volume(t.counts_1hr, "1 hour", False, "paph", "Hour"),
         vph_sql("paph", "counts_1hr", "hour", "Hour", ""))
register("m13_ped_actuations_per_15min", lambda t: ct.period_volume(t.counts_15min, "15 min", False, "pa15"),
         vph_sql("pa15", "counts_15min", "15", "Timeperiod", ""))
THROUGHPUT = f"""SELECT SignalID, 0 AS CallPhase, Date, {week('Date')} AS Week, {dow('Date')} AS DOW, quantile_cont(v, 0.95) * 4 AS vph FROM
(SELECT SignalID, CAST(Timeperiod AS DATE) AS Date, Timeperiod, CAST(sum(vol) AS DOUBLE) AS v FROM counts_15min GROUP BY ALL) GROUP BY SignalID, Date"""
register("m14_throughput", lambda t: ct.throughput(t.counts_15min), THROUGHPUT, "vph")


# ---- the nightly set from the event log -------------------------------------
def nightly(name):
    return lambda t: ct.daily_count_products(t.controller_events, t.det_config, t.det_config, keep=lambda df: df)[name]


EVENT_UPTIME = {**FILTERED_SQL, "event_uptime": UPTIME_SQL["det_uptime"].replace("filtered_1hr", "filtered_events")}
for name, table, sql, floats in (
        ("comm_uptime", "comm_uptime", COMM, "uptime response_ms"),
        ("counts_1hr", "counts_1hr", "SELECT * FROM event_counts", ""),
        ("counts_15min", "counts_15min", "SELECT * FROM event_counts_15min", ""),
        ("filtered_counts_1hr", "filtered_counts_1hr", "SELECT * FROM filtered_events", ""),
        ("filtered_counts_15min", "filtered_counts_15min", "SELECT * FROM filtered_events_15min", ""),
        ("bad_detectors_from_events", "bad_detectors", "SELECT DISTINCT SignalID, Detector, Date, Good_Day FROM filtered_events WHERE Good_Day = 0", ""),
        ("detector_uptime", "detector_uptime_pd", "SELECT * FROM event_uptime", "uptime all"),
        ("counts_ped_1hr", "counts_ped_1hr", "SELECT * FROM event_ped_1hr", ""),
        ("counts_ped_15min", "counts_ped_15min", "SELECT * FROM event_ped_15min", ""),
        ("ped_actuations_per_day", "ped_actuations_pd", VPD.format(n="papd", src="event_ped_1hr", where="", **_wd), ""),
        ("ped_actuations_per_hour", "ped_actuations_ph", vph_sql("paph", "event_ped_1hr", "hour", "Hour", ""), ""),
        ("ped_actuations_per_15min", "ped_actuations_15min", vph_sql("pa15", "event_ped_15min", "15", "Timeperiod", ""), "")):
    register(f"m2_{name}", nightly(table), sql, floats, extra=EVENT_UPTIME)


def late_events(t, name):
    """A table of the nightly set from a store that got the log in three batches: most of it, then late events with some that came before, then the second batch once more."""
    ev = t.controller_events
    late = F.pmod(F.hash("SignalID", "Timestamp", "EventCode"), F.lit(7))
    root = new_table_path(t.spark, "nightly")
    inc.open_store(t.spark, root)
    inc.add_batch(t.spark, root, ev.where(late != 3), "2024-01-05")
    for _ in range(2):
        inc.add_batch(t.spark, root, ev.where(late >= 2), "2024-01-06")
    inc.add_batch(t.spark, root, ev.where(late == 3), "2024-01-07")
    return ct.count_products(inc.stored_tally(t.spark, root), t.det_config, t.det_config)[name]


for name, sql, floats in (("counts_1hr", "SELECT * FROM event_counts", ""), ("comm_uptime", COMM, "uptime response_ms")):
    register(f"m2_{name}_after_late_events", lambda t, name=name: late_events(t, name), sql, floats, extra=EVENT_UPTIME)
