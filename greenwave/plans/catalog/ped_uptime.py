"""Pedestrian input and camera uptime queries."""

from pyspark.sql import functions as F

from greenwave.operators import config as cfg, ped, uptime as up
from greenwave.plans import rollup_sql as rs
from greenwave.plans.adapters_sql import dow, week
from greenwave.plans.registry import register

I = "SignalID, Detector, CallPhase"
HIGH = """SELECT * FROM (WITH h AS (SELECT Date, count(DISTINCT Hour) AS n FROM ped_hourly WHERE hour(Hour) BETWEEN 6 AND 22 GROUP BY ALL),
  d AS (SELECT SignalID, Detector, CallPhase, Date FROM (SELECT SignalID, Detector, CallPhase, Date, sum(paph) AS s, sum(paph * paph) AS q FROM ped_hourly WHERE hour(Hour) BETWEEN 6 AND 22 GROUP BY ALL) JOIN h USING (Date)
    WHERE s / n > 600 OR (n > 1 AND sqrt(greatest((q - s * s / n) / (n - 1), 0)) > 9000)),
  e AS (SELECT SignalID, Detector, CallPhase, Date FROM ped_hourly WHERE hour(Hour) < 6 GROUP BY ALL HAVING max(paph) > 300 OR list_reverse_sort(list(paph))[3] > 60),
  r AS (SELECT *, row_number() OVER (PARTITION BY SignalID, Hour ORDER BY paph DESC) AS r FROM ped_hourly),
  s AS (SELECT *, coalesce(max(paph) FILTER (r = 2) OVER (PARTITION BY SignalID, Hour), 0) AS second FROM r),
  o AS (SELECT SignalID, Detector, CallPhase, Date FROM s GROUP BY ALL HAVING count(*) FILTER (paph > greatest(1, second) * 100 AND paph > 300) >= 4)
  SELECT * FROM d UNION SELECT * FROM e UNION (SELECT o.* FROM o SEMI JOIN (SELECT SignalID FROM ped_hourly GROUP BY ALL HAVING count(DISTINCT (Detector, CallPhase)) > 1) k USING (SignalID)))"""
START, CALC = "2024-01-10", "2024-02-01"
PAU = {"high": HIGH, "high_since": HIGH.replace("ped_hourly", f"(SELECT * FROM ped_hourly WHERE Date >= DATE '{CALC}')"), "dense": f"""SELECT * FROM (WITH k AS (SELECT DISTINCT {I} FROM ped_daily), days AS (SELECT DISTINCT Date FROM ped_daily),
    g AS (SELECT k.*, Date, coalesce(papd, 0) AS papd FROM k CROSS JOIN days LEFT JOIN ped_daily USING (SignalID, Detector, CallPhase, Date)),
    l AS (SELECT *, last_value(CASE WHEN papd <> 0 THEN Date END IGNORE NULLS) OVER (PARTITION BY {I} ORDER BY Date) AS lst FROM g)
    SELECT l.SignalID, l.Detector, l.CallPhase, l.Date, papd, dayofweek(l.Date) BETWEEN 1 AND 5 AS weekday, CASE WHEN papd > 0 THEN NULL ELSE lst END AS streak_id
    FROM l LEFT JOIN (SELECT SignalID, min("Asof") AS "Asof" FROM corridors GROUP BY ALL) c ON l.SignalID = c.SignalID
    WHERE l.Date >= greatest(DATE '{START}', coalesce("Asof", (SELECT min(Date) FROM ped_daily))))""",
       "p0": f"""SELECT {I}, weekday, CASE WHEN x = 0 THEN 1 WHEN v = 0 OR v IS NULL THEN 1 ELSE
    list_sum([exp((m * m / v + k) * ln(m / v) - m / v - lgamma(m * m / v + k + 1)) FOR k IN range(400)]) END AS p0
    FROM (SELECT {I}, weekday, avg(papd) AS m, var_pop(papd) AS v, max(papd) AS x FROM dense GROUP BY ALL HAVING count(*) > 2)""",
       "pau": f"""SELECT * FROM (WITH s AS (SELECT d.*, p0 FROM dense d LEFT JOIN p0 USING (SignalID, Detector, CallPhase, weekday)),
    r AS (SELECT *, CASE WHEN streak_id IS NULL THEN 0 WHEN count(*) FILTER (p0 IS NULL) OVER w = 0 THEN 1 - exp(sum(ln(p0)) OVER w) END AS problow
      FROM s WINDOW w AS (PARTITION BY {I}, streak_id))
    SELECT {I}, Date, {dow('Date')} AS DOW, {week('Date')} AS Week, papd, problow, CASE WHEN h THEN 1 ELSE 0 END AS probhigh,
      CASE WHEN problow > 0.99 OR h THEN 0 WHEN problow <= 0.99 AND NOT h THEN 1 END AS uptime, 1 AS "all"
    FROM (SELECT r.*, hh.SignalID IS NOT NULL AS h FROM r LEFT JOIN high_since hh USING (SignalID, Detector, CallPhase, Date)) WHERE Date >= DATE '{CALC}')"""}


def pau(t):
    return ped.ped_input_uptime(t.ped_daily, t.ped_hourly, t.corridors, START, CALC)


def kept_pau(t):
    return t.kept("pau", lambda: pau(t))


register("e1_ped_inputs_too_high", lambda t: ped.too_high(t.ped_hourly).drop("toohigh"), "SELECT * FROM high", extra=PAU)
register("e2_low_press_probability", lambda t: ped.low_press_probability(
    t.ped_daily.withColumn("weekday", F.dayofweek("Date").isin(2, 3, 4, 5, 6))),
    PAU["p0"].replace("FROM dense", "FROM (SELECT *, dayofweek(Date) BETWEEN 1 AND 5 AS weekday FROM ped_daily)"), "p0")
register("e3_ped_input_uptime", pau, "SELECT * FROM pau", "papd problow", extra=PAU)
register("e4_bad_ped_inputs", lambda t: ped.bad_ped_inputs(kept_pau(t)), "SELECT SignalID, Detector, Date FROM pau WHERE uptime = 0", extra=PAU)
register("e5_imputed_presses", lambda t: ped.impute_presses(kept_pau(t)), f"""
SELECT * REPLACE (CASE WHEN uptime = 1 THEN papd ELSE floor(avg(papd) FILTER (uptime = 1) OVER (PARTITION BY {I}, date_trunc('month', Date))) END AS papd) FROM pau""",
         "papd problow", extra=PAU)
for name, src, m in (("15min", "counts_15min", 15), ("1hr", "counts_1hr", 60)):
    register(f"e6_good_presses_{name}", lambda t, src=src, m=m: ped.good_period_presses(
        getattr(t, src), ped.bad_ped_inputs(kept_pau(t)), m, "pa15" if m == 15 else "paph"), f"""
    WITH r AS (SELECT * FROM {src} s WHERE NOT EXISTS (SELECT 1 FROM pau p WHERE p.uptime = 0 AND p.SignalID = s.SignalID AND p.Detector = s.Detector AND p.Date = CAST(s.Timeperiod AS DATE))),
    p AS (SELECT SignalID, Timeperiod, CAST(sum(vol) AS BIGINT) AS v FROM r GROUP BY ALL),
    g AS (SELECT SignalID, unnest(generate_series((SELECT date_trunc('day', min(Timeperiod)) FROM r), (SELECT date_trunc('day', max(Timeperiod)) + INTERVAL {1440 - m} MINUTE FROM r), INTERVAL {m} MINUTE)) AS Timeperiod FROM (SELECT DISTINCT SignalID FROM r))
    SELECT g.SignalID, g.Timeperiod, coalesce(v, 0) AS {'pa15' if m == 15 else 'paph'} FROM g LEFT JOIN p USING (SignalID, Timeperiod)""", extra=PAU)

# ---- cameras ----------------------------------------------------------------
CAM = {"activity": """SELECT CameraID, Date, coalesce(stddev_samp(Size), 0) AS Size FROM (SELECT DISTINCT * FROM camera_log) GROUP BY ALL""",
       "camtree": """SELECT c.CameraID, c.Location, c.As_of_Date, c.SignalID, k.Zone_Group, k.Zone, k.Corridor, k.Subcorridor FROM cam_config c
         LEFT JOIN (SELECT DISTINCT SignalID, Zone_Group, Zone, Corridor, Subcorridor FROM corridors) k ON c.SignalID = k.SignalID""",
       "camup": """SELECT g.CameraID, g.d AS Date, CASE WHEN a.CameraID IS NULL THEN 0.0 ELSE 1.0 END AS up, 1.0 AS num, CASE WHEN a.CameraID IS NULL THEN 0.0 ELSE 1.0 END AS uptime,
         SignalID, Zone_Group, Zone, Corridor, Subcorridor FROM (SELECT *, CAST(unnest(generate_series(CAST((SELECT min(Date) FROM activity WHERE Size > 0) AS TIMESTAMP), CAST((SELECT max(Date) FROM activity WHERE Size > 0) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM camtree) g
         LEFT JOIN (SELECT DISTINCT CameraID, Date FROM activity WHERE Size > 0) a ON a.CameraID = g.CameraID AND a.Date = g.d WHERE g.d >= As_of_Date"""}
_enc = CAM["camup"].replace("FROM activity WHERE Size > 0", "FROM camera_log WHERE Size > 20")
CAM["camenc"] = _enc
CAM_START = "2023-12-20"  # before the first day of the log


def _since_start(sql, seen):
    """The range of days also has the start if a configured camera was never up."""
    silent = f"EXISTS (SELECT 1 FROM camtree WHERE CameraID NOT IN (SELECT CameraID FROM {seen}))"
    up_days = f"FROM {seen} AND CameraID IN (SELECT CameraID FROM camtree)"
    for f, pick in (("min", "least"), ("max", "greatest")):
        old = f"(SELECT {f}(Date) FROM {seen})"
        assert old in sql
        sql = sql.replace(old, f"(SELECT CASE WHEN {silent} THEN {pick}({f}(Date), DATE '{CAM_START}') ELSE {f}(Date) END {up_days})")
    return sql


CAM["camup"], CAM["camenc"] = _since_start(CAM["camup"], "activity WHERE Size > 0"), _since_start(CAM["camenc"], "camera_log WHERE Size > 20")
CAM["comb"] = """SELECT * FROM (WITH b AS (SELECT CameraID, Date, Zone_Group, Zone, Corridor, Subcorridor, coalesce(max(u5), 0) AS up_web, coalesce(max(ue), 0) AS up_enc FROM
    (SELECT CameraID, Date, Zone_Group, Zone, Corridor, Subcorridor, up AS u5, NULL AS ue FROM camup UNION ALL SELECT CameraID, Date, Zone_Group, Zone, Corridor, Subcorridor, NULL, up FROM camenc
      UNION ALL SELECT CameraID, Date, Zone_Group, Zone, Corridor, Subcorridor, NULL, NULL FROM
      (SELECT DISTINCT CameraID, Zone_Group, Zone, Corridor, Subcorridor FROM (SELECT * FROM camup UNION ALL SELECT * FROM camenc)) CROSS JOIN (SELECT DISTINCT Date FROM (SELECT * FROM camup UNION ALL SELECT * FROM camenc))) GROUP BY ALL)
    SELECT *, up_web AS uptime, 1.0 AS num, greatest(up_web * 2, up_enc) AS up FROM b WHERE Date NOT IN (SELECT Date FROM b GROUP BY Date HAVING avg(up_web) < 0.2))"""


def cams(t):
    return cfg.camera_config(t.cam_config, t.corridors)


def cam_up(t):
    return up.daily_camera_uptime(up.camera_activity(t.camera_log), cams(t), CAM_START)


def enc_up(t):
    return up.daily_camera_uptime(t.camera_log.where(F.col("Size") > 20), cams(t), CAM_START)


def combined(t):
    return up.combined_camera_uptime(cam_up(t), enc_up(t))


def kept_combined(t):
    return t.kept("combined_camera_uptime", lambda: combined(t))


register("d3_camera_config", cams, "SELECT * FROM camtree", extra=CAM)
register("q1_camera_activity", lambda t: up.camera_activity(t.camera_log), "SELECT * FROM activity", "Size", extra=CAM)
register("q2_daily_camera_uptime", cam_up, "SELECT * FROM camup", "up num uptime", extra=CAM)
register("q3_combined_camera_uptime", combined, "SELECT * FROM comb", "up num uptime up_web up_enc", extra=CAM)
register("q4_daily_avg_camera", lambda t: up.daily_avg_camera(cam_up(t)), rs.period_avg("SELECT * FROM camup", "uptime", "Date", "num", "CameraID"), "uptime num delta", extra=CAM)
PL = "CameraID, Zone_Group, Zone, Corridor, Subcorridor"
_wk = rs.tuesday(rs.delta(rs.mean(f"SELECT *, {week('Date')} AS Week FROM comb", f"{PL}, Week", "uptime", "num"), PL, "Week", "uptime"), "SELECT * FROM comb")
register("q4_weekly_avg_camera", lambda t: up.weekly_avg_camera(kept_combined(t)), _wk, "uptime num delta", extra=CAM)
register("q4_monthly_avg_camera", lambda t: up.monthly_avg_camera(kept_combined(t)),
         f"SELECT {PL}, CAST(date_trunc('month', Date) AS DATE) AS Month, sum(uptime) AS up, {rs.wmean('uptime', 'num')} AS uptime, sum(num) AS num FROM comb GROUP BY ALL", "up uptime num", extra=CAM)
for per, key in (("week", f"greatest((SELECT min(Date) FROM comb), CAST(DATE '2016-12-25' + CAST({week('Date')} * 7 + 2 AS INTEGER) AS DATE)) AS Date"),
                 ("month", "CAST(date_trunc('month', Date) AS DATE) AS Month")):
    register(f"q4_cor_{per}ly_camera_sums", lambda t, p=per: up.cor_camera_uptime(kept_combined(t), p),
             f"SELECT * FROM (SELECT {key.replace(' AS Date', ' AS k').replace(' AS Month', ' AS k')}, Corridor, Zone_Group, sum(up) AS up, sum(num) AS num, sum(up) / sum(num) AS uptime FROM comb WHERE Corridor IS NOT NULL GROUP BY ALL)".replace("SELECT * FROM (", f"SELECT k AS {'Date' if per == 'week' else 'Month'}, Corridor, Zone_Group, up, num, uptime FROM (", 1),
             "up num uptime", extra=CAM)


def _cor(src, per):
    cor = rs.delta(rs.mean(f"SELECT * FROM ({src}) WHERE Corridor IS NOT NULL", f"Zone_Group, Zone, Corridor, {per}", "uptime", "num"), "Zone_Group, Zone, Corridor", per, "uptime")
    return rs.zone_groups(cor, "uptime", per, "num")


_sub = "SELECT Zone AS Zone_Group, Corridor AS Zone, Subcorridor AS Corridor, Date, uptime, num FROM comb WHERE Subcorridor IS NOT NULL"
register("q4_cor_daily_camera_uptime", lambda t: up.cor_camera_rollup(kept_combined(t)), rs.with_week(_cor("SELECT * FROM comb", "Date")), "uptime num delta", extra=CAM)
register("q4_sub_daily_camera_uptime", lambda t: up.cor_camera_rollup(kept_combined(t), sub=True), rs.with_week(_cor(_sub, "Date")), "uptime num delta", extra=CAM)
register("q4_cor_weekly_camera_uptime", lambda t: up.cor_camera_rollup(up.weekly_avg_camera(kept_combined(t))), rs.with_week(_cor(_wk, "Date")), "uptime num delta", extra=CAM)
register("q5_rsu_uptime", lambda t: up.rsu_uptime(
    cam_up(t).groupBy("SignalID", "Date").agg(F.max("uptime").alias("uptime"), F.count(F.lit(1)).alias("count")),
    t.cam_config), """
WITH r AS (SELECT SignalID, Date, max(uptime) AS uptime, count(*) AS n FROM camup GROUP BY ALL),
f AS (SELECT r.* FROM r JOIN (SELECT SignalID, min(Date) AS d FROM r WHERE uptime = 1 GROUP BY ALL) s ON r.SignalID = s.SignalID AND r.Date >= s.d)
SELECT SignalID, Date, uptime, n AS total FROM f WHERE Date NOT IN (SELECT Date FROM f GROUP BY Date HAVING avg(uptime) < 0.2)""", "uptime", extra=CAM)
