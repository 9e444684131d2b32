"""Travel time, safety, crash and delay-cost queries."""

from pyspark.sql import functions as F

from greenwave.functions import sketches as sk, timeparts as tp
from greenwave.operators import rollup as ru, serve as sv, travel as tv
from greenwave.plans import rollup_sql as rs
from greenwave.plans.adapters_sql import week
from greenwave.plans.catalog.rollups import VPH, hourly_volume, midweek
from greenwave.plans.registry import register
from greenwave.session import cut_lineage

TT = {"stt": """SELECT DISTINCT r.tmc_code, s.Corridor, s.Subcorridor, Hour, s.miles, reference_speed, travel_time_minutes, speed,
        s.miles / nullif(reference_speed, 0) * 60 AS reference_minutes, CAST(Hour AS DATE) AS date FROM (SELECT * EXCLUDE (Corridor, miles) FROM travel_times) r JOIN segments s ON r.tmc_code = s.tmc_code"""}


def stt(t):
    return tv.segment_travel_times(t.travel_times.drop("Corridor", "miles"), t.segments)


register("t1_segment_travel_times", stt, "SELECT * FROM stt", "miles reference_speed travel_time_minutes speed reference_minutes", extra=TT)


def ttm_sql(keys, cond):
    return f"""SELECT {keys}, h AS Hour, avg(t) / nullif(avg(r), 0) AS tti, quantile_cont(t, 0.9) / nullif(avg(r), 0) AS pti,
    quantile_cont(t, 0.9) / nullif(avg(r), 0) - avg(t) / nullif(avg(r), 0) AS bi, avg(sp) AS speed_mph FROM (
    SELECT {keys}, {rs.MONTH_HOUR} AS h, t, r, m / nullif(t / 60, 0) AS sp FROM (
    SELECT {keys}, Hour, sum(travel_time_minutes) AS t, sum(reference_minutes) AS r, sum(miles) AS m FROM stt WHERE {cond} GROUP BY ALL)) GROUP BY ALL"""


register("t2_corridor_travel_time_metrics", lambda t: ti(t),
         ttm_sql("Corridor", "Corridor <> 'None'"), "tti pti bi speed_mph", extra=TT)
register("t2_subcorridor_travel_time_metrics", lambda t: tv.travel_time_metrics(tv.corridor_travel_times(stt(t), True), ["Corridor", "Subcorridor"], t.travel_times.count()),
         ttm_sql("Corridor, Subcorridor", "Subcorridor <> 'None'"), "tti pti bi speed_mph", extra=TT)
register("t3_relative_speed_index", lambda t: tv.relative_speed_index(t.travel_times, t.speed_limits),
         "SELECT *, speed / Speed_Limit AS rsi FROM (SELECT Corridor, quantile_cont(speed, 0.9) AS speed FROM travel_times GROUP BY ALL) JOIN speed_limits USING (Corridor)", "speed rsi")


def month_of_hour():
    return F.trunc(F.col("Hour").cast("date"), "month").alias("Month")


def speed_index_from_sketches(t):
    """Sketches by day and segment are stored, merged to corridors and months, and their ranks checked against the rows."""
    times = t.travel_times
    daily = cut_lineage(sk.quantile_sketches(times, ["Corridor", "tmc_code", F.col("Hour").cast("date").alias("Date")], "speed"))
    merged = sk.merged_sketches(daily, ["Corridor", F.trunc("Date", "month").alias("Month")])
    estimate = merged.select("Corridor", "Month", "n", sk.sketch_quantile(0.9).alias("estimate"))
    rows = times.withColumn("Month", month_of_hour())
    checked = sk.with_exact_rank(estimate, rows, ["Corridor", "Month"], "speed", "estimate")
    return checked.join(t.speed_limits, "Corridor").select("Corridor", "Month", "n", "Speed_Limit", sk.rank_within(0.9).alias("rank_within_1_percent"))


register("t3_speed_index_from_sketches", speed_index_from_sketches, """
SELECT Corridor, Month, n, Speed_Limit, true AS rank_within_1_percent FROM (
  SELECT Corridor, CAST(date_trunc('month', Hour) AS DATE) AS Month, count(*) AS n FROM travel_times GROUP BY ALL) JOIN speed_limits USING (Corridor)""", "Speed_Limit")


def injury(t):
    return t.travel_times.select(F.col("speed").alias("mph_bin")).distinct().withColumn("pct", F.col("mph_bin") * F.col("mph_bin") / 10000)


def bpsi_sql(keys):
    return f"""SELECT {keys}, sum(n / tot * pct) AS overall_pct FROM (SELECT *, sum(n) OVER (PARTITION BY {keys}) AS tot FROM (
    SELECT {keys}, speed, CAST(count(*) AS DOUBLE) AS n FROM (SELECT *, CAST(date_trunc('month', Hour) AS DATE) AS Month FROM stt) WHERE speed >= 20 AND hour(Hour) IN (9, 10, 19, 20) GROUP BY ALL))
    JOIN (SELECT DISTINCT speed, speed * speed / 10000 AS pct FROM travel_times) USING (speed) GROUP BY ALL"""


register("t4_bike_ped_safety_index", lambda t: tv.bike_ped_safety_index(stt(t), injury(t)), bpsi_sql("Corridor"), "overall_pct", extra=TT)


def series(t, which):
    rows = stt(t).withColumn("Month", tp.month_start("Hour"))
    one = lambda g: tv.bike_ped_safety_index(rows, injury(t), [*g, "Month"]).withColumnRenamed("overall_pct", "bpsi")
    return tv.monthly_index_series(one(["Corridor"]), one(["Corridor", "Subcorridor"]), t.corridors, "bpsi")[which]


register("t5_monthly_safety_sub", lambda t: series(t, "sub"), rs.delta(
    f"SELECT Corridor AS Zone_Group, Subcorridor AS Corridor, Month, overall_pct AS bpsi FROM ({bpsi_sql('Corridor, Subcorridor, Month')}) UNION ALL SELECT Corridor, Corridor, Month, overall_pct FROM ({bpsi_sql('Corridor, Month')})",
    "Zone_Group, Corridor", "Month", "bpsi"), "bpsi delta", extra=TT)
register("t5_monthly_safety_cor", lambda t: series(t, "cor"), rs.delta(
    f"SELECT b.Corridor, Month, overall_pct AS bpsi, Zone_Group FROM ({bpsi_sql('Corridor, Month')}) b LEFT JOIN (SELECT DISTINCT Zone_Group, Corridor FROM corridors) c ON b.Corridor = c.Corridor",
    "Zone_Group, Corridor", "Month", "bpsi"), "bpsi delta", extra=TT)



def speed_series(t, which):
    rows = stt(t).withColumn("Month", tp.month_start("Hour"))
    one = lambda g: tv.relative_speed_index(rows, t.speed_limits, [*g, "Month"]).drop("speed", "Speed_Limit")
    return tv.monthly_index_series(one(["Corridor"]), one(["Corridor", "Subcorridor"]), t.corridors, "rsi")[which]


def rsi_sql(keys):
    return f"""SELECT * EXCLUDE (speed, Speed_Limit), speed / nullif(Speed_Limit, 0) AS rsi FROM (SELECT {keys}, quantile_cont(speed, 0.9) AS speed FROM
    (SELECT *, CAST(date_trunc('month', Hour) AS DATE) AS Month FROM stt) GROUP BY ALL) JOIN speed_limits USING (Corridor)"""


register("t5_monthly_speed_sub", lambda t: speed_series(t, "sub"), rs.delta(
    f"SELECT Corridor AS Zone_Group, Subcorridor AS Corridor, Month, rsi FROM ({rsi_sql('Corridor, Subcorridor, Month')}) UNION ALL SELECT Corridor, Corridor, Month, rsi FROM ({rsi_sql('Corridor, Month')})",
    "Zone_Group, Corridor", "Month", "rsi"), "rsi delta", extra=TT)
register("t5_monthly_speed_cor", lambda t: speed_series(t, "cor"), rs.delta(
    f"SELECT b.Corridor, Month, rsi, Zone_Group FROM ({rsi_sql('Corridor, Month')}) b LEFT JOIN (SELECT DISTINCT Zone_Group, Corridor FROM corridors) c ON b.Corridor = c.Corridor",
    "Zone_Group, Corridor", "Month", "rsi"), "rsi delta", extra=TT)

# ---- travel index weighted by hourly volume ---------------------------------
_mo = rs.monthly_hourly_volume(VPH["vph"], "vph")
_s, _w = rs.ones(_mo, None)
TI = {**TT, "corvph": rs.corridor_means(_s, "vph", "Hour", _w), "ti": ttm_sql("Corridor", "Corridor <> 'None'")}


def ti(t):
    return tv.travel_time_metrics(tv.corridor_travel_times(stt(t)), rows=t.travel_times.count())


def cor_vph(t):
    hourly = ru.monthly_hourly_volume(hourly_volume(t, "vph"), "vph").withColumn("ones", F.lit(1.0))
    return ru.corridor_means(hourly, t.corridors, "vph", "Hour", "ones", rows=t.base("lineitem").count())


def weighted_sql(by):
    return f"""SELECT t.Corridor, t.Hour, tti, pti, bi, speed_mph, c.Zone_Group, c.Zone, hour(t.Hour) AS hr, coalesce(w.pct, 1) AS pct FROM ti t
    LEFT JOIN (SELECT DISTINCT Zone_Group, Zone, Corridor FROM corridors) c ON t.Corridor = c.Corridor
    LEFT JOIN (SELECT Zone_Group, Zone, Corridor, hour(Hour) AS hr, avg(pct) AS pct FROM (SELECT *, vph / nullif(sum(vph) OVER (PARTITION BY Zone_Group, Zone, Corridor, {by}), 0) AS pct FROM corvph) GROUP BY ALL) w
      ON w.Zone_Group = c.Zone_Group AND w.Zone = c.Zone AND w.Corridor = c.Corridor AND w.hr = hour(t.Hour)"""


def weighted(t, weekly=False):
    return tv.weighted_travel_index(ti(t), cor_vph(t), t.corridors, weekly)


register("t6_monthly_travel_index_weights", weighted, weighted_sql("month(Hour)"), "tti pti bi speed_mph pct", extra=TI)
register("t6_weekly_travel_index_weights", lambda t: weighted(t, True), weighted_sql(week("CAST(Hour AS DATE)")), "tti pti bi speed_mph pct", extra=TI)


def ti_rollup_sql(src, x, per, drop=True):
    cor = rs.delta(rs.mean(f"SELECT * FROM ({src}) WHERE Corridor IS NOT NULL", f"Zone_Group, Zone, Corridor, {per}", x, "pct"), "Zone_Group, Zone, Corridor", per, x)
    if drop:
        cor = f"SELECT * FROM ({cor}) WHERE {x} IS NOT NULL"
    return rs.zone_groups(cor, x, per, "pct")


for x in ("tti", "pti", "bi", "speed_mph"):
    register(f"t7_cor_monthly_{x}_by_hr", lambda t, x=x: tv.travel_index_rollup(weighted(t), x, "hour"),
             ti_rollup_sql(weighted_sql("month(Hour)"), x, "Hour", False), f"{x} pct delta", extra=TI)
    register(f"t7_cor_monthly_{x}_by_day", lambda t, x=x: tv.travel_index_rollup(weighted(t), x, "month"),
             ti_rollup_sql(f"SELECT *, CAST(Hour AS DATE) AS Month FROM ({weighted_sql('month(Hour)')})", x, "Month"), f"{x} pct delta", extra=TI)
register("t7_cor_weekly_tti_by_day", lambda t: tv.travel_index_rollup(weighted(t, True), "tti", "week"),
         rs.with_week(ti_rollup_sql(f"SELECT *, CAST(Hour AS DATE) AS Date FROM ({weighted_sql(week('CAST(Hour AS DATE)'))})", "tti", "Date")), "tti pct delta", extra=TI)
_tti_h = ti_rollup_sql(weighted_sql("month(Hour)"), "tti", "Hour", False)
_pti_h = ti_rollup_sql(weighted_sql("month(Hour)"), "pti", "Hour", False)
register("v6_buffer_index_by_hour", lambda t: sv_buffer(t), f"SELECT Zone_Group, Corridor, Hour, tti, pti, pti - tti AS bi FROM ({_tti_h}) a FULL JOIN (SELECT Zone_Group, Corridor, Hour, pti FROM ({_pti_h})) b USING (Zone_Group, Corridor, Hour)",
         "tti pti bi", extra=TI)


def sv_buffer(t):
    w = weighted(t)
    return tv.buffer_index(tv.travel_index_rollup(w, "tti", "hour"), tv.travel_index_rollup(w, "pti", "hour"), "Hour")


# ---- delay cost -------------------------------------------------------------
UDC = {"udch": f"""SELECT Zone, Corridor, CAST(date_trunc('month', date) AS DATE) AS Month, date_trunc('hour', date) - to_days(CAST(day(date) - 1 AS INTEGER)) AS month_hour, sum(delay_cost) AS delay_cost
        FROM delay_costs GROUP BY ALL""",
       "udcm": "SELECT Zone, Corridor, CAST(date_trunc('month', date) AS DATE) AS Month, sum(delay_cost) AS cost FROM delay_costs GROUP BY ALL"}
TREND = """WITH tg AS (SELECT DISTINCT Month FROM udcm WHERE Month > (SELECT min(Month) FROM udcm)),
p AS (SELECT DISTINCT u.Zone, u.Corridor, tg.Month FROM udcm u JOIN tg ON u.Month IN (tg.Month, tg.Month - INTERVAL 1 MONTH, tg.Month - INTERVAL 12 MONTH)),
j AS (SELECT p.*, a.cost AS current_month, b.cost AS last_month, c.cost AS last_year FROM p
  LEFT JOIN udcm a ON a.Zone = p.Zone AND a.Corridor = p.Corridor AND a.Month = p.Month
  LEFT JOIN udcm b ON b.Zone = p.Zone AND b.Corridor = p.Corridor AND b.Month = CAST(p.Month - INTERVAL 1 MONTH AS DATE)
  LEFT JOIN udcm c ON c.Zone = p.Zone AND c.Corridor = p.Corridor AND c.Month = CAST(p.Month - INTERVAL 12 MONTH AS DATE))
SELECT *, (current_month - last_month) / nullif(last_month, 0) AS month_over_month, (current_month - last_year) / nullif(last_year, 0) AS year_over_year FROM j"""
_costs = "current_month last_month last_year month_over_month year_over_year"
register("t8_hourly_delay_cost", lambda t: tv.hourly_delay_cost(t.delay_costs), "SELECT * FROM udch", "delay_cost", 3, extra=UDC)
register("t8_delay_cost_trend", lambda t: tv.delay_cost_trend(t.delay_costs), TREND, _costs, 3, extra=UDC)
register("v3_delay_cost_trend_documents", lambda t: sv.query_delay_trend(sv.store_delay_trend(tv.delay_cost_trend(t.delay_costs))), TREND, _costs, 3, extra=UDC)
register("v3_delay_cost_hourly", lambda t: sv.query_delay_hourly(tv.hourly_delay_cost(t.delay_costs), "Zone 1", "2024-06-01"),
         "SELECT * FROM udch WHERE Zone = 'Zone 1' AND Month <= DATE '2024-06-01'", "delay_cost", 3, extra=UDC)
register("v14_delay_cost_comparison", lambda t: sv.delay_cost_comparison(tv.hourly_delay_cost(t.delay_costs)), " UNION ALL ".join(
    f"SELECT Zone, Corridor, month_hour + INTERVAL {n} MONTH AS month_hour, '{p}' AS period, delay_cost FROM udch WHERE Month = (SELECT CAST(max(Month) - INTERVAL {n} MONTH AS DATE) FROM udch)"
    for p, n in (("current_month", 0), ("last_month", 1), ("last_year", 12))), "delay_cost", 3, extra=UDC)
register("t9_delay_cost_run_list", lambda t: tv.delay_cost_run_list(t.corridors.withColumn("Zone", F.concat(F.lit("Zone "), F.col("Zone"))), t.segments, "Zone")
         .select("Zone", "Corridor", F.array_join("tmcs", ",").alias("tmcs")),
         "SELECT 'Zone ' || Zone AS Zone, Corridor, string_agg(tmc_code, ',' ORDER BY tmc_code) AS tmcs FROM (SELECT DISTINCT Zone, Corridor FROM corridors) JOIN (SELECT DISTINCT Corridor, tmc_code FROM segments) USING (Corridor) GROUP BY ALL")


def bottlenecks(t):
    now = t.travel_times.where(F.col("speed") < 40).groupBy("Corridor").agg(F.collect_set("tmc_code").alias("tmcs_current"))
    year = t.travel_times.where(F.col("speed") >= 40).groupBy("Corridor").agg(F.collect_set("tmc_code").alias("tmcs_1yr"))
    rows = now.join(year, "Corridor")
    return tv.bottleneck_lengths(rows, t.segments.withColumn("length", F.col("miles")), "Corridor",
                                 {"tmcs_current": "length_current", "tmcs_1yr": "length_1yr"})


_len = lambda c: f"(SELECT Corridor, sum(miles) AS l FROM (SELECT DISTINCT Corridor, tmc_code FROM travel_times WHERE {c}) JOIN (SELECT tmc_code, miles FROM segments) USING (tmc_code) GROUP BY ALL)"
register("t11_bottleneck_lengths", bottlenecks, f"SELECT Corridor, a.l AS length_current, b.l AS length_1yr FROM {_len('speed < 40')} a JOIN {_len('speed >= 40')} b USING (Corridor)",
         "length_current length_1yr")

# ---- crashes ----------------------------------------------------------------
_vpd = rs.monthly_avg_by_day(f"SELECT * FROM metrics_daily WHERE {rs.MIDWEEK}", "vpd")
_cr = ("crashes_k", "crashes_a", "crashes_b", "crashes_c", "crashes_o", "crashes_total", "cost")
CRASH = {"mvpd": _vpd,
         "cdense": f"""SELECT k.SignalID, m.Month, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _cr)} FROM (SELECT DISTINCT SignalID FROM crashes) k CROSS JOIN (SELECT DISTINCT Month FROM crashes) m
          LEFT JOIN crashes c ON c.SignalID = k.SignalID AND c.Month = m.Month""",
         "croll": f"""SELECT SignalID, Month, {', '.join(f'sum({c}) OVER w AS {c}' for c in _cr)} FROM cdense WINDOW w AS (PARTITION BY SignalID ORDER BY Month ROWS BETWEEN 35 PRECEDING AND CURRENT ROW)""",
         "vroll": """SELECT SignalID, Month, vpd, avg(vpd) OVER (PARTITION BY SignalID ORDER BY Month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS vpd12 FROM
          (SELECT k.SignalID, m.Month, vpd FROM (SELECT DISTINCT SignalID FROM mvpd) k CROSS JOIN (SELECT DISTINCT Month FROM mvpd) m LEFT JOIN mvpd v ON v.SignalID = k.SignalID AND v.Month = m.Month)""",
         "crates": f"""SELECT SignalID, Month, {', '.join(_cr)}, vpd, vpd12, crashes_total * 1000.0 / nullif(vpd * 3, 0) AS cri, cost / nullif(vpd * 3, 0) AS kabco, Month AS Date, 0 AS CallPhase
          FROM (SELECT r.* EXCLUDE (Month), m.Month FROM (SELECT * FROM croll WHERE Month = (SELECT max(Month) FROM croll)) r CROSS JOIN (SELECT DISTINCT Month FROM mvpd) m) x FULL JOIN vroll v USING (SignalID, Month)"""}


def mvpd(t):
    return t.kept("monthly_vpd", lambda: ru.monthly_avg_by_day(midweek(t.metrics_daily), "vpd"))


def crates(t):
    return tv.monthly_crash_rates(t.crashes, mvpd(t))


def kept_crates(t):
    return t.kept("crash_rates", lambda: crates(t))


register("t10_rolling_crashes", lambda t: tv.rolling_crashes(t.crashes), f"SELECT SignalID, Month, {', '.join(f'CAST({c} AS {'DOUBLE' if c == 'cost' else 'BIGINT'}) AS {c}' for c in _cr)} FROM croll", "cost", 2, extra=CRASH)
register("w6_rolling_volume", lambda t: tv.rolling_volume(mvpd(t)), "SELECT * FROM vroll", "vpd vpd12", extra=CRASH)
register("t10_monthly_crash_rates", crates, f"SELECT * REPLACE ({', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in _cr[:-1])}) FROM crates", "cost vpd vpd12 cri kabco", 3, extra=CRASH)
for x in ("cri", "kabco"):
    sig = rs.monthly_avg_by_day(f"SELECT SignalID, CallPhase, Date, {x} FROM crates", x)
    register(f"t10_monthly_{x}", lambda t, x=x: tv.crash_index(kept_crates(t), x), sig, f"{x} delta", extra=CRASH)
    register(f"t10_cor_monthly_{x}", lambda t, x=x: ru.cor_monthly_avg_by_day(tv.crash_index(kept_crates(t), x), t.corridors, x),
             rs.corridor_rollup(sig, x, "Month"), f"{x} delta", extra=CRASH)
