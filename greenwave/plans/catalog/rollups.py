"""Roll-up queries: one row per metric, resolution and level."""

from pyspark.sql import functions as F

from greenwave.functions import timeparts as tp
from greenwave.operators import counts as ct, rollup as ru
from greenwave.operators.lattice import lattice
from greenwave.plans import rollup_sql as rs
from greenwave.plans.adapters_sql import week, dow
from greenwave.plans.catalog.counts import UPTIME_SQL, filtered
from greenwave.plans.registry import register

# ---- flagship ---------------------------------------------------------------
_vpd = f"SELECT SignalID, CallPhase, CAST(Timeperiod AS DATE) AS Date, CAST(sum(vol) AS DOUBLE) AS vpd, {week('CAST(Timeperiod AS DATE)')} AS Week, {dow('CAST(Timeperiod AS DATE)')} AS DOW FROM counts_1hr WHERE CallPhase IN (2, 6) GROUP BY SignalID, CallPhase, CAST(Timeperiod AS DATE)"
_wk = rs.weekly_sum_by_day(f"SELECT * FROM ({_vpd}) WHERE {rs.MIDWEEK}", "vpd")


def midweek(df):
    return df.where(F.col("DOW").isin(tp.TUE, tp.WED, tp.THU))


register("flagship_weekly_corridor_volume",
         lambda t: ru.cor_weekly_avg_by_day(ru.weekly_sum_by_day(midweek(ct.daily_volume(t.counts_1hr)), "vpd"), t.corridors, "vpd"),
         rs.with_week(rs.corridor_rollup(_wk, "vpd", "Date")), "vpd delta")

# ---- daily metrics ----------------------------------------------------------
for m, mid in (("vpd", True), ("papd", True), ("vph", False)):
    label = "throughput" if m == "vph" else m
    cut = (lambda df: midweek(df)) if mid else (lambda df: df)
    src = f"SELECT * FROM metrics_daily WHERE {rs.MIDWEEK}" if mid else "SELECT * FROM metrics_daily"
    weekly = lambda t, m=m, cut=cut: ru.weekly_sum_by_day(cut(t.metrics_daily), m)
    monthly = lambda t, m=m, cut=cut: ru.monthly_avg_by_day(cut(t.metrics_daily), m)
    wk, mo = rs.weekly_sum_by_day(src, m), rs.monthly_avg_by_day(src, m)
    register(f"r5_weekly_{label}", weekly, wk, f"{m} delta")
    register(f"r7_monthly_{label}", monthly, mo, f"{m} delta")
    register(f"r11_cor_weekly_{label}", lambda t, f=weekly, m=m: ru.cor_weekly_avg_by_day(f(t), t.corridors, m),
             rs.with_week(rs.corridor_rollup(wk, m, "Date")), f"{m} delta")
    register(f"r11_cor_monthly_{label}", lambda t, f=monthly, m=m: ru.cor_monthly_avg_by_day(f(t), t.corridors, m),
             rs.corridor_rollup(mo, m, "Month"), f"{m} delta")

# ---- hourly ratio metrics ---------------------------------------------------
register("r4_daily_aog", lambda t: ru.daily_avg(t.metrics_hourly, "aog", "vol", True),
         rs.period_avg(f"SELECT * FROM metrics_hourly WHERE {rs.PEAK.format(c='Date_Hour')}", "aog", "Date", "vol"), "aog delta")
register("r4_daily_sum_paph", lambda t: ru.daily_sum(t.metrics_hourly, "paph"),
         rs.period_sum("SELECT * FROM metrics_hourly", "paph", "Date"), "paph delta")
for m, w, label in (("aog", "vol", "aog"), ("pr", "vol", "pr"), ("sf_freq", "cycles", "sf"), ("qs_freq", "cycles", "qs")):
    src = "SELECT * FROM metrics_hourly"
    weekly = lambda t, m=m, w=w: ru.weekly_avg_by_day(t.metrics_hourly, m, w, True)
    monthly = lambda t, m=m, w=w: ru.monthly_avg_by_day(t.metrics_hourly, m, w, True)
    by_hr = lambda t, m=m, w=w: ru.avg_by_hr(t.metrics_hourly, m, w)
    mo_hr = lambda t, m=m, w=w, f=by_hr: ru.monthly_avg_by_hr(f(t), m, w, delta=False)
    wk, mo, hr = rs.weekly_avg_by_day(src, m, w), rs.monthly_avg_by_day(src, m, w, True), rs.avg_by_hr(src, m, w)
    mh = rs.monthly_avg_by_hr(hr, m, w, False)
    f = f"{m} {w} delta"
    register(f"r6_weekly_{label}_by_day", weekly, wk, f)
    register(f"r7_monthly_{label}_by_day", monthly, mo, f)
    register(f"r9_{label}_by_hr", by_hr, hr, f)
    register(f"r10_monthly_{label}_by_hr", mo_hr, mh, f"{m} {w}")
    register(f"r11_cor_weekly_{label}_by_day", lambda t, f=weekly, m=m, w=w: ru.cor_weekly_avg_by_day(f(t), t.corridors, m, w),
             rs.with_week(rs.corridor_rollup(wk, m, "Date", w)), f)
    register(f"r11_cor_monthly_{label}_by_day", lambda t, f=monthly, m=m, w=w: ru.cor_monthly_avg_by_day(f(t), t.corridors, m, w),
             rs.corridor_rollup(mo, m, "Month", w), f)
    register(f"r11_cor_monthly_{label}_by_hr", lambda t, f=mo_hr, m=m, w=w: ru.cor_avg_by_hr(f(t), t.corridors, m, w),
             rs.corridor_rollup(mh, m, "Hour", w, drop_empty=False), f)
    if label == "aog":
        for half, cond in (("am", rs.AM), ("pm", rs.PM)):
            register(f"r11_cor_monthly_aog_peak_{half}",
                     lambda t, f=mo_hr, h=half: ru.cor_peak_means(ru.cor_avg_by_hr(f(t), t.corridors, "aog", "vol"), "aog", "vol", "Date")[h],
                     rs.delta(rs.mean(f"SELECT *, CAST(Hour AS DATE) AS Date FROM ({rs.corridor_rollup(mh, m, 'Hour', w, drop_empty=False)}) WHERE {cond}",
                                      "Zone_Group, Corridor, Date", "aog", "vol"), "Zone_Group, Corridor", "Date", "aog"), "aog vol delta")
register("r10_monthly_aog_by_hr_with_delta", lambda t: ru.monthly_avg_by_hr(t.metrics_hourly.withColumn("Hour", F.col("Date_Hour")), "aog", "vol"),
         rs.monthly_avg_by_hr("SELECT *, Date_Hour AS Hour FROM metrics_hourly", "aog", "vol"), "aog vol delta")

# ---- all levels from one table of partial sums --------------------------------
for m, w, label in (("aog", "vol", "aog"), ("sf_freq", "cycles", "sf")):
    src = "SELECT * FROM metrics_hourly"
    dy = rs.period_avg(f"SELECT * FROM metrics_hourly WHERE {rs.PEAK.format(c='Date_Hour')}", m, "Date", w)
    wk, mo = rs.weekly_avg_by_day(src, m, w), rs.monthly_avg_by_day(src, m, w, True)
    parts = []
    for time, sql, per in (("day", dy, "Date"), ("week", wk, "Date"), ("month", mo, "Month")):
        parts.append(f"SELECT '{time}' AS time, 'signal' AS place, CAST(NULL AS VARCHAR) AS Zone_Group, CAST(SignalID AS VARCHAR) AS name, {per} AS period, {m}, {w}, delta FROM ({sql})")
        parts.append(f"SELECT '{time}', 'corridor', Zone_Group, Corridor, {per}, {m}, {w}, delta FROM ({rs.corridor_rollup(sql, m, per, w)})")
    register(f"r4_r11_all_levels_{label}", lambda t, m=m, w=w: lattice(t.metrics_hourly, t.corridors, m, w), " UNION ALL ".join(parts), f"{m} {w} delta")

# ---- hourly volumes ---------------------------------------------------------
VPH = {m: f"SELECT SignalID, Date_Hour AS Hour, sum({c}) AS {m}, min(Week) AS Week, min(DOW) AS DOW FROM metrics_hourly GROUP BY ALL"
       for m, c in (("vph", "vol"), ("paph", "paph"))}


def hourly_volume(t, m):
    c = {"vph": "vol", "paph": "paph"}[m]
    return t.metrics_hourly.groupBy("SignalID", F.col("Date_Hour").alias("Hour")).agg(
        F.sum(c).alias(m), F.min("Week").alias("Week"), F.min("DOW").alias("DOW"))


for m in ("vph", "paph"):
    src = f"SELECT * FROM ({VPH[m]}) WHERE {rs.MIDWEEK}"
    weekly = lambda t, m=m: ru.weekly_avg_by_hr(midweek(hourly_volume(t, m)), m)
    monthly = lambda t, m=m: ru.monthly_hourly_volume(hourly_volume(t, m), m)
    wk, mo = rs.weekly_avg_by_hr(src, m, phased=False), rs.monthly_hourly_volume(VPH[m], m)
    register(f"r8_weekly_{m}", weekly, wk, f"{m} delta")
    register(f"r10_monthly_{m}", monthly, mo, m)
    cw = lambda t, f=weekly, m=m: ru.cor_avg_by_hr(f(t), t.corridors, m)
    cm = lambda t, f=monthly, m=m: ru.cor_avg_by_hr(f(t), t.corridors, m)
    cws, cms = rs.corridor_rollup(wk, m, "Hour", drop_empty=False), rs.corridor_rollup(mo, m, "Hour", drop_empty=False)
    register(f"r11_cor_weekly_{m}", cw, cws, f"{m} delta")
    register(f"r11_cor_monthly_{m}", cm, cms, f"{m} delta")
    if m == "vph":
        for half, cond in (("am", rs.AM), ("pm", rs.PM)):
            for res, sig, cor, ssql, csql, per in (("weekly", weekly, cw, wk, cws, "Date"), ("monthly", monthly, cm, mo, cms, "Month")):
                register(f"r4_{res}_vph_peak_{half}", lambda t, f=sig, h=half, p=per: ru.peak_means(f(t), "vph", p)[h],
                         rs.period_avg(f"SELECT SignalID, vph, CAST(Hour AS DATE) AS {per} FROM ({ssql}) WHERE {cond}", "vph", per), "vph delta")
                register(f"r11_cor_{res}_vph_peak_{half}", lambda t, f=cor, h=half, p=per: ru.cor_peak_means(f(t), "vph", period=p)[h],
                         rs.delta(rs.avg(f"SELECT *, CAST(Hour AS DATE) AS {per} FROM ({csql}) WHERE {cond}", f"Zone_Group, Corridor, {per}", "vph"),
                                  "Zone_Group, Corridor", per, "vph"), "vph delta")
register("r8_weekly_sf_by_hr", lambda t: ru.weekly_avg_by_hr(t.metrics_hourly.withColumn("Hour", F.col("Date_Hour")), "sf_freq", "cycles"),
         rs.weekly_avg_by_hr("SELECT *, Date_Hour AS Hour FROM metrics_hourly", "sf_freq", "cycles"), "sf_freq cycles delta")
register("d14_hourly_with_hierarchy", lambda t: ru.hourly_with_hierarchy(hourly_volume(t, "vph").select("SignalID", "Hour", "vph"), "vph", t.corridors),
         f"SELECT d.*, Zone_Group, Zone, Corridor FROM ({rs.delta(f'SELECT SignalID, Hour, vph FROM ({VPH['vph']})', 'SignalID', 'Hour', 'vph')}) d JOIN corridors c ON d.SignalID = c.SignalID", "vph delta")

# ---- detector uptime --------------------------------------------------------
AVG_UPTIME = {**UPTIME_SQL, "avg_uptime": f"""SELECT *, 0 AS CallPhase, {week('Date')} AS Week, {rs.dow('Date')} AS DOW FROM (SELECT SignalID, Date, {rs.wmean('uptime', '"all"')} AS uptime, sum("all") AS "all",
  sum(uptime * "all") FILTER (setback = 'Setback') / sum("all") FILTER (setback = 'Setback') AS uptime_sb, sum("all") FILTER (setback = 'Setback') AS all_sb,
  sum(uptime * "all") FILTER (setback = 'Presence') / sum("all") FILTER (setback = 'Presence') AS uptime_pr, sum("all") FILTER (setback = 'Presence') AS all_pr FROM det_uptime GROUP BY ALL)"""}


def avg_uptime(t):
    daily = t.kept("avg_daily_detector_uptime", lambda: ct.avg_daily_detector_uptime(ct.daily_detector_uptime(filtered(t))))
    return daily.withColumns({"CallPhase": F.lit(0), "Week": tp.week_index("Date")})


def weekly_uptime(t):
    return ru.weekly_avg_by_day(avg_uptime(t).drop("delta"), "uptime", "all", peak=False).na.fill({"uptime": 0.0})


_wu = rs.weekly_avg_by_day("SELECT * FROM avg_uptime", "uptime", '"all"', False)
_wu = f"SELECT * REPLACE (coalesce(uptime, 0) AS uptime) FROM ({_wu})"
register("r6_weekly_detector_uptime", weekly_uptime, _wu, "uptime all delta", extra=AVG_UPTIME)
register("r7_monthly_detector_uptime", lambda t: ru.monthly_avg_by_day(avg_uptime(t).drop("delta"), "uptime", "all"),
         rs.monthly_avg_by_day("SELECT * FROM avg_uptime", "uptime", '"all"'), "uptime all delta", extra=AVG_UPTIME)
register("r11_cor_weekly_detector_uptime", lambda t: ru.cor_weekly_avg_by_day(weekly_uptime(t), t.corridors, "uptime", "all"),
         rs.with_week(rs.corridor_rollup(_wu, "uptime", "Date", '"all"')), "uptime all delta", extra=AVG_UPTIME)


def _cor_up(per):
    src = "SELECT *, CAST(date_trunc('month', Date) AS DATE) AS Month FROM avg_uptime"
    part = lambda v, w: rs.corridor_rollup(f"SELECT * FROM ({src}) WHERE {v} IS NOT NULL", v, per, w)
    keep = "uptime, delta" if per == "Month" else "uptime"
    return f"""SELECT Corridor, Zone_Group, {per}, uptime_sb, uptime_pr, {keep}{', ' + week('Date') + ' AS Week' if per == 'Date' else ''}
    FROM (SELECT Corridor, Zone_Group, {per}, uptime_sb FROM ({part('uptime_sb', 'all_sb')})) a
    FULL JOIN (SELECT Corridor, Zone_Group, {per}, uptime_pr FROM ({part('uptime_pr', 'all_pr')})) b USING (Corridor, Zone_Group, {per})
    LEFT JOIN (SELECT Corridor, Zone_Group, {per}, {keep} FROM ({part('uptime', '"all"' if per == 'Month' else None)})) c USING (Corridor, Zone_Group, {per})"""


register("r11_cor_daily_detector_uptime", lambda t: ru.cor_detector_uptime(avg_uptime(t), t.corridors, "Date"),
         _cor_up("Date"), "uptime_sb uptime_pr uptime", extra=AVG_UPTIME)
register("r11_cor_monthly_detector_uptime", lambda t: ru.cor_detector_uptime(avg_uptime(t), t.corridors, "Month"),
         _cor_up("Month"), "uptime_sb uptime_pr uptime delta", extra=AVG_UPTIME)

# ---- generic periods, group sets, quarters ----------------------------------
register("r1_corridor_means", lambda t: ru.corridor_means(t.metrics_daily, t.corridors, "uptime", "Date", "all", t.base("lineitem").count()),  # no more rows than line items
         rs.corridor_means("SELECT * FROM metrics_daily", "uptime", "Date", '"all"'), "uptime all delta")
EXTRA = {"Two Regions": ("Zone_Group", ("ASIA", "EUROPE")), "Asia": ("Zone_Group", ("ASIA",)), "Pair": ("Zone", ("NATION_1", "NATION_2"))}
EXTRA_SQL = ("CASE WHEN Zone_Group IN ('ASIA', 'EUROPE') THEN 'Two Regions' END, CASE WHEN Zone_Group = 'ASIA' THEN 'Asia' END, "
             "CASE WHEN Zone IN ('NATION_1', 'NATION_2') THEN 'Pair' END")
_mv = rs.monthly_avg_by_day(f"SELECT * FROM metrics_daily WHERE {rs.MIDWEEK}", "vpd")
register("r2_overlapping_groups", lambda t: ru.cor_monthly_avg_by_day(ru.monthly_avg_by_day(midweek(t.metrics_daily), "vpd"), t.corridors, "vpd", extra=EXTRA),
         rs.corridor_rollup(_mv, "vpd", "Month", extra=EXTRA_SQL), "vpd delta")
register("r2_groups_by_zone_group", lambda t: ru.cor_monthly_avg_by_day(ru.monthly_avg_by_day(midweek(t.metrics_daily), "vpd"), t.corridors, "vpd", by="Zone_Group"),
         rs.corridor_rollup(_mv, "vpd", "Month", by="Zone_Group"), "vpd delta")
register("r3_period_sum_15min", lambda t: ru.period_sum(t.counts_15min, "vol", "Timeperiod"),
         rs.period_sum("SELECT SignalID, Timeperiod, vol FROM counts_15min", "vol", "Timeperiod"), "delta")
register("r3_period_avg_1hr", lambda t: ru.period_avg(t.metrics_hourly, "sf_freq", "Date_Hour", "cycles"),
         rs.period_avg("SELECT * FROM metrics_hourly", "sf_freq", "Date_Hour", "cycles"), "sf_freq cycles delta")
register("r3_daily_avg_unweighted", lambda t: ru.daily_avg(t.metrics_daily, "vph"),
         rs.period_avg("SELECT * FROM metrics_daily", "vph", "Date"), "vph ones delta")
register("r9_sum_by_period", lambda t: ru.sum_by_period(t.counts_15min.drop("Detector"), "vol", "1 hour"),
         rs.delta(rs.total(f"SELECT SignalID, CallPhase, {week('CAST(Timeperiod AS DATE)')} AS Week, {dow('Timeperiod')} AS DOW, date_trunc('hour', Timeperiod) AS Timeperiod, vol FROM counts_15min",
                           "SignalID, CallPhase, Week, DOW, Timeperiod", "vol"), "SignalID, CallPhase, Week, DOW", "Timeperiod", "vol"), "delta")
register("r9_avg_by_hr_unweighted", lambda t: ru.avg_by_hr(t.metrics_hourly, "aog"), rs.avg_by_hr("SELECT * FROM metrics_hourly", "aog"), "aog delta")
register("r11_cor_avg_by_period_15min", lambda t: ru.corridor_rollup(ru.period_sum(t.counts_15min, "vol", "Timeperiod").drop("delta"), t.corridors, "vol", "Timeperiod"),
         rs.corridor_rollup(rs.total("SELECT * FROM counts_15min", "SignalID, Timeperiod", "vol"), "vol", "Timeperiod"), "vol delta")
_cm = rs.corridor_rollup(_mv, "vpd", "Month")
for op, w in (("avg", None), ("sum", None), ("latest", None)):
    register(f"r12_quarterly_{op}", lambda t, op=op: ru.quarterly(
        ru.cor_monthly_avg_by_day(ru.monthly_avg_by_day(midweek(t.metrics_daily), "vpd"), t.corridors, "vpd").drop("delta", "ones"), "vpd", operation=op),
        rs.quarterly(f"SELECT * EXCLUDE (delta, ones) FROM ({_cm})", "vpd", operation=op), "vpd delta")
_aog_mo = rs.corridor_rollup(rs.monthly_avg_by_day("SELECT * FROM metrics_hourly", "aog", "vol", True), "aog", "Month", "vol")
register("r12_quarterly_weighted", lambda t: ru.quarterly(
    ru.cor_monthly_avg_by_day(ru.monthly_avg_by_day(t.metrics_hourly, "aog", "vol", True), t.corridors, "aog", "vol").drop("delta"), "aog", "vol"),
    rs.quarterly(f"SELECT * EXCLUDE (delta) FROM ({_aog_mo})", "aog", "vol"), "aog vol delta")

# ---- signals as corridors ---------------------------------------------------
_md = rs.monthly_avg_by_day(f"SELECT * FROM metrics_daily WHERE {rs.MIDWEEK}", "vpd")
register("d13_signals_as_corridors", lambda t: ru.signals_as_corridors(
    ru.monthly_avg_by_day(midweek(t.metrics_daily), "vpd"),
    ru.cor_monthly_avg_by_day(ru.monthly_avg_by_day(midweek(t.metrics_daily), "vpd"), t.corridors, "vpd").drop("ones"), t.corridors),
    f"""WITH n AS (SELECT SignalID, Corridor, min(Description) AS Description, min(Name) AS Name FROM corridors GROUP BY ALL),
    sig AS ({_md}), cor AS ({_cm})
    SELECT n.Corridor AS Zone_Group, CAST(s.SignalID AS VARCHAR) AS Corridor, Month, vpd, delta, coalesce(n.Description, CAST(s.SignalID AS VARCHAR)) AS Description, n.Name
    FROM sig s LEFT JOIN n ON s.SignalID = n.SignalID
    UNION ALL SELECT Corridor, Corridor, Month, vpd, delta, Corridor, NULL FROM cor WHERE Corridor IN (SELECT Corridor FROM n)""", "vpd delta")
