"""Daily, weekly and monthly roll-ups of communications, pedestrian delay and push-button uptime."""

from pyspark.sql import functions as F

from greenwave.functions import timeparts as tp
from greenwave.operators import config as cfg, counts as ct, cycles as cy, rollup as ru
from greenwave.plans import rollup_sql as rs
from greenwave.plans.adapters_sql import dow, week
from greenwave.plans.catalog.cycles import PED
from greenwave.plans.catalog.ped_uptime import PAU, kept_pau
from greenwave.plans.registry import register

COMM = """SELECT SignalID, 0 AS CallPhase, date AS Date, {w} AS Week,
  CAST(count(*) FILTER (EventCode = 502 AND EventParam < 100) AS DOUBLE) / nullif(count(*) FILTER (EventCode = 502 AND EventParam > -1), 0) AS uptime
  FROM (SELECT DISTINCT * FROM controller_events WHERE EventCode IN (502, 503)) GROUP BY SignalID, date""".format(w=week("date"))
DELAY = (f"SELECT SignalID, 0 AS CallPhase, Date, {week('Date')} AS Week, Avg_Max_Ped_Delay AS pd, Events FROM (SELECT * FROM ("
         + PED.format(free=18000).replace("THEN EventParam END AS cl0", "THEN EventParam * 60 END AS cl0") + "))")
PRESS = 'SELECT SignalID, CallPhase, Date, Week, uptime, "all" FROM pau'


def comm(t):
    return ct.comm_uptime(t.controller_events).select("SignalID", "CallPhase", "Date", "Week", "uptime")


def delay(t):
    stretched = t.controller_events.withColumn("EventParam", F.when(F.col("EventCode") == 132, F.col("EventParam") * 60).otherwise(F.col("EventParam")))
    out = cy.ped_delay(stretched, 18000).withColumnRenamed("Avg_Max_Ped_Delay", "pd")
    return t.kept("ped_delay", lambda: out.select("SignalID", F.lit(0).alias("CallPhase"), "Date", tp.week_index("Date").alias("Week"), "pd", "Events"))


def press(t):
    return kept_pau(t).select("SignalID", "CallPhase", "Date", "Week", "uptime", "all")


for label, make, sql, v, w, extra in (("comm_uptime", comm, COMM, "uptime", None, None), ("ped_delay", delay, DELAY, "pd", "Events", None),
                                      ("ped_uptime", press, PRESS, "uptime", "all", PAU)):
    q = f'"{w}"' if w == "all" else w
    f = f"{v} delta" + (" ones" if w is None else "")
    daily, wk, mo = rs.period_avg(sql, v, "Date", q), rs.weekly_avg_by_day(sql, v, q, False), rs.monthly_avg_by_day(sql, v, q)
    weekly = lambda t, make=make, v=v, w=w: ru.weekly_avg_by_day(make(t), v, w, peak=False)
    monthly = lambda t, make=make, v=v, w=w: ru.monthly_avg_by_day(make(t), v, w)
    mf = f"{v} delta"
    register(f"r4_daily_{label}", lambda t, make=make, v=v, w=w: ru.daily_avg(make(t), v, w), daily, f, extra=extra)
    register(f"r6_weekly_{label}", weekly, wk, f, extra=extra)
    register(f"r7_monthly_{label}", monthly, mo, mf, extra=extra)
    register(f"r11_cor_weekly_{label}", lambda t, g=weekly, v=v, w=w: ru.cor_weekly_avg_by_day(g(t), t.corridors, v, w),
             rs.with_week(rs.corridor_rollup(wk if w else f"SELECT * EXCLUDE (ones) FROM ({wk})", v, "Date", q)), f, extra=extra)
    register(f"r11_cor_monthly_{label}", lambda t, g=monthly, v=v, w=w: ru.cor_monthly_avg_by_day(g(t), t.corridors, v, w),
             rs.corridor_rollup(mo, v, "Month", q), f, extra=extra)
    register(f"r11_sub_monthly_{label}", lambda t, g=monthly, v=v, w=w: ru.cor_monthly_avg_by_day(g(t), cfg.subcorridors_as_corridors(t.corridors), v, w),
             rs.corridor_rollup(mo, v, "Month", q, corridors="subcorridors"), f,
             extra={**(extra or {}), "subcorridors": "SELECT SignalID, Zone AS Zone_Group, Corridor AS Zone, Subcorridor AS Corridor FROM corridors"})
