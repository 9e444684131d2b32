"""Work-order and location queries."""

from pyspark.sql import functions as F

from greenwave.functions.grid import periods_seen
from greenwave.operators import tasks as tk, serve as sv
from greenwave.plans import rollup_sql as rs
from greenwave.plans.registry import register

TODAY, START = "2026-06-01", "2020-07-01"
NAMES = ("Two Regions",)
GROUPS = {"Two Regions": ("Zone_Group", ("ASIA", "EUROPE"))}
TK = {"tt0": f"""SELECT t.* REPLACE (coalesce(Task_Subtype, 'Unspecified') AS Task_Subtype), c.Zone_Group, c.Zone, c.Corridor,
        date_diff('day', Date_Reported, Date_Resolved) AS Days_To_Resolve, date_diff('day', Date_Reported, Date_Resolved) * 24 AS Hours_To_Resolve, 'all' AS "All"
        FROM tasks t JOIN (SELECT DISTINCT SignalID, Zone_Group, Zone, Corridor FROM corridors) c ON t.SignalID = c.SignalID
        WHERE Date_Reported < DATE '{TODAY}' AND (Date_Resolved < DATE '{TODAY}' OR Date_Resolved IS NULL)""",
      "tt": "SELECT * FROM tt0 UNION ALL SELECT * REPLACE ('Two Regions' AS Zone_Group) FROM tt0 WHERE Zone_Group IN ('ASIA', 'EUROPE')"}


def tidy(t):
    return tk.tidy_tasks(t.tasks, t.corridors, TODAY, extra_groups=GROUPS)


register("k1_tidy_tasks", tidy, "SELECT * FROM tt", extra=TK)


def moves(keys):
    return f"""SELECT {keys}, Date, CAST(sum(r) AS BIGINT) AS n_reported, CAST(sum(s) AS BIGINT) AS n_resolved FROM (SELECT {keys}, Date_Reported AS Date, 1 AS r, 0 AS s FROM tt
    UNION ALL SELECT {keys}, Date_Resolved, 0, 1 FROM tt WHERE Date_Resolved IS NOT NULL) GROUP BY ALL"""


def status(src, keys):
    return f"""SELECT *, cum_Reported - cum_Resolved AS Outstanding FROM (SELECT *, CAST(sum(Reported) OVER w AS BIGINT) AS cum_Reported, CAST(sum(Resolved) OVER w AS BIGINT) AS cum_Resolved
    FROM (SELECT {keys}, Date, CAST(sum(n_reported) AS BIGINT) AS Reported, CAST(sum(n_resolved) AS BIGINT) AS Resolved FROM ({src}) GROUP BY ALL) WINDOW w AS (PARTITION BY {keys} ORDER BY Date))"""


register("k2_daily_task_status", lambda t: tk.daily_status(tk.reported_and_resolved(tidy(t), ["SignalID", "Zone_Group"]), ["SignalID", "Zone_Group"]),
         status(moves("SignalID, Zone_Group"), "SignalID, Zone_Group"), extra=TK)
COLS = "Reported, Resolved, cum_Reported, cum_Resolved, Outstanding"


def cor_daily(p):
    m = moves(f"Zone_Group, Zone, Corridor, SignalID, {p}")
    inside = f"Date >= DATE '{START}' AND Date <= DATE '{TODAY}'"
    cor = f"SELECT Zone_Group, Corridor, {p}, Date, {COLS} FROM ({status(m, f'Zone_Group, Zone, Corridor, {p}')}) WHERE Zone_Group <> 'Two Regions'"
    grp = f"SELECT Zone_Group, Zone_Group AS Corridor, {p}, Date, {COLS} FROM ({status(m, f'Zone_Group, {p}')})"
    sig = f"SELECT Corridor AS Zone_Group, Corridor, {p}, Date, {COLS} FROM (SELECT *, min(Zone_Group) OVER (PARTITION BY Corridor) AS mg FROM ({cor})) WHERE Zone_Group = mg"
    return f"SELECT * FROM ({cor} UNION ALL {grp}) WHERE {inside}", f"SELECT * FROM ({sig}) WHERE {inside}"


def monthly(src, p):
    return f"""SELECT * FROM (WITH m AS (SELECT Zone_Group, Corridor, {p}, CAST(date_trunc('month', Date) AS DATE) AS Month, CAST(sum(Reported) AS BIGINT) AS Reported, CAST(sum(Resolved) AS BIGINT) AS Resolved,
      max(ROW(Date, cum_Reported, cum_Resolved, Outstanding)) AS l FROM ({src}) GROUP BY ALL),
    g AS (SELECT * FROM (SELECT DISTINCT Zone_Group, Corridor FROM m) CROSS JOIN (SELECT DISTINCT {p} FROM m) CROSS JOIN (SELECT DISTINCT Month FROM m)),
    j AS (SELECT g.*, coalesce(Reported, 0) AS Reported, coalesce(Resolved, 0) AS Resolved, l[2] AS cr, coalesce(l[3], 0) AS cum_Resolved, coalesce(l[4], 0) AS Outstanding FROM g LEFT JOIN m USING (Zone_Group, Corridor, {p}, Month)),
    f AS (SELECT * EXCLUDE (cr), coalesce(last_value(cr IGNORE NULLS) OVER (PARTITION BY Zone_Group, Corridor, {p} ORDER BY Month), 0) AS cum_Reported FROM j)
    SELECT *, {', '.join(f'(CAST({c} AS DOUBLE) - lag({c}) OVER w) / nullif(lag({c}) OVER w, 0) AS {n}' for c, n in (('Reported', 'delta_rep'), ('Resolved', 'delta_res'), ('Outstanding', 'delta_out')))}
    FROM f WINDOW w AS (PARTITION BY Zone_Group, Corridor, {p} ORDER BY Month))"""


def outs(t, p):
    return tk.outstanding_tasks(tidy(t), t.corridors, p, START, TODAY, NAMES)


D = "delta_rep delta_res delta_out"
for p, label in (("Priority", "priority"), ("Task_Type", "type"), ("Task_Subtype", "subtype"), ("Task_Source", "source"), ('"All"', "all")):
    col = p.strip('"')
    cd, sd = cor_daily(p)
    register(f"k4_cor_monthly_tasks_by_{label}", lambda t, c=col: outs(t, c)["cor_monthly"], monthly(cd, p), D, extra=TK)
    register(f"k3_cor_daily_tasks_by_{label}", lambda t, c=col: outs(t, c)["cor_daily"], cd, extra=TK)
    register(f"k5_sig_daily_tasks_by_{label}", lambda t, c=col: outs(t, c)["sig_daily"], sd, extra=TK)
    register(f"k5_sig_monthly_tasks_by_{label}", lambda t, c=col: outs(t, c)["sig_monthly"], monthly(sd, p), D, extra=TK)
_age = f"""SELECT * FROM (WITH mo AS (SELECT DISTINCT CAST(date_trunc('month', Date_Reported) AS DATE) AS Month FROM tasks),
x AS (SELECT Zone_Group, Zone, Corridor, Month, Date_Reported AS r, Date_Resolved AS s, last_day(Month) AS e FROM tt, mo),
a AS (SELECT Zone_Group, Zone, Corridor, Month, count(*) FILTER ((s IS NULL OR s > e) AND r < e - 45) AS over45, count(*) FILTER ((s IS NULL OR s > e) AND r < e - 90) AS over90,
  count(*) FILTER ((s IS NULL OR s > e) AND r <= e) AS num_outstanding, nullif(count(*) FILTER (r <= e AND s < e AND r > DATE '{START}'), 0) AS num_resolved,
  avg(s - r) FILTER (r <= e AND s < e AND r > DATE '{START}') AS mttr FROM x GROUP BY ALL HAVING over45 > 0),
b AS (SELECT Zone_Group, Corridor, Month, num_outstanding - over45 AS d0_45, over45 - over90 AS d45_90, over45, over90, num_outstanding, num_resolved, mttr FROM a),
c AS (SELECT * FROM b WHERE Zone_Group <> 'Two Regions' UNION ALL SELECT Zone_Group, Zone_Group, Month, CAST(sum(d0_45) AS BIGINT), CAST(sum(d45_90) AS BIGINT), CAST(sum(over45) AS BIGINT), CAST(sum(over90) AS BIGINT), CAST(sum(num_outstanding) AS BIGINT),
  CASE WHEN count(*) = count(num_resolved) THEN CAST(sum(num_resolved) AS BIGINT) END, {rs.wmean('mttr', 'num_resolved')} FROM b GROUP BY Zone_Group, Month)
SELECT *, (CAST(over45 AS DOUBLE) - lag(over45) OVER w) / nullif(lag(over45) OVER w, 0) AS delta_over45, (mttr - lag(mttr) OVER w) / nullif(lag(mttr) OVER w, 0) AS delta_mttr FROM c WINDOW w AS (PARTITION BY Zone_Group, Corridor ORDER BY Month))"""


def by_age(t):
    one_zone = tidy(t).withColumn("Zone", F.col("Zone_Group"))  # one row per corridor and zone group
    months = periods_seen(t.tasks.select(F.trunc("Date_Reported", "month").alias("Month")), "Month")
    return tk.outstanding_by_age(one_zone, months, START, NAMES)


register("k6_outstanding_by_age", by_age, _age.replace("SELECT Zone_Group, Zone, Corridor, Month, Date_Reported", "SELECT Zone_Group, Zone_Group AS Zone, Corridor, Month, Date_Reported"),
         "mttr delta_over45 delta_mttr", extra=TK)


def events_sql(place, g):
    m = lambda d, n: f"SELECT *, CAST(sum({n}) OVER (PARTITION BY {place}, {g} ORDER BY Month) AS BIGINT) AS cum{n} FROM (SELECT {place}, {g}, CAST(date_trunc('month', {d}) AS DATE) AS Month, count(*) AS {n} FROM tt WHERE {d} IS NOT NULL GROUP BY ALL)"
    return f"""SELECT *, cumRep - cumRes AS outstanding FROM (SELECT {place}, {g}, Month, Rep, cumRep, coalesce(Res, 0) AS Res, coalesce(last_value(cumRes IGNORE NULLS) OVER (PARTITION BY {place}, {g} ORDER BY Month), 0) AS cumRes
    FROM ({m('Date_Reported', 'Rep')}) LEFT JOIN ({m('Date_Resolved', 'Res')}) USING ({place}, {g}, Month))"""


register("k7_outstanding_events_by_type", lambda t: tk.outstanding_events(tidy(t), "Task_Type"), events_sql("Zone_Group", "Task_Type"), extra=TK)
register("k7_outstanding_events_by_corridor", lambda t: tk.outstanding_events(tidy(t), "Priority", "Corridor"), events_sql("Corridor", "Priority"), extra=TK)
register("v8_backlog_long", lambda t: sv.backlog_long(tk.outstanding_events(tidy(t), "Task_Type").select(
    "Zone_Group", "Task_Type", "Month", F.col("Rep").alias("Reported"), F.col("Res").alias("Resolved"), F.col("outstanding").alias("Outstanding")),
    ["Zone_Group", "Task_Type", "Month"]),
    f"SELECT Zone_Group, Task_Type, Month, Events, value FROM (UNPIVOT (SELECT Zone_Group, Task_Type, Month, Rep AS Reported, Res AS Resolved, outstanding AS Outstanding FROM ({events_sql('Zone_Group', 'Task_Type')})) ON Reported, Resolved, Outstanding INTO NAME Events VALUE value)", extra=TK)

# ---- locations --------------------------------------------------------------
DIST = "2 * 6371000.0::DOUBLE * asin(sqrt(least(1, pow(sin((radians(b.Latitude) - radians(a.Latitude)) / 2), 2) + cos(radians(a.Latitude)) * cos(radians(b.Latitude)) * pow(sin((radians(b.Longitude) - radians(a.Longitude)) / 2), 2))))"
LOC = {"sites": "SELECT DISTINCT SignalID, Latitude, Longitude FROM corridors",
       "locn": f"SELECT LocationId, (min(ROW(m, SignalID)))[2] AS SignalID, min(m) AS m FROM (SELECT LocationId, SignalID, {DIST} AS m FROM locations a, sites b WHERE abs(a.Latitude - b.Latitude) < 0.002) WHERE m < 100 GROUP BY ALL",
       "sign": f"SELECT SignalID, (min(ROW(m, LocationId)))[2] AS LocationId, min(m) AS m FROM (SELECT SignalID, LocationId, {DIST} AS m FROM sites a, (SELECT min(LocationId) AS LocationId, Latitude, Longitude FROM locations GROUP BY Latitude, Longitude) b WHERE abs(a.Latitude - b.Latitude) < 0.002) WHERE m < 100 GROUP BY ALL"}


def sites(t):
    return t.corridors.select("SignalID", "Latitude", "Longitude").distinct()


register("j13_nearest_signal", lambda t: tk.nearest(t.locations, sites(t), "LocationId", "SignalID"), "SELECT * FROM locn", "m", 3, extra=LOC)
register("k8_match_locations", lambda t: tk.match_locations(sites(t), t.locations), """
SELECT LocationId, SignalID, m, good_guess FROM (SELECT *, row_number() OVER (PARTITION BY LocationId ORDER BY m, good_guess DESC, SignalID) AS n FROM (
SELECT s.LocationId, s.SignalID, CAST(trunc(s.m) AS INTEGER) AS m, CASE WHEN split_part(Custom_Identifier, ' ', 1) = CAST(s.SignalID AS VARCHAR) THEN 1 ELSE 0 END AS good_guess
FROM sign s JOIN locations USING (LocationId))) WHERE n = 1""", extra=LOC)
register("k8_location_distances", lambda t: tk.location_distances(t.locations, sites(t)),
         "SELECT SignalID, count(*) AS n, min(m) AS mindist, max(m) AS maxdist FROM locn GROUP BY ALL", "mindist maxdist", 3, extra=LOC)
