"""Serving, source and sink queries."""

from pyspark.sql import functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.layout import laid_out
from greenwave.operators import counts as ct, rollup as ru, serve as sv, tasks as tk
from greenwave.plans import rollup_sql as rs
from greenwave.plans.catalog.counts import ADJ_SQL, RAW, HOUR, adjusted
from greenwave.plans.catalog.ped_uptime import CAM, combined
from greenwave.plans.catalog.rollups import midweek
from greenwave.plans.metrics import METRICS
from greenwave.plans.registry import register
from greenwave.session import new_table_path
from greenwave.sources import scan, sinks

_mo_vpd = rs.monthly_avg_by_day(f"SELECT * FROM metrics_daily WHERE {rs.MIDWEEK}", "vpd")
_mh = rs.monthly_avg_by_hr(rs.avg_by_hr("SELECT * FROM metrics_hourly", "aog", "vol"), "aog", "vol", False)
SV = {"sig_vpd": _mo_vpd, "cor_vpd": rs.corridor_rollup(_mo_vpd, "vpd", "Month"),
      "cor_aogh": rs.corridor_rollup(_mh, "aog", "Hour", "vol", drop_empty=False),
      "cor_wk": rs.with_week(rs.corridor_rollup(rs.weekly_sum_by_day(f"SELECT * FROM metrics_daily WHERE {rs.MIDWEEK}", "vpd"), "vpd", "Date")),
      "cor_aog": rs.corridor_rollup(rs.monthly_avg_by_day("SELECT * FROM metrics_hourly", "aog", "vol", True), "aog", "Month", "vol")}
SV["qu_vpd"] = rs.quarterly("SELECT * EXCLUDE (delta, ones) FROM cor_vpd", "vpd")
SV["qu_aog"] = rs.quarterly("SELECT * EXCLUDE (delta) FROM cor_aog", "aog", "vol")


def source(t):
    """Result tables by name, as lazy frames."""
    def open_table(name):
        if name == "sig_mo_vpd":
            return ru.monthly_avg_by_day(midweek(t.metrics_daily), "vpd")
        if name == "cor_mo_vpd":
            return ru.cor_monthly_avg_by_day(open_table("sig_mo_vpd"), t.corridors, "vpd")
        if name == "cor_wk_vpd":
            return ru.cor_weekly_avg_by_day(ru.weekly_sum_by_day(midweek(t.metrics_daily), "vpd"), t.corridors, "vpd")
        if name == "cor_mo_aogd":
            return ru.cor_monthly_avg_by_day(ru.monthly_avg_by_day(t.metrics_hourly, "aog", "vol", True), t.corridors, "aog", "vol")
        if name == "cor_mo_aogh":
            return ru.cor_avg_by_hr(ru.monthly_avg_by_hr(ru.avg_by_hr(t.metrics_hourly, "aog", "vol"), "aog", "vol", delta=False), t.corridors, "aog", "vol")
        if name == "cor_qu_vpd":
            return ru.quarterly(open_table("cor_mo_vpd").drop("delta", "ones"), "vpd")
        if name == "cor_qu_aogd":
            return ru.quarterly(open_table("cor_mo_aogd").drop("delta"), "aog", "vol")
        raise KeyError(name)

    return open_table


VPD, AOG = METRICS["daily_traffic_volume"], METRICS["arrivals_on_green"]
register("v1_monthly_up_to", lambda t: sv.query_data(source(t), VPD, "NATION_3", month="2023-06-01"),
         "SELECT * FROM cor_vpd WHERE Zone_Group = 'NATION_3' AND Month <= DATE '2023-06-01'", "vpd delta", extra=SV)
register("v1_monthly_alias_groups", lambda t: sv.query_data(source(t), VPD, "South", month="2023-06-01", upto=False, aliases={"South": ["NATION_3", "NATION_4", "NATION_7"]},
         hide_corridor_prefix="NATION"),
         "SELECT * FROM cor_vpd WHERE Zone_Group IN ('NATION_3', 'NATION_4', 'NATION_7') AND Corridor NOT LIKE 'NATION%' AND Month = DATE '2023-06-01'", "vpd delta", extra=SV)
register("v1_hourly", lambda t: sv.query_data(source(t), AOG, "NATION_5", hourly=True, month="2022-03-01", upto=False),
         "SELECT * FROM cor_aogh WHERE Zone_Group = 'NATION_5' AND Hour <= TIMESTAMP '2022-03-31 23:00:00' AND Hour >= TIMESTAMP '2022-03-01'", "aog vol delta", extra=SV)
register("v1_weekly", lambda t: sv.query_data(source(t), VPD, "NATION_1", resolution="weekly", month="2022-03-01", corridor="Corridor 0"),
         "SELECT * FROM cor_wk WHERE Zone_Group = 'NATION_1' AND Date <= DATE '2022-03-31' AND Corridor = 'Corridor 0'", "vpd delta", extra=SV)
register("v1_quarterly", lambda t: sv.query_data(source(t), VPD, "NATION_5", resolution="quarterly", quarter="2023.2"),
         "SELECT * FROM qu_vpd WHERE Zone_Group = 'NATION_5' AND Quarter <= '2023.2'", "vpd delta", extra=SV)
register("v4_signal_map", lambda t: sv.signal_map_data(source(t)("sig_mo_vpd"), t.corridors, "vpd", "2023-06-01"), """
SELECT s.SignalID, Month, vpd, c.Corridor, c.Latitude, c.Longitude, c.Description FROM sig_vpd s JOIN (SELECT SignalID, min(Corridor) AS Corridor, min(Latitude) AS Latitude, min(Longitude) AS Longitude, min(Description) AS Description FROM corridors GROUP BY ALL) c
ON s.SignalID = c.SignalID WHERE Month = DATE '2023-06-01'""", "vpd Latitude Longitude", extra=SV)
register("o2_top_signals", lambda t: sv.top_signals(sv.signal_map_data(source(t)("sig_mo_vpd"), t.corridors, "vpd", "2023-06-01"), "vpd"), """
SELECT s.SignalID, Description, Corridor, vpd FROM sig_vpd s JOIN (SELECT SignalID, min(Corridor) AS Corridor, min(Description) AS Description FROM corridors GROUP BY ALL) c
ON s.SignalID = c.SignalID WHERE Month = DATE '2023-06-01' ORDER BY vpd DESC NULLS LAST, s.SignalID LIMIT 10""", "vpd", extra=SV)
register("o3_top_per_zone_with_ties", lambda t: sv.top_per_group(tk_input(t), "Zone", "delay_cost"), """
SELECT Zone, Corridor, date, delay_cost FROM (SELECT *, rank() OVER (PARTITION BY Zone ORDER BY delay_cost DESC) AS r FROM (SELECT Zone, Corridor, date, floor(delay_cost / 1000) AS delay_cost FROM delay_costs)) WHERE r <= 10""", "delay_cost")
register("o4_first_and_last", lambda t: sv.first_and_last(source(t)("cor_mo_vpd"), ["Zone_Group", "Corridor"], "Month", "vpd"),
         "SELECT Zone_Group, Corridor, arg_min(vpd, Month) AS first_value, arg_max(vpd, Month) AS last_value FROM cor_vpd GROUP BY ALL", "first_value last_value", extra=SV)


def tk_input(t):
    return t.delay_costs.withColumn("delay_cost", F.floor(F.col("delay_cost") / 1000).cast("double"))


_days = ", ".join(f"coalesce(sum(v) FILTER (day(Date) = {d}), 0) AS d{d:02d}" for d in range(1, 32))
register("v5_camera_uptime_matrix", lambda t: sv.uptime_matrix(combined(t), "up", "2024-01-01", "CameraID"),
         f"SELECT CameraID, {_days} FROM (SELECT CameraID, Date, sum(up) AS v FROM comb WHERE date_trunc('month', Date) = DATE '2024-01-01' GROUP BY ALL) GROUP BY CameraID",
         " ".join(f"d{d:02d}" for d in range(1, 32)), extra=CAM)
register("v7_metric_card", lambda t: sv.metric_card(source(t)("cor_mo_vpd"), "NATION_3", "vpd", "Month", "2023-06-01"),
         "SELECT Month, vpd, delta, vpd / nullif(1 + delta, 0) AS previous FROM cor_vpd WHERE Zone_Group = 'NATION_3' AND Corridor = 'NATION_3' AND Month <= DATE '2023-06-01' ORDER BY Month DESC LIMIT 1",
         "vpd delta previous", extra=SV)


def extract(t):
    s = source(t)
    return sv.quarterly_extract({"Traffic Volume": (s("cor_qu_vpd"), "vpd"), "Arrivals on Green": (s("cor_qu_aogd"), "aog")})


_q = "SELECT '{l}' AS Metric, Zone_Group, Corridor, Quarter, {v} AS value, {w} AS weight FROM {t}"
register("v10_quarterly_extract", extract, f"""
WITH r AS ({_q.format(l='Traffic Volume', v='vpd', w='ones', t='qu_vpd')} UNION ALL {_q.format(l='Arrivals on Green', v='aog', w='vol', t='qu_aog')}),
d AS (SELECT *, last_day(make_date(CAST(split_part(Quarter, '.', 1) AS INTEGER), CAST(split_part(Quarter, '.', 2) AS INTEGER) * 3, 1)) AS date FROM r),
f AS (SELECT Metric, Zone_Group, Corridor, value, weight, date, CAST(year(date + INTERVAL 6 MONTH) AS VARCHAR) || '.' || CAST(quarter(date + INTERVAL 6 MONTH) AS VARCHAR) AS Quarter FROM d)
SELECT Zone_Group AS District, date, Quarter, Metric, value FROM f WHERE Zone_Group = Corridor
UNION ALL SELECT Zone_Group, date, Quarter, Metric, {rs.wmean('value', 'weight')} FROM f WHERE Zone_Group <> Corridor AND Zone_Group NOT IN (SELECT Zone_Group FROM f WHERE Zone_Group = Corridor) GROUP BY Zone_Group, date, Quarter, Metric""",
         "value", extra=SV)


def comments(t):
    return t.tasks.select(F.trunc("Date_Reported", "month").alias("Month"), F.col("Task_Type").alias("Zone"),
                          F.col("Date_Reported").cast("timestamp_ntz").alias("LastModified"), F.col("TaskID").cast("string").alias("Comment"))


_cm = "SELECT CAST(date_trunc('month', Date_Reported) AS DATE) AS Month, Task_Type AS Zone, CAST(Date_Reported AS TIMESTAMP) AS LastModified, CAST(TaskID AS VARCHAR) AS Comment FROM tasks"
register("v11_latest_comments", lambda t: sv.latest_comments(comments(t)), f"SELECT * EXCLUDE (m) FROM (SELECT *, max(LastModified) OVER (PARTITION BY Month, Zone) AS m FROM ({_cm})) WHERE LastModified = m")
register("v11_recent_comments", lambda t: sv.recent_comments(comments(t)), f"SELECT * EXCLUDE (r) FROM (SELECT *, rank() OVER (PARTITION BY Month, Zone ORDER BY LastModified DESC) AS r FROM ({_cm})) WHERE r <= 10")
register("v12_report_cut_off", lambda t: sv.cut_off(source(t)("cor_wk_vpd"), "2023-06-01"), "SELECT * FROM cor_wk WHERE Date < DATE '2023-07-01'", "vpd delta", extra=SV)
register("v13_signals_with_corridors", lambda t: sv.signals_with_corridors(t.controller_events.groupBy("SignalID").agg(
    F.concat(F.lit("Street "), F.min("EventParam").cast("string")).alias("PrimaryName"), F.lit("Side").alias("SecondaryName")), t.corridors), """
SELECT s.SignalID, PrimaryName, SecondaryName, Zone_Group, Zone, coalesce(Corridor, 'None') AS Corridor, coalesce(Description, CAST(s.SignalID AS VARCHAR) || ': ' || PrimaryName || ' @ ' || SecondaryName) AS Description
FROM (SELECT SignalID, 'Street ' || CAST(min(EventParam) AS VARCHAR) AS PrimaryName, 'Side' AS SecondaryName FROM controller_events GROUP BY ALL) s LEFT JOIN corridors c ON s.SignalID = c.SignalID""")

# ---- sources ----------------------------------------------------------------
register("s1_s6_range_scan", lambda t: scan.event_slice(t.controller_events, "2024-01-01", "2024-01-02").select("SignalID", "Timestamp", "EventCode", "EventParam"),
         """SELECT DISTINCT SignalID, "Timestamp", EventCode, EventParam FROM controller_events WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-02'""")
register("s3_midweek_events_of_signals", lambda t: scan.event_slice(t.controller_events, "2024-01-01", "2024-01-03", t.corridors, (1, 8, 9), True),
         """SELECT DISTINCT * FROM controller_events SEMI JOIN corridors USING (SignalID) WHERE EventCode IN (1, 8, 9) AND dayofweek(date) IN (2, 3, 4)""")
register("s4_union_of_sources", lambda t: scan.union_sources(t.controller_events.where("EventCode < 100"),
         t.controller_events.where("EventCode >= 100").withColumnsRenamed({"EventCode": "event_type", "EventParam": "event_parameter"}),
         {"event_type": "EventCode", "event_parameter": "EventParam"}), "SELECT * FROM controller_events")
register("s9_camera_log_http", lambda t: scan.camera_log(t.camera_log.select(
    F.col("CameraID").alias("ID"), F.concat(F.date_format("Timestamp", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")).alias("Last-Modified"),
    F.col("Size").alias("Content-Length"), F.col("Date").alias("file_date")), "America/New_York"),
    """SELECT DISTINCT CameraID, date_trunc('second', "Timestamp") - INTERVAL 5 HOUR AS "Timestamp", Size, Date FROM camera_log""", "Size")
register("s9_camera_log_iso", lambda t: scan.camera_log(t.camera_log.select(
    F.col("CameraID").alias("ID"), F.date_format("Timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("Last-Modified"),
    F.col("Size").alias("Content-Length"), F.col("Date").alias("file_date")), "America/New_York", http_dates=False),
    """SELECT DISTINCT CameraID, date_trunc('second', "Timestamp") - INTERVAL 5 HOUR AS "Timestamp", Size, Date FROM camera_log""", "Size")
register("s10_first_missing", lambda t: t.controller_events.select(scan.parse_date_rule("first_missing", "2024-03-01", t.controller_events).alias("start")).distinct(),
         "SELECT least(CAST(max(date) + 1 AS DATE), DATE '2024-02-29') AS start FROM controller_events")
register("s10_first_missing_across", lambda t: scan.first_missing_across(t.metrics_daily.groupBy(F.col("SignalID").alias("table")).agg(F.max("Date").alias("MaxDate")), 1),
         "SELECT CAST(min(m) + 1 AS DATE) AS first_missing FROM (SELECT m FROM (SELECT SignalID, max(Date) AS m FROM metrics_daily GROUP BY ALL) GROUP BY m HAVING count(*) > 1)")
register("s11_signals_of_a_day", lambda t: scan.signals_in(t.controller_events, "2024-01-02"), "SELECT DISTINCT SignalID FROM controller_events WHERE date = DATE '2024-01-02'")
register("p15_delay_cost_json", lambda t: scan.explode_daily_results(t.delay_costs.groupBy("Zone", "Corridor", F.col("date").cast("date").alias("d")).agg(
    F.to_json(F.struct(F.array(F.struct(F.array_sort(F.collect_list(F.struct(F.date_format("date", "MMMM dd, yyyy HH:mm:ss").alias("date"),
              F.struct("delay_cost").alias("combined")))).alias("values"))).alias("daily_results"))).alias("json"))).drop("d"),
         "SELECT Zone, Corridor, date, delay_cost FROM delay_costs", "delay_cost", 2)


def responses(t):
    """A response for every cost: nested or dotted cost, and fields that no schema names."""
    h = F.hour("date")
    at = F.date_format("date", "MMMM dd, yyyy HH:mm:ss").alias("date")
    unit = F.struct(F.lit("USD").alias("currency"), F.array(h, h + 1).alias("parts.of")).alias("unit")
    nested = F.to_json(F.struct(F.array(F.struct(F.array(F.struct(at, F.struct("delay_cost").alias("combined"), unit)).alias("values"))).alias("daily_results")))
    dotted = F.to_json(F.struct(F.array(F.struct(F.array(F.struct(at, F.col("delay_cost").alias("combined.delay_cost"), unit)).alias("values"))).alias("daily_results")))
    return t.delay_costs.select("Zone", "Corridor", F.col("date").alias("of"), F.when(h % 2 == 0, nested).otherwise(dotted).alias("json"))


register("p15_open_daily_results", lambda t: scan.open_daily_results(responses(t)).select("Zone", "Corridor", "of", "date", "delay_cost", F.try_variant_get("value", "$.unit.currency", "string").alias("currency"),
         F.size(F.try_variant_get("value", "$.unit['parts.of']", "array<variant>")).alias("n_parts")),
         """SELECT Zone, Corridor, date AS "of", date, delay_cost, 'USD' AS currency, CAST(2 AS INTEGER) AS n_parts FROM delay_costs""", "delay_cost", 2)
_H = 'CAST(hour("date") AS INTEGER)'
register("p15_json_leaves", lambda t: scan.json_leaves(responses(t).select("Zone", "Corridor", "of", F.try_parse_json("json").alias("v")), "v").where("path not like '%delay_cost%' AND path not like '%date%'"),
         f"""SELECT Zone, Corridor, date AS "of", '$[''daily_results''][0][''values''][0][''unit'']' || step AS path, kind, leaf FROM delay_costs, LATERAL (SELECT unnest(['[''currency'']', '[''parts.of''][0]', '[''parts.of''][1]']) AS step,
         unnest(['STRING', 'BIGINT', 'BIGINT']) AS kind, unnest(['USD', CAST({_H} AS VARCHAR), CAST({_H} + 1 AS VARCHAR)]) AS leaf)""")


def stored_events(t):
    """Events stored by date, then read back for the dates of a calendar and counted by the reader's callback."""
    root = new_table_path(t.spark, "events")
    sinks.write_by_date(t.controller_events, root)
    dates = new_table_path(t.spark, "dates")
    t.controller_events.select(F.col("date").alias("Date"), F.dayofweek("date").alias("DOW")).distinct().write.parquet(dates)
    busy = t.spark.read.parquet(dates).where("DOW IN (3, 4)")
    return scan.read_range(t.spark, root, "2024-01-01", "2024-01-31", callback=lambda df: df.groupBy("Date", "SignalID", "EventCode").agg(F.count(F.lit(1)).alias("n")), days=busy)


register("s1_stored_range", stored_events, """SELECT date AS Date, CAST(SignalID AS VARCHAR) AS SignalID, EventCode, count(*) AS n FROM controller_events WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' AND dayofweek(date) IN (2, 3) GROUP BY ALL""")


def bucketed_counts(t, buckets=16):
    """Daily volumes by configured phase, from two tables stored with the same buckets."""
    made = []
    for df, name in ((t.counts_1hr.select("SignalID", "Detector", "Timeperiod", "vol"), "counts"), (t.det_config.select("SignalID", "Detector", "CallPhase"), "config")):
        path = new_table_path(t.spark, name)
        made.append(sinks.write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), path, buckets))
    return made[0].join(made[1], ["SignalID", "Detector"]).groupBy("SignalID", "Detector", "CallPhase", tp.day("Timeperiod").alias("Date")).agg(F.sum("vol").alias("vol"))


register("j1_bucketed_daily_counts", bucketed_counts, """SELECT SignalID, Detector, d.CallPhase, CAST(Timeperiod AS DATE) AS Date, CAST(sum(vol) AS BIGINT) AS vol
FROM (SELECT SignalID, Detector, Timeperiod, vol FROM counts_1hr) c JOIN (SELECT SignalID, Detector, CallPhase FROM det_config) d USING (SignalID, Detector) GROUP BY ALL""")

# ---- sinks ------------------------------------------------------------------
DET = {**ADJ_SQL, "details": """SELECT SignalID, Timeperiod, Detector, CallPhase, CAST(r.vol AS INTEGER) AS vol_rc, CASE WHEN Good_Day = 0 THEN a.vol END AS vol_ac, Good_Day = 0 AS bad_day
    FROM counts_1hr r FULL JOIN filtered_1hr f USING (SignalID, Timeperiod, Detector, CallPhase) FULL JOIN adjusted_1hr a USING (SignalID, Timeperiod, Detector, CallPhase)"""}


def details(t):
    """Counts are stored, not the filtered table with its row for every hour: all three tables lie by signal over as many tasks, and are nested there."""
    counts, config, by = t.kept("counts_1hr", lambda: t.counts_1hr, packed=True), t.det_config, ["SignalID"]
    rows, days = ct.grid_size(counts, config)
    rows *= 2  # a task holds a signal's filtered and adjusted rows
    f = ct.filtered_counts(counts, config, by=by, size=(rows, days))
    return sinks.signal_details(laid_out(counts, by, rows), f, ct.adjusted_counts(f))


register("s7_signal_details", lambda t: details(t).select("SignalID", "date", F.size("data").cast("bigint").alias("n"),
         F.aggregate("data", F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x["vol_rc"], F.lit(0))).alias("vol_rc")),
         "SELECT SignalID, CAST(Timeperiod AS DATE) AS date, count(*) AS n, CAST(coalesce(sum(vol_rc), 0) AS BIGINT) AS vol_rc FROM details GROUP BY ALL", extra=DET)
register("s8_read_signal_details", lambda t: sinks.read_signal_details(details(t)), "SELECT * REPLACE (coalesce(CallPhase, 0) AS CallPhase) FROM details", extra=DET)
_new = f"SELECT * FROM ({rs.monthly_avg_by_day('SELECT * REPLACE (papd * 1.5 AS papd) FROM metrics_daily', 'papd')})"
_old = f"SELECT * FROM ({rs.monthly_avg_by_day('SELECT * FROM metrics_daily', 'papd')})"


def old_new(t):
    old = ru.monthly_avg_by_day(t.metrics_daily, "papd")
    return old, ru.monthly_avg_by_day(t.metrics_daily.withColumn("papd", F.col("papd") * 1.5), "papd")


register("s13_merge_window", lambda t: sinks.merge_window(*old_new(t), "papd", "2021-01-01", "2023-06-01"), rs.delta(
    f"SELECT SignalID, Month, papd FROM ({_old}) WHERE Month >= DATE '2021-01-01' AND Month < DATE '2023-06-01' UNION ALL SELECT SignalID, Month, papd FROM ({_new}) WHERE Month >= DATE '2023-06-01'",
    "SignalID", "Month", "papd"), "papd delta")
register("s14_publish_rows", lambda t: sinks.publish_rows(*old_new(t), "2021-01-01", "2023-06-01", "2024-02-01"),
         f"SELECT * FROM ({_old}) WHERE Month >= DATE '2021-01-01' AND Month < DATE '2023-06-01' UNION ALL SELECT * FROM ({_new}) WHERE Month >= DATE '2023-06-01' AND Month < DATE '2024-03-01'", "papd delta")
register("s14_retention", lambda t: sinks.retain_months(t.metrics_daily, "2026-05-20", 8), "SELECT * FROM metrics_daily WHERE Date >= DATE '2025-10-01'", "vpd uptime vph papd all")


def audited(t):
    return sinks.result_table_counts({"sig_dy_vpd": t.metrics_daily, "sig_dy_aog": t.metrics_hourly.drop("Hour"), "sig_wk_cnt": t.counts_1hr})


_aud = "SELECT 'sig_dy_vpd' AS \"table\", Date AS date, count(*) AS records FROM metrics_daily GROUP BY ALL UNION ALL SELECT 'sig_dy_aog', Date, count(*) FROM metrics_hourly GROUP BY ALL UNION ALL SELECT 'sig_wk_cnt', CAST(Timeperiod AS DATE), count(*) FROM counts_1hr GROUP BY ALL"
register("s15_result_table_counts", audited, _aud)
register("s15_audit_matrix", lambda t: sinks.audit_matrix(audited(t), resolution="dy"),
         f"SELECT \"table\", date, CAST(sum(records) AS BIGINT) AS records FROM ({_aud}) WHERE \"table\" LIKE '%\\_dy\\_%' ESCAPE '\\' GROUP BY ALL")


def two_sources(t):
    e = t.controller_events
    return e.where(F.col("EventParam") != 4), e.where(F.col("EventCode") != 82)


register("s16_reconcile_sources", lambda t: sinks.reconcile(*two_sources(t), ["SignalID", "EventCode", "EventParam"]), """
SELECT SignalID, EventCode, EventParam, count(*) FILTER (s = 'l') AS left_rows, count(*) FILTER (s = 'r') AS right_rows, CASE WHEN left_rows > 0 AND right_rows > 0 THEN 'both' WHEN left_rows > 0 THEN 'left' ELSE 'right' END AS side
FROM (SELECT *, 'l' AS s FROM controller_events WHERE EventParam <> 4 UNION ALL SELECT *, 'r' FROM controller_events WHERE EventCode <> 82) GROUP BY ALL""")
register("s16_row_diff", lambda t: sinks.row_diff(*two_sources(t))["left_only"],
         "SELECT * FROM controller_events WHERE EventParam <> 4 EXCEPT ALL SELECT * FROM controller_events WHERE EventCode <> 82")


def logs(t):
    """Two event logs: the second lacks some events, has others once more, and some with another code."""
    ev = t.controller_events
    second = ev.where((F.col("EventParam") != 4) | (F.col("SignalID") != 1))
    return ev, second.withColumn("EventCode", F.when((F.col("SignalID") == 2) & (F.hour("Timestamp") == 5), F.col("EventCode") + 1000).otherwise(F.col("EventCode")))


register("s16_tree_diff", lambda t: sinks.tree_diff(*logs(t), ["SignalID", "Timestamp"], [{"date": F.col("date")}, {"SignalID": F.col("SignalID")}, {"hour": F.hour("Timestamp")}])
         .withColumn("columns", F.array_join("columns", ",")), """
WITH l AS (SELECT *, row_number() OVER (PARTITION BY SignalID, "Timestamp" ORDER BY EventCode, EventParam, date) AS i FROM controller_events),
r AS (SELECT *, row_number() OVER (PARTITION BY SignalID, "Timestamp" ORDER BY EventCode, EventParam, date) AS i FROM (
  SELECT * REPLACE (CASE WHEN SignalID = 2 AND hour("Timestamp") = 5 THEN EventCode + 1000 ELSE EventCode END AS EventCode) FROM controller_events WHERE EventParam <> 4 OR SignalID <> 1))
SELECT coalesce(l.SignalID, r.SignalID) AS SignalID, coalesce(l."Timestamp", r."Timestamp") AS "Timestamp",
  CASE WHEN r.i IS NULL THEN 'left' WHEN l.i IS NULL THEN 'right' ELSE 'changed' END AS side,
  CASE WHEN r.i IS NULL OR l.i IS NULL THEN '' ELSE concat_ws(',', CASE WHEN l.EventCode IS DISTINCT FROM r.EventCode THEN 'EventCode' END,
    CASE WHEN l.EventParam IS DISTINCT FROM r.EventParam THEN 'EventParam' END, CASE WHEN l.date IS DISTINCT FROM r.date THEN 'date' END) END AS columns
FROM l FULL JOIN r ON l.SignalID = r.SignalID AND l."Timestamp" = r."Timestamp" AND l.i = r.i
WHERE l.i IS NULL OR r.i IS NULL OR l.EventCode IS DISTINCT FROM r.EventCode OR l.EventParam IS DISTINCT FROM r.EventParam OR l.date IS DISTINCT FROM r.date""")
register("s17_append_distinct", lambda t: sinks.append_distinct(*two_sources(t)), "SELECT DISTINCT * FROM controller_events WHERE EventParam <> 4 OR EventCode <> 82")
register("u3_missing_days", lambda t: t.metrics_daily.where("CallPhase = 2").select("SignalID", "Date").distinct().subtract(
    t.metrics_daily.where("CallPhase = 6").select("SignalID", "Date")),
    "SELECT DISTINCT SignalID, Date FROM metrics_daily WHERE CallPhase = 2 EXCEPT SELECT SignalID, Date FROM metrics_daily WHERE CallPhase = 6")
