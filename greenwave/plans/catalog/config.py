"""Configuration and scalar-expression queries."""

from pyspark.sql import functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.ranges import band_score
from greenwave.operators import config as cfg, counts as ct, serve as sv
from greenwave.plans.adapters_sql import dow, week
from greenwave.plans.catalog.counts import FILTERED_SQL, filtered
from greenwave.plans.registry import register

RAW = {"raw_cor": """SELECT CAST(s_suppkey // 5 AS INTEGER) AS SignalID, s_suppkey % 7 <> 0 AS Include, ' ' || r_name || ' ' AS Contract, n_name AS District,
    CASE WHEN s_suppkey % 11 <> 0 THEN 'Corridor ' || CAST(s_suppkey // 10 AS VARCHAR) END AS Corridor, 'Sub ' || CAST(s_suppkey // 5 AS VARCHAR) AS Subcorridor,
    s_name AS Main_Street, n_name AS Side_Street, CASE WHEN s_suppkey % 3 <> 0 THEN CAST(DATE '2023-01-01' + CAST(s_suppkey % 50 AS INTEGER) AS DATE) END AS Modified
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""}


def raw_corridors(t):
    k = F.col("s_suppkey")
    s, n, r = t.base("supplier"), t.base("nation"), t.base("region")
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        F.floor(k / 5).cast("int").alias("SignalID"), (k % 7 != 0).alias("Include"),
        F.concat(F.lit(" "), "r_name", F.lit(" ")).alias("Contract"), F.col("n_name").alias("District"),
        F.when(k % 11 != 0, F.concat(F.lit("Corridor "), F.floor(k / 10).cast("string"))).alias("Corridor"),
        F.concat(F.lit("Sub "), F.floor(k / 5).cast("string")).alias("Subcorridor"), F.col("s_name").alias("Main_Street"),
        F.col("n_name").alias("Side_Street"),
        F.when(k % 3 != 0, F.date_add(F.lit("2023-01-01").cast("date"), (k % 50).cast("int"))).alias("Modified"))


def prepared(t, groups=None):
    return cfg.prepare_corridors(raw_corridors(t), groups, rename={"Contract": "Zone_Group", "District": "Zone"})


def prepared_sql(cond="true"):
    return f"""SELECT SignalID, Zone_Group, Zone, Corridor, Subcorridor, Main_Street || ' @ ' || Side_Street AS Name, Modified, CAST(SignalID AS VARCHAR) || ': ' || Main_Street || ' @ ' || Side_Street AS Description
    FROM (SELECT * EXCLUDE (Modified), m AS Modified, max(m) OVER (PARTITION BY SignalID, Zone, Corridor) AS mx FROM (SELECT * EXCLUDE (Contract, District), trim(Contract) AS Zone_Group, District AS Zone, coalesce(Modified, DATE '1900-01-01') AS m FROM raw_cor) WHERE SignalID > 0 AND Include AND {cond})
    WHERE Modified = mx AND Corridor IS NOT NULL"""


register("d1_corridors", prepared, prepared_sql(), extra=RAW)
register("d1_corridors_of_groups", lambda t: prepared(t, ["ASIA", "AMERICA"]), prepared_sql("Zone_Group IN ('ASIA', 'AMERICA')"), extra=RAW)
register("d2_corridors_in_several_zones", lambda t: cfg.corridors_in_several_zones(prepared(t)),
         f"SELECT Corridor, count(DISTINCT Zone) AS zones FROM ({prepared_sql()}) GROUP BY Corridor HAVING zones > 1", extra=RAW)


def odd_case(t):
    return t.corridors.withColumn("Corridor", F.when(F.col("SignalID") % 2 == 0, F.upper("Corridor")).otherwise(F.col("Corridor")))


register("d2_corridors_differing_by_case", lambda t: cfg.corridors_differing_by_case(odd_case(t)).select("folded", F.array_join("spellings", "|").alias("spellings")),
         """SELECT lower(c) AS folded, string_agg(c, '|' ORDER BY c) AS spellings FROM (SELECT DISTINCT CASE WHEN SignalID % 2 = 0 THEN upper(Corridor) ELSE Corridor END AS c FROM corridors) GROUP BY lower(c) HAVING count(*) > 1""")


def raw_detectors(t):
    """Every line as a configuration row: many rows per detector."""
    return t._line.select("SignalID", "Detector", "CallPhase", "l_orderkey", "l_partkey", "l_suppkey",
                          (F.col("l_partkey") % 5).alias("CountPriority"))


register("d4_first_detector_config", lambda t: cfg.first_per_detector(raw_detectors(t), ["l_orderkey", "l_partkey", "l_suppkey"]),
         "SELECT SignalID, Detector, CallPhase, l_orderkey, l_partkey, l_suppkey, l_partkey % 5 AS CountPriority FROM (SELECT *, row_number() OVER (PARTITION BY SignalID, Detector ORDER BY l_orderkey, l_partkey, l_suppkey) AS n FROM line) WHERE n = 1")
register("d4_merged_detector_config", lambda t: cfg.merge_daily_config(
    [raw_detectors(t).where("CountPriority = 4"), raw_detectors(t)], ["l_orderkey", "l_partkey", "l_suppkey"]),
    "SELECT SignalID, Detector, CallPhase, l_orderkey, l_partkey, l_suppkey, l_partkey % 5 AS CountPriority FROM (SELECT *, row_number() OVER (PARTITION BY SignalID, Detector ORDER BY l_partkey % 5 <> 4, l_orderkey, l_partkey, l_suppkey) AS n FROM line) WHERE n = 1")
register("d5_recent_ped_detectors", lambda t: cfg.recent_ped_detectors(t.ped_daily, "2025-01-15"),
         "SELECT DISTINCT SignalID, Detector, CallPhase FROM ped_daily WHERE Date >= DATE '2024-07-01'")
DC = "SignalID, Detector, CallPhase, CountPriority, TimeFromStopBar, DistanceFromStopBar, ApproachDesc, LaneNumber, DetectionTypeDesc"
register("d6_aog_detectors", lambda t: cfg.aog_detectors(t.det_config), f"""
SELECT {DC}, p AS AOGPriority FROM (SELECT *, min(p) OVER (PARTITION BY SignalID, CallPhase) AS mp FROM (SELECT *, CASE WHEN DetectionTypeDesc LIKE '%Exit%' THEN 0 WHEN DetectionTypeDesc LIKE '%Advanced Count%' THEN 1 END AS p FROM det_config) WHERE p IS NOT NULL) WHERE p = mp""")


def dated(t):
    """The configuration of every day with counts."""
    days = t.counts_1hr.select(F.array_sort(F.collect_set(F.col("Timeperiod").cast("date")))).scalar()
    return t.det_config.withColumn("Date", F.explode(days))


DATED = {**FILTERED_SQL, "dated": "SELECT d.*, Date FROM det_config d CROSS JOIN (SELECT DISTINCT CAST(Timeperiod AS DATE) AS Date FROM counts_1hr)",
         "bad": "SELECT DISTINCT SignalID, Detector, Date FROM filtered_1hr WHERE Good_Day = 0"}
register("d7_spillback_detectors", lambda t: cfg.qs_detectors(dated(t), ct.bad_detectors(filtered(t))),
         "SELECT * FROM dated ANTI JOIN bad USING (SignalID, Detector, Date) WHERE (DetectionTypeDesc LIKE '%Advanced Count%' OR DetectionTypeDesc LIKE '%Advanced Speed%') AND DistanceFromStopBar IS NOT NULL", extra=DATED)
register("d8_split_failure_detectors", lambda t: cfg.sf_detectors(t.det_config), f"SELECT {DC} FROM det_config WHERE DetectionTypeDesc LIKE '%Stop Bar Presence%'")
register("d9_volume_detectors", lambda t: cfg.volume_detectors(t.det_config),
         f"SELECT {DC}, m AS minCountPriority FROM (SELECT *, min(CountPriority) OVER (PARTITION BY SignalID, CallPhase) AS m FROM det_config) WHERE CountPriority = m")
register("d10_count_detectors", lambda t: cfg.count_detectors(dated(t), ct.bad_detectors(filtered(t))),
         "SELECT *, CountPriority = min(CountPriority) OVER (PARTITION BY Date, SignalID, CallPhase) AS CountDetector FROM (SELECT * FROM dated ANTI JOIN bad USING (SignalID, Detector, Date))", extra=DATED)
register("d11_latest_config", lambda t: cfg.latest_config(dated(t), "2024-01-25"), "SELECT * FROM dated WHERE Date = (SELECT max(Date) FROM dated WHERE Date <= DATE '2024-01-25')", extra=DATED)
register("d13_subcorridors_as_corridors", lambda t: cfg.subcorridors_as_corridors(t.corridors),
         'SELECT SignalID, Zone AS Zone_Group, Corridor AS Zone, Subcorridor AS Corridor, Name, "Asof", Latitude, Longitude, Description FROM corridors')

# ---- calendar expressions ---------------------------------------------------
TUESDAY = "CAST(d + CAST(2 - dayofweek(d) AS INTEGER) AS DATE)"
register("p1_p8_calendar", lambda t: t._line.select("Date", "Date_Hour").distinct().select(
    "Date", "Date_Hour", tp.floor_minutes("Date_Hour", 15).alias("q15"), tp.floor_minutes("Date_Hour", 180).alias("h3"),
    tp.week_index("Date").alias("Week"), tp.dow("Date").alias("DOW"), tp.midweek("Date").cast("int").alias("midweek"),
    tp.nearest_tuesday("Date").alias("tuesday"), tp.last_monday("Date").alias("monday"), tp.month_start("Date").alias("month"),
    tp.month_hour("Date_Hour").alias("month_hour"), tp.january_hour("Date_Hour").alias("january_hour"), tp.is_peak("Date_Hour").cast("int").alias("peak"),
    tp.quarter_label("Date").alias("quarter"), tp.fiscal_quarter("Date").alias("fiscal"), tp.quarter_end("Date").alias("quarter_end"),
    F.date_format("Date", "MMM").alias("month_name")),
    f"""SELECT d AS Date, h AS Date_Hour, time_bucket(INTERVAL '15 minutes', h) AS q15, h - to_hours(CAST(hour(h) % 3 AS INTEGER)) AS h3, {week('d')} AS Week, {dow('d')} AS DOW,
    CAST(dayofweek(d) IN (2, 3, 4) AS INTEGER) AS midweek, {TUESDAY} AS tuesday, CAST(d - CAST((dayofweek(d) + 6) % 7 AS INTEGER) AS DATE) AS monday, CAST(date_trunc('month', d) AS DATE) AS month,
    h - to_days(CAST(day(h) - 1 AS INTEGER)) AS month_hour, h - to_days(CAST(day(h) - 1 AS INTEGER)) - to_months(CAST(month(h) - 1 AS INTEGER)) AS january_hour,
    CAST(hour(h) IN (6, 7, 8, 9, 15, 16, 17, 18, 19) AS INTEGER) AS peak, CAST(year(d) AS VARCHAR) || '.' || CAST(quarter(d) AS VARCHAR) AS quarter,
    CAST(year(d + INTERVAL 6 MONTH) AS VARCHAR) || '.' || CAST(quarter(d + INTERVAL 6 MONTH) AS VARCHAR) AS fiscal, last_day(CAST(date_trunc('quarter', d) + INTERVAL 2 MONTH AS DATE)) AS quarter_end,
    strftime(d, '%b') AS month_name FROM (SELECT DISTINCT Date AS d, Date_Hour AS h FROM line)""")
register("p9_local_time", lambda t: t.camera_log.select("CameraID", "Timestamp", tp.local_time("Timestamp", "America/New_York").alias("local")),
         """SELECT CameraID, "Timestamp", "Timestamp" - INTERVAL 5 HOUR AS local FROM camera_log""")
register("p10_p11_text", lambda t: t.corridors.select("SignalID", "Zone", "Name",
         F.col("Name").rlike("(?i)supplier#0+[1-3]").cast("int").alias("hit"), F.regexp_extract("Name", "([0-9]+)$", 1).alias("digits"),
         F.regexp_replace("Name", "#0+", " ").alias("short"), F.concat_ws(": ", F.col("SignalID").cast("string"), F.trim("Zone")).alias("united"),
         F.split_part("Corridor", F.lit(" "), F.lit(2)).alias("number"), F.col("Zone").startswith("NATION_1").cast("int").alias("starts")),
         """SELECT SignalID, Zone, Name, CAST(regexp_matches(Name, '(?i)supplier#0+[1-3]') AS INTEGER) AS hit, regexp_extract(Name, '([0-9]+)$', 1) AS digits, regexp_replace(Name, '#0+', ' ') AS short,
         CAST(SignalID AS VARCHAR) || ': ' || trim(Zone) AS united, split_part(Corridor, ' ', 2) AS number, CAST(starts_with(Zone, 'NATION_1') AS INTEGER) AS starts FROM corridors""")
register("p16_coordinates", lambda t: t.locations.groupBy(F.floor(F.col("LocationId") / 10).alias("g")).agg(
    F.concat(F.lit("LINESTRING '"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("LocationId", "Longitude", "Latitude"))),
             lambda x: F.concat_ws(" ", F.round(x["Longitude"], 3).cast("string"), F.round(x["Latitude"], 3).cast("string"))), ","), F.lit("'")).alias("text"))
    .select("g", F.posexplode(sv.coordinates("text")).alias("i", "p")).select("g", "i", "p.longitude", "p.latitude"),
    "SELECT LocationId // 10 AS g, CAST(row_number() OVER (PARTITION BY LocationId // 10 ORDER BY LocationId) - 1 AS INTEGER) AS i, round(Longitude, 3) AS longitude, round(Latitude, 3) AS latitude FROM locations",
    "longitude latitude")
_edges = [(1.9, 1), (1.5, 5), (1.2, 8), (0.0, 10)]
register("j10_band_lookup", lambda t: t.travel_times.select("tmc_code", "Hour", "speed",
         band_score(F.col("speed") / 30, _edges, True).alias("forward"), band_score(F.col("speed") / 30, _edges, False).alias("backward")),
         """SELECT tmc_code, Hour, speed, CASE WHEN speed / 30 >= 1.9::DOUBLE THEN 1.0 WHEN speed / 30 >= 1.5::DOUBLE THEN 5.0 WHEN speed / 30 >= 1.2::DOUBLE THEN 8.0 WHEN speed / 30 >= 0 THEN 10.0 END AS forward,
         CASE WHEN speed / 30 <= 0 THEN 10.0 WHEN speed / 30 <= 1.2::DOUBLE THEN 8.0 WHEN speed / 30 <= 1.5::DOUBLE THEN 5.0 WHEN speed / 30 <= 1.9::DOUBLE THEN 1.0 END AS backward FROM travel_times""",
         "speed forward backward")
