"""Health score queries."""

from pyspark.sql import functions as F

from greenwave.operators import health as hl, rollup as ru, serve as sv
from greenwave.plans import rollup_sql as rs
from greenwave.plans.catalog.rollups import midweek
from greenwave.plans.registry import register

PLACE = "Zone_Group, Zone, Corridor, Subcorridor"


def _score(x, band, forward):
    edges = sorted(zip(hl.BANDS[band], hl.SCORES), reverse=forward)
    op = ">=" if forward else "<="
    return "CASE " + " ".join(f"WHEN {x} {op} {float(e)!r}::DOUBLE THEN {float(s)!r}::DOUBLE" for e, s in edges) + " END"


def _weight(name):
    return "CASE Context " + " ".join(f"WHEN {i} THEN {float(w)!r}::DOUBLE" for i, w in enumerate(hl.WEIGHTS[name], 1)) + " END"


_cols = ", ".join(f"CAST({src} AS DOUBLE) AS {n}, {_score(f'CAST({src} AS DOUBLE)', b, f)} AS {n}_Score, CASE WHEN {_score(f'CAST({src} AS DOUBLE)', b, f)} IS NOT NULL THEN {_weight(n)} END AS {n}_Weight"
                  for n, (src, b, f) in hl.MEASURES.items())
_cat = "CASE Context " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(hl.CONTEXT_CATEGORY, 1)) + " END"
HS = {"hscored": f"SELECT {PLACE}, Month, Context, {_cat} AS Context_Category, {_cols} FROM (SELECT * EXCLUDE (flash_events), coalesce(flash_events, 0) AS flash_events, pti - tti AS bi FROM health_input) WHERE Context BETWEEN 1 AND 5"}
SCORE_F = " ".join(f"{n} {n}_Score {n}_Weight" for n in hl.MEASURES)
register("h3_scores", lambda t: hl.scored(t.health_input), "SELECT * FROM hscored", SCORE_F, extra=HS)


def pct_sql(group):
    names = hl.GROUPS[group]
    w = " + ".join(f"coalesce({n}_Weight, 0)" for n in names)
    e = " + ".join(f"coalesce({n}_Score * {n}_Weight, 0)" for n in names)
    vals = ", ".join([f"{n}_Score" for n in names] + list(names))
    nulls = ", ".join("NULL" for _ in range(2 * len(names)))
    return f"""SELECT Zone_Group, Zone, coalesce(Corridor, Zone) AS Corridor, coalesce(Subcorridor, Corridor, Zone) AS Subcorridor, Month, Context, Percent_Health, Missing_Data, {vals} FROM (
    WITH r AS (SELECT {PLACE}, Month, Context_Category AS Context, avg(({e}) / nullif({w}, 0) / 10) OVER p AS Percent_Health, avg(1 - ({w}) / 100) OVER p AS Missing_Data, {vals} FROM hscored WINDOW p AS (PARTITION BY {PLACE}, Month)),
    c AS (SELECT Zone_Group, Zone, Corridor, Month, avg(Percent_Health) AS Percent_Health FROM r GROUP BY ALL),
    z AS (SELECT Zone_Group, Zone, Month, avg(Percent_Health) AS Percent_Health FROM c GROUP BY ALL)
    SELECT * FROM r UNION ALL SELECT Zone_Group, Zone, Corridor, NULL, Month, k, Percent_Health, NULL, {nulls} FROM c JOIN (SELECT Corridor, max(Context) AS k FROM r GROUP BY ALL) USING (Corridor)
    UNION ALL SELECT Zone_Group, Zone, NULL, NULL, Month, NULL, Percent_Health, NULL, {nulls} FROM z)"""


def health(t, g):
    return hl.percent_health(hl.scored(t.health_input), g)


for g in hl.GROUPS:
    f = "Percent_Health Missing_Data " + " ".join(f"{n} {n}_Score" for n in hl.GROUPS[g])
    register(f"h4_{g}_health", lambda t, g=g: health(t, g), pct_sql(g), f, extra=HS)
    means = ", ".join(f"avg({c}) AS {c}" for c in f.split())
    cor = f"SELECT Zone_Group, Zone, Corridor, Month, {means} FROM ({pct_sql(g)}) GROUP BY Zone_Group, Zone, Corridor, Month"
    register(f"h5_{g}_corridor_health", lambda t, g=g: hl.corridor_health(health(t, g)), cor, f, extra=HS)
_m = "Percent_Health Missing_Data " + " ".join(f"{n} {n}_Score" for n in hl.GROUPS["maintenance"])
register("h5_maintenance_plot_rows", lambda t: hl.health_plot_rows(health(t, "maintenance")),
         f"SELECT Corridor AS Zone_Group, Subcorridor AS Corridor, * EXCLUDE (Zone_Group, Zone, Corridor, Subcorridor) FROM ({pct_sql('maintenance')})", _m, extra=HS)
register("v2_health_query", lambda t: sv.query_health(lambda name: health(t, "safety"), "safety", "ASIA", month="2023-03-01"),
         f"SELECT * FROM ({pct_sql('safety')}) WHERE (Zone_Group = 'ASIA' OR Zone = 'ASIA') AND Month = DATE '2023-03-01'",
         "Percent_Health Missing_Data " + " ".join(f"{n} {n}_Score" for n in hl.GROUPS["safety"]), extra=HS)
register("v9_filter_health", lambda t: sv.filter_health(health(t, "operations"), ["EUROPE", "NATION_2"], "Corridor 4"),
         f"SELECT * FROM ({pct_sql('operations')}) WHERE (Zone_Group IN ('EUROPE', 'NATION_2') OR Zone IN ('EUROPE', 'NATION_2')) AND Corridor = 'Corridor 4'",
         "Percent_Health Missing_Data " + " ".join(f"{n} {n}_Score" for n in hl.GROUPS["operations"]), extra=HS)

# ---- summaries --------------------------------------------------------------
_src = {"vpd": (rs.corridor_rollup(rs.monthly_avg_by_day(f"SELECT * FROM metrics_daily WHERE {rs.MIDWEEK}", "vpd"), "vpd", "Month"), "vpd"),
        "aog": (rs.corridor_rollup(rs.monthly_avg_by_day("SELECT * FROM metrics_hourly", "aog", "vol", True), "aog", "Month", "vol"), "aog"),
        "sf": (rs.corridor_rollup(rs.monthly_avg_by_day("SELECT * FROM metrics_hourly", "sf_freq", "cycles", True), "sf_freq", "Month", "cycles"), "sf_freq"),
        "tp": (rs.corridor_rollup(rs.monthly_avg_by_day("SELECT * FROM metrics_daily", "vph"), "vph", "Month"), "vph")}
SUM = {f"sum_{k}": v[0] for k, v in _src.items()}


def frames(t):
    c = t.corridors
    by_day = ru.cor_monthly_avg_by_day
    return [(by_day(ru.monthly_avg_by_day(midweek(t.metrics_daily), "vpd"), c, "vpd"), "vpd", "vpd"),
            (by_day(ru.monthly_avg_by_day(t.metrics_hourly, "aog", "vol", True), c, "aog", "vol"), "aog", "aog"),
            (by_day(ru.monthly_avg_by_day(t.metrics_hourly, "sf_freq", "cycles", True), c, "sf_freq", "cycles"), "sf_freq", "sf"),
            (by_day(ru.monthly_avg_by_day(t.metrics_daily, "vph"), c, "vph"), "vph", "tp")]


SUMMARY = "SELECT * FROM " + " FULL JOIN ".join(f"(SELECT Zone_Group, Corridor, Month, {v[1]} AS {k}, delta AS {k}_delta FROM sum_{k}) {k}" + (" USING (Zone_Group, Corridor, Month)" if i else "")
                                                for i, (k, v) in enumerate(_src.items())) + " WHERE Zone_Group <> Corridor"
SF = " ".join(f"{k} {k}_delta" for k in _src)
register("h1_monthly_summary", lambda t: hl.monthly_summary(frames(t)), SUMMARY, SF, extra=SUM)
register("h6_corridor_summary", lambda t: hl.corridor_summary(frames(t), lambda c: ~c.startswith("Corridor")),
         f"SELECT * FROM ({SUMMARY}) SEMI JOIN sum_vpd USING (Zone_Group, Corridor, Month) WHERE Zone_Group NOT LIKE 'Corridor%' AND Corridor LIKE 'Corridor%'", SF, extra=SUM)
register("h6_metrics_by_corridor", lambda t: hl.metrics_by_corridor(hl.monthly_summary(frames(t)), ["vpd", "aog"]),
         f"SELECT Zone_Group, Month, Metric, Corridor, max(v) AS value FROM (SELECT Zone_Group, Corridor, Month, 'vpd' AS Metric, vpd AS v FROM ({SUMMARY}) UNION ALL SELECT Zone_Group, Corridor, Month, 'aog', aog FROM ({SUMMARY})) GROUP BY ALL",
         "value", extra=SUM)


def signal_input(t):
    """Signal-level rows: camera rows hold cctv, signal rows hold the rest."""
    h = t.health_input.join(t.corridors.select("SignalID", "Corridor", "Subcorridor", "Zone").distinct(), ["Corridor", "Subcorridor", "Zone"])
    one = h.groupBy(F.col("Corridor").alias("Zone_Group"), F.col("SignalID").cast("string").alias("Corridor"), "Month").agg(
        *[F.max(c).alias(c) for c in ("du", "pau", "cu", "flash_events", "pr", "pd", "sf_freq", "tti", "pti", "cri", "kabco", "rsi", "bpsi")])
    cam = h.join(t.cam_config.select("CameraID", "SignalID"), "SignalID").groupBy(
        F.col("Corridor").alias("Zone_Group"), F.col("CameraID").alias("Corridor"), "Month").agg(F.max("cctv").alias("cctv"))
    merged = hl.merge_cameras_into_signals(one.unionByName(cam, allowMissingColumns=True), t.cam_config)
    contexts = t.health_input.groupBy("Corridor", "Subcorridor").agg(F.max("Context").alias("Context"))
    sub = t.health_input.groupBy("Corridor", "Subcorridor", "Month").agg(F.max("tti").alias("tti"), F.max("pti").alias("pti"))
    return hl.signal_health_input(merged, t.corridors, contexts, sub)


SIG = {"hsig": f"""SELECT * FROM (WITH h AS (SELECT hi.*, c.SignalID FROM health_input hi JOIN (SELECT DISTINCT SignalID, Corridor, Subcorridor, Zone FROM corridors) c USING (Corridor, Subcorridor, Zone)),
  one AS (SELECT Corridor AS zg, CAST(SignalID AS VARCHAR) AS sid, Month, {', '.join(f'max({c}) AS {c}' for c in ('du', 'pau', 'cu', 'flash_events', 'pr', 'pd', 'sf_freq', 'cri', 'kabco', 'rsi', 'bpsi'))} FROM h GROUP BY ALL),
  cam AS (SELECT h.Corridor AS zg, CAST(h.SignalID AS VARCHAR) AS sid, Month, max(cctv) AS cctv FROM h JOIN cam_config k ON k.SignalID = h.SignalID GROUP BY ALL),
  mg AS (SELECT * FROM one FULL JOIN cam USING (zg, sid, Month)),
  cx AS (SELECT Corridor, Subcorridor, max(Context) AS Context FROM health_input GROUP BY ALL),
  su AS (SELECT Corridor, Subcorridor, Month, max(tti) AS tti, max(pti) AS pti FROM health_input GROUP BY ALL)
  SELECT mg.* EXCLUDE (zg, sid), c.Zone_Group, c.Zone, c.Corridor, mg.sid AS Subcorridor, cx.Context, CASE WHEN Context BETWEEN 1 AND 4 THEN su.tti END AS tti, CASE WHEN Context BETWEEN 1 AND 4 THEN su.pti END AS pti
  FROM mg JOIN (SELECT DISTINCT Corridor, SignalID, Subcorridor, Zone_Group, Zone FROM corridors) c ON c.Corridor = mg.zg AND CAST(c.SignalID AS VARCHAR) = mg.sid
  JOIN cx ON cx.Corridor = c.Corridor AND cx.Subcorridor = c.Subcorridor LEFT JOIN su ON su.Corridor = c.Corridor AND su.Subcorridor = c.Subcorridor AND su.Month = mg.Month)"""}
register("h2_signal_health_input", signal_input, "SELECT * FROM hsig", "du pau cu pr pd sf_freq tti pti cri kabco rsi bpsi cctv", extra=SIG)
SIG2 = {**SIG, "hscored": HS["hscored"].replace("FROM health_input)", "FROM hsig)")}
register("h5_signal_maintenance_health", lambda t: hl.with_subcorridor(hl.percent_health(hl.scored(signal_input(t)), "maintenance"), t.corridors),
         f"SELECT h.* EXCLUDE (Subcorridor), h.Subcorridor AS SignalID, c.Subcorridor FROM ({pct_sql('maintenance')}) h JOIN (SELECT DISTINCT Zone, Corridor, Subcorridor, CAST(SignalID AS VARCHAR) AS sid FROM corridors) c ON c.Zone = h.Zone AND c.Corridor = h.Corridor AND c.sid = h.Subcorridor",
         _m, extra=SIG2)
