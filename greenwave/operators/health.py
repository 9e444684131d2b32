"""Weighted health scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from greenwave.functions.ranges import band_score

# The lower or upper edge of each score's band, scores 1 to 10 in order.
SCORES = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)
BANDS = {
    "cctv": (0.0, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0),
    "comm": (0.91, 0.92, 0.93, 0.94, 0.95, 0.96, 0.97, 0.98, 0.99, 1.00),
    "detection": (0.20, 0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90, 0.95, 1.00),
    "ped_actuation": (0.20, 0.30, 0.40, 0.50, 0.60, 0.70, 0.80, 0.90, 0.95, 1.00),
    "flash_events": (9, 8, 7, 6, 5, 4, 3, 2, 1, 0),
    "pr": (0.00, 1.00, 1.02, 1.04, 1.06, 1.08, 1.10, 1.12, 1.14, 1.16),
    "ped_delay": (270, 240, 210, 180, 150, 120, 90, 60, 30, 0),
    "sf": (0.350, 0.300, 0.250, 0.225, 0.200, 0.150, 0.100, 0.075, 0.050, 0.000),
    "tti": (1.9, 1.8, 1.7, 1.6, 1.5, 1.4, 1.3, 1.2, 1.1, 0.0),
    "bi": (0.250, 0.225, 0.200, 0.175, 0.150, 0.125, 0.100, 0.075, 0.050, 0.000),
    "crash_rate": (9, 8, 7, 6, 5, 4, 3, 2, 1, 0),
    "kabco": (900, 800, 700, 600, 500, 400, 300, 200, 100, 0),
    "high_speed": (2.00, 1.20, 1.15, 1.10, 1.05, 1.00, 0.95, 0.90, 0.85, 0.00),
    "ped_injury_exposure": (1.00, 0.95, 0.85, 0.75, 0.65, 0.55, 0.45, 0.35, 0.30, 0.00),
}
# Weight of each measure by context 1 to 5.
CONTEXT_CATEGORY = ("Multi-Modal with Pedestrian Focus", "Multi-Modal Balanced and Coordinated",
                    "Mainline Vehicle Progression", "Low Volume Coordinated", "Non-Coordinated or Isolated")
WEIGHTS = {
    "Detection_Uptime": (25, 12, 12, 15, 15),
    "Ped_Act_Uptime": (15, 47, 47, 40, 40),
    "Comm_Uptime": (40, 23, 23, 25, 25),
    "CCTV_Uptime": (10, 6, 6, 5, 5),
    "Flash_Events": (10, 12, 12, 15, 15),
    "Platoon_Ratio": (10, 30, 30, 15, 0),
    "Ped_Delay": (50, 20, 10, 5, 10),
    "Split_Failures": (20, 20, 15, 30, 40),
    "TTI": (5, 10, 20, 30, 25),
    "BI": (15, 20, 25, 20, 25),
    "Crash_Rate_Index": (50, 20, 10, 20, 35),
    "KABCO_Crash_Severity_Index": (10, 30, 30, 20, 35),
    "High_Speed_Index": (10, 30, 45, 50, 25),
    "Ped_Injury_Exposure_Index": (30, 20, 15, 10, 5),
}
# measure: (input column, band, larger edge at or above the value?)
MEASURES = {
    "Detection_Uptime": ("du", "detection", False), "Ped_Act_Uptime": ("pau", "ped_actuation", False),
    "Comm_Uptime": ("cu", "comm", False), "CCTV_Uptime": ("cctv", "cctv", False),
    "Flash_Events": ("flash_events", "flash_events", True),
    "Platoon_Ratio": ("pr", "pr", True), "Ped_Delay": ("pd", "ped_delay", True),
    "Split_Failures": ("sf_freq", "sf", True), "TTI": ("tti", "tti", True), "BI": ("bi", "bi", True),
    "Crash_Rate_Index": ("cri", "crash_rate", True), "KABCO_Crash_Severity_Index": ("kabco", "kabco", True),
    "High_Speed_Index": ("rsi", "high_speed", True), "Ped_Injury_Exposure_Index": ("bpsi", "ped_injury_exposure", True),
}
GROUPS = {
    "maintenance": ("Detection_Uptime", "Ped_Act_Uptime", "Comm_Uptime", "CCTV_Uptime", "Flash_Events"),
    "operations": ("Platoon_Ratio", "Ped_Delay", "Split_Failures", "TTI", "BI"),
    "safety": ("Crash_Rate_Index", "KABCO_Crash_Severity_Index", "High_Speed_Index", "Ped_Injury_Exposure_Index"),
}
PLACE = ("Zone_Group", "Zone", "Corridor", "Subcorridor")


def monthly_summary(frames: Sequence[tuple[DataFrame, str, str]], sub: bool = False) -> DataFrame:
    """All monthly metrics side by side per place and month, each with its change; places only, no groups.

    frames: (frame, value column, result name).  The frames are stacked and grouped once instead of
    being joined one after another.
    """
    keys = ["Zone_Group", "Corridor", "Month"]
    stacked = None
    for df, value, name in frames:
        part = df.select(*keys, F.lit(name).alias("_m"), F.col(value).cast("double").alias("_v"), F.col("delta").alias("_d"))
        stacked = part if stacked is None else stacked.unionByName(part)
    names = [name for _, _, name in frames]
    cell = lambda n, c: F.max(F.when(F.col("_m") == n, F.col(c)))
    out = stacked.where(F.col("Zone_Group") != F.col("Corridor")).groupBy(*keys).agg(
        *[cell(n, "_v").alias(n) for n in names], *[cell(n, "_d").alias(f"{n}_delta") for n in names])
    return out.withColumnsRenamed({"Corridor": "Subcorridor", "Zone_Group": "Corridor"}) if sub else out


def merge_cameras_into_signals(summary: DataFrame, cameras: DataFrame, prefix: str = "CAM") -> DataFrame:
    """Camera rows moved to their signal, and each signal's rows of a month merged into one."""
    keys = ["Corridor", "Zone_Group", "Month"]
    moved = summary.join(cameras.select(F.col("CameraID").alias("Corridor"), F.col("SignalID").cast("string").alias("_s")), "Corridor", "left")
    moved = moved.withColumn("Corridor", F.coalesce("_s", "Corridor")).drop("_s").where(~F.col("Corridor").contains(prefix))
    return moved.groupBy(*keys).agg(*[F.max(c).alias(c) for c in summary.columns if c not in keys])


def signal_health_input(signals: DataFrame, corridors: DataFrame, contexts: DataFrame, sub_input: DataFrame) -> DataFrame:
    """Signal rows with context; travel indices come from the signal's subcorridor in contexts 1 to 4.

    signals: Zone_Group (corridor), Corridor (signal), Month and the measures.
    """
    rows = signals.drop("tti", "pti").withColumnsRenamed({"Corridor": "SignalID", "Zone_Group": "Corridor"})
    tree = corridors.select("Corridor", F.col("SignalID").cast("string").alias("SignalID"), "Subcorridor",
                            "Zone_Group", "Zone").distinct()
    rows = rows.join(tree, ["Corridor", "SignalID"]).join(contexts.select("Corridor", "Subcorridor", "Context"), ["Corridor", "Subcorridor"])
    near = sub_input.select("Corridor", "Subcorridor", "Month", "tti", "pti").distinct()
    rows = rows.join(near, ["Corridor", "Subcorridor", "Month"], "left")
    near_only = lambda c: F.when(F.col("Context").between(1, 4), F.col(c)).alias(c)
    rows = rows.withColumns({"tti": near_only("tti"), "pti": near_only("pti")}).drop("Subcorridor")
    return rows.withColumnRenamed("SignalID", "Subcorridor")


def _by_context(values: Sequence) -> Column:
    out = F.lit(None)
    for i, v in enumerate(values, start=1):
        out = F.when(F.col("Context") == i, F.lit(v)).otherwise(out)
    return out


def scored(df: DataFrame) -> DataFrame:
    """Measures, their 1-10 scores, and the context's weights (NULL where there is no score)."""
    df = df.withColumns({"bi": F.col("pti") - F.col("tti"), "flash_events": F.coalesce("flash_events", F.lit(0))})
    df = df.where(F.col("Context").between(1, 5))
    cols = [*PLACE, "Month", "Context", _by_context(CONTEXT_CATEGORY).alias("Context_Category")]
    for name, (source, band, forward) in MEASURES.items():
        x = F.col(source).cast("double")
        score = band_score(x, list(zip(BANDS[band], SCORES)), forward)
        weight = F.when(score.isNotNull(), _by_context(WEIGHTS[name]).cast("double"))
        cols += [x.alias(name), score.alias(f"{name}_Score"), weight.alias(f"{name}_Weight")]
    return df.select(*cols)


def percent_health(scores: DataFrame, group: str) -> DataFrame:
    """Percent health and missing share of a group of measures, with corridor and zone subtotals."""
    names = GROUPS[group]
    zero = F.lit(0.0)
    weight = sum((F.coalesce(f"{n}_Weight", zero) for n in names), zero)
    earned = sum((F.coalesce(F.col(f"{n}_Score") * F.col(f"{n}_Weight"), zero) for n in names), zero)
    place = Window.partitionBy(*PLACE, "Month")
    rows = scores.withColumns({"_p": F.try_divide(earned, weight) / 10, "_x": 1 - weight / 100})
    rows = rows.select(*PLACE, "Month", F.col("Context_Category").alias("Context"),
                       F.avg("_p").over(place).alias("Percent_Health"), F.avg("_x").over(place).alias("Missing_Data"),
                       *[f"{n}_Score" for n in names], *names)
    corridor = rows.groupBy("Zone_Group", "Zone", "Corridor", "Month").agg(F.avg("Percent_Health").alias("Percent_Health"))
    zone = corridor.groupBy("Zone_Group", "Zone", "Month").agg(F.avg("Percent_Health").alias("Percent_Health"))
    kinds = rows.groupBy("Corridor").agg(F.max("Context").alias("Context"))
    out = rows.unionByName(corridor.join(kinds, "Corridor", "left"), allowMissingColumns=True).unionByName(zone, allowMissingColumns=True)
    corridor_name = F.coalesce("Corridor", "Zone")
    return out.withColumn("Corridor", corridor_name).withColumn("Subcorridor", F.coalesce("Subcorridor", "Corridor"))


def corridor_health(sub_health: DataFrame) -> DataFrame:
    """Means over a corridor's subcorridors (and its own subtotal row) of every column."""
    keys = ["Zone_Group", "Zone", "Corridor", "Month"]
    values = [c for c in sub_health.columns if c not in (*keys, "Subcorridor", "Context")]
    return sub_health.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in values])


def health_plot_rows(health: DataFrame, corridor_level: bool = False) -> DataFrame:
    """Re-keyed for reports: one level of the hierarchy as Zone_Group, the next as Corridor."""
    if corridor_level:
        return health.drop("Zone_Group").withColumnRenamed("Zone", "Zone_Group")
    return health.drop("Zone_Group", "Zone").withColumnsRenamed({"Corridor": "Zone_Group", "Subcorridor": "Corridor"})


def with_subcorridor(signal_health: DataFrame, corridors: DataFrame) -> DataFrame:
    """Signal health rows with the signal's subcorridor."""
    tree = corridors.select("Zone", "Corridor", "Subcorridor", F.col("SignalID").cast("string").alias("SignalID")).distinct()
    return (signal_health.withColumnRenamed("Subcorridor", "SignalID").join(tree, ["Zone", "Corridor", "SignalID"])
            .where("Subcorridor is not null"))


def corridor_summary(frames: Sequence[tuple[DataFrame, str, str]], is_zone) -> DataFrame:
    """Metrics of corridors in zones, keeping the places and months of the first frame.

    ``is_zone`` maps a column to a condition that says whether a name is a zone's.
    """
    keys = ["Zone_Group", "Corridor", "Month"]
    wide = monthly_summary(frames)
    first = frames[0][0].select(*keys).distinct()
    return wide.join(first, keys, "left_semi").where(is_zone(F.col("Zone_Group")) & ~is_zone(F.col("Corridor")))


def metrics_by_corridor(summary: DataFrame, metrics: Sequence[str], corridors: Sequence[str] | None = None) -> DataFrame:
    """One row per zone group, month, metric and corridor; with ``corridors``, a column for each of these instead."""
    long = summary.unpivot(["Zone_Group", "Corridor", "Month"], list(metrics), "Metric", "value")
    if corridors is None:
        return long.groupBy("Zone_Group", "Month", "Metric", "Corridor").agg(F.max("value").alias("value"))
    return long.groupBy("Zone_Group", "Month", "Metric").pivot("Corridor", list(corridors)).agg(F.max("value"))
