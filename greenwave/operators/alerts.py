"""Watchdog alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from greenwave.functions.layout import laid_out
from greenwave.functions.timeparts import day

ALERT_COLUMNS = ("Zone_Group", "Zone", "Corridor", "SignalID", "CallPhase", "Detector", "Date", "Name", "Alert", "ApproachDesc")
# fixed alert and zone names
BAD_DETECTOR, BAD_PED, NO_CAMERA, RAMP_ZONE = "Bad Vehicle Detection", "Bad Ped Pushbuttons", "No Camera Image", "Ramp Meters"
#: Alerts that a task holds: wide rows, which ten sorts and hash tables of one stage keep at about 3 kB each.
ALERTS_PER_TASK = 200_000


def _since(df: DataFrame, today, days: int | None) -> DataFrame:
    if days is None:
        return df
    return df.where((F.col("Date") >= F.date_sub(F.lit(today).cast("date"), days)) & (F.col("Date") < F.lit(today).cast("date")))


def _text(c) -> Column:
    return F.col(c).cast("string").alias(c)


def bad_detector_alerts(bad: DataFrame, config: DataFrame, corridors: DataFrame, today=None, days: int | None = None) -> DataFrame:
    """Bad vehicle detectors with their approach and lane."""
    keys = [k for k in ("SignalID", "Detector", "Date") if k in config.columns]
    rows = _since(bad, today, days).select("SignalID", "Detector", "Date").join(
        config.select(*keys, "CallPhase", "ApproachDesc", "LaneNumber"), keys, "left")
    rows = rows.join(corridors.select("SignalID", "Zone_Group", "Zone", "Corridor", "Name"), "SignalID").where("Corridor is not null")
    name = F.when(F.col("Corridor") == "Ramp Meter", F.regexp_replace("Name", "@", "-")).otherwise(F.col("Name"))
    lane = F.when(F.col("ApproachDesc").isNull(), "").otherwise(
        F.concat(F.trim("ApproachDesc"), F.lit(" Lane "), F.coalesce(F.col("LaneNumber").cast("string"), F.lit("NA"))))
    return rows.select("Zone_Group", "Zone", "Corridor", _text("SignalID"), _text("CallPhase"), _text("Detector"), "Date",
                       name.alias("Name"), F.lit(BAD_DETECTOR).alias("Alert"), lane.alias("ApproachDesc"))


def bad_ped_alerts(bad: DataFrame, corridors: DataFrame, today=None, days: int | None = None) -> DataFrame:
    rows = _since(bad, today, days).join(corridors.select("SignalID", "Zone_Group", "Zone", "Corridor", "Name"), "SignalID", "left")
    return rows.select("Zone_Group", "Zone", "Corridor", _text("SignalID"), F.lit(None).cast("string").alias("CallPhase"),
                       _text("Detector"), "Date", "Name", F.lit(BAD_PED).alias("Alert"), F.lit(None).cast("string").alias("ApproachDesc"))


def camera_alerts(activity: DataFrame, cameras: DataFrame, today=None, days: int | None = None) -> DataFrame:
    rows = _since(activity, today, days).where(F.col("Size") == 0).select("CameraID", "Date").join(cameras, "CameraID")
    rows = rows.where(F.col("Date") > F.col("As_of_Date"))
    return rows.select("Zone_Group", "Zone", "Corridor", F.col("CameraID").alias("SignalID"), F.lit("0").alias("CallPhase"),
                       F.lit("0").alias("Detector"), "Date", F.col("Location").alias("Name"), F.lit(NO_CAMERA).alias("Alert"),
                       F.lit(None).cast("string").alias("ApproachDesc"))


def _group_ramp_detectors(rows: DataFrame) -> DataFrame:
    """Ramp meters: phase from the approach's first word, mainline detectors of an approach as one; other rows stay, repeats included.

    One pass over all rows of a signal, which are a few months of days for each of its detectors.
    """
    ramp = F.coalesce(F.col("Zone") == RAMP_ZONE, F.lit(False))
    text = F.max(F.when(ramp, F.col("ApproachDesc"))).over(Window.partitionBy("SignalID", "Detector"))
    word = F.regexp_extract("_text", "^[^ -]+", 0)
    rows = rows.withColumn("_text", text).withColumns({
        "CallPhase": F.when(~ramp, F.col("CallPhase")).when(word.isin("Mainline", "Passage", "Demand", "Queue"), word).otherwise("Other"),
        "ApproachDesc": F.when(ramp, F.regexp_replace("_text", r"Mainline-\S+", "Mainline")).otherwise(F.col("ApproachDesc"))})
    together = F.collect_set(F.when(ramp, F.col("Detector"))).over(Window.partitionBy("SignalID", "ApproachDesc"))
    rows = rows.withColumn("Detector", F.when(ramp, F.array_join(F.array_sort(together), "/")).otherwise(F.col("Detector")))
    counted = rows.groupBy(*ALERT_COLUMNS).agg(F.count(F.lit(1)).alias("_n"))
    return counted.select(*ALERT_COLUMNS, F.explode(F.array_repeat(F.lit(0), F.when(ramp, 1).otherwise(F.col("_n")).cast("int"))).alias("_i")).drop("_i")


def alerts(parts: Sequence[DataFrame], today=None, days: int | None = 180, cap: int = 90) -> DataFrame:
    """All alerts with the length of their streak of days (a gap of more than one day starts anew)."""
    rows = None
    for part in parts:
        part = part.select(*ALERT_COLUMNS)
        rows = part if rows is None else rows.unionByName(part)
    if today is not None and days is not None:
        rows = rows.where(F.col("Date") > F.date_sub(F.lit(today).cast("date"), days))
    # signals without a corridor are not reported; a missing detector or phase is 0
    rows = rows.where(F.col("Corridor").isNotNull()).withColumns({c: F.coalesce(c, F.lit("0")) for c in ("Detector", "CallPhase")})
    # one layout by signal serves the distinct rows, every window and the grouping
    rows = laid_out(rows, ["SignalID"], rows.count(), ALERTS_PER_TASK).distinct()
    later = Window.partitionBy("SignalID", "Detector").orderBy(
        F.desc("Alert"), F.desc("CallPhase"), F.desc("Date")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("ApproachDesc", F.coalesce(F.last("ApproachDesc", ignorenulls=True).over(later), F.lit("")))
    rows = _group_ramp_detectors(rows)
    keys = ["Zone_Group", "Zone", "SignalID", "CallPhase", "Detector", "Alert"]
    w = Window.partitionBy(*keys).orderBy("Date", "Corridor", "Name", "ApproachDesc")
    gap = F.datediff("Date", F.lag("Date").over(w))
    rows = rows.withColumn("_run", F.sum(F.when(gap <= 1, 0).otherwise(1)).over(w))
    run = Window.partitionBy(*keys, "_run").orderBy("Date", "Corridor", "Name", "ApproachDesc")
    return rows.withColumn("streak", F.least(F.row_number().over(run), F.lit(cap))).drop("_run")


def alerts_between(rows: DataFrame, start, end) -> DataFrame:
    return rows.where(F.col("Date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def filter_alerts(rows: DataFrame, alert: str, zone_group: str | None = None, corridor: str | None = None,
                  phase: str | None = None, pattern: str = "", active: str = "All",
                  groups: dict[str, tuple[str, Sequence[str]]] | None = None) -> dict[str, DataFrame]:
    """Alerts of a type in a place, and a table of occurrences and active streaks.

    A streak is active when it reaches the type's latest date.  ``active`` is 'All', 'Active' or
    'Active 3-days'.  ``groups`` maps group names to (column, values).
    """
    kind = rows.where(F.col("Alert") == alert)
    latest = kind.select(F.max("Date")).scalar()
    df = kind
    if corridor is not None:
        df = df.where(F.col("Corridor") == corridor)
    elif zone_group is not None:
        if groups and zone_group in groups:
            c, values = groups[zone_group]
            df = df.where(F.col(c).isin(*values))
        else:
            df = df.where((F.col("Zone") == zone_group) | (F.col("Zone_Group") == zone_group))
    if pattern:
        hit = lambda c: F.coalesce(F.col(c).cast("string").rlike(f"(?i){pattern}"), F.lit(False))
        df = df.where(hit("Name") | hit("Corridor") | hit("SignalID"))
    if phase is not None and alert != "Missing Records":
        df = df.where(F.col("CallPhase") == str(phase))
    keys = ["Zone", "Corridor", "SignalID", "CallPhase", "Detector", "ApproachDesc", "Name", "Alert"]
    table = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("Occurrences"),
                                  F.max(F.when(F.col("Date") == latest, F.col("streak")).otherwise(0)).alias("Streak"))
    floor = {"All": None, "Active": 0, "Active 3-days": 2}[active]
    if floor is not None:
        table = table.where(F.col("Streak") > floor)
        df = df.join(table.select("SignalID", "Detector").distinct(), ["SignalID", "Detector"], "left_semi")
    if alert != BAD_DETECTOR:
        table = table.drop("ApproachDesc")
    return {"rows": df, "table": table}
