"""Dimension preparation: corridors, detector and camera configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def prepare_corridors(raw: DataFrame, zone_groups: Sequence[str] | None = None,
                      rename: dict[str, str] | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """Signal hierarchy from the raw corridor list: trimmed, included signals, latest revision.

    ``rename`` maps a tenant's columns to the hierarchy's (for example Contract to Zone_Group,
    District to Zone).  ``extra`` names further columns to keep.
    """
    df = raw.withColumnsRenamed(rename or {})
    text = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    df = df.withColumns({c: F.trim(c) for c in text})
    df = df.where((F.col("SignalID") > 0) & F.col("Include"))
    if zone_groups is not None:
        df = df.where(F.col("Zone_Group").isin(*zone_groups))
    df = df.withColumn("Modified", F.coalesce("Modified", F.lit("1900-01-01").cast("date")))
    newest = F.max("Modified").over(Window.partitionBy("SignalID", "Zone", "Corridor"))
    df = df.withColumn("_newest", newest).where((F.col("Modified") == F.col("_newest")) & F.col("Corridor").isNotNull())
    name = F.concat_ws(" @ ", F.col("Main_Street"), F.col("Side_Street"))
    return df.select("SignalID", "Zone_Group", "Zone", "Corridor", "Subcorridor", *extra, name.alias("Name"),
                     F.col("Modified"), F.concat(F.col("SignalID").cast("string"), F.lit(": "), name).alias("Description"))


def corridors_in_several_zones(corridors: DataFrame) -> DataFrame:
    return (corridors.groupBy("Corridor").agg(F.countDistinct("Zone").alias("zones"))
            .where(F.col("zones") > 1))


def corridors_differing_by_case(corridors: DataFrame) -> DataFrame:
    names = corridors.select("Corridor").distinct().withColumn("folded", F.lower("Corridor"))
    return (names.groupBy("folded").agg(F.array_sort(F.collect_set("Corridor")).alias("spellings"))
            .where(F.size("spellings") > 1))


def camera_config(cameras: DataFrame, corridors: DataFrame) -> DataFrame:
    """Included cameras with the hierarchy of the signal they stand at."""
    if "Include" in cameras.columns:
        cameras = cameras.where(F.col("Include"))
    tree = corridors.select("SignalID", "Zone_Group", "Zone", "Corridor", "Subcorridor").distinct()
    return cameras.join(tree, "SignalID", "left")


def first_per_detector(raw: DataFrame, order: Sequence, keys=("SignalID", "Detector")) -> DataFrame:
    """One configuration row per detector, chosen by an explicit order."""
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*keys).orderBy(*order)
    return raw.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merge_daily_config(parts: Sequence[DataFrame], order: Sequence, keys=("SignalID", "Detector")) -> DataFrame:
    """Several same-day files as one configuration; earlier files win."""
    merged = None
    for rank, part in enumerate(parts):
        tagged = part.withColumn("_file", F.lit(rank))
        merged = tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
    return first_per_detector(merged, ["_file", *order], keys).drop("_file")


def recent_ped_detectors(ped_log: DataFrame, as_of: Column | str) -> DataFrame:
    """Pedestrian detectors seen since the start of the month six months before ``as_of``."""
    as_of = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    since = F.add_months(F.trunc(as_of, "month"), -6)
    return ped_log.where(F.col("Date") >= since).select("SignalID", "Detector", "CallPhase").distinct()


def latest_config(history: DataFrame, as_of: Column | str) -> DataFrame:
    """The newest dated configuration on or before a day."""
    as_of = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    upto = history.where(F.col("Date") <= as_of)
    return upto.where(F.col("Date") == upto.select(F.max("Date")).scalar())


def _at_minimum(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    least = F.min(by).over(Window.partitionBy(*keys))
    return df.withColumn("_least", least).where(F.col(by) == F.col("_least")).drop("_least")


def _config_keys(config: DataFrame) -> list[str]:
    return (["Date"] if "Date" in config.columns else []) + ["SignalID", "CallPhase"]


def aog_detectors(config: DataFrame) -> DataFrame:
    """Per phase the detectors best suited to arrivals: exit first, then advanced count."""
    kind = F.col("DetectionTypeDesc")
    rank = F.when(kind.rlike("Exit"), 0).when(kind.rlike("Advanced Count"), 1)
    ranked = config.withColumn("AOGPriority", rank).where(F.col("AOGPriority").isNotNull())
    return _at_minimum(ranked, _config_keys(config), "AOGPriority")


def qs_detectors(config: DataFrame, bad_detectors: DataFrame | None = None) -> DataFrame:
    """Setback detectors with a known distance that are not bad that day."""
    out = config.where(F.col("DetectionTypeDesc").rlike("Advanced Count|Advanced Speed")
                       & F.col("DistanceFromStopBar").isNotNull())
    return without_bad(out, bad_detectors)


def without_bad(config: DataFrame, bad_detectors: DataFrame | None) -> DataFrame:
    if bad_detectors is None:
        return config
    keys = [k for k in ("Date", "SignalID", "Detector") if k in config.columns and k in bad_detectors.columns]
    return config.join(bad_detectors.select(*keys), keys, "left_anti")


def sf_detectors(config: DataFrame) -> DataFrame:
    return config.where(F.col("DetectionTypeDesc").rlike("Stop Bar Presence"))


def volume_detectors(config: DataFrame) -> DataFrame:
    """Detectors at the lowest count priority of their phase."""
    keys = _config_keys(config)
    least = F.min("CountPriority").over(Window.partitionBy(*keys))
    return config.withColumn("minCountPriority", least).where(F.col("CountPriority") == F.col("minCountPriority"))


def count_detectors(config: DataFrame, bad_detectors: DataFrame | None) -> DataFrame:
    """Good detectors, flagged where they are the ones to count volume with."""
    good = without_bad(config, bad_detectors)
    least = F.min("CountPriority").over(Window.partitionBy(*_config_keys(good)))
    return good.withColumn("CountDetector", F.coalesce(F.col("CountPriority") == least, F.lit(False)))


def subcorridors_as_corridors(corridors: DataFrame) -> DataFrame:
    """The hierarchy one level down: corridors become zones and subcorridors become corridors."""
    return (corridors.where(F.col("Subcorridor").isNotNull())
            .drop("Zone_Group")
            .withColumnsRenamed({"Zone": "Zone_Group", "Corridor": "Zone", "Subcorridor": "Corridor"}))


def channel_phase_mapping(events: DataFrame, channel_code: int = 82, phase_code: int = 43,
                          lead_seconds: float = 0.1) -> DataFrame:
    """Detector to phase pairs mined from calls that follow a detector by exactly one clock tick.

    A call counts only where its instant holds one call and one detection, so both sides are
    reduced to such instants before they meet; no instant can fan out.
    """
    from greenwave.functions.timeparts import add_seconds

    def alone(df, name):
        return (df.groupBy("SignalID", "Timestamp")
                .agg(F.min("EventParam").alias(name), F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n"))

    detections = events.where(F.col("EventCode") == channel_code).select("SignalID", "Timestamp", "EventParam")
    calls = events.where(F.col("EventCode") == phase_code).select(
        "SignalID", add_seconds("Timestamp", -lead_seconds).alias("Timestamp"), "EventParam")
    pairs = alone(detections, "Detector").join(alone(calls, "CallPhase"), ["SignalID", "Timestamp"])
    return pairs.select("SignalID", "Detector", "CallPhase").distinct()
