"""Ramp meters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.ordered import carry

KM_PER_MILE = 1.609344
# fixed controller event codes
RATE, ACTIVE, VOLUME, OCCUPANCY, SPEED = 1058, 1013, 1371, 1372, 1373


def ramp_slice(events: DataFrame, halves=("AM", "PM")) -> DataFrame:
    """Ramp-meter events with the half of the day."""
    rows = events.where(F.col("EventCode") >= 1000).select(
        "SignalID", "Timestamp", "EventCode", "EventParam", tp.day("Timestamp").alias("date"),
        F.when(F.hour("Timestamp") < 12, "AM").otherwise("PM").alias("per"))
    return rows.where(F.col("per").isin(*halves))


def _for_signals(rows: DataFrame, signals: DataFrame | None) -> DataFrame:
    return rows if signals is None else rows.join(signals, "SignalID", "right")


def _ends(rows: DataFrame, order) -> DataFrame:
    return carry(rows, ["SignalID", "date"], "Timestamp", {"Timestamp2": F.col("Timestamp")}, order=order,
                 backward=True, inclusive=False)


def flush_events(events: DataFrame, signals: DataFrame | None = None) -> DataFrame:
    rows = events.where((F.col("EventCode") == RATE) & (F.col("EventParam") == 0)).select("SignalID", "date", "Timestamp", "per")
    return _for_signals(rows, signals)


def metering_rates(events: DataFrame, signals: DataFrame | None = None) -> DataFrame:
    """Intervals of a metering rate, each up to the next rate or activation event."""
    rows = events.where((F.col("EventCode") == RATE) | ((F.col("EventCode") == ACTIVE) & (F.col("EventParam") == 1)))
    rows = rows.select("SignalID", "date", "Timestamp", "per", "EventCode", F.col("EventParam").alias("rate"))
    rows = _ends(rows, ["EventCode", "rate"]).where((F.col("EventCode") == RATE) & (F.col("rate") > 0))
    return _for_signals(rows, signals)


def mainline_traffic(events: DataFrame, signals: DataFrame | None = None) -> DataFrame:
    """Volume, occupancy (%) and speed (mph) reported at one time."""
    rows = events.where(F.col("EventCode").isin(VOLUME, OCCUPANCY, SPEED))
    wide = rows.groupBy("SignalID", "date", "Timestamp", "per").pivot("EventCode", [VOLUME, OCCUPANCY, SPEED]).agg(F.min("EventParam"))
    wide = wide.withColumnsRenamed({str(VOLUME): "vol", str(OCCUPANCY): "occ", str(SPEED): "spd"})
    wide = wide.where(F.col("vol").isNotNull() & (F.col("spd") > 0)).withColumns(
        {"spd": F.col("spd").cast("double") / KM_PER_MILE, "occ": F.col("occ").cast("double") / 10})
    return _for_signals(wide, signals)


def traffic_intervals(traffic: DataFrame, measure: str) -> DataFrame:
    """Rows with a value of vol, occ or spd, each up to the next such row of the day."""
    return _ends(traffic.where(F.col(measure).isNotNull()), [measure])


def traffic_by_rate(events: DataFrame) -> DataFrame:
    """Flow, occupancy and speed with the metering rate in force (NULL when 0 or none yet).

    Rates and traffic go through one layout, with one read of the events: a rate holds from the row of its
    own time on; of several at one time the highest counts.
    """
    value = F.when(F.col("EventCode") == SPEED, F.nullif(F.col("EventParam") / KM_PER_MILE, F.lit(0.0))).when(
        F.col("EventCode") == OCCUPANCY, F.col("EventParam") / 10.0).otherwise(F.col("EventParam").cast("double"))
    of = lambda code: F.min(F.when(F.col("EventCode") == code, value))
    wide = events.where(F.col("EventCode").isin(VOLUME, OCCUPANCY, SPEED, RATE)).groupBy("SignalID", "date", "Timestamp").agg(
        of(VOLUME).alias("avg_flow_rate"), of(OCCUPANCY).alias("avg_occ"), of(SPEED).alias("avg_speed"),
        F.max(F.when(F.col("EventCode") == RATE, F.col("EventParam"))).alias("metering_rate"), F.count_if(F.col("EventCode") != RATE).alias("_traffic"))
    out = carry(wide, ["SignalID", "date"], "Timestamp", {"metering_rate": F.col("metering_rate")}).where("_traffic > 0").drop("_traffic")
    return out.withColumn("metering_rate", F.nullif("metering_rate", F.lit(0)))
