"""Event pairing, cycles and signal timing metrics.

Work is keyed by signal and day (and phase or detector), as one day is the unit the metrics are
defined on; within a day the order-dependent steps run in hourly groups (see functions.ordered).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.grid import minute_step
from greenwave.functions.ordered import asof, carry
from greenwave.functions.ranges import overlap_join
from greenwave.functions.stats import nth_largest, ratio, wmean, with_delta, with_share  # noqa: F401
from greenwave.session import cut_lineage

GREEN, YELLOW, RED = 1, 8, 9  # controller event codes: phase green / yellow / red start
BARRIER, TERMINATIONS = 31, (4, 5, 6)
DETECTOR_OFF, DETECTOR_ON = 81, 82
PHASE_KEYS = ("SignalID", "date", "EventParam")


def event_pairs(events: DataFrame, pairs: Sequence[tuple[int, int]], keys: Sequence[str] = PHASE_KEYS, also: Sequence[str] = ()) -> DataFrame:
    """For every start code followed by its end code: start, earliest end and duration in seconds.

    All code pairs are found in one pass.  A start repeated before an end is dropped; a pair of equal
    codes uses the next strictly later event.  ``also`` names columns of the start event to keep.
    """
    codes = sorted({c for p in pairs for c in p})
    rows = events.where(F.col("EventCode").isin(*codes)).select(*keys, "Timestamp", "EventCode", *also).distinct()
    start = F.struct(F.col("Timestamp").alias("ts"), *also)
    mark = lambda c: F.when(F.col("EventCode") == c, start)
    cross = [p for p in pairs if p[0] != p[1]]
    parts = []
    if cross:
        seen = carry(rows, keys, "Timestamp", {f"_s{a}": mark(a) for a in sorted({a for a, _ in cross})}, peers=True)
        made = [F.when(F.col("EventCode") == b, F.struct(F.lit(a).alias("code"), F.col(f"_s{a}").alias("start")))
                for a, b in cross]
        parts.append(seen.withColumn("_p", F.explode(F.array_compact(F.array(*made)))))
    for a, b in pairs:
        if a == b:
            same = carry(rows.where(F.col("EventCode") == a), keys, "Timestamp", {"_s": start}, inclusive=False)
            parts.append(same.withColumn("_p", F.struct(F.lit(a).alias("code"), F.col("_s").alias("start"))))
    found = None
    for part in parts:
        part = part.select(*keys, F.col("_p.code").alias("EventCode"), F.col("_p.start.ts").alias("StartTimeStamp"),
                           *[F.col(f"_p.start.{c}").alias(c) for c in also], "Timestamp")
        found = part if found is None else found.unionByName(part)
    out = found.where("StartTimeStamp is not null").groupBy(*keys, "EventCode", "StartTimeStamp", *also).agg(
        F.min("Timestamp").alias("EndTimeStamp"))
    return out.withColumn("Duration", tp.seconds_between("StartTimeStamp", "EndTimeStamp"))


def phase_intervals(events: DataFrame) -> DataFrame:
    """Green, yellow and red intervals."""
    return event_pairs(events, ((GREEN, YELLOW), (YELLOW, RED), (RED, GREEN)))


def phase_cycles(events: DataFrame) -> DataFrame:
    """Green start to the next green start."""
    return event_pairs(events, ((GREEN, GREEN),))


def assign_cycle(intervals: DataFrame, events: DataFrame) -> DataFrame:
    """The cycle (barrier of ring 1) each interval starts in; intervals before the first are dropped."""
    starts = events.where((F.col("EventCode") == BARRIER) & (F.col("EventParam") == 1)).select(
        "SignalID", "date", F.col("Timestamp").alias("CycleStart")).distinct()
    out = asof(intervals, starts, ["SignalID", "date"], "StartTimeStamp", "CycleStart", ["CycleStart"])
    return out.where("CycleStart is not null").withColumn(
        "TimeInCycle", tp.seconds_between("CycleStart", "StartTimeStamp")).withColumnRenamed("EventParam", "Phase")


def intervals_in_cycle(events: DataFrame) -> DataFrame:
    """``assign_cycle`` of ``phase_intervals``, with one read of the events.

    The barriers go through the same layout as the phase events: each of these gets the latest barrier of its signal and
    day, and an interval takes over that of the event it starts with.
    """
    barrier = (F.col("EventCode") == BARRIER) & (F.col("EventParam") == 1)
    rows = events.where(barrier | F.col("EventCode").isin(GREEN, YELLOW, RED)).select(*PHASE_KEYS, "Timestamp", "EventCode")
    rows = carry(rows, ["SignalID", "date"], "Timestamp", {"CycleStart": F.when(barrier, F.col("Timestamp"))}, peers=True)
    out = event_pairs(rows, ((GREEN, YELLOW), (YELLOW, RED), (RED, GREEN)), also=["CycleStart"]).where("CycleStart is not null")
    return out.withColumn("TimeInCycle", tp.seconds_between("CycleStart", "StartTimeStamp")).withColumnRenamed("EventParam", "Phase")


def detector_pairs(events: DataFrame, config: DataFrame) -> DataFrame:
    """Detector on/off pairs with their phase, moved by the travel time from the stop bar."""
    pairs = event_pairs(events, ((DETECTOR_ON, DETECTOR_OFF),)).withColumnRenamed("EventParam", "Detector")
    conf = config.where(F.col("CallPhase").isNotNull() & F.col("CountDetector").isNotNull()).select(
        "SignalID", "Detector", F.col("CallPhase").alias("Phase"), "CountDetector",
        F.coalesce("TimeFromStopBar", F.lit(0.0)).alias("_shift"))
    return pairs.join(conf, ["SignalID", "Detector"]).select(
        "SignalID", "date", "Phase", "Detector", "CountDetector",
        tp.add_seconds("StartTimeStamp", F.col("_shift")).alias("DetTimeStamp"), F.col("Duration").alias("DetDuration"))


def detections_by_interval(intervals: DataFrame, detections: DataFrame) -> DataFrame:
    """Each detection with the phase interval and cycle it falls in."""
    marks = intervals.select("SignalID", "date", "Phase", F.col("StartTimeStamp").alias("PhaseStart"), "CycleStart",
                             "EventCode")
    out = asof(detections, marks, ["SignalID", "date", "Phase"], "DetTimeStamp", "PhaseStart",
               ["PhaseStart", "CycleStart", "EventCode"])
    return out.where("PhaseStart is not null").withColumns({
        "DetTimeInCycle": tp.seconds_between("CycleStart", "DetTimeStamp"),
        "DetTimeInPhase": tp.seconds_between("PhaseStart", "DetTimeStamp")})


def event_etl(events: DataFrame, config: DataFrame, keep=cut_lineage) -> tuple[DataFrame, DataFrame]:
    """Phase intervals with volume and termination type, and detections within them.

    ``keep`` stores the two intermediate tables that several later jobs read (a checkpoint in the cluster's shared
    folder).  None is needed: with ``lambda df: df`` a single job still reads the events once for intervals, once for detections
    and once for terminations.
    """
    intervals = keep(intervals_in_cycle(events))
    found = keep(detections_by_interval(intervals, detector_pairs(events, config)))
    volume = found.where("CountDetector").groupBy("SignalID", "date", "Phase", "EventCode", "PhaseStart").agg(
        F.count(F.lit(1)).alias("Volume"))
    ends = events.where(F.col("EventCode").isin(*TERMINATIONS)).select(
        "SignalID", F.col("EventParam").alias("Phase"), F.col("Timestamp").alias("PhaseEnd"),
        F.col("EventCode").alias("TermType")).distinct()
    gyr = intervals.withColumnsRenamed({"StartTimeStamp": "PhaseStart", "EndTimeStamp": "PhaseEnd"})
    cycles = gyr.join(volume, ["SignalID", "date", "Phase", "EventCode", "PhaseStart"], "left").join(
        ends, ["SignalID", "Phase", "PhaseEnd"], "left")
    cycles = cycles.select("SignalID", "date", "Phase", "CycleStart", "PhaseStart", "PhaseEnd", "EventCode",
                           F.coalesce("TermType", F.lit(0)).alias("TermType"), "Duration",
                           F.coalesce("Volume", F.lit(0)).alias("Volume"))
    # the stop-bar shift can push a detection past midnight; keep each day's own
    found = found.where(tp.day("DetTimeStamp") <= F.col("date"))
    return cycles, found.select("SignalID", "date", "Phase", "Detector", "CycleStart", "PhaseStart", "EventCode",
                                "DetTimeStamp", "DetDuration", "DetTimeInCycle", "DetTimeInPhase")


# ---- arrivals on green ------------------------------------------------------
def arrivals_on_green(detections: DataFrame, good_config: DataFrame, unit: str = "1 hour") -> DataFrame:
    """Share of arrivals on green, and its ratio to the share of green time, per phase and period.

    Period boundaries are added to each phase's day and take the interval running at that time, so
    no interval crosses a period.  A period's last row therefore ends at the next boundary.
    """
    minutes = tp.UNIT_MINUTES.get(unit) or int(unit.split()[0])
    conf = good_config.where(F.col("DetectionTypeDesc").contains("Advanced Count"))
    keys = [k for k in ("date", "SignalID", "Detector") if k in conf.columns]
    det = detections.distinct().join(conf.select(*keys).distinct(), keys, "left_semi")
    arrivals = det.groupBy("SignalID", "Phase", tp.floor_period("DetTimeStamp", unit).alias("Hour")).agg(
        F.count_if(F.col("EventCode") == GREEN).alias("_green"), F.count(F.lit(1)).alias("vol")).where("_green > 0")

    starts = det.select("SignalID", "date", "Phase", F.col("PhaseStart").alias("ts"), "EventCode").distinct()
    day0 = tp.ntz("date")
    step = minute_step(minutes)
    edges = starts.select("SignalID", "date", "Phase").distinct().withColumn("ts", F.explode(F.sequence(
        day0, (day0 + tp.day_interval(days=1) - step).cast("timestamp_ntz"), step))).withColumn("EventCode", F.lit(None).cast("int"))
    phase_day = ["SignalID", "date", "Phase"]
    rows = starts.unionByName(edges)
    rows = carry(rows, phase_day, "ts", {"Interval": F.col("EventCode")}, order=[F.col("EventCode").isNull()],
                 bucket_minutes=minutes)
    rows = rows.withColumn("Hour", tp.floor_minutes("ts", minutes))
    inside = F.lead("ts").over(Window.partitionBy(*phase_day, "Hour").orderBy("ts", F.col("EventCode").isNull()))
    last_of_day = F.col("Hour") + step >= day0 + tp.day_interval(days=1)
    end = F.coalesce(inside, F.when(~last_of_day, (F.col("Hour") + step).cast("timestamp_ntz")))
    rows = rows.withColumn("_sec", F.coalesce(tp.seconds_between("ts", end), F.lit(0.0))).where("Interval is not null")
    green = rows.groupBy("SignalID", "Phase", "Hour").agg(
        F.sum(F.when(F.col("Interval") == GREEN, F.col("_sec"))).alias("_g"), F.sum("_sec").alias("_all")).where("_g is not null")
    out = arrivals.join(green, ["SignalID", "Phase", "Hour"])
    aog, gc = ratio("_green", "vol"), ratio("_g", "_all")
    return out.select("SignalID", F.col("Phase").alias("CallPhase"), F.col("Hour").alias("Date_Hour"),
                      aog.alias("aog"), F.try_divide(aog, gc).alias("pr"), "vol")


def arrivals_by_color(wide: DataFrame, unit: str = "1 hour") -> DataFrame:
    """Vehicles and their share by interval colour, from the wide event table."""
    color = (F.when(F.col("Interval") == 1, "Green").when(F.col("Interval") == 8, "Yellow")
             .when(F.col("Interval") == 10, "Red").otherwise(F.col("Interval").cast("string")))
    keys = ["SignalID", "Timeperiod", "Phase"]
    rows = wide.where(F.col("DetectorOff").isNotNull() & F.col("Phase").isNotNull() & F.col("Interval").isNotNull())
    counted = rows.groupBy("SignalID", tp.floor_period("Timestamp", unit).alias("Timeperiod"), "Phase",
                           color.alias("Interval")).agg(F.count("Detector").alias("Vehicles"))
    return with_share(counted, keys, "Vehicles", "Percent")


# ---- occupancy, split failures, spillback -----------------------------------
def occupancy(detections: DataFrame, intervals: DataFrame) -> DataFrame:
    """Largest detector occupancy per cycle; cycles without detections have 0.

    detections: SignalID, Phase, Detector, DetOn, DetOff; intervals: SignalID, Phase, CycleStart,
    IntervalStart, IntervalEnd.
    """
    cycle = ["SignalID", "Phase", "CycleStart"]
    hits = overlap_join(detections, intervals, ["SignalID", "Phase"], ("DetOn", "DetOff"), ("IntervalStart", "IntervalEnd"))
    shared = tp.seconds_between(F.greatest("DetOn", "IntervalStart"), F.least("DetOff", "IntervalEnd"))
    per_det = hits.groupBy(*cycle, "Detector").agg(
        ratio(F.sum(shared), F.max(tp.seconds_between("IntervalStart", "IntervalEnd"))).alias("occ"))
    best = per_det.groupBy(*cycle).agg(F.max("occ").alias("occ"))
    return intervals.select(*cycle).distinct().join(best, cycle, "left").withColumn("occ", F.coalesce("occ", F.lit(0.0)))


def split_failures_by_cycle(detections: DataFrame, cycles: DataFrame, config: DataFrame,
                            first_seconds_of_red: float = 5, threshold: float = 0.80,
                            phases: Sequence[int] = (3, 4, 7, 8)) -> DataFrame:
    """Cycles whose stop-bar occupancy passes the threshold both on green and at the start of red.

    Phase 0 rows say whether any phase failed.
    """
    from greenwave.operators.config import sf_detectors

    conf = sf_detectors(config).where(F.col("TimeFromStopBar").isNotNull())
    keys = [k for k in ("date", "SignalID", "Phase", "Detector") if k in conf.columns or k == "Phase"]
    conf = conf.withColumn("Phase", F.col("CallPhase")).select(*keys).distinct()
    det = detections.where(F.col("Phase").isin(*phases)).join(conf, keys, "left_semi").select(
        "SignalID", "Phase", "Detector", F.col("DetTimeStamp").alias("DetOn"),
        tp.add_seconds("DetTimeStamp", F.col("DetDuration")).alias("DetOff"))
    cyc = cycles.where(F.col("Phase").isin(*phases)).select("SignalID", "Phase", "CycleStart", "PhaseStart", "PhaseEnd", "EventCode")
    green = cyc.where(F.col("EventCode") == GREEN).select(
        "SignalID", "Phase", "CycleStart", F.col("PhaseStart").alias("IntervalStart"), F.col("PhaseEnd").alias("IntervalEnd"))
    red = cyc.where(F.col("EventCode") == RED).select(
        "SignalID", "Phase", "CycleStart", F.col("PhaseStart").alias("IntervalStart"),
        tp.add_seconds("PhaseStart", first_seconds_of_red).alias("IntervalEnd"))
    keys = ["SignalID", "Phase", "CycleStart"]
    both = occupancy(det, green).withColumnRenamed("occ", "gr_occ").join(
        occupancy(det, red).withColumnRenamed("occ", "sr_occ"), keys, "full").na.fill({"gr_occ": 0.0, "sr_occ": 0.0})
    sf = both.withColumn("sf", ((F.col("gr_occ") > threshold) & (F.col("sr_occ") > threshold)).cast("int"))
    any_phase = sf.groupBy("SignalID", F.lit(0).alias("Phase"), "CycleStart").agg(F.max("sf").alias("sf"))
    return sf.unionByName(any_phase, allowMissingColumns=True)


def split_failures(sf: DataFrame, unit: str = "1 hour") -> DataFrame:
    out = sf.groupBy("SignalID", F.col("Phase").alias("CallPhase"), tp.floor_period("CycleStart", unit).alias("Date_Hour")).agg(
        F.sum("sf").cast("int").alias("sf"), F.count(F.lit(1)).alias("cycles"))
    return out.withColumns({"Date": tp.day("Date_Hour"), "DOW": tp.dow("Date_Hour"), "Week": tp.week_index("Date_Hour"),
                            "sf_freq": ratio("sf", "cycles")})


def peak_split_failures(sf: DataFrame, ts: str = "Date_Hour") -> dict[str, DataFrame]:
    """Split-failure share weighted by cycles, for peak and off-peak hours of each day."""
    def part(cond):
        return sf.where(cond).groupBy("SignalID", tp.day(ts).alias("Period")).agg(
            wmean("sf_freq", "cycles").alias("sf_freq"), F.sum("cycles").alias("cycles"))

    return {"peak": part(tp.is_peak(ts)), "off_peak": part(~tp.is_peak(ts))}


def spillback_by_cycle(detections: DataFrame, config: DataFrame, bad_detectors: DataFrame | None = None) -> DataFrame:
    """95th percentile detector-on time per setback detector and cycle; the longest detector counts."""
    from greenwave.operators.config import qs_detectors

    conf = qs_detectors(config, bad_detectors).where(F.col("TimeFromStopBar").isNotNull())
    keys = [k for k in ("date", "SignalID", "Phase", "Detector") if k in conf.columns or k == "Phase"]
    conf = conf.withColumn("Phase", F.col("CallPhase")).select(*keys).distinct()
    det = detections.join(conf, keys, "left_semi")
    per_det = det.groupBy("SignalID", "date", "Phase", "CycleStart", "Detector").agg(
        F.percentile("DetDuration", 0.95).alias("occ"))  # one detector in one cycle: a few rows
    return per_det.groupBy("SignalID", "date", "Phase", "CycleStart").agg(F.max("occ").alias("occ"))


def queue_spillback(by_cycle: DataFrame, unit: str = "1 hour", seconds: float = 3) -> DataFrame:
    out = by_cycle.groupBy("SignalID", F.col("Phase").alias("CallPhase"), F.col("date").alias("Date"),
                           tp.floor_period("CycleStart", unit).alias("Date_Hour")).agg(
        F.count_if(F.col("occ") > seconds).cast("int").alias("qs"), F.count(F.lit(1)).cast("int").alias("cycles"))
    return out.withColumns({"DOW": tp.dow("Date"), "Week": tp.week_index("Date"), "qs_freq": ratio("qs", "cycles")})


# ---- pedestrian delay -------------------------------------------------------
PED_CALL, WALK, CLEARANCE, CYCLE_LENGTH = 45, 21, 22, 132


def ped_delay(events: DataFrame, max_free_delay: float = 300) -> DataFrame:
    """Mean pedestrian delay per signal and day.

    A signal that ran a cycle length that day is coordinated: clearance to next walk, no longer than
    the cycle, while the running cycle length is above zero; event-weighted over phases.  Otherwise it
    is free: call to walk, up to five minutes.
    """
    day_keys = ["SignalID", "date"]
    pe = events.where(F.col("EventCode").isin(PED_CALL, WALK, CLEARANCE, CYCLE_LENGTH)).select(
        *day_keys, "Timestamp", "EventCode", "EventParam")
    length = F.when(F.col("EventCode") == CYCLE_LENGTH, F.col("EventParam"))
    kind = pe.groupBy(*day_keys).agg((F.coalesce(F.max(length), F.lit(0)) > 0).alias("coordinated"))
    pe = carry(pe, day_keys, "Timestamp", {"CycleLength": length}, order=["EventCode", "EventParam"])
    pe = pe.where(F.col("EventCode") != CYCLE_LENGTH).join(kind, day_keys)
    pe = pe.where(~F.col("coordinated") | (F.coalesce("CycleLength", F.lit(0)) > 0))
    nxt = F.struct(F.col("EventCode").alias("code"), F.col("Timestamp").alias("ts"))
    pe = carry(pe, [*day_keys, "EventParam"], "Timestamp", {"_n": nxt}, order=["EventCode"], backward=True, inclusive=False)
    delay = tp.seconds_between("Timestamp", "_n.ts")
    free = ~F.col("coordinated") & (F.col("EventCode") == PED_CALL) & (F.col("_n.code") == WALK) & (delay <= max_free_delay)
    coord = F.col("coordinated") & (F.col("EventCode") == CLEARANCE) & (F.col("_n.code") == WALK) & (delay <= F.col("CycleLength"))
    kept = pe.withColumn("Delay", delay).where(free | coord)
    # an event-weighted mean of phase means is the mean over events
    return kept.groupBy("SignalID", F.col("date").alias("Date"),
                        F.when(F.col("coordinated"), "Coordinated").otherwise("Free").alias("Pattern")).agg(
        F.avg("Delay").alias("Avg_Max_Ped_Delay"), F.count(F.lit(1)).alias("Events"))


# ---- flash and coordination state -------------------------------------------
def flash_events(events: DataFrame) -> DataFrame:
    """Changes of flash status with the time to the next change; undetermined statuses are dropped."""
    keys = ["SignalID", "date"]
    rows = events.where(F.col("EventCode") == 173).select(*keys, "Timestamp", "EventParam")
    rows = carry(rows, keys, "Timestamp", {"_before": F.col("EventParam")}, order=["EventParam"], inclusive=False)
    changes = rows.where(~F.col("EventParam").eqNullSafe(F.col("_before"))).drop("_before")
    nxt = F.struct(F.col("Timestamp").alias("ts"), F.col("EventParam").alias("param"))
    changes = carry(changes, keys, "Timestamp", {"_n": nxt}, order=["EventParam"], backward=True, inclusive=False)
    return changes.where(~F.col("EventParam").isin(2, 3, 4)).select(
        "SignalID", F.col("date").alias("Date"), F.col("Timestamp").alias("TimeStamp"), "EventParam",
        tp.seconds_between("Timestamp", "_n.ts").alias("FlashDuration"),
        F.coalesce("_n.param", F.lit(0)).alias("EndParam"))


def monthly_flash_count(flash: DataFrame) -> DataFrame:
    from greenwave.operators.rollup import monthly_avg_by_day

    month = flash.groupBy("SignalID", tp.month_start("Date").alias("Date")).agg(
        F.count(F.lit(1)).cast("double").alias("flash"))
    return monthly_avg_by_day(month.withColumn("CallPhase", F.lit(0)), "flash")


def time_in_state(wide: DataFrame, state: str = "CoordState") -> DataFrame:
    """Seconds a signal spent in each state per day; the last state closes at midnight.

    Each row's time lasts to the next row of its signal-day, so contiguous rows of a state add up.
    """
    rows = wide.select("SignalID", tp.day("Timestamp").alias("Date"), "Timestamp",
                       F.coalesce(F.col(state).cast("int"), F.lit(-1)).alias(state)).distinct()
    rows = carry(rows, ["SignalID", "Date"], "Timestamp", {"_next": F.col("Timestamp")}, order=[state], backward=True, inclusive=False)
    end = F.coalesce("_next", (tp.ntz("Date") + tp.day_interval(days=1)).cast("timestamp_ntz"))
    return rows.groupBy("SignalID", "Date", state).agg(F.sum(tp.seconds_between("Timestamp", end)).alias("duration"))


def state_sessions(rows: DataFrame, state: str, keys: Sequence[str] = ("SignalID", "Date")) -> DataFrame:
    """Contiguous runs of a state with start, end and duration."""
    before = F.struct(F.col(state).alias("s"))
    rows = carry(rows, keys, "Timestamp", {"_before": before}, order=[state], inclusive=False)
    first = F.col("_before").isNull() | ~F.col("_before.s").eqNullSafe(F.col(state))
    starts = rows.where(first).select(*keys, "Timestamp", state)
    starts = carry(starts, keys, "Timestamp", {"_next": F.col("Timestamp")}, order=[state], backward=True, inclusive=False)
    end = F.coalesce("_next", (tp.ntz("Date") + tp.day_interval(days=1)).cast("timestamp_ntz"))
    return starts.select(*keys, state, F.col("Timestamp").alias("start"), end.alias("end"),
                         tp.seconds_between("Timestamp", end).alias("duration"))
