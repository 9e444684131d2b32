"""Counts, count quality, gap filling and volume."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.grid import densify, day_step, minute_step
from greenwave.functions.layout import laid_out
from greenwave.functions.ordered import streak_length
from greenwave.functions.stats import ratio, total, weighted_percentile, with_delta
from greenwave.session import cut_lineage

VEHICLE_CODE, PED_CODE = 82, 90  # controller event codes: detector on, pedestrian input on
POLL_CODE, ANSWER_CODE = 502, 503  # and of the poll log: share of failed polls, response time


# ---- raw counts -------------------------------------------------------------
def raw_counts(events: DataFrame, code: int = VEHICLE_CODE, unit: str = "1 hour") -> DataFrame:
    """Distinct events of a code per signal, detector and period."""
    hits = events.where(F.col("EventCode") == code).select("SignalID", "Timestamp", "EventParam").distinct()
    return hits.groupBy("SignalID", tp.floor_period("Timestamp", unit).alias("Timeperiod"),
                        F.col("EventParam").alias("Detector")).agg(F.count(F.lit(1)).alias("vol"))


def counts_by_phase(events: DataFrame, config: DataFrame, code: int = VEHICLE_CODE, unit: str = "1 hour",
                    midweek_only: bool = False) -> DataFrame:
    """Counts with the phase each detector calls (NULL where the detector is not configured)."""
    if midweek_only:
        events = events.where(tp.midweek("Timestamp"))
    counted = raw_counts(events, code, unit)
    phases = config.select("SignalID", "Detector", "CallPhase")
    return counted.join(phases, ["SignalID", "Detector"], "left").select(
        "SignalID", "Timeperiod", "Detector", "CallPhase", "vol")


def hourly_grid_counts(counts: DataFrame, unit_minutes: int = 60) -> DataFrame:
    """Counts with zero rows for every missing period of a detector's first to last day."""
    keys = [c for c in ("SignalID", "Detector", "CallPhase") if c in counts.columns]
    span = counts.select(F.struct(F.min("Timeperiod").cast("date").cast("timestamp_ntz").alias("lo"),
                                  (F.max("Timeperiod").cast("date").cast("timestamp_ntz")
                                   + tp.day_interval(days=1)).alias("hi"))).scalar()
    step = minute_step(unit_minutes)
    return densify(counts, keys, "Timeperiod", span["lo"], span["hi"] - step, step, {"vol": 0})


# ---- communications ---------------------------------------------------------
def comm_uptime(events: DataFrame, period: Column | None = None) -> DataFrame:
    """Share of polls that succeeded and mean response time by signal and day."""
    e = events.where(F.col("EventCode").isin(502, 503)).select(
        "SignalID", "Timestamp", "EventCode", "EventParam").distinct()
    poll, answer = F.col("EventCode") == 502, F.col("EventCode") == 503
    out = e.groupBy("SignalID", tp.day("Timestamp").alias("Date")).agg(
        ratio(F.count_if(poll & (F.col("EventParam") < 100)), F.count_if(poll & (F.col("EventParam") > -1))).alias("uptime"),
        F.avg(F.when(answer, F.col("EventParam"))).alias("response_ms"))
    return _with_calendar(out)


def _with_calendar(daily: DataFrame) -> DataFrame:
    return daily.select("SignalID", F.lit(0).alias("CallPhase"), "Date", tp.ntz("Date").alias("Date_Hour"),
                        tp.dow("Date").alias("DOW"), tp.week_index("Date").alias("Week"), "uptime", "response_ms")


def comm_uptime_by_period(wide_events: DataFrame, unit: str) -> DataFrame:
    """The same share for any interval, straight from the event rows."""
    poll = F.col("EventCode") == 502
    return (wide_events.where(F.col("EventCode").isin(502, 503))
            .groupBy("SignalID", tp.floor_period("Timestamp", unit).alias("Timeperiod"))
            .agg(F.count_if(poll & (F.col("EventParam") < 100)).alias("successes"),
                 F.count_if(poll & (F.col("EventParam") >= 0)).alias("attempts"),
                 F.avg(F.when(F.col("EventCode") == 503, F.col("EventParam"))).alias("response_ms"))
            .select("SignalID", F.lit(0).alias("CallPhase"), "Timeperiod",
                    F.when(F.col("successes") > 0, ratio("successes", "attempts")).alias("uptime"), "response_ms"))


def gap_uptime(events: DataFrame, max_gap_minutes: int = 15, by_signal: bool = True) -> DataFrame:
    """Share of each day without event gaps over the limit, per signal or for the whole system.

    Events are first reduced to distinct minutes (at most 1440 rows per signal and day, and per day
    for the system), with one extra row at the first day's start and the last day's end.
    """
    minute = F.date_trunc("minute", "Timestamp").cast("timestamp_ntz")
    seen = events.select("SignalID", minute.alias("Timestamp")).distinct()
    span = events.select(F.struct(
        F.min("Timestamp").cast("date").cast("timestamp_ntz").alias("lo"),
        (F.max("Timestamp").cast("date").cast("timestamp_ntz") + tp.day_interval(hours=23, minutes=59)).alias("hi"))).scalar()
    ends = seen.select("SignalID").distinct().select("SignalID", F.explode(F.array(span["lo"], span["hi"])).alias("Timestamp"))
    rows = seen.unionByName(ends).distinct()
    if not by_signal:
        rows = rows.select("Timestamp").distinct().withColumn("SignalID", F.lit(0))
    rows = rows.withColumn("Date", tp.day("Timestamp"))
    w = Window.partitionBy("SignalID", "Date").orderBy("Timestamp")
    gap = tp.seconds_between(F.lag("Timestamp").over(w), "Timestamp") / 60
    rows = rows.withColumn("span", gap).where("span is not null")
    lost = F.sum(F.when(F.col("span") > max_gap_minutes, F.col("span")).otherwise(0.0))
    out = rows.groupBy("SignalID", "Date").agg((1 - lost / 1440).alias("uptime" if by_signal else "uptime_all"))
    return out if by_signal else out.drop("SignalID")


# ---- count quality ----------------------------------------------------------
@dataclass(frozen=True)
class Limits:
    """Thresholds of the daily count checks (fixed values per interval)."""
    minutes: int
    max_volume: int
    max_volume_mainline: int
    max_delta: int
    max_delta_mainline: int
    max_flat: int
    high_periods: int


HOURLY = Limits(60, 1200, 3000, 200, 500, 5, 5)
QUARTER_HOURLY = Limits(15, 300, 750, 50, 125, 20, 20)


DAY_KEYS = ("SignalID", "Date", "CallPhase", "Detector")


def _detectors(config: DataFrame) -> DataFrame:
    main = F.col("ApproachDesc").rlike("Mainline").cast("int")
    return config.select(*[c for c in DAY_KEYS if c in config.columns], F.coalesce(main, F.lit(0)).alias("main")).distinct()


def grid_size(counts: DataFrame, config: DataFrame, limits: Limits = HOURLY) -> tuple[int, list[date]]:
    """How many rows ``filtered_counts`` lays out and fills, and the days that have counts (the calendar bounds them)."""
    seen = counts.where(F.col("CallPhase").isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.collect_set(tp.day("Timeperiod")).alias("days")).first()
    detector_days = _detectors(config).count() * (1 if "Date" in config.columns else len(seen.days))
    return seen.rows + detector_days * (1440 // limits.minutes), sorted(seen.days)


def filtered_counts(counts: DataFrame, config: DataFrame, limits: Limits = HOURLY, by: Sequence[str] = ("SignalID", "CallPhase"),
                    size: tuple[int, list[date]] | None = None) -> DataFrame:
    """Every configured detector's day on a full period grid with its quality flags.

    Volume is NULL on bad days.  Counts and detector-days are laid out once by signal and phase (``by``); a day's periods are made
    there.  The merge, the streaks and the daily flags all reuse that layout, and so does ``adjusted_counts``.  ``size`` is
    that of ``grid_size``, where the caller has it.
    """
    day_keys = list(DAY_KEYS)
    step = minute_step(limits.minutes)
    rows, days = size or grid_size(counts, config, limits)
    counts = counts.where(F.col("CallPhase").isNotNull()).select(
        "SignalID", tp.day("Timeperiod").alias("Date"), "CallPhase", "Detector", "Timeperiod",
        F.col("vol").cast("double").alias("vol"), F.lit(None).cast("int").alias("main"))
    conf = _detectors(config)
    if "Date" not in config.columns:
        conf = conf.withColumn("Date", F.explode(F.array(*[F.lit(d) for d in days]).cast("array<date>")))
    grid = conf.withColumns({"Timeperiod": F.lit(None).cast("timestamp_ntz"), "vol": F.lit(None).cast("double")})
    both = counts.withColumn("_day", F.lit(False)).unionByName(grid.select(*counts.columns, F.lit(True).alias("_day")))
    laid = laid_out(both, by, rows)
    start = tp.ntz("Date")
    periods = F.sequence(start, (start + tp.day_interval(days=1) - step).cast("timestamp_ntz"), step)
    laid = laid.withColumn("Timeperiod", F.explode(F.when(F.col("_day"), periods).otherwise(F.array("Timeperiod"))))
    merged = laid.groupBy(*day_keys, "Timeperiod").agg(
        F.coalesce(F.sum("vol"), F.lit(0.0)).alias("vol"), F.max("main").alias("main"))

    day = Window.partitionBy(*day_keys)
    run = day.orderBy("Timeperiod")
    early = F.hour("Timeperiod") < 5
    df = merged.withColumn("delta_vol", F.col("vol") - F.lag("vol").over(run))
    df = df.withColumn("_streak_of", F.when(early, -1.0).otherwise(F.col("vol")))
    df = streak_length(df, day_keys, "Timeperiod", "_streak_of", "_len")
    df = df.withColumn("flatlined", F.when(early, 0.0).otherwise(F.col("_len").cast("double")))
    mainline = F.col("main") == 1
    known = F.col("main").isNotNull()
    df = df.withColumns({
        "mean_abs_delta": F.ceil(F.avg(F.abs("delta_vol")).over(day)).cast("int"),
        "flat_strk": F.max("flatlined").over(day).cast("int"),
        "_over_main": F.sum((F.col("vol") > limits.max_volume_mainline).cast("int")).over(day),
        "_over": F.sum((F.col("vol") > limits.max_volume).cast("int")).over(day),
        "_unknown": F.sum((~known).cast("int")).over(day)})
    # a detector-day with unknown periods has unknown volume and delta flags unless the rule holds anyway
    sure = F.col("_unknown") == 0
    maxvol = F.when(mainline, F.col("_over_main") > limits.high_periods).otherwise(F.col("_over") > limits.high_periods)
    mad = F.when(mainline, F.col("mean_abs_delta") > limits.max_delta_mainline).otherwise(
        F.col("mean_abs_delta") > limits.max_delta)
    df = df.withColumns({
        "flat_flag": (F.col("flat_strk") > limits.max_flat).cast("int"),
        "maxvol_flag": F.when(sure, maxvol.cast("int")), "mad_flag": F.when(sure, mad.cast("int"))})
    bad = (F.col("flat_flag") > 0) | (F.col("maxvol_flag") > 0) | (F.col("mad_flag") > 0)
    df = df.withColumn("Good_Day", F.when(bad, 0).when(~bad, 1))
    return df.select("SignalID", "Date", "Timeperiod", "Detector", "CallPhase",
                     F.when(F.col("Good_Day") == 1, F.col("vol")).alias("vol"), "delta_vol", "mean_abs_delta",
                     "flatlined", "flat_strk", "flat_flag", "maxvol_flag", "mad_flag", "Good_Day",
                     tp.month_hour("Timeperiod").alias("Month_Hour"), tp.january_hour("Timeperiod").alias("Hour"))


def cap_detectors(filtered: DataFrame, caps: DataFrame) -> DataFrame:
    """Fail a listed detector (SignalID, Detector, max_vol) whose volume ever passes its own maximum.

    The maximum comes from a partial aggregate, not from gathering the detector's rows.
    """
    keys = ["SignalID", "Detector"]
    peak = (filtered.join(caps.select(*keys), keys, "left_semi").groupBy(*keys)
            .agg(F.max("vol").alias("_peak"), F.count_if(F.col("vol").isNull()).alias("_gaps")))
    rule = caps.join(peak, keys, "left").select(*keys, (F.coalesce(F.col("_peak") > F.col("max_vol"), F.lit(False))).alias("_over"))
    j = filtered.join(rule, keys, "left")
    listed, over = F.col("_over").isNotNull(), F.coalesce("_over", F.lit(False))
    vol = F.when(over, F.lit(None)).otherwise(F.col("vol"))
    good = F.when(listed, vol.isNotNull().cast("int")).otherwise(F.col("Good_Day"))
    return j.withColumn("Good_Day", good).withColumn("vol", vol).drop("_over")


def adjusted_counts(filtered: DataFrame, max_estimate: float = 3000) -> DataFrame:
    """Fill the gaps of bad detectors from their siblings, then from the monthly median of the hour.

    A detector's share of its phase is that of the month, so several months may come in one call.
    Windows run over one phase's detectors in one period, a handful of rows, or over one phase's month.  All of them
    keep the layout by signal and phase that ``filtered_counts`` leaves.
    """
    phase = ["SignalID", "CallPhase"]
    phase_time = Window.partitionBy(*phase, "Timeperiod")
    df = filtered.select("SignalID", "CallPhase", "Detector", "Timeperiod", "Month_Hour",
                         tp.dow("Timeperiod").alias("DOW"), F.trunc(tp.day("Timeperiod"), "month").alias("_month"), F.col("vol").cast("double").alias("vol"))
    df = df.withColumn("_missing", F.count_if(F.col("vol").isNull()).over(phase_time))
    used = F.sum(F.when(F.col("_missing") == 0, F.col("vol")))
    shared = [*phase, "_month", "Detector"]
    df = df.withColumn("_v", used.over(Window.partitionBy(*shared)))
    named = reduce(Column.__and__, [F.col(k).isNotNull() for k in shared])  # others have no share
    df = df.withColumn("Ph_Contr", F.when(named, ratio("_v", used.over(Window.partitionBy(*phase, "_month"))))).drop("_v")
    whole = F.avg(ratio("vol", "Ph_Contr")).over(phase_time)
    endless = F.count_if((F.col("vol") > 0) & (F.col("Ph_Contr") == 0)).over(phase_time)
    df = df.withColumn("_whole", F.when(endless == 0, whole))
    df = df.withColumn("_whole", F.when(F.col("_whole") <= max_estimate, F.col("_whole")))
    df = df.withColumn("vol", F.coalesce(F.col("vol"), F.round(F.col("_whole") * F.col("Ph_Contr"), 6).cast("int").cast("double")))
    slot = ["SignalID", "CallPhase", "Detector", "DOW", "Month_Hour"]
    typical = F.percentile("vol", 0.5).over(Window.partitionBy(*slot))  # at most five weeks of one hour
    return (df.withColumn("vol", F.coalesce(F.col("vol").cast("int"), typical.cast("int")))
            .where("vol is not null").select("SignalID", "CallPhase", "Detector", "Timeperiod", "vol"))


def prepared_adjusted_counts(filtered: DataFrame, config: DataFrame) -> DataFrame:
    """Adjusted counts over the detectors that carry a phase's volume."""
    from greenwave.operators.config import volume_detectors

    keys = [k for k in ("Date", "SignalID", "CallPhase", "Detector") if k in config.columns]
    used = volume_detectors(config).where(F.col("CountPriority").isNotNull()).select(*keys).distinct()
    return adjusted_counts(filtered.join(used, keys, "left_semi"))


def detector_uptime(filtered: DataFrame) -> DataFrame:
    """One row per detector and day of the range; Good_Day is NULL on days without data."""
    rows = filtered.select("SignalID", "Detector", "Date", "Good_Day").distinct()
    span = filtered.select(F.struct(F.min("Date").alias("lo"), F.max("Date").alias("hi"))).scalar()
    return densify(rows, ["SignalID", "Detector"], "Date", span["lo"], span["hi"], day_step())


def bad_detectors(filtered: DataFrame) -> DataFrame:
    return (filtered.where(F.col("Good_Day") == 0).select("SignalID", "Detector", "Date", "Good_Day").distinct())


def daily_detector_uptime(filtered: DataFrame) -> DataFrame:
    """Share of good detectors per phase and period, without periods in which the signal saw nothing."""
    dead = Window.partitionBy("SignalID", "Timeperiod")  # one signal's detectors in one period
    live = filtered.withColumn("_all", F.coalesce(F.sum("vol").over(dead), F.lit(0.0))).where("_all <> 0")
    out = live.groupBy("SignalID", "CallPhase", "Date", F.col("Timeperiod").alias("Date_Hour")).agg(
        total("Good_Day").alias("_good"), F.count(F.lit(1)).cast("double").alias("all"))
    return out.select("SignalID", "CallPhase", "Date", "Date_Hour",
                      F.when(F.col("CallPhase").isin(2, 6), "Setback").otherwise("Presence").alias("setback"),
                      ratio("_good", "all").alias("uptime"), "all")


def avg_daily_detector_uptime(uptime: DataFrame) -> DataFrame:
    """Weighted daily uptime over all, setback (_sb) and presence (_pr) detectors in one pass."""
    from greenwave.functions.stats import wmean

    def part(cond, tag):
        u, n = F.when(cond, F.col("uptime")), F.when(cond, F.col("all"))
        return [wmean(u, n).alias(f"uptime{tag}"), F.sum(n).alias(f"all{tag}")]

    sb = F.col("setback") == "Setback"
    out = uptime.groupBy("SignalID", "Date").agg(
        *part(F.lit(True), ""), *part(sb, "_sb"), *part(~sb, "_pr"))
    return with_delta(out, ["SignalID"], "Date", "uptime")


# ---- volumes ----------------------------------------------------------------
def _mainline(counts: DataFrame, only: bool) -> DataFrame:
    return counts.where(F.col("CallPhase").isin(2, 6)) if only else counts


def daily_volume(counts: DataFrame, mainline_only: bool = True, name: str = "vpd") -> DataFrame:
    """Vehicles (or presses) per signal, phase and day."""
    d = tp.day("Timeperiod")
    out = _mainline(counts, mainline_only).groupBy("SignalID", "CallPhase", d.alias("Date")).agg(
        total("vol").cast("double").alias(name))
    return out.withColumn("Week", tp.week_index("Date")).withColumn("DOW", tp.dow("Date"))


def period_volume(counts: DataFrame, unit: str = "1 hour", mainline_only: bool = True, name: str = "vph",
                  period: str = "Timeperiod") -> DataFrame:
    """Vehicles (or presses) per signal and period, over phases."""
    per = tp.floor_period("Timeperiod", unit)
    out = _mainline(counts, mainline_only).groupBy("SignalID", per.alias(period)).agg(
        total("vol").cast("double").alias(name))
    return out.withColumn("Week", tp.week_index(period)).withColumn("DOW", tp.dow(period))


def throughput(counts_15min: DataFrame) -> DataFrame:
    """95th percentile of a day's quarter-hour totals as an hourly rate."""
    per = counts_15min.groupBy("SignalID", tp.day("Timeperiod").alias("Date"), "Timeperiod").agg(
        total("vol").cast("double").alias("v"))
    out = weighted_percentile(per, ["SignalID", "Date"], "v", 0.95, "vph")
    return out.select("SignalID", F.lit(0).alias("CallPhase"), "Date", tp.week_index("Date").alias("Week"),
                      tp.dow("Date").alias("DOW"), (F.col("vph") * 4).alias("vph"))


NIGHTLY_CODES = (VEHICLE_CODE, PED_CODE, POLL_CODE, ANSWER_CODE)


def quarter_hour_tally(events: DataFrame) -> DataFrame:
    """Distinct events per signal, code, parameter and quarter hour, for the codes of the nightly count tables.

    One scan and one shuffle of the log; every table of ``daily_count_products`` is a sum over these rows.
    """
    rows = events.where(F.col("EventCode").isin(*NIGHTLY_CODES)).select(
        "SignalID", "Timestamp", "EventCode", "EventParam").distinct()
    return rows.groupBy("SignalID", tp.floor_period("Timestamp", "15 min").alias("Timeperiod"), "EventCode", "EventParam").agg(
        F.count(F.lit(1)).alias("vol"))


def tallied_counts(tally: DataFrame, config: DataFrame, code: int, unit: str) -> DataFrame:
    """``counts_by_phase`` from the quarter-hour tally."""
    counted = tally.where(F.col("EventCode") == code).groupBy(
        "SignalID", tp.floor_period("Timeperiod", unit).alias("Timeperiod"), F.col("EventParam").alias("Detector")).agg(F.sum("vol").alias("vol"))
    return counted.join(config.select("SignalID", "Detector", "CallPhase"), ["SignalID", "Detector"], "left").select(
        "SignalID", "Timeperiod", "Detector", "CallPhase", "vol")


def tallied_comm_uptime(tally: DataFrame) -> DataFrame:
    """``comm_uptime`` from the quarter-hour tally."""
    poll, answer = F.col("EventCode") == POLL_CODE, F.col("EventCode") == ANSWER_CODE
    count = lambda cond: F.sum(F.when(cond, F.col("vol")).otherwise(F.lit(0)))
    out = tally.where(poll | answer).groupBy("SignalID", tp.day("Timeperiod").alias("Date")).agg(
        ratio(count(poll & (F.col("EventParam") < 100)), count(poll & (F.col("EventParam") > -1))).alias("uptime"),
        ratio(F.sum(F.when(answer, F.col("EventParam") * F.col("vol"))), count(answer & F.col("EventParam").isNotNull())).alias("response_ms"))
    return _with_calendar(out)


def daily_count_products(events: DataFrame, config: DataFrame, ped_config: DataFrame, keep=cut_lineage) -> dict[str, DataFrame]:
    """The nightly set of count tables from one event log, keyed by table name.

    The log is read once: ``keep`` stores its quarter-hour tally, from which all tables derive.  Pass
    ``lambda df: df`` to stay lazy where only one of the tables is wanted.
    """
    return count_products(keep(quarter_hour_tally(events)), config, ped_config)


def count_products(tally: DataFrame, config: DataFrame, ped_config: DataFrame) -> dict[str, DataFrame]:
    """The nightly set of count tables from the quarter-hour tally, also a stored one that late events were merged into."""
    hour = tallied_counts(tally, config, VEHICLE_CODE, "1 hour")
    quarter = tallied_counts(tally, config, VEHICLE_CODE, "15 min")
    ped_hour = tallied_counts(tally, ped_config, PED_CODE, "1 hour").where("CallPhase is not null")
    ped_quarter = tallied_counts(tally, ped_config, PED_CODE, "15 min").where("CallPhase is not null")
    filtered = filtered_counts(hour, config, HOURLY)
    return {
        "comm_uptime": tallied_comm_uptime(tally),
        "counts_1hr": hour, "filtered_counts_1hr": filtered,
        "bad_detectors": bad_detectors(filtered), "detector_uptime_pd": daily_detector_uptime(filtered),
        "counts_15min": quarter, "filtered_counts_15min": filtered_counts(quarter, config, QUARTER_HOURLY),
        "counts_ped_1hr": ped_hour, "counts_ped_15min": ped_quarter,
        "ped_actuations_pd": daily_volume(ped_hour, False, "papd"),
        "ped_actuations_ph": period_volume(ped_hour, "1 hour", False, "paph", "Hour"),
        "ped_actuations_15min": period_volume(ped_quarter, "15 min", False, "pa15"),
    }


def wide_vehicle_counts(wide: DataFrame, unit: str = "1 hour") -> DataFrame:
    """Detections with a matching off event, from the wide event table."""
    return (wide.where(F.col("DetectorOff").isNotNull())
            .groupBy("SignalID", tp.floor_period("Timestamp", unit).alias("Timeperiod"), "Detector", "Phase")
            .agg(F.count(F.lit(1)).alias("Vehicles")))
