"""Roll-ups over time and place.

One engine serves every metric: a signal frame (SignalID, optional CallPhase, a period column, a value
and an optional weight) goes through one or two grouped means or sums, an optional gap fill, and a
period-over-period change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.grid import bounds, densify, first_value, month_step
from greenwave.functions.layout import laid_out
from greenwave.functions.stats import total, wmean, with_delta

HIERARCHY = ("Zone_Group", "Zone", "Corridor")


def _weighted(df: DataFrame, weight: str | None) -> tuple[DataFrame, str]:
    """Use a column of ones where no weight is named."""
    if weight is None or weight == "ones":
        return df.withColumn("ones", F.lit(1.0)), "ones"
    return df, weight


def _mean(df: DataFrame, keys: Sequence, value: str, weight: str) -> DataFrame:
    return df.groupBy(*keys).agg(wmean(value, weight).alias(value), total(weight).alias(weight))


def group_mean(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """Weighted mean and total weight per group."""
    return _mean(df, keys, value, weight)


def peak_only(df: DataFrame, ts: str = "Date_Hour") -> DataFrame:
    return df.where(tp.is_peak(ts))


# ---- signal level -----------------------------------------------------------
def period_avg(df: DataFrame, value: str, period: str, weight: str | None = None, entity: str = "SignalID") -> DataFrame:
    df, weight = _weighted(df, weight)
    out = _mean(df, [entity, period], value, weight)
    return with_delta(out, [entity], period, value).select(entity, period, value, weight, "delta")


def period_sum(df: DataFrame, value: str, period: str, entity: str = "SignalID") -> DataFrame:
    out = df.groupBy(entity, period).agg(total(value).alias(value))
    return with_delta(out, [entity], period, value).select(entity, period, value, "delta")


def daily_avg(df: DataFrame, value: str, weight: str | None = None, peak: bool = False) -> DataFrame:
    return period_avg(peak_only(df) if peak else df, value, "Date", weight)


def daily_sum(df: DataFrame, value: str) -> DataFrame:
    return period_sum(df, value, "Date")


def _with_tuesday(df: DataFrame, source: DataFrame, dates: str = "Date") -> DataFrame:
    return df.withColumn("Date", tp.tuesday_of_week("Week", first_value(source, dates)))


def weekly_sum_by_day(df: DataFrame, value: str) -> DataFrame:
    """Mean over the week's days per phase, summed over phases."""
    phase = df.groupBy("SignalID", "Week", "CallPhase").agg(F.avg(value).alias(value))
    out = phase.groupBy("SignalID", "Week").agg(total(value).alias(value))
    out = with_delta(out, ["SignalID"], "Week", value)
    return _with_tuesday(out, df).select("SignalID", "Date", "Week", value, "delta")


def weekly_avg_by_day(df: DataFrame, value: str, weight: str | None = None, peak: bool = True) -> DataFrame:
    """Weighted mean over the week per phase, then over phases; weeks without data become rows."""
    src, weight = _weighted(df, weight)
    rows = peak_only(src) if peak else src
    phase = _mean(rows, ["SignalID", "CallPhase", "Week"], value, weight)
    b = bounds(rows, "Week")
    dense = densify(phase, ["SignalID", "CallPhase"], "Week", b["lo"], b["hi"], F.lit(1), {weight: 0.0})
    out = _mean(dense, ["SignalID", "Week"], value, weight)
    out = with_delta(out, ["SignalID"], "Week", value)
    return _with_tuesday(out, df).select("SignalID", "Date", "Week", value, weight, "delta")


def monthly_avg_by_day(df: DataFrame, value: str, weight: str | None = None, peak: bool = False) -> DataFrame:
    """Months without data become rows.  Unweighted: mean per phase, summed over phases (0 for an empty
    month).  Weighted: weighted mean per phase, then over phases (NULL for an empty month)."""
    rows = (peak_only(df) if peak else df).withColumn("Month", tp.month_start("Date"))
    b = bounds(rows, "Month")
    keys = ["SignalID", "CallPhase", "Month"]
    if weight is None:
        phase = rows.groupBy(*keys).agg(F.avg(value).alias(value))
        dense = densify(phase, keys[:2], "Month", b["lo"], b["hi"], month_step())
        out = dense.groupBy("SignalID", "Month").agg(total(value).alias(value))
    else:
        phase = _mean(rows, keys, value, weight)
        dense = densify(phase, keys[:2], "Month", b["lo"], b["hi"], month_step(), {weight: 0.0})
        out = _mean(dense, ["SignalID", "Month"], value, weight)
    return with_delta(out, ["SignalID"], "Month", value)


def weekly_avg_by_hr(df: DataFrame, value: str, weight: str | None = None, ts: str = "Hour") -> DataFrame:
    """Hours moved to the week's Tuesday; mean over days per phase, then over phases."""
    tuesday = tp.tuesday_of_week("Week", first_value(df, F.col(ts).cast("date")))
    rows = df.withColumn(ts, tp.on_date(ts, tuesday))
    keys = ["SignalID", "Week", ts]
    phased = keys + (["CallPhase"] if "CallPhase" in df.columns else [])
    if weight is None:
        out = rows.groupBy(*phased).agg(F.avg(value).alias(value))
        out = out.groupBy(*keys).agg(F.avg(value).alias(value))
    else:
        out = _mean(_mean(rows, phased, value, weight), keys, value, weight)
    # change is taken against the previous hour of the same week
    out = with_delta(out, ["SignalID", "Week"], ts, value)
    return out.select("SignalID", ts, "Week", value, *([weight] if weight else []), "delta")


def sum_by_period(df: DataFrame, value: str, unit: str) -> DataFrame:
    """Totals per signal, phase and bucket; change against the previous bucket of the day."""
    keys = ["SignalID", "CallPhase", "Week", "DOW"]
    rows = df.withColumns({"DOW": tp.dow("Timeperiod"), "Week": tp.week_index("Timeperiod"),
                           "Timeperiod": tp.floor_period("Timeperiod", unit)})
    out = rows.groupBy(*keys, "Timeperiod").agg(total(value).alias(value))
    return with_delta(out, keys, "Timeperiod", value)


def avg_by_hr(df: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """Hourly (weighted) mean per signal and phase with change against the previous hour."""
    src, weight = _weighted(df, weight)
    rows = src.withColumn("Hour", tp.floor_hour("Date_Hour"))
    out = _mean(rows, ["SignalID", "CallPhase", "Hour"], value, weight)
    out = out.withColumns({"Week": tp.week_index("Hour"), "DOW": tp.dow("Hour")})
    return with_delta(out, ["SignalID", "CallPhase"], "Hour", value)


def monthly_avg_by_hr(df: DataFrame, value: str, weight: str | None = None, delta: bool = True) -> DataFrame:
    """Per hour over phases, then per hour of day on the first of the month."""
    src, weight = _weighted(df, weight)
    hour = _mean(src, ["SignalID", "Hour"], value, weight)
    out = _mean(hour.withColumn("Hour", tp.month_hour("Hour")), ["SignalID", "Hour"], value, weight)
    return with_delta(out, ["SignalID"], "Hour", value) if delta else out


def monthly_hourly_volume(df: DataFrame, value: str = "vph") -> DataFrame:
    """Midweek hourly volume averaged per hour of day on the first of the month."""
    rows = df.where(F.col("DOW").isin(tp.TUE, tp.WED, tp.THU))
    hour = rows.groupBy("SignalID", "Hour").agg(total(value).alias(value))
    return hour.groupBy("SignalID", tp.month_hour("Hour").alias("Hour")).agg(F.avg(value).alias(value))


def peak_means(df: DataFrame, value: str, period: str = "Month") -> dict[str, DataFrame]:
    """AM and PM peak means of an hourly signal series."""
    def part(hours):
        rows = df.where(F.hour("Hour").isin(*hours)).withColumn("Date", tp.day("Hour"))
        return daily_avg(rows, value).withColumnRenamed("Date", period)

    return {"am": part(tp.AM_PEAK_HOURS), "pm": part(tp.PM_PEAK_HOURS)}


# ---- corridors --------------------------------------------------------------
def corridor_means(df: DataFrame, corridors: DataFrame, value: str, period: str, weight: str | None = None,
                   rows: int | None = None) -> DataFrame:
    """Mean per corridor; a signal counts in every corridor it belongs to.

    The hierarchy is not hinted: Spark broadcasts it only when its measured size allows.  Where ``rows`` says how many rows
    ``df`` has, a row moves once for each corridor and meets its zones there, and one layout serves the means and the change.
    """
    keys = [*HIERARCHY, period]
    if all(k in df.columns for k in HIERARCHY) and "SignalID" not in df.columns:
        joined = df
    else:
        shared = [c for c in df.columns if c in corridors.columns]
        if rows is None or any(k in shared for k in HIERARCHY):
            joined = df.join(corridors, shared)
        else:
            joined = in_zones(df.select(*dict.fromkeys([*shared, period, value, *([weight] if weight else [])])), corridors, shared, rows)
    joined = joined.where(F.col("Corridor").isNotNull())
    if weight is None:
        out = joined.groupBy(*keys).agg(F.avg(value).alias(value))
    else:
        out = _mean(joined, keys, value, weight)
    return with_delta(out, HIERARCHY, period, value)


def in_zones(df: DataFrame, corridors: DataFrame, shared: list[str], rows: int) -> DataFrame:
    """Rows laid out by corridor, then one for each zone that the corridor names for the signal, repeats included."""
    places = corridors.where(F.col("Corridor").isNotNull()).groupBy("Corridor", *shared).agg(
        F.collect_list(F.struct("Zone_Group", "Zone")).alias("_zones"))
    size = places.select(F.sum(F.size("_zones")).alias("all"), F.countDistinct(*shared).alias("signals")).first()
    laid = laid_out(df.join(places, shared), ["Corridor"], rows * (size.all or 0) // max(size.signals, 1))
    return laid.select("*", F.inline("_zones")).drop("_zones")


def zone_memberships(extra: dict[str, tuple[str, Sequence[str]]] | None = None, by: str = "Zone") -> Column:
    """The group names a corridor row adds to: its own zone (or zone group) and any extra groups.

    ``extra`` maps a group name to (column, values) that select its members.
    """
    names = [F.col(by)]
    for group, (c, values) in (extra or {}).items():
        names.append(F.when(F.col(c).isin(*values), F.lit(group)))
    return F.array_compact(F.array(*names))


def with_zone_groups(cor: DataFrame, value: str, period: str, weight: str,
                     extra: dict[str, tuple[str, Sequence[str]]] | None = None, by: str = "Zone") -> DataFrame:
    """Corridor rows plus one row per overlapping group, all groups from one pass over the corridors."""
    members = cor.withColumn("_g", F.explode(zone_memberships(extra, by)))
    groups = _mean(members, ["_g", period], value, weight).withColumnRenamed("_g", "Zone_Group")
    groups = with_delta(groups.withColumn("Corridor", F.col("Zone_Group")), ["Zone_Group"], period, value)
    cols = ["Corridor", "Zone_Group", period, value, weight, "delta"]
    own = cor.select("Corridor", F.col("Zone").alias("Zone_Group"), period, value, weight, "delta")
    return own.unionByName(groups.select(*cols)).distinct()


def corridor_rollup(df: DataFrame, corridors: DataFrame, value: str, period: str, weight: str | None = None,
                    drop_empty: bool = True, extra=None, by: str = "Zone") -> DataFrame:
    """Corridor means and their zone groups for any period column."""
    src, weight = _weighted(df, weight)
    cor = corridor_means(src, corridors, value, period, weight)
    if drop_empty:
        cor = cor.where(F.col(value).isNotNull())
    return with_zone_groups(cor, value, period, weight, extra, by)


def cor_weekly_avg_by_day(df, corridors, value, weight=None, **kw) -> DataFrame:
    return corridor_rollup(df, corridors, value, "Date", weight, **kw).withColumn("Week", tp.week_index("Date"))


def cor_monthly_avg_by_day(df, corridors, value, weight=None, **kw) -> DataFrame:
    return corridor_rollup(df, corridors, value, "Month", weight, **kw)


def cor_avg_by_hr(df, corridors, value, weight=None, **kw) -> DataFrame:
    return corridor_rollup(df, corridors, value, "Hour", weight, drop_empty=False, **kw)


def cor_peak_means(cor_hourly: DataFrame, value: str, weight: str | None = None,
                   period: str = "Month") -> dict[str, DataFrame]:
    """AM and PM peak means of an hourly corridor series."""
    keys = ["Zone_Group", "Corridor"]

    def part(hours):
        rows = cor_hourly.where(F.hour("Hour").isin(*hours)).withColumn(period, tp.day("Hour"))
        if weight is None:
            out = rows.groupBy(*keys, period).agg(F.avg(value).alias(value))
        else:
            out = _mean(rows, [*keys, period], value, weight)
        return with_delta(out, keys, period, value)

    return {"am": part(tp.AM_PEAK_HOURS), "pm": part(tp.PM_PEAK_HOURS)}


def cor_detector_uptime(avg_daily: DataFrame, corridors: DataFrame, period: str = "Date", **kw) -> DataFrame:
    """Setback, presence and all-detector uptime side by side per corridor and period."""
    rows = avg_daily.withColumn("Month", tp.month_start("Date")) if period == "Month" else avg_daily
    part = lambda v, w: corridor_rollup(rows.where(F.col(v).isNotNull()).drop("delta"), corridors, v, period, w, **kw)
    sb, pr = part("uptime_sb", "all_sb"), part("uptime_pr", "all_pr")
    everything = part("uptime", "all" if period == "Month" else None)
    keys = ["Corridor", "Zone_Group", period]
    out = sb.select(*keys, "uptime_sb").join(pr.select(*keys, "uptime_pr"), keys, "full")
    keep = ["uptime", "delta"] if period == "Month" else ["uptime"]
    out = out.join(everything.select(*keys, *keep), keys, "left")
    return out.withColumn("Week", tp.week_index("Date")) if period == "Date" else out


def quarterly(monthly: DataFrame, value: str, weight: str | None = None, operation: str = "avg") -> DataFrame:
    """Calendar quarters of a monthly corridor series: weighted mean, sum, or the latest month."""
    src, weight = _weighted(monthly, weight if weight in monthly.columns else None)
    rows = src.withColumn("Quarter", tp.quarter_label("Month"))
    keys = ["Corridor", "Zone_Group", "Quarter"]
    if operation == "avg":
        out = _mean(rows, keys, value, weight)
    elif operation == "sum":
        out = rows.groupBy(*keys).agg(total(value).alias(value))
    elif operation == "latest":
        out = rows.groupBy(*keys).agg(F.max_by(F.struct(value, weight), "Month").alias("_r")).select(*keys, "_r.*")
    else:
        raise ValueError(f"unknown operation {operation!r}")
    return with_delta(out, ["Corridor", "Zone_Group"], "Quarter", value)


# ---- signals as corridors ---------------------------------------------------
def signals_as_corridors(df: DataFrame, cor_df: DataFrame, corridors: DataFrame, identifier: str = "SignalID") -> DataFrame:
    """Signal (or camera) rows re-keyed as corridors of their corridor, with the corridor rows appended.

    Every row stays: one whose signal is in no corridor has no zone group.  Cameras are matched within the corridor that
    their row names.  ``Name`` comes from the configuration (for cameras their location).
    """
    label = next((c for c in ("Name", "Location") if c in corridors.columns), None)
    about = [F.min("Description").alias("Description") if identifier == "SignalID" else F.lit(None).cast("string").alias("Description")]
    names = corridors.groupBy(identifier, "Corridor").agg(*about, *([F.min(label).alias("Name")] if label else []))
    by_corridor = identifier != "SignalID" and "Corridor" in df.columns
    dropped = ["Zone_Group", "Subcorridor", "Description", "Name", *([] if by_corridor else ["Corridor"])]
    own = df.drop(*dropped).join(names, [identifier, "Corridor"] if by_corridor else identifier, "left")
    own = own.withColumnRenamed("Corridor", "Zone_Group").withColumn("Corridor", F.col(identifier).cast("string")).drop(identifier)
    own = own.withColumn("Description", F.coalesce("Description", "Corridor"))
    kept = cor_df.join(names.select("Corridor").distinct(), "Corridor", "left_semi")
    kept = kept.drop("Subcorridor", "Zone_Group").withColumns(
        {"Zone_Group": F.col("Corridor"), "Description": F.col("Corridor")})
    return own.unionByName(kept, allowMissingColumns=True)


def hourly_with_hierarchy(df: DataFrame, value: str, corridors: DataFrame) -> DataFrame:
    """Signal hours with their hierarchy and change per signal."""
    tree = corridors.select("SignalID", *HIERARCHY)
    changed = with_delta(df, ["SignalID"], "Hour", value)
    return changed.join(tree, "SignalID", "left").where(F.col("Corridor").isNotNull())
