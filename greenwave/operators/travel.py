"""Travel time, speed, safety, crash and delay-cost measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.grid import densify_seen, periods_seen
from greenwave.functions.layout import laid_out
from greenwave.functions.stats import ratio, weighted_percentile, with_delta, with_share
from greenwave.operators.rollup import HIERARCHY, cor_avg_by_hr, cor_monthly_avg_by_day, cor_weekly_avg_by_day, monthly_avg_by_day


def segment_travel_times(readings: DataFrame, segments: DataFrame) -> DataFrame:
    """Readings with their segment's corridor, length and reference minutes; exact copies dropped.

    Copies go before the join, where rows are narrow: different readings and different segments make different rows.
    """
    df = laid_out(readings.where("tmc_code is not null"), ["tmc_code"], readings.count()).distinct()
    df = df.join(segments.select("tmc_code", "miles", "Corridor", "Subcorridor").distinct(), "tmc_code")
    return df.withColumn("reference_minutes", ratio("miles", "reference_speed") * 60).withColumn("date", tp.day("Hour"))


def corridor_travel_times(segment_times: DataFrame, sub: bool = False) -> DataFrame:
    """The rows kept for corridors (or subcorridors); 'None' marks unassigned segments."""
    return segment_times.where(F.col("Subcorridor" if sub else "Corridor") != "None")


def travel_time_metrics(times: DataFrame, group: Sequence[str] = ("Corridor",), rows: int | None = None) -> DataFrame:
    """Travel time, planning time and buffer index and speed per corridor and hour of day in the month.

    A month holds at most 31 of one hour, so the percentile's groups are small.  One layout by place serves both
    groupings; ``rows`` says about how many rows come, and is counted if not given.
    """
    times = laid_out(times, group, times.count() if rows is None else rows)
    whole = times.groupBy(*group, "Hour").agg(
        F.sum("travel_time_minutes").alias("_t"), F.sum("reference_minutes").alias("_r"), F.sum("miles").alias("_m"))
    whole = whole.withColumns({"Hour": tp.month_hour("Hour"), "_s": ratio("_m", F.col("_t") / 60)})
    out = whole.groupBy(*group, "Hour").agg(
        F.avg("_t").alias("_t"), F.avg("_r").alias("_r"), F.percentile("_t", 0.9).alias("_p"), F.avg("_s").alias("speed_mph"))
    tti, pti = ratio("_t", "_r"), ratio("_p", "_r")
    return out.select(*group, "Hour", tti.alias("tti"), pti.alias("pti"), (pti - tti).alias("bi"), "speed_mph")


def relative_speed_index(times: DataFrame, limits: DataFrame, group: Sequence[str] = ("Corridor",), accuracy: int | None = None) -> DataFrame:
    """90th percentile speed over the speed limit; ``accuracy`` as in ``weighted_percentile``."""
    p90 = weighted_percentile(times, group, "speed", 0.9, "speed", accuracy)
    return p90.join(limits.select(*[c for c in group if c in limits.columns], "Speed_Limit"),
                    [c for c in group if c in limits.columns]).withColumn("rsi", ratio("speed", "Speed_Limit"))


def bike_ped_safety_index(times: DataFrame, injury: DataFrame, group: Sequence[str] = ("Corridor",), ts: str = "Hour") -> DataFrame:
    """Chance of serious injury from the mix of speeds, 9-11 AM and 7-9 PM, 20 mph and up.

    injury: mph_bin, pct.
    """
    rows = times.where((F.col("speed") >= 20) & F.hour(ts).isin(9, 10, 19, 20))
    mix = rows.groupBy(*group, "speed").agg(F.count(F.lit(1)).alias("_n"))
    mix = with_share(mix, group, "_n", "_share").join(injury.withColumnRenamed("mph_bin", "speed"), "speed")
    return mix.groupBy(*group).agg(F.sum(F.col("_share") * F.col("pct")).alias("overall_pct"))


def monthly_index_series(cor: DataFrame, sub: DataFrame, corridors: DataFrame, value: str) -> dict[str, DataFrame]:
    """Monthly corridor and subcorridor series with change; corridor rows also stand as subcorridors."""
    whole = sub.select("Corridor", "Subcorridor", "Month", value).unionByName(
        cor.select("Corridor", F.col("Corridor").alias("Subcorridor"), "Month", value))
    whole = whole.withColumnsRenamed({"Corridor": "Zone_Group", "Subcorridor": "Corridor"})
    tree = corridors.select("Zone_Group", "Corridor").distinct()
    main = cor.select("Corridor", "Month", value).join(tree, "Corridor", "left")
    by = ["Zone_Group", "Corridor"]
    return {"sub": with_delta(whole, by, "Month", value), "cor": with_delta(main, by, "Month", value)}


# ---- travel index weighted by volume ----------------------------------------
def hour_weights(cor_vph: DataFrame, by: Column) -> DataFrame:
    """Mean share of a corridor's daily volume by hour of day."""
    rows = cor_vph.select(*HIERARCHY, "Hour", "vph").withColumn("_by", by)
    shares = with_share(rows, [*HIERARCHY, "_by"], "vph", "pct")
    return shares.groupBy(*HIERARCHY, F.hour("Hour").alias("hr")).agg(F.avg("pct").alias("pct"))


def weighted_travel_index(ti: DataFrame, cor_vph: DataFrame, corridors: DataFrame, weekly: bool = False) -> DataFrame:
    """Corridor travel index with the hour's volume share as weight (1 where unknown).

    A place has at most 24 weights, so they travel as one row a place, and the index meets places and weights in one join that
    keeps its layout by corridor.
    """
    by = tp.week_index("Hour") if weekly else F.month("Hour")
    keys = [k for k in HIERARCHY if k in ti.columns]
    weights = hour_weights(cor_vph, by).where("hr is not null").groupBy(*HIERARCHY).agg(
        F.map_from_entries(F.collect_list(F.struct("hr", "pct"))).alias("_pct"))
    places = corridors.select(*HIERARCHY).distinct().join(weights, list(HIERARCHY), "left")
    placed = ti.join(places, keys, "left").withColumn("hr", F.hour("Hour"))
    values = [c for c in ti.columns if c not in HIERARCHY]
    return placed.select(*HIERARCHY, "hr", *values, F.coalesce(F.try_element_at("_pct", "hr"), F.lit(1.0)).alias("pct"))


def travel_index_rollup(weighted: DataFrame, value: str, period: str = "hour", **kw) -> DataFrame:
    """Corridor and zone travel index by hour of day, month or day."""
    if period == "hour":
        return cor_avg_by_hr(weighted, weighted, value, "pct", **kw)
    if period == "month":
        return cor_monthly_avg_by_day(weighted.withColumn("Month", tp.day("Hour")), weighted, value, "pct", **kw)
    return cor_weekly_avg_by_day(weighted.withColumn("Date", tp.day("Hour")), weighted, value, "pct", **kw)


def buffer_index(tti: DataFrame, pti: DataFrame, period: str) -> DataFrame:
    keys = ["Zone_Group", "Corridor", period]
    both = tti.select(*keys, "tti").join(pti.select(*keys, "pti"), keys, "full")
    return both.withColumn("bi", F.col("pti") - F.col("tti"))


# ---- user delay cost --------------------------------------------------------
def hourly_delay_cost(udc: DataFrame) -> DataFrame:
    """Cost per zone, corridor, month and hour of day (on the month's first day)."""
    rows = udc.where("date is not null").withColumns({"Month": tp.month_start("date"), "month_hour": tp.month_hour(tp.floor_hour("date"))})
    return rows.groupBy("Zone", "Corridor", "Month", "month_hour").agg(F.coalesce(F.sum("delay_cost"), F.lit(0.0)).alias("delay_cost"))


def delay_cost_trend(udc: DataFrame) -> DataFrame:
    """Each month's cost next to the month before and the same month last year.

    A month's total is sent to the months that compare with it, so no table joins itself.
    """
    month = udc.where("date is not null").groupBy("Zone", "Corridor", tp.month_start("date").alias("Month")).agg(
        F.coalesce(F.sum("delay_cost"), F.lit(0.0)).alias("cost"))
    months = periods_seen(udc.select(tp.month_start("date").alias("Month")), "Month")
    to = F.explode(F.array(*[F.struct(F.add_months("Month", n).alias("Month"), F.lit(n).alias("lag")) for n in (0, 1, 12)]))
    sent = month.select("Zone", "Corridor", "cost", to.alias("_to"))
    sent = sent.where(F.array_contains(F.slice(months, 2, F.greatest(F.size(months) - 1, F.lit(0))), F.col("_to.Month")))
    pick = lambda n: F.max(F.when(F.col("_to.lag") == n, F.col("cost")))
    out = sent.groupBy("Zone", "Corridor", F.col("_to.Month").alias("Month")).agg(
        pick(0).alias("current_month"), pick(1).alias("last_month"), pick(12).alias("last_year"))
    return out.withColumns({
        "month_over_month": ratio(F.col("current_month") - F.col("last_month"), "last_month"),
        "year_over_year": ratio(F.col("current_month") - F.col("last_year"), "last_year")})


def delay_cost_run_list(corridors: DataFrame, segments: DataFrame, zone_prefix: str) -> DataFrame:
    """Segments of each zone's corridors, as one list per corridor."""
    places = corridors.select("Zone", "Corridor").distinct().where(F.col("Zone").startswith(zone_prefix))
    return (places.join(segments.where("Corridor is not null").select("Corridor", "tmc_code").distinct(), "Corridor")
            .groupBy("Zone", "Corridor").agg(F.array_sort(F.collect_list("tmc_code")).alias("tmcs")))


def bottleneck_lengths(bottlenecks: DataFrame, segments: DataFrame, id_col: str,
                       lists: dict[str, str]) -> DataFrame:
    """Total segment length of each list column; ``lists`` maps list column to result name."""
    length = segments.select("tmc_code", "length")
    out = bottlenecks
    for c, name in lists.items():
        total_len = (bottlenecks.select(id_col, F.explode(F.array_distinct(c)).alias("tmc_code")).join(length, "tmc_code")
                     .groupBy(id_col).agg(F.sum("length").alias(name)))
        out = out.join(total_len, id_col, "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
    return out.drop(*lists)


# ---- crashes ----------------------------------------------------------------
CRASH_COLUMNS = ("crashes_k", "crashes_a", "crashes_b", "crashes_c", "crashes_o", "crashes_total", "cost")


def rolling_crashes(crashes: DataFrame, months: int = 36) -> DataFrame:
    """Trailing sums over the last ``months`` months that occur in the data."""
    rows = crashes.dropna().groupBy("SignalID", "Month").agg(*[F.sum(c).alias(c) for c in CRASH_COLUMNS])
    dense = densify_seen(rows, ["SignalID"], "Month", dict.fromkeys(CRASH_COLUMNS, 0))
    w = Window.partitionBy("SignalID").orderBy("Month").rowsBetween(-(months - 1), 0)
    return dense.withColumns({c: F.sum(c).over(w) for c in CRASH_COLUMNS})


def rolling_volume(monthly_vpd: DataFrame, months: int = 12) -> DataFrame:
    """Monthly volume with its trailing mean (``vpd12``)."""
    dense = densify_seen(monthly_vpd.select("SignalID", "Month", "vpd"), ["SignalID"], "Month")
    w = Window.partitionBy("SignalID").orderBy("Month").rowsBetween(-(months - 1), 0)
    return dense.withColumn("vpd12", F.avg("vpd").over(w))


def monthly_crash_rates(crashes: DataFrame, monthly_vpd: DataFrame) -> DataFrame:
    """Crash-rate and severity-cost index: the latest trailing crash sums against each month's volume."""
    trailing = rolling_crashes(crashes)
    latest = trailing.where(F.col("Month") == trailing.select(F.max("Month")).scalar()).drop("Month")
    latest = latest.withColumn("Month", F.explode(periods_seen(monthly_vpd, "Month")))
    both = latest.join(rolling_volume(monthly_vpd), ["SignalID", "Month"], "full")
    three_years = F.col("vpd") * 3
    return both.withColumns({"cri": ratio(F.col("crashes_total") * 1000, three_years), "kabco": ratio("cost", three_years),
                             "Date": F.col("Month"), "CallPhase": F.lit(0)})


def crash_index(rates: DataFrame, value: str) -> DataFrame:
    """Monthly signal series of 'cri' or 'kabco'."""
    return monthly_avg_by_day(rates.select("SignalID", "CallPhase", "Date", value), value)
