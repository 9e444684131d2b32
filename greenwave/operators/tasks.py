"""Work-order backlogs and matching of work locations to signals."""

from __future__ import annotations

import math

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.grid import periods_seen
from greenwave.functions.stats import total, wmean, with_delta

UNSPECIFIED = ("Task_Type", "Task_Subtype", "Task_Source", "Priority", "Status")


def tidy_tasks(tasks: DataFrame, corridors: DataFrame, today, key: str = "SignalID",
               extra_groups: dict[str, tuple[str, Sequence[str]]] | None = None, zone_as_group: bool = False) -> DataFrame:
    """Reported (and perhaps resolved) tasks with hierarchy and time to resolve.

    ``extra_groups`` (name: column, values) and ``zone_as_group`` repeat a task in further zone groups.
    """
    today = F.lit(today).cast("date") if not isinstance(today, Column) else today
    rows = tasks.where((F.col("Date_Reported") < today) & ((F.col("Date_Resolved") < today) | F.col("Date_Resolved").isNull()))
    rows = rows.join(corridors.select(key, "Zone_Group", "Zone", "Corridor").distinct(), key, "left").where("Corridor is not null")
    hours = tp.seconds_between(tp.ntz("Date_Reported"), tp.ntz("Date_Resolved")) / 3600
    rows = rows.withColumns({c: F.coalesce(c, F.lit("Unspecified")) for c in UNSPECIFIED if c in tasks.columns})
    rows = rows.withColumns({"Days_To_Resolve": F.floor(hours / 24), "Hours_To_Resolve": F.floor(hours),
                             "Date_Reported": tp.day("Date_Reported"), "Date_Resolved": tp.day("Date_Resolved"), "All": F.lit("all")})
    groups = [F.col("Zone_Group")]
    if zone_as_group:
        groups.append(F.col("Zone"))
    for name, (c, values) in (extra_groups or {}).items():
        groups.append(F.when(F.col(c).isin(*values), F.lit(name)))
    if len(groups) == 1:
        return rows
    return rows.withColumn("Zone_Group", F.explode(F.array_compact(F.array(*groups))))


def reported_and_resolved(tasks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tasks reported and resolved per key and day, in one pass over the tasks."""
    moves = tasks.select(*keys, F.explode(F.array(
        F.struct(F.col("Date_Reported").alias("Date"), F.lit(1).alias("rep"), F.lit(0).alias("res")),
        F.struct(F.col("Date_Resolved").alias("Date"), F.lit(0).alias("rep"), F.lit(1).alias("res")))).alias("_m"))
    return moves.where("_m.Date is not null").groupBy(*keys, F.col("_m.Date").alias("Date")).agg(
        F.sum("_m.rep").alias("n_reported"), F.sum("_m.res").alias("n_resolved"))


def daily_status(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Daily and running totals and the backlog; a key has at most one row a day."""
    out = daily.groupBy(*keys, "Date").agg(F.sum("n_reported").alias("Reported"), F.sum("n_resolved").alias("Resolved"))
    w = Window.partitionBy(*keys).orderBy("Date").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns({"cum_Reported": F.sum("Reported").over(w), "cum_Resolved": F.sum("Resolved").over(w)})
    return out.withColumn("Outstanding", F.col("cum_Reported") - F.col("cum_Resolved"))


def outstanding_by_month(daily: DataFrame, param: str, carry_all: bool = False) -> DataFrame:
    """Monthly sums and month-end backlog for every corridor, value of the parameter and month seen.

    In months without rows only the running count of reported tasks is carried on (``carry_all``
    carries the other two as well).
    """
    place = ["Zone_Group", "Corridor"]
    month = daily.groupBy(*place, param, tp.month_start("Date").alias("Month")).agg(
        F.sum("Reported").alias("Reported"), F.sum("Resolved").alias("Resolved"),
        # several zones can share a corridor name: on a shared last day the larger backlog counts
        F.max(F.struct("Date", "cum_Reported", "cum_Resolved", "Outstanding")).alias("_last"))
    month = month.select(*place, param, "Month", "Reported", "Resolved", "_last.*").drop("Date")
    grid = month.select(*place).distinct().withColumn(param, F.explode(periods_seen(month, param))).withColumn(
        "Month", F.explode(periods_seen(month, "Month")))
    keys = [*place, param]
    out = grid.join(month, [*keys, "Month"], "left")
    w = Window.partitionBy(*keys).orderBy("Month")
    carried = ["cum_Reported"] + (["cum_Resolved", "Outstanding"] if carry_all else [])
    out = out.withColumns({c: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) for c in carried})
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("Reported", "Resolved", "cum_Reported", "cum_Resolved", "Outstanding")})
    for value, name in (("Reported", "delta_rep"), ("Resolved", "delta_res"), ("Outstanding", "delta_out")):
        out = with_delta(out, keys, "Month", value, name)
    return out


def one_group_per_corridor(df: DataFrame, corridors: DataFrame) -> DataFrame:
    """Rows of each corridor's first zone group, re-keyed to the corridor itself."""
    first = df.groupBy("Corridor").agg(F.min("Zone_Group").alias("Zone_Group"))
    out = df.join(first, ["Corridor", "Zone_Group"], "left_semi")
    return out.join(corridors.select("Corridor").distinct(), "Corridor", "left_semi").withColumn("Zone_Group", F.col("Corridor"))


def outstanding_tasks(tasks: DataFrame, corridors: DataFrame, param: str, report_start, today,
                      group_names: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Daily and monthly backlog by a task parameter, for corridors with zone groups and for corridors alone.

    ``group_names`` are overlapping groups that have no corridor rows of their own.
    """
    daily = reported_and_resolved(tasks, ["Zone_Group", "Zone", "Corridor", "SignalID", param])
    corridor = daily_status(daily, ["Zone_Group", "Zone", "Corridor", param])
    corridor = corridor.where(~F.col("Zone_Group").isin(*group_names) if group_names else F.lit(True)).drop("Zone")
    group = daily_status(daily, ["Zone_Group", param]).withColumn("Corridor", F.col("Zone_Group"))
    inside = (F.col("Date") >= F.lit(report_start).cast("date")) & (F.col("Date") <= F.lit(today).cast("date"))
    cor = corridor.unionByName(group).where(inside)
    sig = one_group_per_corridor(corridor, corridors).where(inside)
    return {"cor_daily": cor, "sig_daily": sig,
            "cor_monthly": outstanding_by_month(cor, param), "sig_monthly": outstanding_by_month(sig, param)}


def outstanding_by_age(tasks: DataFrame, months, report_start, group_names: Sequence[str] = ()) -> DataFrame:
    """Backlog by age and mean time to resolve as of each month's end, for corridors and zone groups.

    Tasks are first counted by (place, reported, resolved) day, so the months multiply counts, not tasks.
    """
    place = ["Zone_Group", "Zone", "Corridor"]
    counted = tasks.groupBy(*place, "Date_Reported", "Date_Resolved").agg(F.count(F.lit(1)).alias("_n"))
    rows = counted.withColumn("Month", F.explode(months)).withColumn("_end", F.last_day("Month"))
    rep, res, end, n = F.col("Date_Reported"), F.col("Date_Resolved"), F.col("_end"), F.col("_n")
    is_open = res.isNull() | (res > end)
    done = (rep <= end) & (res < end) & (rep > F.lit(report_start).cast("date"))
    count = lambda cond: F.sum(F.when(cond, n).otherwise(0))
    out = rows.groupBy(*place, "Month").agg(
        count(is_open & (rep < F.date_sub(end, 45))).alias("over45"), count(is_open & (rep < F.date_sub(end, 90))).alias("over90"),
        count(is_open & (rep <= end)).alias("num_outstanding"), F.sum(F.when(done, n)).alias("num_resolved"),
        F.sum(F.when(done, n * F.datediff(res, rep))).alias("_days")).where("over45 > 0")
    out = out.withColumns({"d0_45": F.col("num_outstanding") - F.col("over45"), "d45_90": F.col("over45") - F.col("over90"),
                           "mttr": F.try_divide(F.col("_days").cast("double"), F.col("num_resolved").cast("double"))})
    cols = ["Zone_Group", "Corridor", "Month", "d0_45", "d45_90", "over45", "over90", "num_outstanding", "num_resolved", "mttr"]
    every = F.count_if(F.col("num_resolved").isNull()) == 0
    group = out.groupBy("Zone_Group", "Month").agg(
        *[F.sum(c).alias(c) for c in ("d0_45", "d45_90", "over45", "over90", "num_outstanding")],
        wmean("mttr", "num_resolved").alias("mttr"), F.when(every, F.sum("num_resolved")).alias("num_resolved"))
    corridor = out.where(~F.col("Zone_Group").isin(*group_names)) if group_names else out
    both = corridor.select(*cols).unionByName(group.withColumn("Corridor", F.col("Zone_Group")).select(*cols))
    both = with_delta(both, ["Zone_Group", "Corridor"], "Month", "over45", "delta_over45")
    return with_delta(both, ["Zone_Group", "Corridor"], "Month", "mttr", "delta_mttr")


def outstanding_events(tasks: DataFrame, group: str, place: str = "Zone_Group") -> DataFrame:
    """Reported and resolved tasks and the backlog in each month with reports."""
    keys = [place, group]
    w = Window.partitionBy(*keys).orderBy("Month").rowsBetween(Window.unboundedPreceding, 0)

    def monthly(date, n, running):
        rows = tasks.where(F.col(date).isNotNull()).groupBy(*keys, tp.month_start(date).alias("Month")).agg(F.count(F.lit(1)).alias(n))
        return rows.withColumn(running, F.sum(n).over(w))

    both = monthly("Date_Reported", "Rep", "cumRep").join(monthly("Date_Resolved", "Res", "cumRes"), [*keys, "Month"], "left")
    both = both.withColumn("cumRes", F.last("cumRes", ignorenulls=True).over(w)).na.fill(0, ["Rep", "cumRep", "Res", "cumRes"])
    return both.withColumn("outstanding", F.col("cumRep") - F.col("cumRes"))


# ---- locations --------------------------------------------------------------
EARTH_METERS = 6371000.0


def meters_between(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance."""
    a, b, c, d = (F.radians(x) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return 2 * EARTH_METERS * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def nearest(points: DataFrame, others: DataFrame, point_id: str, other_id: str, within: float = 100.0) -> DataFrame:
    """Each point's nearest other within ``within`` metres, ties to the smallest id.

    Points meet others of their own and neighbouring grid cells only.  Rows of cells are as high as ``within``; in each row
    the cells are as wide as ``within`` where the parallels around it are shortest, and go around the
    globe.  So no pair is missed, whatever the distance and latitude.  Others at one position are one
    candidate, so copies of a position cost nothing.
    """
    high = min(180.0, math.degrees(within / EARTH_METERS) * 1.001 + 1e-9)

    def columns(row: Column) -> Column:
        """How many cells a row has."""
        edge = F.greatest(F.abs((row - 1) * high), F.abs((row + 2) * high))
        ring = F.cos(F.radians(F.least(edge, F.lit(90.0))))
        return F.greatest(F.lit(1), F.floor(F.least(ring * 360.0 * 0.99 / high, F.lit(1e15)))).cast("long")

    row = lambda c: F.floor(F.col(c) / high)
    column = lambda lon, n: F.pmod(F.floor((lon + 180.0) / 360.0 * n), n)
    around = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    sites = others.groupBy("Latitude", "Longitude").agg(F.min(other_id).alias(other_id))
    sites = sites.withColumn("_dx", around).withColumn("_x", row("Latitude") + F.col("_dx")).withColumn("_n", columns(F.col("_x")))
    sites = sites.withColumn("_dy", around).withColumn("_y", F.pmod(column(F.col("Longitude"), F.col("_n")) + F.col("_dy"), F.col("_n")))
    sites = sites.drop("_dx", "_dy", "_n").distinct().withColumnsRenamed({"Latitude": "_lat", "Longitude": "_lon"})
    pts = points.select(point_id, "Latitude", "Longitude", row("Latitude").alias("_x"))
    pts = pts.withColumn("_y", column(F.col("Longitude"), columns(F.col("_x"))))
    near = pts.join(sites, ["_x", "_y"]).withColumn("m", meters_between(F.col("Latitude"), F.col("Longitude"), F.col("_lat"), F.col("_lon")))
    best = near.where(F.col("m") < within).groupBy(point_id).agg(F.min(F.struct("m", other_id)).alias("_b"))
    return best.select(point_id, f"_b.{other_id}", "_b.m")


def match_locations(signals: DataFrame, locations: DataFrame, within: float = 100.0) -> DataFrame:
    """One signal per work location: nearest, then the one the location's name starts with."""
    pairs = nearest(signals, locations, "SignalID", "LocationId", within)
    pairs = pairs.withColumn("m", F.col("m").cast("int")).join(
        locations.select("LocationId", "Custom_Identifier"), "LocationId")
    guess = (F.split_part("Custom_Identifier", F.lit(" "), F.lit(1)) == F.col("SignalID").cast("string")).cast("int")
    w = Window.partitionBy("LocationId").orderBy("m", F.col("good_guess").desc(), "SignalID")
    out = pairs.withColumn("good_guess", F.coalesce(guess, F.lit(0)))
    return out.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("LocationId", "SignalID", "m", "good_guess")


def location_distances(locations: DataFrame, signals: DataFrame) -> DataFrame:
    """How many locations lie nearest to each signal, with smallest and largest distance."""
    return nearest(locations, signals, "LocationId", "SignalID").groupBy("SignalID").agg(
        F.count(F.lit(1)).alias("n"), F.min("m").alias("mindist"), F.max("m").alias("maxdist"))
