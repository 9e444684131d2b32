"""Queries behind the report pages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.grid import densify, day_step
from greenwave.functions.stats import wmean
from greenwave.plans.metrics import Metric, table_name

Source = Callable[[str], DataFrame]


def _place(df: DataFrame, level: str, zone_group: str, aliases: dict[str, Sequence[str]] | None,
           hide_corridor_prefix: str | None) -> DataFrame:
    if level == "signal" and zone_group == "All":
        return df
    if aliases and zone_group in aliases:
        df = df.where(F.col("Zone_Group").isin(*aliases[zone_group]))
        if level == "corridor" and hide_corridor_prefix:
            df = df.where(~F.col("Corridor").startswith(hide_corridor_prefix))
        return df
    return df.where(F.col("Zone_Group") == zone_group)


def query_data(source: Source, metric: Metric, zone_group: str, level: str = "corridor", resolution: str = "monthly",
               hourly: bool = False, corridor: str | None = None, month: str | None = None, quarter: str | None = None,
               upto: bool = True, aliases: dict[str, Sequence[str]] | None = None,
               hide_corridor_prefix: str | None = None) -> DataFrame:
    """Rows of a result table for a place, up to (or exactly at) a period.

    ``source`` opens a table by name, for example ``spark.table``.
    """
    df = _place(source(table_name(metric, level, resolution, hourly)), level, zone_group, aliases, hide_corridor_prefix)
    if hourly and metric.hourly_table:
        if resolution == "monthly":
            first = F.lit(month).cast("timestamp_ntz")
            df = df.where(F.col("Hour") <= F.add_months(F.lit(month).cast("date"), 1).cast("timestamp_ntz") - tp.day_interval(hours=1))
            df = df if upto else df.where(F.col("Hour") >= first)
    elif resolution == "monthly":
        at = F.lit(month).cast("date")
        df = df.where(F.col("Month") <= at if upto else F.col("Month") == at)
    elif resolution == "quarterly":
        df = df.where(F.col("Quarter") <= quarter if upto else F.col("Quarter") == quarter)
    else:
        end = F.last_day(F.lit(month).cast("date"))
        df = df.where(F.col("Date") <= end if upto else F.col("Date") == end)
    return df if corridor is None else df.where(F.col("Corridor") == corridor)


def query_health(source: Source, table: str, zone_group: str, level: str = "corridor", corridor: str | None = None,
                 month: str | None = None, aliases: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Health rows of a place; corridors are read from the subcorridor table."""
    prefix = "sig" if level == "signal" else "sub"
    df = source(f"{prefix}_mo_{table}")
    if aliases and zone_group in aliases:
        df = df.where(F.col("Zone_Group").isin(*aliases[zone_group]))
    elif not (level == "signal" and zone_group == "All"):
        df = df.where((F.col("Zone_Group") == zone_group) | (F.col("Zone") == zone_group))
    if month is not None:
        df = df.where(F.col("Month") == F.lit(month).cast("date"))
    return df if corridor is None else df.where(F.col("Corridor") == corridor)


def filter_health(health: DataFrame, zones: Sequence[str], corridor: str | None = None) -> DataFrame:
    """Health rows by zone group or zone, and corridor."""
    df = health.where(F.col("Zone_Group").isin(*zones) | F.col("Zone").isin(*zones))
    return df if corridor is None else df.where(F.col("Corridor") == corridor)


def query_delay_trend(stored: DataFrame) -> DataFrame:
    """Rows of the delay-cost trend kept as one JSON document per month."""
    row = ("array<struct<Zone:string,Corridor:string,Month:date,current_month:double,last_month:double,last_year:double,"
           "month_over_month:double,year_over_year:double>>")
    return stored.select(F.inline(F.from_json("data", row)))


def store_delay_trend(trend: DataFrame, max_rows_per_document: int = 1000) -> DataFrame:
    """The trend as JSON documents, split so that no document grows with the data."""
    cols = ["Zone", "Corridor", "Month", "current_month", "last_month", "last_year", "month_over_month", "year_over_year"]
    part = F.floor((F.row_number().over(Window.partitionBy("Month", "_h").orderBy("Zone", "Corridor")) - 1) / max_rows_per_document)
    rows = trend.withColumn("_h", F.pmod(F.xxhash64("Zone", "Corridor"), F.lit(64))).withColumn("_part", part)
    return rows.groupBy("Month", "_h", "_part").agg(F.collect_list(F.struct(*cols)).alias("r")).select(
        "Month", F.to_json("r").alias("data"))


def query_delay_hourly(hourly: DataFrame, zone: str, month: str) -> DataFrame:
    return hourly.where((F.col("Zone") == zone) & (F.col("Month") <= F.lit(month).cast("date")))


def delay_cost_comparison(hourly: DataFrame) -> DataFrame:
    """The latest month's hourly cost with last month and last year shifted onto the same hours."""
    latest = hourly.select(F.max("Month")).scalar()
    parts = []
    for name, months in (("current_month", 0), ("last_month", 1), ("last_year", 12)):
        rows = hourly.where(F.col("Month") == F.add_months(latest, -months))
        moved = (F.col("month_hour") + F.make_ym_interval(F.lit(0), F.lit(months))).cast("timestamp_ntz")
        parts.append(rows.select("Zone", "Corridor", moved.alias("month_hour"), F.lit(name).alias("period"), "delay_cost"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def signal_map_data(metric_rows: DataFrame, signals: DataFrame, variable: str, month: str) -> DataFrame:
    """A month's signal values with coordinates and description."""
    rows = metric_rows.where(F.col("Month") == F.lit(month).cast("date")).select("SignalID", "Month", variable)
    place = signals.groupBy("SignalID").agg(F.min("Corridor").alias("Corridor"), F.min("Latitude").alias("Latitude"),
                                            F.min("Longitude").alias("Longitude"), F.min("Description").alias("Description"))
    return rows.join(place, "SignalID", "left").where("Latitude is not null")


def top_signals(rows: DataFrame, variable: str, n: int = 10, ascending: bool | None = None) -> DataFrame:
    """The ``n`` worst signals of a map: lowest uptime, or highest of anything else."""
    up = variable == "uptime" if ascending is None else ascending
    by = F.col(variable).asc_nulls_last() if up else F.col(variable).desc_nulls_last()
    return rows.select("SignalID", "Description", "Corridor", variable).distinct().orderBy(by, "SignalID").limit(n)


def top_per_group(rows: DataFrame, group: str, by: str, n: int = 10) -> DataFrame:
    """Rows of each group at or above its n-th largest value, ties kept.

    Ranks run over distinct values within hash slices first, so a hot group is never ranked whole.
    """
    values = rows.groupBy(group, by).agg(F.count(F.lit(1)).alias("_c"))
    sliced = values.withColumn("_s", F.pmod(F.xxhash64(by), F.lit(64)))
    first = Window.partitionBy(group, "_s").orderBy(F.col(by).desc())
    kept = sliced.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= n).drop("_r")
    over = Window.partitionBy(group).orderBy(F.col(by).desc()).rowsBetween(Window.unboundedPreceding, -1)
    edge = kept.withColumn("_above", F.coalesce(F.sum("_c").over(over), F.lit(0))).where(F.col("_above") < n)
    edge = edge.groupBy(group).agg(F.min(by).alias("_edge"))
    return rows.join(edge, group).where(F.col(by) >= F.col("_edge")).drop("_edge")


def uptime_matrix(df: DataFrame, value: str, month: str, key: str = "Corridor") -> DataFrame:
    """One row per entity, one column per day of the month (``d01`` ...), 0 where there is nothing."""
    first = F.lit(month).cast("date")
    rows = df.where(tp.month_start("Date") == first).groupBy(key, "Date").agg(F.sum(value).alias(value))
    dense = densify(rows, [key], "Date", first, F.last_day(first), day_step(), {value: 0})
    days = [f"d{d:02d}" for d in range(1, 32)]
    name = F.concat(F.lit("d"), F.lpad(F.dayofmonth("Date").cast("string"), 2, "0"))
    wide = dense.withColumn("_d", name).groupBy(key).pivot("_d", days).agg(F.sum(value))
    return wide.na.fill(0, days)


def metric_card(df: DataFrame, zone_group: str, variable: str, period: str, at: str) -> DataFrame:
    """One place's value, change, and the value before it."""
    rows = df.where((F.col("Zone_Group") == zone_group) & (F.col("Corridor") == zone_group) & (F.col(period) <= F.lit(at).cast("date")))
    last = F.max(F.struct(period, variable, "delta"))
    out = rows.agg(last.alias("_l"))
    value, change = F.col(f"_l.{variable}"), F.col("_l.delta")
    return out.select(F.col(f"_l.{period}").alias(period), value.alias(variable), change.alias("delta"),
                      F.try_divide(value, 1 + change).alias("previous"))


def first_and_last(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """The first and last period's value of each group."""
    return df.groupBy(*keys).agg(F.min_by(value, period).alias("first_value"), F.max_by(value, period).alias("last_value"))


def backlog_long(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Reported, resolved and outstanding tasks in long form."""
    return df.unpivot(list(ids), ["Reported", "Resolved", "Outstanding"], "Events", "value")


def quarterly_extract(tables: dict[str, tuple[DataFrame, str]], fiscal_start: int = 7) -> DataFrame:
    """All quarterly metrics in long form by district and fiscal quarter.

    tables: metric label -> (frame, value column).  A district's own rows are used where it has any,
    otherwise the weighted mean over its corridors; the weight is the first of ones, num, vol.
    """
    rows = None
    for label, (df, value) in tables.items():
        weights = [F.col(c).cast("double") for c in ("ones", "num", "vol") if c in df.columns] or [F.lit(None).cast("double")]
        part = df.select(F.lit(label).alias("Metric"), "Zone_Group", "Corridor", "Quarter",
                         F.col(value).cast("double").alias("value"), F.coalesce(*weights).alias("weight"))
        rows = part if rows is None else rows.unionByName(part)
    year, quarter = F.split_part("Quarter", F.lit("."), F.lit(1)), F.split_part("Quarter", F.lit("."), F.lit(2))
    rows = rows.where(F.col("Quarter").rlike(r"^\d{4}\.\d$") & (F.col("Zone_Group") != "NA"))
    start = F.make_date(year.cast("int"), (quarter.cast("int") - 1) * 3 + 1, F.lit(1))
    rows = rows.withColumn("date", tp.quarter_end(start)).withColumn("Quarter", tp.fiscal_quarter("date", fiscal_start))
    cols = [F.col("Zone_Group").alias("District"), "date", "Quarter", "Metric", "value"]
    own = rows.where(F.col("Zone_Group") == F.col("Corridor"))
    rest = rows.where(F.col("Zone_Group") != F.col("Corridor")).join(own.select("Zone_Group").distinct(), "Zone_Group", "left_anti")
    rest = rest.groupBy("Zone_Group", "date", "Quarter", "Metric").agg(wmean("value", "weight").alias("value"))
    return own.select(*cols).unionByName(rest.select(*cols))


def latest_comments(comments: DataFrame, zone: str | None = None, month: str | None = None) -> DataFrame:
    """The newest comment of each month and zone."""
    newest = comments.groupBy("Month", "Zone").agg(F.max("LastModified").alias("LastModified"))
    out = comments.join(newest, ["Month", "Zone", "LastModified"], "left_semi")
    out = out if zone is None else out.where(F.col("Zone") == zone)
    return out if month is None else out.where(F.col("Month") == F.lit(month).cast("date"))


def recent_comments(comments: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` newest comments of each month and zone, ties kept."""
    keyed = comments.withColumn("_k", F.struct("Month", "Zone"))
    return top_per_group(keyed, "_k", "LastModified", n).drop("_k")


def cut_off(df: DataFrame, report_end: str) -> DataFrame:
    """A result table's rows up to the end of the report, whatever its period column."""
    end = F.lit(report_end).cast("date")
    if "Quarter" in df.columns:
        return df.where(F.col("Quarter") <= tp.quarter_label(end))
    if "Month" in df.columns:
        return df.where(F.col("Month") <= end)
    period = next(c for c in ("Date", "Hour", "Timeperiod") if c in df.columns)
    return df.where(F.col(period).cast("date") < F.add_months(end, 1))


def signals_with_corridors(signals: DataFrame, corridors: DataFrame) -> DataFrame:
    """Every signal with its corridor ('None' if it has none) and a description."""
    out = signals.join(corridors.select("SignalID", "Zone_Group", "Zone", "Corridor", "Description"), "SignalID", "left")
    fallback = F.concat(F.col("SignalID").cast("string"), F.lit(": "), F.col("PrimaryName"), F.lit(" @ "), F.col("SecondaryName"))
    return out.withColumns({"Corridor": F.coalesce("Corridor", F.lit("None")), "Description": F.coalesce("Description", fallback)})


def coordinates(text: str | Column, quoted: bool = True) -> Column:
    """'lon lat,lon lat' (inside quotes), or ','- and ':'-separated points, as an array of points."""
    c = F.col(text) if isinstance(text, str) else text
    points = F.split(F.regexp_extract(c, "'(.*?)'", 1), ",") if quoted else F.array_distinct(F.split(c, "[,:]"))

    def point(p):
        xy = F.split(F.trim(p), r"\s+")
        return F.struct(F.element_at(xy, 1).cast("double").alias("longitude"), F.element_at(xy, 2).cast("double").alias("latitude"))

    return F.transform(points, point)
