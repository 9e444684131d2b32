"""Camera and roadside-unit uptime."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.grid import bounds, day_step, densify, spread
from greenwave.functions.stats import ratio, total, wmean, with_delta
from greenwave.operators.rollup import cor_monthly_avg_by_day, cor_weekly_avg_by_day

PLACE = ["Zone_Group", "Zone", "Corridor", "Subcorridor", "CameraID", "Description"]


def camera_activity(log: DataFrame) -> DataFrame:
    """Standard deviation of a camera's image size per day; 0 means the picture never changed."""
    return log.distinct().groupBy("CameraID", "Date").agg(F.coalesce(F.stddev_samp("Size"), F.lit(0.0)).alias("Size"))


def daily_camera_uptime(activity: DataFrame, cameras: DataFrame, start=None) -> DataFrame:
    """Every configured camera on every day of the range: up when its activity is above zero.

    The range goes from the first to the last day on which any camera is up; a camera that is never up brings ``start`` into it.
    """
    rows = activity if start is None else activity.where(F.col("Date") >= F.lit(start).cast("date"))
    up = rows.where(F.col("Size") > 0).select("CameraID", "Date").distinct()
    b = bounds(up.join(cameras.select("CameraID").distinct(), "CameraID", "left_semi"), "Date")
    low, high = b["lo"], b["hi"]
    if start is not None:
        first = F.lit(start).cast("date")
        silent = cameras.select("CameraID").join(up, "CameraID", "left_anti").select(F.count(F.lit(1)) > 0).scalar()
        low = F.when(silent, F.least(low, first)).otherwise(low)
        high = F.when(silent, F.greatest(high, first)).otherwise(high)
    grid = spread(cameras, "Date", low, high, day_step()).where(F.col("Date") >= F.col("As_of_Date"))
    out = grid.join(up.withColumn("_up", F.lit(1.0)), ["CameraID", "Date"], "left")
    up_col = F.coalesce("_up", F.lit(0.0))
    return out.select("CameraID", "Date", up_col.alias("up"), F.lit(1.0).alias("num"), up_col.alias("uptime"),
                      *[c for c in cameras.columns if c not in ("CameraID", "Location", "As_of_Date")])


def combined_camera_uptime(web: DataFrame, encoder: DataFrame, min_overall: float = 0.2) -> DataFrame:
    """Public-site and encoder feeds together: up is 2 on the site, 1 at the encoder only, 0 otherwise.

    Every camera has a row on every date that any row has.  Days on which the whole system is below ``min_overall`` are dropped as collection failures.
    """
    keys = [c for c in web.columns if c not in ("up", "num", "uptime", "SignalID")]
    none = F.lit(None).cast("double")
    seen = web.select(*keys).unionByName(encoder.select(*keys))
    dates = seen.select("Date").distinct()
    span = bounds(seen, "Date")
    grid = (spread(seen.drop("Date").distinct(), "Date", span["lo"], span["hi"], day_step()).join(dates, "Date", "left_semi")
            .select(*keys, none.alias("up_web"), none.alias("up_enc")))
    both = (grid.unionByName(web.select(*keys, F.col("up").alias("up_web"), none.alias("up_enc")))
            .unionByName(encoder.select(*keys, F.lit(None).cast("double").alias("up_web"), F.col("up").alias("up_enc")))
            .groupBy(*keys).agg(F.coalesce(F.max("up_web"), F.lit(0.0)).alias("up_web"), F.coalesce(F.max("up_enc"), F.lit(0.0)).alias("up_enc")))
    out = both.withColumns({"uptime": F.col("up_web"), "num": F.lit(1.0),
                            "up": F.greatest(F.col("up_web") * 2, F.col("up_enc"))})
    bad = out.groupBy("Date").agg((F.sum("uptime") / F.sum("num")).alias("_u")).where(F.col("_u") < min_overall).select("Date")
    return out.join(bad, "Date", "left_anti")


def daily_avg_camera(df: DataFrame, value: str = "uptime", weight: str = "num") -> DataFrame:
    out = df.groupBy("CameraID", "Date").agg(wmean(value, weight).alias(value), total(weight).alias(weight))
    return with_delta(out, ["CameraID"], "Date", value)


def weekly_avg_camera(df: DataFrame, value: str = "uptime", weight: str = "num") -> DataFrame:
    place = [c for c in PLACE if c in df.columns]
    first = df.select(F.min("Date")).scalar()
    rows = df.withColumn("Week", tp.week_index("Date"))
    out = rows.groupBy(*place, "Week").agg(wmean(value, weight).alias(value), total(weight).alias(weight))
    out = with_delta(out, place, "Week", value)
    return out.withColumn("Date", tp.tuesday_of_week("Week", first))


def monthly_avg_camera(df: DataFrame) -> DataFrame:
    place = [c for c in PLACE if c in df.columns]
    return df.groupBy(*place, tp.month_start("Date").alias("Month")).agg(
        total("uptime").alias("up"), wmean("uptime", "num").alias("uptime"), total("num").alias("num"))


def cor_camera_uptime(df: DataFrame, period: str = "week") -> DataFrame:
    """Corridor sums of cameras up and counted, and their ratio, by week (Tuesday) or month."""
    if period == "week":
        first = df.select(F.min("Date")).scalar()
        key = tp.tuesday_of_week("_w", first).alias("Date")
        df = df.withColumn("_w", tp.week_index("Date"))
    else:
        key = tp.month_start("Date").alias("Month")
    return df.where(F.col("Corridor").isNotNull()).groupBy(key, "Corridor", "Zone_Group").agg(
        total("up").alias("up"), total("num").alias("num"), ratio(F.sum("up"), F.sum("num")).alias("uptime"))


def _cameras_in_corridors(df: DataFrame, sub: bool) -> DataFrame:
    if not sub:
        return df
    return (df.drop("Zone_Group").where(F.col("Subcorridor").isNotNull())
            .withColumnsRenamed({"Zone": "Zone_Group", "Corridor": "Zone", "Subcorridor": "Corridor"}))


def cor_camera_rollup(df: DataFrame, period: str = "Date", sub: bool = False, **kw) -> DataFrame:
    """Corridor (or subcorridor) camera uptime with zone groups; rows already carry their place."""
    rows = _cameras_in_corridors(df, sub).select("Zone_Group", "Zone", "Corridor", period, "uptime", "num")
    fn = cor_weekly_avg_by_day if period == "Date" else cor_monthly_avg_by_day
    return fn(rows, rows, "uptime", "num", **kw)


def rsu_uptime(rsu: DataFrame, powered: DataFrame, min_overall: float = 0.2) -> DataFrame:
    """Powered roadside units from their first day up, without days of systemic failure.

    rsu: SignalID, Date, uptime, count.
    """
    rows = rsu.join(powered.select("SignalID").distinct(), "SignalID", "left_semi")
    first = rows.where(F.col("uptime") == 1).groupBy("SignalID").agg(F.min("Date").alias("_first"))
    rows = rows.join(first, "SignalID").where(F.col("Date") >= F.col("_first")).drop("_first")
    bad = rows.groupBy("Date").agg(F.avg("uptime").alias("_u")).where(F.col("_u") < min_overall).select("Date")
    return rows.join(bad, "Date", "left_anti").select("SignalID", "Date", "uptime", F.col("count").alias("total"))
