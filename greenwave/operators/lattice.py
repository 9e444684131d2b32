"""All levels of a metric from one table of partial sums: days, weeks and months of signals, corridors and zones.

A weighted mean over any period is a ratio of two sums, so the fact table is read once, into sums by
signal, phase and day.  Weeks and months are grouping sets over these; places follow from the signals' few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.grid import bounds, densify
from greenwave.functions.layout import laid_out
from greenwave.functions.stats import total, wmean, with_delta
from greenwave.operators.rollup import HIERARCHY, in_zones, zone_memberships
from greenwave.session import stored

TIMES = ("day", "week", "month")
SUMS = ("_xw", "_used", "_all", "_bare")
FAR = 1 << 30  # a step beyond any next period: nothing is filled in between


def partial_sums(df: DataFrame, value: str, weight: str, ts: str = "Date_Hour") -> DataFrame:
    """Sums by signal, phase, day and whether the hour is a peak hour: x * w, the weights of rows with a value, all weights, and values without a weight."""
    x, w = F.col(value), F.col(weight)
    used = x.isNotNull()
    return df.groupBy("SignalID", "CallPhase", "Date", "Week", tp.is_peak(ts).alias("peak")).agg(
        F.sum(F.when(used, (x * w).cast("double"))).alias("_xw"), F.sum(F.when(used, w.cast("double"))).alias("_used"),
        F.coalesce(F.sum(w), F.lit(0)).cast("double").alias("_all"), F.count_if(used & w.isNull()).alias("_bare"))


def _value() -> Column:
    return F.when(F.col("_bare") == 0, F.try_divide("_xw", "_used"))


def _sums(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def signal_levels(sums: DataFrame, value: str, weight: str, rows: int | None = None) -> DataFrame:
    """time, SignalID, _period (number of the period), value, weight: days over all phases at once; weeks and months per phase and then over phases,
    with rows for periods without data.

    ``sums`` (of about ``rows`` rows) is laid out by signal once; all levels are made there.
    """
    number = lambda m: F.year(m) * 12 + F.month(m) - 1
    numbers = F.unix_date("Date"), F.col("Week"), number(tp.month_start("Date"))  # periods of each kind numbered without gaps
    each = F.array(*[F.struct(F.lit(t).alias("_kind"), n.cast("int").alias("_period")) for t, n in zip(TIMES, numbers, strict=True)])
    keys = ["SignalID", "CallPhase"]
    laid = laid_out(sums.select(*keys, "Date", "Week", *SUMS), ["SignalID"], sums.count() if rows is None else rows, 250_000)
    sets = _sums(laid.select(*keys, *SUMS, F.inline(each)), [*keys, "_kind", "_period"])
    sets = sets.withColumn("time", F.when(F.col("_period").isNull(), "month").otherwise(F.col("_kind")))
    span = bounds(sums, "Week"), bounds(sums, tp.month_start("Date"))
    day, week = F.col("time") == "day", F.col("time") == "week"
    low, high = (F.when(day, F.col("_period")).when(week, span[0][e]).otherwise(number(span[1][e])) for e in ("lo", "hi"))
    step = F.when(day, FAR).otherwise(1)
    phases = sets.select("time", *keys, "_period", _value().alias(value), F.col("_all").alias(weight), "_xw", "_used", "_bare")
    dense = densify(phases, ["time", *keys], "_period", low, high, step, {weight: 0.0})
    pooled = F.when(F.sum("_bare") == 0, F.try_divide(F.sum("_xw"), F.sum("_used")))
    return dense.groupBy("time", "SignalID", "_period").agg(
        F.when(day, pooled).otherwise(wmean(value, weight)).alias(value), total(weight).alias(weight))


def stored_sums(sums: DataFrame) -> DataFrame:
    """The partial sums as Parquet, signals together: a fraction of what a checkpoint takes."""
    return stored(sums.sortWithinPartitions("SignalID", "CallPhase", "Date"), "partial_sums")


def lattice(df: DataFrame, corridors: DataFrame, value: str, weight: str, peak: bool = True, extra: dict | None = None, keep=stored_sums) -> DataFrame:
    """time, place ('signal' or 'corridor'), Zone_Group, name, period, value, weight, delta for days, weeks and months in one table.

    The same rows as the separate roll-ups give.  Weeks stand at their Tuesday, months at their first day.  Corridor rows include the
    overlapping zone groups (``extra`` as in ``zone_memberships``); signals have no Zone_Group.  ``keep`` stores the partial
    sums, the only thing made from the fact table.

    Sums move to their signal and a signal's levels once to each of its corridors; zones, changes and equal rows are settled
    there.  Only a corridor named like its zone can equal a zone group's row, so only such rows move once more.
    """
    sums = keep(partial_sums(df, value, weight))
    used = sums.where("peak") if peak else sums
    seen = used.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("SignalID").alias("signals"), F.approx_count_distinct("Week").alias("weeks")).first()
    levels = seen.rows + seen.signals * seen.weeks * 5 // 4  # days, weeks and months
    signals = with_delta(signal_levels(used, value, weight, levels), ["time", "SignalID"], "_period", value)
    mean = lambda rows, keys: rows.groupBy(*keys).agg(wmean(value, weight).alias(value), total(weight).alias(weight))
    zoned = in_zones(signals.drop("delta"), corridors, ["SignalID"], levels)
    cor = with_delta(mean(zoned, ["time", *HIERARCHY, "_period"]), ["time", *HIERARCHY], "_period", value).where(F.col(value).isNotNull())
    groups = mean(cor.drop("delta").withColumn("name", F.explode(zone_memberships(extra))), ["time", "name", "_period"])
    groups = with_delta(groups, ["time", "name"], "_period", value).withColumn("Zone_Group", F.col("name"))
    out = ["time", "Zone_Group", "name", "_period", value, weight, "delta"]
    own = lambda rows: rows.select("time", F.col("Zone").alias("Zone_Group"), F.col("Corridor").alias("name"), *out[3:])
    alike = F.col("Zone").eqNullSafe(F.col("Corridor"))
    places = own(cor.where(~alike)).distinct().unionByName(own(cor.where(alike)).unionByName(groups.select(*out)).distinct())
    both = signals.select(F.lit("signal").alias("place"), "time", F.lit(None).cast("string").alias("Zone_Group"), F.col("SignalID").cast("string").alias("name"), *out[3:]).unionByName(
        places.withColumn("place", F.lit("corridor")))
    first = sums.select(F.min("Date")).scalar()
    month = F.make_date(F.expr("_period div 12").cast("int"), (F.col("_period") % 12 + 1).cast("int"), F.lit(1))
    period = F.when(F.col("time") == "day", F.date_from_unix_date(F.col("_period").cast("int"))).when(F.col("time") == "week", tp.tuesday_of_week("_period", first)).otherwise(month)
    return both.select("time", "place", "Zone_Group", "name", period.alias("period"), value, weight, "delta")
