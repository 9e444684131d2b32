"""Pedestrian push-button quality, volumes and imputation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.grid import densify, densify_seen
from greenwave.functions.layout import laid_out
from greenwave.functions.ordered import last_change
from greenwave.functions.stats import gamma_cdf_at_one, nth_largest, ratio

INPUT = ["SignalID", "Detector", "CallPhase"]


def too_high(paph: DataFrame, since=None) -> DataFrame:
    """Input-days with implausibly many presses by any of three tests.

    paph: SignalID, Detector, CallPhase, Hour, paph.  Missing hours count as zero: they are counted,
    not generated, so a quiet input costs nothing.
    """
    rows = paph.withColumn("Date", tp.day("Hour")) if "Date" not in paph.columns else paph
    if since is not None:
        rows = rows.where(F.col("Date") >= (since if isinstance(since, Column) else F.lit(since)).cast("date"))
    hour, x = F.hour("Hour"), F.col("paph").cast("double")
    day = [*INPUT, "Date"]

    # compare with the second-largest input of the signal that hour (at least 1)
    laid = laid_out(rows, ["SignalID"], rows.count())
    peers = Window.partitionBy("SignalID", "Hour").orderBy(F.col("paph").desc())
    second = F.max(F.when(F.col("_r") == 2, x)).over(Window.partitionBy("SignalID", "Hour"))
    ranked = laid.withColumn("_r", F.row_number().over(peers)).withColumn("_second", F.coalesce(second, F.lit(0.0)))
    outlier = (x > F.greatest(F.lit(1.0), F.col("_second")) * 100) & (x > 300)
    # one pass over the laid out rows sums up all three tests
    sample, early = F.when((hour >= 6) & (hour <= 22), x), F.when(hour < 6, x)
    found = ranked.groupBy(*day).agg(
        F.sum(sample).alias("_s"), F.sum(sample * sample).alias("_q"), F.max(early).alias("_h"), nth_largest(early, 3).alias("_m"),
        F.count_if(outlier).alias("_o"))
    # a signal with a single input has nothing to compare with
    several = rows.groupBy("SignalID").agg((F.countDistinct("Detector", "CallPhase") > 1).alias("_several"))
    # hours seen anywhere that day are the sample; an input's absent hours are zeros
    hours = rows.where((hour >= 6) & (hour <= 22)).groupBy("Date").agg(F.countDistinct("Hour").alias("_n"))
    found = found.join(several, "SignalID", "left").join(hours, "Date", "left")
    mean = F.col("_s") / F.col("_n")
    sd = F.sqrt(F.greatest(F.try_divide(F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n"), F.col("_n") - 1), F.lit(0.0)))
    tests = [mean > 600, sd > 9000, F.col("_h") > 300, F.col("_m") > 60, (F.col("_o") >= 4) & F.col("_several")]
    return found.where(reduce(Column.__or__, [F.coalesce(t, F.lit(False)) for t in tests])).select(*day, F.lit(True).alias("toohigh"))


def low_press_probability(daily: DataFrame) -> DataFrame:
    """Per input and weekday/weekend: chance of at most one press a day, from a gamma fitted by moments."""
    fit = daily.groupBy(*INPUT, "weekday").agg(
        F.count(F.lit(1)).alias("_n"), F.avg("papd").alias("_m"), F.var_pop("papd").alias("_v"), F.max("papd").alias("_x"))
    fit = fit.where("_n > 2")
    shape = F.try_divide(F.col("_m") * F.col("_m"), F.col("_v"))
    rate = F.try_divide(F.col("_m"), F.col("_v"))
    p0 = F.when(F.col("_x") == 0, F.lit(1.0)).otherwise(F.coalesce(gamma_cdf_at_one(shape, rate), F.lit(1.0)))
    return fit.select(*INPUT, "weekday", p0.alias("p0"))


def ped_input_uptime(papd: DataFrame, paph: DataFrame, corridors: DataFrame, start, calc_start=None,
                     config: DataFrame | None = None) -> DataFrame:
    """Daily verdict on every push-button input.

    A day is bad when the current run of days without presses would happen by chance less than once
    in a hundred times, or when there are too many presses.
    """
    start = F.lit(start).cast("date")
    calc = start if calc_start is None else F.lit(calc_start).cast("date")
    daily = papd.select(*INPUT, "Date", F.col("papd").cast("double").alias("papd"))
    if config is not None:
        daily = daily.join(config.select(*INPUT, "Date").distinct(), [*INPUT, "Date"], "full")
    daily = daily.where(F.col("CallPhase") != 0).withColumn("papd", F.coalesce("papd", F.lit(0.0)))
    # one layout by input serves the filling, the runs and both joins, which bring one row an input
    inputs = daily.agg(F.countDistinct(F.struct(*INPUT)).alias("n"), F.countDistinct("Date").alias("days"), F.min("Date").alias("first")).first()
    known = corridors.groupBy("SignalID").agg(F.min("Asof").alias("Asof"))
    laid = laid_out(daily.join(known, "SignalID", "left"), INPUT, inputs.n * inputs.days)
    dense = densify_seen(laid, INPUT, "Date", {"papd": 0.0})
    dense = dense.withColumn("weekday", tp.dow("Date").isin(2, 3, 4, 5, 6))
    dense = last_change(dense, INPUT, "Date", F.col("papd") != 0, "_last")
    dense = dense.withColumn("streak_id", F.when(F.col("papd") > 0, F.lit(None)).otherwise(F.col("_last"))).drop("_last")
    asof = F.max("Asof").over(Window.partitionBy(*INPUT))
    dense = dense.withColumn("Asof", asof).where(
        F.col("Date") >= F.greatest(start, F.coalesce("Asof", F.lit(inputs.first).cast("date")))).drop("Asof")
    fitted = low_press_probability(dense).groupBy(*INPUT).agg(*[F.max(F.when(F.col("weekday") == d, F.col("p0"))).alias(n) for n, d in (("_on", True), ("_off", False))])
    scored = dense.join(fitted, INPUT, "left").withColumn("p0", F.when(F.col("weekday"), F.col("_on")).otherwise(F.col("_off"))).drop("_on", "_off")
    # a run's probability is the product over its days (few per input): NULL if a day has none, 0 if one is 0
    run = Window.partitionBy(*INPUT, "streak_id")
    product = F.when(F.count_if(F.col("p0") <= 0).over(run) > 0, F.lit(0.0)).otherwise(
        F.exp(F.sum(F.log(F.when(F.col("p0") > 0, F.col("p0")))).over(run)))
    pz = scored.withColumn("_p", F.when(F.count_if(F.col("p0").isNull()).over(run) == 0, product))
    problow = F.when(F.col("streak_id").isNull(), F.lit(0.0)).otherwise(1 - F.col("_p"))
    out = pz.withColumn("problow", problow).where(F.col("Date") >= calc)
    high = too_high(paph, calc).groupBy(*INPUT).agg(F.collect_set("Date").alias("_high"))  # the calendar bounds the days
    out = out.join(high, INPUT, "left").withColumn("toohigh", F.coalesce(F.array_contains("_high", F.col("Date")), F.lit(False)))
    bad = (F.col("problow") > 0.99) | F.col("toohigh")
    return out.select(*INPUT, "Date", tp.dow("Date").alias("DOW"), tp.week_index("Date").alias("Week"), "papd", "problow",
                      F.col("toohigh").cast("int").alias("probhigh"), F.when(bad, 0).when(~bad, 1).alias("uptime"),
                      F.lit(1).alias("all"))


def bad_ped_inputs(uptime: DataFrame) -> DataFrame:
    return uptime.where(F.col("uptime") == 0).select("SignalID", "Detector", "Date")


def impute_presses(uptime: DataFrame) -> DataFrame:
    """Presses on bad days replaced by the floor of the input's monthly mean over good days."""
    month = Window.partitionBy(*INPUT, tp.month_start("Date"))  # at most 31 rows
    good = F.when(F.col("uptime") == 1, F.col("papd"))
    return uptime.withColumn("papd", F.when(F.col("uptime") == 1, F.col("papd")).otherwise(F.floor(F.avg(good).over(month)).cast("double")))


def good_period_presses(counts: DataFrame, bad: DataFrame, minutes: int = 15, name: str = "vol") -> DataFrame:
    """Presses per signal and period without bad input-days, zero-filled over the range of days."""
    from greenwave.functions.grid import minute_step

    rows = counts.withColumn("Date", tp.day("Timeperiod")).join(bad.select("SignalID", "Detector", "Date").distinct(),
                                                                ["SignalID", "Detector", "Date"], "left_anti")
    per = rows.groupBy("SignalID", "Timeperiod").agg(F.sum("vol").alias(name))
    span = rows.select(F.struct(tp.ntz(F.min("Date")).alias("lo"),
                                (tp.ntz(F.max("Date")) + tp.day_interval(days=1)).alias("hi"))).scalar()
    step = minute_step(minutes)
    return densify(per, ["SignalID"], "Timeperiod", span["lo"], span["hi"] - step, step, {name: 0})
