"""Regular period grids without cross joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from greenwave.functions.timeparts import col


def bounds(df: DataFrame, c, lo_name: str = "lo", hi_name: str = "hi") -> Column:
    """Smallest and largest value of a column as a one-row scalar subquery."""
    return df.select(F.struct(F.min(col(c)).alias(lo_name), F.max(col(c)).alias(hi_name))).scalar()


def first_value(df: DataFrame, c) -> Column:
    return df.select(F.min(col(c))).scalar()


def last_value(df: DataFrame, c) -> Column:
    return df.select(F.max(col(c))).scalar()


def periods_seen(df: DataFrame, c) -> Column:
    """The sorted distinct periods in the data.  The calendar bounds their number, not the rows."""
    return df.select(F.array_sort(F.collect_set(col(c)))).scalar()


def spread(keys: DataFrame, period: str, lo, hi, step: Column) -> DataFrame:
    """One row per key and period from ``lo`` to ``hi``."""
    return keys.withColumn(period, F.explode(F.sequence(lo, hi, step)))


def densify(df: DataFrame, keys: Sequence[str], period: str, lo, hi, step: Column,
            fill: dict | None = None) -> DataFrame:
    """Add the missing periods of every key between ``lo`` and ``hi``.

    ``df`` holds one row per key and period.  Every row makes the periods up to the next row of
    its key, so there is one shuffle on the key and no join against a grid.  Other columns are
    NULL in added rows unless ``fill`` names a value.
    """
    fill = fill or {}
    others = [c for c in df.columns if c not in keys and c != period]
    w = Window.partitionBy(*keys).orderBy(period)
    here = F.col(period)
    start = F.when(F.row_number().over(w) == 1, F.least(lo, here)).otherwise(here)
    stop = F.greatest(F.coalesce(F.lead(period).over(w) - step, hi), here)
    made = df.withColumn("_from", start).withColumn("_to", stop).withColumn(
        "_p", F.explode(F.sequence(F.col("_from"), F.col("_to"), step)))
    own = F.col("_p") == here
    out = [F.col(k) for k in keys] + [F.col("_p").cast(df.schema[period].dataType).alias(period)]
    out += [F.when(own, F.col(c)).otherwise(F.lit(fill.get(c))).alias(c) for c in others]
    return made.select(*out)


def densify_seen(df: DataFrame, keys: Sequence[str], period: str, fill: dict | None = None) -> DataFrame:
    """Add, for every key, the periods that occur anywhere in the data."""
    seen = periods_seen(df, period)
    numbered = df.withColumn("_i", F.array_position(seen, F.col(period)).cast("int")).drop(period)
    dense = densify(numbered, keys, "_i", F.lit(1), F.size(seen), F.lit(1), fill)
    return dense.withColumn(period, F.element_at(seen, F.col("_i"))).drop("_i")


def month_step() -> Column:
    return F.make_ym_interval(F.lit(0), F.lit(1))


def day_step() -> Column:
    return F.expr("INTERVAL '1' DAY")


def minute_step(minutes: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
