"""Aggregates with the engine's missing-value rules; every function returns a Column."""

from __future__ import annotations

from collections.abc import Sequence
from math import erfc, lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from greenwave.functions.timeparts import col


def ratio(a, b) -> Column:
    """a / b, NULL where b is zero."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def total(x) -> Column:
    """Sum that is 0 over nothing."""
    return F.coalesce(F.sum(col(x)), F.lit(0))


def wmean(x, w) -> Column:
    """Weighted mean over rows with a value.

    NULL when a row with a value has no weight, and when the weights add up to zero.
    """
    x, w = col(x), col(w)
    used = x.isNotNull()
    bare = F.count_if(used & w.isNull())
    return F.when(bare == 0, F.try_divide(F.sum(F.when(used, (x * w).cast("double"))),
                                          F.sum(F.when(used, w.cast("double")))))


def strict_max(x) -> Column:
    """Max that is NULL when any value is NULL."""
    x = col(x)
    return F.when(F.count_if(x.isNull()) == 0, F.max(x))


def with_delta(df: DataFrame, entity: Sequence[str], period: str, value: str, name: str = "delta") -> DataFrame:
    """Relative change against the entity's previous row."""
    before = F.lag(value).over(Window.partitionBy(*entity).orderBy(period))
    return df.withColumn(name, F.try_divide((F.col(value) - before).cast("double"), before.cast("double")))


def with_share(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """Each row's share of its group's total."""
    return df.withColumn(name, ratio(value, F.sum(value).over(Window.partitionBy(*group))))


def nth_largest(x, n: int) -> Column:
    """n-th largest value; use only where a group has a known small size (hours of a day)."""
    return F.try_element_at(F.sort_array(F.collect_list(col(x)), asc=False), F.lit(n))


def weighted_percentile(df: DataFrame, keys: Sequence[str], value: str, p: float, name: str, accuracy: int | None = None) -> DataFrame:
    """Percentile of a group, exact (linear interpolation) unless ``accuracy`` is given.

    Equal values are counted before the shuffle, so a hot group costs its number of distinct values, not its
    number of rows.  Where values hardly ever repeat and a group has very many, give ``accuracy``: the result is then a value
    of the group whose rank is off by at most a share of 1 / accuracy, from sketches of bounded size made in each task.
    """
    if accuracy is not None:
        return df.groupBy(*keys).agg(F.percentile_approx(value, p, accuracy).cast("double").alias(name)).where(F.col(name).isNotNull())
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*keys).agg(F.percentile(value, p, F.col("_n")).alias(name))


def gamma_cdf_at_one(shape: Column, rate: Column) -> Column:
    """P(X <= 1) for a gamma distribution, as an Arrow-batched function."""
    @F.pandas_udf("double")
    def cdf(a: pd.Series, x: pd.Series) -> pd.Series:
        av, xv = a.to_numpy(float), x.to_numpy(float)
        out = np.full(len(av), np.nan)
        ok = np.isfinite(av) & np.isfinite(xv) & (av > 0) & (xv > 0)
        if ok.any():
            out[ok] = _lower_gamma(av[ok], xv[ok], np.array([lgamma(v) for v in av[ok]]))
        return pd.Series(out)

    return F.nanvl(cdf(shape, rate), F.lit(None).cast("double"))


#: Above this shape the uniform asymptotic expansion is exact to about 1e-10, and the others would take many steps.
LARGE_SHAPE = 1e5


def _lower_gamma(a, x, lgam):
    """Regularized lower incomplete gamma for arrays, by series, continued fraction or, for large shapes, asymptotic expansion."""
    out = np.empty_like(x)
    large = a > LARGE_SHAPE
    series = ~large & (x < a + 1)
    rest = ~large & ~series
    if large.any():
        out[large] = _gamma_large(a[large], x[large])
    if series.any():
        out[series] = _gamma_series(a[series], x[series], lgam[series])
    if rest.any():
        out[rest] = 1 - _gamma_fraction(a[rest], x[rest], lgam[rest])
    return np.clip(out, 0, 1)


def _gamma_lead(a, x, lgam):
    return np.exp(np.clip(a * np.log(x) - x - lgam, -745, 700))


def _gamma_series(a, x, lgam):
    """Power series for x < a + 1; its terms fall, so it always ends."""
    term = 1.0 / a
    total = term.copy()
    n = a.copy()
    while np.any(term >= total * 1e-16):
        n = n + 1
        term = term * x / n
        total = total + term
    return _gamma_lead(a, x, lgam) * total


def _gamma_fraction(a, x, lgam):
    """The upper function by continued fraction (modified Lentz) for x >= a + 1, run until it stands still."""
    tiny = 1e-300
    b = x + 1 - a
    c = np.full_like(x, 1 / tiny)
    d = 1 / np.where(b == 0, tiny, b)
    h = d.copy()
    i, step = 0, np.full_like(x, 2.0)
    while np.any(np.abs(step - 1) >= 1e-15):
        i += 1
        an = -i * (i - a)
        b = b + 2
        d = an * d + b
        d = 1 / np.where(np.abs(d) < tiny, tiny, d)
        c = b + an / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        step = d * c
        h = h * step
    return _gamma_lead(a, x, lgam) * h


def _gamma_large(a, x):
    """First term of the uniform expansion around x = a."""
    mu = (x - a) / a
    eta = np.sign(mu) * np.sqrt(2 * np.maximum(mu - np.log1p(mu), 0))
    near = np.abs(mu) < 1e-3
    with np.errstate(divide="ignore", invalid="ignore"):
        first = np.where(near, -1 / 3 + eta / 12 - 2 * eta**2 / 135, 1 / mu - 1 / eta)
    main = np.array([erfc(v) for v in -eta * np.sqrt(a / 2)]) / 2
    return main - np.exp(-a * eta**2 / 2) / np.sqrt(2 * np.pi * a) * first
