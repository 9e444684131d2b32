"""Missing-value rules, grids, order-dependent helpers and range joins against brute force."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from greenwave.functions import grid, ordered, ranges, stats, timeparts as tp

T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


@pytest.mark.parametrize("rows, want", [
    ([(1.0, 2.0), (3.0, 2.0)], 2.0),
    ([(1.0, 2.0), (None, 5.0)], 1.0),      # a row without a value does not count
    ([(1.0, None), (3.0, 1.0)], None),     # a value without a weight makes the mean unknown
    ([(1.0, 0.0), (3.0, 0.0)], None),      # weights that add up to nothing
    ([(None, None)], None),
])
def test_weighted_mean(frame, rows, want):
    got = frame(rows, "x double, w double").agg(stats.wmean("x", "w").alias("m"), stats.total("w").alias("w")).first()
    assert got["m"] == want
    assert got["w"] == sum(w or 0 for _, w in rows)


def test_delta_is_null_on_zero(frame):
    df = stats.with_delta(frame([("a", 1, 0.0), ("a", 2, 5.0), ("a", 3, 10.0), ("b", 1, 3.0)], "k string, p int, v double"), ["k"], "p", "v")
    got = {(r.k, r.p): r.delta for r in df.collect()}
    assert got == {("a", 1): None, ("a", 2): None, ("a", 3): 1.0, ("b", 1): None}


def test_strict_max(frame):
    df = frame([("a", 1), ("a", None), ("b", 2)], "k string, v int").groupBy("k").agg(stats.strict_max("v").alias("m"))
    assert {r.k: r.m for r in df.collect()} == {"a": None, "b": 2}


def test_weighted_percentile_equals_plain(frame):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), float(rng.randrange(20))) for _ in range(300)]
    df = frame(rows, "k string, v double")
    a = {r.k: r.p for r in stats.weighted_percentile(df, ["k"], "v", 0.9, "p").collect()}
    b = {r.k: r.p for r in df.groupBy("k").agg(F.percentile("v", 0.9).alias("p")).collect()}
    assert a == pytest.approx(b)


@pytest.mark.parametrize("shape, rate", [(0.3, 0.05), (1.0, 1.0), (2.5, 0.1), (9.0, 30.0), (40.0, 2.0)])
def test_gamma_cdf(frame, shape, rate):
    got = frame([(shape, rate)], "a double, r double").select(stats.gamma_cdf_at_one(F.col("a"), F.col("r"))).first()[0]
    n = 200000
    mid = [(i + 0.5) / n for i in range(n)]
    if shape < 1:  # substitute x = u**(1/shape): the density's singularity at zero disappears
        want = math.exp(shape * math.log(rate) - math.lgamma(shape + 1)) * sum(math.exp(-rate * u ** (1 / shape)) for u in mid) / n
    else:
        c = shape * math.log(rate) - math.lgamma(shape)
        want = sum(math.exp(c + (shape - 1) * math.log(x) - rate * x) for x in mid) / n
    assert got == pytest.approx(want, abs=1e-6)


def test_densify(frame):
    df = frame([("a", 2, 5.0), ("a", 4, 7.0), ("b", 3, 1.0)], "k string, p int, v double")
    got = sorted((r.k, r.p, r.v) for r in grid.densify(df, ["k"], "p", F.lit(1), F.lit(5), F.lit(1), {"v": 0.0}).collect())
    want = sorted(("a", p, {2: 5.0, 4: 7.0}.get(p, 0.0)) for p in range(1, 6)) + sorted(("b", p, {3: 1.0}.get(p, 0.0)) for p in range(1, 6))
    assert got == want


def test_densify_months(frame):
    df = frame([("a", date(2024, 1, 1), 1.0), ("a", date(2024, 4, 1), 2.0)], "k string, p date, v double")
    got = [(r.p, r.v) for r in grid.densify(df, ["k"], "p", F.lit("2023-12-01").cast("date"), F.lit("2024-05-01").cast("date"),
                                            grid.month_step()).orderBy("p").collect()]
    assert got == [(date(2023, 12, 1), None), (date(2024, 1, 1), 1.0), (date(2024, 2, 1), None), (date(2024, 3, 1), None),
                   (date(2024, 4, 1), 2.0), (date(2024, 5, 1), None)]


@pytest.mark.parametrize("bucket", [5, 60])
def test_carry_matches_brute_force(frame, bucket):
    rng = random.Random(bucket)
    rows = [(rng.choice("ab"), at(m), i, rng.choice([None, None, i])) for i, m in enumerate(rng.sample(range(600), 80))]
    df = frame(rows, "k string, ts timestamp_ntz, id int, v int")
    fwd = {r.id: r.f for r in ordered.carry(df, ["k"], "ts", {"f": F.col("v")}, bucket_minutes=bucket).collect()}
    back = {r.id: r.f for r in ordered.carry(df, ["k"], "ts", {"f": F.col("v")}, bucket_minutes=bucket, backward=True, inclusive=False).collect()}
    for k, ts, i, _ in rows:
        before = [(t, v) for kk, t, _, v in rows if kk == k and t <= ts and v is not None]
        after = [(t, v) for kk, t, _, v in rows if kk == k and t > ts and v is not None]
        assert fwd[i] == (max(before)[1] if before else None)
        assert back[i] == (min(after)[1] if after else None)


def test_asof_matches_brute_force(frame):
    rng = random.Random(7)
    left = [(rng.choice("abc"), at(rng.randrange(500)), i) for i in range(60)]
    right = [(rng.choice("ab"), at(m), m) for m in rng.sample(range(500), 40)]
    got = {r.id: r.v for r in ordered.asof(frame(left, "k string, ts timestamp_ntz, id int"),
                                           frame(right, "k string, rt timestamp_ntz, v int"), ["k"], "ts", "rt", ["v"]).collect()}
    assert len(got) == len(left)
    for k, ts, i in left:
        cand = [(t, v) for kk, t, v in right if kk == k and t <= ts]
        assert got[i] == (max(cand)[1] if cand else None)


def test_streaks(frame):
    values = [0, 0, 5, 5, 5, None, None, 0]
    df = frame([("a", i, v) for i, v in enumerate(values)], "k string, p int, v int")
    got = [r.s for r in ordered.streak_length(df, ["k"], "p", "v", "s").orderBy("p").collect()]
    assert got == [1, 2, 1, 2, 3, 1, 2, 1]
    capped = [r.s for r in ordered.streak_length(df, ["k"], "p", "v", "s", cap=2).orderBy("p").collect()]
    assert max(capped) == 2


def test_overlap_join_matches_brute_force(frame):
    rng = random.Random(11)
    span = lambda: (lambda a: (a, a + rng.randrange(0, 40)))(rng.randrange(300))
    a = [(rng.choice("xy"), i, *map(at, span())) for i in range(40)]
    b = [(rng.choice("xy"), i, *map(at, span())) for i in range(40)]
    got = ranges.overlap_join(frame(a, "k string, i int, a0 timestamp_ntz, a1 timestamp_ntz"),
                              frame(b, "k string, j int, b0 timestamp_ntz, b1 timestamp_ntz"), ["k"], ("a0", "a1"), ("b0", "b1"), 10)
    got = sorted((r.i, r.j) for r in got.collect())
    assert got == sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] <= y[3] and x[3] >= y[2])


def test_bands(frame):
    up = [(0.0, 1), (1.0, 2), (1.02, 3)]
    xs = [None, -0.1, 0.0, 0.99, 1.0, 1.01, 1.02, 9.0]
    df = frame([(x,) for x in xs], "x double")
    fwd = [r[0] for r in df.select(ranges.band_score(F.col("x"), up, True)).collect()]
    back = [r[0] for r in df.select(ranges.band_score(F.col("x"), up, False)).collect()]
    assert fwd == [None, None, 1, 1, 2, 2, 3, 3]
    assert back == [None, 1, 1, 2, 2, 3, 3, None]


def test_calendar(frame):
    df = frame([(date(2016, 12, 25),), (date(2016, 12, 31),), (date(2017, 1, 1),), (date(2016, 12, 20),)], "d date")
    assert [r[0] for r in df.select(tp.week_index("d")).collect()] == [0, 0, 1, 0]
    one = frame([(datetime(2024, 3, 31, 13, 37),)], "t timestamp_ntz").select(
        tp.floor_minutes("t", 15), tp.month_hour("t"), tp.january_hour("t"), tp.fiscal_quarter("t"), tp.quarter_label("t"), tp.last_monday("t")).first()
    assert tuple(one) == (datetime(2024, 3, 31, 13, 30), datetime(2024, 3, 1, 13, 37), datetime(2024, 1, 1, 13, 37), "2024.3", "2024.1", date(2024, 3, 25))
