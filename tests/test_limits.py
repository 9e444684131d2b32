"""Answers that must not depend on hidden limits: units, large shapes, distances, months, dates and missing keys."""

import datetime as dt
import math
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from greenwave.functions import stats, timeparts as tp
from greenwave.operators import alerts as al, counts as ct, rollup as ru, tasks as tk, uptime as up

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("minutes", [45, 90, 300, 0, -15, 7])
def test_units_that_leave_uneven_buckets_are_refused(minutes):
    with pytest.raises(ValueError):
        tp.floor_minutes("t", minutes)


@pytest.mark.parametrize("shape,want", [(1e6, 0.5 + 1 / (3 * math.sqrt(2 * math.pi * 1e6))), (1e7, 0.5 + 1 / (3 * math.sqrt(2 * math.pi * 1e7))),
                                        (5e4, 0.5 + 1 / (3 * math.sqrt(2 * math.pi * 5e4)))])
def test_gamma_of_large_shapes(frame, shape, want):
    got = frame([(shape, shape)], "a double, r double").select(stats.gamma_cdf_at_one(F.col("a"), F.col("r"))).first()[0]
    assert got == pytest.approx(want, abs=1e-7)


def test_gamma_methods_agree_where_they_meet():
    import numpy as np

    a = np.full(9, stats.LARGE_SHAPE)
    x = a + np.linspace(-4, 4, 9) * np.sqrt(a)
    exact = np.where(x < a + 1, stats._gamma_series(a, x, np.array([math.lgamma(v) for v in a])), 1 - stats._gamma_fraction(a, x, np.array([math.lgamma(v) for v in a])))
    assert np.allclose(stats._gamma_large(a, x), exact, atol=1e-8)


def test_approximate_percentile_is_within_its_rank(frame):
    rng = random.Random(2)
    rows = [("k", rng.random()) for _ in range(5000)] + [("none", None)]
    df = frame(rows, "k string, v double")
    got = {r.k: r.p for r in stats.weighted_percentile(df, ["k"], "v", 0.9, "p", accuracy=1000).collect()}
    rank = sum(v <= got["k"] for _, v in rows[:-1]) / 5000
    assert set(got) == {"k"} and abs(rank - 0.9) <= 1 / 1000 + 1 / 5000


def meters(p, q):
    a, b, c, d = map(math.radians, (*p, *q))
    return 2 * tk.EARTH_METERS * math.asin(math.sqrt(min(1.0, math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))


@pytest.mark.parametrize("within,lat,lon", [(100.0, 33.7, -84.4), (900.0, 71.0, 20.0), (5000.0, 0.0, 179.999), (5000.0, 89.98, 0.0), (5000.0, -60.0, -179.99)])
def test_nearest_against_all_pairs(frame, within, lat, lon):
    rng = random.Random(int(within + lat))

    def near(n):
        reach = math.degrees(2 * within / tk.EARTH_METERS)
        out = []
        for k in range(n):
            la = max(-90.0, min(90.0, lat + rng.uniform(-reach, reach)))
            lo = lon + rng.uniform(-reach, reach) / max(0.02, math.cos(math.radians(la)))
            out.append((k, la, (lo + 180) % 360 - 180))
        return out

    points, others = near(60), near(60)
    want = {}
    for k, *p in points:
        best = min(((meters(p, q), j) for j, *q in others), default=None)
        if best and best[0] < within:
            want[k] = best[1]
    schema = "id int, Latitude double, Longitude double"
    got = tk.nearest(frame(points, schema.replace("id", "PointId")), frame(others, schema.replace("id", "OtherId")), "PointId", "OtherId", within).collect()
    assert {r.PointId: r.OtherId for r in got} == want


def test_phase_shares_are_those_of_the_month(frame):
    rows = []
    for month, (x, y) in ((1, (10.0, 30.0)), (2, (30.0, 10.0))):
        for hour in range(4):
            t = dt.datetime(2024, month, 2, hour)
            rows.append((1, 2, 1, t, t, x))
            rows.append((1, 2, 2, t, t, None if hour == 3 else y))
    df = frame(rows, "SignalID int, CallPhase int, Detector int, Timeperiod timestamp_ntz, Month_Hour timestamp_ntz, vol double")
    got = {(r.Timeperiod.month, r.Detector): r.vol for r in ct.adjusted_counts(df).collect() if r.Timeperiod.hour == 3}
    assert got == {(1, 1): 10, (1, 2): 30, (2, 1): 30, (2, 2): 10}


def test_alerts_need_a_corridor_and_name_missing_inputs_zero(frame):
    schema = "Zone_Group string, Zone string, Corridor string, SignalID string, CallPhase string, Detector string, Date date, Alert string, Name string, ApproachDesc string"
    day = dt.date(2024, 1, 2)
    rows = [("g", "z", "c", "1", None, None, day, "Bad Ped", "n", None), ("g", "z", None, "2", "2", "3", day, "Bad Ped", "n", None)]
    got = al.alerts([frame(rows, schema)]).collect()
    assert [(r.SignalID, r.CallPhase, r.Detector, r.streak) for r in got] == [("1", "0", "0", 1)]


CAMERA = "CameraID string, Location string, As_of_Date date, SignalID int, Zone_Group string, Zone string, Corridor string, Subcorridor string"


def test_a_camera_that_is_never_up_brings_the_start(frame):
    first = dt.date(2024, 1, 1)
    cameras = frame([(c, "l", first, 1, "g", "z", "k", "s") for c in ("a", "b")], CAMERA)
    seen = frame([("a", dt.date(2024, 1, 3), 5.0)], "CameraID string, Date date, Size double")
    days = lambda c, s: {(r.CameraID, r.Date.day) for r in up.daily_camera_uptime(seen, c, s).collect()}
    assert days(cameras, "2024-01-01") == {(c, d) for c in "ab" for d in (1, 2, 3)}
    assert days(cameras.where("CameraID = 'a'"), "2024-01-01") == {("a", 3)}


def test_combined_cameras_have_every_date(frame):
    keys = "CameraID string, Date date, up double, num double, uptime double, Corridor string"
    web = frame([("a", dt.date(2024, 1, 1), 1.0, 1.0, 1.0, "k"), ("a", dt.date(2024, 1, 4), 1.0, 1.0, 1.0, "k")], keys)
    encoder = frame([("b", dt.date(2024, 1, 4), 1.0, 1.0, 1.0, "k")], keys)
    got = {(r.CameraID, r.Date.day): r.up for r in up.combined_camera_uptime(web, encoder).collect()}
    assert got == {("a", 1): 2.0, ("a", 4): 2.0, ("b", 1): 0.0, ("b", 4): 1.0}


def test_signals_without_a_corridor_stay(frame):
    corridors = frame([(1, "k", "here", "sign")], "SignalID int, Corridor string, Description string, Name string")
    rows = frame([(1, 5.0), (2, 6.0)], "SignalID int, vpd double")
    cor = frame([("k", "g", 11.0)], "Corridor string, Zone_Group string, vpd double")
    got = {(r.Zone_Group, r.Corridor, r.Description, r.Name, r.vpd) for r in ru.signals_as_corridors(rows, cor, corridors).collect()}
    assert got == {("k", "1", "here", "sign", 5.0), (None, "2", "2", None, 6.0), ("k", "k", "k", None, 11.0)}


def test_python_functions_run_when_spark_starts_elsewhere(tmp_path):
    code = (f"import sys; sys.path.insert(0, {REPO!r})\nimport __spark_entry__ as e\n"
            "from greenwave.session import build_session\n"
            "s = build_session('elsewhere', 'local[2]', **{'spark.ui.enabled': 'false', 'spark.sql.shuffle.partitions': '2'})\n"
            "print('rows', e.queries()['e2_low_press_probability'](s, '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in out.stdout, out.stderr[-2000:]
