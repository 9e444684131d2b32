"""Tasks follow the number of rows, one layout serves all steps, and results stay those of plain Python."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

from greenwave.functions import layout
from greenwave.operators import alerts as al, counts as ct, ped, rollup as ru, travel as tv
from plans import executed

T0 = datetime(2024, 1, 1)


def shuffles(df):
    return [text for kind, text in executed(df) if kind == "ShuffleExchangeExec"]


def test_alerts_are_dealt_by_their_number(frame, monkeypatch):
    monkeypatch.setattr(al, "ALERTS_PER_TASK", 25, raising=False)
    schema = ("Zone_Group string, Zone string, Corridor string, SignalID string, CallPhase string, Detector string, Date date, "
              "Name string, Alert string, ApproachDesc string")
    rows = [("Z", "Y", "C", str(s), "2", "1", date(2024, 1, 1) + timedelta(days=d), "n", al.BAD_DETECTOR, "") for s in range(30) for d in range(10)]
    out = al.alerts([frame(rows, schema)])
    assert out.rdd.getNumPartitions() == 12
    assert sorted(r.streak for r in out.collect()) == sorted([*range(1, 11)] * 30)


def test_bad_inputs_come_from_one_layout_by_input(frame):
    rng = random.Random(3)
    daily = [(s, d, 2, date(2024, 1, 1) + timedelta(days=k), float(rng.randrange(40))) for s in (1, 2) for d in (1, 2) for k in range(40) if not (s == 2 and d == 1 and k > 12)]
    hourly = [(1, 1, 2, date(2024, 1, 5), T0 + timedelta(days=4, hours=h), 500.0) for h in range(24)] + [(1, 2, 2, date(2024, 1, 5), T0 + timedelta(days=4, hours=h), 2.0) for h in range(24)]
    corridors = frame([(1, date(2024, 1, 3)), (2, None)], "SignalID int, Asof date")
    out = ped.ped_input_uptime(frame(daily, "SignalID int, Detector int, CallPhase int, Date date, papd double"),
                               frame(hourly, "SignalID int, Detector int, CallPhase int, Date date, Hour timestamp_ntz, paph double"), corridors, "2024-01-01")
    got = {(r.SignalID, r.Detector, r.Date.day + 31 * (r.Date.month - 1)): r for r in out.collect()}
    assert len(got) == 2 * 38 + 2 * 40
    assert [k for k, r in got.items() if r.probhigh] == [(1, 1, 5)] and got[1, 1, 5].uptime == 0
    assert all(got[2, 1, k].uptime == 0 for k in range(30, 41)) and got[2, 1, 10].uptime == 1
    # neither the weekday nor the day is a key of the tasks
    assert not any("weekday" in text or "streak_id" in text for text in shuffles(out))


def _month(detectors=3):
    rng = random.Random(5)
    return [(s, T0 + timedelta(hours=h), d, 2, rng.randrange(1, 100)) for s in (1, 2) for d in range(1, detectors + 1) for h in range(72)
            if not (d == 1 and 24 <= h < 48)]


def test_filled_counts_move_once(frame):
    counts = frame(_month(), "SignalID int, Timeperiod timestamp_ntz, Detector int, CallPhase int, vol long")
    config = frame([(s, d, 2, "EB") for s in (1, 2) for d in (1, 2, 3)], "SignalID int, Detector int, CallPhase int, ApproachDesc string")
    out = ct.adjusted_counts(ct.filtered_counts(counts, config))
    moved = shuffles(out)
    assert sum("hashpartitioning(SignalID" in text and "CallPhase" in text and "Detector" not in text for text in moved) == 1
    assert not any("Timeperiod" in text.split("hashpartitioning(")[-1].split("),")[0] for text in moved)
    got = out.collect()
    assert len(got) == 2 * 3 * 72 and all(r.vol > 0 for r in got if r.Detector > 1)
    total, filled = defaultdict(float), {}
    for s, t, d, _, v in _month():
        if t.day != 2:
            total[s, d] += v
    known = {(s, t, d): v for s, t, d, _, v in _month()}
    for r in got:
        if r.Detector == 1 and r.Timeperiod.day == 2:
            share = {d: total[r.SignalID, d] / sum(total[r.SignalID, e] for e in (1, 2, 3)) for d in (1, 2, 3)}
            whole = sum(known[r.SignalID, r.Timeperiod, d] / share[d] for d in (2, 3)) / 2
            filled[r.SignalID, r.Timeperiod] = (r.vol, int(round(whole * share[1], 6)))
    assert len(filled) == 48 and all(a == b for a, b in filled.values())


def test_travel_times_follow_their_number(frame, monkeypatch):
    monkeypatch.setattr(layout, "ROWS_PER_TASK", 50)
    monkeypatch.setattr(layout.laid_out, "__defaults__", (50,))
    rows = [(f"t{k % 40}", T0 + timedelta(hours=k // 40), 30.0, float(1 + k % 7), 40.0) for k in range(400)]
    readings = frame(rows + rows[:100], "tmc_code string, Hour timestamp_ntz, reference_speed double, travel_time_minutes double, speed double")
    segments = frame([(f"t{k}", 1.0 + k, f"C{k % 5}", "S") for k in range(40)] * 2, "tmc_code string, miles double, Corridor string, Subcorridor string")
    times = tv.segment_travel_times(readings, segments)
    assert times.count() == 400
    out = tv.travel_time_metrics(tv.corridor_travel_times(times), rows=500)
    assert out.rdd.getNumPartitions() == 10 and len(out.collect()) == 5 * 10


def test_corridor_rows_meet_their_zones_after_they_moved(frame):
    rng = random.Random(9)
    corridors = [(s, f"G{z}", f"Z{z}", c, f"S{s}") for s in range(12) for z in range(s % 3 + 1) for c in ([f"C{s % 4}"] + (["C9"] if s == 5 else []))] + [(0, "G0", "Z0", "C0", "twice"), (3, None, None, "C7", ""), (4, "G", "Z", None, "")]
    daily = [(s, p, date(2024, 1, 1 + d), None if rng.random() < 0.1 else rng.random(), float(rng.randrange(5))) for s in (*range(13), None) for p in (2, 4) for d in range(6)]
    c = frame(corridors, "SignalID int, Zone_Group string, Zone string, Corridor string, Subcorridor string")
    d = frame(daily, "SignalID int, CallPhase int, Date date, uptime double, `all` double")
    key = lambda r: [str(x) if x is None or not isinstance(x, float) else f"{x:.9f}" for x in r]
    plain = sorted(map(key, ru.corridor_means(d, c, "uptime", "Date", "all").collect()))
    out = ru.corridor_means(d, c, "uptime", "Date", "all", rows=len(daily))
    assert sorted(map(key, out.collect())) == plain and len(plain) > 60
    assert not any("Date" in text.split("hashpartitioning(")[-1].split("),")[0] for text in shuffles(out))


def test_hours_of_a_signal_move_once(spark):
    from greenwave.plans.catalog.travel import cor_vph
    from greenwave.sources.adapters import Tables

    moved = shuffles(cor_vph(Tables(spark, "/root/testdata/sf0.001")))
    assert sum("hashpartitioning(SignalID" in text for text in moved) == 1
    assert not any("CallPhase" in text or "Date_Hour" in text for text in moved)


def test_weights_move_by_corridor_only(spark):
    from greenwave.plans.catalog.travel import cor_vph, weighted
    from greenwave.sources.adapters import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    keyed = lambda df: [text.split("hashpartitioning(")[-1].split("),")[0] for text in shuffles(df)]
    assert not any("Hour" in text for text in keyed(cor_vph(t)))
    assert not any("Hour" in text or "hr#" in text for text in keyed(weighted(t)))


def test_weights_of_places_and_hours_that_are_unknown(frame):
    hour = lambda d, h: datetime(2024, 1, d, h)
    ti = frame([(c, hour(1, h), 2.0) for c in ("a", "b", "none") for h in (7, 8)] + [("a", None, 3.0)], "Corridor string, Hour timestamp_ntz, tti double")
    corridors = frame([("g", "z", "a"), ("g", "z", "a"), ("g", "y", "a"), ("g", None, "b")], "Zone_Group string, Zone string, Corridor string")
    vph = [("g", "z", "a", hour(1, 7), 1.0), ("g", "z", "a", hour(1, 9), 3.0), ("g", None, "b", hour(1, 7), 5.0), ("g", None, "b", hour(1, 9), 5.0), ("g", "z", "a", None, 4.0)]
    out = tv.weighted_travel_index(ti, frame(vph, "Zone_Group string, Zone string, Corridor string, Hour timestamp_ntz, vph double"), corridors)
    got = sorted(((r.Corridor, r.Zone or "", -1 if r.hr is None else r.hr, r.tti, r.pct) for r in out.collect()))
    one = [("a", "y", -1, 3.0, 1.0), ("a", "y", 7, 2.0, 1.0), ("a", "y", 8, 2.0, 1.0), ("a", "z", -1, 3.0, 1.0), ("a", "z", 7, 2.0, 0.25),
           ("a", "z", 8, 2.0, 1.0), ("b", "", 7, 2.0, 1.0), ("b", "", 8, 2.0, 1.0), ("none", "", 7, 2.0, 1.0), ("none", "", 8, 2.0, 1.0)]
    assert got == one
