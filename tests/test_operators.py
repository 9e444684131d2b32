"""Operators on hand-built rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from greenwave.operators import alerts as al, config as cfg, counts as ct, cycles as cy, health as hl, ped, rollup as ru, tasks as tk, travel as tv, wide as wd
from greenwave.sources import scan, sinks

D = date(2024, 1, 2)
T0 = datetime(2024, 1, 2)
COUNTS = "SignalID int, Timeperiod timestamp_ntz, Detector int, CallPhase int, vol int"
CONFIG = "SignalID int, Detector int, CallPhase int, ApproachDesc string, CountPriority int"
EVENTS = "SignalID int, Timestamp timestamp_ntz, EventCode int, EventParam int, date date"


def s(sec):
    return T0 + timedelta(seconds=sec)


def ev(rows):
    return [(1, s(t), c, p, D) for t, c, p in rows]


def hours(values, detector=1, signal=1, phase=2):
    return [(signal, T0 + timedelta(hours=h), detector, phase, v) for h, v in enumerate(values) if v is not None]


# ---- counts -----------------------------------------------------------------
def _flags(frame, values, approach="EB Side"):
    df = ct.filtered_counts(frame(hours(values), COUNTS), frame([(1, 1, 2, approach, 1)], CONFIG))
    rows = df.collect()
    assert len(rows) == 24
    return rows[0]


VARIED = [10 + h for h in range(24)]


def test_five_flat_hours_are_good_and_six_are_bad(frame):
    five = VARIED[:8] + [50] * 5 + VARIED[13:]
    six = VARIED[:8] + [50] * 6 + VARIED[14:]
    assert (_flags(frame, five).flat_strk, _flags(frame, five).Good_Day) == (5, 1)
    assert (_flags(frame, six).flat_strk, _flags(frame, six).Good_Day) == (6, 0)


def test_flat_hours_before_five_do_not_count(frame):
    assert _flags(frame, [7] * 5 + VARIED[5:]).Good_Day == 1


def test_high_volume_and_mainline_limits(frame):
    high = [100 + h for h in range(24)]
    for h in (6, 8, 10, 12, 14, 16):
        high[h] = 1300
    side, main = _flags(frame, high), _flags(frame, high, "NB Mainline")
    assert (side.maxvol_flag, side.mad_flag) == (1, 1)
    assert (main.maxvol_flag, main.mad_flag) == (0, 1)


def test_detector_missing_from_config_has_unknown_verdict(frame):
    counts = hours(VARIED) + hours([10, 20, 30], detector=9)
    df = ct.filtered_counts(frame(counts, COUNTS), frame([(1, 1, 2, "EB", 1)], CONFIG))
    rows = df.where("Detector = 9").collect()
    assert len(rows) == 3 and all(r.Good_Day is None and r.vol is None for r in rows)


def test_adjusted_counts_fill_from_sibling_then_median(frame):
    schema = "SignalID int, CallPhase int, Detector int, Timeperiod timestamp_ntz, Month_Hour timestamp_ntz, vol double"
    mh = lambda d, h: (datetime(2024, 1, d, h), datetime(2024, 1, 1, h))
    rows = [(1, 2, 1, *mh(2, 8), 30.0), (1, 2, 2, *mh(2, 8), 10.0),   # shares 3/4 and 1/4
            (1, 2, 1, *mh(9, 8), 60.0), (1, 2, 2, *mh(9, 8), None),   # 60 / 0.75 * 0.25 = 20
            (1, 2, 1, *mh(16, 8), None), (1, 2, 2, *mh(16, 8), None),  # medians of the same weekday hour
            (1, 2, 1, *mh(3, 9), 5000.0), (1, 2, 2, *mh(3, 9), None)]  # estimate over 3000 is not used
    got = {(r.Detector, r.Timeperiod.day): r.vol for r in ct.adjusted_counts(frame(rows, schema)).collect()}
    assert got == {(1, 2): 30, (2, 2): 10, (1, 9): 60, (2, 9): 20, (1, 16): 45, (2, 16): 15, (1, 3): 5000}


def test_gap_uptime(frame):
    rows = [(1, T0 + timedelta(minutes=m), 1, 1, D) for m in [*range(0, 600, 10), *range(720, 1440, 10)]]
    got = ct.gap_uptime(frame(rows, EVENTS)).first().uptime
    assert got == pytest.approx(1 - 130 / 1440)


# ---- cycles -----------------------------------------------------------------
def pairs(frame, rows, codes):
    df = cy.event_pairs(frame(ev(rows), EVENTS), codes)
    return sorted((r.EventCode, (r.StartTimeStamp - T0).total_seconds(), r.Duration) for r in df.collect())


def test_pair_takes_latest_start_and_earliest_end(frame):
    assert pairs(frame, [(0, 1, 2), (10, 1, 2), (30, 8, 2), (40, 8, 2)], ((1, 8),)) == [(1, 10.0, 20.0)]


def test_pair_of_one_instant_and_across_hours(frame):
    rows = [(5, 1, 2), (5, 8, 2), (3500, 1, 2), (3700, 8, 2)]
    assert pairs(frame, rows, ((1, 8),)) == [(1, 5.0, 0.0), (1, 3500.0, 200.0)]


def test_equal_codes_pair_with_the_next_event(frame):
    assert pairs(frame, [(0, 1, 2), (60, 1, 2), (90, 1, 4)], ((1, 1),)) == [(1, 0.0, 60.0)]


ETL = [(0, 31, 1), (1, 1, 4), (20, 8, 4), (20, 4, 4), (24, 9, 4), (60, 1, 4), (61, 31, 1), (5, 82, 7), (7, 81, 7), (21, 82, 7), (22, 81, 7)]
DET = "SignalID int, Detector int, CallPhase int, TimeFromStopBar double, CountDetector boolean, DetectionTypeDesc string"


def test_event_etl(frame):
    cycles, det = cy.event_etl(frame(ev(ETL), EVENTS), frame([(1, 7, 4, 1.0, True, "Stop Bar Presence")], DET))
    got = {r.EventCode: (r.Duration, r.Volume, r.TermType) for r in cycles.collect()}
    assert got == {1: (19.0, 1, 4), 8: (4.0, 1, 0), 9: (36.0, 0, 0)}
    assert sorted((r.EventCode, r.DetTimeInPhase, r.DetDuration) for r in det.collect()) == [(1, 5.0, 2.0), (8, 2.0, 1.0)]


def test_occupancy_edges(frame):
    det = frame([(1, 4, 1, s(0), s(10)), (1, 4, 2, s(20), s(25)), (1, 4, 1, s(28), s(40))], "SignalID int, Phase int, Detector int, DetOn timestamp_ntz, DetOff timestamp_ntz")
    iv = frame([(1, 4, s(0), s(10), s(30)), (1, 4, s(100), s(100), s(120))], "SignalID int, Phase int, CycleStart timestamp_ntz, IntervalStart timestamp_ntz, IntervalEnd timestamp_ntz")
    got = {(r.CycleStart - T0).total_seconds(): r.occ for r in cy.occupancy(det, iv).collect()}
    assert got == {0.0: pytest.approx(0.25), 100.0: 0.0}


def test_arrivals_on_green_carries_intervals_over_the_hour(frame):
    schema = "SignalID int, date date, Phase int, Detector int, CycleStart timestamp_ntz, PhaseStart timestamp_ntz, EventCode int, DetTimeStamp timestamp_ntz, DetDuration double, DetTimeInCycle double, DetTimeInPhase double"
    row = lambda start, code, t: (1, D, 2, 1, s(0), s(start), code, s(t), 1.0, 0.0, 0.0)
    rows = [row(3000, 1, 3100), row(3000, 1, 3700), row(4500, 9, 4600), row(5400, 1, 5500)]
    conf = frame([(1, 1, 2, "Advanced Count")], "SignalID int, Detector int, CallPhase int, DetectionTypeDesc string")
    got = {r.Date_Hour.hour: (r.aog, r.pr, r.vol) for r in cy.arrivals_on_green(frame(rows, schema), conf).collect()}
    assert got[0] == (1.0, 1.0, 1)
    # second hour: green 900 s, red 900 s, green 1800 s; two of three arrivals on green
    assert got[1] == (pytest.approx(2 / 3), pytest.approx((2 / 3) / 0.75), 3)


def test_flash_and_ped_delay(frame):
    flash = frame(ev([(0, 173, 2), (10, 173, 2), (20, 173, 5), (50, 173, 2)]), EVENTS)
    got = [(r.EventParam, r.FlashDuration, r.EndParam) for r in cy.flash_events(flash).collect()]
    assert got == [(5, 30.0, 2)]
    free = frame(ev([(0, 45, 2), (40, 21, 2), (100, 45, 2), (500, 21, 2)]), EVENTS)
    r = cy.ped_delay(free).first()
    assert (r.Pattern, r.Avg_Max_Ped_Delay, r.Events) == ("Free", 40.0, 1)
    coord = frame(ev([(0, 132, 90), (10, 22, 2), (70, 21, 2), (80, 22, 2), (300, 21, 2)]), EVENTS)
    r = cy.ped_delay(coord).first()
    assert (r.Pattern, r.Avg_Max_Ped_Delay, r.Events) == ("Coordinated", 60.0, 1)


def test_wide_events(frame):
    rows = [(0, 183, 5), (1, 31, 1), (2, 0, 2), (3, 1, 2), (4, 82, 7), (6, 81, 7), (8, 182, 1), (9, 8, 2), (10, 84, 7), (11, 82, 7), (12, 83, 7), (13, 90, 3), (15, 89, 3)]
    conf = frame([(1, 7, 2, 0.0)], "SignalID int, Detector int, CallPhase int, TimeFromStopBar double")
    got = {(r.Timestamp - T0).seconds: r for r in wd.widen(frame(ev(rows), EVENTS), conf).collect()}
    assert got[4].Interval == 1 and got[4].DetectorDuration == 2.0 and got[4].PhaseStart == s(2) and got[4].CycleStart == s(1)
    assert got[4].PowerFailure == 5 and got[9].PowerFailure is None
    assert got[11].DetectorFault == 7 and got[11].DetectorOff is None and got[12].DetectorFault is None
    assert got[13].PedInputDuration == 2.0 and 6 not in got and 15 not in got


def test_channel_phase_mapping_needs_single_matches(frame):
    tick = timedelta(seconds=0.1)
    rows = [(1, s(0), 82, 5, D), (1, s(0) + tick, 43, 2, D), (1, s(9), 82, 5, D), (1, s(9), 82, 6, D), (1, s(9) + tick, 43, 4, D)]
    got = cfg.channel_phase_mapping(frame(rows, EVENTS)).collect()
    assert [tuple(r) for r in got] == [(1, 5, 2)]


# ---- pedestrian inputs ------------------------------------------------------
def test_zero_streaks_and_leading_zeros(frame):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(30)]
    presses = [0, 0] + [50, 60, 55, 40, 65, 50, 45, 60, 55, 50] + [0] * 6 + [50, 60, 55, 40, 65, 50, 45, 60, 55, 50, 40, 30]
    rows = [(1, 1, 2, d, float(p)) for d, p in zip(days, presses) if p] + [(2, 1, 2, d, 10.0) for d in days]
    papd = frame(rows, "SignalID int, Detector int, CallPhase int, Date date, papd double")
    paph = frame([(1, 1, 2, datetime(2024, 1, 3, 8), 5.0)], "SignalID int, Detector int, CallPhase int, Hour timestamp_ntz, paph double")
    cor = frame([(1, date(2000, 1, 1))], "SignalID int, Asof date")
    got = {r.Date: r for r in ped.ped_input_uptime(papd, paph, cor, "2024-01-01").where("SignalID = 1").collect()}
    assert len(got) == 30
    assert got[days[0]].uptime == 1 and got[days[0]].problow == 0       # never pressed yet
    assert all(got[d].uptime == 0 and got[d].problow > 0.99 for d in days[12:18])
    assert got[days[20]].problow == 0


def test_too_high_rules(frame):
    schema = "SignalID int, Detector int, CallPhase int, Hour timestamp_ntz, paph double"
    h = lambda n: datetime(2024, 1, 1, n)
    rows = [(1, 1, 2, h(2), 301.0), (1, 2, 4, h(2), 61.0), (1, 2, 4, h(3), 61.0), (1, 2, 4, h(4), 61.0)]      # early hours
    rows += [(2, 1, 2, h(n), 900.0) for n in range(8, 12)] + [(2, 2, 4, h(n), 2.0) for n in range(8, 12)]      # outlier against 2 presses
    rows += [(3, 1, 2, h(n), 500.0) for n in range(8, 12)]                                                     # alone at its signal
    got = {(r.SignalID, r.Detector) for r in ped.too_high(frame(rows, schema)).collect()}
    assert got == {(1, 1), (1, 2), (2, 1)}


# ---- roll-ups ---------------------------------------------------------------
MONTHLY = "SignalID int, CallPhase int, Date date, v double, w double"


def test_gap_months(frame):
    rows = [(1, 2, date(2024, 1, 5), 10.0, 1.0), (1, 2, date(2024, 3, 5), 20.0, 1.0), (1, 6, date(2024, 1, 5), 4.0, 1.0)]
    plain = [(r.Month.month, r.v, r.delta) for r in ru.monthly_avg_by_day(frame(rows, MONTHLY), "v").orderBy("Month").collect()]
    assert plain == [(1, 14.0, None), (2, 0.0, -1.0), (3, 20.0, None)]
    weighted = [(r.Month.month, r.v, r.w) for r in ru.monthly_avg_by_day(frame(rows, MONTHLY), "v", "w").orderBy("Month").collect()]
    assert weighted == [(1, 7.0, 2.0), (2, None, 0.0), (3, 20.0, 1.0)]


def test_group_rows_and_bounds(frame):
    rows = [(1, date(2024, 1, 2), 10.0), (2, date(2024, 1, 2), 30.0), (3, date(2024, 1, 2), 50.0)]
    cor = frame([(1, "R1", "Z1", "A"), (2, "R1", "Z1", "B"), (3, "R2", "Z2", "C")], "SignalID int, Zone_Group string, Zone string, Corridor string")
    got = {(r.Zone_Group, r.Corridor): r.v for r in ru.cor_weekly_avg_by_day(
        frame(rows, "SignalID int, Date date, v double"), cor, "v", extra={"All": ("Zone_Group", ("R1", "R2"))}).collect()}
    assert got == {("Z1", "A"): 10.0, ("Z1", "B"): 30.0, ("Z2", "C"): 50.0, ("Z1", "Z1"): 20.0, ("Z2", "Z2"): 50.0, ("All", "All"): 30.0}


# ---- tasks, alerts, health --------------------------------------------------
def test_backlog_by_age(frame):
    schema = "Zone_Group string, Zone string, Corridor string, Date_Reported date, Date_Resolved date"
    rows = [("G", "Z", "C", date(2024, 1, 1), None), ("G", "Z", "C", date(2024, 3, 30), date(2024, 3, 31)),
            ("G", "Z", "C", date(2024, 3, 1), date(2024, 3, 11))]
    got = {(r.Corridor): r for r in tk.outstanding_by_age(frame(rows, schema), F.array(F.lit("2024-03-01").cast("date")), "2023-01-01").collect()}
    r = got["C"]
    # the task resolved on the last day counts neither as outstanding nor as resolved
    assert (r.over45, r.over90, r.num_outstanding, r.num_resolved, r.mttr) == (1, 0, 1, 1, 10.0)
    assert set(got) == {"C", "G"}


def test_monthly_backlog_in_gap_months(frame):
    schema = "Zone_Group string, Corridor string, p string, Date date, Reported int, Resolved int, cum_Reported int, cum_Resolved int, Outstanding int"
    rows = [("G", "C", "x", date(2024, 1, 9), 2, 1, 2, 1, 1), ("G", "C", "y", date(2024, 2, 9), 1, 0, 1, 0, 1)]
    pick = lambda df: {(r.p, r.Month.month): (r.Reported, r.cum_Reported, r.cum_Resolved, r.Outstanding) for r in df.collect()}
    assert pick(tk.outstanding_by_month(frame(rows, schema), "p")) == {("x", 1): (2, 2, 1, 1), ("x", 2): (0, 2, 0, 0), ("y", 1): (0, 0, 0, 0), ("y", 2): (1, 1, 0, 1)}
    assert pick(tk.outstanding_by_month(frame(rows, schema), "p", carry_all=True))[("x", 2)] == (0, 2, 1, 1)


def test_alert_streaks(frame):
    schema = "Zone_Group string, Zone string, Corridor string, SignalID string, CallPhase string, Detector string, Date date, Name string, Alert string, ApproachDesc string"
    days = [1, 2, 4, 5, 6]
    rows = [("G", "Z", "C", "1", "2", "3", date(2024, 1, d), "n", al.BAD_DETECTOR, "NB" if d == 5 else None) for d in days]
    rows += [("G", al.RAMP_ZONE, "C", "9", "2", d, date(2024, 1, 1), "n", al.BAD_DETECTOR, a) for d, a in (("46", "Mainline-Lead Lane 1"), ("49", "Mainline-Trail Lane 1"))]
    out = al.alerts([frame(rows, schema)]).collect()
    got = {r.Date.day: (r.streak, r.ApproachDesc) for r in out if r.SignalID == "1"}
    assert got == {1: (1, "NB"), 2: (2, "NB"), 4: (1, "NB"), 5: (2, "NB"), 6: (3, "")}
    assert {(r.Detector, r.CallPhase) for r in out if r.SignalID == "9"} == {("46/49", "Mainline")}


def test_health_weights(frame):
    cols = "Zone_Group string, Zone string, Corridor string, Subcorridor string, Month date, Context int, du double, pau double, cu double, cctv double, flash_events double, pr double, pd double, sf_freq double, tti double, pti double, cri double, kabco double, rsi double, bpsi double"
    row = ("G", "Z", "C", "S", date(2024, 1, 1), 1, 0.95, None, 0.97, 0.0, None, 1.0, 30.0, 0.05, 1.2, 1.3, 2.0, 150.0, 0.9, 0.35)
    out = hl.percent_health(hl.scored(frame([row], cols)), "maintenance").where("Subcorridor = 'S'").first()
    # detection 9*25, comm 7*40, cctv 1*10, no flash event 10*10; pedestrian inputs unknown
    assert out.Percent_Health == pytest.approx((225 + 280 + 10 + 100) / 85 / 10)
    assert out.Missing_Data == pytest.approx(0.15)


def test_delay_cost_trend(frame):
    rows = [("Z", "C", datetime(y, m, 3, 5), v) for y, m, v in ((2023, 1, 10.0), (2023, 12, 20.0), (2024, 1, 30.0))]
    got = {r.Month: r for r in tv.delay_cost_trend(frame(rows, "Zone string, Corridor string, date timestamp_ntz, delay_cost double")).collect()}
    r = got[date(2024, 1, 1)]
    assert (r.current_month, r.last_month, r.last_year, r.month_over_month, r.year_over_year) == (30.0, 20.0, 10.0, 0.5, 2.0)


def test_nearest_signal_matches_brute_force(frame):
    import math
    import random

    rng = random.Random(5)
    sig = [(i, 33 + rng.random() * 0.01, -84 - rng.random() * 0.01) for i in range(40)]
    loc = [(i, 33 + rng.random() * 0.01, -84 - rng.random() * 0.01) for i in range(60)]

    def m(a, b):
        p, q = map(math.radians, (a[1], b[1]))
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * tk.EARTH_METERS * math.asin(math.sqrt(h))

    want = {a[0]: min((m(a, b), b[0]) for b in sig) for a in loc}
    want = {k: v[1] for k, v in want.items() if v[0] < 100}
    got = {r.LocationId: r.SignalID for r in tk.nearest(frame(loc, "LocationId int, Latitude double, Longitude double"),
                                                        frame(sig, "SignalID int, Latitude double, Longitude double"), "LocationId", "SignalID").collect()}
    assert got == want and want


# ---- sources and sinks ------------------------------------------------------
def test_upsert_twice_is_the_same(frame):
    schema = "SignalID int, Month date, v double, delta double"
    old = frame([(1, date(2024, m, 1), float(m), None) for m in range(1, 6)], schema)
    new = frame([(1, date(2024, m, 1), 10.0 * m, None) for m in range(4, 8)], schema)
    once = sinks.merge_window(old, new, "v", "2024-02-01", "2024-05-01")
    twice = sinks.merge_window(once, new, "v", "2024-02-01", "2024-05-01")
    pick = lambda df: sorted((r.Month.month, r.v, r.delta) for r in df.collect())
    assert pick(once) == pick(twice)
    assert [r[0] for r in pick(once)] == [2, 3, 4, 5, 6, 7] and pick(once)[3][1:] == (50.0, 11.5)


def test_versions_and_dates_on_disk(spark, frame, tmp_path):
    schema = "SignalID int, Month date, v double, delta double"
    old = frame([(1, date(2024, 1, 1), 1.0, None)], schema)
    new = frame([(1, date(2024, 2, 1), 3.0, None)], schema)
    root = str(tmp_path / "tables")
    sinks.merge_batch(spark, [(old, "t", "v", "2024-01-01", "2024-01-01")], root)
    sinks.merge_batch(spark, [(new, "t", "v", "2024-01-01", "2024-02-01")], root)
    got = spark.read.parquet(sinks.latest_version(spark, root, "t")).orderBy("Month").collect()
    assert [(r.v, r.delta) for r in got] == [(1.0, None), (3.0, 2.0)]

    table = str(tmp_path / "counts")
    day = lambda d, v: (1, datetime(2024, 1, d, 5), 1, 2, v)
    sinks.write_by_date(frame([day(1, 5), day(2, 6)], COUNTS), table)
    sinks.write_by_date(frame([day(2, 9)], COUNTS), table)
    back = scan.read_range(spark, table, "2024-01-01", "2024-01-02")
    assert sorted((r.Date.day, r.vol) for r in back.collect()) == [(1, 5), (2, 9)]
    only = scan.read_range(spark, table, "2024-01-02", "2024-01-02", ["1"])
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and [r.vol for r in only.collect()] == [9]
    more = scan.read_range(spark, table, "2024-01-01", "2024-01-02", callback=lambda df: df.groupBy("Date").agg(F.sum("vol").alias("vol")))
    assert sorted((r.Date.day, r.vol) for r in more.collect()) == [(1, 5), (2, 9)]
    hidden = str(tmp_path / "hidden")
    sinks.write_by_date(frame([day(1, 5)], COUNTS).withColumn("__index", F.lit(0)), hidden)
    assert "__index" not in scan.read_range(spark, hidden, "2024-01-01", "2024-01-01").columns
    sinks.export_csv(frame([day(1, 5)], COUNTS), str(tmp_path / "csv"))
    assert [r.vol for r in spark.read.csv(str(tmp_path / "csv"), header=True).collect()] == ["5"]
    inv = {r.table: r.files for r in scan.inventory(spark, str(tmp_path)).where("table = 'counts'").groupBy("table").agg(F.sum("files").alias("files")).collect()}
    assert inv["counts"] >= 2


def test_nightly_tables_from_one_tally_equal_direct_ones(frame):
    at = lambda m, s=0: datetime(2024, 1, 2, 7, m, s)
    rows = [(1, at(m, s), c, p, date(2024, 1, 2)) for m, s, c, p in
            [(1, 0, 82, 3), (1, 0, 82, 3), (1, 5, 82, 3), (20, 0, 82, 3), (20, 0, 82, 9), (3, 0, 90, 3), (4, 0, 502, 10), (5, 0, 502, 100), (5, 0, 502, 100),
             (6, 0, 502, -1), (7, 0, 503, 40), (8, 0, 503, 10), (9, 0, 81, 3)]]
    events = frame(rows, "SignalID int, Timestamp timestamp_ntz, EventCode int, EventParam int, date date")
    config = frame([(1, 3, 2, "Mainline")], "SignalID int, Detector int, CallPhase int, ApproachDesc string")
    stored = []
    made = ct.daily_count_products(events, config, config, keep=lambda df: stored.append(df) or df)
    assert len(made) == 12 and len(stored) == 1
    same = lambda a, b: sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))
    assert same(made["comm_uptime"], ct.comm_uptime(events))
    for name, unit in (("counts_1hr", "1 hour"), ("counts_15min", "15 min")):
        assert same(made[name], ct.counts_by_phase(events, config, 82, unit))
    assert [r.vol for r in made["counts_ped_1hr"].collect()] == [1]


def test_tasks_csv(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("TaskID,Date_Reported\n1,01/02/2024 08:00:00 AM\n2,01/01/2020 08:00:00 AM\n")
    b.write_text("TaskID,Date_Reported\n1,01/02/2024 08:00:00 AM\n3,02/02/2024 01:30:00 PM\n")
    got = scan.read_tasks_csv(spark, [str(a), str(b)], "TaskID int, Date_Reported timestamp_ntz", "2023-01-01")
    assert sorted((r.TaskID, r.Date_Reported) for r in got.collect()) == [(1, datetime(2024, 1, 2, 8)), (3, datetime(2024, 2, 2, 13, 30))]


def test_reconcile_counts_repeats_and_null_keys(frame):
    left = frame([(1, None), (1, None), (2, 5)], "a int, b int")
    right = frame([(1, None), (3, 6)], "a int, b int")
    got = {(r.a, r.b): (r.left_rows, r.right_rows, r.side) for r in sinks.reconcile(left, right, ["a", "b"]).collect()}
    assert got == {(1, None): (2, 1, "both"), (2, 5): (1, 0, "left"), (3, 6): (0, 1, "right")}


def test_weekly_shard_and_rules(spark, frame):
    assert scan.weekly_shard("events", "2024-01-03") == "events_2024_01"
    one = spark.range(1).select(scan.parse_date_rule("yesterday", "2024-03-01").alias("a"), scan.parse_date_rule("3 days ago", "2024-03-01").alias("b")).first()
    assert tuple(one) == (date(2024, 2, 29), date(2024, 2, 27))
