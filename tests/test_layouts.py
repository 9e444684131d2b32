"""Order-dependent steps: one read of the events, bounded groups, overlap of spans of any length."""

import random
from datetime import datetime, timedelta

import pytest
from plans import executed, scans

import __spark_entry__ as entry
from greenwave.functions import ranges
from greenwave.functions.ordered import asof, carry
from greenwave.operators import wide
from tests.test_queries import SF

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("name", ["c3_intervals_in_cycle", "g4_traffic_by_metering_rate", "c1_c2_phase_intervals", "c6_cycles", "c7_wide_events", "c17_time_in_state", "g2_metering_rates"])
def test_events_are_read_once(spark, name):
    assert len(scans(entry.queries()[name](spark, SF), "ts#")) == 1


def test_event_etl_needs_no_stored_table(spark):
    from greenwave.operators import cycles
    from greenwave.plans.catalog.cycles import count_config
    from greenwave.sources.adapters import Tables

    t = Tables(spark, SF)
    stored, _ = cycles.event_etl(t.controller_events, count_config(t))
    lazy, _ = cycles.event_etl(t.controller_events, count_config(t), keep=lambda df: df)
    assert len(scans(lazy, "ts#")) == 3
    assert sorted(map(repr, lazy.collect())) == sorted(map(repr, stored.collect()))


def test_layout_is_shared_by_both_readers(spark):
    kinds = [kind for kind, _ in executed(entry.queries()["c1_c2_phase_intervals"](spark, SF))]
    assert "ReusedExchangeExec" in kinds


@pytest.mark.parametrize("backward,inclusive", [(False, True), (False, False), (True, True), (True, False)])
def test_carry_equals_a_walk(frame, backward, inclusive):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, None]), T0 + timedelta(minutes=rng.randrange(600)), k, rng.choice([None, None, k])) for k in range(400)]
    want = []
    for key in (1, 2, None):
        last = None
        for r in sorted((r for r in rows if r[0] == key), key=lambda r: r[1:3], reverse=backward):
            if inclusive and r[3] is not None:
                last = r[3]
            want.append((*r[:3], last))
            if r[3] is not None:
                last = r[3]
    df = frame(rows, "k int, ts timestamp_ntz, n int, v int")
    got = carry(df, ["k"], "ts", {"w": df.v}, order=["n"], backward=backward, inclusive=inclusive).select("k", "ts", "n", "w").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_asof_over_empty_buckets_and_null_keys(frame):
    left = frame([(1, T0 + timedelta(hours=h), h) for h in (0, 3, 9)] + [(None, T0 + timedelta(hours=5), 50)], "k int, t timestamp_ntz, n int")
    right = frame([(1, T0 + timedelta(hours=2), 7), (None, T0, 8)], "k int, u timestamp_ntz, v int")
    assert {r.n: r.v for r in asof(left, right, ["k"], "t", "u", ["v"]).collect()} == {0: None, 3: 7, 9: 7, 50: 8}


@pytest.mark.parametrize("seed,levels", [(1, 1), (2, 3), (3, 5)])
def test_overlap_equals_all_pairs(frame, seed, levels):
    rng = random.Random(seed)

    def spans(n):
        out = []
        for k in range(n):
            lo = rng.randrange(3 * 86400)
            size = rng.choice([0, 1, 40, 300, 3600, 86400, 5 * 86400])
            out.append((rng.choice([1, 1, 2]), k, T0 + timedelta(seconds=lo), None if k == 0 else T0 + timedelta(seconds=lo + rng.choice([size, rng.randrange(size + 1), -1]))))
        return out

    a, b = spans(60), spans(60)
    got = ranges.overlap_join(frame(a, "k int, x int, a0 timestamp_ntz, a1 timestamp_ntz"), frame(b, "k int, y int, b0 timestamp_ntz, b1 timestamp_ntz"), ["k"], ("a0", "a1"), ("b0", "b1"), levels)
    real = lambda r: r[3] is not None and r[2] <= r[3]
    want = sorted((p[0], p[1], q[1]) for p in a for q in b if p[0] == q[0] and real(p) and real(q) and p[2] <= q[3] and p[3] >= q[2])
    assert sorted((r.k, r.x, r.y) for r in got.collect()) == want and len(want) > 100


def test_covers_are_exact_and_small(frame):
    rng = random.Random(5)
    spans = [(a, a + rng.choice([0, 1, 11, 12, 288, 5000])) for a in [rng.randrange(10**7) for _ in range(200)] + [0, -7, -4000]]
    df = frame(spans, "a long, b long")
    for levels, most in ((3, {1: 2, 13: 9, 289: 30}), (6, {1: 2, 13: 9, 289: 24})):
        for r in df.select("a", "b", ranges.cover(df.a, df.b, levels).alias("c")).collect():
            if r.a < 0:
                continue
            cells = [n for x in r.c for n in range(x.cell * 4**x.level, (x.cell + 1) * 4**x.level)]
            assert cells and sorted(cells) == list(range(r.a, r.b + 1))
            assert len(r.c) <= most.get(r.b - r.a + 1, 10**9)


def test_wide_rows_do_not_depend_on_the_buckets(spark, frame):
    rng = random.Random(7)
    codes = [0, 1, 4, 8, 10, 21, 22, 31, 43, 81, 82, 83, 85, 89, 90, 131, 132, 134, 150, 173, 182, 184, 300, 612, 316]
    hot = [(1 if rng.random() < 0.7 else 2, T0 + timedelta(minutes=rng.randrange(0, 3 * 1440, 7)), rng.choice(codes), rng.randrange(1, 5)) for _ in range(3000)]
    events = frame([(s, t, c, p, t.date()) for s, t, c, p in hot], "SignalID int, Timestamp timestamp_ntz, EventCode int, EventParam int, date date").distinct()
    config = frame([(s, d, d, 60.0 * d) for s in (1, 2) for d in (1, 2, 3)], "SignalID int, Detector int, CallPhase int, TimeFromStopBar double")
    by = {m: sorted(map(repr, wide.widen(events, config, m).collect())) for m in (15, 60, 1440)}
    assert by[15] == by[60] == by[1440] and len(by[60]) > 2000
    largest = wide.widen(events, config)  # a signal with two thirds of all events lies in many tasks
    plan = " ".join(text for kind, text in executed(largest) if kind == "ShuffleExchangeExec")
    assert "hashpartitioning(_day" in plan and "_b" in plan
