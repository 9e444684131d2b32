"""Stored partial results: sketches, partial sums, incremental tallies, hash trees."""

import random
from collections import Counter
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pytest
from plans import executed, scans
from pyspark.sql import functions as F

from greenwave.functions import sketches as sk
from greenwave.operators import counts as ct, rollup as ru
from greenwave.operators.lattice import lattice, partial_sums
from greenwave.plans.catalog.serve import details
from greenwave.session import new_table_path, stored
from greenwave.sources import incremental as inc, sinks

T0 = datetime(2024, 1, 1)
EVENTS = "SignalID int, Timestamp timestamp_ntz, EventCode int, EventParam int, date date"


def test_merged_sketches_keep_the_rank(spark):
    rows = spark.range(200_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 50).alias("day"), F.when(F.col("id") % 97 != 0, F.hash("id") % 100_000).alias("x"))
    daily = sk.quantile_sketches(rows, ["k", "day"], "x")
    merged = sk.merged_sketches(daily, ["k"])
    for p in (0.01, 0.5, 0.95):
        est = merged.select("k", "n", sk.sketch_quantile(p).alias("q"))
        checked = sk.with_exact_rank(est, rows, ["k"], "x", "q").select("n", sk.rank_within(p).alias("ok"), (F.col("_up_to") - p).alias("off")).collect()
        assert len(checked) == 3 and all(r.ok for r in checked) and sum(r.n for r in checked) == rows.where("x IS NOT NULL").count()
    wrong = sk.with_exact_rank(merged.select("k", sk.sketch_quantile(0.5).alias("q")), rows, ["k"], "x", "q").select(sk.rank_within(0.6).alias("ok")).collect()
    assert not any(r.ok for r in wrong)


def test_small_groups_are_exact(frame):
    rows = frame([(1, float(k)) for k in range(101)] + [(2, None)], "k int, x double")
    got = sk.merged_sketches(sk.quantile_sketches(rows, ["k", (F.col("x") % 7).alias("part")], "x"), ["k"]).select("k", sk.sketch_quantile(0.5).alias("q")).collect()
    assert [(r.k, r.q) for r in got] == [(1, 50.0)]


def test_all_levels_read_the_facts_once(spark, frame):
    rng = random.Random(2)
    rows = [(s, p, date(2024, 1, 1) + timedelta(days=d), 366 + d // 7, datetime(2024, 1, 1, h) + timedelta(days=d), rng.choice([None, 0.5, 0.25]), float(rng.randrange(1, 9)))
            for s in (1, 2) for p in (2, 4) for d in (0, 1, 9, 40) for h in (7, 12, 17)]
    path = new_table_path(spark, "facts")
    frame(rows, "SignalID int, CallPhase int, Date date, Week int, Date_Hour timestamp_ntz, x double, w double").write.parquet(path)
    corridors = frame([(1, "C1", "Z1", "G"), (2, "C1", "Z1", "G")], "SignalID int, Corridor string, Zone string, Zone_Group string")
    lazy = lattice(spark.read.parquet(path), corridors, "x", "w", keep=lambda df: df)
    stored = lattice(spark.read.parquet(path), corridors, "x", "w")
    assert not scans(stored, "Date_Hour")  # only the stored sums
    assert len(scans(partial_sums(spark.read.parquet(path), "x", "w"), "Date_Hour")) == 1
    assert sorted(map(repr, lazy.collect())) == sorted(map(repr, stored.collect()))
    weeks = {(r.name, r.period): (r.x, r.w) for r in stored.where("place = 'signal' AND time = 'week'").collect()}
    assert len(weeks) == 2 * 6 and sum(w for _, w in weeks.values()) == sum(r[6] for r in rows if r[4].hour in (7, 17))
    empty = [v for v in weeks.values() if v == (None, 0.0)]
    assert len(empty) == 2 * 3


def test_levels_are_made_where_signals_and_corridors_lie(spark, frame):
    rng = random.Random(4)
    rows = [(s, p, date(2024, 1, 1) + timedelta(days=d), 366 + d // 7, datetime(2024, 1, 1, h) + timedelta(days=d), rng.choice([None, 0.5, 0.25]), rng.choice([None, 1.0, 3.0]))
            for s in (1, 2, 3, 4, None) for p in (2, 4) for d in (0, 1, 9, 40) for h in (7, 12, 17) if rng.random() < 0.8]
    facts = frame(rows, "SignalID int, CallPhase int, Date date, Week int, Date_Hour timestamp_ntz, x double, w double")
    # signal 1 in two corridors, signal 2 listed twice, signal 3 in a corridor named like its zone, one zone in two groups
    places = [(1, "C1", "Z1", "G"), (1, "C2", "Z1", "G"), (2, "C1", "Z1", "H"), (2, "C1", "Z1", "H"), (3, "Z2", "Z2", "G"), (4, None, "Z2", "G"), (4, "C4", None, None), (3, "C5", "Z1", "G"), (3, "C5", "Z1", "H")]
    corridors = frame(places, "SignalID int, Corridor string, Zone string, Zone_Group string")
    levels = lattice(facts, corridors, "x", "w")
    ran = executed(levels)
    assert [text for kind, text in ran if kind == "FileSourceScanExec" and "_xw" in text]  # sums lie in Parquet
    moved = [text for kind, text in ran if kind == "ShuffleExchangeExec" and "SinglePartition" not in text]
    assert len(moved) <= 8
    dealt = [text for text in moved if "REPARTITION_BY_NUM" in text]
    assert len(dealt) == 3 and sum("hashpartitioning(SignalID" in text for text in dealt) == 2 and sum("hashpartitioning(Corridor" in text for text in dealt) == 1
    want = []
    for time, signal, roll in (("day", ru.daily_avg(facts, "x", "w", True), "Date"), ("week", ru.weekly_avg_by_day(facts, "x", "w", True), "Date"), ("month", ru.monthly_avg_by_day(facts, "x", "w", True), "Month")):
        want += [(time, "signal", None, None if r.SignalID is None else str(r.SignalID), r[roll], r.x, r.w, r.delta) for r in signal.collect()]
        want += [(time, "corridor", r.Zone_Group, r.Corridor, r[roll], r.x, r.w, r.delta) for r in ru.corridor_rollup(signal.drop("delta", "Week"), corridors, "x", roll, "w").collect()]
    tidy = lambda rows: sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in rows)
    assert tidy(levels.collect()) == tidy(want) and len(want) > 80


def test_details_are_nested_where_the_signal_lies(spark, frame):
    rng = random.Random(6)
    phase = {1: 2, 2: 2, 3: 4, 4: None}
    rows = [(s, T0 + timedelta(days=d, hours=h), k, phase[k], rng.choice([0, 50, 90, 100]) if k != 3 or d else 7)
            for s in (1, 2, 3, None) for k in phase for d in range(9) for h in range(24) if rng.random() < 0.8]
    counts = frame(rows, "SignalID int, Timeperiod timestamp_ntz, Detector int, CallPhase int, vol long")
    config = frame([(s, k, p, "EB Mainline" if k == 1 else "Side") for s in (1, 2, 5) for k, p in phase.items()], "SignalID int, Detector int, CallPhase int, ApproachDesc string")
    kept = {}
    t = SimpleNamespace(counts_1hr=counts, det_config=config, kept=lambda name, make, packed=False: kept.setdefault(name, stored(make(), name)))
    nested = details(t)
    moved = [text for kind, text in executed(nested) if kind == "ShuffleExchangeExec"]
    assert list(kept) == ["counts_1hr"] and not any("Timeperiod" in text or "date" in text for text in moved)
    assert sum("hashpartitioning(SignalID" in text and "REPARTITION_BY_NUM" in text for text in moved) == 2
    cells = {}
    filtered = ct.filtered_counts(counts, config)
    for at, part in enumerate((counts.select("*", F.col("vol").alias("v")), filtered.withColumn("v", F.col("Good_Day")), ct.adjusted_counts(filtered).withColumn("v", F.col("vol").cast("int")))):
        for r in part.collect():
            cells.setdefault((r.SignalID, r.Timeperiod, r.Detector, r.CallPhase), [None] * 3)[at] = r.v
    want = {}
    for (s, ts, k, p), (raw, good, adjusted) in cells.items():
        bad = None if good is None else good == 0
        want.setdefault((s, ts.date()), []).append((ts.hour, k, p, raw, adjusted if bad else None, bad))
    got = {(r.SignalID, r.date): sorted(map(repr, map(tuple, r.data))) for r in nested.collect()}
    assert got == {key: sorted(map(repr, v)) for key, v in want.items()}
    assert {x[5] for v in want.values() for x in v} == {True, False, None} and any(x[4] is not None for v in want.values() for x in v)


def log(seed, n=3000, days=6):
    rng = random.Random(seed)
    out = [(rng.randrange(1, 4), T0 + timedelta(minutes=rng.randrange(days * 1440)), rng.choice([82, 90, 502, 503, 1]), rng.choice([1, 2, 3, None])) for _ in range(n)]
    return [(*r, r[1].date()) for r in out]


def test_late_events_give_the_same_tallies(spark, frame):
    rows = log(1)
    late = [r for r in rows if r[1] < T0 + timedelta(days=2) and (r[0] + r[1].minute) % 3 == 0]
    first = [r for r in rows if r not in late]
    root = new_table_path(spark, "tallies")
    inc.open_store(spark, root)
    inc.add_batch(spark, root, frame(first, EVENTS), "a")
    before = {r.path: r.modificationTime for r in files(spark, root)}
    again = late + [r for r in first if r[4] == date(2024, 1, 1)][:200]  # late ones, and some that came before
    for _ in range(2):
        inc.add_batch(spark, root, frame(again, EVENTS), "b")
    key = lambda df: sorted((tuple(r) for r in df.select("SignalID", "Timeperiod", "EventCode", "EventParam", "vol").collect()), key=repr)
    whole = ct.quarter_hour_tally(frame(rows, EVENTS))
    assert key(inc.stored_tally(spark, root)) == key(whole)
    after = {r.path: r.modificationTime for r in files(spark, root)}
    assert all(after[p] == m for p, m in before.items())  # nothing is written again
    assert {p.split("date=")[1][:10] for p in set(after) - set(before) if "batch=b" in p} <= {"2024-01-01", "2024-01-02"}
    seen = inc.seen_events(spark, root)
    assert seen.count() == seen.select(*inc.EVENT).distinct().count() == len({r[:4] for r in rows if r[2] != 1})


def files(spark, root):
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root).select("path", "modificationTime").collect()


def test_only_touched_dates_are_read(spark, frame):
    root = new_table_path(spark, "tallies")
    inc.open_store(spark, root)
    inc.add_batch(spark, root, frame(log(2), EVENTS), "a")
    fresh = inc.new_events(frame([r for r in log(3, 300) if r[4] == date(2024, 1, 3)], EVENTS), inc.seen_events(spark, root), "b")
    text = next(t for t in scans(fresh, "batch"))
    assert "PartitionFilters" in text and "2024" not in text.split("DataFilters")[0]
    fresh.collect()
    assert "2024-01-03" in fresh._jdf.queryExecution().optimizedPlan().toString() and "2024-01-04" not in fresh._jdf.queryExecution().optimizedPlan().toString()
    assert inc.new_events(frame([], EVENTS), inc.seen_events(spark, root), "c").isEmpty()



@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tree_diff_equals_a_full_comparison(frame, seed):
    rng = random.Random(seed)
    left = log(seed, 400) + log(seed, 20)  # some rows twice
    right = []
    for r in left:
        dice = rng.random()
        if r[0] == 1 or dice < 0.9:
            right.append(r)
        elif dice < 0.95:
            right.append((r[0], r[1], r[2], None if r[3] else 9, r[4]))
    right += [(2, T0, 7, 7, T0.date())] * 2
    branches = [{"date": F.col("date")}, {"SignalID": F.col("SignalID")}, {"hour": F.hour("Timestamp")}]
    got = sinks.tree_diff(frame(left, EVENTS), frame(right, EVENTS), ["SignalID", "Timestamp"], branches).collect()
    order = lambda rows: sorted(rows, key=lambda r: (r[2], (r[3] is not None, r[3] or 0), r[4]))
    want = Counter()
    for key in {r[:2] for r in left + right}:
        a, b = (order([r for r in side if r[:2] == key]) for side in (left, right))
        for k in range(max(len(a), len(b))):
            if k >= len(a) or k >= len(b):
                want[(*key, "right" if k >= len(a) else "left", ())] += 1
            elif a[k] != b[k]:
                want[(*key, "changed", tuple(n for n, x, y in zip(("EventCode", "EventParam", "date"), a[k][2:], b[k][2:]) if x != y))] += 1
    assert Counter((r.SignalID, r.Timestamp, r.side, tuple(r["columns"])) for r in got) == want and want


def test_tree_diff_compares_only_open_branches(spark, frame):
    left = log(5, 2000)
    right = [r if k != 7 else (*r[:3], 99, r[4]) for k, r in enumerate(left)]
    paths = [new_table_path(spark, "log") for _ in range(2)]
    for rows, path in zip((left, right), paths):
        frame(rows, EVENTS).write.parquet(path)
    a, b = (spark.read.parquet(p) for p in paths)
    branches = [{"date": F.col("date")}, {"SignalID": F.col("SignalID")}, {"hour": F.hour("Timestamp")}]
    assert sinks.tree_diff(a, a, ["SignalID", "Timestamp"], branches).isEmpty()
    out = sinks.tree_diff(a, b, ["SignalID", "Timestamp"], branches)
    assert [(r.side, r["columns"]) for r in out.collect()] == [("changed", ["EventParam"])]
    hashes = sinks.branch_hashes(a, {"SignalID": F.col("SignalID")}, a.columns).collect()
    assert sum(r._n for r in hashes) == 2000 and len({r._low for r in hashes}) == 3
    twice = frame([left[0], left[0]], EVENTS), frame([left[1], left[1]], EVENTS)
    one = [sinks.branch_hashes(x, {"all": F.lit(1)}, x.columns).first() for x in twice]
    assert one[0] != one[1]  # repeated rows do not cancel out
