"""Stored tables: sizes of files, buckets, pruning while a query runs, versions; JSON of unknown shape; alerts of ramp meters."""

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from greenwave.operators import alerts as al
from greenwave.sources import scan, sinks
from tests.plans import executed, scans

COUNTS = "SignalID int, Timeperiod timestamp_ntz, Detector int, CallPhase int, vol int"


@pytest.fixture
def small_files(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200k")
    yield
    spark.conf.set(key, before)


def counts(spark, hot, sparse):
    """One date with ``hot`` rows and six with ``sparse`` rows each."""
    n = F.col("id")
    day = F.when(n < hot, 0).otherwise(1 + (n - hot) % 6)
    return spark.range(0, hot + 6 * sparse, 1, 8).select(
        (n % 97).cast("int").alias("SignalID"), (F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(day, n % 24)).alias("Timeperiod"),
        (n % 7).cast("int").alias("Detector"), F.lit(2).alias("CallPhase"), F.pmod(F.xxhash64("id"), F.lit(1_000_000_007)).cast("int").alias("vol"))


@pytest.mark.parametrize("spread", [1, 4])
def test_a_hot_date_is_cut_and_sparse_dates_are_not(spark, tmp_path, small_files, spread):
    df = counts(spark, 200_000, 60)
    root = str(tmp_path / "counts")
    sinks.write_by_date(df, root, spread=spread)
    files = {r.date: (r.files, r.bytes) for r in scan.inventory(spark, str(tmp_path)).collect()}
    assert len(files) == 7
    hot, hot_bytes = files.pop(date(2024, 1, 1))
    assert hot >= 4 and hot_bytes / hot < 600_000 and all(n <= spread for n, _ in files.values())
    back = scan.read_range(spark, root, "2024-01-01", "2024-01-31")
    total = lambda x: x.agg(F.count(F.lit(1)), F.sum(F.col("vol").cast("long"))).first()
    assert total(back) == total(df)
    if spread > 1:  # a signal lies in one part of the date
        of = spark.read.parquet(root).where("date = '2024-01-01'").groupBy("SignalID").agg(F.countDistinct("_metadata.file_name").alias("n"))
        assert of.agg(F.avg("n")).first()[0] < hot / 2


def test_joins_of_equal_buckets_need_no_shuffle(spark, frame, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = counts(spark, 4000, 10)
        config = frame([(s, d, d % 3) for s in range(97) for d in range(7)] + [(None, 1, 1)], "SignalID int, Detector int, CallPhase int")
        a = sinks.write_bucketed(rows.drop("CallPhase"), "test_bucketed_counts", str(tmp_path / "a"), 8)
        b = sinks.write_bucketed(config, "test_bucketed_config", str(tmp_path / "b"), 8)
        got = a.join(b, ["SignalID", "Detector"]).groupBy("SignalID", "Detector", "CallPhase").agg(F.sum("vol").alias("vol"))
        kinds = Counter(kind for kind, _ in executed(got))
        assert kinds["SortMergeJoinExec"] == 1 and not kinds["ShuffleExchangeExec"]
        want = rows.drop("CallPhase").join(config, ["SignalID", "Detector"]).groupBy("SignalID", "Detector", "CallPhase").agg(F.sum("vol").alias("vol"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS test_bucketed_counts")
        spark.sql("DROP TABLE IF EXISTS test_bucketed_config")


def test_a_table_of_dates_prunes_partitions(spark, frame, tmp_path):
    root, dates = str(tmp_path / "counts"), str(tmp_path / "dates")
    sinks.write_by_date(counts(spark, 5000, 50), root)
    frame([(date(2024, 1, 1) + timedelta(days=k), k) for k in range(9)] + [(None, 3)], "Date date, k int").write.parquet(dates)
    days = spark.read.parquet(dates).where("k IN (2, 3)")
    got = scan.read_range(spark, root, "2024-01-01", "2024-01-31", days=days)
    read = [text for text in scans(got) if "vol" in text]
    assert len(read) == 1 and "dynamicpruning" in read[0]
    assert Counter(r.Date.day for r in got.collect()) == {3: 50, 4: 50}


def test_versions_keep_the_last_and_numbers_count(spark, frame, tmp_path):
    root = str(tmp_path / "tables")
    row = lambda m, v: frame([(1, date(2024 + m // 12, m % 12 + 1, 1), v, None)], "SignalID int, Month date, v double, delta double")
    assert sinks.latest_version(spark, root, "t") is None
    for m in range(12):
        sinks.merge_batch(spark, [(row(m, float(m)), "t", "v", "2024-01-01", f"2024-{m + 1:02d}-01"), (row(m, 1.0), "u", "v", "2024-01-01", f"2024-{m + 1:02d}-01")], root)
    assert sorted(p.name for p in (tmp_path / "tables" / "t").iterdir()) == ["v0", "v1", "v2"]
    # number 11 is newer than number 9, whatever the order of their names
    assert sinks._newest(spark, root, "t") == 11 and sinks.latest_version(spark, root, "t").endswith("t/v2")
    # a version that was written but not noted, as by a lost job, is not read and is overwritten
    row(5, -1.0).write.mode("overwrite").parquet(f"{root}/t/v0")
    got = spark.read.parquet(sinks.latest_version(spark, root, "t"))
    assert sorted(r.v for r in got.collect()) == [float(m) for m in range(12)]
    sinks.merge_batch(spark, [(row(12, 99.0), "t", "v", "2024-01-01", "2025-01-01")], root)
    assert spark.read.parquet(sinks.latest_version(spark, root, "t")).count() == 13
    with pytest.raises(ValueError):
        sinks.merge_batch(spark, [], root, keep=1)


def test_json_of_unknown_shape(frame):
    texts = ['{"a": 1, "b.c": {"it\'s": [1.50, {"z": null}]}, "e": {}, "f": [], "t": true}', '"word"', "[]", None, "{broken", '[[["deep"]]]']
    docs = frame(list(enumerate(texts)), "id int, json string").select("id", F.try_parse_json("json").alias("v"))
    rows = {(r.id, r.path): (r.kind, r.leaf) for r in scan.json_leaves(docs, "v").collect()}
    assert rows == {
        (0, "$['a']"): ("BIGINT", "1"), (0, "$['b.c']['it\\'s'][0]"): ("DECIMAL(2,1)", "1.5"), (0, "$['b.c']['it\\'s'][1]['z']"): ("VOID", None),
        (0, "$['e']"): ("OBJECT<>", "{}"), (0, "$['f']"): ("ARRAY<VOID>", "[]"), (0, "$['t']"): ("BOOLEAN", "true"), (1, "$"): ("STRING", "word"),
        (2, "$"): ("ARRAY<VOID>", "[]"), (3, "$"): (None, None), (4, "$"): (None, None), (5, "$[0][0][0]"): ("STRING", "deep")}
    shallow = {r.path: r.leaf for r in scan.json_leaves(docs.where("id = 5"), "v", depth=2).collect()}
    assert shallow == {"$[0][0]": '["deep"]'}


def test_results_keep_fields_that_no_schema_names(frame):
    good = '{"daily_results": [{"values": [{"date": "January 2, 2024 05:00:00", "combined": {"delay_cost": 5}, "new": {"x.y": [1, 2]}}, {"date": "odd", "combined.delay_cost": 2.5}, 7]}, {"values": []}, {}], "more": 1}'
    df = frame([(1, good), (2, None), (3, "{broken"), (4, '{"daily_results": 3}')], "id int, json string")
    out = scan.open_daily_results(df).withColumn("whole", F.to_json("value")).collect()
    assert sorted(((r.date, r.delay_cost, r.whole) for r in out), key=repr) == sorted([
        (datetime(2024, 1, 2, 5), 5.0, '{"combined":{"delay_cost":5},"date":"January 2, 2024 05:00:00","new":{"x.y":[1,2]}}'),
        (None, 2.5, '{"combined.delay_cost":2.5,"date":"odd"}'), (None, None, "7")], key=repr)


def test_ramp_meters_in_one_pass(spark, frame, tmp_path):
    schema = "Zone_Group string, Zone string, Corridor string, SignalID string, CallPhase string, Detector string, Date date, Name string, Alert string, ApproachDesc string"
    row = lambda zone, s, p, d, day, a: ("G", zone, "C", s, p, d, date(2024, 1, day), "n", al.BAD_DETECTOR, a)
    rows = [row(al.RAMP_ZONE, "9", "2", d, day, a) for day in (1, 2, 4) for d, a in (("46", "Mainline-Lead Lane 1"), ("49", "Mainline-Trail Lane 1"), ("50", "Passage Lane 1"), ("51", "Exit"))]
    rows += [row("Z", "8", "4", d, day, "Mainline-Lead Lane 1") for day in (1, 2) for d in ("46", "49")] + [row(None, "7", None, None, 1, None)]
    # rows that differ only in an approach still to be filled in stay two rows, except at ramp meters
    rows += [row("Z", "8", "4", "46", 1, None), row(al.RAMP_ZONE, "9", "2", "46", 1, None)]
    path = str(tmp_path / "rows")
    frame(rows, schema).write.parquet(path)
    out = al.alerts([spark.read.parquet(path)])
    assert len(scans(out)) == 1
    got = Counter((r.SignalID, r.CallPhase, r.Detector, r.ApproachDesc, r.Date.day, r.streak) for r in out.collect() if r.SignalID != "8")
    ramp = lambda p, d, a: {("9", p, d, a, day, s): 1 for day, s in ((1, 1), (2, 2), (4, 1))}
    assert got == {**ramp("Mainline", "46/49", "Mainline Lane 1"), **ramp("Passage", "50", "Passage Lane 1"), **ramp("Other", "51", "Exit"), ("7", "0", "0", "", 1, 1): 1}
    plain = Counter((r.Detector, r.CallPhase, r.Date.day) for r in out.collect() if r.SignalID == "8")
    assert plain == {("46", "4", 1): 2, ("46", "4", 2): 1, ("49", "4", 1): 1, ("49", "4", 2): 1}
