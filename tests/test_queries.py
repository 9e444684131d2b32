"""Registered queries against their SQL on the small test data, and the shape of their plans."""

import os

import pytest

import __spark_entry__ as entry
from tools.check_queries import TABLES, rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SAMPLE = ["flagship_weekly_corridor_volume", "m5_filtered_counts_1hr", "m7_adjusted_counts_1hr", "r6_weekly_aog_by_day", "r2_overlapping_groups",
          "c6_cycles", "c7_wide_events", "c11_split_failures_1hr", "e3_ped_input_uptime", "q3_combined_camera_uptime", "t2_corridor_travel_time_metrics",
          "k6_outstanding_by_age", "h4_safety_health", "s8_read_signal_details", "v10_quarterly_extract"]


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_oracle_names_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    cur = db.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows(df.columns, df.collect()) == rows(cols, cur.fetchall())


@pytest.mark.parametrize("name", ["r6_weekly_aog_by_day", "m5_filtered_counts_1hr", "c3_intervals_in_cycle", "c10_green_occupancy", "k6_outstanding_by_age", "t8_delay_cost_trend"])
def test_plans_have_no_cross_joins_or_python(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = entry.queries()["m3_comm_uptime"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in plan.split("ReadSchema:")[1]
