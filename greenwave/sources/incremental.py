"""Nightly tallies that late events are merged into: stored by date and batch, exact, and safe to run again.

Two tables, partitioned by date and batch: ``seen`` holds the distinct events a batch brought that no other batch had, ``tally``
their counts by quarter hour.  Counts of a date are the sum over its batches, so a late batch adds rows and recounts nothing.  Running a
batch again replaces what it wrote before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from greenwave.functions import timeparts as tp
from greenwave.operators.counts import NIGHTLY_CODES, quarter_hour_tally

EVENT = ("SignalID", "Timestamp", "EventCode", "EventParam")


def _stored(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, date date, batch string").parquet(f"{root}/{table}")


def seen_events(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, root, "seen", "SignalID int, Timestamp timestamp_ntz, EventCode int, EventParam int")


def stored_tally(spark: SparkSession, root: str) -> DataFrame:
    """The tally over all batches; filters on ``date`` read only its partitions."""
    rows = _stored(spark, root, "tally", "SignalID int, Timeperiod timestamp_ntz, EventCode int, EventParam int, vol long")
    return rows.groupBy("date", "SignalID", "Timeperiod", "EventCode", "EventParam").agg(F.sum("vol").alias("vol"))


def open_store(spark: SparkSession, root: str) -> None:
    """Empty tables where there are none yet."""
    for table, schema in (("seen", "SignalID int, Timestamp timestamp_ntz, EventCode int, EventParam int"), ("tally", "SignalID int, Timeperiod timestamp_ntz, EventCode int, EventParam int, vol long")):
        spark.createDataFrame([], f"{schema}, date date, batch string").write.mode("append").partitionBy("date", "batch").parquet(f"{root}/{table}")


def new_events(events: DataFrame, seen: DataFrame, batch: str) -> DataFrame:
    """The distinct events of a batch that other batches have not brought.

    Only dates of the batch are looked up; there are as many as days it touches, so their list is small.  NULL parameters match each other.
    """
    mine = events.where(F.col("EventCode").isin(*NIGHTLY_CODES)).select(*EVENT, tp.day("Timestamp").alias("date")).distinct()
    dates = [r.date for r in mine.select("date").distinct().collect()]
    if not dates:
        return mine
    known = seen.where(F.col("date").isin(dates) & (F.col("batch") != batch)).select(*[F.col(c).alias(f"_{c}") for c in (*EVENT, "date")])
    same = (F.col("date") == F.col("_date")) & F.col("EventParam").eqNullSafe(F.col("_EventParam"))
    for c in EVENT[:3]:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return mine.join(known, same, "left_anti")


def add_batch(spark: SparkSession, root: str, events: DataFrame, batch: str) -> None:
    """Merge a batch of events of any dates: the tallies first, then what was seen.

    If the job is lost between the two writes, running the batch again finds the same new events and replaces its tallies.
    """
    fresh = new_events(events, seen_events(spark, root), batch)
    write = lambda df, table: (df.withColumn("batch", F.lit(batch)).repartition("date", "SignalID").write.mode("overwrite")
                               .option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch").parquet(f"{root}/{table}"))
    write(quarter_hour_tally(fresh).withColumn("date", tp.day("Timeperiod")), "tally")
    write(fresh, "seen")
