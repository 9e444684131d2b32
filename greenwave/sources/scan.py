"""Readers: date-partitioned tables, event logs, CSV and camera logs, table inventories."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from greenwave.functions import timeparts as tp


def read_range(spark: SparkSession, root: str, start: str, end: str, signals: Sequence[int] | DataFrame | None = None,
               callback: Callable[[DataFrame], DataFrame] | None = None, days: DataFrame | None = None) -> DataFrame:
    """A date range of a ``date=``-partitioned table; only its partitions are read.

    Columns that start with '__' are dropped and ``Date`` comes from the partition.  ``days`` is a table of dates (its column
    ``Date``), such as a filtered calendar: only rows of its dates are kept, and partitions without one are pruned while the query runs.
    """
    df = spark.read.parquet(root).where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if days is not None:
        df = df.join(days.select(F.col("Date").alias("_day")), F.col("date") == F.col("_day"), "left_semi")
    df = limit_signals(df.drop(*[c for c in df.columns if c.startswith("__")]), signals)
    df = df.withColumnRenamed("date", "Date")
    return callback(df) if callback else df


def limit_signals(df: DataFrame, signals: Sequence[int] | DataFrame | None) -> DataFrame:
    if signals is None:
        return df
    if isinstance(signals, DataFrame):
        return df.join(signals.select("SignalID").distinct(), "SignalID", "left_semi")
    return df.where(F.col("SignalID").isin(*signals))


def event_slice(events: DataFrame, start: str, end: str, signals=None, codes: Sequence[int] | None = None,
                midweek_only: bool = False) -> DataFrame:
    """Distinct events of a date range, with optional signal, code and midweek filters."""
    df = events.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    df = limit_signals(df, signals)
    if codes is not None:
        df = df.where(F.col("EventCode").isin(*codes))
    if midweek_only:
        df = df.where(tp.midweek("date"))
    return df.distinct()


def jdbc_events(spark: SparkSession, url: str, table: str, days: Sequence[str], signals: Sequence[int] | None = None,
                codes: Sequence[int] | None = None, weekdays: Sequence[int] | None = None, column: str = "Timestamp",
                **options) -> DataFrame:
    """Event rows from a database, one task per day; every filter runs in the database."""
    extra = ""
    if signals:
        extra += f" AND SignalID IN ({', '.join(str(int(s)) for s in signals)})"
    if codes:
        extra += f" AND EventCode IN ({', '.join(str(int(c)) for c in codes)})"
    if weekdays:
        from datetime import date

        days = [d for d in days if (date.fromisoformat(d).isoweekday() % 7 + 1) in weekdays]
    predicates = [f"{column} >= '{d} 00:00:00' AND {column} < '{_next_day(d)} 00:00:00'{extra}" for d in days]
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def _next_day(d: str) -> str:
    from datetime import date, timedelta

    return (date.fromisoformat(d) + timedelta(days=1)).isoformat()


def weekly_shard(prefix: str, day: str) -> str:
    """Name of the weekly table that holds a day, by ISO week."""
    from datetime import date

    year, week, _ = date.fromisoformat(day).isocalendar()
    return f"{prefix}_{year}_{week:02d}"


def union_sources(first: DataFrame, second: DataFrame, rename: dict[str, str]) -> DataFrame:
    """Two event sources as one, the second with its columns renamed."""
    return first.unionByName(second.withColumnsRenamed(rename), allowMissingColumns=True)


def read_tasks_csv(spark: SparkSession, paths: Sequence[str], schema: str, report_start: str,
                   timestamp_format: str = "MM/dd/yyyy hh:mm:ss a") -> DataFrame:
    """Archived and current task files with typed columns, from the start of the report, copies dropped."""
    reader = spark.read.schema(schema).option("header", "true")
    reader = reader.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    df = reader.csv(list(paths))
    return df.where(F.col("Date_Reported") >= F.lit(report_start).cast("date")).distinct()


def camera_log(raw: DataFrame, zone: str, http_dates: bool = True) -> DataFrame:
    """Camera log lines as local wall-clock rows, copies dropped.

    raw: ID, Last-Modified, Content-Length, file_date.  Dates are HTTP dates or ISO stamps, in UTC.
    """
    text = F.col("`Last-Modified`")
    if http_dates:
        # 'Tue, 02 Jan 2024 10:00:00 GMT': the weekday is redundant and the zone is always GMT
        text = F.regexp_extract(text, r"(\d{1,2} \w{3} \d{4} \d{2}:\d{2}:\d{2})", 1)
        stamp = F.try_to_timestamp(text, F.lit("d MMM yyyy HH:mm:ss")).cast("timestamp_ntz")
    else:
        stamp = F.to_timestamp_ntz(F.regexp_replace(F.substring(text, 1, 19), "T", " "))
    return raw.select(F.col("ID").alias("CameraID"), tp.local_time(stamp, zone).alias("Timestamp"),
                      F.col("`Content-Length`").cast("double").alias("Size"), F.col("file_date").cast("date").alias("Date")).distinct()


def signals_in(df: DataFrame, day: str) -> DataFrame:
    """Signals with rows on a day."""
    return df.where(F.col("date") == F.lit(day).cast("date")).select("SignalID").distinct()


def parse_date_rule(rule: str, today: str, table: DataFrame | None = None, date_column: str = "date") -> Column | str:
    """'yesterday', 'N days ago', 'first_missing' (day after the newest partition, at most yesterday) or a date."""
    now = F.lit(today).cast("date")
    if rule == "yesterday":
        return F.date_sub(now, 1)
    if rule.endswith("days ago"):
        return F.date_sub(now, int(rule.split()[0]))
    if rule == "first_missing":
        newest = table.select(F.max(date_column)).scalar()
        return F.least(F.date_add(newest, 1), F.date_sub(now, 1))
    return F.date_add(F.lit(rule).cast("date"), 1)


def first_missing_across(newest_dates: DataFrame, exceptions: int = 5) -> DataFrame:
    """Day after the earliest newest date that more than ``exceptions`` tables share.

    newest_dates: table, MaxDate.
    """
    shared = newest_dates.groupBy("MaxDate").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > exceptions)
    return shared.agg(F.date_add(F.min("MaxDate"), 1).alias("first_missing"))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files, bytes and newest change per table and date below a folder of ``table/date=.../`` tables."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    path = F.col("path")
    return df.select("path", "length", "modificationTime").groupBy(
        F.regexp_extract(path, r"/([^/]+)/date=", 1).alias("table"),
        F.to_date(F.regexp_extract(path, r"date=(\d{4}-\d{2}-\d{2})", 1)).alias("date")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("last_modified"))


def explode_daily_results(text: DataFrame, column: str = "json") -> DataFrame:
    """Delay-cost responses (``daily_results`` with a ``values`` array) as one row per value."""
    schema = "daily_results array<struct<values: array<struct<date: string, `combined.delay_cost`: double, combined: struct<delay_cost: double>>>>>"
    rows = text.withColumn("_r", F.from_json(column, schema))
    rows = rows.withColumn("_d", F.explode("_r.daily_results")).withColumn("_v", F.explode("_d.values"))
    stamp = F.try_to_timestamp("_v.date", F.lit("MMMM d, yyyy HH:mm:ss")).cast("timestamp_ntz")
    cost = F.coalesce(F.col("_v.combined.delay_cost"), F.col("_v.`combined.delay_cost`"))
    return rows.select(*[c for c in text.columns if c != column], stamp.alias("date"), cost.alias("delay_cost"))


def json_leaves(df: DataFrame, value: str, depth: int = 8) -> DataFrame:
    """One row for each leaf of the VARIANT column ``value``: the other columns, path, kind and the leaf as text.

    Nothing is known of the keys beforehand.  A path is a JSON path with quoted keys, so dotted keys stay one step.  JSON null, an empty object
    or array, and what still has parts after ``depth`` levels are leaves too, the last as JSON text.  A missing document (SQL NULL) gives one
    row with neither kind nor leaf.
    """
    spark = df.sparkSession
    keep = [c for c in df.columns if c != value]
    out = df.select(*keep, F.col(value).alias("_v"), F.lit("$").alias("path"))
    for _ in range(depth):
        parts = out.lateralJoin(spark.tvf.variant_explode_outer(F.col("_v").outer()))
        step = F.when(F.col("key").isNotNull(), F.concat(F.lit("['"), F.regexp_replace("key", "(['\\\\])", r"\\$1"), F.lit("']"))).otherwise(
            F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        inner = F.col("pos").isNotNull()
        out = parts.select(*keep, F.when(inner, F.col("value")).otherwise(F.col("_v")).alias("_v"),
                           F.when(inner, F.concat("path", step)).otherwise(F.col("path")).alias("path"))
    kind = F.schema_of_variant("_v")
    whole = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    leaf = F.when(whole, F.to_json("_v")).otherwise(F.try_variant_get("_v", "$", "string"))
    return out.select(*keep, "path", kind.alias("kind"), leaf.alias("leaf"))


def open_daily_results(text: DataFrame, column: str = "json") -> DataFrame:
    """Delay-cost responses as one row per value: date, delay_cost (nested or under a dotted key) and ``value``, all the value's fields as VARIANT.

    Fields that no schema names stay in ``value``.  Texts that are NULL, no JSON or without values give no row.
    """
    keep = [c for c in text.columns if c != column]
    days = text.select(*keep, F.try_variant_get(F.try_parse_json(column), "$.daily_results", "array<variant>").alias("_days"))
    days = days.select(*keep, F.explode("_days").alias("_day"))
    rows = days.select(*keep, F.explode(F.try_variant_get("_day", "$.values", "array<variant>")).alias("value"))
    stamp = F.try_to_timestamp(F.try_variant_get("value", "$.date", "string"), F.lit("MMMM d, yyyy HH:mm:ss")).cast("timestamp_ntz")
    cost = F.coalesce(F.try_variant_get("value", "$.combined.delay_cost", "double"), F.try_variant_get("value", "$['combined.delay_cost']", "double"))
    return rows.select(*keep, stamp.alias("date"), cost.alias("delay_cost"), "value")
