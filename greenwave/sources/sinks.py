"""Writers: partitioned tables, trailing-window upserts, result tables, nested details, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from greenwave.functions import timeparts as tp
from greenwave.functions.stats import with_delta

PERIODS = ("Quarter", "Month", "Date", "Hour", "Timeperiod")


def write_by_date(df: DataFrame, root: str, cluster_by: Sequence[str] = ("SignalID",), spread: int = 1) -> None:
    """Overwrite exactly the dates present in ``df``; ids are stored as strings.

    Rows are rebalanced by date, so a date with many rows is cut into files of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    and dates with few rows share a task; files are sorted by ``cluster_by``.  With ``spread`` a date is first cut into that many parts by the hash
    of ``cluster_by``, so that a reader of one signal opens one part of a large date.
    """
    if "Date" not in df.columns:
        source = next(c for c in ("Timeperiod", "Hour", "Date_Hour", "Timestamp") if c in df.columns)
        df = df.withColumn("Date", tp.day(source))
    ids = [c for c in ("SignalID", "CallPhase", "Detector") if c in df.columns]
    out = df.withColumns({c: F.col(c).cast("string") for c in ids}).withColumnRenamed("Date", "date")
    keys = [c for c in cluster_by if c in out.columns]
    if spread > 1 and keys:
        out = out.withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(spread))).hint("rebalance", "date", "_part").drop("_part")
    else:
        out = out.hint("rebalance", "date")
    out = out.sortWithinPartitions("date", *keys)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(root)


def write_bucketed(df: DataFrame, name: str, folder: str, buckets: int, keys: Sequence[str] = ("SignalID", "Detector")) -> DataFrame:
    """Store ``df`` as the table ``name``, bucketed and sorted by ``keys``, and read it back.

    Joins of tables with equal buckets on ``keys``, and groupings that contain them, need no shuffle.  A bucket may consist of
    several files (rows are rebalanced, a full bucket is written by several tasks), but a join reads it in one task: take keys none
    of which holds a large share of the rows, such as signal and detector.
    """
    writer = df.hint("rebalance", *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", folder).saveAsTable(name)
    return df.sparkSession.table(name)


def period_column(df: DataFrame) -> str:
    return next(c for c in PERIODS if c in df.columns)


def merge_window(old: DataFrame, new: DataFrame, value: str, report_start: str, calc_start: str) -> DataFrame:
    """Old rows of [report_start, calc_start) with new rows from calc_start on, change recomputed over both.

    Quarterly tables are replaced.  Running it twice gives the same table.
    """
    period = period_column(old)
    if period == "Quarter":
        return new
    lo, cut = F.lit(report_start).cast("date"), F.lit(calc_start).cast("date")
    at = F.col(period).cast("date")
    both = old.where((at >= lo) & (at < cut)).unionByName(new.where(at >= cut), allowMissingColumns=True)
    keys = [c for c in ("Zone_Group", "Corridor", "SignalID") if c in old.columns]
    return with_delta(both.drop("delta"), keys, period, value)


def merge_batch(spark: SparkSession, plan: Sequence[tuple[DataFrame, str, str, str, str]], root: str, keep: int = 3) -> None:
    """Merge a list of (new rows, table, value, report start, calc start) into stored tables.

    Each merge writes a whole new version and then notes its number in the table ``versions``; readers take the highest number noted, so
    a lost job leaves the table as it was and may be run again.  The last ``keep`` versions stay: each has a place, and
    a new one overwrites the oldest.
    """
    if keep < 2:
        raise ValueError("keep at least 2 versions: the one read and the one written")
    for new, table, value, report_start, calc_start in plan:
        number = _newest(spark, root, table)
        merged = new if number is None else merge_window(spark.read.parquet(_place(root, table, number, keep)), new, value, report_start, calc_start)
        following = 0 if number is None else number + 1
        path = _place(root, table, following, keep)
        merged.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        note = spark.range(1).select(F.lit(following).cast("long").alias("number"), F.lit(path).alias("path"), F.lit(table).alias("table"))
        note.write.mode("append").partitionBy("table").parquet(f"{root}/versions")


def _place(root: str, table: str, number: int, keep: int) -> str:
    return f"{root}/{table}/v{number % keep}"


def versions(spark: SparkSession, root: str) -> DataFrame | None:
    """number, path and table of every version noted, or None where there is none."""
    try:
        return spark.read.schema("number long, path string, table string").parquet(f"{root}/versions")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _newest(spark: SparkSession, root: str, table: str) -> int | None:
    noted = versions(spark, root)
    return None if noted is None else noted.where(F.col("table") == table).agg(F.max("number")).first()[0]


def latest_version(spark: SparkSession, root: str, table: str) -> str | None:
    """Folder of the newest completely written version of a table, or None."""
    noted = versions(spark, root)
    return None if noted is None else noted.where(F.col("table") == table).agg(F.max_by("path", "number")).first()[0]


def publish_rows(target: DataFrame, new: DataFrame, report_start: str, calc_start: str, report_end: str,
                 weekly: bool = False, replace_all: bool = False) -> DataFrame:
    """A result table after publishing: rows before the report and from the start on make room for new rows.

    Only the target's columns are kept; new rows end one month after ``report_end``; weekly tables start
    at the Tuesday of the start's week.
    """
    cols = [c for c in target.columns if c in new.columns]
    if replace_all:
        return new.select(*cols)
    start = F.lit(calc_start).cast("date")
    start = tp.nearest_tuesday(start) if weekly else start
    at = F.col(period_column(target)).cast("date")
    kept = target.where((at >= F.lit(report_start).cast("date")) & (at < start))
    added = new.where((at >= start) & (at < F.add_months(F.lit(report_end).cast("date"), 1))).select(*cols)
    return kept.unionByName(added, allowMissingColumns=True)


def retain_months(df: DataFrame, today: str, months: int = 8, period: str = "Date") -> DataFrame:
    """Rows of the last ``months`` months; on a table partitioned by the period this drops partitions."""
    floor = F.add_months(F.trunc(F.lit(today).cast("date"), "month"), -months)
    return df.where(F.col(period).cast("date") >= F.add_months(floor, 1))


def result_table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and day."""
    out = None
    for name, df in tables.items():
        part = df.groupBy(F.col(period_column(df)).cast("date").alias("date")).agg(F.count(F.lit(1)).alias("records"))
        part = part.select(F.lit(name).alias("table"), "date", "records")
        out = part if out is None else out.unionByName(part)
    return out


def audit_matrix(counts: DataFrame, dates: Sequence[str] | None = None, resolution: str | None = None) -> DataFrame:
    """Records by table and date, for one resolution ('dy', 'wk', 'mo', 'qu') of table names like cor_dy_vpd.

    All dates come as rows; with ``dates``, a column for each of these instead.
    """
    if resolution:
        counts = counts.where(F.split_part("table", F.lit("_"), F.lit(2)) == resolution)
    if dates is None:
        return counts.groupBy("table", "date").agg(F.sum("records").alias("records"))
    rows = counts.withColumn("_d", F.col("date").cast("string"))
    return rows.groupBy("table").pivot("_d", list(dates)).agg(F.sum("records"))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of two sources by where their keys occur: both, left only or right only.

    Counted per key on each side first, so repeated rows never multiply; NULL keys match each other.
    """
    tag = lambda df, side: df.select(*keys, F.lit(side).alias("_s"))
    both = tag(left, "l").unionByName(tag(right, "r")).groupBy(*keys).agg(
        F.count_if(F.col("_s") == "l").alias("left_rows"), F.count_if(F.col("_s") == "r").alias("right_rows"))
    where = F.when((F.col("left_rows") > 0) & (F.col("right_rows") > 0), "both").when(F.col("left_rows") > 0, "left").otherwise("right")
    return both.withColumn("side", where)


def row_diff(left: DataFrame, right: DataFrame) -> dict[str, DataFrame]:
    """Rows of each frame that the other lacks, repeats counted."""
    return {"left_only": left.exceptAll(right), "right_only": right.exceptAll(left)}


def branch_hashes(df: DataFrame, branch: dict[str, Column], rows: Sequence[str]) -> DataFrame:
    """Number and hash of the rows of every branch; equal sets of rows, repeats counted, have equal hashes in any order.

    Each task sums the hashes of its own rows, so a branch moves as one row a task.
    """
    # NULLs are marked: hashing alone passes over them
    h = F.xxhash64(*[x for c in rows for x in (F.col(c), F.col(c).isNull())])
    marked = df.select(*[c.alias(n) for n, c in branch.items()], h.alias("_h"))
    return marked.groupBy(*branch).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("_h").bitwiseAND(0xFFFFFFFF)).alias("_low"), F.sum(F.shiftrightunsigned("_h", 32)).alias("_high"))


def tree_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], branches: Sequence[dict[str, Column]]) -> DataFrame:
    """Rows in which two sources differ: the keys, side ('left', 'right' or 'changed') and the names of the columns that differ.

    ``branches`` are ever finer parts of the data, such as dates, then signals, then hours.  The number and hash of each finest branch are
    summed up to the coarser ones; from the top down only branches that differ are followed, and only
    rows of finest branches that differ are shuffled and compared.  Rows of equal keys are paired in the order of
    their other columns; NULLs match each other.  Columns are those of ``left``.
    """
    columns = left.columns
    others = [c for c in columns if c not in keys]
    finest = {n: c for level in branches for n, c in level.items()}
    sides = [branch_hashes(df.select(*columns), finest, columns) for df in (left, right)]
    signed = sides[0].withColumn("_s", F.lit(1)).unionByName(sides[1].withColumn("_s", F.lit(-1)))
    names: list[str] = []
    open_ = None
    for level in branches:
        names = [*names, *level]
        here = signed if open_ is None else signed.join(open_, _same(names[: -len(level)]), "left_semi")
        grouped = here.groupBy(*names).agg(*[F.sum(F.col(c) * F.col("_s")).alias(c) for c in ("_n", "_low", "_high")])
        open_ = grouped.where("_n <> 0 OR _low <> 0 OR _high <> 0").select(*[F.col(n).alias(f"{n}_open") for n in names])
    parts = []
    for df, side in ((left, "l"), (right, "r")):
        rows = df.select(*columns).withColumns({n: c for n, c in finest.items() if n not in columns})
        parts.append(rows.join(open_, _same(names), "left_semi").select(*columns).withColumn("_side", F.lit(side)))
    place = Window.partitionBy(*keys, "_side").orderBy(*others)
    paired = parts[0].unionByName(parts[1]).withColumn("_i", F.row_number().over(place))
    one = lambda s: F.any_value(F.when(F.col("_side") == s, F.struct(F.lit(1).alias("_in"), *others)), F.lit(True))
    both = paired.groupBy(*keys, "_i").agg(one("l").alias("_l"), one("r").alias("_r"))
    differs = F.array_compact(F.array(*[F.when(~F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")), F.lit(c)) for c in others]))
    side = F.when(F.col("_r").isNull(), "left").when(F.col("_l").isNull(), "right").otherwise("changed")
    out = both.select(*keys, side.alias("side"), F.when(side == "changed", differs).otherwise(F.array().cast("array<string>")).alias("columns"))
    return out.where((F.col("side") != "changed") | (F.size("columns") > 0))


def _same(names: Sequence[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(n).eqNullSafe(F.col(f"{n}_open"))
    return out


def append_distinct(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Old and new rows together without copies."""
    return new.distinct() if old is None else old.unionByName(new, allowMissingColumns=True).distinct()


def signal_details(raw: DataFrame, filtered: DataFrame, adjusted: DataFrame) -> DataFrame:
    """Raw, filtered and adjusted hourly counts nested per signal and day.

    The three tables are stacked and grouped by their shared key; where they lie by signal over as many tasks, nothing moves.
    Adjusted volume shows only on bad days.  A nested row holds one signal's day: detectors x 24 hours.
    """
    keys = ["SignalID", "Timeperiod", "Detector", "CallPhase"]
    none_int = F.lit(None).cast("int")
    part = lambda df, rc, gd, ac: df.select(*keys, rc.cast("int").alias("vol_rc"), gd.cast("int").alias("gd"), ac.cast("int").alias("vol_ac"))
    rows = (part(raw, F.col("vol"), none_int, none_int).unionByName(part(filtered, none_int, F.col("Good_Day"), none_int))
            .unionByName(part(adjusted, none_int, none_int, F.col("vol"))))
    rows = rows.groupBy(*keys).agg(F.max("vol_rc").alias("vol_rc"), F.max("gd").alias("gd"), F.max("vol_ac").alias("vol_ac"))
    rows = rows.withColumns({"date": tp.day("Timeperiod"), "Hour": F.hour("Timeperiod"), "bad_day": F.col("gd") == 0})
    rows = rows.withColumn("vol_ac", F.when(F.col("bad_day"), F.col("vol_ac")))
    item = F.struct("Detector", "Hour", "CallPhase", "vol_rc", "vol_ac", "bad_day")
    nested = rows.groupBy("SignalID", "date").agg(F.array_sort(F.collect_list(item)).alias("_d"))
    return nested.select("SignalID", "date", F.transform("_d", lambda x: F.struct(
        x["Hour"].alias("Hour"), x["Detector"].alias("Detector"), x["CallPhase"].alias("CallPhase"),
        x["vol_rc"].alias("vol_rc"), x["vol_ac"].alias("vol_ac"), x["bad_day"].alias("bad_day"))).alias("data"))


def read_signal_details(nested: DataFrame) -> DataFrame:
    """One row per detector and hour of nested signal details; an unknown phase reads as 0."""
    flat = nested.select("SignalID", "date", F.inline("data"))
    stamp = (tp.ntz("date") + tp.day_interval(hours=F.col("Hour"))).cast("timestamp_ntz")
    return flat.select("SignalID", stamp.alias("Timeperiod"), "Detector", F.coalesce("CallPhase", F.lit(0)).alias("CallPhase"),
                       "vol_rc", "vol_ac", "bad_day")


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)
