"""Order-dependent helpers: carry a value along a key's events, as-of lookups, runs.

A key can own a large part of all events, so nothing here sorts a whole key in one task.  Events are
split into (key, time bucket) groups; each group is filled on its own, and the value a bucket hands
to the next one comes from a small per-bucket summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType, VariantType

from greenwave.functions.timeparts import col, floor_minutes

BUCKET_MINUTES = 60


#: A value that stands for NULL in a grouping key, by type.
_LOWEST = {"tinyint": -(1 << 7), "smallint": -(1 << 15), "int": -(1 << 31), "bigint": -(1 << 63), "double": float("-inf"), "float": float("-inf"), "boolean": False,
           "string": "", "date": "0001-01-01", "timestamp": "0001-01-02 00:00:00", "timestamp_ntz": "0001-01-01 00:00:00"}


def never_null(df: DataFrame, name: str) -> Column:
    """The column with NULL as the lowest value of its type, for grouping keys.

    Of such a key Catalyst knows that it has no NULL, so a join adds no filter to one of its sides.  Two sides
    that read one shuffled table then stay alike down to it, and Spark makes that table once.
    """
    kind = df.schema[name].dataType.simpleString()
    if kind not in _LOWEST:
        raise ValueError(f"{name}: no key of type {kind}")
    return F.coalesce(F.col(name), F.lit(_LOWEST[kind]).cast(kind))


def carry(df: DataFrame, keys: Sequence[str], ts: str, values: dict[str, Column], order: Sequence = (),
          backward: bool = False, bucket_minutes: int = BUCKET_MINUTES, inclusive: bool = True,
          peers: bool = False) -> DataFrame:
    """Last (or, backward, next) non-null value at every row of a key.

    ``order`` breaks ties between rows with the same ``ts``, then the other columns do.  Rows whose key is NULL are
    a key of their own.  ``inclusive=False`` looks only at the other rows before (after) this one; ``peers=True`` looks
    at every row of the same instant as well.

    ``df`` is laid out by (key, bucket) once.  What a bucket hands on and the filling inside it both read
    that layout, and what is handed comes back to it by a join that moves only the few handed rows.
    """
    order = [col(o) for o in order]
    names = df.columns
    df = df.withColumn("_b", floor_minutes(ts, bucket_minutes))
    groups = [f"_g{k}" for k in range(len(keys))]
    df = df.withColumns({**{g: never_null(df, k) for g, k in zip(groups, keys, strict=True)}, "_b": never_null(df, "_b")}).repartition(*groups, "_b")
    others = [F.col(f"`{c}`") for c in names if c != ts and not isinstance(df.schema[c].dataType, (MapType, VariantType))]
    by = [F.col(ts), *order]
    # looking back means reading the rows in reverse: a frame that grows is linear, one that shrinks is not
    turn = (lambda c: c.desc()) if backward else (lambda c: c.asc())
    edge = F.min_by if backward else F.max_by
    w = Window.partitionBy(*groups, "_b").orderBy(*[turn(c) for c in (by if peers else [*by, *others])])
    if peers:
        frame = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    across = Window.partitionBy(*groups).orderBy(turn(F.col("_b"))).rowsBetween(Window.unboundedPreceding, -1)

    rank = F.struct(*by, *others)  # all columns, as in the windows: else the two readers would need different columns of the layout
    tails = df.groupBy(*groups, "_b").agg(
        *[edge(v, F.when(v.isNotNull(), rank)).alias(f"_t_{n}") for n, v in values.items()])
    handed = tails.select(*groups, "_b", *[
        F.last(f"_t_{n}", ignorenulls=True).over(across).alias(f"_h_{n}") for n in values])
    inside = df.select("*", *[F.last(v, ignorenulls=True).over(frame).alias(f"_w_{n}") for n, v in values.items()])
    joined = inside.join(handed, [*groups, "_b"], "left")
    keep = [c for c in names if c not in values]
    return joined.select(*keep, *[F.coalesce(f"_w_{n}", f"_h_{n}").alias(n) for n in values])


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
         take: Sequence[str], **kw) -> DataFrame:
    """Each left row with the columns of the latest right row of its key at or before it.

    Unmatched left rows get NULLs.  Ties among right rows go to the largest ``take`` values.
    """
    marks = right.select(*keys, F.col(right_ts).alias("_ts"), F.struct(*take).alias("_r"))
    rows = left.select(*keys, F.col(left_ts).alias("_ts"),
                       F.struct(*[c for c in left.columns]).alias("_l"))
    both = marks.unionByName(rows, allowMissingColumns=True)
    side = F.col("_l").isNotNull().cast("int")  # right rows first at equal times
    filled = carry(both, keys, "_ts", {"_m": F.col("_r")}, order=[side, F.col("_r")], **kw)
    return filled.where(F.col("_l").isNotNull()).select("_l.*", *[F.col(f"_m.{c}").alias(c) for c in take])


def streak_length(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str,
                  cap: int | None = None) -> DataFrame:
    """Length so far of the current run of equal values; keys own few rows (a day of periods)."""
    w = Window.partitionBy(*keys).orderBy(order)
    same = F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1)
    # row number less that of the run's first row: every step uses one window and one sort
    run = df.withColumns({"_new": ~same, "_n": F.row_number().over(w)})
    first = F.max(F.when(F.col("_new"), F.col("_n"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    length = F.col("_n") - first + 1
    if cap:
        length = F.least(length, F.lit(cap))
    return run.withColumn(name, length).drop("_new", "_n")


def last_change(df: DataFrame, keys: Sequence[str], order: str, condition: Column, name: str) -> DataFrame:
    """The latest ``order`` value at which the condition held, up to this row."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(F.when(condition, F.col(order)), ignorenulls=True).over(w))
