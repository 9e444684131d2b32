"""How many tasks a table is dealt over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

ROWS_PER_TASK = 500_000


def laid_out(df: DataFrame, keys: Sequence[str], rows: int, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` dealt by ``keys`` over a number of tasks that follows its number of rows (``rows``, or about that).

    Left alone, Spark sizes tasks by their compressed bytes.  Names and calendars that repeat shrink to a few bytes a row, so a
    task would get millions of rows, all of which its sorts and hash tables hold unpacked.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task))
    return df.repartition(tasks, *keys)
