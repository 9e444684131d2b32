"""Named queries: each pairs a Spark plan with, where one exists, the same question in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType

from greenwave.plans.adapters_sql import with_adapters
from greenwave.session import ship_package
from greenwave.sources.adapters import Tables


@dataclass(frozen=True)
class Query:
    name: str
    plan: Callable[[Tables], DataFrame]
    sql: str | None
    digits: int


QUERIES: dict[str, Query] = {}

# Sums of doubles differ in the last bit with the order of the rows.  Many results are halves or
# eighths, which sit exactly on a rounding edge; this offset moves them off it on both sides.
OFF_EDGE = 3.1e-10


def register(name: str, plan: Callable[[Tables], DataFrame], sql: str | None = None, f: str = "",
             digits: int = 6, extra: dict[str, str] | None = None) -> None:
    """``f`` names the floating columns, rounded alike on both sides."""
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    if sql is not None:
        body = with_adapters(sql, extra)
        cols = f.split('|') if '|' in f else f.split()
        if cols:
            swaps = ", ".join(f'round("{c}" + {OFF_EDGE}, {digits}) AS "{c}"' for c in cols)
            body = f"SELECT * REPLACE ({swaps}) FROM (\n{body}\n) rounded"
        sql = body
    QUERIES[name] = Query(name, plan, sql, digits)


def rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.select(*[
        F.round(F.col(f"`{x.name}`") + F.lit(OFF_EDGE), digits).alias(x.name) if isinstance(x.dataType, (DoubleType, FloatType))
        else F.col(f"`{x.name}`") for x in df.schema])


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return rounded(q.plan(Tables(spark, sf_dir)), q.digits)

    run.__name__ = q.name
    return run


def load_all() -> dict[str, Query]:
    from greenwave.plans import catalog  # noqa: F401  (registers on import)

    return QUERIES
