"""Joins on ranges: interval overlap and band lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


#: Cells of the finest level of the time axis, in minutes; a cell of each further level holds so many of the one below.
UNIT, FAN = 5, 4


def cover(first: Column, last: Column, levels: int) -> Column:
    """The cells (level, number) of a tree over the time axis that make up the finest cells from ``first`` to ``last``: at most
    2 * (FAN - 1) a level, and at the top level as many as it takes."""
    low, high, parts = first, last + 1, []

    def run(level: int, a: Column, b: Column) -> Column:
        made = F.transform(F.sequence(a, b - 1), lambda n: F.struct(F.lit(level).alias("level"), n.alias("cell")))
        return F.when(a < b, made).otherwise(F.array().cast("array<struct<level:int,cell:bigint>>"))

    for level in range(levels):
        if level == levels - 1:
            parts.append(run(level, low, high))
            break
        up, down = F.call_function("div", low + (FAN - 1), F.lit(FAN)), F.call_function("div", high, F.lit(FAN))
        whole = up < down  # some cells of the next level lie inside
        parts += [run(level, low, F.when(whole, up * FAN).otherwise(high)), run(level, F.when(whole, down * FAN).otherwise(high), high)]
        low, high = up, F.greatest(up, down)
    return F.concat(*parts)


def above(cell: Column, levels: int) -> Column:
    """The cells (level, number) that hold a finest cell, one for each level."""
    return F.array(*[F.struct(F.lit(k).alias("level"), F.call_function("div", cell, F.lit(FAN**k)).alias("cell")) for k in range(levels)])


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str],
                 right_span: tuple[str, str], levels: int = 3) -> DataFrame:
    """Pairs of rows of a key whose closed spans touch.

    Of two spans that touch, one begins inside the other.  So every span is laid out twice: by the cells of a tree that
    cover it, and by the cells that hold its begin, one a level.  The begin of one meets the cover of the other in exactly one cell, so each pair
    is found once.  A span of an hour has at most 9 covering cells, one of a day at most 30; with more levels long
    spans take fewer rows and short ones one more for each.  A hot key is spread over its cells.
    """
    def laid(df: DataFrame, span: tuple[str, str], tag: str, begin_first: bool) -> DataFrame:
        lo, hi = span
        at = lambda c: F.expr(f"timestampdiff(MINUTE, TIMESTAMP_NTZ '0001-01-01 00:00:00', {c}) div {UNIT}")
        df = df.where(F.col(lo) <= F.col(hi)).withColumns({f"_{tag}0": at(f"`{lo}`"), f"_{tag}1": at(f"`{hi}`")})
        # kind 0: the left span begins inside the right one; kind 1: the right begins later, inside the left
        kinds = [(above(F.col(f"_{tag}0"), levels), 0 if begin_first else 1), (cover(F.col(f"_{tag}0"), F.col(f"_{tag}1"), levels), 1 if begin_first else 0)]
        named = lambda kind: lambda x: F.struct(F.lit(kind).alias("_kind"), x["level"].alias("_level"), x["cell"].alias("_cell"))
        return df.select("*", F.inline(F.concat(*[F.transform(cells, named(kind)) for cells, kind in kinds]))).drop(f"_{tag}1")

    a, b = laid(left, left_span, "a", True), laid(right, right_span, "b", False)
    pairs = a.join(b, [*keys, "_kind", "_level", "_cell"])
    touching = (F.col(left_span[0]) <= F.col(right_span[1])) & (F.col(left_span[1]) >= F.col(right_span[0]))
    once = (F.col("_kind") == 0) | (F.col("_b0") > F.col("_a0"))
    return pairs.where(touching & once).drop("_kind", "_level", "_cell", "_a0", "_b0")


def band_score(x: Column, edges: Sequence[tuple[float, float]], forward: bool) -> Column:
    """Score of a value from fixed (edge, score) bands.

    forward: the band with the largest edge <= x; otherwise the smallest edge >= x.
    Values outside every band score NULL.
    """
    out = F.lit(None).cast("double")
    ordered = sorted(edges) if forward else sorted(edges, reverse=True)
    for edge, score in ordered:
        hit = x >= F.lit(float(edge)) if forward else x <= F.lit(float(edge))
        out = F.when(hit, F.lit(float(score))).otherwise(out)
    return out
