"""Joins against a lookup side whose size is checked first."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a few short columns, so about 10 MB: the size Spark itself broadcasts by default.
SMALL_ROWS = 200_000
# A dimension of a few short columns, so about 60 MB per executor.
DIMENSION_ROWS = 1_000_000


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left",
                bound: DataFrame | None = None, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Join a lookup table, broadcasting it only when counted to be small.

    ``bound`` may be any DataFrame known to have at least as many rows as ``right`` but cheaper to
    count (the stored table below a view). Above ``max_rows`` this is a shuffled join, where
    adaptive execution splits skewed partitions of the left side.
    """
    if (right if bound is None else bound).count() <= max_rows:
        right = F.broadcast(right)
    return left.join(right, on, how)


def value_ranges(rows: DataFrame, column: str, pieces: int = 64) -> list[tuple[int, int]]:
    """At most ``pieces`` closed ranges that together hold every value of a whole-number column."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return []
    width = (high - low) // pieces + 1
    piece = F.floor((F.col(column) - F.lit(low)) / F.lit(width))
    found = rows.filter(F.col(column).isNotNull()).groupBy(piece.alias("piece")).agg(F.min(column).alias("a"), F.max(column).alias("b"))
    return sorted((r.a, r.b) for r in found.collect())


def within(column: str, ranges: list[tuple[int, int]]) -> Column:
    """Whether the column lies in one of the ranges: plain comparisons, which a scan checks against its statistics."""
    return reduce(or_, [F.col(column).between(a, b) for a, b in ranges], F.lit(False))
