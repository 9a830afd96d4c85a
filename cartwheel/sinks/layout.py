"""Clustering rows along a space-filling curve, so that filters on any of several columns skip row groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# each column is cut into 2 ** BITS parts with about as many rows each
BITS = 6
ACCURACY = 1000


def quantile_edges(rows: DataFrame, columns: list[Column], bits: int = BITS) -> list[list]:
    """Per column the values that cut its rows into 2 ** bits parts; one pass, and so many numbers a column on the driver."""
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    found = rows.agg(*[F.percentile_approx(c, shares, ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return [list(edges or []) for edges in found]


def part_of(value: Column, edges: list) -> Column:
    """How many edges lie below the value, by halving; NULL comes first."""
    def halved(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value > F.lit(edges[middle]), halved(middle + 1, high)).otherwise(halved(low, middle))

    return halved(0, len(edges)).cast("bigint")


def curve(columns: list[Column], edges: list[list], bits: int = BITS) -> Column:
    """The place of a row on the Z curve: the bits of its parts in turn, the highest first."""
    place = F.lit(0).cast("bigint")
    parts = [part_of(c, e) for c, e in zip(columns, edges)]
    for bit in reversed(range(bits)):
        for part in parts:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(part, bit).bitwiseAND(F.lit(1).cast("bigint")))
    return place


def along_curve(rows: DataFrame, columns: list[Column], bits: int = BITS) -> Column:
    """The sort key of ``rows`` for clustering by the columns (numbers; times as such)."""
    return curve(columns, quantile_edges(rows, columns, bits), bits)


def clustered(rows: DataFrame, columns: list[Column], files: int, bits: int = BITS) -> DataFrame:
    """``rows`` in ``files`` ranges of the curve, sorted along it."""
    key = along_curve(rows, columns, bits)
    return rows.withColumn("_place", key).repartitionByRange(files, "_place").sortWithinPartitions("_place").drop("_place")
