"""Ranks and medians over large groups, without putting a group into one task.

Values are counted first (equal values become one row, combined on the map side). The distinct
values of a group are cut into bins by a fixed function of the value, about 6 % wide, so that a
window runs over one bin of a group; the rows of the other bins enter as one number. The bins do
not depend on the data, so a recomputed task after a lost executor cuts them the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

BINS_PER_DOUBLING = 12


def value_bin(value: Column) -> Column:
    """Integer that never decreases as the value grows; symmetric around zero, NULL for NULL."""
    size = F.floor(F.log2(F.abs(value.cast("double")) + 1.0) * BINS_PER_DOUBLING)
    return F.when(value < 0, -size - 1).otherwise(size).cast("int")


def value_positions(df: DataFrame, group: list[str], value: str, descending: bool) -> DataFrame:
    """Distinct values per group: ``n`` rows have the value, ``before`` rows sort ahead of it, ``total`` are in the group."""
    counted = (
        df.groupBy(*group, value).agg(F.count("*").alias("n")).withColumn("_bin", value_bin(F.col(value)))
    )

    def ordered(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    bins = counted.groupBy(*group, "_bin").agg(F.sum("n").alias("_in_bin"))
    over_bins = Window.partitionBy(*group)
    bins = bins.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        F.col("_bin").alias("_b"),
        (F.sum("_in_bin").over(over_bins.orderBy(ordered("_bin")).rowsBetween(Window.unboundedPreceding, 0))
         - F.col("_in_bin")).alias("_ahead"),
        F.sum("_in_bin").over(over_bins).alias("total"),
    )
    same_bin = F.col("_bin").eqNullSafe(F.col("_b"))
    for i, c in enumerate(group):
        same_bin = same_bin & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    inside = Window.partitionBy(*group, "_bin").orderBy(ordered(value)).rowsBetween(Window.unboundedPreceding, 0)
    return (
        counted.withColumn("_upto", F.sum("n").over(inside))
        .join(bins, same_bin, "inner")
        .select(*group, value, "n", (F.col("_ahead") + F.col("_upto") - F.col("n")).alias("before"), "total")
    )


def with_ranks(df: DataFrame, group: list[str], ranks: dict[str, str], total: str | None = None) -> DataFrame:
    """Add ranks of each row in its group: ``ranks`` maps a value column to the name of its rank column.

    Descending, ties share a rank and gaps follow; NULL comes last. Values must be exact (integer or
    decimal). ``total`` names an optional column for the number of rows in the group. Every value
    column reads ``df`` once more, so pass a stored table (see ``session.materialise``), not a long plan.
    """
    out = df
    for i, (value, name) in enumerate(ranks.items()):
        positions = value_positions(df, group, value, descending=True)
        columns = [F.col(c).alias(f"_k{j}") for j, c in enumerate(group)]
        columns += [F.col(value).alias("_v"), (F.col("before") + 1).alias(name)]
        if total and i == 0:
            columns.append(F.col("total").alias(total))
        on = F.col(value).eqNullSafe(F.col("_v"))
        for j, c in enumerate(group):
            on = on & F.col(c).eqNullSafe(F.col(f"_k{j}"))
        out = out.join(positions.select(*columns), on, "inner").drop("_v", *[f"_k{j}" for j in range(len(group))])
    return out


def exact_median(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """Median per group: the middle value, or the mean of the two middle ones. NULLs are ignored."""
    known = df.filter(F.col(value).isNotNull())
    first, last = F.col("before"), F.col("before") + F.col("n")
    lower, upper = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    holds_lower = (first <= lower) & (lower < last)
    holds_upper = (first <= upper) & (upper < last)
    positions = value_positions(known, group, value, descending=False)
    return (
        positions.filter(holds_lower | holds_upper)
        .groupBy(*group)
        .agg(((F.min(value).cast("double") + F.max(value).cast("double")) / 2).alias(out))
    )
