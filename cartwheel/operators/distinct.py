"""Several distinct counts at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(rows: DataFrame, by: list[str], counts: dict[str, tuple[str, Column | None]]) -> DataFrame:
    """Per group the number of distinct values of columns, each optionally over the rows that meet a condition.

    ``counts`` maps a result name to (column, condition). For each column the rows shrink, before they are shuffled, to
    one per group and value with a flag per count, and the flags are added up. The rows are read once per column, not
    copied per count, and a group of any size is spread over the values. NULL values do not count.
    """
    columns = list(dict.fromkeys(column for column, _ in counts.values()))

    def counted(column: str, condition: Column | None) -> Column:
        known = F.col(column).isNotNull()
        return F.when(known if condition is None else known & condition, 1).otherwise(0)

    # a count may bear the name of a column
    flags = {f"_flag_{i}": what for i, what in enumerate(counts.values())}
    parts = [
        rows.groupBy(*by, column).agg(*[F.max(counted(*what)).alias(flag) for flag, what in flags.items() if what[0] == column]).drop(column)
        for column in columns
    ]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.groupBy(*by).agg(*[F.sum(flag).alias(name) for flag, name in zip(flags, counts)])


def daily_bitmaps(rows: DataFrame, day: str, by: list[str], column: str) -> DataFrame:
    """Mergeable state of a distinct count: per day and group one bitmap for every 32,768 whole numbers that occur.

    Exact, and made for serial ids: a bitmap has four kilobytes (far less when compressed) however few of its numbers occur.
    NULL values do not count.
    """
    return (rows.filter(F.col(column).isNotNull()).groupBy(day, *by, F.bitmap_bucket_number(column).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("bitmap")))


def distinct_of(state: DataFrame, by: list[str], out: str) -> DataFrame:
    """Distinct values per group from the bitmaps of any days: a number of the same bucket in several bitmaps counts once."""
    merged = state.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    return merged.groupBy(*by).agg(F.sum("n").alias(out))


def rolling_distinct(state: DataFrame, day: str, by: list[str], days: int, out: str) -> DataFrame:
    """Distinct values per group over the ``days`` days up to each day that has state."""
    open_days = state.select(day).distinct().withColumnRenamed(day, "_day")  # bounded by the calendar
    spread = state.withColumn("_until", F.explode(F.sequence(F.col(day), F.date_add(day, days - 1)))).drop(day)
    inside = spread.join(F.broadcast(open_days), F.col("_until") == F.col("_day"), "left_semi").withColumnRenamed("_until", day)
    return distinct_of(inside, [day, *by], out)
