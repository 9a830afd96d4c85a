"""States over time, stored only when they change.

A day adds the rows that differ from what is known, as versions valid from that day; the first day of a month adds all, so
any day can be rebuilt from its own month. Valid until is the next version of the key in the month, or the month's end.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.sinks import files
from cartwheel.sinks.tables import overwrite_partitions

MONTH, FROM, GONE = "month", "valid_from", "is_gone"


def _stored(spark: SparkSession, path: str, first: date, last: date) -> DataFrame | None:
    """Versions of the months of the two days, up to the last one."""
    if not files.has_data(spark, path):
        return None
    rows = spark.read.option("mergeSchema", False).parquet(path)
    return rows.filter(F.col(MONTH).between(f"{first:%Y-%m}.", f"{last:%Y-%m}.") & (F.col(FROM) <= F.lit(last)))


def state_on(spark: SparkSession, path: str, key: str, day: date) -> DataFrame | None:
    """The rows as they were on ``day``, without those that were gone."""
    versions = _stored(spark, path, day, day)
    if versions is None:
        return None
    newest = versions.groupBy(key).agg(F.max_by(F.struct(*[c for c in versions.columns if c not in (key, MONTH)]), FROM).alias("v"))
    return newest.select(key, "v.*").filter(~F.col(GONE)).drop(GONE, FROM)


def append_state(rows: DataFrame, path: str, key: str, day: date) -> bool:
    """Store the rows of ``day`` that differ from the day before, and which keys are gone.

    A day can be written again, with the same result, until a later one has been; then nothing is done and False returned.
    """
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c != key]
    month = f"{day:%Y-%m}."  # the point keeps the folder name a text
    if files.has_data(spark, path) and not spark.read.parquet(path).filter(F.col(FROM) > F.lit(day)).isEmpty():
        return False
    before = _stored(spark, path, day, day)
    before = before.filter(F.col(FROM) < F.lit(day)) if before is not None else None
    if before is None or before.isEmpty():
        changed = rows.withColumn(GONE, F.lit(False))
    else:
        known = before.groupBy(key).agg(F.max_by(F.struct(*columns, GONE), FROM).alias("old")).withColumnRenamed(key, "_key")
        both = rows.withColumn("new", F.struct(*columns, F.lit(False).alias(GONE))).join(known, F.col(key) == F.col("_key"), "full_outer")
        gone = F.col(key).isNull() & ~F.col(f"old.{GONE}")
        differs = F.col(key).isNotNull() & ~F.col("new").eqNullSafe(F.col("old"))
        kept = both.filter(gone | differs)
        value = F.when(F.col(key).isNull(), F.col("old")).otherwise(F.col("new"))
        changed = kept.select(F.coalesce(key, "_key").alias(key), *[value[c].alias(c) for c in columns], F.col(key).isNull().alias(GONE))
    overwrite_partitions(changed.withColumn(MONTH, F.lit(month)).withColumn(FROM, F.lit(day)), path, [MONTH, FROM])
    return True


def on_days(spark: SparkSession, path: str, key: str, first: date, last: date, day: str = "day") -> DataFrame:
    """The rows of every day from ``first`` to ``last``, with the day.

    Versions and days meet by month, then by the interval. There are as many days as asked for, so they are broadcast.
    """
    versions = _stored(spark, path, first, last)
    if versions is None:
        raise FileNotFoundError(f"no states at {path}")
    end = F.add_months(F.to_date(F.concat(MONTH, F.lit("01")), "yyyy-MM.dd"), 1)
    until = F.coalesce(F.lead(FROM).over(Window.partitionBy(key, MONTH).orderBy(FROM)), end)
    days = (spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias(day))
            .withColumn("_month", F.date_format(day, "yyyy-MM.")))
    joined = versions.withColumn("_until", until).filter(~F.col(GONE)).join(
        F.broadcast(days), (F.col(MONTH) == F.col("_month")) & (F.col(FROM) <= F.col(day)) & (F.col(day) < F.col("_until")))
    return joined.drop(MONTH, FROM, GONE, "_until", "_month")
