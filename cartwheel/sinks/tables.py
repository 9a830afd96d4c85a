"""Parquet tables: partition overwrite, incremental refresh, keyed upsert, versions, registration."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.operators.changes import initial_rows, merge_changes, without_tombstones
from cartwheel.session import materialise, scratch_dir
from cartwheel.sinks import files


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``.

    The rebalance hint gives every partition few, evenly sized files; adaptive execution splits a
    partition that is larger than the rest instead of writing it from one task.
    """
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def delete_insert(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Target without the rows whose key occurs in ``new``, plus ``new``. NULL key parts match NULL."""
    renamed = {k: f"_new_{i}" for i, k in enumerate(keys)}
    new_keys = new.select(*[F.col(k).alias(v) for k, v in renamed.items()]).distinct()
    same = F.lit(True)
    for k, v in renamed.items():
        same = same & F.col(k).eqNullSafe(F.col(v))
    return target.join(new_keys, same, "left_anti").unionByName(new)


def refresh_window(df: DataFrame, path: str, date_col: str, since: date | None = None) -> None:
    """Make the table equal to ``df`` from ``since`` on; earlier dates are not touched.

    The new rows are written aside first, so ``df`` may read the table it replaces. Dates of the
    window that no longer have rows are removed once the new ones are in place.
    """
    spark = df.sparkSession
    fresh = materialise(df, "refresh")
    if since is not None and files.has_data(spark, path):
        old = spark.read.parquet(path).filter(F.col(date_col) >= F.lit(since)).select(date_col).distinct()
        # dates only: the length of the window bounds this list
        vanished = old.join(fresh.select(date_col).distinct(), date_col, "left_anti").collect()
        overwrite_partitions(fresh, path, [date_col])
        for row in vanished:
            files.delete(spark, f"{path}/{date_col}={row[0].isoformat()}")
    else:
        fresh.hint("rebalance", date_col).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy(date_col).parquet(path)


def append_snapshot(df: DataFrame, path: str, date_col: str, day: date) -> bool:
    """Add the snapshot of ``day`` unless it is there already. Returns whether it was written."""
    spark = df.sparkSession
    if files.has_data(spark, path):
        stored = spark.read.parquet(path)
        if not stored.filter(F.col(date_col) == F.lit(day)).isEmpty():
            return False
    overwrite_partitions(df.filter(F.col(date_col) == F.lit(day)), path, [date_col])
    return True


def insert_absent(new: DataFrame, path: str, key: str, order: list[str] | None = None, rejects: str | None = None) -> None:
    """Append the rows whose key is not stored yet; stored rows stay as they are.

    Of several new rows with one key the first by ``order`` (default: all columns) is kept. Rows
    without a key go to ``rejects`` if that is given and are never stored.
    """
    spark = new.sparkSession
    if rejects:
        (new.filter(F.col(key).isNull()).withColumn("reject_reason", F.lit(f"missing {key}"))
         .write.mode("append").parquet(rejects))
    ranked = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order or new.columns])
    new = (new.filter(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(ranked))
           .filter(F.col("_n") == 1).drop("_n"))
    if files.has_data(spark, path):
        new = new.join(spark.read.parquet(path).select(key), key, "left_anti")
    # the files read for the anti join were listed above, the appended ones are not among them
    new.write.mode("append").parquet(path)


# --- keyed upsert ---------------------------------------------------------------------------


def bucket_column(buckets: int) -> str:
    """The bucket count is part of the name: a table cannot be merged with a different count by mistake."""
    return f"bucket_{buckets}"


def bucket_of(pk: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(pk), F.lit(buckets)).cast("int")


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The table without the columns and the tombstones that only the merge needs."""
    stored = spark.read.parquet(path)
    if "op" in stored.columns:
        stored = without_tombstones(stored)
    return stored.drop(*[c for c in stored.columns if c.startswith("bucket_") or c == "lsn"])


def _publish(stage: DataFrame, path: str, bucket: str, sort_by: str | None) -> None:
    """Replace the buckets of the stage. Its files hold one bucket each already, so nothing is shuffled again."""
    (_sorted(stage, bucket, sort_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(bucket).parquet(path))


def _sorted(rows: DataFrame, bucket: str, sort_by: str | None) -> DataFrame:
    return rows.sortWithinPartitions(bucket, sort_by) if sort_by else rows


def upsert(changes: DataFrame, path: str, pk: str, buckets: int = 64, guard: bool = True,
           stage: str | None = None, sort_by: str | None = None) -> None:
    """Merge one change per key into the table at ``path``, which is partitioned by a hash bucket of the key.

    Only the buckets that have changes are read and rewritten. The merged buckets are written to
    ``stage`` before they replace the old ones. If the job dies while replacing them, running it
    again with the same ``stage`` finds the finished stage and only repeats the replacement.
    One writer per table; readers may see some buckets replaced before others.

    Rows are sorted by ``sort_by`` within the files, so that a filter on it skips row groups.
    """
    spark = changes.sparkSession
    bucket = bucket_column(buckets)
    if stage and files.exists(spark, f"{stage}/_SUCCESS"):
        if files.subfolders(spark, stage):
            _publish(spark.read.parquet(stage), path, bucket, sort_by)
        return
    stage = stage or scratch_dir(spark, "merged")
    changes = changes.withColumn(bucket, bucket_of(pk, buckets))
    if files.has_data(spark, path):
        stored = spark.read.parquet(path)
        if bucket not in stored.columns:
            raise ValueError(f"{path} was not written with {buckets} buckets")
        touched = [r[0] for r in changes.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
        merged = merge_changes(stored.filter(F.col(bucket).isin(touched)), changes, pk, guard)
    else:
        merged = initial_rows(changes, guard)
    (_sorted(merged.hint("rebalance", bucket), bucket, sort_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(bucket).parquet(stage))
    if not files.subfolders(spark, stage):
        return  # nothing to store
    _publish(spark.read.schema(merged.schema).parquet(stage), path, bucket, sort_by)


# --- tables that are always rebuilt whole ---------------------------------------------------


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    names = [n for n in files.subfolders(spark, path) if n.startswith("version=")]
    return sorted(int(n.split("=")[1]) for n in names if files.exists(spark, f"{path}/{n}/_SUCCESS"))


def write_version(df: DataFrame, path: str) -> int:
    """Write the table as a new ``version=<n>`` folder; readers switch to it once it is complete."""
    spark = df.sparkSession
    version = max([0, *complete_versions(spark, path)]) + 1
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/version={version}")
    return version


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    versions = complete_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no complete version below {path}")
    return spark.read.parquet(f"{path}/version={versions[-1]}")


# --- names ----------------------------------------------------------------------------------


def create_views(frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def register_tables(spark: SparkSession, database: str, location: str, tables: dict[str, str]) -> list[str]:
    """Create the database and an external table per path where missing. Returns names that are not there afterwards."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    for name, path in tables.items():
        full = f"{database}.{name}"
        if files.has_data(spark, path) and not spark.catalog.tableExists(full):
            spark.catalog.createTable(full, path=path, source="parquet")
            if any("=" in f for f in files.subfolders(spark, path)):
                spark.catalog.recoverPartitions(full)
    return [name for name in tables if not spark.catalog.tableExists(f"{database}.{name}")]
