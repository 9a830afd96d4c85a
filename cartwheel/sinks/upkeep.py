"""Table upkeep: file statistics, compaction, expiry, retention."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import materialise
from cartwheel.sinks import files
from cartwheel.sinks.tables import complete_versions, overwrite_partitions

TARGET_FILE_BYTES = 128 * 1024 * 1024
VERSION_DAYS = 7
# --- fixed values: days that landed objects are kept, by path prefix; other prefixes stay forever ---
RETENTION_DAYS = {"clickstream/": 7, "checkpoints/": 7, "cdc_postgres/": 7, "api_exchange_rates/": 30}


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, folder, length, modificationTime) of the files below ``path``; contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        .load(path).select("path", "length", "modificationTime")
    )
    return listed.withColumn("folder", F.regexp_replace("path", "/[^/]+$", ""))


def crowded_folders(listed: DataFrame, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Folders with more files than their bytes need."""
    return listed.groupBy("folder").agg(F.count("*").alias("files"), F.sum("length").alias("bytes")).withColumn(
        "needed", F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1))).filter("files > needed")


def sized_session(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A session of its own in which rebalanced writes make files of about ``target_bytes``; no other work sees the setting."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return own


def compact(spark: SparkSession, path: str, by: list[str], target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite the crowded partitions of a partitioned table with files of about ``target_bytes``.

    Returns the number of partitions rewritten. The partition list is bounded by the table's folders.
    The rows are copied to ``_compact`` inside the table (hidden from readers) before partitions are
    replaced. If a run dies while replacing, run it again before the next write: partitions that are
    gone come back from the copy, those still there are left alone. A table written by a streaming
    file sink is refused: the log of the sink lists its files, and readers follow that log.
    """
    if files.exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} belongs to a streaming file sink")
    copy = f"{path}/_compact"
    own = sized_session(spark, target_bytes)
    if files.exists(spark, f"{copy}/_SUCCESS"):
        saved = own.read.parquet(copy)
        if files.has_data(spark, path):
            there = own.read.parquet(path).select(*[F.col(c).alias(f"_{c}") for c in by]).distinct()
            same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
            saved = saved.join(there, same, "left_anti")
        overwrite_partitions(saved, path, by)
    files.delete(spark, copy)
    folders = [r.folder for r in crowded_folders(list_files(spark, path), target_bytes).select("folder").collect()]
    if not folders:
        return 0
    rows = spark.read.option("basePath", path).parquet(*folders)
    rows.write.parquet(copy)
    overwrite_partitions(own.read.schema(rows.schema).parquet(copy), path, by)
    files.delete(spark, copy)
    return len(folders)


def expired_versions(versions: DataFrame, as_of: Column, days: int = VERSION_DAYS) -> DataFrame:
    """Versions older than ``days``, per table (columns table, version, written); the newest one is never expired."""
    newest = versions.groupBy("table").agg(F.max("version").alias("newest"))
    cutoff = F.date_sub(as_of, days)
    return (
        versions.join(newest, "table")
        .filter((F.col("version") < F.col("newest")) & (F.to_date("written") < cutoff))
        .drop("newest")
    )


def expire_versions(spark: SparkSession, path: str, as_of: date, days: int = VERSION_DAYS) -> list[int]:
    """Delete superseded versions of one table. Returns the versions deleted."""
    if not complete_versions(spark, path):
        return []
    written = (
        list_files(spark, path)
        .select(F.lit(path).alias("table"), F.col("modificationTime").alias("written"),
                F.regexp_extract("path", r"/version=(\d+)/", 1).try_cast("int").alias("version"))
        .groupBy("table", "version").agg(F.max("written").alias("written"))
    )
    complete = written.filter(F.col("version").isin(complete_versions(spark, path)))
    old = sorted(r.version for r in expired_versions(complete, F.lit(as_of), days).select("version").collect())
    for version in old:
        files.delete(spark, f"{path}/version={version}")
    return old


def table_stats(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(table, files, bytes, versions) per named path."""
    def one(name: str, path: str) -> DataFrame:
        version = F.nullif(F.regexp_extract("path", r"/version=(\d+)/", 1), F.lit(""))
        return list_files(spark, path).agg(
            F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
            F.countDistinct(version).alias("versions")).select(F.lit(name).alias("table"), "files", "bytes", "versions")

    return reduce(DataFrame.unionByName, [one(name, path) for name, path in tables.items()])


def expired_objects(objects: DataFrame, as_of: Column, rules: dict[str, int] | None = None) -> DataFrame:
    """Objects (key, written) past the retention of their prefix, with the days kept."""
    kept = F.coalesce(*[F.when(F.col("key").startswith(prefix), F.lit(days))
                        for prefix, days in (rules or RETENTION_DAYS).items()])
    return objects.withColumn("days_kept", kept).filter(F.to_date("written") < F.date_sub(as_of, F.col("days_kept")))


def apply_retention(spark: SparkSession, root: str, as_of: date, rules: dict[str, int] | None = None) -> int:
    """Delete what is past retention below ``root``; returns the number of folders and files deleted.

    A folder whose objects are all expired goes at once (landing folders are dated, so that is the
    usual case); single expired files of other folders follow one partition of the list at a time. Several
    are deleted at once. Tables of a streaming file sink are refused: their log would go on listing the files.
    """
    marker = root.rstrip("/") + "/"
    for prefix in rules or RETENTION_DAYS:
        table = prefix.rstrip("/")
        tables = [table, *[f"{table}/{name}" for name in files.subfolders(spark, marker + table)]]
        if any(files.exists(spark, f"{marker}{t}/_spark_metadata") for t in tables):
            raise ValueError(f"{marker}{prefix} belongs to a streaming file sink")
    listed = list_files(spark, root, "*").select(
        "path", "folder", F.substring_index("path", marker, -1).alias("key"), F.col("modificationTime").alias("written"))
    expired = materialise(expired_objects(listed, F.lit(as_of), rules), "expired")
    kept = listed.join(expired.select("path"), "path", "left_anti").select("folder").distinct()
    whole = expired.join(kept, "folder", "left_anti").select(F.col("folder").alias("target")).distinct()
    single = expired.join(kept, "folder", "left_semi").select(F.col("path").alias("target"))
    targets = materialise(whole.unionByName(single), "targets")
    return files.each(files.delete, spark, (row.target for row in targets.toLocalIterator()))
