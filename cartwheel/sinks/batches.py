"""Tables that a stream appends to: partitions with one folder per batch.

A batch is written aside, whole, and then its folders, which bear its name, are renamed into the table. A repeated batch
goes on where the earlier attempt ended: what it had written aside is published, what was published stays as it is, under
the same file names, so a stream that follows the table sees no file twice. The files are plain: readers list them,
retention may delete them, and old batches of a partition can be folded into one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.sinks import files
from cartwheel.sinks.upkeep import TARGET_FILE_BYTES, list_files, sized_session

BATCH = "batch"
FOLDED = "folded-"


def query_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives to a query when its checkpoint begins."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def batch_name(spark: SparkSession, checkpoint: str, number: int) -> str:
    """Batch numbers start again when a checkpoint is reset, so the name bears the identity of the query too."""
    return f"{query_identity(spark, checkpoint)}-{number:010d}"


def write_batch(rows: DataFrame, path: str, by: list[str], name: str) -> None:
    """Add the rows of a batch to the partitioned table, unless the batch is there already."""
    spark, aside = rows.sparkSession, f"{path}/_batches"
    stage, done = f"{aside}/{name}", f"{aside}/{name}.done"
    if files.exists(spark, done):
        return
    if not files.exists(spark, f"{stage}/_SUCCESS"):
        (rows.withColumn(BATCH, F.lit(name)).hint("rebalance", *by).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy(*by, BATCH).parquet(stage))
    for folder in files.leaves(spark, stage):
        files.move(spark, f"{stage}/{folder}", f"{path}/{folder}")
    files.touch(spark, done)
    # only the last batch can be repeated
    for old in files.names(spark, aside):
        if old != f"{name}.done":
            files.delete(spark, f"{aside}/{old}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The table without the folder names. With a ``schema`` it may hold no rows yet."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).drop(BATCH)


def _days(listed: DataFrame) -> DataFrame:
    """The files with the folder of their partition and the name of their batch."""
    return (listed.withColumn("partition", F.regexp_extract("folder", f"^(.*)/{BATCH}=[^/]*$", 1))
            .withColumn(BATCH, F.regexp_extract("folder", f"/{BATCH}=([^/]*)$", 1)))


def fold_batches(spark: SparkSession, path: str, by: list[str], target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Fold the batches of every partition with more files than its bytes need into one; returns the partitions folded.

    The batch written last may still be repeated by its query, so it is left alone; all before it are committed. A stream
    may go on writing meanwhile. The folded rows are written aside, in ``_fold``, together with the list of the folders
    they replace. Then each partition loses those folders and gets the folded one, by renaming, so readers may miss a
    partition's rows for a moment but never see them twice. A run that died there is finished by the next one.
    """
    aside = f"{path}/_fold"
    if files.exists(spark, f"{aside}/sources/_SUCCESS"):
        _finish(spark, path, aside)
    files.delete(spark, aside)
    listed = _days(list_files(spark, path)).filter(f"{BATCH} <> ''")
    last = listed.filter(~F.col(BATCH).startswith(FOLDED)).agg(F.max_by(BATCH, F.struct("modificationTime", BATCH)).alias("b")).first().b
    old = listed.filter(F.col(BATCH) != F.lit(last or ""))
    crowded = (old.groupBy("partition").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.collect_set("folder").alias("folders"))
               .filter(F.col("files") > F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1))))
    found = crowded.select("partition", "folders").collect()  # folder names of the crowded partitions
    if not found:
        return 0
    folders = [f for r in found for f in r.folders]
    rows = sized_session(spark, target_bytes).read.option("basePath", path).parquet(*folders)
    rows.withColumn(BATCH, F.lit(FOLDED + uuid.uuid4().hex)).hint("rebalance", *by).write.partitionBy(*by, BATCH).parquet(f"{aside}/rows")
    spark.createDataFrame([(f,) for f in folders], "folder STRING").coalesce(1).write.parquet(f"{aside}/sources")
    _finish(spark, path, aside)
    files.delete(spark, aside)
    return len(found)


def _finish(spark: SparkSession, path: str, aside: str) -> None:
    """Put the folded folders in the place of their sources; what is done already stays done."""
    files.each(files.delete, spark, [r.folder for r in spark.read.parquet(f"{aside}/sources").collect()])
    for folded in files.leaves(spark, f"{aside}/rows"):
        files.move(spark, f"{aside}/rows/{folded}", f"{path}/{folded}")
