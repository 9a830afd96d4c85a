"""Keyed tables as runs of changes: a batch appends, readers merge, a job folds.

Below each hash bucket of the key lies one base run and the change runs of the batches since. A batch writes only its own
changes, one row per key, and replaces what an earlier attempt of the same batch wrote. Which row of a key counts is
decided by the event time and the log position alone, so it does not matter how often or in what order runs are read:

- what a row holds is its newest image, that is the newest change that is not a delete;
- it is deleted if its newest change is a delete;
- a key of which only deletes are known is a tombstone that readers do not see.

Folding is tiered. Once a bucket has ``FAN_IN`` runs of single batches they become one run; once all its changes have
``BASE_SHARE`` of the bytes of its base, base and changes become a new base. So a change is rewritten a few times in all,
whatever the size of the table. Folded runs appear beside their sources, which give the same rows again, and the sources go
after that: readers never miss a row, and a run that died on the way is finished by the next.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.operators.changes import without_tombstones
from cartwheel.operators.joins import value_ranges, within
from cartwheel.sinks import files
from cartwheel.sinks.layout import along_curve
from cartwheel.sinks.tables import bucket_column, bucket_of, overwrite_partitions
from cartwheel.sinks.upkeep import list_files

RUN = "run"
BASE, TIER = "base-", "tier-"
FAN_IN = 4
BASE_SHARE = 0.25
# columns that only the merge needs
INTERNAL = ("lsn", "image_ms", "image_lsn", RUN)


def state_rows(changes: DataFrame) -> DataFrame:
    """Flat changes with the time and the log position of their image; a delete has none. Changes without an operation are left out."""
    image = F.col("op") != "d"
    return changes.filter(F.col("op").isNotNull()).withColumn("image_ms", F.when(image, F.col("ts_ms"))).withColumn("image_lsn", F.when(image, F.col("lsn")))


def resolve(rows: DataFrame, pk: str) -> DataFrame:
    """One state row per key. Changes at the same time and position are ranked by what they hold, so the result is the same in any order."""
    last = ["ts_ms", "lsn", "is_deleted"]
    values = [c for c in rows.columns if c not in (pk, "image_ms", "image_lsn", *last)]
    best = rows.groupBy(pk).agg(
        F.max(F.struct("image_ms", "image_lsn", *values)).alias("_image"), F.max(F.struct(*last)).alias("_last"))
    source = {c: "_last" if c in last else "_image" for c in rows.columns}
    return best.select(*[F.col(pk) if c == pk else F.col(f"{source[c]}.{c}").alias(c) for c in rows.columns])


def stored_schema(payload: T.StructType, pk: str, buckets: int) -> T.StructType:
    """Schema of the stored rows of a table: with it, files of older versions of its columns are read as the newest."""
    lead = "op STRING, ts_ms BIGINT"
    tail = f"is_deleted BOOLEAN, lsn BIGINT, image_ms BIGINT, image_lsn BIGINT, {bucket_column(buckets)} INT, {RUN} STRING"
    return T.StructType([*T.StructType.fromDDL(lead), payload[pk], *[f for f in payload if f.name != pk], *T.StructType.fromDDL(tail)])


def write_run(changes: DataFrame, path: str, pk: str, buckets: int, name: str) -> None:
    """Add one change per key as the run ``name``, or replace that run."""
    bucket = bucket_column(buckets)
    known = {f.split("=")[0] for f in files.subfolders(changes.sparkSession, path) if f.startswith("bucket_")}
    if known - {bucket}:
        raise ValueError(f"{path} was not written with {buckets} buckets")
    rows = state_rows(changes).withColumn(bucket, bucket_of(pk, buckets)).withColumn(RUN, F.lit(name))
    overwrite_partitions(rows, path, [bucket, RUN])


def _layout(spark: SparkSession, path: str) -> tuple[list[str], list[str], list[str]]:
    """(current base folders, change folders, base folders that newer ones replace), relative to ``path``."""
    bases, changes = defaultdict(list), []
    for leaf in files.leaves(spark, path):
        bucket, _, run = leaf.partition(f"/{RUN}=")
        bases[bucket].append(leaf) if run.startswith(BASE) else changes.append(leaf)
    return [max(b) for b in bases.values()], changes, [old for b in bases.values() for old in b if old != max(b)]


def is_runs(spark: SparkSession, path: str) -> bool:
    """Whether the table at ``path`` is made of runs."""
    return any(files.subfolders(spark, f"{path}/{b}")[:1] for b in files.subfolders(spark, path)[:1] if b.startswith("bucket_"))


def _read(spark: SparkSession, path: str, folders: list[str], schema: T.StructType | None = None) -> DataFrame:
    """Rows of the folders; without a schema, whose missing columns are NULL, all files are asked for theirs."""
    reader = spark.read.option("basePath", path)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    return reader.parquet(*[f"{path}/{f}" for f in folders])


def _base_schema(spark: SparkSession, path: str, bases: list[str], more: T.StructType) -> T.StructType:
    """The columns of the base written last, and those that only the changes have."""
    newest = spark.read.option("basePath", path).parquet(f"{path}/{max(bases, key=lambda f: f.rpartition(BASE)[2])}").schema
    return T.StructType([*newest, *[f for f in more if f.name not in newest.names]])


def read_state(spark: SparkSession, path: str, pk: str, schema: T.StructType | None = None) -> DataFrame:
    """State rows of all keys, with their bucket. ``schema``: that of the stored rows, where the files differ in more than
    columns added.

    Rows of the base whose key has not changed pass as they are, and filters reach their files. Buckets without changes are
    not compared with any; in the others only the changed keys are grouped.
    """
    bases, changes, _ = _layout(spark, path)
    if not changes:
        return _read(spark, path, bases, schema or _base_schema(spark, path, bases, T.StructType())).drop(RUN)
    stored = _read(spark, path, changes, schema)
    new = stored.drop(RUN)
    if not bases:
        return resolve(new, pk)
    schema = schema or _base_schema(spark, path, bases, stored.schema)
    busy = {f.split("/")[0] for f in changes}
    parts = [[f for f in bases if (f.split("/")[0] in busy) == changed] for changed in (False, True)]
    quiet, base = [_read(spark, path, folders, schema).drop(RUN) if folders else None for folders in parts]
    merged = resolve(new, pk)
    if base is not None:
        keys = new.select(pk).distinct()
        # whole-number keys are looked up only where the changed ones lie
        near = base.filter(within(pk, value_ranges(new, pk))) if isinstance(new.schema[pk].dataType, T.IntegralType) else base
        touched = near.join(keys, pk, "left_semi").unionByName(new, allowMissingColumns=True)
        merged = base.join(keys, pk, "left_anti").unionByName(resolve(touched, pk), allowMissingColumns=True)
    whole = merged if quiet is None else quiet.unionByName(merged, allowMissingColumns=True)
    return whole.select(*[c for c in schema.names if c != RUN])


def read_runs(spark: SparkSession, path: str, pk: str, schema: T.StructType | None = None) -> DataFrame:
    """The table without tombstones and without the columns that only the merge needs."""
    rows = without_tombstones(read_state(spark, path, pk, schema))
    return rows.drop(*INTERNAL, *[c for c in rows.columns if c.startswith("bucket_")])


def _plan(sizes: list, fan_in: int, base_share: float) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """(bucket → runs that become its new base, bucket → runs that become one run) from (folder, bytes, written)."""
    newest = max((r for r in sizes if not r.run.startswith((BASE, TIER))), key=lambda r: (r.written, r.run), default=None)
    by_bucket = defaultdict(list)
    for r in sizes:
        if newest is None or r.run != newest.run:  # the last batch may still be repeated
            by_bucket[r.bucket].append(r)
    whole, tiers = {}, {}
    for bucket, runs in by_bucket.items():
        base = sum(r.bytes for r in runs if r.run.startswith(BASE))
        changes = [r for r in runs if not r.run.startswith(BASE)]
        single = [r.run for r in changes if not r.run.startswith(TIER)]
        if changes and sum(r.bytes for r in changes) >= base_share * base:
            whole[bucket] = [r.run for r in runs]
        elif len(single) >= fan_in:
            tiers[bucket] = single
    return whole, tiers


def _sorted(rows: DataFrame, first: list[str], cluster: list[Column], stored: DataFrame) -> DataFrame:
    """Sorted within the files by the columns, or along a curve through several. Where the curve is cut is seen from the rows
    as they are ``stored``: the folded ones would be computed once more for that."""
    if len(cluster) < 2:
        return rows.sortWithinPartitions(*first, *cluster)
    return rows.withColumn("_place", along_curve(stored, cluster)).sortWithinPartitions(*first, "_place").drop("_place")


def fold_runs(spark: SparkSession, path: str, pk: str, cluster: list[Column] | None = None, fan_in: int = FAN_IN,
              base_share: float = BASE_SHARE, schema: T.StructType | None = None) -> dict[str, int]:
    """Fold what is due; returns how many buckets got a new base and how many a tier. A stream may go on writing meanwhile.

    Folded rows are clustered by ``cluster`` (default: the key) within the files, so that filters on these columns skip
    row groups. The folder list (buckets times runs) is planned on the driver.
    """
    aside = f"{path}/_fold"
    if files.exists(spark, f"{aside}/sources/_SUCCESS"):
        _finish(spark, path, aside)
    files.delete(spark, aside)
    listed = list_files(spark, path).groupBy("folder").agg(F.sum("length").alias("bytes"), F.max("modificationTime").alias("written"))
    sizes = listed.select(F.regexp_extract("folder", f"/(bucket_[^/]*)/{RUN}=", 1).alias("bucket"), F.regexp_extract("folder", f"/{RUN}=([^/]*)$", 1).alias(RUN),
                          "bytes", "written").collect()
    whole, tiers = _plan(sizes, fan_in, base_share)
    if not whole and not tiers:
        return {"base": 0, "tier": 0}
    bases, _, stale = _layout(spark, path)
    old = {f"{b}/{RUN}={r}" for plan in (whole, tiers) for b, runs in plan.items() for r in runs}
    rows = _read(spark, path, [f for f in old if f not in stale], schema)
    bucket = next(c for c in rows.columns if c.startswith("bucket_"))
    number = 1 + max([0, *[int(f.rpartition(BASE)[2]) for f in bases]])
    # whole buckets, tombstones too: an older change may still arrive
    name = (F.when(F.col(bucket).isin([int(b.partition("=")[2]) for b in whole]), F.lit(f"{BASE}{number:010d}"))
            .otherwise(F.lit(f"{TIER}{uuid.uuid4().hex}")))
    folded = resolve(rows.drop(RUN), pk).withColumn(RUN, name)
    (_sorted(folded.hint("rebalance", bucket, RUN), [bucket, RUN], cluster or [F.col(pk)], rows)
     .write.partitionBy(bucket, RUN).parquet(f"{aside}/rows"))
    spark.createDataFrame([(f,) for f in sorted(old)], "folder STRING").coalesce(1).write.parquet(f"{aside}/sources")
    _finish(spark, path, aside)
    files.delete(spark, aside)
    return {"base": len(whole), "tier": len(tiers)}


def _finish(spark: SparkSession, path: str, aside: str) -> None:
    """Publish the folded runs, then delete what they replace; what is done already stays done."""
    for folded in files.leaves(spark, f"{aside}/rows"):
        files.move(spark, f"{aside}/rows/{folded}", f"{path}/{folded}")
    files.each(files.delete, spark, [f"{path}/{r.folder}" for r in spark.read.parquet(f"{aside}/sources").collect()])


def rebuild(rows: DataFrame, path: str, pk: str, buckets: int, cluster: list[Column] | None = None) -> None:
    """Write state rows (``read_state``) as the base of a new table: with another number of buckets, or from another layout."""
    if files.has_data(rows.sparkSession, path):
        raise ValueError(f"{path} holds a table already")
    bucket = bucket_column(buckets)
    plain = rows.drop(*[c for c in rows.columns if c.startswith("bucket_")])
    for column, known in (("image_ms", "ts_ms"), ("image_lsn", "lsn")):
        if column not in plain.columns:
            plain = plain.withColumn(column, F.col(known))
    based = plain.withColumn(bucket, bucket_of(pk, buckets)).withColumn(RUN, F.lit(f"{BASE}{1:010d}")).hint("rebalance", bucket)
    _sorted(based, [bucket], cluster or [F.col(pk)], plain).write.partitionBy(bucket, RUN).parquet(path)
