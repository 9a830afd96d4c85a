"""Change-feed operators: flatten envelopes, keep the newest event per key, merge into a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F


def event_key(feed: DataFrame, pk: str) -> Column:
    """Key of the changed row, from whichever image the envelopes carry: a delete only has the one before."""
    return F.coalesce(*[F.col(image)[pk] for image in ("after", "before") if image in feed.columns])


def flatten(feed: DataFrame, pk: str = "id") -> DataFrame:
    """Envelopes (``schemas.envelope``) → flat rows: op, ts_ms, key, the columns after the change, is_deleted; ``lsn`` breaks ties."""
    position = F.col("source")["lsn"] if "source" in feed.columns else F.lit(None).cast("bigint")
    parts = feed.select("op", "ts_ms", event_key(feed, pk).alias(pk), F.col("after").dropFields(pk).alias("_image"),
                        F.col("op").eqNullSafe("d").alias("is_deleted"), position.alias("lsn"))
    return parts.select("op", "ts_ms", pk, "_image.*", "is_deleted", "lsn")


def split_keyless(rows: DataFrame, pk: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows without one). A row without a key can never match and is set aside."""
    return rows.filter(F.col(pk).isNotNull()), rows.filter(F.col(pk).isNull())


def latest_per_key(rows: DataFrame, pk: str, order: tuple[str, ...] = ("ts_ms", "lsn")) -> DataFrame:
    """Newest row per key.

    The filter on the row number makes Spark keep one row per key in every map task before the
    shuffle, so a key with a third of all events sends one row per task.
    """
    newest_first = Window.partitionBy(pk).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn("_n", F.row_number().over(newest_first)).filter(F.col("_n") == 1).drop("_n")


def merge_changes(target: DataFrame, changes: DataFrame, pk: str, guard: bool = True) -> DataFrame:
    """Target after applying one change per key.

    delete on a known key: flag it and take the event time; other change on a known key: replace
    all columns (a deleted row comes back); change on an unknown key: insert. ``guard`` ignores
    changes older than the row they would replace, and keeps a delete of an unknown key as a
    tombstone (op 'd'), so that an older change that arrives after it is ignored too: which rows are
    live, and what they hold, does not depend on how the feed is cut into batches. Without it
    whatever arrives last wins and such a delete leaves nothing.
    """
    old = target.select(F.struct("*").alias("old"), F.col(pk).alias("_old_key"))
    new = changes.select(F.struct("*").alias("new"), F.col(pk).alias("_new_key"))
    both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")

    known = F.col("_old_key").isNotNull()
    current = F.lit(True)
    if guard:
        newer, same = F.col("new.ts_ms") > F.col("old.ts_ms"), F.col("new.ts_ms") == F.col("old.ts_ms")
        if "lsn" in target.columns and "lsn" in changes.columns:  # the log position decides ties, in whatever batch they come
            same = same & F.coalesce(F.col("new.lsn") >= F.col("old.lsn"), F.lit(True))
        current = F.coalesce(newer | same, F.lit(True))
    op = F.col("new.op")
    replaced = F.coalesce((op != "d") & (~known | current), F.lit(False))
    deleted = F.coalesce((op == "d") & known & current, F.lit(False))
    if guard:
        replaced = replaced | (~known & op.eqNullSafe("d"))

    def merged(column: str) -> Column:
        kept = F.col(f"old.{column}")
        if column == "is_deleted":
            kept = F.when(deleted, F.lit(True)).otherwise(kept)
        if column in ("ts_ms", "lsn"):
            kept = F.when(deleted, F.col(f"new.{column}")).otherwise(kept)
        return F.when(replaced, F.col(f"new.{column}")).otherwise(kept).alias(column)

    return both.filter(known | replaced).select(*[merged(c) for c in target.columns])


def initial_rows(changes: DataFrame, guard: bool = True) -> DataFrame:
    """Rows of a table that does not exist yet: every change; deletes are tombstones, or left out without ``guard``."""
    return changes.filter(F.col("op").isNotNull() if guard else F.col("op") != "d")


def without_tombstones(rows: DataFrame) -> DataFrame:
    """Rows that once held something; a row deleted after it was known keeps the op of its last image."""
    return rows.filter(~F.col("op").eqNullSafe("d"))


def live(rows: DataFrame) -> DataFrame:
    """Rows not flagged as deleted; an unknown flag counts as deleted."""
    return rows.filter(~F.col("is_deleted"))
