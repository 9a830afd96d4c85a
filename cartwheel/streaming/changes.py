"""Change feed → current-state table, incrementally."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.operators.changes import flatten, latest_per_key, split_keyless
from cartwheel.sinks import files
from cartwheel.sinks.batches import BATCH, batch_name, query_identity
from cartwheel.sinks.runs import write_run
from cartwheel.sinks.tables import upsert
from cartwheel.sources.files import BROKEN_LINE, LANDING_ZONE, change_stream, changes_only, missing_ok, with_landing_parts

log = logging.getLogger(__name__)


def land_changes(messages: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds",
                 zone: str = LANDING_ZONE) -> StreamingQuery:
    """Change messages (a binary ``value``) → JSON lines below the day they arrive on in ``zone``, a folder per batch.

    The tombstones that follow deletes are left out. ``every=None`` drains and stops. A batch that is repeated on the same
    day replaces its files; across midnight its lines stand in both days, which the merge does not mind.
    """
    def land(batch: DataFrame, number: int) -> None:
        # a message is one line: line ends can only stand between the tokens of JSON
        line = F.translate(F.col("value").cast("string"), "\r\n", "  ").alias("value")
        lines = with_landing_parts(changes_only(batch).select(line), F.current_timestamp(), zone)
        by = ["year", "month", "day", BATCH]
        (lines.withColumn(BATCH, F.lit(batch_name(batch.sparkSession, checkpoint, number)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).text(path))

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def merge_batches(table: str, silver: str, checkpoint: str, pk: str, buckets: int, guard: bool,
                  rejects: str | None, applied: dict[int, int], sort_by: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: one change per key is added to the table; rows without a key and lines that could not be
    read are set aside below ``rejects`` (default: in the checkpoint folder).

    With ``guard`` a batch is a run of its own (``sinks/runs.py``): what is written follows the batch. Without it the last
    change to arrive wins, which only a merge into the stored rows can tell. ``applied`` receives the number of changes
    per batch. Replaying a batch gives the same table.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        if "before" in batch.columns:  # of that image only the key is used
            batch = batch.withColumn("before", F.struct(F.col("before")[pk].alias(pk)))
        batch = batch.persist()  # read for the changes and for the rejects
        if batch.isEmpty():
            batch.unpersist()
            return
        broken = F.col(BROKEN_LINE).isNotNull()
        keyed, keyless = split_keyless(flatten(batch.filter(~broken), pk), pk)
        lines = batch.filter(broken).select(BROKEN_LINE, F.lit("malformed").alias("reject_reason"))
        set_aside = keyless.withColumn("reject_reason", F.lit(f"missing {pk}")).unionByName(lines, allowMissingColumns=True)
        set_aside.write.mode("overwrite").parquet(f"{rejects or checkpoint + '/rejects'}/batch={batch_id}")
        latest = latest_per_key(keyed, pk).persist()
        try:
            if guard:
                write_run(latest, silver, pk, buckets, batch_name(batch.sparkSession, f"{checkpoint}/offsets", batch_id))
                applied[batch_id] = latest.count()
                return
            # batch numbers start again when the offsets are reset, so the stage bears the identity of the offsets too
            stage = f"{checkpoint}/stage/{query_identity(batch.sparkSession, f"{checkpoint}/offsets")}-{batch_id}"
            upsert(latest, silver, pk, buckets, guard, stage=stage, sort_by=sort_by)
            applied[batch_id] = latest.count()
            # published: a repetition of the batch merges again, which changes nothing
            files.delete(batch.sparkSession, stage)
        finally:
            latest.unpersist()
            batch.unpersist()
            log.info("%s: batch %s, %s changes", table, batch_id, applied.get(batch_id))

    return merge


def run_change_feed(spark: SparkSession, table: str, landing: str, silver: str, checkpoint: str, pk: str = "id",
                    buckets: int = 64, guard: bool = True, rejects: str | None = None,
                    files_per_trigger: int | None = None, sort_by: str | None = None,
                    versions: tuple[str, ...] = ()) -> dict[int, int]:
    """Merge all feed files not seen yet, then stop. Returns changes applied per batch; nothing to read is no error.

    ``versions``: later versions of the table's columns (see ``change_stream``).
    """
    reader = missing_ok(lambda: change_stream(spark, table, landing, files_per_trigger, versions))
    if reader is None:
        log.warning("%s: nothing landed at %s", table, landing)
        return {}
    applied: dict[int, int] = {}
    query = (
        reader.writeStream
        .foreachBatch(merge_batches(table, silver, checkpoint, pk, buckets, guard, rejects, applied, sort_by))
        .option("checkpointLocation", f"{checkpoint}/offsets")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return applied
