"""Click events: broker → landed files → silver files; sessions over the stream.

Both jobs write batches as folders that a repetition replaces (``sinks/batches.py``), so a batch may fail at any point and
be run again, landed days may expire, and silver days may be compacted while the stream goes on.
"""

from __future__ import annotations

import logging
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.operators.events import (MESSAGE, REASON, WATERMARK_DELAY, amounts_on_checkout_only, late_tolerant, marked_late,
                                        narrowed, read_messages, with_event_day)
from cartwheel.operators.hygiene import quarantine, reject_reason
from cartwheel.operators.sessions import SESSION_GAP_SECONDS
from cartwheel.sinks import files
from cartwheel.sinks.batches import BATCH, batch_name, write_batch
from cartwheel.sources.files import landed_click_stream, missing_ok

log = logging.getLogger(__name__)


def broker_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Messages of a topic from now on. Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "latest").option("failOnDataLoss", "false")
        .load()
    )


def _set_aside(rows: DataFrame, rejects: str, name: str) -> None:
    """Write the rejected rows of a batch below ``rejects``, by reason, and log how many there are."""
    write_batch(rows, rejects, [REASON], name)
    counts = {r[0]: r[1] for r in rows.groupBy(REASON).count().collect()}  # a row per reason
    if counts:
        log.warning("batch %s: set aside %s", name, counts)


def land_clicks(messages: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds",
                rejects: str | None = None) -> StreamingQuery:
    """Parse messages (any stream with a binary ``value``) and append them by day and type. ``every=None`` drains and stops.

    Messages that cannot be used go to ``rejects`` (default: in the checkpoint folder) with the reason, whole.
    """
    aside = rejects or f"{checkpoint}/rejects"

    def land(batch: DataFrame, number: int) -> None:
        name = batch_name(batch.sparkSession, checkpoint, number)
        parsed = read_messages(batch)
        # read for the events and for the rejects; the text of a message is only wanted for those
        parsed = parsed.withColumn(MESSAGE, F.when(F.col(REASON).isNotNull(), F.col(MESSAGE))).persist()
        try:
            events = parsed.filter(F.col(REASON).isNull()).drop(MESSAGE, REASON)
            write_batch(with_event_day(events), path, ["event_date", "event_type"], name)
            _set_aside(parsed.filter(F.col(REASON).isNotNull()).select(MESSAGE, REASON), aside, name)
        finally:
            parsed.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def high_water(spark: SparkSession, checkpoint: str, number: int) -> int | None:
    """The time of the newest event of all batches before ``number``, in microseconds."""
    path = f"{checkpoint}/high_water/{number}"
    return spark.read.parquet(path).first().micros if files.exists(spark, f"{path}/_SUCCESS") else None


def raise_high_water(events: DataFrame, checkpoint: str, number: int) -> None:
    """Store the newest time up to and with batch ``number`` as that of the next one; the mark before last is not needed any more."""
    spark = events.sparkSession
    known = F.lit(high_water(spark, checkpoint, number)).cast("bigint")
    newest = events.agg(F.unix_micros(F.max("event_timestamp")).alias("own")).select(F.greatest("own", known).alias("micros"))
    newest.write.mode("overwrite").parquet(f"{checkpoint}/high_water/{number + 1}")
    files.delete(spark, f"{checkpoint}/high_water/{number - 1}")


def refine_clicks(spark: SparkSession, landed: str, silver: str, checkpoint: str, unique: bool = False,
                  rejects: str | None = None, reason: Column | None = None, delay: str = WATERMARK_DELAY,
                  files_per_batch: int = 100) -> bool:
    """Append all landed events not seen yet to the silver events, by day, then stop. False if nothing has landed.

    Rows for which ``reason`` (default: no user, a negative amount) is not NULL go to ``rejects`` (default: in the
    checkpoint folder). Late rows are kept, marked by ``is_late``.
    """
    events = missing_ok(lambda: landed_click_stream(spark, landed, files_per_batch))
    if events is None:
        return False
    aside = rejects or f"{checkpoint}/rejects"
    why = reject_reason(price="purchase_amount") if reason is None else reason

    def refine(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        name = batch_name(own, checkpoint, number)
        batch = batch.persist()
        try:
            rows = marked_late(narrowed(amounts_on_checkout_only(batch)), high_water(own, checkpoint, number), delay)
            good, bad = quarantine(rows, why)
            write_batch(good, silver, ["event_date"], name)
            _set_aside(bad, aside, name)
            raise_high_water(batch, checkpoint, number)
        finally:
            batch.unpersist()

    query = (late_tolerant(events, delay, unique).drop(BATCH).writeStream.foreachBatch(refine)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return True


def session_stream(events: DataFrame, delay: str = WATERMARK_DELAY, gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """Sessions per user over a stream.

    The built-in session window still merges events exactly one gap apart; one microsecond less
    makes such an event begin a new session, as in the batch operator.
    """
    gap = f"{gap_seconds - 1} seconds 999999 microseconds"
    return (
        events.withWatermark("event_timestamp", delay)
        .groupBy("user_id", F.session_window("event_timestamp", gap).alias("w"))
        .agg(F.count("*").alias("events"), F.max("event_timestamp").alias("session_end"))
        .select("user_id", F.col("w.start").alias("session_start"), "session_end", "events")
    )
