"""Click-event operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import iso_timestamp
from cartwheel.schemas import click_schema, landed_click_schema

WATERMARK_DELAY = "10 minutes"
# column of a message that could not be read, and of the reason why a row is set aside
MESSAGE, REASON = "message", "reject_reason"


def parse_messages(messages: DataFrame) -> DataFrame:
    """Binary JSON messages → event columns; a broken message becomes a row of NULLs."""
    text = F.col("value").cast("string")
    return messages.select(F.from_json(text, click_schema()).alias("event")).select("event.*")


def read_messages(messages: DataFrame) -> DataFrame:
    """Binary JSON messages → event columns, the message itself and why it is set aside (NULL: it is not).

    A message is set aside whole when it is empty, is not JSON of the event schema, or has no time that can be read.
    """
    text = F.col("value").cast("string")
    schema = click_schema().add("_broken", "string")
    event = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    reason = (F.when(F.coalesce(F.trim(MESSAGE), F.lit("")) == "", "empty message")
              .when(F.col("event._broken").isNotNull(), "malformed")
              .when(iso_timestamp(F.col("event.event_timestamp")).isNull(), "no event time"))
    return (messages.select(event.alias("event"), text.alias(MESSAGE)).withColumn(REASON, reason)
            .select("event.*", MESSAGE, REASON).drop("_broken"))


def with_event_day(events: DataFrame) -> DataFrame:
    """Typed timestamp and its day as text (the partition column of the landed files)."""
    return events.withColumn("event_timestamp", iso_timestamp(F.col("event_timestamp"))).withColumn(
        "event_date", F.date_format("event_timestamp", "yyyy-MM-dd"))


def amounts_on_checkout_only(events: DataFrame) -> DataFrame:
    return events.withColumn("purchase_amount", F.when(F.col("event_type") == "checkout", F.col("purchase_amount")))


def narrowed(events: DataFrame) -> DataFrame:
    """Silver columns of the landed events."""
    return events.select(*[F.col(f.name).cast(f.dataType) for f in landed_click_schema()])


def marked_late(events: DataFrame, high_water: int | None, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Add ``is_late``: whether an event lies more than ``delay`` before ``high_water``, the newest event of all earlier batches
    in microseconds.

    That is when an event-time operator of the stream would drop it. Those operators drop it before any code of ours sees
    it, so lateness is decided here, against the high-water mark that the job keeps.
    """
    if high_water is None:
        return events.withColumn("is_late", F.lit(False))
    limit = F.timestamp_micros(F.lit(high_water)) - F.expr(f"interval {delay}")
    return events.withColumn("is_late", F.coalesce(F.col("event_timestamp") < limit, F.lit(False)))


def late_days(events: DataFrame) -> DataFrame:
    """event_date, late and on-time events of the days that late ones fell on: the days whose marts are out of date."""
    late = F.count_if("is_late")
    return (events.groupBy("event_date").agg(late.alias("late_events"), (F.count("*") - late).alias("timely_events"))
            .filter("late_events > 0"))


def late_tolerant(events: DataFrame, delay: str = WATERMARK_DELAY, unique: bool = False) -> DataFrame:
    """Watermark on the event time. Late rows still pass unless ``unique`` asks for deduplication by event id."""
    marked = events.withWatermark("event_timestamp", delay)
    return marked.dropDuplicatesWithinWatermark(["event_id"]) if unique else marked
