"""Sessions by inactivity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

SESSION_GAP_SECONDS = 1800


def session_slices(events: DataFrame, user: str, ts: str, gap_seconds: int) -> DataFrame:
    """(user, time slice) → session start in microseconds, and the events counted.

    A slice is as long as the gap, so two events of one slice are always closer than the gap and
    belong together: a session can only begin at the first event of a slice. The raw events are
    therefore only grouped (with map-side combine), never sorted; the window below runs over at
    most one row per user and slice, which the calendar bounds even for a user with a third of
    all events.
    """
    gap = gap_seconds * 1_000_000
    us = F.unix_micros(ts)
    slices = events.groupBy(F.col(user), F.floor(us / gap).alias("_slice")).agg(
        F.min(us).alias("_first"), F.max(us).alias("_last"), F.count("*").alias("_events"))
    by_time = Window.partitionBy(user).orderBy("_slice")
    previous = F.lag("_last").over(by_time)
    begins = previous.isNull() | (F.col("_first") - previous >= gap)
    slices = slices.withColumn("_begin", F.when(begins, F.col("_first")))
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return slices.withColumn("_start", F.last("_begin", ignorenulls=True).over(so_far))


def sessionize(events: DataFrame, user: str = "user_id", ts: str = "event_timestamp",
               gap_seconds: int = SESSION_GAP_SECONDS, out: str = "session_id") -> DataFrame:
    """Add a session id: same session while consecutive events of a user are less than the gap apart."""
    starts = session_slices(events, user, ts, gap_seconds).select(
        F.col(user).alias("_user"), F.col("_slice").alias("_of"), "_start")
    own_slice = F.floor(F.unix_micros(F.col(ts)) / (gap_seconds * 1_000_000))
    # null-safe: events without a user form sessions of their own
    on = F.col(user).eqNullSafe(F.col("_user")) & own_slice.eqNullSafe(F.col("_of"))
    session_id = F.concat_ws("-", F.coalesce(F.col(user).cast("string"), F.lit("anonymous")), "_start")
    return events.join(starts, on, "inner").withColumn(out, session_id).drop("_user", "_of", "_start")


def session_totals(events: DataFrame, user: str = "user_id", ts: str = "event_timestamp",
                   gap_seconds: int = SESSION_GAP_SECONDS) -> DataFrame:
    """One row per session (start, end, events) straight from the slices: the events are not joined back."""
    return (
        session_slices(events, user, ts, gap_seconds)
        .groupBy(F.col(user), F.col("_start").alias("session_start_us"))
        .agg(F.max("_last").alias("session_end_us"), F.sum("_events").alias("events"))
    )
