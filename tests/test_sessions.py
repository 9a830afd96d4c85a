import random
from datetime import datetime, timedelta, timezone

from conftest import SMALL, plan_of
from pyspark.sql import functions as F

from cartwheel.operators.sessions import session_totals, sessionize
from cartwheel.sources import domain
from cartwheel.streaming.clicks import session_stream

START = datetime(2024, 3, 1, tzinfo=timezone.utc)


def brute_force(events):
    """(user, session start) per event, one event after the other."""
    out, last, begin = [], {}, {}
    for user, at in sorted(events, key=lambda e: (str(e[0]), e[1])):
        if user not in last or at - last[user] >= timedelta(seconds=1800):
            begin[user] = at
        last[user] = at
        out.append((user, at, begin[user]))
    return out


def make(n=4000):
    """A third of all events belong to one user; gaps of exactly half an hour, just less, and ties occur."""
    rng = random.Random(3)
    events, clock = [], {}
    for _ in range(n):
        user = 1 if rng.random() < 0.34 else rng.choice([None, 2, 3, 4, 5])
        gap = rng.choice([0, 1, 600, 1799.999999, 1800, 1800.000001, 5400, rng.random() * 4000])
        clock[user] = clock.get(user, START) + timedelta(seconds=gap)
        events.append((user, clock[user]))
    return events


def test_same_sessions_as_one_by_one(spark):
    events = make()
    df = spark.createDataFrame(events, "user_id INT, event_timestamp TIMESTAMP")
    got = sessionize(df).select("user_id", F.unix_micros("event_timestamp").alias("us"),
                                F.substring_index("session_id", "-", -1).cast("bigint").alias("begin")).collect()
    us = lambda t: round(t.timestamp() * 1e6)
    want = [(u, us(a), us(b)) for u, a, b in brute_force(events)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    totals = {(r.user_id, r.session_start_us): r.events for r in session_totals(df).collect()}
    assert sum(totals.values()) == len(events)
    assert len(totals) == len({(u, b) for u, _, b in want})


def test_raw_events_are_never_sorted_by_user(spark):
    """Only the per-slice summary goes through a window: below it the events are already combined."""
    plan = plan_of(session_totals(domain.raw_clicks(spark, SMALL)))
    assert "partial_min" in plan[plan.rindex("Window"):]


def test_stream_gives_the_closed_sessions(spark, tmp_path):
    df = domain.raw_clicks(spark, SMALL).select("user_id", "event_timestamp")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (session_stream(stream).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "offsets")).trigger(availableNow=True).start(str(tmp_path / "out")))
    query.awaitTermination()
    got = {(r.user_id, r.session_start, r.events) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    newest = df.agg(F.max("event_timestamp")).first()[0]
    every = session_totals(df).select("user_id", F.timestamp_micros("session_start_us").alias("b"),
                                      F.timestamp_micros("session_end_us").alias("e"), "events").collect()
    closed = {(r.user_id, r.b, r.events) for r in every if r.e + timedelta(minutes=30) < newest - timedelta(minutes=10)}
    assert closed and closed == got
