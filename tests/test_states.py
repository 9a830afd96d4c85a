"""States kept between runs: customers as intervals, users as bitmaps, closings of the rates."""

import random
from datetime import date, timedelta

import pytest
from conftest import rows, scanned_rows
from pyspark.sql import functions as F

from cartwheel.operators.distinct import daily_bitmaps, distinct_of, rolling_distinct
from cartwheel.operators.rates import monthly_closings
from cartwheel.plans.staging import PAIR, stage_rates, stage_rates_since
from cartwheel.sinks import intervals
from cartwheel.sinks.tables import overwrite_partitions
from cartwheel.sinks.upkeep import list_files

KNOWN = "k BIGINT, a STRING, n INT"


def days_of(seed, n=14, keys=30):
    """{day: {key: (a, n)}}: keys come, change, go and come back; across the end of a month."""
    rng = random.Random(seed)
    state, out = {}, {}
    for i in range(n):
        day = date(2024, 1, 25) + timedelta(days=i)
        for k in range(keys):
            if rng.random() < 0.15:
                state[k] = (rng.choice(["x", "y", None]), rng.randrange(3))
            elif rng.random() < 0.05:
                state.pop(k, None)
        out[day] = dict(state)
    return out


def frame(spark, state):
    return spark.createDataFrame([(k, *v) for k, v in state.items()], KNOWN)


def test_any_day_is_rebuilt(spark, tmp_path):
    path, history = str(tmp_path / "t"), days_of(1)
    for day, state in history.items():
        if day.day != 28:  # no run on that day: what was known stays
            for _ in range(2):  # the second time changes nothing
                assert intervals.append_state(frame(spark, state), path, "k", day)
    history[date(2024, 1, 28)] = history[date(2024, 1, 27)]
    want = sorted([(k, *v, day) for day, state in history.items() for k, v in state.items()], key=repr)
    got = intervals.on_days(spark, path, "k", min(history), max(history))
    assert rows(got.select("k", "a", "n", "day")) == want
    for day in (date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 5)):
        assert rows(intervals.state_on(spark, path, "k", day)) == sorted([(k, *v) for k, v in history[day].items()], key=repr)
    some = intervals.on_days(spark, path, "k", date(2024, 1, 30), date(2024, 2, 2))
    assert rows(some.groupBy("day").count()) == sorted((d, len(history[d])) for d in history if date(2024, 1, 30) <= d <= date(2024, 2, 2) and history[d])
    assert not intervals.append_state(frame(spark, {}), path, "k", date(2024, 1, 30))      # later days are there
    assert rows(intervals.on_days(spark, path, "k", min(history), max(history)).select("k", "a", "n", "day")) == want


def test_bytes_follow_the_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(50_000).selectExpr("id as k", "sha2(cast(id as string), 256) as a", "0 as n")
    def size():
        return sum(r.length for r in list_files(spark, path).collect())
    intervals.append_state(base, path, "k", date(2024, 1, 3))
    first = size()
    intervals.append_state(base.withColumn("n", F.when(F.col("k") < 50, 1).otherwise(0)), path, "k", date(2024, 1, 4))
    assert size() - first < first / 100
    intervals.append_state(base, path, "k", date(2024, 1, 5))
    assert size() - first < first / 50
    assert intervals.on_days(spark, path, "k", date(2024, 1, 4), date(2024, 1, 4)).filter("n = 1").count() == 50


def test_no_states(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        intervals.on_days(spark, str(tmp_path / "none"), "k", date(2024, 1, 1), date(2024, 1, 1))
    assert intervals.state_on(spark, str(tmp_path / "none"), "k", date(2024, 1, 1)) is None


def test_bitmaps_of_any_days_merge(spark):
    rng = random.Random(3)
    data = [(date(2024, 1, 1 + rng.randrange(20)), rng.choice("ab"), rng.choice([None, rng.randrange(80), rng.randrange(10**12), -rng.randrange(100_000)])) for _ in range(800)]
    data += [(date(2024, 1, 3), "a", 7)] * 500
    state = daily_bitmaps(spark.createDataFrame(data, "day DATE, k STRING, u BIGINT"), "day", ["k"], "u")
    seen = {(d, k, u) for d, k, u in data if u is not None}
    assert rows(distinct_of(state, ["k"], "n")) == sorted((k, len({u for _, j, u in seen if j == k})) for k in "ab")
    want = {(day, k): len({u for d, j, u in seen if j == k and day - timedelta(days=6) <= d <= day}) for day in {d for d, *_ in seen} for k in "ab"}
    assert {(r.day, r.k): r.n for r in rolling_distinct(state, "day", ["k"], 7, "n").collect()} == {k: n for k, n in want.items() if n}


RATE = "exchange_date DATE, base_currency STRING, target_currency STRING, exchange_rate DOUBLE"


def test_carried_rates_read_one_month_and_one_closing(spark, tmp_path):
    rng = random.Random(4)
    data = []
    for cur in ("EUR", "VND", "JPY", "XXX"):
        day = date(2023, 1, 5)
        while day < date(2024, 6, 20):
            if not (cur == "JPY" and day.month in (3, 4, 5)):  # months without a row
                data.append((day, "USD", cur, None if cur == "XXX" or rng.random() < 0.8 else rng.random()))
            day += timedelta(days=rng.choice([1, 1, 3]))
    rates = spark.createDataFrame(data, RATE)
    rates.withColumn("m", F.date_format("exchange_date", "yyyyMM")).repartition("m").sortWithinPartitions("exchange_date").write.partitionBy("m").parquet(str(tmp_path / "r"))
    stored, path = spark.read.parquet(str(tmp_path / "r")).drop("m"), str(tmp_path / "closings")
    for month in [date(2023 + m // 12, m % 12 + 1, 1) for m in range(18)]:  # a run a month, each knowing that month only
        end = (month + timedelta(days=32)).replace(day=1) - timedelta(days=1)
        now = stored.filter(F.col("exchange_date").between(month, end))
        before = spark.read.parquet(path).filter(F.col("month") == F.add_months(F.lit(month), -1)) if month > date(2023, 1, 1) else None
        closings = monthly_closings(now, PAIR, "exchange_date", "exchange_rate", before, end)
        rows_now = [tuple(r) for r in closings.collect()]
        overwrite_partitions(spark.createDataFrame(rows_now, closings.schema), path, ["month"])
    whole = stage_rates(stored)
    for since in (date(2024, 6, 18), date(2024, 5, 31), date(2023, 2, 1)):
        got = stage_rates_since(stored, spark.read.parquet(path), since)
        columns = ["exchange_date", *PAIR, "raw_exchange_rate", "exchange_rate"]
        assert rows(got.select(columns)) == rows(whole.filter(F.col("exchange_date") >= F.lit(since)).select(columns))
    last = stage_rates_since(stored, spark.read.parquet(path), date(2024, 6, 18))
    assert scanned_rows(spark, last, "exchange_date") < 2 * len([d for d in data if d[0] >= date(2024, 6, 1)]) + 8
