import json
import random
from datetime import date, timedelta

from conftest import rows
from pyspark.sql import functions as F

from cartwheel.operators import rates as ops
from cartwheel.plans.staging import stage_rates
from cartwheel.sinks.tables import overwrite_partitions
from cartwheel.sources import files

RATE = "exchange_date DATE, base_currency STRING, target_currency STRING, exchange_rate DOUBLE"


def test_forward_fill_equals_one_by_one(spark):
    rng = random.Random(2)
    data = []
    for cur in ("EUR", "VND"):
        day = date(2020, 1, 1)
        for _ in range(900):                    # long NULL stretches across several months, missing days
            day += timedelta(days=rng.choice([1, 1, 1, 40]))
            data.append((day, "USD", cur, rng.random() if rng.random() < 0.05 else None))
    last, want = {}, []
    for d, b, c, r in sorted(data, key=lambda x: x[0]):
        last[c] = r if r is not None else last.get(c)
        want.append((d, c, last[c], r))
    got = stage_rates(spark.createDataFrame(data, RATE)).select("exchange_date", "target_currency", "exchange_rate", "raw_exchange_rate")
    assert rows(got) == sorted(want, key=repr)
    assert want[0][2] is None or want[0][3] is not None


def land(root, name, at, rates):
    folder = root / "year=2024" / "month=01" / "day=03"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps({"base_code": "USD", "rates": rates, "_ingested_at": at}, indent=2))


def test_documents_to_silver(spark, tmp_path):
    """Pretty-printed documents, a new currency, a NULL, a currency not kept, two documents on a day."""
    land(tmp_path, "a.json", "2024-01-03T08:00:00.000001+00:00", {"EUR": 0.9, "VND": 25000, "AUD": 1.5})
    land(tmp_path, "b.json", "2024-01-03T20:00:00.000001+00:00", {"EUR": 0.95, "VND": None})
    land(tmp_path, "c.json", "2024-01-04T00:30:00+07:00", {"EUR": 0.8, "JPY": 150.5})
    (tmp_path / "year=2024" / "month=01" / "day=03" / "d.json").write_text("{ broken")
    docs = files.fx_documents(spark, str(tmp_path)).filter(F.col("base_code").isNotNull())
    kept = docs.withColumn("rates", ops.rates_as_map(docs)).transform(ops.keep_currencies)
    got = rows(ops.rate_rows(kept).select("exchange_date", "target_currency", "exchange_rate"))
    assert got == [(date(2024, 1, 3), "EUR", 0.95), (date(2024, 1, 3), "JPY", 150.5), (date(2024, 1, 3), "VND", 25000.0)]
    known = rows(ops.rate_rows(docs, keep_nulls=False).select("target_currency", "exchange_rate"))
    assert known == [("AUD", 1.5), ("EUR", 0.95), ("JPY", 150.5), ("VND", 25000.0)]


def test_rates_by_day_are_replaced_by_day(spark, tmp_path):
    path = str(tmp_path / "rates")
    first = spark.createDataFrame([(date(2024, 1, d), "USD", "EUR", 1.0) for d in (1, 2)], RATE)
    overwrite_partitions(first, path, ["exchange_date"])
    overwrite_partitions(first.filter("exchange_date = '2024-01-02'").withColumn("exchange_rate", F.lit(2.0)), path, ["exchange_date"])
    assert rows(spark.read.parquet(path).select("exchange_date", "exchange_rate")) == [(date(2024, 1, 1), 1.0), (date(2024, 1, 2), 2.0)]


def test_a_second_document_does_not_double_the_orders(spark):
    docs = spark.createDataFrame([("USD", {"EUR": 0.5}, "2024-01-03T08:00:00Z"), ("USD", {"EUR": 0.25}, "2024-01-03T09:00:00Z")],
                                 "base_code STRING, rates MAP<STRING, DOUBLE>, _ingested_at STRING")
    orders = spark.createDataFrame([(date(2024, 1, 3), "EUR", 10.0), (date(2024, 1, 3), "VND", 7.0)], "order_date DATE, currency STRING, amount DOUBLE")
    staged = stage_rates(ops.rate_rows(docs))
    assert rows(ops.with_usd(orders, staged, "amount", "usd").select("currency", "usd")) == [("EUR", 40.0), ("VND", 7.0)]
    assert rows(ops.missing_rates(orders, staged)) == [("VND", 1)]
