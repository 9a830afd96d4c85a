"""How much is read: clustered layouts, and orders pruned by the ids that a window confirms."""

from datetime import date

from conftest import plan_of, rows, scanned_rows
from pyspark.sql import functions as F

from cartwheel.operators.joins import value_ranges, within
from cartwheel.plans.funnel import completed_buyers, daily_funnel
from cartwheel.sinks import layout, runs

N = 60_000


def orders(spark):
    """Ids ascend with the time, a day has 600 of them; half are completed."""
    return spark.range(N).select(
        F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("ts_ms"), "id", F.timestamp_seconds(1_704_067_200 + F.col("id") * 144).alias("created_at"),
        F.when(F.col("id") % 2 == 0, "COMPLETED").otherwise("PENDING").alias("status"), (F.xxhash64("id") % 1000).alias("price"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"), F.lit(False).alias("is_deleted"), F.col("id").alias("lsn"))


def small_groups(spark, df, path):
    df.write.option("parquet.block.size", 64 * 1024).option("parquet.page.size", 8 * 1024).parquet(path)
    return spark.read.parquet(path)


def test_a_curve_through_two_columns_skips_on_both(spark, tmp_path):
    df = orders(spark)
    mixed = df.repartition(4, "filler")
    plain = small_groups(spark, mixed.sortWithinPartitions("filler"), str(tmp_path / "plain"))
    by_price = small_groups(spark, mixed.sortWithinPartitions("price", "filler"), str(tmp_path / "price"))
    curved = small_groups(spark, layout.clustered(df, [F.unix_micros("created_at"), F.col("price")], 4), str(tmp_path / "curve"))
    assert rows(curved.groupBy("status").agg(F.sum("id"), F.count("*"))) == rows(df.groupBy("status").agg(F.sum("id"), F.count("*")))
    window = "created_at >= '2024-02-10' and created_at < '2024-02-13'"  # three of a hundred days
    cheap = "price between 100 and 130"
    share = {name: [scanned_rows(spark, t.filter(q).select("filler", "created_at", "price"), "price") / N for q in (window, cheap)]
             for name, t in (("plain", plain), ("price", by_price), ("curve", curved))}
    assert min(share["plain"]) == 1.0 and share["price"][0] == 1.0
    assert max(share["curve"]) < 0.4, share
    for t in (plain, curved):
        assert t.filter(window).count() == 1800


def test_buckets_of_a_keyed_table_are_clustered(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("parquet.block.size", 32 * 1024)
    try:
        runs.write_run(orders(spark), path, "id", 2, "b0")
        runs.write_run(orders(spark).limit(1), path, "id", 2, "b1")
        assert runs.fold_runs(spark, path, "id", [F.unix_micros("created_at"), F.col("id")]) == {"base": 2, "tier": 0}
    finally:
        spark.conf.unset("parquet.block.size")
    recent = runs.read_runs(spark, path, "id").filter("created_at >= '2024-04-07'")  # the last three days
    assert recent.count() == N - 600 * 97
    assert scanned_rows(spark, recent.select("id", "created_at", "filler"), "filler") < 0.2 * N + 2


def test_parts_and_nulls(spark):
    df = spark.createDataFrame([(None,), (1,), (5,), (5,), (9,)], "v INT")
    got = df.select("v", layout.part_of(F.col("v"), [1, 5, 8]).alias("p")).collect()
    assert [(r.v, r.p) for r in got] == [(None, 0), (1, 0), (5, 1), (5, 1), (9, 3)]
    assert layout.quantile_edges(df.limit(0), [F.col("v")]) == [[]]
    assert layout.clustered(df.limit(0), [F.col("v")], 2).count() == 0


def confirmations(spark, *ids):
    return spark.createDataFrame(
        [(f"e{n}", 1 + n, f"s{n}", "checkout", "mobile", "confirmation", i, date(2024, 4, 9), "direct", None, None) for n, i in enumerate(ids)],
        "event_id STRING, user_id BIGINT, session_id STRING, event_type STRING, device STRING, step STRING, real_order_id BIGINT, event_date DATE, "
        "referrer_category STRING, duration_ms INT, scroll_depth_pct INT")


def test_orders_are_read_only_where_confirmed_ids_lie(spark, tmp_path):
    stored = small_groups(spark, orders(spark).coalesce(2), str(tmp_path / "orders"))
    staged = stored.withColumnRenamed("id", "order_id")
    ids = [3, 4, *range(59_000, 59_400, 7), None]  # a window's orders, and two that are confirmed very late
    events = confirmations(spark, *ids)
    want = sorted((date(2024, 4, 9), 1 + n) for n, i in enumerate(ids) if i is not None and i % 2 == 0)
    for prune in (False, True):
        assert sorted(map(tuple, completed_buyers(events, staged, prune).collect())) == want
    assert scanned_rows(spark, completed_buyers(events, staged), "status") == N
    assert scanned_rows(spark, completed_buyers(events, staged, True), "status") < 0.1 * N
    whole, window = daily_funnel(events, staged), daily_funnel(events, staged, date(2024, 4, 9))
    assert rows(whole) == rows(window) and whole.first().users_truly_completed == len(want)


def test_runtime_filter_drops_other_ids_before_the_shuffle(spark, tmp_path):
    """The filter that large tables get by default, provoked on small ones."""
    settings = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    path = str(tmp_path / "clicks")
    confirmations(spark, *range(59_000, 59_400, 7)).write.parquet(path)
    stored = small_groups(spark, orders(spark).coalesce(2), str(tmp_path / "orders")).withColumnRenamed("id", "order_id")
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = completed_buyers(spark.read.parquet(path), stored, True)
        assert df.count() == len([i for i in range(59_000, 59_400, 7) if i % 2 == 0])
        assert "might_contain" in plan_of(df)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_ranges(spark):
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3, 1000, 1001, None)], "i BIGINT")
    assert value_ranges(ids, "i", 4) == [(1, 3), (1000, 1001)]
    assert value_ranges(ids.filter("i is null"), "i") == []
    assert rows(ids.filter(within("i", [(2, 3), (1001, 5000)]))) == [(1001,), (2,), (3,)]
    assert ids.filter(within("i", [])).count() == 0
