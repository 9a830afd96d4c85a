"""Marts on small hand-made tables, where every number can be checked by eye."""

from datetime import date, datetime, timezone

from conftest import plan_of, rows
from pyspark.sql import functions as F

from cartwheel.plans import customers, funnel, reports, sales, staging
from cartwheel.plans.windows import recompute_since

DAY = date(2024, 1, 3)


def clicks(spark, *events):
    """(user, session, type, device, day offset, step, order)"""
    data = [(f"e{i}", u, s, t, d, datetime(2024, 1, 3 + off, 12, i % 60, tzinfo=timezone.utc), step, order, 1000 * i, 10 * i, "7")
            for i, (u, s, t, d, off, step, order) in enumerate(events)]
    df = spark.createDataFrame(data, "event_id STRING, user_id INT, session_id STRING, event_type STRING, device STRING, "
                               "event_timestamp TIMESTAMP, step STRING, real_order_id INT, duration_ms INT, "
                               "scroll_depth_pct INT, item_id STRING")
    for c, t in (("search_query", "string"), ("result_count", "int"), ("click_target", "string"), ("quantity", "int"),
                 ("cart_total", "float"), ("purchase_amount", "float"), ("referrer", "string")):
        df = df.withColumn(c, F.lit(None).cast(t))
    return staging.stage_clicks(df)


def orders(spark, *data):
    """(id, user, product, quantity, total, currency, status, created)"""
    raw = [(i, u, p, q, None, float(total), cur, "momo" if i % 2 else "vnpay", st, at, at, False)
           for i, u, p, q, total, cur, st, at in data]
    df = spark.createDataFrame(raw, "id INT, user_id INT, product_id STRING, quantity INT, unit_price DOUBLE, "
                               "total_amount DOUBLE, currency STRING, payment_method STRING, status STRING, "
                               "created_at STRING, updated_at STRING, is_deleted BOOLEAN")
    return staging.stage_orders(df.withColumn("total_amount", F.col("total_amount").cast("decimal(18,2)")))


def products(spark, *data):
    df = spark.createDataFrame([(*d, 1.0, "2024-01-01T00:00:00Z", False) for d in data],
                               "product_id STRING, category_code STRING, brand STRING, avg_price DOUBLE, created_at STRING, "
                               "is_deleted BOOLEAN")
    return staging.stage_products(df)


def rates(spark, *data):
    return staging.stage_rates(spark.createDataFrame(
        data, "exchange_date DATE, base_currency STRING, target_currency STRING, exchange_rate DOUBLE"))


NO_ORDERS = (1, 1, "7", 1, 1, "USD", "COMPLETED", "2024-01-03T00:00:00Z")


def test_buyer_with_three_sessions_counts_once(spark):
    """One purchase by a user with three sessions on the day: one completed user per device, three sessions."""
    events = clicks(spark, (1, "a", "view_item", "mobile", 0, None, None), (1, "b", "add_to_cart", "mobile", 0, None, None),
                    (1, "c", "checkout", "mobile", 0, "confirmation", 1), (2, "d", "view_item", "mobile", 0, None, None),
                    (3, "e", "checkout", "mobile", 0, "confirmation", 99))
    got = funnel.daily_funnel(events, orders(spark, NO_ORDERS)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.total_sessions, r.users_viewed_product, r.users_added_to_cart, r.users_initiated_checkout,
            r.users_confirmed_checkout, r.users_truly_completed) == (5, 2, 1, 2, 2, 1)
    assert (r.view_to_cart_rate, r.cart_to_checkout_rate, r.true_purchase_rate) == (50.0, 200.0, 50.0)
    assert r.bounce_rate_pct == 100.0 and r.avg_session_duration_sec == 2.0 and r.avg_scroll_depth_pct == 20.0


def test_null_device_user_and_session_keep_their_rows(spark):
    events = clicks(spark, (None, "a", "view_item", None, 0, None, None), (4, None, "view_item", None, 0, None, None),
                    (4, None, "scroll", None, 0, None, None))
    r, = funnel.daily_funnel(events, orders(spark, NO_ORDERS)).collect()
    assert (r.device, r.total_sessions, r.users_viewed_product, r.bounce_rate_pct) == (None, 1, 1, 100.0)
    assert r.avg_session_duration_sec == 1.0  # all three events


def test_session_over_midnight_is_no_bounce_in_an_incremental_run(spark):
    events = clicks(spark, (1, "a", "view_item", "mobile", 0, None, None), (1, "a", "view_item", "mobile", 1, None, None))
    full = funnel.daily_funnel(events, orders(spark, NO_ORDERS))
    late = funnel.daily_funnel(events, orders(spark, NO_ORDERS), since=date(2024, 1, 4))
    assert rows(late) == rows(full.filter(F.col("event_date") >= F.lit(date(2024, 1, 4))))
    assert late.first().bounce_rate_pct == 0.0


def test_engagement(spark):
    events = clicks(spark, (1, "a", "view_item", "mobile", 0, None, None), (1, "b", "view_item", "mobile", 0, None, None),
                    (2, "c", "add_to_cart", "mobile", 0, None, None))
    r, = funnel.product_engagement(events, products(spark, ("7", "toys", "acme"))).collect()
    assert (r.product_id, r.product_name, r.category, r.view_sessions, r.unique_viewers, r.users_added_to_cart,
            r.view_to_cart_rate, r.avg_view_duration_sec, r.search_impressions) == ("7", "acme", "toys", 2, 1, 1, 100.0, 0.5, 0)
    unknown, = funnel.product_engagement(events, products(spark, ("8", "toys", "acme"))).collect()
    assert unknown.category is None


RATES = ((date(2024, 1, 3), "USD", "EUR", 0.5), (date(2024, 1, 4), "USD", "EUR", None), (date(2024, 1, 5), "EUR", "USD", 9.0))


def test_daily_sales(spark):
    o = orders(spark, (1, 1, "7", 2, 100, "EUR", "COMPLETED", "2024-01-03T10:00:00Z"),
               (3, 1, "7", 1, 50, "EUR", "COMPLETED", "2024-01-03T23:59:59Z"),
               (5, 2, "7", 1, 10, "EUR", "CANCELLED", "2024-01-03T10:00:00Z"),
               (7, 2, "7", 1, 20, "EUR", "PENDING", "2024-01-04T01:00:00+07:00"),
               (9, 2, "404", 1, 20, "EUR", "PENDING", "2024-01-03T10:00:00Z"),
               (11, 2, "8", 1, 7, "EUR", "COMPLETED", "2024-01-04T10:00:00Z"),
               (13, 2, "8", 1, 7, "VND", "PENDING", "2024-01-04T10:00:00Z"))
    p = products(spark, ("7", None, None), ("8", "toys", "acme"))
    got = {(r.order_date, r.category, r.currency_group): r for r in sales.daily_sales(o, p, rates(spark, *RATES)).collect()}
    assert len(got) == 3                                   # the unknown product is left out
    r = got[(DAY, "Unknown", "EUR")]
    assert (r.order_count, r.total_revenue_usd, r.avg_order_value_usd, r.total_quantity_sold) == (2, 300.0, 150.0, 3)
    assert (r.cancelled_count, r.cancellation_rate_pct, r.pending_count, r.pending_revenue_usd) == (1, 33.33, 1, 40.0)
    assert got[(date(2024, 1, 4), "toys", "EUR")].total_revenue_usd == 14.0   # rate filled forward
    r = got[(date(2024, 1, 4), "toys", "VND")]                                # no rate at all: taken as USD
    assert (r.total_revenue_usd, r.avg_order_value_usd, r.cancellation_rate_pct, r.pending_revenue_usd) == (0.0, None, None, 7.0)


def test_product_performance_ranks(spark):
    o = orders(spark, *[(i, 1, str(i), 1 + i % 2, amount, "USD", "COMPLETED", "2024-01-03T10:00:00Z")
                        for i, amount in enumerate([50, 70, 70, 10] + [1] * 16)])
    p = products(spark, *[(str(i), "toys", "acme") for i in range(20)])
    got = {r.product_id: r for r in sales.product_performance(o, p, rates(spark, *RATES)).collect()}
    assert [got[i].revenue_rank_in_week for i in "12034"] == [1, 1, 3, 4, 5]
    assert {r.week_start for r in got.values()} == {date(2024, 1, 1)}
    assert [got[i].is_top_10_pct_revenue for i in "120"] == [True, True, False] and got["0"].is_top_3_revenue
    assert got["1"].units_rank_in_week == 1 and got["0"].units_rank_in_week == 11
    assert got["0"].total_products_in_week == 20


def test_snapshot(spark):
    users = staging.stage_users(spark.createDataFrame(
        [(1, "a", "a@x", None, "VN", "2023-01-01T00:00:00Z", None, False), (2, "b", "b@x", "Hue", None, "2023-02-01T00:00:00Z", None, False),
         (3, "c", "c@x", "Hue", None, "2023-02-01T00:00:00Z", None, True)],
        "id INT, name STRING, email STRING, city STRING, country STRING, created_at STRING, updated_at STRING, is_deleted BOOLEAN"))
    o = orders(spark, (2, 1, "7", 1, 100, "EUR", "COMPLETED", "2024-01-03T10:00:00Z"),
               (3, 1, "7", 1, 400, "USD", "COMPLETED", "2024-01-05T10:00:00Z"),
               (5, 1, "7", 1, 9999, "USD", "PENDING", "2024-01-06T10:00:00Z"))
    got = {r.user_id: r for r in customers.customer_snapshot(users, o, rates(spark, *RATES), date(2024, 1, 15)).collect()}
    assert set(got) == {1, 2}
    r = got[1]
    assert (r.city, r.days_since_last_order, r.total_orders, r.customer_lifespan_days, r.total_revenue_usd) == ("Unknown", 10, 2, 2, 600.0)
    assert (r.preferred_currency, r.preferred_payment, r.customer_segment, r.is_high_value) == ("USD", "momo", "Promising", True)
    r = got[2]
    assert (r.country, r.total_orders, r.total_revenue_usd, r.avg_order_value_usd, r.customer_segment, r.is_high_value,
            r.days_since_last_order) == ("Unknown", 0, 0.0, 0.0, "Never Bought", False, None)


def test_how_far_incremental_runs_reach():
    thursday = date(2024, 1, 18)
    assert recompute_since("daily_sales", thursday) == date(2024, 1, 15)
    assert recompute_since("product_performance", thursday) == date(2024, 1, 1)
    assert recompute_since("daily_funnel", thursday) == recompute_since("product_engagement", thursday) == date(2024, 1, 16)


def test_scan_skips_old_partitions(spark, tmp_path):
    path = str(tmp_path / "clicks")
    spark.range(100).select(F.col("id").cast("string").alias("event_id"), F.lit("2024-01-01").alias("event_date")).write.partitionBy(
        "event_date").parquet(path)
    silver = spark.read.parquet(path)
    plan = plan_of(staging._recent(silver, "event_date", date(2024, 1, 5)))
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-04" in plan


def test_scan_gets_the_text_filter(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.createDataFrame([("2024-01-03T10:00:00Z",)], "created_at STRING").write.parquet(path)
    plan = plan_of(staging._recent(spark.read.parquet(path), "created_at", date(2024, 1, 5)))
    assert "GreaterThanOrEqual(created_at,2024-01-04)" in plan


def test_quadrants_have_all_corners(spark):
    data = [(str(i), "toys", 10, 10, c, float(d), 50.0) for i, (d, c) in enumerate([(1, 1), (1, 9), (9, 1), (9, 9), (5, 5)])]
    e = spark.createDataFrame(data, "product_id STRING, category STRING, view_sessions INT, unique_viewers INT, "
                              "users_added_to_cart INT, avg_view_duration_sec DOUBLE, avg_scroll_depth_pct DOUBLE")
    got = {r.product_id: r.quadrant for r in reports.product_quadrants(e).collect()}
    assert got == {"0": "ignore", "1": "hidden gem", "2": "leaking traffic", "3": "star", "4": "star"}


def test_unknown_revenue_ranks_last(spark):
    from cartwheel.operators.ranking import with_ranks

    df = spark.createDataFrame([("w", 1, 5), ("w", 2, None), ("w", 3, 7), ("w", 4, None)], "week STRING, id INT, v INT")
    ranked = with_ranks(df, ["week"], {"v": "rank"}, total="total").select("id", "rank", "total")
    assert rows(ranked) == [(1, 2, 4), (2, 3, 4), (3, 1, 4), (4, 3, 4)]


def test_orders_are_hashed_before_the_newest_is_picked(spark):
    """No sort over the raw orders: what is sorted is a row per user, currency and payment method."""
    o = spark.range(100).select(
        F.col("id").alias("order_id"), (F.col("id") % 5).alias("user_id"), F.lit("USD").alias("currency"),
        F.when(F.col("id") >= 95, "cash").otherwise("card").alias("payment_method"), F.lit("COMPLETED").alias("status"),
        F.lit(2.0).alias("total_amount"), F.lit("2024-01-05 10:00:00").cast("timestamp").alias("created_at"),
        F.lit("2024-01-05").cast("date").alias("order_date"))
    stats = customers.order_stats(o, rates(spark, *RATES))
    assert {(r.user_id, r.total_orders, r.revenue, r.newest.payment_method) for r in stats.collect()} == {
        (u, 20, 40.0, "cash") for u in range(5)}
    plan = plan_of(stats)
    assert plan.count("HashAggregate(keys=[user_id") >= 2
