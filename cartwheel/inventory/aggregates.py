"""Joins, aggregates and scalar functions the marts are made of, one small query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions import scalars as fn
from cartwheel.inventory import base
from cartwheel.inventory.base import Query, h, pct, with_views
from cartwheel.inventory.marts import BEHAVIOUR_SQL
from cartwheel.operators.catalogue import DEFAULT_PRICE, known_codes, mean_price, seen_attributes
from cartwheel.operators.distinct import daily_bitmaps, distinct_counts, rolling_distinct
from cartwheel.operators.rates import with_rate
from cartwheel.plans import funnel
from cartwheel.session import scratch_dir
from cartwheel.sinks import tables
from cartwheel.sources import domain


def _by_status(column):
    return F.when(F.col("status") == "COMPLETED", F.col(column))


def _left_rate(spark, folder):
    o = with_rate(base.orders(spark, folder), base.rates(spark, folder), domain.rates(spark, folder))
    return o.groupBy("currency").agg(F.count("*").alias("orders"), F.count("rate").alias("with_rate"))


def _users_with_stats(spark, folder):
    stats = base.orders(spark, folder).groupBy("user_id").agg(F.count("*").alias("orders"))
    return base.users(spark, folder).join(stats, "user_id", "left").select("user_id", "city", "orders")


def _event_sizes(spark, folder):
    c = base.clicks(spark, folder)
    return c.join(funnel.session_sizes(c), "session_id", "left").groupBy("device", "event_count").agg(
        F.count("*").alias("events"))


def _event_orders(spark, folder):
    c, o = base.clicks(spark, folder), base.orders(spark, folder)
    return c.join(o.select(F.col("order_id").alias("real_order_id"), "status"), "real_order_id", "inner").filter(
        F.col("status") == "COMPLETED").select("event_id", "real_order_id")


def _cast_key(spark, folder):
    p = domain.table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("item_id"), "p_brand")
    return base.clicks(spark, folder).join(p, "item_id", "left").groupBy("p_brand").agg(F.count("*").alias("events"))


def _completed_membership(spark, folder):
    c = base.clicks(spark, folder)
    buyers = funnel.completed_buyers(c, base.orders(spark, folder)).withColumn("bought", F.lit(True))
    return c.join(buyers, ["event_date", "user_id"], "left").groupBy("event_date").agg(
        F.count("*").alias("events"), F.count("bought").alias("by_buyers"))


def _anti(spark, folder):
    done = base.orders(spark, folder).filter(F.col("status") == "COMPLETED")
    return base.users(spark, folder).join(done, "user_id", "left_anti").select("user_id")


def _conditional(spark, folder):
    return base.orders(spark, folder).groupBy("payment_method").agg(
        F.count_if(F.col("status") == "COMPLETED").alias("completed"),
        F.count_if(F.col("status").isin("COMPLETED", "CANCELLED")).alias("closed"),
        fn.half_up(F.coalesce(F.sum(_by_status("total_amount")), F.lit(0))).alias("amount"),
        fn.half_up(F.avg(_by_status("quantity")), 6).alias("mean_quantity"),
        F.count(F.when(F.col("currency") == "VND", 1)).alias("in_vnd"))


def _distinct_counts(spark, folder):
    view, cart = F.col("event_type") == "view_item", F.col("event_type") == "add_to_cart"
    return distinct_counts(base.clicks(spark, folder), ["device"], {
        "sessions": ("session_id", None), "users": ("user_id", None), "viewers": ("user_id", view),
        "carters": ("user_id", cart), "view_sessions": ("session_id", view)})


def _min_max(spark, folder):
    o = base.orders(spark, folder)
    return o.groupBy("user_id").agg(
        F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("days"))


def _newest_attributes(spark, folder):
    newest = F.max_by(F.struct("currency", "payment_method"), F.struct("created_at", "order_id")).alias("n")
    return base.orders(spark, folder).groupBy("user_id").agg(newest).select("user_id", "n.currency", "n.payment_method")


def _ratios(spark, folder):
    o = base.orders(spark, folder).groupBy("user_id").agg(
        F.count_if(F.col("status") == "CANCELLED").alias("cancelled"),
        F.count_if(F.col("status").isin("COMPLETED", "CANCELLED")).alias("closed"),
        F.sum(_by_status("total_amount")).alias("amount"), F.count(_by_status("total_amount")).alias("paid"))
    return o.select("user_id", fn.pct(F.col("cancelled"), F.col("closed")).alias("cancellation_pct"),
                    fn.half_up(fn.ratio_or_zero(F.col("amount"), F.col("paid")), 6).alias("mean_amount"))


def _first_last(spark, folder):
    return known_codes(seen_attributes(domain.behaviour_rows(spark, folder)))


def _mean_price(spark, folder):
    seen = seen_attributes(domain.behaviour_rows(spark, folder))
    return seen.groupBy("product_id").agg(mean_price(F.sum("paid"), F.sum("paid_rows")).alias("avg_price"))


def _dates(spark, folder):
    o = domain.orders(spark, folder).select("id", "created_at")
    day = fn.iso_date(F.col("created_at"))
    return o.select("id", day.alias("day"), fn.week_start(day).alias("week_start"),
                    F.datediff(F.lit(base.ORDERS_AS_OF), day).alias("age"), F.date_add(day, -3).alias("three_before"),
                    F.date_add(fn.week_start(day), -14).alias("two_weeks_before"))


def _broken_dates(spark, folder):
    """ISO text in several spellings, some of it no date at all."""
    key, at = F.col("id"), F.col("created_at")
    text = (F.when(key % 4 == 0, at).when(key % 4 == 1, F.replace(at, F.lit("Z"), F.lit("+07:00")))
            .when(key % 4 == 2, F.replace(at, F.lit("Z"), F.lit(".250000Z"))).otherwise(F.lit("not a date")))
    return domain.orders(spark, folder).select("id", F.unix_micros(fn.iso_timestamp(text)).alias("us"))


def _texts(spark, folder):
    p = domain.products(spark, folder)
    return p.select("product_id", F.coalesce("category_code", F.lit("Unknown")).alias("category"),
                    F.nullif(F.col("brand"), F.lit("Brand#1")).alias("other_brand"),
                    fn.category_placeholder(F.lpad("product_id", 12, "7")).alias("placeholder"),
                    F.ceil(F.col("avg_price") * F.lit(0.1)).alias("tenth"),
                    F.col("brand").contains("2").alias("has_2"))


def _rounded(spark, folder):
    """Values near a half, negative ones, and ones with more digits than a double holds."""
    key = F.col("id")
    tiny = F.lit("0.0249999995").cast("decimal(28,10)")
    exact = (F.when(key % 5 == 0, key + F.lit("0.005").cast("decimal(28,10)")).when(key % 5 == 1, tiny)
             .when(key % 5 == 2, -key - F.lit("0.125").cast("decimal(28,10)"))
             .when(key % 5 == 3, key + F.lit("93000000000000000.005").cast("decimal(28,10)"))
             .otherwise((key.cast("decimal(28,10)") / 8).cast("decimal(28,10)")))
    o = domain.orders(spark, folder).select("id", exact.alias("v"))
    return o.select("id", fn.half_up(F.col("v")).alias("from_decimal"), fn.half_up(F.col("v").cast("double")).alias("from_double"),
                    fn.half_up(F.col("v"), 0).alias("whole"), fn.half_up(-F.col("v"), 6).alias("six"))


WINDOW_DAYS = 7


def _distinct_over_window(spark, folder):
    """Users of the last seven days from the daily bitmaps, which are written first; the events of some days twice."""
    path = scratch_dir(spark, "bitmaps")
    events = base.clicks(spark, folder).select("event_date", "device", "user_id")
    for part in (events, events.filter(F.col("event_date") >= F.lit("2024-01-20").cast("date"))):
        tables.overwrite_partitions(daily_bitmaps(part, "event_date", ["device"], "user_id"), path, ["event_date"])
    return rolling_distinct(spark.read.parquet(path), "event_date", ["device"], WINDOW_DAYS, "users")


QUERIES = [
    Query("f8_round", _rounded, with_views("d_orders", v="""
        select id, case id % 5 when 0 then cast(id as decimal(28,10)) + 0.005 when 1 then cast(0.0249999995 as decimal(28,10))
          when 2 then -cast(id as decimal(28,10)) - 0.125 when 3 then cast(id as decimal(28,10)) + cast('93000000000000000.005' as decimal(28,10))
          else cast(id // 8 as decimal(28,10)) + cast(id % 8 as decimal(28,10)) * 0.125 end as v from d_orders""", body=f"""
        select id, cast(round(cast(v as decimal(38,10)), 2) as double) as from_decimal, {h("cast(v as double)")} as from_double,
          cast(round(cast(v as decimal(38,10)), 0) as double) as whole, cast(round(cast(-v as decimal(38,10)), 6) as double) as six from v""")),
    Query("a5_distinct_over_window", _distinct_over_window, with_views("s_clicks", body=f"""
        select d.event_date, device, count(distinct user_id) as users
        from (select distinct event_date from s_clicks where user_id is not null) d
        join s_clicks c on c.event_date between d.event_date - {WINDOW_DAYS - 1} and d.event_date
        where user_id is not null group by 1, 2""")),
    Query("j1_inner_join",
          lambda s, f: base.orders(s, f).join(base.products(s, f), "product_id").groupBy("category").agg(
              F.count("*").alias("orders")),
          with_views("s_orders", "s_products", body="""
            select category, count(*) as orders from s_orders join s_products using (product_id) group by 1""")),
    Query("j2_left_join_rates", _left_rate, with_views("o_usd", body="""
        select currency, count(*) as orders, count(rate) as with_rate from o_usd group by 1""")),
    Query("j3_users_with_stats", _users_with_stats, with_views("s_users", "s_orders", body="""
        select u.user_id, u.city, o.orders from s_users u
        left join (select user_id, count(*) as orders from s_orders group by 1) o using (user_id)""")),
    Query("j4_membership_join", _completed_membership, with_views("s_clicks", "s_orders", body="""
        select c.event_date, count(*) as events, count(t.user_id) as by_buyers from s_clicks c
        left join (select distinct c.event_date, c.user_id from s_clicks c join s_orders o on c.real_order_id = o.order_id
                   where c.step = 'confirmation' and o.status = 'COMPLETED') t using (event_date, user_id)
        group by 1""")),
    Query("j5_event_orders", _event_orders, with_views("s_clicks", "s_orders", body="""
        select event_id, real_order_id from s_clicks join s_orders on real_order_id = order_id where status = 'COMPLETED'""")),
    Query("j6_session_sizes", _event_sizes, with_views("s_clicks", body="""
        select device, event_count, count(*) as events from s_clicks
        join (select session_id, count(*) as event_count from s_clicks group by 1) using (session_id) group by 1, 2""")),
    Query("j7_cast_key_join", _cast_key, with_views("s_clicks", body="""
        select p_brand, count(*) as events from s_clicks left join part on item_id = cast(p_partkey as varchar) group by 1""")),
    Query("j8_anti_join", _anti, with_views("s_users", "s_orders", body="""
        select user_id from s_users where user_id not in (select user_id from s_orders where status = 'COMPLETED')""")),
    Query("a1_group_by",
          lambda s, f: base.orders(s, f).groupBy("payment_method", "currency", "status").agg(
              F.count("*").alias("orders"), F.sum("quantity").alias("quantity")),
          with_views("s_orders", body="""
            select payment_method, currency, status, count(*) as orders, cast(sum(quantity) as bigint) as quantity
            from s_orders group by all""")),
    Query("a2_conditional_aggregates", _conditional, with_views("s_orders", body=f"""
        select payment_method, count(*) filter (status = 'COMPLETED') as completed,
          count(*) filter (status in ('COMPLETED', 'CANCELLED')) as closed,
          {h("coalesce(sum(total_amount) filter (status = 'COMPLETED'), 0)")} as amount,
          {h("avg(quantity) filter (status = 'COMPLETED')", 6)} as mean_quantity,
          count(*) filter (currency = 'VND') as in_vnd
        from s_orders group by 1""")),
    Query("a5_distinct_counts", _distinct_counts, with_views("s_clicks", body="""
        select device, count(distinct session_id) as sessions, count(distinct user_id) as users,
          count(distinct user_id) filter (event_type = 'view_item') as viewers,
          count(distinct user_id) filter (event_type = 'add_to_cart') as carters,
          count(distinct session_id) filter (event_type = 'view_item') as view_sessions
        from s_clicks group by 1""")),
    Query("a8_min_max_dates", _min_max, with_views("s_orders", body="""
        select user_id, min(order_date) as first_date, max(order_date) as last_date,
          cast(max(order_date) - min(order_date) as int) as days from s_orders group by 1""")),
    Query("a9_newest_attributes", _newest_attributes, with_views("s_orders", body="""
        select user_id, currency, payment_method from s_orders
        qualify row_number() over (partition by user_id order by created_at desc, order_id desc) = 1""")),
    Query("a10_safe_ratios", _ratios, with_views("s_orders", body=f"""
        select user_id, {pct("count(*) filter (status = 'CANCELLED')", "count(*) filter (status in ('COMPLETED', 'CANCELLED'))")}
            as cancellation_pct,
          {h("coalesce(cast(sum(total_amount) filter (status = 'COMPLETED') as double) / nullif(count(*) filter (status = 'COMPLETED'), 0), 0)", 6)}
            as mean_amount
        from s_orders group by 1""")),
    Query("a12_distinct",
          lambda s, f: base.clicks(s, f).select("event_date", "user_id").distinct(),
          with_views("s_clicks", body="select distinct event_date, user_id from s_clicks")),
    Query("a13_count_per_session", lambda s, f: funnel.session_sizes(base.clicks(s, f)),
          with_views("s_clicks", body="select session_id, count(*) as event_count from s_clicks group by 1")),
    Query("a14_last_known_code", _first_last, with_views(rows=BEHAVIOUR_SQL, body="""
        select category_id, category_code as known_code from rows
        where product_id is not null and category_id is not null and category_code is not null
        qualify row_number() over (partition by category_id order by event_time desc, category_code desc) = 1""")),
    Query("a15_mean_positive_price", _mean_price, with_views(rows=BEHAVIOUR_SQL, body=f"""
        select product_id, coalesce({h("sum(cast(price as decimal(18,4))) filter (price > 0) / cast(count(*) filter (price > 0) as double)")},
          {DEFAULT_PRICE}) as avg_price from rows where product_id is not null and category_id is not null group by 1""")),
    Query("f1_iso_timestamps", _broken_dates, with_views("d_orders", body="""
        select id, case id % 4 when 0 then epoch_us(t) when 1 then epoch_us(t - interval 7 hour)
          when 2 then epoch_us(t) + 250000 end as us
        from (select id, strptime(created_at, '%Y-%m-%dT%H:%M:%SZ') as t from d_orders)""")),
    Query("f2_date_arithmetic", _dates, with_views("d_orders", body="""
        select id, day, cast(date_trunc('week', day) as date) as week_start, cast(date '2001-08-01' - day as int) as age,
          day - 3 as three_before, cast(date_trunc('week', day) as date) - 14 as two_weeks_before
        from (select id, cast(strptime(created_at, '%Y-%m-%dT%H:%M:%SZ') as date) as day from d_orders)""")),
    Query("f6_text_functions", _texts, with_views("d_products", body="""
        select product_id, coalesce(category_code, 'Unknown') as category, nullif(brand, 'Brand#1') as other_brand,
          'category_' || substr(lpad(product_id, 12, '7'), 1, 8) as placeholder,
          cast(ceil(avg_price * 0.1) as bigint) as tenth, brand like '%2%' as has_2 from d_products""")),
]
