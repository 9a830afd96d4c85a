"""Writers, refreshes and upkeep: results are read back from the written tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from cartwheel.inventory import base
from cartwheel.inventory.base import Query, h, shown, snapshot_sql, with_views
from cartwheel.inventory.marts import BEHAVIOUR_SQL, catalogue_sql
from cartwheel.operators.catalogue import build_catalogue
from cartwheel.operators.quality import content_hash
from cartwheel.plans import customers
from cartwheel.plans.windows import recompute_since
from cartwheel.session import scratch_dir
from cartwheel.sinks import intervals, tables, upkeep
from cartwheel.sources import domain

SHOWN_SALES = f"""
    select * replace ({h("total_revenue_usd")} as total_revenue_usd, {h("pending_revenue_usd")} as pending_revenue_usd,
      {h("avg_order_value_usd", 6)} as avg_order_value_usd) from m_sales"""


def _sales(df):
    return shown(df, base.SALES_MONEY, base.SALES_MEANS)


def _dynamic_overwrite(spark, folder):
    """All events by day, then the days from the 20th on again with other values: earlier days must stay."""
    path = scratch_dir(spark, "days")
    events = domain.raw_clicks(spark, folder).select("event_id", "user_id", F.to_date("event_timestamp").alias("event_date"))
    tables.overwrite_partitions(events, path, ["event_date"])
    newer = events.filter(F.col("event_date") >= F.lit(date(2024, 1, 20)))
    tables.overwrite_partitions(newer.withColumn("user_id", -F.col("user_id")), path, ["event_date"])
    return spark.read.parquet(path)


def _delete_insert(spark, folder):
    """Rows keyed by (user, category with NULLs): the newer set replaces the keys it has."""
    o = base.orders(spark, folder).join(domain.products(spark, folder).select("product_id", "category_code"), "product_id")
    keys = ["currency", "category_code"]
    old = o.groupBy(*keys).agg(F.count("*").alias("orders"))
    new = o.filter(F.col("currency").isin("USD", "EUR")).groupBy(*keys).agg((-F.count("*")).alias("orders"))
    return tables.delete_insert(old, new, keys)


REFRESHED_SINCE = date(2024, 1, 20)


def _refreshed(spark, folder):
    """An engagement mart with stale figures from a day on, refreshed over that window: equal to a full run."""
    path = scratch_dir(spark, "engagement")
    recent = F.col("event_date") >= F.lit(REFRESHED_SINCE)
    stale = base.product_engagement(spark, folder).withColumn(
        "view_sessions", F.when(recent, F.lit(-1).cast("bigint")).otherwise(F.col("view_sessions")))
    # a date that no longer has events must disappear
    ghost = stale.filter(F.col("event_date") == F.lit(REFRESHED_SINCE)).withColumn(
        "event_date", F.lit(REFRESHED_SINCE + timedelta(days=900)))
    tables.refresh_window(stale.unionByName(ghost), path, "event_date")
    tables.refresh_window(base.product_engagement(spark, folder, REFRESHED_SINCE), path, "event_date", REFRESHED_SINCE)
    return spark.read.parquet(path)


def _incremental(mart, build, column):
    def plan(spark, folder):
        as_of = base.ORDERS_AS_OF if mart in ("daily_sales", "product_performance") else base.EVENTS_AS_OF
        since = recompute_since(mart, as_of)
        df = build(spark, folder, since)
        return _sales(df) if mart == "daily_sales" else df
    return plan


SNAPSHOT_DAYS = (base.ORDERS_AS_OF - timedelta(days=1), base.ORDERS_AS_OF)


def _snapshots(spark, folder):
    """Two days, each written twice: the second time must add nothing."""
    path = scratch_dir(spark, "snapshots")
    for day in (*SNAPSHOT_DAYS, *SNAPSHOT_DAYS):
        tables.append_snapshot(base.customer_snapshot(spark, folder, day), path, "snapshot_date", day)
    return spark.read.parquet(path).groupBy("snapshot_date", "customer_segment").agg(
        F.count("*").alias("customers"), F.count_if("is_high_value").alias("vips"))


STATE_DAYS = tuple(base.ORDERS_AS_OF - timedelta(days=n) for n in (3, 2, 1, 0))


def _customer_states(spark, folder):
    """Customers of four days, across the end of a month, stored as changes; each day's snapshot rebuilt from them.

    Two in three of the users are there from the start, some leave after the first day.
    """
    path = scratch_dir(spark, "states")
    for day in STATE_DAYS:
        known = customers.customer_attributes(_users_on(base.users(spark, folder), day), base.orders(spark, folder), base.rates(spark, folder),
                                              day, domain.rates(spark, folder))
        for _ in range(2):  # the second time changes nothing
            intervals.append_state(known, path, "user_id", day)
    states = intervals.on_days(spark, path, "user_id", STATE_DAYS[0], STATE_DAYS[-1])
    return shown(customers.seen_on(states, F.col("day")), ("total_revenue_usd",), ("avg_order_value_usd",))


def _users_on(users, day):
    number = STATE_DAYS.index(day)
    return users.filter(f"user_id % 3 <> {2 if number < 2 else 9} and user_id % 7 <> {1 if number else 9}")


def _insert_absent(spark, folder):
    """Catalogue of the first days, then of all days: products already there keep their first values."""
    path = scratch_dir(spark, "catalogue")
    rows = domain.behaviour_rows(spark, folder)
    early = rows.filter(F.col("event_time") < "2024-01-02")
    for part in (early, rows, rows):
        tables.insert_absent(build_catalogue(part), path, "product_id")
    return spark.read.parquet(path)


def _views(spark, folder):
    tables.create_views({"stg_orders": base.orders(spark, folder), "stg_products": base.products(spark, folder)})
    return spark.sql("SELECT category, count(*) AS orders FROM stg_orders JOIN stg_products USING (product_id) GROUP BY 1")


def _registered(spark, folder):
    """Products written as a table, registered twice and read by name."""
    root = scratch_dir(spark, "catalog")
    domain.products(spark, folder).repartition(4).write.partitionBy("brand").parquet(f"{root}/products")
    database = f"silver_{root.rsplit('-', 1)[-1]}"
    for _ in range(2):
        missing = tables.register_tables(spark, database, root, {"products": f"{root}/products", "absent": f"{root}/absent"})
    found = spark.table(f"{database}.products").groupBy("brand").agg(F.count("*").alias("products"))
    return found.withColumn("missing", F.lit(",".join(missing)))


def _compacted(spark, folder):
    """Events in many small files per day, compacted: the same rows in one file per day."""
    path = scratch_dir(spark, "events")
    events = domain.raw_clicks(spark, folder).select(
        "event_id", "user_id", "event_type", F.to_date("event_timestamp").alias("event_date"))
    events.repartition(6).write.partitionBy("event_date").parquet(path)
    upkeep.compact(spark, path, ["event_date"])
    per_day = upkeep.list_files(spark, path).groupBy(F.regexp_extract("folder", r"event_date=([0-9-]+)$", 1).cast("date")
                                                    .alias("event_date")).agg(F.count("*").alias("files"))
    return spark.read.parquet(path).groupBy("event_date").agg(
        F.count("*").alias("events"), F.sum("user_id").alias("users")).join(per_day, "event_date")


def _expired_versions(spark, folder):
    versions = domain.orders(spark, folder).select(
        F.col("payment_method").alias("table"), F.col("id").alias("version"), F.to_date("created_at").alias("written"))
    return upkeep.expired_versions(versions, F.lit(date(2001, 7, 20)), 700)


def _versioned(spark, folder):
    """Two rebuilds of a table; readers see the second, expiry removes the first."""
    path = scratch_dir(spark, "versions")
    rows = domain.products(spark, folder).select("product_id", "brand")
    tables.write_version(rows.withColumn("brand", F.lit("before")), path)
    tables.write_version(rows, path)
    upkeep.expire_versions(spark, path, date.today() + timedelta(days=30))
    kept = len(tables.complete_versions(spark, path))
    return tables.read_latest(spark, path).withColumn("versions", F.lit(kept))


def _stats(spark, folder):
    path = scratch_dir(spark, "stats")
    domain.products(spark, folder).repartition(3).write.parquet(f"{path}/products")
    domain.rates(spark, folder).repartition(2).write.parquet(f"{path}/rates/version=1")
    stats = upkeep.table_stats(spark, {"products": f"{path}/products", "rates": f"{path}/rates"})
    return stats.select("table", "files", "versions", (F.col("bytes") > 0).alias("has_bytes"))


def _expired_objects(spark, folder):
    prefix = F.element_at(F.array(*[F.lit(p) for p in ("clickstream/", "checkpoints/", "cdc_postgres/",
                                                       "api_exchange_rates/", "batch_ecommerce/")]),
                          (F.col("id") % 5 + 1).cast("int"))
    objects = domain.orders(spark, folder).select(
        F.concat(prefix, F.col("id").cast("string"), F.lit(".json")).alias("key"), F.to_date("created_at").alias("written"))
    return upkeep.expired_objects(objects, F.lit(base.ORDERS_AS_OF))


def _rerun_equal(spark, folder):
    """Rows and content hash of the refreshed funnel mart before and after two more runs."""
    path = scratch_dir(spark, "rerun")
    tables.refresh_window(base.daily_funnel(spark, folder), path, "event_date")

    def state():
        return content_hash(spark.read.parquet(path)).first()

    first = state()
    for _ in range(2):
        tables.refresh_window(base.daily_funnel(spark, folder, REFRESHED_SINCE), path, "event_date", REFRESHED_SINCE)
    same = state() == first
    return spark.read.parquet(path).withColumn("unchanged", F.lit(same))


QUERIES = [
    Query("k4_dynamic_overwrite", _dynamic_overwrite, with_views("d_raw", body="""
        select event_id, case when event_timestamp >= date '2024-01-20' then -user_id else user_id end as user_id,
          cast(event_timestamp as date) as event_date from d_raw""")),
    Query("k6_delete_insert", _delete_insert, with_views("s_orders", "d_products", body="""
        select currency, category_code, case when currency in ('USD', 'EUR') then -count(*) else count(*) end as orders
        from s_orders join d_products using (product_id) group by 1, 2""")),
    Query("k6_refreshed_engagement", _refreshed, with_views("m_engagement", body="select * from m_engagement")),
    Query("k7_guarded_append", _snapshots, with_views(
        "s_users", "o_usd", two_days=" union all ".join(f"select * from ({snapshot_sql(str(d))})" for d in SNAPSHOT_DAYS),
        body="""select snapshot_date, customer_segment, count(*) as customers, count(*) filter (is_high_value) as vips
                from two_days group by 1, 2""")),
    Query("k7_customer_states", _customer_states, with_views(
        "s_users", "o_usd", days=" union all ".join(
            f"select * from ({snapshot_sql(str(d))}) where user_id % 3 <> {2 if n < 2 else 9} and user_id % 7 <> {1 if n else 9}"
            for n, d in enumerate(STATE_DAYS)),
        body=f"""select * replace ({h("total_revenue_usd")} as total_revenue_usd, {h("avg_order_value_usd", 6)} as avg_order_value_usd)
                 from days""")),
    Query("k8_insert_absent", _insert_absent, with_views(
        rows=BEHAVIOUR_SQL, early="select * from rows where event_time < '2024-01-02'",
        a=catalogue_sql("early"), b=catalogue_sql("rows"),
        body="select * from a union all select * from b where product_id not in (select product_id from a)")),
    Query("k9_staging_views", _views, with_views("s_orders", "s_products", body="""
        select category, count(*) as orders from s_orders join s_products using (product_id) group by 1""")),
    Query("k10_registered_table", _registered, with_views("d_products", body="""
        select brand, count(*) as products, 'absent' as missing from d_products group by 1""")),
    Query("k11_sales_window", _incremental("daily_sales", base.daily_sales, "order_date"), with_views(
        "m_sales", body=SHOWN_SALES + " where order_date >= date '2001-07-29'")),
    Query("k11_product_window", _incremental("product_performance", base.product_performance, "week_start"), with_views(
        "m_products_flagged", body="select * from m_products_flagged where week_start >= date '2001-07-16'")),
    Query("k11_funnel_window", _incremental("daily_funnel", base.daily_funnel, "event_date"), with_views(
        "m_funnel", body="select * from m_funnel where event_date >= date '2024-01-28'")),
    Query("k11_engagement_window", _incremental("product_engagement", base.product_engagement, "event_date"), with_views(
        "m_engagement", body="select * from m_engagement where event_date >= date '2024-01-28'")),
    Query("q7_rerun_unchanged", _rerun_equal, with_views("m_funnel", body="select *, true as unchanged from m_funnel")),
    Query("t1_compacted_events", _compacted, with_views("d_raw", body="""
        select cast(event_timestamp as date) as event_date, count(*) as events, cast(sum(user_id) as bigint) as users,
          cast(1 as bigint) as files from d_raw group by 1""")),
    Query("t2_expired_versions", _expired_versions, with_views("d_orders", body="""
        select payment_method as "table", id as version, cast(strptime(created_at, '%Y-%m-%dT%H:%M:%SZ') as date) as written
        from d_orders d where cast(strptime(created_at, '%Y-%m-%dT%H:%M:%SZ') as date) < date '2001-07-20' - 700
          and id < (select max(id) from d_orders m where m.payment_method = d.payment_method)""")),
    Query("t2_versioned_rebuild", _versioned, with_views("d_products", body="""
        select product_id, brand, 1 as versions from d_products""")),
    Query("t3_table_stats", _stats, """
        select 'products' as "table", cast(3 as bigint) as files, cast(0 as bigint) as versions, true as has_bytes
        union all select 'rates', 2, 1, true"""),
    Query("t4_expired_objects", _expired_objects, with_views("d_orders", body="""
        select prefix || id || '.json' as key, written, days_kept
        from (select id, cast(strptime(created_at, '%Y-%m-%dT%H:%M:%SZ') as date) as written,
                (['clickstream/','checkpoints/','cdc_postgres/','api_exchange_rates/','batch_ecommerce/'])[id % 5 + 1] as prefix,
                (cast([7,7,7,30,null] as int[]))[id % 5 + 1] as days_kept from d_orders)
        where written < date '2001-08-01' - days_kept""")),
]
