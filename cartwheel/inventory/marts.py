"""Staging and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.inventory import base
from cartwheel.inventory.base import Query, h, micros, shown, with_views
from cartwheel.operators.catalogue import build_catalogue
from cartwheel.sources import domain


def _stg_orders(spark, folder):
    return base.orders(spark, folder).select(
        "order_id", "user_id", "product_id", "quantity", F.col("unit_price").cast("double").alias("unit_price"),
        F.col("total_amount").cast("double").alias("total_amount"), "currency", "payment_method", "status",
        micros("created_at"), micros("updated_at"), "order_date")


def _stg_products(spark, folder):
    return base.products(spark, folder).select(
        "product_id", "product_name", "category", "brand", F.col("price").cast("double").alias("price"),
        micros("created_at"), micros("updated_at"))


def _stg_users(spark, folder):
    return base.users(spark, folder).select("user_id", "username", "email", "city", "country", "registration_date")


def _stg_clicks(spark, folder):
    c = base.clicks(spark, folder)
    return c.withColumn("event_timestamp", F.unix_micros("event_timestamp")).withColumn(
        "cart_total", F.col("cart_total").cast("double")).withColumn(
        "purchase_amount", F.col("purchase_amount").cast("double"))


BEHAVIOUR_SQL = """
    select strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as event_time,
      case event_type when 'click' then 'cart' when 'purchase' then 'purchase' else 'view' end as event_type,
      case when event_id % 101 <> 0 then cast(p_partkey as varchar) end as product_id,
      case when event_id % 103 <> 0 then cast(2053013550000000 + p_partkey % 12 as varchar) end as category_id,
      case when event_id % 7 >= 4 and p_partkey % 12 <> 5 and p_partkey % 13 <> 0
        then lower(p_type) || '.' || (p_partkey % 12) end as category_code,
      case when event_id % 5 <> 0 and p_partkey % 11 <> 0 then p_brand end as brand,
      case when event_id % 13 = 0 then 0.0 when event_id % 17 = 0 then -1.0
        when p_partkey % 19 <> 0 then value end as price,
      cast(user_id as varchar) as user_id, 's' || event_id as user_session
    from (select *, event_id % (select count(*) from part) as part_of from events) join part on part_of = p_partkey"""


def catalogue_sql(rows: str) -> str:
    """Catalogue of the rows in the given view."""
    return f"""
        select product_id, p.category_id, category_code,
          coalesce(category_code, known_code, 'category_' || substr(p.category_id, 1, 8)) as category_fill, brand, avg_price
        from (select product_id, arg_min(category_id, (event_time, category_id)) as category_id,
                arg_min(category_code, (event_time, category_code)) filter (category_code is not null) as category_code,
                coalesce(arg_min(brand, (event_time, brand)) filter (brand is not null), 'unknown') as brand,
                coalesce({h("sum(cast(price as decimal(18,4))) filter (price > 0) / cast(count(*) filter (price > 0) as double)")}, 0.01) as avg_price
              from {rows} where product_id is not null and category_id is not null group by product_id) p
        left join (select category_id, arg_max(category_code, (event_time, category_code)) as known_code from {rows}
                   where product_id is not null and category_id is not null and category_code is not null
                   group by category_id) k on p.category_id = k.category_id"""


def _catalogue(spark, folder):
    return build_catalogue(domain.behaviour_rows(spark, folder))


QUERIES = [
    Query("g1_stg_orders", _stg_orders, with_views("s_orders", body="""
        select order_id, user_id, product_id, quantity, cast(unit_price as double) as unit_price,
          cast(total_amount as double) as total_amount, currency, payment_method, status,
          epoch_us(created_at) as created_at, epoch_us(updated_at) as updated_at, order_date from s_orders""")),
    Query("g2_stg_products", _stg_products, with_views("s_products", "d_products", body="""
        select s.* exclude (price), cast(price as double) as price, epoch_us(d.created_at) as created_at,
          epoch_us(d.created_at) as updated_at from s_products s join d_products d using (product_id)""")),
    Query("g3_stg_users", _stg_users, with_views("s_users", body="select * from s_users")),
    Query("g4_stg_exchange_rates", base.rates, with_views("s_rates", body="select * from s_rates")),
    Query("g5_stg_clickstream", _stg_clicks, with_views("s_clicks", body="""
        select * exclude (eid, event_timestamp, cart_total, purchase_amount),
          epoch_us(event_timestamp) as event_timestamp, cast(cart_total as double) as cart_total,
          cast(purchase_amount as double) as purchase_amount from s_clicks""")),
    Query("m1_daily_sales",
          lambda s, f: shown(base.daily_sales(s, f), base.SALES_MONEY, base.SALES_MEANS),
          with_views("m_sales", body=f"""
            select * replace ({h("total_revenue_usd")} as total_revenue_usd,
              {h("pending_revenue_usd")} as pending_revenue_usd,
              {h("avg_order_value_usd", 6)} as avg_order_value_usd) from m_sales""")),
    Query("m2_product_performance", base.product_performance,
          with_views("m_products_flagged", body="select * from m_products_flagged")),
    Query("m3_daily_funnel", base.daily_funnel, with_views("m_funnel", body="select * from m_funnel")),
    Query("m4_product_engagement", base.product_engagement,
          with_views("m_engagement", body="select * from m_engagement")),
    Query("m5_customer_snapshot",
          lambda s, f: shown(base.customer_snapshot(s, f), ("total_revenue_usd",), ("avg_order_value_usd",)),
          with_views("m_snapshot", body=f"""
            select * replace ({h("total_revenue_usd")} as total_revenue_usd,
              {h("avg_order_value_usd", 6)} as avg_order_value_usd) from m_snapshot""")),
    Query("m6_rfm_segment", lambda s, f: base.customer_snapshot(s, f).select("user_id", "customer_segment"),
          with_views("m_snapshot", body="select user_id, customer_segment from m_snapshot")),
    Query("m7_product_catalogue", _catalogue,
          with_views(rows=BEHAVIOUR_SQL, body=catalogue_sql("rows"))),
]
