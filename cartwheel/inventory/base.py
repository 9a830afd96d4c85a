"""Query entries and the SQL views they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.scalars import half_up
from cartwheel.plans import customers, funnel, sales, staging
from cartwheel.session import pin
from cartwheel.sources import domain

ORDERS_AS_OF = date.fromisoformat(domain.ORDERS_AS_OF)
EVENTS_AS_OF = date.fromisoformat(domain.EVENTS_AS_OF)


@dataclass(frozen=True)
class Query:
    name: str
    plan: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.plan(pin(spark), folder)


# --- staged tables ---------------------------------------------------------------------------


def orders(spark, folder, since=None) -> DataFrame:
    return staging.stage_orders(domain.orders(spark, folder), since)


def products(spark, folder) -> DataFrame:
    return staging.stage_products(domain.products(spark, folder))


def users(spark, folder) -> DataFrame:
    return staging.stage_users(domain.users(spark, folder))


def rates(spark, folder) -> DataFrame:
    return staging.stage_rates(domain.rates(spark, folder))


def clicks(spark, folder, since=None) -> DataFrame:
    return staging.stage_clicks(domain.clicks(spark, folder), since)


# --- marts -----------------------------------------------------------------------------------


def daily_sales(spark, folder, since=None) -> DataFrame:
    return sales.daily_sales(orders(spark, folder, since), products(spark, folder), rates(spark, folder), since,
                             rates_bound=domain.rates(spark, folder))


def product_performance(spark, folder, since=None) -> DataFrame:
    return sales.product_performance(orders(spark, folder, since), products(spark, folder), rates(spark, folder), since,
                                     rates_bound=domain.rates(spark, folder))


def daily_funnel(spark, folder, since=None) -> DataFrame:
    edge = since - timedelta(days=1) if since else None  # sessions crossing into the window
    return funnel.daily_funnel(clicks(spark, folder, edge), orders(spark, folder), since)


def product_engagement(spark, folder, since=None) -> DataFrame:
    return funnel.product_engagement(clicks(spark, folder, since), products(spark, folder), since)


def customer_snapshot(spark, folder, as_of=ORDERS_AS_OF) -> DataFrame:
    return customers.customer_snapshot(users(spark, folder), orders(spark, folder), rates(spark, folder), as_of,
                                       rates_bound=domain.rates(spark, folder))


def shown(df: DataFrame, money: tuple[str, ...] = (), means: tuple[str, ...] = ()) -> DataFrame:
    """Amounts to the cent and means to six decimals, so that two engines print the same digits."""
    for c in money:
        df = df.withColumn(c, half_up(F.col(c)))
    for c in means:
        df = df.withColumn(c, half_up(F.col(c), 6))
    return df


SALES_MONEY = ("total_revenue_usd", "pending_revenue_usd")
SALES_MEANS = ("avg_order_value_usd",)


def micros(c: str) -> Column:
    return F.unix_micros(c).alias(c)


# --- SQL -------------------------------------------------------------------------------------


def h(x: str, digits: int = 2) -> str:
    """ROUND of a number as a decimal; a double is taken by the digits it prints."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,10)), {digits}) as double)"


def pct(a: str, b: str) -> str:
    return h(f"(cast({a} as double) / nullif(cast({b} as double), 0) * 100)")


# name → (views it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "d_orders": ((), """
        select o.o_orderkey as id, o.o_custkey as user_id, cast(coalesce(l.pk, 0) as varchar) as product_id,
          coalesce(l.qty, 1) as quantity,
          cast(floor(o.o_totalprice / coalesce(l.qty, 1)) as decimal(18,2)) as unit_price,
          cast(o.o_totalprice as decimal(18,2)) as total_amount,
          (['USD','VND','SGD','EUR','JPY'])[o.o_custkey % 5 + 1] as currency,
          case o.o_orderpriority when '1-URGENT' then 'credit_card' when '2-HIGH' then 'bank_transfer'
            when '3-MEDIUM' then 'momo' when '4-NOT SPECIFIED' then 'vnpay' else 'paypal' end as payment_method,
          case o.o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'PENDING' else 'CANCELLED' end as status,
          strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as created_at,
          strftime(o.o_orderdate + interval 1 hour, '%Y-%m-%dT%H:%M:%SZ') as updated_at,
          o.o_orderkey % 14 = 0 as is_deleted
        from orders o left join (select l_orderkey, min(l_partkey) as pk, cast(sum(l_quantity) as bigint) as qty
                                 from lineitem group by l_orderkey) l on o.o_orderkey = l.l_orderkey"""),
    "d_products": ((), """
        select cast(p_partkey as varchar) as product_id, case when p_partkey % 7 <> 0 then p_type end as category_code,
          case when p_partkey % 11 <> 0 then p_brand end as brand, cast(p_retailprice as decimal(18,2)) as avg_price,
          timestamp '2019-09-30 17:00:00' as created_at from part"""),
    "d_users": ((), """
        select c.c_custkey as id, c.c_name as name, lower(replace(c.c_name, '#', '.')) || '@example.com' as email,
          '+84 ' || lpad(cast(c.c_custkey as varchar), 9, '0') as phone,
          case when c.c_custkey % 10 <> 0 then n.n_name end as city, r.r_name as country,
          date '1995-01-01' + cast(c.c_custkey % 365 as int) as registration_date
        from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey"""),
    "d_rates": ((), """
        select d as exchange_date, 'USD' as base_currency, c.cur as target_currency,
          case when c.cur = 'USD' or day(d) % 9 <> 0
            then cast(c.base as double) * (1 + day(d) / cast(1000 as double)) end as exchange_rate
        from (select distinct cast(o_orderdate as date) as d from orders) x,
          (values ('USD', 1.0), ('VND', 25000.0), ('SGD', 1.35), ('EUR', 0.92), ('JPY', 150.0)) as c(cur, base)
        where day(d) <> 28"""),
    "d_raw": ((), """
        select cast(event_id as varchar) as event_id, event_id as eid, user_id, ts as event_timestamp,
          case event_type when 'view' then 'view_item' when 'click' then 'add_to_cart' when 'purchase' then 'checkout'
            when 'signup' then 'search' else 'scroll' end as event_type,
          (['mobile','desktop','tablet'])[event_id % 3 + 1] as device,
          (['google.com','bing.com','facebook.com','tiktok.com','email','direct',null,'','partner.example',
            'www.youtube.com'])[event_id % 10 + 1] as referrer,
          case when event_type in ('view','click','purchase') then cast(event_id % (select count(*) from part) as varchar) end as item_id,
          case when event_type in ('view','error') then cast(floor(value * 1000) as int) end as duration_ms,
          case when event_type in ('view','error') then cast(json_extract_string(props, '$.k') as int) end
            as scroll_depth_pct,
          case when event_type = 'signup' then 'query ' || (event_id % 25) end as search_query,
          case when event_type = 'signup' then cast(event_id % 40 as int) end as result_count,
          cast(null as varchar) as click_target,
          case when event_type = 'click' then cast(1 + event_id % 3 as int) end as quantity,
          case when event_type = 'purchase' then cast(value as float) end as cart_total,
          case when event_type = 'purchase' then (['confirmation','payment','shipping','shipping'])[event_id % 4 + 1] end
            as step,
          case when event_type = 'purchase' and event_id % 4 = 0 then event_id end as real_order_id,
          cast(value as float) as purchase_amount
        from events"""),
    "d_clicks": (("d_raw",), """
        select * exclude (gap_before, nth), user_id || '-' || min(epoch_us(event_timestamp)) over (
            partition by user_id, nth) as session_id
        from (select *, sum(case when gap_before is null or gap_before >= 1800000000 then 1 else 0 end) over (
                partition by user_id order by event_timestamp, eid rows unbounded preceding) as nth
              from (select *, epoch_us(event_timestamp) - lag(epoch_us(event_timestamp)) over (
                      partition by user_id order by event_timestamp, eid) as gap_before from d_raw))"""),
    "s_orders": (("d_orders",), """
        select id as order_id, * exclude (id, created_at, updated_at, is_deleted),
          strptime(created_at, '%Y-%m-%dT%H:%M:%SZ') as created_at,
          strptime(updated_at, '%Y-%m-%dT%H:%M:%SZ') as updated_at,
          cast(strptime(created_at, '%Y-%m-%dT%H:%M:%SZ') as date) as order_date
        from d_orders where not is_deleted"""),
    "s_products": (("d_products",), """
        select product_id, brand as product_name, coalesce(category_code, 'Unknown') as category,
          coalesce(brand, 'Unknown') as brand, avg_price as price from d_products"""),
    "s_users": (("d_users",), """
        select id as user_id, name as username, email, coalesce(city, 'Unknown') as city, country, registration_date
        from d_users"""),
    "s_rates": (("d_rates",), """
        select d.exchange_date, d.base_currency, d.target_currency, d.exchange_rate as raw_exchange_rate, k.exchange_rate
        from d_rates d asof left join (select * from d_rates where exchange_rate is not null) k
          on d.base_currency = k.base_currency and d.target_currency = k.target_currency and d.exchange_date >= k.exchange_date"""),
    "s_clicks": (("d_clicks",), """
        select d_clicks.* exclude (referrer), cast(event_timestamp as date) as event_date, coalesce(channel, 'other') as referrer_category
        from d_clicks left join (
          select referrer, arg_min(channel, rank) as channel
          from (select distinct referrer from d_clicks) join (values
            ('%google%', 'organic_search', 1), ('%bing%', 'organic_search', 1), ('%yahoo%', 'organic_search', 1), ('%facebook%', 'social', 2),
            ('%instagram%', 'social', 2), ('%tiktok%', 'social', 2), ('%twitter%', 'social', 2), ('%youtube%', 'social', 2),
            ('email', 'email', 3), ('direct', 'direct', 4), ('', 'direct', 4)) w(pattern, channel, rank)
            on coalesce(referrer, '') like pattern group by referrer) c on d_clicks.referrer is not distinct from c.referrer"""),
    "o_usd": (("s_orders", "s_rates"), """
        select o.*, r.exchange_rate as rate, cast(o.total_amount as double) / coalesce(r.exchange_rate, 1.0) as usd
        from s_orders o left join s_rates r
          on o.order_date = r.exchange_date and o.currency = r.target_currency and r.base_currency = 'USD'"""),
    "m_sales": (("o_usd", "s_products"), f"""
        select order_date, category, brand, payment_method, currency as currency_group,
          count(*) filter (status = 'COMPLETED') as order_count,
          coalesce(sum(usd) filter (status = 'COMPLETED'), 0) as total_revenue_usd,
          avg(usd) filter (status = 'COMPLETED') as avg_order_value_usd,
          cast(coalesce(sum(quantity) filter (status = 'COMPLETED'), 0) as bigint) as total_quantity_sold,
          count(*) filter (status = 'CANCELLED') as cancelled_count,
          {pct("count(*) filter (status = 'CANCELLED')", "count(*) filter (status in ('COMPLETED', 'CANCELLED'))")}
            as cancellation_rate_pct,
          count(*) filter (status = 'PENDING') as pending_count,
          coalesce(sum(usd) filter (status = 'PENDING'), 0) as pending_revenue_usd
        from o_usd join s_products using (product_id) group by all"""),
    "m_products": (("o_usd", "s_products"), f"""
        select week_start, product_id, product_name, category, brand, units_sold, order_count,
          {h("revenue")} as revenue_usd, {h("mean")} as avg_order_value_usd,
          rank() over (partition by week_start order by revenue desc nulls last) as revenue_rank_in_week,
          rank() over (partition by week_start order by units_sold desc) as units_rank_in_week,
          count(*) over (partition by week_start) as total_products_in_week
        from (select cast(date_trunc('week', order_date) as date) as week_start, product_id, product_name, category,
                brand, cast(sum(units) as bigint) as units_sold, cast(sum(orders) as bigint) as order_count,
                sum(usd) as revenue, cast(sum(usd) as double) / nullif(sum(priced), 0) as mean
              from (select order_date, product_id, sum(quantity) as units, count(distinct order_id) as orders,
                      count(total_amount) as priced,
                      cast(cast(sum(total_amount) as double) / coalesce(any_value(rate), 1.0) as decimal(28,6)) as usd
                    from o_usd where status = 'COMPLETED' group by order_date, product_id, currency)
              join s_products using (product_id) group by all)"""),
    "m_products_flagged": (("m_products",), """
        select *, revenue_rank_in_week <= ceil(total_products_in_week * 0.10) as is_top_10_pct_revenue,
          revenue_rank_in_week <= 3 as is_top_3_revenue from m_products"""),
    "m_funnel": (("s_clicks", "s_orders"), f"""
        select event_date, device, referrer_category, total_sessions, viewed as users_viewed_product,
          carted as users_added_to_cart, checkout as users_initiated_checkout, confirmed as users_confirmed_checkout,
          completed as users_truly_completed, {pct("carted", "viewed")} as view_to_cart_rate,
          {pct("checkout", "carted")} as cart_to_checkout_rate, {pct("completed", "viewed")} as true_purchase_rate,
          {h("ms / 1000.0")} as avg_session_duration_sec, {h("depth")} as avg_scroll_depth_pct,
          {pct("bounced", "total_sessions")} as bounce_rate_pct
        from (select e.event_date, e.device, e.referrer_category, count(distinct e.session_id) as total_sessions,
            count(distinct e.user_id) filter (e.event_type = 'view_item') as viewed,
            count(distinct e.user_id) filter (e.event_type = 'add_to_cart') as carted,
            count(distinct e.user_id) filter (e.event_type = 'checkout') as checkout,
            count(distinct e.user_id) filter (e.step = 'confirmation') as confirmed,
            count(distinct e.user_id) filter (t.user_id is not null) as completed,
            avg(e.duration_ms) as ms, avg(e.scroll_depth_pct) as depth,
            count(distinct e.session_id) filter (z.size = 1) as bounced
          from s_clicks e
          left join (select distinct c.event_date, c.user_id from s_clicks c
                     join s_orders o on c.real_order_id = o.order_id
                     where c.step = 'confirmation' and o.status = 'COMPLETED') t
            on e.user_id = t.user_id and e.event_date = t.event_date
          left join (select session_id, count(*) as size from s_clicks group by session_id) z
            on e.session_id = z.session_id
          group by all)"""),
    "m_engagement": (("s_clicks", "s_products"), f"""
        select event_date, item_id as product_id, product_name, category, brand, view_sessions, unique_viewers,
          users_added_to_cart, {pct("users_added_to_cart", "unique_viewers")} as view_to_cart_rate,
          {h("ms / 1000.0")} as avg_view_duration_sec, {h("depth")} as avg_scroll_depth_pct, search_impressions
        from (select event_date, item_id, product_name, category, brand,
            count(distinct session_id) filter (event_type = 'view_item') as view_sessions,
            count(distinct user_id) filter (event_type = 'view_item') as unique_viewers,
            count(distinct user_id) filter (event_type = 'add_to_cart') as users_added_to_cart,
            avg(duration_ms) filter (event_type = 'view_item') as ms,
            avg(scroll_depth_pct) filter (event_type = 'view_item') as depth,
            count(*) filter (event_type = 'search') as search_impressions
          from s_clicks left join s_products on item_id = s_products.product_id
          where item_id is not null group by all)"""),
}


def snapshot_sql(as_of: str) -> str:
    """Customer snapshot of one day over the views s_users and o_usd."""
    return f"""
        select date '{as_of}' as snapshot_date, user_id, city, country, registration_date,
          cast(date '{as_of}' - last_order_date as int) as days_since_last_order,
          coalesce(n, 0) as total_orders, first_order_date, last_order_date,
          cast(last_order_date - first_order_date as int) as customer_lifespan_days,
          coalesce(revenue, 0) as total_revenue_usd, coalesce(revenue / n, 0) as avg_order_value_usd,
          last_seen.currency as preferred_currency, last_seen.payment_method as preferred_payment,
          case when n is null then 'Never Bought' when date '{as_of}' - last_order_date > 180 then 'Lost'
            when date '{as_of}' - last_order_date > 60 and revenue > 100 then 'At Risk'
            when date '{as_of}' - last_order_date <= 30 and n >= 5 and revenue >= 200 then 'Champions'
            when date '{as_of}' - last_order_date <= 60 and n >= 3 then 'Loyal'
            when date '{as_of}' - last_order_date <= 30 and n <= 2 then 'Promising' else 'New' end as customer_segment,
          coalesce(revenue, 0) > 500 as is_high_value
        from s_users left join (
          select user_id, count(distinct order_id) as n, min(order_date) as first_order_date,
            max(order_date) as last_order_date, cast(sum(cast(usd as decimal(28,6))) as double) as revenue,
            arg_max({{'currency': currency, 'payment_method': payment_method}},
                    {{'at': created_at, 'order_id': order_id}}) as last_seen
          from o_usd where status = 'COMPLETED' and order_date <= date '{as_of}' group by user_id) using (user_id)"""


VIEWS["m_snapshot"] = (("s_users", "o_usd"), snapshot_sql(domain.ORDERS_AS_OF))


def with_views(*names: str, body: str, **extra: str) -> str:
    """``body`` preceded by the named shared views, the views they need, and extra ones in the given order."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = [f"{n} as ({VIEWS[n][1]})" for n in order] + [f"{n} as ({text})" for n, text in extra.items()]
    return f"with {', '.join(parts)} {body}" if parts else body
