"""Reports on the marts."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame

from cartwheel.inventory import base
from cartwheel.inventory.base import Query, h, pct, shown, snapshot_sql, with_views
from cartwheel.plans import reports

SNAPSHOT_DAYS = [base.ORDERS_AS_OF - timedelta(days=n) for n in (15, 8, 7, 1, 0)]
SNAPSHOTS_SQL = " union all ".join(f"select * from ({snapshot_sql(str(d))})" for d in SNAPSHOT_DAYS)
EVENT_WEEKS = [date(2024, 1, d) for d in (1, 8, 15, 22, 29)]
HISTOGRAM_WIDTH = 50_000.0


def _snapshots(spark, folder) -> DataFrame:
    return reduce(DataFrame.unionByName, [base.customer_snapshot(spark, folder, d) for d in SNAPSHOT_DAYS])


def _on(build, report, money=(), means=()):
    return lambda s, f: shown(report(build(s, f)), money, means)


def _mean(c: str, weight: str) -> str:
    return h(f"(sum(cast({c} as double) * {weight}) / nullif(cast(sum({weight}) filter ({c} is not null) as double), 0))")


def _pivot_columns() -> str:
    return ", ".join(f"max({m}) filter (week_start = date '{w}') as w{w:%Y%m%d}_{m}"
                     for w in EVENT_WEEKS for m in ("duration", "scroll", "rate"))


def _engagement_sql(*keys: str) -> str:
    return f"""
        select {', '.join(keys)}, cast(sum(view_sessions) as bigint) as view_sessions,
          {_mean("avg_view_duration_sec", "view_sessions")} as duration,
          {_mean("avg_scroll_depth_pct", "view_sessions")} as scroll,
          {pct("sum(users_added_to_cart)", "sum(unique_viewers)")} as rate
        from m_engagement group by all"""


QUERIES = [
    Query("v1_daily_kpis", lambda s, f: shown(reports.daily_kpis(base.daily_sales(s, f), base.daily_funnel(s, f)),
                                              ("gmv_usd",), ("avg_order_value_usd",)),
          with_views("m_sales", "m_funnel", body=f"""
            select day, {h("coalesce(gmv, 0)")} as gmv_usd, cast(coalesce(orders, 0) as bigint) as orders,
              {h("gmv / nullif(orders, 0)", 6)} as avg_order_value_usd, {pct("buyers", "viewers")} as conversion_pct
            from (select order_date as day, sum(total_revenue_usd) as gmv, sum(order_count) as orders from m_sales group by 1)
            full join (select event_date as day, sum(users_truly_completed) as buyers, sum(users_viewed_product) as viewers
                       from m_funnel group by 1) using (day)""")),
    Query("v2_revenue_and_orders", _on(base.daily_sales, reports.revenue_and_orders, ("revenue_usd",)),
          with_views("m_sales", body=f"""
            select order_date, {h("sum(total_revenue_usd)")} as revenue_usd, cast(sum(order_count) as bigint) as orders
            from m_sales group by 1""")),
    Query("v3_revenue_share", _on(base.daily_sales, reports.revenue_share, ("revenue_usd",)),
          with_views("m_sales", body=f"""
            select category, brand, {h("sum(total_revenue_usd)")} as revenue_usd,
              {pct("sum(total_revenue_usd)", "(select sum(total_revenue_usd) from m_sales)")} as share_pct
            from m_sales group by 1, 2""")),
    Query("v4_funnel_steps", _on(base.daily_funnel, reports.funnel_steps), with_views("m_funnel", body="""
        select step, cast(users as bigint) as users from (
          select sum(users_viewed_product) as "1 view", sum(users_added_to_cart) as "2 cart",
            sum(users_initiated_checkout) as "3 checkout", sum(users_confirmed_checkout) as "4 confirm",
            sum(users_truly_completed) as "5 completed" from m_funnel)
        unpivot (users for step in ("1 view", "2 cart", "3 checkout", "4 confirm", "5 completed"))""")),
    Query("v5_segments_by_week", _on(_snapshots, lambda d: reports.segments_by_week(d, base.ORDERS_AS_OF)),
          with_views("s_users", "o_usd", snapshots=SNAPSHOTS_SQL, body="""
            select cast(date_trunc('week', snapshot_date) as date) as week_start, customer_segment, count(*) as customers
            from snapshots where snapshot_date in (select max(snapshot_date) from snapshots
                                                   group by date_trunc('week', snapshot_date))
            group by 1, 2""")),
    Query("v6_cancellation_by_category", _on(base.daily_sales, reports.cancellation_by_category),
          with_views("m_sales", body=f"""
            select *, cancellation_rate_pct > 10 as is_alert from (
              select category, cast(sum(cancelled_count) as bigint) as cancelled, cast(sum(order_count) as bigint) as completed,
                {pct("sum(cancelled_count)", "(sum(cancelled_count) + sum(order_count))")} as cancellation_rate_pct
              from m_sales group by 1)""")),
    Query("v7_weekly_leaderboard", _on(base.product_performance, lambda d: reports.weekly_leaderboard(d).select(
        "week_start", "place", "product_id", "revenue_usd", "revenue_rank_in_week")),
          with_views("m_products", body="""
            select week_start, cast(row_number() over (partition by week_start order by revenue_rank_in_week, product_id) as int)
                as place, product_id, revenue_usd, revenue_rank_in_week
            from m_products qualify place <= 10""")),
    Query("v8_expected_gmv", _on(base.daily_sales, reports.expected_gmv, ("expected_gmv_usd",)),
          with_views("m_sales", body=f"""
            select order_date, {h("sum(total_revenue_usd) + sum(pending_revenue_usd)")} as expected_gmv_usd
            from m_sales group by 1""")),
    Query("v9_vip_counts", _on(base.customer_snapshot, reports.vip_counts), with_views("m_snapshot", body="""
        select snapshot_date, count(*) filter (is_high_value) as vips,
          count(*) filter (is_high_value and customer_segment in ('At Risk', 'Lost')) as vips_at_risk
        from m_snapshot group by 1""")),
    Query("v10_vip_action_list", _on(base.customer_snapshot, reports.vip_action_list, ("total_revenue_usd",)),
          with_views("m_snapshot", body=f"""
            select user_id, customer_segment, {h("total_revenue_usd")} as total_revenue_usd, total_orders, days_since_last_order
            from m_snapshot where is_high_value and customer_segment in ('At Risk', 'Lost')
            order by m_snapshot.total_revenue_usd desc, user_id limit 100""")),
    Query("v11_revenue_histogram", _on(base.customer_snapshot, lambda d: reports.revenue_histogram(d, HISTOGRAM_WIDTH)),
          with_views("m_snapshot", body=f"""
            select customer_segment, cast(floor(total_revenue_usd / {HISTOGRAM_WIDTH}) as bigint) as bucket,
              count(*) as customers, cast(floor(total_revenue_usd / {HISTOGRAM_WIDTH}) as double) * {HISTOGRAM_WIDTH} as from_usd
            from m_snapshot group by all""")),
    Query("v12_conversion_trend", _on(base.daily_funnel, reports.conversion_trend), with_views("m_funnel", body=f"""
        select *, {h("avg(true_purchase_rate) over (partition by referrer_category order by event_date rows between 6 preceding and current row)", 4)}
            as rolling_rate
        from (select referrer_category, event_date,
                {pct("sum(users_truly_completed)", "sum(users_viewed_product)")} as true_purchase_rate
              from m_funnel group by 1, 2)""")),
    Query("v13_engagement_by_device", _on(base.daily_funnel, reports.engagement_by_device), with_views("m_funnel", body=f"""
        select *, bounce_rate_pct > 40 as is_alert from (
          select device, cast(sum(total_sessions) as bigint) as sessions,
            {_mean("bounce_rate_pct", "total_sessions")} as bounce_rate_pct,
            {_mean("avg_session_duration_sec", "total_sessions")} as avg_session_duration_sec,
            {_mean("avg_scroll_depth_pct", "total_sessions")} as avg_scroll_depth_pct from m_funnel group by 1)""")),
    Query("v14_engagement_pivot", _on(base.product_engagement, lambda d: reports.engagement_pivot(d, EVENT_WEEKS)),
          with_views("m_engagement", weekly=_engagement_sql(
              "product_id", "cast(date_trunc('week', event_date) as date) as week_start"),
              body=f"select product_id, {_pivot_columns()} from weekly group by 1")),
    Query("v15_product_quadrants", _on(base.product_engagement, reports.product_quadrants),
          with_views("m_engagement", products=_engagement_sql("product_id", "coalesce(category, 'Unknown') as category"),
                     body="""
            select product_id, category, view_sessions, duration as avg_view_duration_sec, rate as view_to_cart_rate,
              case when d >= md and r >= mr then 'star' when d >= md then 'leaking traffic'
                when r >= mr then 'hidden gem' else 'ignore' end as quadrant
            from (select *, median(d) over (partition by category) as md, median(r) over (partition by category) as mr
                  from (select *, round(duration * 100) as d, round(rate * 100) as r from products
                        where duration is not null and rate is not null))""")),
    Query("v16_segment_transitions", _on(_snapshots, reports.segment_transitions),
          with_views("s_users", "o_usd", snapshots=SNAPSHOTS_SQL, body="""
            select snapshot_date, from_segment, customer_segment as to_segment, count(*) as customers
            from (select *, lag(customer_segment) over (partition by user_id order by snapshot_date) as from_segment
                  from snapshots) where from_segment is not null group by 1, 2, 3""")),
    Query("v16_cohort_growth", _on(_snapshots, reports.cohort_growth, ("revenue_usd",)),
          with_views("s_users", "o_usd", snapshots=SNAPSHOTS_SQL, body=f"""
            select cohort_month, snapshot_date, customers, {h("revenue")} as revenue_usd,
              {pct("(revenue - lag(revenue) over w)", "(lag(revenue) over w)")} as growth_pct
            from (select cast(date_trunc('month', registration_date) as date) as cohort_month, snapshot_date,
                    count(*) as customers, sum(total_revenue_usd) as revenue from snapshots group by 1, 2)
            window w as (partition by cohort_month order by snapshot_date)""")),
    Query("v17_popular_queries", _on(base.clicks, reports.popular_queries), with_views("s_clicks", body="""
        select search_query, count(*) as searches, count(distinct user_id) as users from s_clicks
        where event_type = 'search' and search_query is not null
        group by 1 order by searches desc, search_query limit 20""")),
]
