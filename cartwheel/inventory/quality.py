"""Data checks, on tables damaged on purpose and on the marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.inventory import base
from cartwheel.inventory.base import Query, with_views
from cartwheel.operators import quality as ops
from cartwheel.plans import reports
from cartwheel.sources import domain


def _damaged_orders(spark, folder):
    """Orders without some users, with unknown states and currencies, negative totals and repeated ids."""
    key = F.col("id")
    o = domain.orders(spark, folder)
    return o.select(
        F.when(key % 40 == 3, key + 1).otherwise(key).alias("id"),
        F.when(key % 50 != 0, F.col("user_id")).alias("user_id"), "product_id",
        F.when(key % 60 == 0, "LOST").when(key % 61 == 0, None).otherwise(F.col("status")).alias("status"),
        F.when(key % 70 == 0, "XYZ").otherwise(F.col("currency")).alias("currency"),
        F.when(key % 80 == 0, -F.col("total_amount")).otherwise(F.col("total_amount")).cast("double").alias("total_amount"))


DAMAGED = """
    select case when id % 40 = 3 then id + 1 else id end as id, case when id % 50 <> 0 then user_id end as user_id,
      product_id, case when id % 60 = 0 then 'LOST' when id % 61 = 0 then null else status end as status,
      case when id % 70 = 0 then 'XYZ' else currency end as currency,
      cast(case when id % 80 = 0 then -total_amount else total_amount end as double) as total_amount
    from d_orders"""


def _violations(check):
    return lambda s, f: ops.violations(_damaged_orders(s, f), check)


def _damaged_report(spark, folder):
    return ops.run_suite({"orders": _damaged_orders(spark, folder)})


def _suite(spark, folder):
    """All checks of the source tables and the marts in one report."""
    return ops.run_suite({
        "orders": domain.orders(spark, folder), "products": domain.products(spark, folder),
        "users": domain.users(spark, folder), "exchange_rates": domain.rates(spark, folder),
        "clickstream": domain.clicks(spark, folder), "daily_sales": base.daily_sales(spark, folder),
        "product_performance": base.product_performance(spark, folder),
        "daily_funnel": base.daily_funnel(spark, folder), "product_engagement": base.product_engagement(spark, folder),
        "customer_snapshot": base.customer_snapshot(spark, folder),
    })


_EXPECTED_SUITE = " union all ".join(
    f"""select '{table}' as "table", '{c.column}' as "column", '{c.kind}' as "check", '{c.severity}' as severity,
      {("(select count(*) from " + view + " where " + {
          "not_null": f"{c.column} is null",
          "accepted_values": f"{c.column} not in ({', '.join(repr(v) for v in c.values)})",
          "accepted_range": f"not ({c.column} >= {c.low if c.low is not None else '-1e300'} and {c.column} <= {c.high if c.high is not None else '1e300'})",
      }[c.kind] + ")") if c.kind != "unique" else
      f"(select count(*) from (select {c.column} from {view} group by 1 having count(*) > 1))"} as failures"""
    for table, view in [("orders", "d_orders"), ("products", "d_products"), ("users", "d_users"),
                        ("exchange_rates", "d_rates"), ("clickstream", "d_clicks"), ("daily_sales", "m_sales"),
                        ("product_performance", "m_products"), ("daily_funnel", "m_funnel"),
                        ("product_engagement", "m_engagement"), ("customer_snapshot", "m_snapshot")]
    for c in ops.SUITES[table])
STATUS = "case when failures = 0 then 'pass' else case severity when 'error' then 'error' else 'warn' end end as status"


def _freshness(spark, folder):
    as_of = F.lit("2001-08-01 12:00:00").cast("timestamp")
    o = base.orders(spark, folder)
    late = o.filter(F.col("payment_method") == "momo")
    return ops.freshness(o, "daily_sales", "created_at", as_of, ops.FRESHNESS_MINUTES["daily_sales"]).unionByName(
        ops.freshness(late, "customer_snapshot", "updated_at", as_of, ops.FRESHNESS_MINUTES["customer_snapshot"]))


QUERIES = [
    Query("q1_not_null", _violations(ops.Check("not_null", "user_id")), with_views("d_orders", damaged=DAMAGED, body="""
        select * from damaged where user_id is null""")),
    Query("q2_unique", _violations(ops.Check("unique", "id")), with_views("d_orders", damaged=DAMAGED, body="""
        select id, count(*) as copies from damaged group by 1 having count(*) > 1""")),
    Query("q3_accepted_values", _violations(ops.accepted("status", "PENDING", "COMPLETED", "CANCELLED")[0]),
          with_views("d_orders", damaged=DAMAGED, body="select * from damaged where status = 'LOST'")),
    Query("q4_accepted_range", _violations(ops.between("total_amount", 0, 400000)[0]),
          with_views("d_orders", damaged=DAMAGED, body="""
            select * from damaged where total_amount < 0 or total_amount > 400000""")),
    Query("q5_damaged_report", _damaged_report, with_views("d_orders", damaged=DAMAGED, body=f"""
        select *, {STATUS} from (
          select 'orders' as "table", "column", "check", 'error' as severity, failures from (
            select 'id' as "column", 'not_null' as "check", count(*) filter (id is null) as failures from damaged
            union all select 'user_id', 'not_null', count(*) filter (user_id is null) from damaged
            union all select 'product_id', 'not_null', count(*) filter (product_id is null) from damaged
            union all select 'id', 'unique', (select count(*) from (select id from damaged group by 1 having count(*) > 1))
            union all select 'status', 'accepted_values', count(*) filter (status = 'LOST') from damaged
            union all select 'currency', 'accepted_values', count(*) filter (currency = 'XYZ') from damaged))""")),
    Query("q5_suite_report", _suite, with_views(
        "d_orders", "d_products", "d_users", "d_rates", "d_clicks", "m_sales", "m_products", "m_funnel", "m_engagement",
        "m_snapshot", body=f"select *, {STATUS} from ({_EXPECTED_SUITE})")),
    Query("q6_freshness", _freshness, with_views("s_orders", body="""
        select 'daily_sales' as "table", lag_minutes, cast(60 as bigint) as max_minutes, lag_minutes <= 60 as is_fresh
        from (select cast(floor((epoch_us(timestamp '2001-08-01 12:00:00') - epoch_us(max(created_at))) / 60000000) as bigint)
                as lag_minutes from s_orders)
        union all
        select 'customer_snapshot', lag_minutes, 1440, lag_minutes <= 1440
        from (select cast(floor((epoch_us(timestamp '2001-08-01 12:00:00') - epoch_us(max(updated_at))) / 60000000) as bigint)
                as lag_minutes from s_orders where payment_method = 'momo')""")),
    Query("q8_cancellation_alerts",
          lambda s, f: reports.cancellation_alerts(base.daily_sales(s, f)).select(
              "order_date", "category", "brand", "payment_method", "currency_group", "cancellation_rate_pct"),
          with_views("m_sales", body="""
            select order_date, category, brand, payment_method, currency_group, cancellation_rate_pct from m_sales
            where cancellation_rate_pct > 10""")),
    Query("q8_bounce_alerts",
          lambda s, f: reports.bounce_alerts(base.daily_funnel(s, f)).select("event_date", "device", "referrer_category", "bounce_rate_pct"),
          with_views("m_funnel", body="""
            select event_date, device, referrer_category, bounce_rate_pct from m_funnel where bounce_rate_pct > 40""")),
]
