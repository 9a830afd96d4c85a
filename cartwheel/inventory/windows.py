"""Window functions, ranks, limits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions.scalars import cents, half_up
from cartwheel.inventory import base
from cartwheel.inventory.base import Query, h, with_views
from cartwheel.operators.changes import latest_per_key
from cartwheel.operators.ranking import exact_median, with_ranks
from cartwheel.plans import reports
from cartwheel.session import materialise
from cartwheel.sources import domain


def _dedup(spark, folder):
    items = domain.table(spark, folder, "lineitem")
    return latest_per_key(items, "l_orderkey", ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")).select(
        "l_orderkey", "l_linenumber", "l_partkey")


def _rank(spark, folder):
    orders = materialise(
        base.orders(spark, folder).select("order_id", "payment_method", "quantity", cents(F.col("total_amount")).alias("cents")),
        "ranked")
    return with_ranks(orders, ["payment_method"], {"cents": "by_amount", "quantity": "by_quantity"}, total="orders").select(
        "order_id", "by_amount", "by_quantity", "orders", (F.col("by_amount") <= F.ceil(F.col("orders") * F.lit(0.10))).alias("top"))


def _median(spark, folder):
    orders = base.orders(spark, folder).select("currency", cents(F.col("total_amount")).alias("cents"))
    return exact_median(orders, ["currency"], "cents", "median_cents")


def _sample(spark, folder):
    """1,000 random completed orders; which ones is left to chance, how many and of what kind is not."""
    done = base.orders(spark, folder).filter(F.col("status") == "COMPLETED")
    picked = done.select("order_id", "status").orderBy(F.rand(7)).limit(1000)
    return picked.groupBy("status").agg(F.countDistinct("order_id").alias("orders"))


QUERIES = [
    Query("w1_row_number_dedup", _dedup, """
        select l_orderkey, l_linenumber, l_partkey from lineitem
        qualify row_number() over (partition by l_orderkey
          order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) = 1"""),
    Query("w2_rank_in_group", _rank, with_views("s_orders", body="""
        select order_id, by_amount, by_quantity, orders, by_amount <= ceil(orders * 0.10) as top
        from (select order_id, rank() over (partition by payment_method order by total_amount desc) as by_amount,
                rank() over (partition by payment_method order by quantity desc) as by_quantity,
                count(*) over (partition by payment_method) as orders from s_orders)""")),
    Query("w3_median_in_group", _median, with_views("s_orders", body="""
        select currency, median(cast(total_amount * 100 as bigint)) as median_cents from s_orders group by 1""")),
    Query("w4_last_known_rate",
          lambda s, f: base.rates(s, f).filter(F.col("raw_exchange_rate").isNull()).select(
              "exchange_date", "target_currency", "exchange_rate"),
          with_views("s_rates", body="""
            select exchange_date, target_currency, exchange_rate from s_rates where raw_exchange_rate is null""")),
    Query("w7_rolling_mean", lambda s, f: reports.conversion_trend(base.daily_funnel(s, f)), with_views("m_funnel", body=f"""
        select referrer_category, event_date, true_purchase_rate,
          {h("avg(true_purchase_rate) over (partition by referrer_category order by event_date rows between 6 preceding and current row)", 4)}
            as rolling_rate
        from (select referrer_category, event_date,
                {base.pct("sum(users_truly_completed)", "sum(users_viewed_product)")} as true_purchase_rate
              from m_funnel group by 1, 2)""")),
    Query("w8_top_orders",
          lambda s, f: base.orders(s, f).orderBy(F.col("total_amount").desc(), "order_id").limit(100).select(
              "order_id", half_up(F.col("total_amount")).alias("total_amount")),
          with_views("s_orders", body=f"""
            select order_id, {h("total_amount")} as total_amount from s_orders
            order by s_orders.total_amount desc, order_id limit 100""")),
    Query("w9_random_sample", _sample, with_views("s_orders", body="""
        select 'COMPLETED' as status, least(count(*), 1000) as orders from s_orders where status = 'COMPLETED'""")),
    Query("w10_max_id",
          lambda s, f: domain.users(s, f).agg(F.coalesce(F.max("id"), F.lit(1000)).alias("max_id")),
          with_views("d_users", body="select coalesce(max(id), 1000) as max_id from d_users")),
]
