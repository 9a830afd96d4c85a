"""Customer snapshot: one row per user and snapshot date."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import ratio_or_zero, rfm_segment
from cartwheel.operators.rates import with_usd
from cartwheel.plans.sales import EXACT

VIP_REVENUE = 500
# above every 64-bit order id
ID_RANGE = Decimal(10) ** 19
YEAR_ONE = -62_135_596_800_000_000


def order_stats(orders: DataFrame, rates: DataFrame, rates_bound: DataFrame | None = None) -> DataFrame:
    """Completed orders per user. ``order_id`` is unique, so counting rows counts orders; the attributes
    of the newest order win, ties going to the higher order id. Revenue is a sum of exact decimals, so it does not depend
    on the order of the rows.

    Time and id are ranked as one number, so the orders are only hashed into a row per user, currency
    and payment method; the few rows left are what the greatest rank is picked from.
    """
    done = orders.filter(F.col("status") == "COMPLETED")
    at = F.coalesce(F.unix_micros("created_at"), F.lit(YEAR_ONE)).cast("decimal(18,0)")
    rank = at * F.lit(ID_RANGE) + F.col("order_id").cast("decimal(20,0)")
    attributes = ["currency", "payment_method"]
    return (
        with_usd(done, rates, "total_amount", "usd", rates_bound).withColumn("usd", F.col("usd").try_cast(EXACT))
        .groupBy("user_id", *attributes)
        .agg(F.count("order_id").alias("orders"), F.min("order_date").alias("first"), F.max("order_date").alias("last"),
             F.sum("usd").alias("usd"), F.max(rank).alias("rank"))
        .groupBy("user_id")
        .agg(F.sum("orders").alias("total_orders"), F.min("first").alias("first_order_date"),
             F.max("last").alias("last_order_date"), F.sum("usd").cast("double").alias("revenue"),
             F.max_by(F.struct(*attributes), "rank").alias("newest"))
    )


def customer_attributes(users: DataFrame, orders: DataFrame, rates: DataFrame, as_of: date,
                        rates_bound: DataFrame | None = None) -> DataFrame:
    """What is known of every user on ``as_of`` and stays as it is until something happens; later orders do not count."""
    stats = order_stats(orders.filter(F.col("order_date") <= F.lit(as_of)), rates, rates_bound)
    people = users.select("user_id", "city", "country", "registration_date")
    return people.join(stats, "user_id", "left").select(
        "user_id", "city", "country", "registration_date", F.coalesce("total_orders", F.lit(0).cast("bigint")).alias("total_orders"),
        "first_order_date", "last_order_date", "revenue", F.col("newest.currency").alias("preferred_currency"),
        F.col("newest.payment_method").alias("preferred_payment"))


def seen_on(attributes: DataFrame, day: Column) -> DataFrame:
    """The snapshot of a day from the attributes: with recency, lifespan, segment and VIP flag."""
    recency = F.datediff(day, F.col("last_order_date"))
    revenue = F.coalesce("revenue", F.lit(0.0))
    return attributes.select(
        day.alias("snapshot_date"), "user_id", "city", "country", "registration_date",
        recency.alias("days_since_last_order"), "total_orders", "first_order_date", "last_order_date",
        F.datediff("last_order_date", "first_order_date").alias("customer_lifespan_days"),
        revenue.alias("total_revenue_usd"),
        ratio_or_zero(F.col("revenue"), F.col("total_orders")).alias("avg_order_value_usd"),
        "preferred_currency", "preferred_payment",
        rfm_segment(recency, F.col("total_orders"), F.col("revenue")).alias("customer_segment"),
        (revenue > VIP_REVENUE).alias("is_high_value"),
    )


def customer_snapshot(users: DataFrame, orders: DataFrame, rates: DataFrame, as_of: date,
                      rates_bound: DataFrame | None = None) -> DataFrame:
    """Recency, frequency, revenue, segment and VIP flag of every user on ``as_of``; later orders do not count."""
    return seen_on(customer_attributes(users, orders, rates, as_of, rates_bound), F.lit(as_of))
