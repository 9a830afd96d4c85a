"""Sales marts: per day and per week × product."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import half_up, pct, ratio, week_start
from cartwheel.operators.joins import DIMENSION_ROWS, lookup_join
from cartwheel.operators.ranking import with_ranks
from cartwheel.operators.rates import with_rate, with_usd
from cartwheel.session import materialise


# Converted amounts as exact numbers, so that sums and ranks do not depend on the order of the rows.
EXACT = "decimal(28,6)"


def _since(df: DataFrame, column: str, since: date | None) -> DataFrame:
    return df if since is None else df.filter(F.col(column) >= F.lit(since))


def daily_sales(orders: DataFrame, products: DataFrame, rates: DataFrame, since: date | None = None,
                rates_bound: DataFrame | None = None) -> DataFrame:
    """Per date × category × brand × payment method × currency: completed, cancelled and pending orders.

    A catalogue counted to be small is broadcast, so the orders are not shuffled before they are
    combined; a larger one is joined by shuffle, where adaptive execution splits a best-seller.
    Amounts are summed as exact decimals in their own currency; since a group has one date and one
    currency, the rate is joined to the finished groups and divides each sum once.
    """
    keys = ["order_date", "category", "brand", "payment_method", "currency"]

    def amount(status: str) -> Column:
        return F.sum(F.when(F.col("status") == status, F.col("total_amount")))

    def n(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    named = lookup_join(_since(orders, "order_date", since), products.select("product_id", "category", "brand"),
                        ["product_id"], "inner", max_rows=DIMENSION_ROWS)
    groups = (
        named.groupBy(*keys)
        .agg(
            n("COMPLETED").alias("order_count"),
            amount("COMPLETED").alias("completed_amount"),
            F.count(F.when(F.col("status") == "COMPLETED", F.col("total_amount"))).alias("priced_count"),
            F.sum(F.when(F.col("status") == "COMPLETED", F.col("quantity"))).alias("completed_quantity"),
            n("CANCELLED").alias("cancelled_count"),
            n("PENDING").alias("pending_count"),
            amount("PENDING").alias("pending_amount"),
        )
    )
    rate = F.coalesce("rate", F.lit(1.0))
    revenue = F.col("completed_amount").cast("double") / rate
    return with_rate(groups, rates, rates_bound).select(
        "order_date", "category", "brand", "payment_method", F.col("currency").alias("currency_group"),
        "order_count",
        F.coalesce(revenue, F.lit(0.0)).alias("total_revenue_usd"),
        ratio(revenue, F.col("priced_count")).alias("avg_order_value_usd"),
        F.coalesce("completed_quantity", F.lit(0).cast("bigint")).alias("total_quantity_sold"),
        "cancelled_count",
        pct(F.col("cancelled_count"), F.col("order_count") + F.col("cancelled_count")).alias("cancellation_rate_pct"),
        "pending_count",
        F.coalesce(F.col("pending_amount").cast("double") / rate, F.lit(0.0)).alias("pending_revenue_usd"),
    )


def weekly_revenue(orders: DataFrame, products: DataFrame, rates: DataFrame, since: date | None = None,
                   rates_bound: DataFrame | None = None) -> DataFrame:
    """Completed orders per week × product, unranked.

    Orders are first summed per date × product × currency (a best-seller shrinks to a few rows per
    map task), then converted, then summed per week. ``order_id`` is the unique key of the orders
    table, so counting rows counts orders.
    """
    daily = (
        _since(orders, "order_date", since)
        .filter(F.col("status") == "COMPLETED")
        .groupBy("order_date", "product_id", "currency")
        .agg(F.sum("quantity").alias("units"), F.count("order_id").alias("orders"),
             F.count("total_amount").alias("priced"), F.sum("total_amount").alias("amount"))
    )
    weekly = (
        with_usd(daily, rates, "amount", "usd", rates_bound).withColumn("usd", F.col("usd").cast(EXACT))
        .groupBy(week_start(F.col("order_date")).alias("week_start"), "product_id")
        .agg(F.sum("units").cast("bigint").alias("units_sold"), F.sum("orders").alias("order_count"),
             F.sum("priced").alias("priced"), F.sum("usd").alias("revenue"))
    )
    named = products.select("product_id", "product_name", "category", "brand")
    return weekly.join(named, "product_id", "inner")


def product_performance(orders: DataFrame, products: DataFrame, rates: DataFrame, since: date | None = None,
                        rates_bound: DataFrame | None = None) -> DataFrame:
    """Per week × product: sales, ranks by unrounded revenue and units, top flags. Unknown revenue ranks last."""
    weekly = weekly_revenue(orders, products, rates, since, rates_bound)
    ranked = with_ranks(
        materialise(weekly, "weekly_revenue"), ["week_start"],
        {"revenue": "revenue_rank_in_week", "units_sold": "units_rank_in_week"}, total="total_products_in_week")
    top_tenth = F.ceil(F.col("total_products_in_week") * F.lit(0.10))
    return ranked.select(
        "week_start", "product_id", "product_name", "category", "brand", "units_sold", "order_count",
        half_up(F.col("revenue")).alias("revenue_usd"),
        half_up(ratio(F.col("revenue"), F.col("priced"))).alias("avg_order_value_usd"),
        "revenue_rank_in_week", "units_rank_in_week", "total_products_in_week",
        (F.col("revenue_rank_in_week") <= top_tenth).alias("is_top_10_pct_revenue"),
        (F.col("revenue_rank_in_week") <= 3).alias("is_top_3_revenue"),
    )
