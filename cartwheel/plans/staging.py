"""Staging: silver tables → renamed, typed, live rows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.scalars import iso_timestamp, referrer_category
from cartwheel.operators.changes import live
from cartwheel.operators.rates import forward_fill, forward_fill_from


def _or_unknown(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("Unknown"))


def _recent(rows: DataFrame, column: str, since: date | None) -> DataFrame:
    """Drop rows surely older than ``since`` by a plain comparison the scan can use to skip row groups and partitions.

    ISO text sorts by time; one day of slack covers UTC offsets. The exact filter stays with the mart.
    """
    if since is None or column not in rows.columns:
        return rows
    bound = since - timedelta(days=1)
    is_text = isinstance(rows.schema[column].dataType, T.StringType)
    return rows.filter(F.col(column) >= (F.lit(bound.isoformat()) if is_text else F.lit(bound)))


def stage_orders(orders: DataFrame, since: date | None = None) -> DataFrame:
    orders = _recent(orders, "created_at", since)
    created = iso_timestamp(F.col("created_at"))
    return live(orders).select(
        F.col("id").alias("order_id"), "user_id", "product_id", "quantity", "unit_price", "total_amount",
        "currency", "payment_method", "status",
        created.alias("created_at"),
        iso_timestamp(F.col("updated_at")).alias("updated_at"),
        F.to_date(created).alias("order_date"),
    )


def stage_products(products: DataFrame, category_col: str = "category_code") -> DataFrame:
    """The brand doubles as the product name. ``category_col`` may name a filled category column instead."""
    created = iso_timestamp(F.col("created_at"))
    return live(products).select(
        "product_id",
        F.col("brand").alias("product_name"),
        _or_unknown(category_col).alias("category"),
        _or_unknown("brand").alias("brand"),
        F.col("avg_price").alias("price"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )


def stage_users(users: DataFrame) -> DataFrame:
    created = iso_timestamp(F.col("created_at"))
    return live(users).select(
        F.col("id").alias("user_id"), F.col("name").alias("username"), "email",
        _or_unknown("city").alias("city"), _or_unknown("country").alias("country"),
        F.to_date(created).alias("registration_date"),
        created.alias("created_at"),
        iso_timestamp(F.col("updated_at")).alias("updated_at"),
    )


def stage_rates(rates: DataFrame) -> DataFrame:
    """Rates with gaps filled from the last known day; the raw value stays next to it."""
    raw = rates.select("exchange_date", "base_currency", "target_currency",
                       F.col("exchange_rate").alias("raw_exchange_rate"))
    return forward_fill(raw, ["base_currency", "target_currency"], "exchange_date", "raw_exchange_rate",
                        "exchange_rate")


PAIR = ["base_currency", "target_currency"]


def stage_rates_since(rates: DataFrame, closings: DataFrame, since: date) -> DataFrame:
    """``stage_rates`` from ``since`` on: reads the rates of its month and later, and the closings of the month before."""
    first = since.replace(day=1)
    before = closings.filter(F.col("month") == F.add_months(F.lit(first), -1)).select(*PAIR, F.col("exchange_rate").alias("raw_exchange_rate"))
    raw = rates.filter(F.col("exchange_date") >= F.lit(first)).select(
        "exchange_date", *PAIR, F.col("exchange_rate").alias("raw_exchange_rate"))
    return forward_fill_from(raw, PAIR, "exchange_date", "raw_exchange_rate", "exchange_rate", before, since).select(
        *PAIR, "exchange_date", "raw_exchange_rate", "exchange_rate")


CLICK_COLUMNS = (
    "event_id", "user_id", "session_id", "event_type", "device", "step", "real_order_id", "item_id", "duration_ms",
    "scroll_depth_pct", "search_query", "result_count", "click_target", "quantity", "cart_total", "purchase_amount",
)


def stage_clicks(clicks: DataFrame, since: date | None = None) -> DataFrame:
    """``event_date`` of silver files is their partition column, so filtering on it skips whole folders."""
    clicks = _recent(clicks, "event_date" if "event_date" in clicks.columns else "event_timestamp", since)
    ts = F.col("event_timestamp").cast("timestamp")
    return clicks.select(
        *CLICK_COLUMNS, ts.alias("event_timestamp"), F.to_date(ts).alias("event_date"),
        referrer_category(F.col("referrer")).alias("referrer_category"),
    )
