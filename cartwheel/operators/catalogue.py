"""Product catalogue from historical shop behaviour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import category_placeholder, half_up
from cartwheel.session import materialise

DEFAULT_BRAND = "unknown"
DEFAULT_PRICE = 0.01


def _present(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def seen_attributes(rows: DataFrame, ts: str = "event_time") -> DataFrame:
    """One row per combination of product, category, code and brand: when first and last seen, and its paid prices.

    The history repeats a product's attributes on every event, so this shrinks it to little more
    than one row per product, in one hash aggregation with map-side combine: numbers are its only
    buffers. Rows without a product or category id are skipped.
    """
    us = F.unix_micros(F.try_to_timestamp(ts))
    paid = F.when(F.col("price") > 0, F.col("price").try_cast("decimal(18,4)"))
    return (
        rows.select(_present("product_id").alias("product_id"), _present("category_id").alias("category_id"),
                    _present("category_code").alias("code"), _present("brand").alias("brand"),
                    us.alias("us"), paid.alias("paid"))
        .filter(F.col("product_id").isNotNull() & F.col("category_id").isNotNull())
        .groupBy("product_id", "category_id", "code", "brand")
        .agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"),
             F.sum("paid").alias("paid"), F.count("paid").alias("paid_rows"))
    )


def _first(c: str) -> Column:
    """Value seen first; of several at the same instant the smallest."""
    return F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("first_us", c)))


def known_codes(seen: DataFrame) -> DataFrame:
    """category_id → the code seen last with it; of several at the same instant the greatest.

    The rows are hashed down to one per category and code before anything is picked.
    """
    coded = seen.filter(F.col("code").isNotNull()).groupBy("category_id", "code").agg(F.max("last_us").alias("last_us"))
    return coded.groupBy("category_id").agg(F.max_by("code", F.struct("last_us", "code")).alias("known_code"))


def mean_price(paid: Column, rows: Column) -> Column:
    """Mean of the positive prices to the cent; the sum is a decimal, so the order does not matter."""
    return F.coalesce(half_up(paid.cast("double") / F.nullif(rows, F.lit(0)).cast("double")), F.lit(DEFAULT_PRICE))


def build_catalogue(rows: DataFrame, ts: str = "event_time") -> DataFrame:
    """One row per product id.

    Each attribute is the first value seen, the category falls back to the code last seen with its
    id, then to a placeholder. The history is read once. Adaptive execution broadcasts the codes when they turn out small.
    """
    seen = materialise(seen_attributes(rows, ts), "seen")
    products = seen.groupBy("product_id").agg(
        _first("category_id").alias("category_id"),
        _first("code").alias("category_code"),
        F.coalesce(_first("brand"), F.lit(DEFAULT_BRAND)).alias("brand"),
        mean_price(F.sum("paid"), F.sum("paid_rows")).alias("avg_price"),
    )
    fill = F.coalesce("category_code", "known_code", category_placeholder(F.col("category_id")))
    return products.join(known_codes(seen), "category_id", "left").select(
        "product_id", "category_id", "category_code", fill.alias("category_fill"), "brand", "avg_price")
