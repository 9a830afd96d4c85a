"""Exchange rates: documents → rows, forward fill, conversion to USD."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.scalars import usd
from cartwheel.operators.joins import lookup_join

# --- fixed values: currencies kept on landing ---
CURRENCIES_KEPT = ("USD", "VND", "RUB", "EUR", "GBP", "JPY", "CNY", "KRW", "THB", "SGD")

_RATE_MAP = T.MapType(T.StringType(), T.DoubleType())


def keep_currencies(documents: DataFrame) -> DataFrame:
    return documents.withColumn("rates", F.map_filter("rates", lambda code, _: code.isin(*CURRENCIES_KEPT)))


def rates_as_map(documents: DataFrame, keep_nulls: bool = True) -> Column:
    """The rates object as map<currency, rate>, so that a new currency is a row and not a column.

    With ``keep_nulls=False`` currencies without a rate vanish, as plain JSON conversion does.
    """
    if isinstance(documents.schema["rates"].dataType, T.MapType):
        rates = F.col("rates").cast(_RATE_MAP)
        return rates if keep_nulls else F.map_filter(rates, lambda _, rate: rate.isNotNull())
    text = F.to_json("rates", {"ignoreNullFields": str(not keep_nulls).lower()})
    return F.from_json(text, _RATE_MAP)


def rate_rows(documents: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """FX documents → silver rows, one per (date, base, target).

    Of several documents on a day the one ingested last counts; a currency it has no rate for keeps
    the rate of an earlier document of that day.
    """
    at = F.try_to_timestamp("_ingested_at")
    rows = documents.select(
        F.to_date(at).alias("exchange_date"), F.col("base_code").alias("base_currency"), at.alias("at"),
        F.explode(rates_as_map(documents, keep_nulls)).alias("target_currency", "rate"))
    newest = F.max(F.struct(F.col("rate").isNotNull().alias("known"), "at", "rate")).alias("newest")
    return rows.groupBy("exchange_date", "base_currency", "target_currency").agg(newest).select(
        "exchange_date", "base_currency", "target_currency", F.col("newest.rate").alias("exchange_rate"))


def forward_fill(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """Last non-NULL ``value`` at or before each row, per key, ordered by a DATE.

    Works in two levels so that a long series is not one task: rows are filled inside their
    (key, month), and what is still empty takes the last value of an earlier month. The window
    over months sees one row per key and month.
    """
    month = F.trunc(order, "month")
    inside = Window.partitionBy(*keys, "_month").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_month", month)
    closing = (
        rows.groupBy(*keys, "_month")
        .agg(F.max(F.when(F.col(value).isNotNull(), F.struct(order, value))).alias("_close"))
        .withColumn("_carry", F.last(F.col(f"_close.{value}"), ignorenulls=True).over(before))
        .drop("_close")
    )
    on = [*keys, "_month"]
    filled = rows.withColumn("_inside", F.last(value, ignorenulls=True).over(inside))
    return (
        filled.join(closing, on, "left")
        .withColumn(out, F.coalesce("_inside", "_carry"))
        .drop("_month", "_inside", "_carry")
    )


def monthly_closings(df: DataFrame, keys: list[str], order: str, value: str, before: DataFrame | None, until: date) -> DataFrame:
    """Per key and month the last non-NULL ``value`` at or before its end, for all months of ``df`` up to that of ``until``.

    ``before`` (keys and ``value``) holds the closings of the month before ``df`` begins. A key without rows in a month keeps
    its value.
    """
    month = F.trunc(order, "month")
    own = (df.filter(F.col(value).isNotNull()).groupBy(*keys, month.alias("month"))
           .agg(F.max_by(value, order).alias(value)))
    first = df.agg(F.min(month)).first()[0] or until
    if before is not None:
        own = own.unionByName(before.select(*keys, F.add_months(F.trunc(F.lit(first), "month"), -1).alias("month"), value))
    months = F.sequence(F.add_months(F.trunc(F.lit(first), "month"), -1), F.trunc(F.lit(until), "month"), F.expr("interval 1 month"))
    grid = own.select(*keys).distinct().withColumn("month", F.explode(months))
    so_far = Window.partitionBy(*keys).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    filled = grid.join(own, [*keys, "month"], "left").withColumn(value, F.last(value, ignorenulls=True).over(so_far))
    return filled.filter((F.col("month") >= F.trunc(F.lit(first), "month")) & F.col(value).isNotNull())


def forward_fill_from(df: DataFrame, keys: list[str], order: str, value: str, out: str, before: DataFrame, start: date) -> DataFrame:
    """``forward_fill`` of rows from the month of ``start`` on, with what the months before them leave (``before``: keys, ``value``)."""
    first = start.replace(day=1)
    carried = before.select(*keys, F.date_sub(F.lit(first), 1).alias(order), value)
    rows = carried.unionByName(df.filter(F.col(order) >= F.lit(first)), allowMissingColumns=True)
    return forward_fill(rows, keys, order, value, out).filter(F.col(order) >= F.lit(start))


def with_rate(facts: DataFrame, staged_rates: DataFrame, bound: DataFrame | None = None) -> DataFrame:
    """Add the USD rate of (order_date, currency); NULL where there is none.

    Rates are one row per day and currency, so the calendar bounds them; the size is checked anyway.
    """
    lookup = staged_rates.filter(F.col("base_currency") == "USD").select(
        F.col("exchange_date").alias("order_date"), F.col("target_currency").alias("currency"),
        F.col("exchange_rate").alias("rate"))
    return lookup_join(facts, lookup, ["order_date", "currency"], "left", bound)


def with_usd(facts: DataFrame, staged_rates: DataFrame, amount: str, out: str,
             bound: DataFrame | None = None) -> DataFrame:
    return with_rate(facts, staged_rates, bound).withColumn(out, usd(F.col(amount), F.col("rate"))).drop("rate")


def missing_rates(orders: DataFrame, staged_rates: DataFrame, bound: DataFrame | None = None) -> DataFrame:
    """Orders in a foreign currency that fall back to rate 1, counted per currency."""
    foreign = orders.filter(F.col("currency") != "USD")
    return (
        with_rate(foreign, staged_rates, bound)
        .filter(F.col("rate").isNull())
        .groupBy("currency")
        .agg(F.count("*").alias("orders_without_rate"))
    )
