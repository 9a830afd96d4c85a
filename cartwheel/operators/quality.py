"""Declarative data checks, one pass per table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str                     # not_null | unique | accepted_values | accepted_range
    column: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    severity: str = "error"


def not_null(*columns: str) -> list[Check]:
    return [Check("not_null", c) for c in columns]


def unique(*columns: str) -> list[Check]:
    return [Check("unique", c) for c in columns]


def accepted(column: str, *values: str) -> list[Check]:
    return [Check("accepted_values", column, values=values)]


def between(column: str, low: float | None = None, high: float | None = None, severity: str = "error") -> list[Check]:
    return [Check("accepted_range", column, low=low, high=high, severity=severity)]


# --- fixed values: the checks of every table, their accepted values and bounds ---
SUITES: dict[str, list[Check]] = {
    "orders": [
        *not_null("id", "user_id", "product_id"), *unique("id"),
        *accepted("status", "PENDING", "COMPLETED", "CANCELLED"),
        *accepted("currency", "USD", "VND", "SGD", "EUR", "JPY"),
    ],
    "products": [*not_null("product_id"), *unique("product_id")],
    "users": [*not_null("id"), *unique("id")],
    "exchange_rates": not_null("exchange_date", "base_currency", "target_currency"),
    "clickstream": not_null("event_id", "user_id", "session_id"),
    "daily_sales": [
        *not_null("order_date", "category", "total_revenue_usd"),
        *between("total_revenue_usd", 0), *between("cancellation_rate_pct", 0, 100),
        *between("pending_revenue_usd", 0), *between("avg_order_value_usd", 0),
    ],
    "product_performance": [
        *not_null("week_start", "product_id", "revenue_usd"),
        *between("revenue_usd", 0), *between("units_sold", 0), *between("revenue_rank_in_week", 1),
    ],
    # a user may add to the cart without a view on that day, so the step rates can pass 100: a warning only
    "daily_funnel": [
        *not_null("event_date", "device", "referrer_category"),
        *accepted("referrer_category", "organic_search", "social", "email", "direct", "other"),
        *between("true_purchase_rate", 0, 100, "warn"), *between("bounce_rate_pct", 0, 100),
        *between("view_to_cart_rate", 0, 100, "warn"),
    ],
    "product_engagement": [
        *not_null("event_date", "product_id"),
        *between("view_to_cart_rate", 0, 100, "warn"), *between("avg_view_duration_sec", 0),
    ],
    "customer_snapshot": [
        *not_null("snapshot_date", "user_id", "customer_segment", "total_revenue_usd", "total_orders"),
        *accepted("customer_segment", "Champions", "Loyal", "Promising", "At Risk", "New", "Lost", "Never Bought"),
        *between("total_revenue_usd", 0), *between("total_orders", 0), *between("avg_order_value_usd", 0),
    ],
}


def violates(check: Check) -> Column:
    """True for a row that breaks a row-level check. NULL breaks only ``not_null``."""
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return F.coalesce(~c.isin(*check.values), F.lit(False))
    broken = F.lit(False)
    if check.low is not None:
        broken = broken | (c < check.low)
    if check.high is not None:
        broken = broken | (c > check.high)
    return F.coalesce(broken, F.lit(False))


def violations(df: DataFrame, check: Check) -> DataFrame:
    """Rows that break the check; for ``unique`` the repeated values with their count."""
    if check.kind != "unique":
        return df.filter(violates(check))
    counted = df.filter(F.col(check.column).isNotNull()).groupBy(check.column).agg(F.count("*").alias("copies"))
    return counted.filter(F.col("copies") > 1)


def check_table(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """Report rows (table, column, check, severity, failures, status).

    All row-level checks are counted in one scan; every uniqueness check adds one grouping by its key.
    """
    rows = [c for c in checks if c.kind != "unique"]
    reports = []
    if rows:
        counts = df.agg(*[F.count_if(violates(c)).alias(f"n{i}") for i, c in enumerate(rows)])
        lines = F.array(*[F.struct(F.lit(c.column).alias("column"), F.lit(c.kind).alias("check"),
                                   F.lit(c.severity).alias("severity"), F.col(f"n{i}").alias("failures"))
                          for i, c in enumerate(rows)])
        reports.append(counts.select(F.inline(lines)))
    for c in checks:
        if c.kind == "unique":
            reports.append(violations(df, c).agg(F.count("*").alias("failures")).select(
                F.lit(c.column).alias("column"), F.lit(c.kind).alias("check"),
                F.lit(c.severity).alias("severity"), "failures"))
    report = reduce(DataFrame.unionByName, reports)
    status = F.when(F.col("failures") == 0, "pass").otherwise(
        F.when(F.col("severity") == "error", "error").otherwise("warn"))
    return report.select(F.lit(table).alias("table"), "column", "check", "severity", "failures", status.alias("status"))


def run_suite(tables: dict[str, DataFrame]) -> DataFrame:
    """One report over all given tables that have checks."""
    return reduce(DataFrame.unionByName, [check_table(df, name, SUITES[name]) for name, df in tables.items()])


# --- fixed values: how old a mart may be, in minutes ---
FRESHNESS_MINUTES = {
    "daily_sales": 60, "product_performance": 240, "daily_funnel": 30, "product_engagement": 60,
    "customer_snapshot": 1440,
}


def freshness(df: DataFrame, table: str, ts: str, as_of: Column, max_minutes: int) -> DataFrame:
    """How far the newest row lags behind ``as_of``; an empty table is not fresh."""
    newest = df.agg(F.max(F.col(ts).cast("timestamp")).alias("newest"))
    lag = F.floor((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros("newest")) / 60_000_000)
    return newest.select(
        F.lit(table).alias("table"), lag.cast("bigint").alias("lag_minutes"),
        F.lit(max_minutes).cast("bigint").alias("max_minutes"),
        F.coalesce(lag <= max_minutes, F.lit(False)).alias("is_fresh"))


def content_hash(df: DataFrame) -> DataFrame:
    """(rows, hash) that do not depend on the row order: equal for two runs with equal content."""
    columns = sorted(df.columns)
    row = F.xxhash64(*[F.col(c) for c in columns]).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.sum(row).alias("hash"))
