"""Rows to set aside, personal data, event names, keys across sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.scalars import harmonised_event, mask_email, mask_phone, surrogate_key


def reject_reason(user: str = "user_id", price: str = "unit_price") -> Column:
    """Why a row cannot be used, NULL when it can."""
    return F.when(F.col(user).isNull(), "missing user_id").when(F.col(price) < 0, "negative price")


def quarantine(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows with the reason)."""
    marked = rows.withColumn("reject_reason", reason)
    return (marked.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            marked.filter(F.col("reject_reason").isNotNull()))


def mask_people(users: DataFrame, email: str = "email", phone: str = "phone") -> DataFrame:
    return users.withColumn(email, mask_email(F.col(email))).withColumn(phone, mask_phone(F.col(phone)))


def harmonise_events(events: DataFrame, column: str = "event_type") -> DataFrame:
    return events.withColumn(column, harmonised_event(F.col(column)))


def with_surrogate_key(rows: DataFrame, source: str, natural_key: str, out: str = "user_key") -> DataFrame:
    return rows.withColumn(out, surrogate_key(F.lit(source), F.col(natural_key)))
