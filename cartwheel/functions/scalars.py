"""Column → Column helpers. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: referrer substrings per channel, checked in this order ---
SEARCH_ENGINES = ("google", "bing", "yahoo")
SOCIAL_SITES = ("facebook", "instagram", "tiktok", "twitter", "youtube")
# --- fixed values: month abbreviations ---
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
# --- fixed values: event names of the historical source → names of the live one ---
EVENT_NAMES = {"view": "view_item", "cart": "add_to_cart", "purchase": "checkout"}


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 text (``Z`` or a numeric offset) → timestamp, NULL when it does not parse."""
    return F.try_to_timestamp(c)


def iso_date(c: Column) -> Column:
    return F.to_date(iso_timestamp(c))


def week_start(day: Column) -> Column:
    """Monday of the week, as a DATE."""
    return F.trunc(day, "week")


# Numbers are rounded as decimals of this type: doubles by the digits they print, decimals exactly.
ROUNDED = "decimal(38,10)"


def half_up(c: Column, digits: int = 2) -> Column:
    """Round, halves away from zero. NULL for what is no number or has over 28 digits before the point."""
    return F.round(c.try_cast(ROUNDED), digits).cast("double")


def cents(c: Column) -> Column:
    """Amount as whole cents, halves away from zero; an integer is the same whatever order the summands came in."""
    return (F.round(c.try_cast(ROUNDED), 2) * 100).try_cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` in double, NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def pct(numerator: Column, denominator: Column) -> Column:
    """Percentage with two decimals, NULL for a zero denominator."""
    return half_up(ratio(numerator, denominator) * 100)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (NULL counts as 0)."""
    return F.when(condition, 1).otherwise(0)


def usd(amount: Column, rate: Column) -> Column:
    """Amount in USD; without a rate the amount is taken as USD already."""
    return amount.cast("double") / F.coalesce(rate, F.lit(1.0))


def _mentions(c: Column, words: tuple[str, ...]) -> Column:
    return reduce(or_, [c.contains(word) for word in words])


def referrer_category(referrer: Column) -> Column:
    r = F.coalesce(referrer, F.lit(""))
    return (
        F.when(_mentions(r, SEARCH_ENGINES), "organic_search")
        .when(_mentions(r, SOCIAL_SITES), "social")
        .when(r == "email", "email")
        .when(r.isin("direct", ""), "direct")
        .otherwise("other")
    )


def rfm_segment(recency_days: Column, orders: Column, revenue: Column) -> Column:
    """RFM label; the first rule that holds wins, a rule over NULL does not hold."""
    # --- fixed values: label and its thresholds, in order of precedence ---
    rules = (
        ("Never Bought", F.coalesce(orders, F.lit(0)) == 0),
        ("Lost", recency_days > 180),
        ("At Risk", (recency_days > 60) & (revenue > 100)),
        ("Champions", (recency_days <= 30) & (orders >= 5) & (revenue >= 200)),
        ("Loyal", (recency_days <= 60) & (orders >= 3)),
        ("Promising", (recency_days <= 30) & (orders <= 2)),
    )
    return F.coalesce(*[F.when(rule, F.lit(label)) for label, rule in rules], F.lit("New"))


def category_placeholder(category_id: Column) -> Column:
    """Label of a category without a code. The published rule takes eight characters of the id, so ids that begin alike
    share a label; the id itself stays in its own column."""
    return F.concat(F.lit("category_"), F.substring(category_id, 1, 8))


def file_month(name: Column) -> Column:
    """``2019-Oct.csv`` / ``2019-9.csv`` → struct(year, month as two digits); NULL for any other name."""
    stem = F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"\.[^.]*$", "")
    year = F.nullif(F.regexp_extract(stem, r"^([^-]*)-([^-]+)$", 1), F.lit(""))
    raw = F.regexp_extract(stem, r"^([^-]*)-([^-]+)$", 2)
    pairs = [F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, f"{i:02d}")]
    by_name = F.try_element_at(F.create_map(*pairs), raw)
    # shorter numbers are padded to two digits, longer ones stay as they are
    by_number = F.when(raw.rlike(r"^\d+$"), F.when(F.length(raw) < 2, F.lpad(raw, 2, "0")).otherwise(raw))
    month = F.coalesce(by_name, by_number)
    known = year.isNotNull() & month.isNotNull()
    return F.when(known, F.struct(year.alias("year"), month.alias("month")))


def mask_email(email: Column) -> Column:
    """Whole hash of the address, domain kept: joins still work at any size, the person is not readable."""
    return F.concat(F.sha2(F.lower(email), 256), F.lit("@"), F.substring_index(email, "@", -1))


def mask_phone(phone: Column) -> Column:
    """All digits but the last three become ``*``."""
    return F.regexp_replace(phone, r"\d(?=(?:\D*\d){3})", "*")


def surrogate_key(source: Column, natural_key: Column) -> Column:
    """Stable key over (source, natural key); 256 bits, so no collisions at any table size."""
    return F.sha2(F.concat_ws(":", source, natural_key.cast("string")), 256)


def harmonised_event(event_type: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in EVENT_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, event_type), event_type)
