"""How far back an incremental run of a mart reaches."""

from __future__ import annotations

from datetime import date, timedelta

# --- fixed values: days (or weeks) each mart recomputes, because orders change status late ---
DAYS_BACK = {"daily_sales": 3, "daily_funnel": 2, "product_engagement": 2}
WEEKS_BACK = {"product_performance": 2}


def recompute_since(mart: str, as_of: date) -> date:
    """First day an incremental run recomputes. Weekly marts start on a Monday."""
    if mart in WEEKS_BACK:
        monday = as_of - timedelta(days=as_of.weekday())
        return monday - timedelta(weeks=WEEKS_BACK[mart])
    return as_of - timedelta(days=DAYS_BACK[mart])
