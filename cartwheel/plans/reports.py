"""Reports on the marts: dashboards' charts, tables and alerts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.functions.scalars import cents, half_up, pct, ratio, week_start
from cartwheel.operators.ranking import exact_median
from cartwheel.session import materialise

CANCELLATION_ALERT_PCT = 10
BOUNCE_ALERT_PCT = 40
LOST_VIP_SEGMENTS = ("At Risk", "Lost")


# --- sales ----------------------------------------------------------------------------------


def daily_kpis(sales: DataFrame, funnel: DataFrame) -> DataFrame:
    """Revenue, orders, order value and conversion per day; a day may have sales, clicks or both."""
    orders = sales.groupBy(F.col("order_date").alias("day")).agg(
        F.sum("total_revenue_usd").alias("gmv"), F.sum("order_count").alias("orders"))
    visits = funnel.groupBy(F.col("event_date").alias("day")).agg(
        F.sum("users_truly_completed").alias("buyers"), F.sum("users_viewed_product").alias("viewers"))
    both = orders.unionByName(visits, allowMissingColumns=True).groupBy("day").agg(
        *[F.sum(c).alias(c) for c in ("gmv", "orders", "buyers", "viewers")])
    return both.select(
        "day", F.coalesce("gmv", F.lit(0.0)).alias("gmv_usd"), F.coalesce("orders", F.lit(0)).alias("orders"),
        ratio(F.col("gmv"), F.col("orders")).alias("avg_order_value_usd"),
        pct(F.col("buyers"), F.col("viewers")).alias("conversion_pct"))


def revenue_and_orders(sales: DataFrame) -> DataFrame:
    return sales.groupBy("order_date").agg(
        F.sum("total_revenue_usd").alias("revenue_usd"), F.sum("order_count").alias("orders"))


def revenue_share(sales: DataFrame) -> DataFrame:
    """Revenue per category × brand and its share of everything sold."""
    everything = sales.agg(F.sum("total_revenue_usd")).scalar()
    return (
        sales.groupBy("category", "brand").agg(F.sum("total_revenue_usd").alias("revenue_usd"))
        .withColumn("share_pct", pct(F.col("revenue_usd"), everything))
    )


def cancellation_by_category(sales: DataFrame) -> DataFrame:
    """Rate over the summed counts; a mean of the daily rates would weigh small days too high."""
    sums = sales.groupBy("category").agg(
        F.sum("cancelled_count").alias("cancelled"), F.sum("order_count").alias("completed"))
    rate = pct(F.col("cancelled"), F.col("cancelled") + F.col("completed"))
    return sums.withColumn("cancellation_rate_pct", rate).withColumn(
        "is_alert", F.col("cancellation_rate_pct") > CANCELLATION_ALERT_PCT)


def cancellation_alerts(sales: DataFrame) -> DataFrame:
    return sales.filter(F.col("cancellation_rate_pct") > CANCELLATION_ALERT_PCT)


def expected_gmv(sales: DataFrame) -> DataFrame:
    """Revenue of the day if all pending orders complete."""
    return sales.groupBy("order_date").agg(
        (F.sum("total_revenue_usd") + F.sum("pending_revenue_usd")).alias("expected_gmv_usd"))


def weekly_leaderboard(performance: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` products of every week. The rank is stored in the mart, so this is a filter plus a tie-break."""
    order = Window.partitionBy("week_start").orderBy("revenue_rank_in_week", "product_id")
    return (
        performance.filter(F.col("revenue_rank_in_week") <= top)
        .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)
    )


# --- customers ------------------------------------------------------------------------------


def segments_by_week(snapshots: DataFrame, as_of: date, weeks: int = 12) -> DataFrame:
    """Customers per segment on the last snapshot of each week."""
    recent = snapshots.filter(F.col("snapshot_date") > F.lit(as_of - timedelta(weeks=weeks)))
    week = week_start(F.col("snapshot_date")).alias("week_start")
    counts = recent.groupBy(week, "snapshot_date", "customer_segment").agg(F.count("*").alias("customers"))
    # the counts are days × segments: small whatever the number of customers
    newest = F.max("snapshot_date").over(Window.partitionBy("week_start"))
    return counts.withColumn("_newest", newest).filter(F.col("snapshot_date") == F.col("_newest")).select(
        "week_start", "customer_segment", "customers")


def vip_counts(snapshot: DataFrame) -> DataFrame:
    lost = F.col("customer_segment").isin(*LOST_VIP_SEGMENTS)
    return snapshot.groupBy("snapshot_date").agg(
        F.count_if("is_high_value").alias("vips"), F.count_if(F.col("is_high_value") & lost).alias("vips_at_risk"))


def vip_action_list(snapshot: DataFrame, top: int = 100) -> DataFrame:
    """The VIPs to win back, biggest spenders first."""
    lost = snapshot.filter(F.col("is_high_value") & F.col("customer_segment").isin(*LOST_VIP_SEGMENTS))
    return lost.orderBy(F.col("total_revenue_usd").desc(), "user_id").limit(top).select(
        "user_id", "customer_segment", "total_revenue_usd", "total_orders", "days_since_last_order")


def revenue_histogram(snapshot: DataFrame, width: float) -> DataFrame:
    """Customers per segment and revenue bucket of the given width; ``from_usd`` is the lower edge."""
    bucket = F.floor(F.col("total_revenue_usd") / width)
    return snapshot.groupBy("customer_segment", bucket.alias("bucket")).agg(F.count("*").alias("customers")).withColumn(
        "from_usd", F.col("bucket") * F.lit(width))


def segment_transitions(snapshots: DataFrame) -> DataFrame:
    """Customers per pair of segments on consecutive snapshots. A customer has one row per snapshot date."""
    by_day = Window.partitionBy("user_id").orderBy("snapshot_date")
    moves = snapshots.select("snapshot_date", "user_id", "customer_segment").withColumn(
        "from_segment", F.lag("customer_segment").over(by_day))
    return (
        moves.filter(F.col("from_segment").isNotNull())
        .groupBy("snapshot_date", "from_segment", F.col("customer_segment").alias("to_segment"))
        .agg(F.count("*").alias("customers"))
    )


def cohort_growth(snapshots: DataFrame) -> DataFrame:
    """Revenue per registration month and snapshot, and its growth since the snapshot before."""
    cohorts = snapshots.groupBy(F.trunc("registration_date", "month").alias("cohort_month"), "snapshot_date").agg(
        F.count("*").alias("customers"), F.sum("total_revenue_usd").alias("revenue_usd"))
    before = F.lag("revenue_usd").over(Window.partitionBy("cohort_month").orderBy("snapshot_date"))
    return cohorts.withColumn("growth_pct", pct(F.col("revenue_usd") - before, before))


# --- clicks ---------------------------------------------------------------------------------

FUNNEL_STEPS = {
    "users_viewed_product": "1 view", "users_added_to_cart": "2 cart", "users_initiated_checkout": "3 checkout",
    "users_confirmed_checkout": "4 confirm", "users_truly_completed": "5 completed",
}


def funnel_steps(funnel: DataFrame) -> DataFrame:
    """Users per funnel step, one row per step."""
    totals = funnel.agg(*[F.sum(c).alias(step) for c, step in FUNNEL_STEPS.items()])
    return totals.unpivot([], list(FUNNEL_STEPS.values()), "step", "users")


def conversion_trend(funnel: DataFrame, days: int = 7) -> DataFrame:
    """Purchase rate per channel and day, and its mean over the last ``days`` rows (one row per channel and day)."""
    daily = funnel.groupBy("referrer_category", "event_date").agg(
        F.sum("users_truly_completed").alias("buyers"), F.sum("users_viewed_product").alias("viewers"))
    daily = daily.select("referrer_category", "event_date",
                         pct(F.col("buyers"), F.col("viewers")).alias("true_purchase_rate"))
    last_days = Window.partitionBy("referrer_category").orderBy("event_date").rowsBetween(-(days - 1), 0)
    return daily.withColumn("rolling_rate", half_up(F.avg("true_purchase_rate").over(last_days), 4))


def engagement_by_device(funnel: DataFrame) -> DataFrame:
    """Bounce rate and engagement per device, weighted by sessions."""
    weight = F.col("total_sessions")

    def mean(c: str):
        known = F.when(F.col(c).isNotNull(), weight)
        return half_up(ratio(F.sum(F.col(c) * weight), F.sum(known)))

    return funnel.groupBy("device").agg(
        F.sum(weight).alias("sessions"), mean("bounce_rate_pct").alias("bounce_rate_pct"),
        mean("avg_session_duration_sec").alias("avg_session_duration_sec"),
        mean("avg_scroll_depth_pct").alias("avg_scroll_depth_pct"),
    ).withColumn("is_alert", F.col("bounce_rate_pct") > BOUNCE_ALERT_PCT)


def bounce_alerts(funnel: DataFrame) -> DataFrame:
    return funnel.filter(F.col("bounce_rate_pct") > BOUNCE_ALERT_PCT)


def _engagement(engagement: DataFrame, *keys) -> DataFrame:
    """View-weighted time and depth and the view→cart rate over the summed users."""
    views = F.col("view_sessions")

    def mean(c: str):
        return half_up(ratio(F.sum(F.col(c) * views), F.sum(F.when(F.col(c).isNotNull(), views))))

    return engagement.groupBy(*keys).agg(
        F.sum(views).alias("view_sessions"),
        mean("avg_view_duration_sec").alias("duration"), mean("avg_scroll_depth_pct").alias("scroll"),
        pct(F.sum("users_added_to_cart"), F.sum("unique_viewers")).alias("rate"))


def engagement_pivot(engagement: DataFrame, weeks: list[date]) -> DataFrame:
    """Product × week matrix. The weeks are given, so the columns are fixed and no job is needed to find them."""
    weekly = _engagement(engagement, "product_id", week_start(F.col("event_date")).alias("week_start"))
    label = F.date_format("week_start", "'w'yyyyMMdd")
    return (
        weekly.withColumn("week", label).groupBy("product_id").pivot("week", [f"w{w:%Y%m%d}" for w in weeks])
        .agg(F.max("duration").alias("duration"), F.max("scroll").alias("scroll"), F.max("rate").alias("rate"))
    )


def product_quadrants(engagement: DataFrame) -> DataFrame:
    """Products by view time and view→cart rate, each against the median of its category."""
    category = F.coalesce("category", F.lit("Unknown"))
    products = _engagement(engagement, "product_id", category.alias("category")).filter(
        F.col("duration").isNotNull() & F.col("rate").isNotNull())
    exact = materialise(products.withColumn("_d", cents(F.col("duration"))).withColumn("_r", cents(F.col("rate"))),
                        "quadrants")
    medians = exact_median(exact, ["category"], "_d", "_md").join(
        exact_median(exact, ["category"], "_r", "_mr"), "category")
    attentive, converting = F.col("_d") >= F.col("_md"), F.col("_r") >= F.col("_mr")
    return exact.join(medians, "category").select(
        "product_id", "category", "view_sessions", F.col("duration").alias("avg_view_duration_sec"),
        F.col("rate").alias("view_to_cart_rate"),
        F.when(attentive & converting, "star").when(attentive, "leaking traffic")
        .when(converting, "hidden gem").otherwise("ignore").alias("quadrant"))


def popular_queries(events: DataFrame, top: int = 20) -> DataFrame:
    """Most frequent search texts; equal counts in alphabetical order."""
    searches = events.filter((F.col("event_type") == "search") & F.col("search_query").isNotNull())
    return (
        searches.groupBy("search_query").agg(F.count("*").alias("searches"), F.countDistinct("user_id").alias("users"))
        .orderBy(F.col("searches").desc(), "search_query").limit(top)
    )
