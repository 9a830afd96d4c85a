"""Click marts: the daily funnel and daily product engagement.

Distinct users and sessions are counted by grouping to user (session) grain first and summing
flags, so each event is shuffled at most once per grain instead of once per distinct count, and a
hot user, session or product is combined on the map side.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.functions.scalars import flag, half_up, pct, ratio
from cartwheel.operators.joins import value_ranges, within

FUNNEL_KEYS = ["event_date", "device", "referrer_category"]


def _seen(condition: Column) -> Column:
    return F.max(flag(condition & F.col("user_id").isNotNull()))


def completed_buyers(events: DataFrame, orders: DataFrame, prune: bool = False) -> DataFrame:
    """(date, user) with a confirmation whose order really was completed; each pair once, so joins do not multiply rows.

    Of the orders only the ids of the completed ones are read, and with ``prune`` only where the confirmed ids lie: the
    ranges they fall into reach the scan, which skips the row groups outside (an order confirmed in a short window has an
    id near its end). Spark's own runtime filter then drops other ids of those row groups before the shuffle. No order is
    lost by either, however old it is. Sizes are left to adaptive execution, which broadcasts the smaller side if it may.
    """
    confirmations = events.filter((F.col("step") == "confirmation") & F.col("real_order_id").isNotNull())
    if prune:
        orders = orders.filter(within("order_id", value_ranges(confirmations, "real_order_id")))
    done = orders.filter(F.col("status") == "COMPLETED").select(F.col("order_id").alias("real_order_id"))
    return confirmations.join(done, "real_order_id", "left_semi").select("event_date", "user_id").distinct()


def session_sizes(events: DataFrame) -> DataFrame:
    return events.groupBy("session_id").agg(F.count("*").alias("event_count"))


def _user_grain(events: DataFrame, orders: DataFrame, prune: bool) -> DataFrame:
    kind = F.col("event_type")
    users = events.groupBy(*FUNNEL_KEYS, "user_id").agg(
        _seen(kind == "view_item").alias("viewed"), _seen(kind == "add_to_cart").alias("carted"),
        _seen(kind == "checkout").alias("checkout"), _seen(F.col("step") == "confirmation").alias("confirmed"),
        F.sum("duration_ms").alias("ms"), F.count("duration_ms").alias("timed"),
        F.sum("scroll_depth_pct").alias("scroll"), F.count("scroll_depth_pct").alias("scrolled"),
    )
    buyers = completed_buyers(events, orders, prune).withColumn("completed", F.lit(1))
    return users.join(buyers, ["event_date", "user_id"], "left").select(
        *FUNNEL_KEYS, "viewed", "carted", "checkout", "confirmed",
        F.coalesce("completed", F.lit(0)).alias("completed"), "ms", "timed", "scroll", "scrolled",
        F.lit(0).alias("session"), F.lit(0).alias("bounced"))


def _session_grain(events: DataFrame) -> DataFrame:
    """One row per session and group. The window sees a session's groups (days × devices × channels), not its events."""
    visits = events.filter(F.col("session_id").isNotNull()).groupBy("session_id", *FUNNEL_KEYS).agg(
        F.count("*").alias("n"))
    size = F.sum("n").over(Window.partitionBy("session_id"))
    return visits.withColumn("size", size).select(
        *FUNNEL_KEYS, F.lit(1).alias("session"), flag(F.col("size") == 1).alias("bounced"))


def daily_funnel(events: DataFrame, orders: DataFrame, since: date | None = None) -> DataFrame:
    """Per date × device × referrer category: sessions, users per step, conversion rates, engagement, bounces.

    An incremental run reads one day more, so that a session crossing midnight keeps its true size.
    """
    in_window = events if since is None else events.filter(F.col("event_date") >= F.lit(since))
    with_edge = events if since is None else events.filter(F.col("event_date") >= F.lit(since - timedelta(days=1)))
    sessions = _session_grain(with_edge)
    if since is not None:
        sessions = sessions.filter(F.col("event_date") >= F.lit(since))

    sums = ["viewed", "carted", "checkout", "confirmed", "completed", "ms", "timed", "scroll", "scrolled",
            "session", "bounced"]
    groups = (
        _user_grain(in_window, orders, since is not None)
        .unionByName(sessions, allowMissingColumns=True)
        .groupBy(*FUNNEL_KEYS)
        .agg(*[F.sum(c).alias(c) for c in sums])
    )
    c = {name: F.col(name) for name in sums}
    return groups.select(
        *FUNNEL_KEYS,
        c["session"].alias("total_sessions"),
        c["viewed"].alias("users_viewed_product"),
        c["carted"].alias("users_added_to_cart"),
        c["checkout"].alias("users_initiated_checkout"),
        c["confirmed"].alias("users_confirmed_checkout"),
        c["completed"].alias("users_truly_completed"),
        pct(c["carted"], c["viewed"]).alias("view_to_cart_rate"),
        pct(c["checkout"], c["carted"]).alias("cart_to_checkout_rate"),
        pct(c["completed"], c["viewed"]).alias("true_purchase_rate"),
        half_up(ratio(c["ms"], c["timed"] * 1000)).alias("avg_session_duration_sec"),
        half_up(ratio(c["scroll"], c["scrolled"])).alias("avg_scroll_depth_pct"),
        pct(c["bounced"], c["session"]).alias("bounce_rate_pct"),
    )


def product_engagement(events: DataFrame, products: DataFrame, since: date | None = None) -> DataFrame:
    """Per date × item: views, carts, view→cart rate, view time and depth. Products join the finished groups."""
    keys = ["event_date", "item_id"]
    on_item = events.filter(F.col("item_id").isNotNull())
    if since is not None:
        on_item = on_item.filter(F.col("event_date") >= F.lit(since))
    kind = F.col("event_type")
    view = kind == "view_item"
    ms, scroll = F.when(view, F.col("duration_ms")), F.when(view, F.col("scroll_depth_pct"))
    users = on_item.groupBy(*keys, "user_id").agg(
        _seen(view).alias("viewers"), _seen(kind == "add_to_cart").alias("carters"),
        F.sum(ms).alias("ms"), F.count(ms).alias("timed"),
        F.sum(scroll).alias("scroll"), F.count(scroll).alias("scrolled"),
        F.count_if(kind == "search").alias("searches"),
    ).drop("user_id")
    sessions = (
        on_item.filter(view & F.col("session_id").isNotNull())
        .select(*keys, "session_id").distinct()
        .select(*keys, F.lit(1).alias("sessions"))
    )
    sums = ["viewers", "carters", "ms", "timed", "scroll", "scrolled", "searches", "sessions"]
    groups = users.unionByName(sessions, allowMissingColumns=True).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums])
    named = products.select(F.col("product_id").cast("string").alias("item_id"), "product_name", "category", "brand")
    c = {name: F.col(name) for name in sums}
    return groups.join(named, "item_id", "left").select(
        "event_date", F.col("item_id").alias("product_id"), "product_name", "category", "brand",
        F.coalesce(c["sessions"], F.lit(0).cast("bigint")).alias("view_sessions"),
        c["viewers"].alias("unique_viewers"),
        c["carters"].alias("users_added_to_cart"),
        pct(c["carters"], c["viewers"]).alias("view_to_cart_rate"),
        half_up(ratio(c["ms"], c["timed"] * 1000)).alias("avg_view_duration_sec"),
        half_up(ratio(c["scroll"], c["scrolled"])).alias("avg_scroll_depth_pct"),
        c["searches"].alias("search_impressions"),
    )
