"""The jobs of the lakehouse, from Python or the command line.

    python -m cartwheel.jobs --lake /data/lake change-feed --table orders --primary-key id
    python -m cartwheel.jobs --lake /data/lake marts --as-of 2024-01-30

Folders below the lake: ``bronze/<source>`` as landed, ``silver/<table>``, ``gold/<mart>``, ``checkpoints/<job>``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.functions.scalars import iso_timestamp
from cartwheel.operators.catalogue import build_catalogue
from cartwheel.operators.distinct import daily_bitmaps, rolling_distinct
from cartwheel.operators.quality import FRESHNESS_MINUTES, SUITES, check_table, freshness, run_suite
from cartwheel.operators.rates import keep_currencies, monthly_closings, rate_rows
from cartwheel.plans import customers, funnel, sales, staging
from cartwheel.plans.windows import recompute_since
from cartwheel.session import build_session, materialise, pin
from cartwheel.sinks import files, intervals, runs, tables, upkeep
from cartwheel.sinks.batches import BATCH, fold_batches
from cartwheel.sources.files import BROKEN_LINE, audited, behaviour_csv, fx_documents, land_json, missing_ok, with_landing_parts
from cartwheel.streaming.changes import land_changes, run_change_feed
from cartwheel.streaming.clicks import broker_stream, land_clicks, refine_clicks

PRIMARY_KEYS = {"orders": "id", "products": "product_id", "users": "id"}
# the columns by which incremental runs read a keyed table
CLUSTER_COLUMNS = {"orders": ("created_at", "id")}
MART_DATES = {"daily_sales": "order_date", "product_performance": "week_start", "daily_funnel": "event_date",
              "product_engagement": "event_date", "customer_snapshot": "snapshot_date"}


def cluster_columns(table: str) -> list[Column]:
    """Those columns as numbers; ISO text as the time it says."""
    return [F.unix_micros(iso_timestamp(F.col(c))) if c.endswith("_at") else F.col(c) for c in CLUSTER_COLUMNS.get(table, ())]


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def silver(self, table: str) -> DataFrame:
        path = self.path("silver", table)
        if runs.is_runs(self.spark, path):
            return runs.read_runs(self.spark, path, PRIMARY_KEYS.get(table, "id"))
        return tables.read_keyed(self.spark, path).drop(BATCH)

    def gold(self, mart: str) -> DataFrame:
        return self.spark.read.parquet(self.path("gold", mart))


def merge_changes(lake: Lake, table: str, pk: str | None = None, buckets: int = 64) -> dict[int, int]:
    """Merge the change events of a table landed since the last run."""
    return run_change_feed(
        lake.spark, table, lake.path("bronze", "cdc", table), lake.path("silver", table),
        lake.path("checkpoints", f"cdc_{table}"), pk or PRIMARY_KEYS.get(table, "id"), buckets,
        rejects=lake.path("silver", "rejects", table))


def rebucket(lake: Lake, table: str, buckets: int, pk: str | None = None) -> str:
    """Write a keyed silver table anew with another number of buckets, beside the old one; returns the new path.

    Stop the change feed first, and put the new folder in the old one's place before it runs again.
    """
    path, pk = lake.path("silver", table), pk or PRIMARY_KEYS.get(table, "id")
    target = lake.path("silver", f"{table}_{buckets}_buckets")
    stored = runs.read_state(lake.spark, path, pk) if runs.is_runs(lake.spark, path) else lake.spark.read.parquet(path)
    runs.rebuild(stored, target, pk, buckets, cluster_columns(table))
    return target


def land_feed(lake: Lake, table: str, messages: DataFrame, every: str | None = "10 seconds") -> StreamingQuery:
    """Change messages of a table (a binary ``value``) → its landing folder."""
    return land_changes(messages, lake.path("bronze", "cdc", table), lake.path("checkpoints", f"land_{table}"), every)


def land_rates(lake: Lake, documents: DataFrame, at: datetime) -> None:
    """FX documents (base_code, rates as a map) → the landing folder of the day, stamped with their ingestion time."""
    when = F.lit(at)
    stamped = with_landing_parts(audited(keep_currencies(documents), when), when)
    land_json(stamped, lake.path("bronze", "exchange_rates"), per_file=1)


def load_rates(lake: Lake) -> bool:
    """All landed FX documents → silver rates; days that have documents are replaced. False if there is nothing.

    Documents that could not be parsed are listed anew by every run in ``silver/rejects/exchange_rates``.
    """
    documents = missing_ok(lambda: fx_documents(lake.spark, lake.path("bronze", "exchange_rates")))
    if documents is None or documents.isEmpty():
        return False
    if BROKEN_LINE in documents.columns:
        documents = materialise(documents, "rates")  # the reader does not give the broken text on its own
        broken = documents.filter(F.col(BROKEN_LINE).isNotNull())
        (broken.select(BROKEN_LINE, F.lit("malformed").alias("reject_reason"))
         .write.mode("overwrite").parquet(lake.path("silver", "rejects", "exchange_rates")))
        if not {"base_code", "rates"} <= set(documents.columns):
            return False
        documents = documents.filter(F.col(BROKEN_LINE).isNull()).drop(BROKEN_LINE)
    usable = documents.filter("base_code IS NOT NULL AND rates IS NOT NULL")
    loaded = materialise(rate_rows(usable), "rates")
    tables.overwrite_partitions(loaded, lake.path("silver", "exchange_rates"), ["exchange_date"])
    first = loaded.agg(F.min("exchange_date")).first()[0]
    if first:
        close_rates(lake, first)
    return True


def close_rates(lake: Lake, since: date) -> None:
    """Bring the monthly closings of the rates up to date from the month of ``since`` on; earlier months are not read."""
    path, rates = lake.path("silver", "exchange_rate_closings"), lake.silver("exchange_rates")
    start, before = since.replace(day=1), None
    if files.has_data(lake.spark, path):
        rates = rates.filter(F.col("exchange_date") >= F.lit(start))
        before = lake.silver("exchange_rate_closings").filter(F.col("month") == F.add_months(F.lit(start), -1))
    until = rates.agg(F.max("exchange_date")).first()[0] or since
    closings = monthly_closings(rates, staging.PAIR, "exchange_date", "exchange_rate", before, until)
    tables.overwrite_partitions(materialise(closings, "closings"), path, ["month"])


def staged_rates(lake: Lake, since: date | None) -> tuple[DataFrame, DataFrame]:
    """(rates filled forward, stored rows that bound them). With ``since`` only its month and one closing are read."""
    rates = lake.silver("exchange_rates")
    if since is None or not files.has_data(lake.spark, lake.path("silver", "exchange_rate_closings")):
        return staging.stage_rates(rates), rates
    recent = rates.filter(F.col("exchange_date") >= F.lit(since.replace(day=1)))
    return staging.stage_rates_since(rates, lake.silver("exchange_rate_closings"), since), recent


def land(lake: Lake, messages: DataFrame, every: str | None = "10 seconds") -> StreamingQuery:
    """Click messages → landed events; messages that cannot be used go to ``bronze/rejects/clickstream``."""
    return land_clicks(messages, lake.path("bronze", "clickstream"), lake.path("checkpoints", "land_clicks"), every,
                       lake.path("bronze", "rejects", "clickstream"))


def refine(lake: Lake) -> bool:
    """Landed click events → silver events, those not seen yet; unusable ones go to ``silver/rejects/clickstream``."""
    return refine_clicks(lake.spark, lake.path("bronze", "clickstream"), lake.path("silver", "clickstream"),
                         lake.path("checkpoints", "clickstream"), rejects=lake.path("silver", "rejects", "clickstream"))


def rejected(lake: Lake) -> DataFrame:
    """(table, reject_reason, rows) of everything that the jobs have set aside."""
    kept = {"landed clicks": lake.path("bronze", "rejects", "clickstream"), "clicks": lake.path("silver", "rejects", "clickstream"),
            **{t: lake.path("silver", "rejects", t) for t in (*PRIMARY_KEYS, "exchange_rates")}}
    parts = [lake.spark.read.schema("reject_reason STRING").parquet(path).select(F.lit(name).alias("table"), "reject_reason")
             for name, path in kept.items() if files.has_data(lake.spark, path)]
    empty = lake.spark.createDataFrame([], "`table` STRING, reject_reason STRING")
    return reduce(DataFrame.unionByName, parts, empty).groupBy("table", "reject_reason").agg(F.count("*").alias("rows"))


def seed_catalogue(lake: Lake, csv: str) -> None:
    """Historical CSV → product catalogue; products already there stay."""
    rows = behaviour_csv(lake.spark, csv, ["event_time", "product_id", "category_id", "category_code", "brand", "price"])
    tables.insert_absent(build_catalogue(rows), lake.path("silver", "catalogue"), "product_id")


def _mart_plans(lake: Lake, as_of: date) -> dict[str, Callable[[date | None], DataFrame]]:
    products = staging.stage_products(lake.silver("products"))

    def orders(since: date | None = None) -> DataFrame:
        return staging.stage_orders(lake.silver("orders"), since)

    def with_rates(since: date | None) -> tuple[DataFrame, date | None, DataFrame]:
        filled, bound = staged_rates(lake, since)
        return filled, since, bound

    return {
        "daily_sales": lambda since: sales.daily_sales(orders(since), products, *with_rates(since)),
        "product_performance": lambda since: sales.product_performance(orders(since), products, *with_rates(since)),
        # the funnel looks one day further back for sessions crossing into the window; staging leaves that day in
        "daily_funnel": lambda since: funnel.daily_funnel(
            staging.stage_clicks(lake.silver("clickstream"), since), orders(), since),
        "product_engagement": lambda since: funnel.product_engagement(
            staging.stage_clicks(lake.silver("clickstream"), since), products, since),
        "customer_snapshot": lambda since: customers.seen_on(_customers(lake, as_of), F.lit(as_of)),
    }


def _customers(lake: Lake, as_of: date) -> DataFrame:
    filled, bound = staged_rates(lake, None)
    return customers.customer_attributes(staging.stage_users(lake.silver("users")), staging.stage_orders(lake.silver("orders")),
                                         filled, as_of, bound)


def record_customers(lake: Lake, as_of: date) -> bool:
    """Store what has changed of the customers since the day before; what is written follows the changes."""
    return intervals.append_state(materialise(_customers(lake, as_of), "customers"), lake.path("gold", "customer_states"), "user_id", as_of)


def customers_on(lake: Lake, first: date, last: date) -> DataFrame:
    """The customer snapshots of any days, rebuilt from the stored changes."""
    states = intervals.on_days(lake.spark, lake.path("gold", "customer_states"), "user_id", first, last)
    return customers.seen_on(states, F.col("day"))


def count_users(lake: Lake, since: date | None) -> None:
    """The distinct users of every day and device as bitmaps, from ``since`` on; other days are not read."""
    events = staging.stage_clicks(lake.silver("clickstream"), since)
    if since is not None:
        events = events.filter(F.col("event_date") >= F.lit(since))
    tables.refresh_window(daily_bitmaps(events, "event_date", ["device"], "user_id"), lake.path("gold", "user_bitmaps"), "event_date", since)


def active_users(lake: Lake, days: int) -> DataFrame:
    """Distinct users per day and device over the last ``days`` days, without reading events."""
    return rolling_distinct(lake.spark.read.parquet(lake.path("gold", "user_bitmaps")), "event_date", ["device"], days, "users")


def refresh_mart(lake: Lake, mart: str, as_of: date, full: bool = False) -> DataFrame:
    """Recompute one mart (its window only, unless ``full`` or new) and return the report of its checks."""
    build = _mart_plans(lake, as_of)[mart]
    path, column = lake.path("gold", mart), MART_DATES[mart]
    if mart == "customer_snapshot":
        df = build(None)
        tables.append_snapshot(df, path, column, as_of)
    else:
        since = None if full or not files.has_data(lake.spark, path) else recompute_since(mart, as_of)
        df = build(since)
        tables.refresh_window(df, path, column, since)
    # with its schema even an empty mart can be read
    return check_table(lake.spark.read.schema(df.schema).parquet(path), mart, SUITES[mart])


def refresh_marts(lake: Lake, as_of: date, full: bool = False) -> DataFrame:
    """All marts; one report over the checks of all silver and gold tables."""
    silver = run_suite({name: lake.silver(name) for name in SUITES if name not in MART_DATES})
    bitmaps = lake.path("gold", "user_bitmaps")
    count_users(lake, None if full or not files.has_data(lake.spark, bitmaps) else recompute_since("daily_funnel", as_of))
    record_customers(lake, as_of)
    return reduce(DataFrame.unionByName, [silver, *[refresh_mart(lake, mart, as_of, full) for mart in MART_DATES]])


def mart_freshness(lake: Lake, at: datetime) -> DataFrame:
    """How far the newest day of each mart lags behind ``at``, and whether that is within its limit.

    A day's rows count as written at its end, a week's at the end of the week: an open day is never late.
    """
    def one(mart: str) -> DataFrame:
        column = MART_DATES[mart]
        days = 7 if column == "week_start" else 1
        dated = lake.gold(mart).select(F.date_add(column, days).cast("timestamp").alias("until"))
        return freshness(dated, mart, "until", F.lit(at), FRESHNESS_MINUTES[mart])

    return reduce(DataFrame.unionByName, [one(mart) for mart in MART_DATES])


def maintain(lake: Lake, as_of: date) -> DataFrame:
    """Fold the silver events and the changes of the keyed tables, compact the partitioned marts, expire old landed files, report file statistics."""
    clicks = lake.path("silver", "clickstream")
    if files.has_data(lake.spark, clicks):
        fold_batches(lake.spark, clicks, ["event_date"])
    for table, pk in PRIMARY_KEYS.items():
        if runs.is_runs(lake.spark, lake.path("silver", table)):
            runs.fold_runs(lake.spark, lake.path("silver", table), pk, cluster_columns(table))
    for mart, column in MART_DATES.items():
        if files.has_data(lake.spark, lake.path("gold", mart)):
            upkeep.compact(lake.spark, lake.path("gold", mart), [column])
    if files.exists(lake.spark, lake.path("bronze")):
        upkeep.apply_retention(lake.spark, lake.path("bronze"), as_of, {
            "clickstream/": 7, "cdc/": 7, "exchange_rates/": 30})
    return upkeep.table_stats(lake.spark, {m: lake.path("gold", m) for m in MART_DATES
                                           if files.has_data(lake.spark, lake.path("gold", m))})


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Lakehouse jobs")
    parser.add_argument("--lake", required=True, help="root folder of the lake")
    jobs = parser.add_subparsers(dest="job", required=True)
    feed = jobs.add_parser("change-feed")
    feed.add_argument("--table", required=True)
    feed.add_argument("--primary-key")
    feed.add_argument("--buckets", type=int, default=64)
    for name in ("land-clicks", "land-changes"):
        stream = jobs.add_parser(name)
        stream.add_argument("--servers", required=True)
        stream.add_argument("--topic", required=True)
        if name == "land-changes":
            stream.add_argument("--table", required=True)
    documents = jobs.add_parser("land-rates")
    documents.add_argument("--documents", required=True, help="folder of FX documents as fetched, one JSON object a file")
    rebuilt = jobs.add_parser("rebucket")
    rebuilt.add_argument("--table", required=True)
    rebuilt.add_argument("--buckets", type=int, required=True)
    jobs.add_parser("refine-clicks")
    jobs.add_parser("rejects")
    jobs.add_parser("rates")
    catalogue = jobs.add_parser("catalogue")
    catalogue.add_argument("--csv", required=True)
    for name in ("marts", "maintain"):
        dated = jobs.add_parser(name)
        dated.add_argument("--as-of", type=date.fromisoformat, default=date.today())
        if name == "marts":
            dated.add_argument("--full", action="store_true")
    args = parser.parse_args(argv)

    lake = Lake(pin(build_session(args.job)), args.lake)
    if args.job == "change-feed":
        merge_changes(lake, args.table, args.primary_key, args.buckets)
    elif args.job == "land-clicks":
        land(lake, broker_stream(lake.spark, args.servers, args.topic)).awaitTermination()
    elif args.job == "land-changes":
        land_feed(lake, args.table, broker_stream(lake.spark, args.servers, args.topic)).awaitTermination()
    elif args.job == "land-rates":
        land_rates(lake, fx_documents(lake.spark, args.documents, "*.json"), datetime.now(timezone.utc))
    elif args.job == "rebucket":
        print(rebucket(lake, args.table, args.buckets))
    elif args.job == "refine-clicks":
        refine(lake)
    elif args.job == "rejects":
        rejected(lake).show(100, truncate=False)
    elif args.job == "rates":
        load_rates(lake)
    elif args.job == "catalogue":
        seed_catalogue(lake, args.csv)
    elif args.job == "marts":
        refresh_marts(lake, args.as_of, args.full).show(100, truncate=False)
        mart_freshness(lake, datetime.combine(args.as_of, datetime.min.time(), timezone.utc)).show(truncate=False)
    else:
        maintain(lake, args.as_of).show(truncate=False)


if __name__ == "__main__":
    main()
