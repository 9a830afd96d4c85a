"""Time the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators import changes, quality
from cartwheel.operators.catalogue import build_catalogue
from cartwheel.operators.rates import forward_fill
from cartwheel.operators.sessions import session_totals, sessionize
from cartwheel.plans import customers, funnel, reports, sales, staging
from cartwheel.session import build_session, materialise, scratch_dir
from cartwheel.sources import domain, files

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
AS_OF = date.fromisoformat(domain.ORDERS_AS_OF)
CATALOGUE_COPIES = 60


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(run) -> float:
    """Best of the runs after a first one that warms the JVM up."""
    run()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return min(times)


def catalogue_csv(spark: SparkSession) -> tuple[str, int]:
    """Behaviour history as CSV: the given events, each copied on several products, so that fixed costs do not dominate."""
    rows = domain.behaviour_rows(spark, FOLDER)
    copies = F.explode(F.sequence(F.lit(1), F.lit(CATALOGUE_COPIES))).alias("copy")
    out = scratch_dir(spark, "bench-csv")
    (rows.select(copies, "*").withColumn("product_id", F.concat("product_id", F.col("copy").cast("string"))).drop("copy")
     .repartition(int(CPUS)).write.option("header", True).csv(out))
    return out, rows.count() * CATALOGUE_COPIES


def headline(spark: SparkSession) -> dict:
    """Name → function building the plan, over silver tables written once beforehand."""
    silver = {name: materialise(build(spark, FOLDER), name) for name, build in {
        "orders": domain.orders, "products": domain.products, "users": domain.users, "rates": domain.rates,
        "raw_clicks": domain.raw_clicks, "clicks": domain.clicks, "feed": domain.change_feed,
        "behaviour": domain.behaviour_rows,
    }.items()}
    rates = silver["rates"]

    def orders():
        return staging.stage_orders(silver["orders"])

    def products():
        return staging.stage_products(silver["products"])

    def clicks():
        return staging.stage_clicks(silver["clicks"])

    def staged_rates():
        return staging.stage_rates(rates)

    def newest(part: int):
        keyed, _ = changes.split_keyless(changes.flatten(silver["feed"].filter(F.col("part") == part)), "id")
        return changes.latest_per_key(keyed, "id").drop("lsn")

    def daily_funnel():
        return funnel.daily_funnel(clicks(), orders())

    return {
        "m1_daily_sales": lambda: sales.daily_sales(orders(), products(), staged_rates(), rates_bound=rates),
        "m2_product_performance": lambda: sales.product_performance(orders(), products(), staged_rates(), rates_bound=rates),
        "m3_daily_funnel": daily_funnel,
        "m4_product_engagement": lambda: funnel.product_engagement(clicks(), products()),
        "m5_customer_snapshot": lambda: customers.customer_snapshot(
            staging.stage_users(silver["users"]), orders(), staged_rates(), AS_OF, rates_bound=rates),
        "m7_product_catalogue": lambda: build_catalogue(silver["behaviour"]),
        "x4_forward_fill": lambda: forward_fill(rates, ["base_currency", "target_currency"], "exchange_date",
                                                "exchange_rate", "filled"),
        "e6_sessionize": lambda: sessionize(silver["raw_clicks"]),
        "e6_session_totals": lambda: session_totals(silver["raw_clicks"]),
        "c6_latest_per_key": lambda: newest(0),
        "c7_merge_upsert": lambda: changes.merge_changes(changes.initial_rows(newest(0)), newest(1), "id"),
        "q5_source_checks": lambda: quality.run_suite({
            "orders": silver["orders"], "products": silver["products"], "users": silver["users"],
            "exchange_rates": rates, "clickstream": silver["clicks"]}),
        "v12_conversion_trend": lambda: reports.conversion_trend(daily_funnel()),
    }


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    plans = headline(spark)
    prepared = time.perf_counter() - start
    seconds = {name: round(best(lambda p=plan: consume(p())), 3) for name, plan in plans.items()}
    path, rows = catalogue_csv(spark)
    csv_seconds = best(lambda: consume(build_catalogue(files.behaviour_csv(spark, path))))
    seconds["catalogue_from_csv"] = round(csv_seconds, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")), "cpus": int(CPUS), "prepare_silver_seconds": round(prepared, 3),
        "catalogue_csv_rows": rows, "catalogue_csv_rows_per_sec": round(rows / csv_seconds),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
