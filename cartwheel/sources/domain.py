"""The given star-schema tables seen as commerce tables (silver shape).

Each function takes (spark, folder) and returns a lazy DataFrame over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.sessions import sessionize

ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-30"

CURRENCIES = ("USD", "VND", "SGD", "EUR", "JPY")
BASE_RATES = {"USD": 1.0, "VND": 25000.0, "SGD": 1.35, "EUR": 0.92, "JPY": 150.0}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(c: Column, cases: dict, default=None) -> Column:
    out = None
    for key, value in cases.items():
        value = F.lit(value)
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return out.otherwise(F.lit(default))


def _iso(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    items = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.min("l_partkey").alias("part"), F.sum("l_quantity").cast("bigint").alias("qty"))
    )
    head = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "id")
    quantity = F.coalesce("qty", F.lit(1).cast("bigint"))
    return head.join(items, "id", "left").select(
        "id",
        F.col("o_custkey").alias("user_id"),
        F.coalesce("part", F.lit(0)).cast("string").alias("product_id"),
        quantity.alias("quantity"),
        F.floor(F.col("o_totalprice") / quantity).cast("decimal(18,2)").alias("unit_price"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_amount"),
        _pick(F.col("o_custkey") % 5, dict(enumerate(CURRENCIES))).alias("currency"),
        _pick(F.col("o_orderpriority"), {"1-URGENT": "credit_card", "2-HIGH": "bank_transfer", "3-MEDIUM": "momo",
                                         "4-NOT SPECIFIED": "vnpay"}, "paypal").alias("payment_method"),
        _pick(F.col("o_orderstatus"), {"F": "COMPLETED", "O": "PENDING"}, "CANCELLED").alias("status"),
        _iso(F.col("o_orderdate")).alias("created_at"),
        _iso(F.col("o_orderdate") + F.expr("interval 1 hour")).alias("updated_at"),
        (F.col("id") % 14 == 0).alias("is_deleted"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        key.cast("string").alias("product_id"),
        F.when(key % 7 != 0, F.col("p_type")).alias("category_code"),
        F.when(key % 11 != 0, F.col("p_brand")).alias("brand"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("avg_price"),
        F.lit("2019-10-01T00:00:00+07:00").alias("created_at"),
        F.lit(False).alias("is_deleted"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    key = F.col("c_custkey")
    registered = F.date_add(F.lit("1995-01-01").cast("date"), (key % 365).cast("int"))
    return (
        table(spark, folder, "customer")
        .join(nation, "c_nationkey")
        .join(region, "n_regionkey")
        .select(
            key.alias("id"),
            F.col("c_name").alias("name"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
            F.concat(F.lit("+84 "), F.lpad(key.cast("string"), 9, "0")).alias("phone"),
            F.when(key % 10 != 0, F.col("n_name")).alias("city"),
            F.col("r_name").alias("country"),
            _iso(registered).alias("created_at"),
            _iso(registered).alias("updated_at"),
            F.lit(False).alias("is_deleted"),
        )
    )


def rates(spark: SparkSession, folder: str) -> DataFrame:
    """Daily USD rates over the order dates: NULL on days 9/18/27, absent on day 28."""
    day = F.dayofmonth("exchange_date")
    quotes = F.explode(F.array(*[
        F.struct(F.lit(cur).alias("cur"), F.lit(base).alias("base")) for cur, base in BASE_RATES.items()
    ]))
    return (
        table(spark, folder, "orders")
        .select(F.col("o_orderdate").cast("date").alias("exchange_date"))
        .distinct()
        .filter(day != 28)
        .select("exchange_date", quotes.alias("q"))
        .select(
            "exchange_date",
            F.lit("USD").alias("base_currency"),
            F.col("q.cur").alias("target_currency"),
            F.when((F.col("q.cur") == "USD") | (day % 9 != 0),
                   F.col("q.base") * (1 + day / F.lit(1000.0))).alias("exchange_rate"),
        )
    )


def raw_clicks(spark: SparkSession, folder: str) -> DataFrame:
    """Events without a session id."""
    eid, kind = F.col("event_id"), F.col("event_type")
    purchase = kind == "purchase"
    timed = kind.isin("view", "error")
    return table(spark, folder, "events").select(
        eid.cast("string").alias("event_id"),
        "user_id",
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        _pick(kind, {"view": "view_item", "click": "add_to_cart", "purchase": "checkout", "signup": "search"},
              "scroll").alias("event_type"),
        _pick(eid % 3, {0: "mobile", 1: "desktop"}, "tablet").alias("device"),
        _pick(eid % 10, {0: "google.com", 1: "bing.com", 2: "facebook.com", 3: "tiktok.com", 4: "email",
                         5: "direct", 6: None, 7: "", 8: "partner.example"}, "www.youtube.com").alias("referrer"),
        F.when(kind.isin("view", "click", "purchase"), (eid % part_count(spark, folder)).cast("string")).alias("item_id"),
        F.when(timed, F.floor(F.col("value") * 1000).cast("int")).alias("duration_ms"),
        F.when(timed, F.get_json_object("props", "$.k").cast("int")).alias("scroll_depth_pct"),
        F.when(kind == "signup", F.concat(F.lit("query "), (eid % 25).cast("string"))).alias("search_query"),
        F.when(kind == "signup", (eid % 40).cast("int")).alias("result_count"),
        F.lit(None).cast("string").alias("click_target"),
        F.when(kind == "click", (1 + eid % 3).cast("int")).alias("quantity"),
        F.when(purchase, F.col("value").cast("float")).alias("cart_total"),
        F.when(purchase, _pick(eid % 4, {0: "confirmation", 1: "payment"}, "shipping")).alias("step"),
        F.when(purchase & (eid % 4 == 0), eid).alias("real_order_id"),
        F.col("value").cast("float").alias("purchase_amount"),
    )


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    return sessionize(raw_clicks(spark, folder))


def change_feed(spark: SparkSession, folder: str, stored: DataFrame | None = None) -> DataFrame:
    """Order change events: creations, status updates, deletes, revivals, duplicates, lost keys.

    ``part`` numbers the landing file the event arrives in; late events are in part 1. ``stored``: the orders, if they have been
    written already.
    """
    row = (orders(spark, folder) if stored is None else stored).drop("is_deleted").withColumn("amount", F.col("total_amount"))
    key = F.col("id")
    image = F.struct(*[F.col(c) for c in row.columns])

    def event(part, op, offset, before, after):
        return F.struct(
            F.lit(part).alias("part"), F.lit(op).alias("op"), before.alias("before"), after.alias("after"),
            (key * 10 + offset).alias("ts_ms"), (key * 100 + offset * 10 + part).alias("lsn"))

    none = F.lit(None).cast(row.select(image.alias("s")).schema["s"].dataType)
    pending = image.withField("status", F.lit("PENDING"))
    keyless = image.withField("id", F.lit(None).cast("bigint"))
    extra = image.withField("quantity", F.col("quantity") + 1)
    events = F.array(
        event(0, "c", 1, none, F.when(key % 3 == 0, pending).otherwise(image)),
        F.when(key % 3 == 0, event(1, "u", 2, pending, image)),
        F.when(key % 33 == 0, event(0, "u", 2, pending, extra)),       # same ts_ms as the update, lower lsn
        F.when((key % 14 == 0) & (key % 42 != 0), event(0, "d", 3, image, none)),
        F.when(key % 42 == 0, event(1, "d", 3, image, none)),
        F.when(key % 28 == 0, event(1, "u", 4, image, image)),          # revived
        F.when(key % 22 == 0, event(1, "u", 0, none, extra)),           # arrives late, older than the creation
        F.when(key % 97 == 0, event(0, "u", 5, none, keyless)),
    )
    return row.select(F.explode(F.filter(events, lambda e: e.isNotNull())).alias("e")).select(
        "e.part", "e.before", "e.after", "e.op", "e.ts_ms",
        F.struct(F.lit("orders").alias("table"), F.col("e.ts_ms").alias("ts_ms"), F.col("e.lsn").alias("lsn"))
        .alias("source"))


def click_bytes(spark: SparkSession, folder: str, which: str = "true", stored: DataFrame | None = None) -> DataFrame:
    """Click events as broker messages: a binary JSON ``value``; every 500th message is broken. ``which`` chooses events.
    ``stored``: the clicks, if they have been written already."""
    c = (clicks(spark, folder) if stored is None else stored).filter(which)
    text = F.to_json(F.struct(*[
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_timestamp")
        if name == "event_timestamp" else F.col(name) for name in c.columns
    ]))
    broken = F.col("event_id").cast("bigint") % 500 == 499
    return c.select(F.when(broken, F.lit("{not json")).otherwise(text).cast("binary").alias("value"))


def fx_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One FX document per date, a second corrected one on days divisible by 5."""
    docs = rates(spark, folder).groupBy("exchange_date", F.col("base_currency").alias("base_code")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("target_currency", "exchange_rate")))).alias("rates"))
    corrected = F.transform_values("rates", lambda k, v: v * 1.5)
    copies = F.array(
        F.struct(F.lit("T08:00:00.000001+00:00").alias("at"), F.col("rates").alias("rates")),
        F.when(F.dayofmonth("exchange_date") % 5 == 0,
               F.struct(F.lit("T20:30:00.000002+00:00").alias("at"), corrected.alias("rates"))),
    )
    return (
        docs.select("exchange_date", "base_code", F.explode(F.filter(copies, lambda d: d.isNotNull())).alias("d"))
        .select(
            "base_code",
            F.map_concat("d.rates", F.create_map(F.lit("XAU"), F.lit(0.0005))).alias("rates"),
            F.concat(F.date_format("exchange_date", "yyyy-MM-dd"), F.col("d.at")).alias("_ingested_at"),
        )
    )


def part_count(spark: SparkSession, folder: str) -> int:
    """Number of parts: events refer to all of them in turn."""
    return max(1, table(spark, folder, "part").count())


def behaviour_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Historical shop behaviour: events on parts, with missing codes, brands, ids and prices."""
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("part"), "p_type", "p_brand")
    eid = F.col("event_id")
    category = F.col("part") % 12
    code = F.concat_ws(".", F.lower("p_type"), category.cast("string"))
    return (
        table(spark, folder, "events")
        .withColumn("part", eid % part_count(spark, folder))
        .join(part, "part")
        .select(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
            _pick(F.col("event_type"), {"click": "cart", "purchase": "purchase"}, "view").alias("event_type"),
            F.when(eid % 101 != 0, F.col("part").cast("string")).alias("product_id"),
            F.when(eid % 103 != 0, (category + 2053013550000000).cast("string")).alias("category_id"),
            F.when((eid % 7 >= 4) & (category != 5) & (F.col("part") % 13 != 0), code).alias("category_code"),
            F.when((eid % 5 != 0) & (F.col("part") % 11 != 0), F.col("p_brand")).alias("brand"),
            F.when(eid % 13 == 0, F.lit(0.0)).when(eid % 17 == 0, F.lit(-1.0))
            .when(F.col("part") % 19 != 0, F.col("value")).alias("price"),
            F.col("user_id").cast("string").alias("user_id"),
            F.concat(F.lit("s"), eid.cast("string")).alias("user_session"),
        )
    )
