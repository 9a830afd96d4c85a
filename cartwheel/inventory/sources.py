"""Readers and landing layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.functions.scalars import file_month
from cartwheel.inventory.base import Query, with_views
from cartwheel.inventory.changes import FEED_COLUMNS, FEED_SQL, feed_columns, landed_feed
from cartwheel.inventory.marts import BEHAVIOUR_SQL, catalogue_sql
from cartwheel.operators.catalogue import build_catalogue
from cartwheel.operators.rates import keep_currencies, rates_as_map
from cartwheel.session import scratch_dir
from cartwheel.sources import domain, files
from cartwheel.sources.files import Catalog


def _change_feed(spark, folder):
    """The feed through the stream reader of the job, with two broken lines that must not appear."""
    landing, out = landed_feed(spark, folder), scratch_dir(spark, "s2")
    broken = spark.createDataFrame([('{"op": "c", "after": {"id": "many"}}',), ("{broken",)], "value STRING")
    broken.write.option("compression", "none").text(f"{landing}/year=2024/month=01/day=03")
    reader = files.change_stream(spark, "orders", landing)
    query = (feed_columns(reader.filter(F.col(files.BROKEN_LINE).isNull())).writeStream.format("parquet")
             .option("checkpointLocation", f"{out}/offsets").trigger(availableNow=True).start(f"{out}/rows"))
    query.awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def _event_stream(spark, folder):
    """Landed event files as a stream, drained into a table and read back."""
    events = domain.table(spark, folder, "events")
    out = scratch_dir(spark, "s3")
    events.write.parquet(f"{out}/landed")
    query = (
        files.landed_click_stream(spark, f"{out}/landed", schema=events.schema)
        .writeStream.format("parquet").option("checkpointLocation", f"{out}/_offsets").trigger(availableNow=True)
        .start(f"{out}/rows")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"),
                                                    "user_id", "event_type", "value")


def land_documents(spark, folder) -> str:
    """FX documents as multi-line JSON below dated folders: one array per month, so the calendar bounds a file."""
    docs = domain.fx_documents(spark, folder).withColumn("at", F.try_to_timestamp("_ingested_at"))
    docs = files.with_landing_parts(docs, F.col("at")).withColumn("day", F.lit("01")).drop("at")
    text = F.to_json(F.collect_list(F.struct("_ingested_at", "base_code", "rates")))
    out = scratch_dir(spark, "fx")
    (docs.groupBy("year", "month", "day").agg(F.replace(text, F.lit(","), F.lit(",\n  ")).alias("value"))
     .write.option("compression", "none").partitionBy("year", "month", "day").format("text").save(out))
    return out


def _fx_documents(spark, folder):
    # the text writer names its files .txt
    docs = files.fx_documents(spark, land_documents(spark, folder), "*/*/*/*.txt")
    return docs.select("_ingested_at", F.explode(rates_as_map(docs)).alias("currency", "rate"))


DOC_ROWS_SQL = """
    select exchange_date, strftime(exchange_date, '%Y-%m-%d') || tm as _ingested_at, currency, rate
    from (select exchange_date, 'T08:00:00.000001+00:00' as tm, target_currency as currency, exchange_rate as rate from d_rates
          union all
          select exchange_date, 'T20:30:00.000002+00:00', target_currency, exchange_rate * 1.5 from d_rates
          where day(exchange_date) % 5 = 0
          union all
          select exchange_date, 'T08:00:00.000001+00:00', 'XAU', 0.0005 from (select distinct exchange_date from d_rates)
          union all
          select exchange_date, 'T20:30:00.000002+00:00', 'XAU', 0.0005 from (select distinct exchange_date from d_rates)
          where day(exchange_date) % 5 = 0)"""


def land_behaviour(spark, folder) -> list[str]:
    """Two monthly CSV files' folders, with a line of too many fields per folder's file."""
    rows = domain.behaviour_rows(spark, folder)
    out = scratch_dir(spark, "csv")
    rows.write.option("header", True).csv(f"{out}/good")
    # lines that do not fit: one field too many
    broken = rows.filter(F.col("user_session").endswith("77")).withColumn("extra", F.lit("x"))
    broken.write.option("header", True).csv(f"{out}/broken")
    return [f"{out}/good", f"{out}/broken"]


def _csv_rows(spark, folder):
    columns = ["event_time", "product_id", "category_id", "category_code", "brand", "price"]
    return files.behaviour_csv(spark, land_behaviour(spark, folder), columns).drop("file")


def _csv_catalogue(spark, folder):
    return build_catalogue(files.behaviour_csv(spark, land_behaviour(spark, folder)))


def _table_scan(spark, folder):
    return Catalog(spark, {"orders": f"{folder}/orders.parquet"}).source("orders").groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"))


def _currency_filter(spark, folder):
    docs = keep_currencies(domain.fx_documents(spark, folder))
    return docs.select("_ingested_at", F.explode("rates").alias("currency", "rate"))


def _landing_parts(spark, folder):
    ts = F.col("event_timestamp")
    return files.with_landing_parts(files.audited(domain.raw_clicks(spark, folder), ts), ts).select(
        "event_id", "_ingested_at", "year", "month", "day")


def _feed_landing(spark, folder):
    c = domain.raw_clicks(spark, folder)
    value = F.when(F.col("event_id").cast("bigint") % 50 != 0, F.col("event_type"))
    messages = files.changes_only(c.withColumn("value", value))
    return files.with_landing_parts(messages, F.col("event_timestamp"), files.LANDING_ZONE).select(
        "event_id", "year", "month", "day")


def _file_months(spark, folder):
    o = domain.table(spark, folder, "orders").withColumn("ts", F.col("o_orderdate").cast("timestamp"))
    key = F.col("o_orderkey")
    name = (
        F.when(key % 5 == 0, F.date_format("ts", "yyyy-MMM'.csv'")).when(key % 5 == 1, F.date_format("ts", "yyyy-M'.csv'"))
        .when(key % 5 == 2, F.date_format("ts", "yyyy-MM'.csv'")).when(key % 5 == 3, F.date_format("ts", "yyyy-MM-dd'.csv'"))
        .otherwise(F.date_format("ts", "yyyy'-half.csv'"))
    )
    return o.select(key.alias("id"), name.alias("file"), file_month(name).alias("p")).select(
        "id", "file", "p.year", "p.month")


QUERIES = [
    Query("s2_json_change_feed", _change_feed, with_views("d_orders", feed=FEED_SQL, body=f"select {FEED_COLUMNS} from feed")),
    Query("s3_parquet_event_stream", _event_stream,
          "select event_id, epoch_us(ts) as ts, user_id, event_type, value from events"),
    Query("s4_fx_documents", _fx_documents, with_views("d_rates", docs=DOC_ROWS_SQL,
                                                       body="select _ingested_at, currency, rate from docs")),
    Query("s5_behaviour_csv", _csv_rows, with_views(rows=BEHAVIOUR_SQL, body="""
        select event_time, product_id, category_id, category_code, brand, cast(price as double) as price from rows""")),
    Query("s5_csv_to_catalogue", _csv_catalogue, with_views(rows=BEHAVIOUR_SQL, body=catalogue_sql("rows"))),
    Query("s6_table_scan", _table_scan, "select o_orderstatus, count(*) as orders from orders group by 1"),
    Query("s9_currency_filter", _currency_filter, with_views("d_rates", docs=DOC_ROWS_SQL, body="""
        select _ingested_at, currency, rate from docs where currency <> 'XAU'""")),
    Query("s10_landing_parts", _landing_parts, """
        select cast(event_id as varchar) as event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') as _ingested_at,
          strftime(ts, '%Y') as year, strftime(ts, '%m') as month, strftime(ts, '%d') as day from events"""),
    Query("s11_change_feed_landing", _feed_landing, """
        select cast(event_id as varchar) as event_id, strftime(ts + interval 7 hour, '%Y') as year,
          strftime(ts + interval 7 hour, '%m') as month, strftime(ts + interval 7 hour, '%d') as day
        from events where event_id % 50 <> 0"""),
    Query("s12_file_months", _file_months, """
        select o_orderkey as id, case o_orderkey % 5 when 0 then strftime(o_orderdate, '%Y-%b.csv')
            when 1 then strftime(o_orderdate, '%Y-%-m.csv') when 2 then strftime(o_orderdate, '%Y-%m.csv')
            when 3 then strftime(o_orderdate, '%Y-%m-%d.csv') else strftime(o_orderdate, '%Y-half.csv') end as file,
          case when o_orderkey % 5 < 3 then strftime(o_orderdate, '%Y') end as year,
          case when o_orderkey % 5 < 3 then strftime(o_orderdate, '%m') end as month from orders"""),
]
