"""Exchange-rate operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cartwheel.functions.scalars import half_up
from cartwheel.inventory import base
from cartwheel.inventory.base import Query, h, with_views
from cartwheel.operators import rates as ops
from cartwheel.plans.staging import PAIR, stage_rates_since
from cartwheel.session import materialise, scratch_dir
from cartwheel.sinks.tables import overwrite_partitions
from cartwheel.sources import domain

DOCS = """
    select exchange_date, tm, target_currency as currency, exchange_rate * factor as rate
    from d_rates, (values ('T08:00:00.000001+00:00', 1.0), ('T20:30:00.000002+00:00', 1.5)) v(tm, factor)
    where factor = 1.0 or day(exchange_date) % 5 = 0
    union all
    select exchange_date, tm, 'XAU', 0.0005 from (select distinct exchange_date from d_rates),
      (values ('T08:00:00.000001+00:00', 1.0), ('T20:30:00.000002+00:00', 1.5)) v(tm, factor)
    where factor = 1.0 or day(exchange_date) % 5 = 0"""


def _as_struct(spark, folder):
    """Documents with the rates as a struct, the shape a JSON reader infers."""
    docs = domain.fx_documents(spark, folder)
    return docs.withColumn("rates", F.struct(*[
        F.try_element_at("rates", F.lit(c)).alias(c) for c in (*domain.CURRENCIES, "XAU")]))


def _map_rows(keep_nulls):
    def plan(spark, folder):
        docs = _as_struct(spark, folder)
        return docs.select("_ingested_at", F.explode(ops.rates_as_map(docs, keep_nulls)).alias("currency", "rate"))
    return plan


def _converted(spark, folder):
    o = base.orders(spark, folder)
    return ops.with_usd(o, base.rates(spark, folder), "total_amount", "usd", domain.rates(spark, folder)).select(
        "order_id", half_up(F.col("usd")).alias("usd"))


CARRIED_SINCE = date(2001, 7, 29)


def _carried(spark, folder):
    """Closings brought up to date month by month as days arrive; then the last days from their month and one closing."""
    path = scratch_dir(spark, "closings")
    rates = domain.rates(spark, folder)
    for first, until in ((None, "2000-11-14"), ("2000-11-15", "2001-06-30"), ("2001-07-01", "2001-08-31")):
        known = rates.filter(F.col("exchange_date") <= F.lit(until).cast("date"))
        before = None
        if first:
            month = F.trunc(F.lit(first).cast("date"), "month")
            known = known.filter(F.col("exchange_date") >= month)
            before = spark.read.parquet(path).filter(F.col("month") == F.add_months(month, -1))
        closed = ops.monthly_closings(known, PAIR, "exchange_date", "exchange_rate", before, date.fromisoformat(until))
        overwrite_partitions(materialise(closed, "closed"), path, ["month"])
    return stage_rates_since(rates, spark.read.parquet(path), CARRIED_SINCE)


QUERIES = [
    Query("x4_carried_rates", _carried, with_views("s_rates", body=f"select * from s_rates where exchange_date >= date '{CARRIED_SINCE}'")),
    Query("x1_struct_to_map", _map_rows(True), with_views("d_rates", docs=DOCS, body="""
        select strftime(exchange_date, '%Y-%m-%d') || tm as _ingested_at, currency, rate from docs""")),
    Query("x1_struct_to_map_known", _map_rows(False), with_views("d_rates", docs=DOCS, body="""
        select strftime(exchange_date, '%Y-%m-%d') || tm as _ingested_at, currency, rate from docs
        where rate is not null""")),
    Query("x2_rate_rows", lambda s, f: ops.rate_rows(_as_struct(s, f)), with_views("d_rates", docs=DOCS, body="""
        select exchange_date, 'USD' as base_currency, currency as target_currency, arg_max_null(rate, tm) as exchange_rate
        from docs group by exchange_date, currency""")),
    Query("x3_ingest_dates",
          lambda s, f: ops.rate_rows(domain.fx_documents(s, f)).groupBy("exchange_date").agg(F.count("*").alias("rates")),
          with_views("d_rates", body="select exchange_date, count(*) + 1 as rates from d_rates group by 1")),
    Query("x4_forward_fill", base.rates, with_views("s_rates", body="select * from s_rates")),
    Query("x5_convert_to_usd", _converted, with_views("o_usd", body=f"select order_id, {h('usd')} as usd from o_usd")),
    Query("x6_missing_rates",
          lambda s, f: ops.missing_rates(base.orders(s, f), base.rates(s, f), domain.rates(s, f)),
          with_views("o_usd", body="""
            select currency, count(*) as orders_without_rate from o_usd where currency <> 'USD' and rate is null group by 1""")),
]
