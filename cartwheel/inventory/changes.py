"""Change-feed operators, checked on order changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.inventory.base import Query, with_views
from cartwheel.operators import changes as ops
from cartwheel.schemas import payload
from cartwheel.session import materialise, scratch_dir
from cartwheel.sinks import runs
from cartwheel.sinks.tables import read_keyed, upsert
from cartwheel.sources import domain, files
from cartwheel.streaming.changes import run_change_feed

FEED_COLUMNS = "op, ts_ms, lsn, before_id, after_id, after_status, after_quantity, after_total"
# the events of the feed: part, op, offset, which rows, image before, image after
FEED_SQL = " union all ".join(
    f"""select {part} as part, '{op}' as op, id * 10 + {offset} as ts_ms, id * 100 + {offset * 10 + part} as lsn,
          {before} as before_id, {after} as after_id, {status} as after_status, {quantity} as after_quantity,
          {total} as after_total from d_orders where {which}"""
    for part, op, offset, which, before, after, status, quantity, total in [
        (0, "c", 1, "true", "cast(null as bigint)", "id", "case when id % 3 = 0 then 'PENDING' else status end",
         "quantity", "cast(total_amount as double)"),
        (1, "u", 2, "id % 3 = 0", "id", "id", "status", "quantity", "cast(total_amount as double)"),
        (0, "u", 2, "id % 33 = 0", "id", "id", "status", "quantity + 1", "cast(total_amount as double)"),
        (0, "d", 3, "id % 14 = 0 and id % 42 <> 0", "id", "null", "null", "null", "null"),
        (1, "d", 3, "id % 42 = 0", "id", "null", "null", "null", "null"),
        (1, "u", 4, "id % 28 = 0", "id", "id", "status", "quantity", "cast(total_amount as double)"),
        (1, "u", 0, "id % 22 = 0", "null", "id", "status", "quantity + 1", "cast(total_amount as double)"),
        (0, "u", 5, "id % 97 = 0", "null", "null", "status", "quantity", "cast(total_amount as double)"),
    ])

FLAT_SQL = """
    select part, op, ts_ms, coalesce(after_id, before_id) as id, after_status as status, after_quantity as quantity,
      after_total as total_amount, op = 'd' as is_deleted, lsn from feed"""
LATEST_SQL = """
    select * exclude (n) from (select *, row_number() over (partition by id order by ts_ms desc, lsn desc) as n
                               from flat where id is not null) where n = 1"""


def _state_sql(guard: bool) -> str:
    """Table after part 0 as the first load and part 1 as one merge."""
    return with_views("d_orders", feed=FEED_SQL, flat=FLAT_SQL,
                      a="select * from (select *, row_number() over (partition by id order by ts_ms desc, lsn desc) as n"
                        f" from flat where id is not null and part = 0) where n = 1 and {'true' if guard else "op <> 'd'"}",
                      b="select * from (select *, row_number() over (partition by id order by ts_ms desc, lsn desc) as n"
                        " from flat where id is not null and part = 1) where n = 1",
                      body=f"""
        select * from (select id,
          case when upd then b.op else a.op end as op,
          case when upd or del then b.ts_ms else a.ts_ms end as ts_ms,
          case when upd then b.status else a.status end as status,
          case when upd then b.quantity else a.quantity end as quantity,
          case when upd then b.total_amount else a.total_amount end as total_amount,
          case when del then true when upd then b.is_deleted else a.is_deleted end as is_deleted
        from (select coalesce(a.id, b.id) as id, a, b,
                coalesce(b.op <> 'd' and (a.id is null or {'b.ts_ms >= a.ts_ms' if guard else 'true'}), false) as upd,
                coalesce(b.op = 'd' and a.id is not null and {'b.ts_ms >= a.ts_ms' if guard else 'true'}, false) as del
              from a full join b on a.id = b.id)
        where a.id is not null or upd) where op <> 'd'""")


# of the newest change per key and part: what a key holds is its newest image, and its newest change says whether it is deleted
RUNS_SQL = with_views(
    "d_orders", feed=FEED_SQL, flat=FLAT_SQL,
    newest="""select * from flat where id is not null
              qualify row_number() over (partition by id, part order by ts_ms desc, lsn desc) = 1""",
    seen="select id, ts_ms, is_deleted from newest qualify row_number() over (partition by id order by ts_ms desc, lsn desc) = 1",
    image="""select id, op, status, quantity, total_amount from newest where op <> 'd'
             qualify row_number() over (partition by id order by ts_ms desc, lsn desc) = 1""",
    body="select id, op, ts_ms, status, quantity, total_amount, is_deleted from image join seen using (id)")


def feed_columns(feed):
    return feed.select("op", "ts_ms", F.col("source.lsn").alias("lsn"),
                       F.col("before.id").cast("bigint").alias("before_id"), F.col("after.id").cast("bigint").alias("after_id"),
                       F.col("after.status").alias("after_status"),
                       F.col("after.quantity").cast("bigint").alias("after_quantity"),
                       F.col("after.total_amount").cast("double").alias("after_total"))


def stored_orders(spark, folder):
    """The orders written once, for feeds that are read part by part."""
    return materialise(domain.orders(spark, folder), "order-rows")


def land_part(spark, folder, landing: str, part: int, stored=None) -> None:
    """Write one part of the feed as JSON lines below a dated folder."""
    feed = domain.change_feed(spark, folder, stored).filter(F.col("part") == part).drop("part")
    files.land_json(feed.withColumns({"year": F.lit("2024"), "month": F.lit("01"), "day": F.lit(f"{part + 1:02d}")}),
                    landing)


def landed_feed(spark, folder) -> str:
    landing = scratch_dir(spark, "cdc")
    land_part(spark, folder, landing, 0)
    land_part(spark, folder, landing, 1)
    return landing


def _flat(spark, folder):
    return ops.flatten(domain.change_feed(spark, folder))


def _state(rows):
    return rows.select(F.col("id").cast("bigint").alias("id"), "op", "ts_ms", "status",
                       F.col("quantity").cast("bigint").alias("quantity"),
                       F.col("total_amount").cast("double").alias("total_amount"), "is_deleted")


def _parts(spark, folder, *more, stored=None):
    feed = domain.change_feed(spark, folder, stored)
    def part(n):
        keyed, _ = ops.split_keyless(ops.flatten(feed.filter(F.col("part") == n)), "id")
        latest = ops.latest_per_key(keyed, "id")
        return latest if more else latest.drop("lsn")
    return part(0), part(1)


def _merged(guard):
    def plan(spark, folder):
        first, second = _parts(spark, folder)
        return _state(ops.without_tombstones(ops.merge_changes(ops.initial_rows(first, guard), second, "id", guard)))
    return plan


def _upserted(spark, folder):
    """Both parts through the bucketed table; the second part twice, which must not change anything."""
    first, second = _parts(spark, folder)
    path = scratch_dir(spark, "orders")
    second = materialise(second, "part")
    for batch in (first, second, second):
        upsert(batch, path, "id", buckets=8)
    return _state(read_keyed(spark, path))


def _streamed(spark, folder):
    """The incremental job over landed files: part 0, nothing new, part 1."""
    root = scratch_dir(spark, "feed")
    stored = stored_orders(spark, folder)
    landing, silver, offsets = f"{root}/landing", f"{root}/silver", f"{root}/checkpoint"
    for part in (0, None, 1):
        if part is not None:
            land_part(spark, folder, landing, part, stored)
        run_change_feed(spark, "orders", landing, silver, offsets, buckets=8, rejects=f"{root}/rejects")
    return _state(runs.read_runs(spark, silver, "id"))


def _runs(fold: str | None):
    """Part 0 as a run, part 1 as three, one of them twice, folded in between: the rows are the same however that is done."""
    def plan(spark, folder):
        first, second = (materialise(p, "part") for p in _parts(spark, folder, "lsn", stored=stored_orders(spark, folder)))
        path = scratch_dir(spark, "orders")
        runs.write_run(first, path, "id", 8, "batch-0")
        for number in (1, 2, 2, 3):
            runs.write_run(second.filter(F.col("id") % 3 == number - 1), path, "id", 8, f"batch-{number}")
            if fold and number == 1:  # the first run becomes the base
                runs.fold_runs(spark, path, "id", [F.col("ts_ms")], base_share=0)
        if fold:
            runs.fold_runs(spark, path, "id", [F.col("ts_ms"), F.col("id")], fan_in=2, base_share=0 if fold == "base" else 9)
        return _state(runs.read_runs(spark, path, "id"))
    return plan


NEXT_VERSION = "channel STRING, quantity BIGINT, unit_price DECIMAL(20,4)"


def _land_next_version(spark, folder, landing: str, stored=None) -> None:
    """Part 1 with a new column and wider types, and the changes of odd ids with a quantity that is text."""
    feed = domain.change_feed(spark, folder, stored).filter("part = 1").drop("part")
    image = F.col("after")
    later = (image.withField("channel", F.concat(F.lit("c"), (image["id"] % 3).cast("string")))
             .withField("quantity", image["quantity"] + 3_000_000_000)
             .withField("unit_price", (image["unit_price"] + F.lit("0.0125").cast("decimal(20,4)")).cast("decimal(20,4)")))
    narrowed = later.withField("quantity", F.concat(F.lit("about "), image["quantity"].cast("string")))
    for day, which, after in (("02", image["id"].isNull() | (image["id"] % 2 == 0), later), ("03", image["id"] % 2 == 1, narrowed)):
        files.land_json(feed.filter(which).withColumn("after", after).withColumns(
            {"year": F.lit("2024"), "month": F.lit("01"), "day": F.lit(day)}), landing)


def _versions(spark, folder):
    """Two versions of a feed merged; rows last changed by the first one have no channel, narrowed lines are set aside."""
    root = scratch_dir(spark, "feed")
    landing, silver = f"{root}/landing", f"{root}/silver"
    stored = stored_orders(spark, folder)
    for land, versions in ((lambda: land_part(spark, folder, landing, 0, stored), ()),
                           (lambda: _land_next_version(spark, folder, landing, stored), (NEXT_VERSION,))):
        land()
        run_change_feed(spark, "orders", landing, silver, f"{root}/checkpoint", buckets=8, rejects=f"{root}/rejects", versions=versions)
    schema = runs.stored_schema(payload("orders", NEXT_VERSION), "id", 8)
    runs.fold_runs(spark, silver, "id", base_share=0, schema=schema)  # the first batch becomes the base
    rows = runs.read_runs(spark, silver, "id", schema)
    broken = spark.read.schema("reject_reason STRING").parquet(f"{root}/rejects").filter("reject_reason = 'malformed'")
    return (rows.select("id", "quantity", "channel", F.col("unit_price").cast("double").alias("unit_price"), "is_deleted", F.lit(0).alias("broken"))
            .unionByName(broken.agg(F.count("*").cast("int").alias("broken")), allowMissingColumns=True))


def _unknown_columns(spark, folder):
    """What the second version has beyond the first: seen before it is registered."""
    landing = scratch_dir(spark, "cdc")
    land_part(spark, folder, landing, 0)
    _land_next_version(spark, folder, landing)
    return files.unknown_columns(spark, "orders", landing)


def _rejected(spark, folder):
    _, keyless = ops.split_keyless(_flat(spark, folder), "id")
    return keyless.select("op", "ts_ms", "status")


QUERIES = [
    Query("c3_flatten", lambda s, f: _state(_flat(s, f)), with_views("d_orders", feed=FEED_SQL, flat=FLAT_SQL, body="""
        select id, op, ts_ms, status, quantity, total_amount, is_deleted from flat""")),
    Query("c4_key_recovery",
          lambda s, f: domain.change_feed(s, f).filter(F.col("after").isNull()).transform(
              lambda d: d.select("ts_ms", ops.event_key(d, "id").alias("id"))),
          with_views("d_orders", feed=FEED_SQL, body="select ts_ms, before_id as id from feed where op = 'd'")),
    Query("c5_delete_flag", lambda s, f: _flat(s, f).groupBy("is_deleted").agg(F.count("*").alias("events")),
          with_views("d_orders", feed=FEED_SQL, body="select op = 'd' as is_deleted, count(*) as events from feed group by 1")),
    Query("c6_latest_per_key",
          lambda s, f: _state(ops.latest_per_key(ops.split_keyless(_flat(s, f), "id")[0], "id")),
          with_views("d_orders", feed=FEED_SQL, flat=FLAT_SQL, latest=LATEST_SQL, body="""
            select id, op, ts_ms, status, quantity, total_amount, is_deleted from latest""")),
    Query("c7_merge_upsert", _merged(True), _state_sql(True)),
    Query("c7_merge_unguarded", _merged(False), _state_sql(False)),
    Query("c7_bucketed_upsert", _upserted, _state_sql(True)),
    Query("c7_change_runs", _runs(None), RUNS_SQL),
    Query("c7_folded_tiers", _runs("tier"), RUNS_SQL),
    Query("c7_folded_base", _runs("base"), RUNS_SQL),
    Query("c8_incremental_job", _streamed, RUNS_SQL),
    Query("c2_versioned_feed", _versions, with_views(
        "d_orders", feed=f"select f.*, unit_price from ({FEED_SQL}) f left join d_orders o on f.after_id = o.id",
        fit="""select part, op, ts_ms, coalesce(after_id, before_id) as id, lsn,
                 after_quantity + case when part = 1 then 3000000000 else 0 end as quantity,
                 case when part = 1 then 'c' || (after_id % 3) end as channel,
                 cast(cast(unit_price as decimal(20,4)) + case when part = 1 then 0.0125 else 0 end as double) as unit_price
               from feed where (part = 0 or after_id is null or after_id % 2 = 0) and coalesce(after_id, before_id) is not null""",
        newest="select * from fit qualify row_number() over (partition by id, part order by ts_ms desc, lsn desc) = 1",
        body="""
        select id, quantity, channel, unit_price, last_op = 'd' as is_deleted, 0 as broken from newest
        join (select id, arg_max(op, {'a': ts_ms, 'b': lsn}) as last_op from newest group by id) using (id) where op <> 'd'
        qualify row_number() over (partition by id order by ts_ms desc, lsn desc) = 1
        union all select null, null, null, null, null, cast(count(*) as int) from feed where part = 1 and after_id % 2 = 1""")),
    Query("c2_unknown_columns", _unknown_columns, with_views("d_orders", feed=FEED_SQL, body="""
        select 'channel' as "column", count(*) as lines from feed where part = 1 and after_id is not null group by 1""")),
    Query("c9_live_rows", lambda s, f: ops.live(domain.orders(s, f)).select("id", "status"),
          with_views("d_orders", body="select id, status from d_orders where not is_deleted")),
    Query("p1_keyless_changes", _rejected,
          with_views("d_orders", feed=FEED_SQL, body="""
            select op, ts_ms, after_status as status from feed where after_id is null and before_id is null""")),
]
