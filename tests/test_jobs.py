"""The whole way on small data: landed files → silver → marts, run again and again."""

import json
from datetime import date, datetime, timezone

import pytest
from conftest import rows

from cartwheel import jobs
from cartwheel.operators.quality import content_hash

AS_OF = date(2024, 1, 10)


def write(path, *docs, indent=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(d, indent=indent) for d in docs))


def change(op, ts, after=None, before=None):
    return {"before": before, "after": after, "op": op, "ts_ms": ts, "source": {"lsn": ts}}


def order(i, user, status, day, total=100.0, currency="EUR"):
    at = f"2024-01-{day:02d}T10:00:00Z"
    return {"id": i, "user_id": user, "product_id": "7", "quantity": 1, "unit_price": total, "total_amount": total, "amount": total,
            "currency": currency, "payment_method": "momo", "status": status, "created_at": at, "updated_at": at}


def land(lake, table, name, *events):
    write(lake / "bronze/cdc" / table / "year=2024/month=01/day=10" / name, *events)


def click(i, user, session, kind, day, **extra):
    return json.dumps({"event_id": f"e{i}", "user_id": user, "session_id": session, "event_type": kind, "device": "mobile",
                       "referrer": "google.com", "event_timestamp": f"2024-01-{day:02d}T10:00:{i:02d}+00:00", "item_id": "7", **extra}).encode()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    land(root, "orders", "a.json", *[change("c", i, order(i, i % 3, "COMPLETED" if i == 2 else "PENDING", 1 + i)) for i in range(1, 9)])
    land(root, "products", "a.json", change("c", 1, {"product_id": "7", "category_code": "toys", "brand": "acme", "avg_price": 1.5,
                                                     "created_at": "2024-01-01T00:00:00Z"}))
    land(root, "users", "a.json", *[change("c", 1, {"id": i, "name": "n", "email": "e@x", "city": "Hue", "created_at": "2023-05-01T00:00:00Z"})
                                    for i in range(3)])
    for day in range(1, 10):
        write(root / f"bronze/exchange_rates/year=2024/month=01/day={day:02d}/r.json",
              {"base_code": "USD", "rates": {"EUR": None if day == 9 else 0.5, "USD": 1.0}, "_ingested_at": f"2024-01-{day:02d}T08:00:00+00:00"}, indent=2)
    values = [b"{broken", click(9, None, "z", "view_item", 8), click(1, 1, "a", "view_item", 8), click(2, 1, "a", "add_to_cart", 8),
              click(3, 1, "a", "checkout", 9, step="confirmation", real_order_id=8, purchase_amount=100.0), click(4, 2, "b", "view_item", 9)]
    spark.createDataFrame([(bytearray(v),) for v in values], "value BINARY").write.parquet(str(root / "messages"))
    lake = jobs.Lake(spark, str(root))
    jobs.land(lake, spark.readStream.schema("value BINARY").parquet(str(root / "messages")), every=None).awaitTermination()
    return lake


def ingest(lake):
    for table in jobs.PRIMARY_KEYS:
        jobs.merge_changes(lake, table, buckets=2)
    assert jobs.load_rates(lake) and jobs.refine(lake)


def spark_of(lake):
    return lake.spark


def gold_state(lake):
    return {m: tuple(content_hash(lake.gold(m)).first()) for m in jobs.MART_DATES}


def test_reruns_change_nothing_and_late_updates_arrive(lake, tmp_path):
    from pathlib import Path
    ingest(lake)
    report = jobs.refresh_marts(lake, AS_OF)
    assert {r.status for r in report.collect()} == {"pass"}
    first = gold_state(lake)
    assert all(n > 0 for n, _ in first.values())
    for _ in range(2):
        ingest(lake)
        jobs.refresh_marts(lake, AS_OF)
        assert gold_state(lake) == first

    # order 8 completes and order 7 is deleted, inside the window; order 1 completes too, long before it
    land(Path(lake.root), "orders", "b.json", change("u", 100, order(8, 2, "COMPLETED", 9)), change("d", 100, before=order(7, 1, "PENDING", 8)),
         change("u", 100, order(1, 1, "COMPLETED", 2)))
    ingest(lake)
    jobs.refresh_marts(lake, AS_OF)
    got = {r.order_date.day: r for r in lake.gold("daily_sales").collect()}
    assert (got[9].order_count, got[9].total_revenue_usd, got[9].pending_count) == (1, 200.0, 0)   # rate of day 9 filled forward
    assert 8 not in got                                             # its only order is gone
    assert got[2].pending_count == 1                                # outside the window: as before
    funnel = {r.event_date.day: r for r in lake.gold("daily_funnel").collect()}
    assert funnel[9].users_truly_completed == 1 and funnel[9].bounce_rate_pct == 50.0
    assert funnel[8].bounce_rate_pct == 0.0

    jobs.refresh_marts(lake, AS_OF, full=True)
    got = {r.order_date.day: r for r in lake.gold("daily_sales").collect()}
    assert got[2].order_count == 1
    assert lake.gold("customer_snapshot").count() == 3              # one snapshot a day, whatever is run again
    jobs.refresh_mart(lake, "customer_snapshot", date(2024, 1, 11))
    assert lake.gold("customer_snapshot").count() == 6
    snapshots = lake.gold("customer_snapshot").filter("snapshot_date = '2024-01-10'").orderBy("user_id").collect()
    jobs.record_customers(lake, date(2024, 1, 10))
    rebuilt = jobs.customers_on(lake, AS_OF, AS_OF).orderBy("user_id").select(lake.gold("customer_snapshot").columns).collect()
    assert [r.user_id for r in rebuilt] == [r.user_id for r in snapshots]
    assert {(r.event_date.day, r.users) for r in jobs.active_users(lake, 2).collect()} == {(8, 1), (9, 2)}
    assert rows(jobs.rejected(lake)) == [("clicks", "missing user_id", 1), ("landed clicks", "malformed", 1)]
    before = {t: rows(lake.silver(t)) for t in ("orders", "users", "clickstream")}
    assert jobs.maintain(lake, AS_OF).count() == 5
    assert {t: rows(lake.silver(t)) for t in before} == before     # folded, the same rows
    assert jobs.rebucket(lake, "orders", 3).endswith("orders_3_buckets")
    moved = jobs.runs.read_runs(spark_of(lake), lake.path("silver", "orders_3_buckets"), "id").select(lake.silver("orders").columns)
    assert rows(moved) == before["orders"]
    fresh = {r.table: r.lag_minutes for r in jobs.mart_freshness(lake, datetime(2024, 1, 10, 0, 45, tzinfo=timezone.utc)).collect()}
    assert set(fresh) == set(jobs.MART_DATES) and fresh["daily_funnel"] == fresh["daily_sales"] == 45


def test_catalogue_job(lake, tmp_path):
    (tmp_path / "2019-Oct.csv").write_text(
        "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
        "2019-10-01 00:00:00 UTC,view,p1,c1,toys,acme,2.00,1,s\n")
    for _ in range(2):
        jobs.seed_catalogue(lake, str(tmp_path))
    assert rows(lake.silver("catalogue")) == [("p1", "c1", "toys", "toys", "acme", 2.0)]


def test_landed_rates_can_be_loaded(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path))
    for day, rate in ((3, 0.5), (4, 0.25)):
        documents = spark.createDataFrame([("USD", {"EUR": rate, "XAU": 9.0}), ("GBP", {"EUR": 2.0, "VND": None})],
                                          "base_code STRING, rates MAP<STRING, DOUBLE>").coalesce(1)
        jobs.land_rates(lake, documents, datetime(2024, 1, day, 8, tzinfo=timezone.utc))
    assert jobs.load_rates(lake)
    got = {(r.exchange_date.day, r.base_currency, r.target_currency): r.exchange_rate
           for r in lake.silver("exchange_rates").filter("exchange_rate is not null").collect()}
    assert got == {(3, "USD", "EUR"): 0.5, (4, "USD", "EUR"): 0.25, (3, "GBP", "EUR"): 2.0, (4, "GBP", "EUR"): 2.0}


def test_broken_rate_documents_are_set_aside(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path))
    folder = tmp_path / "bronze/exchange_rates/year=2024/month=01/day=03"
    write(folder / "a.json")
    (folder / "a.json").write_text("{broken")
    assert jobs.load_rates(lake) is False                           # nothing else there
    write(folder / "b.json", {"base_code": "USD", "rates": {"EUR": 0.5}, "_ingested_at": "2024-01-03T08:00:00+00:00"}, indent=2)
    for _ in range(2):
        assert jobs.load_rates(lake)
        assert [r.exchange_rate for r in lake.silver("exchange_rates").filter("target_currency = 'EUR'").collect()] == [0.5]
        assert rows(spark.read.parquet(lake.path("silver", "rejects", "exchange_rates"))) == [("{broken", "malformed")]


def test_nothing_to_load(spark, tmp_path):
    empty = jobs.Lake(spark, str(tmp_path))
    assert jobs.load_rates(empty) is False and jobs.refine(empty) is False and jobs.merge_changes(empty, "orders") == {}


def test_command_line_needs_a_job():
    with pytest.raises(SystemExit):
        jobs.main(["--lake", "/nowhere"])
