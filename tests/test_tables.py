import os
import time
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartwheel.operators.catalogue import build_catalogue
from cartwheel.operators.quality import FRESHNESS_MINUTES, SUITES, Check, check_table, content_hash, freshness, run_suite
from cartwheel.session import scratch_dir, scratch_root
from cartwheel.sinks import files, tables, upkeep
from cartwheel.sources.files import Catalog, behaviour_csv, missing_ok


def days(spark, *data):
    return spark.createDataFrame([(date(2024, 1, d), k, v) for d, k, v in data], "day DATE, k STRING, v INT")


def test_delete_insert_matches_null_keys(spark):
    old = days(spark, (1, None, 1), (1, "a", 2), (2, "a", 3))
    new = days(spark, (1, None, 9), (3, "b", 4))
    assert rows(tables.delete_insert(old, new, ["day", "k"]).select("k", "v")) == [("a", 2), ("a", 3), ("b", 4), (None, 9)]


def test_refresh_replaces_the_window_only(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.refresh_window(days(spark, (1, "a", 1), (2, "a", 1), (2, "gone", 1), (3, "gone", 1)), path, "day")
    for _ in range(2):
        tables.refresh_window(days(spark, (2, "a", 2), (4, "b", 2)), path, "day", date(2024, 1, 2))
        assert rows(spark.read.parquet(path).select("day", "k", "v")) == [
            (date(2024, 1, 1), "a", 1), (date(2024, 1, 2), "a", 2), (date(2024, 1, 4), "b", 2)]
    # a refresh may read the table it replaces
    stored = spark.read.parquet(path)
    tables.refresh_window(stored.filter("day >= '2024-01-02'").withColumn("v", F.col("v") + 1).select("day", "k", "v"), path, "day", date(2024, 1, 2))
    assert rows(spark.read.parquet(path).select("v")) == [(1,), (3,), (3,)]


def test_snapshot_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "s")
    df = days(spark, (1, "a", 1), (2, "b", 2))
    assert tables.append_snapshot(df, path, "day", date(2024, 1, 1))
    assert not tables.append_snapshot(df, path, "day", date(2024, 1, 1))
    assert tables.append_snapshot(df, path, "day", date(2024, 1, 2))
    assert spark.read.parquet(path).count() == 2


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    assert [tables.write_version(days(spark, (1, "a", n)), path) for n in (1, 2, 3)] == [1, 2, 3]
    os.remove(f"{path}/version=3/_SUCCESS")                      # an unfinished rebuild is not read
    assert tables.read_latest(spark, path).first().v == 2
    assert upkeep.expire_versions(spark, path, date.today()) == []
    old = time.time() - 9 * 86400
    for name in os.listdir(f"{path}/version=1"):
        os.utime(f"{path}/version=1/{name}", (old, old))
    assert upkeep.expire_versions(spark, path, date.today()) == [1]
    assert tables.read_latest(spark, path).first().v == 2
    stats = upkeep.table_stats(spark, {"t": path}).first()
    assert stats.versions == 2 and stats.bytes > 0
    with pytest.raises(FileNotFoundError):
        tables.read_latest(spark, str(tmp_path / "none"))


def test_compaction_keeps_every_row(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("part"))
    df.repartition(8).write.partitionBy("part").parquet(path)
    df.filter("part = 0").coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    before = content_hash(spark.read.parquet(path)).first()
    assert upkeep.compact(spark, path, ["part"]) == 2            # part 0 is fine already
    assert upkeep.compact(spark, path, ["part"]) == 0
    assert content_hash(spark.read.parquet(path)).first() == before
    assert upkeep.list_files(spark, path).count() == 3
    # a run that died while replacing partitions: one is gone, the copy is complete
    spark.read.parquet(path).filter("part > 0").withColumn(
        "id", F.when(F.col("part") == 2, -1).otherwise(F.col("id"))).write.parquet(f"{path}/_compact")
    files.delete(spark, f"{path}/part=1")
    assert upkeep.compact(spark, path, ["part"]) == 0
    assert content_hash(spark.read.parquet(path)).first() == before and not files.exists(spark, f"{path}/_compact")


def test_retention(spark, tmp_path):
    old = time.time() - 8 * 86400
    names = ["clickstream/day=1/a", "clickstream/day=1/b", "clickstream/day=2/new", "clickstream/day=3/new", "clickstream/day=3/old",
             "cdc_postgres/x", "api_exchange_rates/x", "batch_ecommerce/x"]
    for name in names:
        f = tmp_path / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("x")
        if "new" not in name:
            os.utime(f, (old, old))
    assert upkeep.apply_retention(spark, str(tmp_path), date.today()) == 3   # one folder, one file of day 3, the feed folder
    left = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file() and not p.name.startswith("."))
    assert left == ["api_exchange_rates/x", "batch_ecommerce/x", "clickstream/day=2/new", "clickstream/day=3/new"]


def test_registration_is_repeatable(spark, tmp_path):
    days(spark, (1, "a", 1), (2, "b", 2)).write.partitionBy("day").parquet(str(tmp_path / "t"))
    for _ in range(2):
        assert tables.register_tables(spark, "silver_test", str(tmp_path), {"t": str(tmp_path / "t"), "u": str(tmp_path / "u")}) == ["u"]
    assert spark.table("silver_test.t").filter("day = '2024-01-02'").count() == 1


def test_catalog_and_missing_paths(spark, tmp_path):
    days(spark, (1, "a", 1)).write.parquet(str(tmp_path / "t"))
    catalog = Catalog(spark, {"t": str(tmp_path / "t"), "u": str(tmp_path / "u")})
    assert catalog.source("t").count() == 1
    assert missing_ok(lambda: catalog.source("u")) is None
    with pytest.raises(KeyError, match="known: t, u"):
        catalog.source("w")


def test_scratch_follows_the_cluster_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    folder = scratch_dir(spark, "x")
    assert folder.startswith(root + "/") and "/x-" in folder


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace
    conf = {"spark.sql.warehouse.dir": "/w/"}
    def session(master):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))
    assert scratch_root(session("local[8]")) == "/w/_scratch"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint.dir"):
            scratch_root(session(master))
    assert scratch_root(SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs://x/c/"}, sparkContext=SimpleNamespace(master="yarn"))) == "hdfs://x/c"


def test_catalogue(spark, tmp_path):
    (tmp_path / "2019-Oct.csv").write_text("\n".join([
        "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session",
        "2019-10-01 00:00:01 UTC,view,p1,c1,,,0.00,1,s",
        "2019-10-01 00:00:02 UTC,view,p1,c9,toys.cars,acme,10.00,1,s",
        "2019-10-01 00:00:03 UTC,view,p1,c1,toys.boats,other,10.01,1,s",
        "2019-10-01 00:00:04 UTC,view,p2,c9,,,,1,s",
        "2019-10-01 00:00:05 UTC,view,p3,2053013563,,zeta,-5,1,s",
        "2019-10-01 00:00:06 UTC,view,,c1,x,x,1,1,s",
        "2019-10-01 00:00:07 UTC,view,p4,,x,x,1,1,s",
        "2019-10-01 00:00:08 UTC,view,p5,c1,x,x,1,1,s,one too many",
        "2019-10-01 00:00:09 UTC,view,p6,c1,x,x,not a price,1,s",
    ]) + "\n")
    rows_in = behaviour_csv(spark, str(tmp_path))
    assert {r.file for r in rows_in.select("file").distinct().collect()} == {"2019-Oct.csv"}
    got = rows(build_catalogue(rows_in))
    assert got == [
        ("p1", "c1", "toys.cars", "toys.cars", "acme", 10.01),
        ("p2", "c9", None, "toys.cars", "unknown", 0.01),
        ("p3", "2053013563", None, "category_20530135", "zeta", 0.01),
    ]
    path = str(tmp_path / "catalogue")
    for part in (build_catalogue(rows_in).filter("product_id = 'p1'"), build_catalogue(rows_in).withColumn("brand", F.lit("later"))):
        tables.insert_absent(part, path, "product_id")
    assert rows(spark.read.parquet(path).select("product_id", "brand")) == [("p1", "acme"), ("p2", "later"), ("p3", "later")]


def test_checks(spark):
    df = spark.createDataFrame([(1, "x", 5.0), (1, None, -1.0), (None, "y", None)], "id INT, s STRING, n DOUBLE")
    report = {(r.column, r.check): (r.failures, r.status) for r in check_table(df, "t", [
        Check("not_null", "id"), Check("unique", "id"), Check("accepted_values", "s", values=("x",)),
        Check("accepted_range", "n", low=0, severity="warn"), Check("accepted_range", "n", high=5, severity="warn")]).collect()}
    assert report[("id", "not_null")] == (1, "error") and report[("id", "unique")] == (1, "error")
    assert report[("s", "accepted_values")] == (1, "error")
    assert check_table(df, "t", [Check("accepted_range", "n", low=0, severity="warn")]).first().status == "warn"
    assert check_table(df, "t", [Check("accepted_range", "n", high=5)]).first().status == "pass"
    users = run_suite({"users": df.select("id")})
    assert users.count() == len(SUITES["users"])


def test_freshness(spark):
    df = days(spark, (3, "a", 1))
    as_of = F.lit("2024-01-04 00:00:00").cast("timestamp")
    r = freshness(df, "customer_snapshot", "day", as_of, FRESHNESS_MINUTES["customer_snapshot"]).first()
    assert (r.lag_minutes, r.is_fresh) == (1440, True)
    assert not freshness(df, "daily_sales", "day", as_of, FRESHNESS_MINUTES["daily_sales"]).first().is_fresh
    assert not freshness(df.limit(0), "daily_sales", "day", as_of, 60).first().is_fresh


def test_content_hash_sees_changes_but_not_order(spark):
    a = days(spark, (1, "a", 1), (2, "b", 2))
    assert content_hash(a).first() == content_hash(days(spark, (2, "b", 2), (1, "a", 1))).first()
    assert content_hash(a).first() != content_hash(days(spark, (2, "b", 3), (1, "a", 1))).first()


def test_empty_tables(spark, tmp_path):
    """An empty result leaves a table that the next refresh and append can build on."""
    path = str(tmp_path / "e")
    full = days(spark, (1, "a", 1))
    for since in (None, date(2024, 1, 1)):
        tables.refresh_window(full.filter("k = 'z'"), path, "day", since)
        assert spark.read.schema(full.schema).parquet(path).count() == 0 and not files.has_data(spark, path)
    tables.refresh_window(full, path, "day", date(2024, 1, 1))
    assert spark.read.parquet(path).count() == 1
    tables.refresh_window(full.filter("k = 'z'"), path, "day", date(2024, 1, 1))
    assert not files.has_data(spark, path)
    assert tables.append_snapshot(full, path, "day", date(2024, 1, 1))


def test_insert_absent_keeps_one_row_per_key(spark, tmp_path):
    path, rejects = str(tmp_path / "t"), str(tmp_path / "rejects")
    new = spark.createDataFrame([("a", 2), ("a", 1), (None, 3), ("b", None)], "k STRING, v INT")
    tables.insert_absent(new, path, "k", ["v"], rejects)
    tables.insert_absent(new, path, "k", ["v"])
    assert rows(spark.read.parquet(path)) == [("a", 1), ("b", None)]
    assert rows(spark.read.parquet(rejects)) == [(None, 3, "missing k")]
