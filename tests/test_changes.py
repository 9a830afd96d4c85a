import json
import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from cartwheel.operators import changes as ops
from cartwheel.schemas import change_schema
from cartwheel.sinks import files
from cartwheel.sinks.runs import read_runs
from cartwheel.sinks.tables import read_keyed, upsert
from cartwheel.streaming.changes import run_change_feed

ROW = "op STRING, ts_ms BIGINT, id INT, status STRING, is_deleted BOOLEAN"


def table(spark, *events):
    return spark.createDataFrame([(op, ts, key, status, op == "d") for op, ts, key, status in events], ROW)


def state(df):
    return {r.id: (r.op, r.ts_ms, r.status, r.is_deleted) for r in df.collect()}


def test_merge_rules(spark):
    target = table(spark, ("c", 10, 1, "old"), ("c", 10, 2, "old"), ("c", 10, 3, "old"), ("c", 10, 4, "old"))
    batch = table(spark, ("u", 20, 1, "new"), ("d", 20, 2, None), ("u", 5, 3, "late"), ("c", 20, 5, "born"),
                  ("d", 20, 6, None), (None, 20, 7, "no op"))
    merged = ops.merge_changes(target, batch, "id")
    assert state(merged) == {
        1: ("u", 20, "new", False), 2: ("c", 20, "old", True), 3: ("c", 10, "old", False), 4: ("c", 10, "old", False),
        5: ("c", 20, "born", False), 6: ("d", 20, None, True)}
    unguarded = state(ops.merge_changes(target, batch, "id", guard=False))
    assert unguarded[3] == ("u", 5, "late", False) and 6 not in unguarded
    assert sorted(state(ops.without_tombstones(merged))) == [1, 2, 3, 4, 5]
    late = ops.merge_changes(merged, table(spark, ("c", 15, 6, "before its delete")), "id")
    assert state(late)[6] == ("d", 20, None, True)
    revived = ops.merge_changes(merged, table(spark, ("u", 30, 2, "back")), "id")
    assert state(revived)[2] == ("u", 30, "back", False)
    assert rows(ops.live(merged).select("id")) == [(1,), (3,), (4,), (5,)]


def test_merging_twice_changes_nothing_and_order_does_not_matter(spark):
    rng = random.Random(5)
    events = [(rng.choice("cuud"), ts, rng.randrange(40), f"s{ts}") for ts in range(400)]
    target = ops.initial_rows(ops.latest_per_key(table(spark, *events[:200]), "id", ("ts_ms",)))
    batch = events[200:]
    shuffled = rng.sample(batch, len(batch))
    one, two = (ops.latest_per_key(table(spark, *b), "id", ("ts_ms",)) for b in (batch, shuffled))
    once = ops.merge_changes(target, one, "id")
    assert state(once) == state(ops.merge_changes(target, two, "id"))
    assert state(once) == state(ops.merge_changes(once, one, "id"))


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"),
                                    F.col("id").alias("ts_ms"), F.lit(0).alias("lsn"))
    latest = ops.latest_per_key(df, "id")
    plan = plan_of(latest)
    assert plan.count("WindowGroupLimit") == 2
    assert latest.filter("id = 7").first().ts_ms == 9999


def test_upsert_touches_only_its_buckets_and_replays(spark, tmp_path):
    path, stage = str(tmp_path / "t"), str(tmp_path / "stage")
    upsert(table(spark, *[("c", 1, i, "a") for i in range(200)]), path, "id", buckets=16)
    before = {f.path: f.modificationTime for f in files_of(spark, path)}
    change = table(spark, ("u", 2, 7, "b"), ("d", 2, 8, None))
    upsert(change, path, "id", buckets=16, stage=stage)
    after = {f.path: f.modificationTime for f in files_of(spark, path)}
    assert 14 <= len(set(before) & set(after)) < 16
    want = state(read_keyed(spark, path))
    assert want[7] == ("u", 2, "b", False) and want[8] == ("c", 2, "a", True) and len(want) == 200
    # the job died while replacing buckets: one is gone, the stage is complete
    bucket = next(n for n in files.subfolders(spark, path) if n.startswith("bucket_16=") and
                  spark.read.parquet(f"{path}/{n}").filter("id = 7").count())
    files.delete(spark, f"{path}/{bucket}")
    upsert(change, path, "id", buckets=16, stage=stage)
    assert state(read_keyed(spark, path)) == want
    with pytest.raises(ValueError, match="buckets"):
        upsert(change, path, "id", buckets=8)


def files_of(spark, path):
    from cartwheel.sinks.upkeep import list_files
    return list_files(spark, path).collect()


def event(op, ts, key, status, lsn=None, keyless=False):
    image = {"id": None if keyless else key, "status": status, "total_amount": 12.345}
    return {"before": image if op == "d" else None, "after": None if op == "d" else image, "op": op, "ts_ms": ts,
            "source": {"lsn": lsn or ts, "table": "orders"}}


def land(root, name, lines):
    folder = root / "landing" / "year=2024" / "month=01" / "day=01"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def test_incremental_job(spark, tmp_path):
    where = dict(landing=str(tmp_path / "landing"), silver=str(tmp_path / "silver"), checkpoint=str(tmp_path / "cp"),
                 rejects=str(tmp_path / "rejects"), buckets=4)
    land(tmp_path, "a.json", [event("c", 1, 1, "a"), event("c", 1, 2, "a"), event("c", 1, 3, "a"), "{broken",
                              event("u", 5, 9, "lost", keyless=True)])
    assert sum(run_change_feed(spark, "orders", **where).values()) == 3
    assert run_change_feed(spark, "orders", **where) == {}          # nothing new
    land(tmp_path, "b.json", [event("u", 3, 1, "late tie", lsn=3), event("u", 3, 1, "tie wins", lsn=4),
                              event("d", 4, 2, None), event("u", 0, 3, "too old")])
    assert sum(run_change_feed(spark, "orders", **where).values()) == 3
    silver = read_runs(spark, where["silver"], "id")
    assert state(silver) == {1: ("u", 3, "tie wins", False), 2: ("c", 4, "a", True), 3: ("c", 1, "a", False)}
    assert float(silver.filter("id = 1").first().total_amount) == 12.35              # doubles become cents, half up
    rejected = spark.read.parquet(where["rejects"])
    assert sorted(r.reject_reason for r in rejected.collect()) == ["malformed", "missing id"]


def test_offsets_that_begin_again(spark, tmp_path):
    """Batch numbers repeat after a reset; the changes of the new batches must still be merged."""
    where = dict(landing=str(tmp_path / "landing"), silver=str(tmp_path / "silver"), checkpoint=str(tmp_path / "cp"), buckets=4)
    land(tmp_path, "a.json", [event("c", 1, 1, "a"), event("c", 1, 2, "a")])
    run_change_feed(spark, "orders", **where)
    (tmp_path / "cp" / "offsets").rename(tmp_path / "old-offsets")
    land(tmp_path, "b.json", [event("u", 5, 1, "b"), event("c", 5, 3, "b")])
    run_change_feed(spark, "orders", **where)
    assert state(read_runs(spark, where["silver"], "id")) == {1: ("u", 5, "b", False), 2: ("c", 1, "a", False), 3: ("c", 5, "b", False)}


def test_the_log_position_decides_ties_across_batches(spark, tmp_path):
    where = dict(landing=str(tmp_path / "landing"), silver=str(tmp_path / "silver"), checkpoint=str(tmp_path / "cp"), buckets=4)
    land(tmp_path, "a.json", [event("u", 7, 1, "later in the log", lsn=9)])
    run_change_feed(spark, "orders", **where)
    land(tmp_path, "b.json", [event("u", 7, 1, "earlier in the log", lsn=8), event("c", 1, 3_000_000_000, "large id"),
                              event("c", 1, 2**64, "id too large")])
    run_change_feed(spark, "orders", **where)
    assert state(read_runs(spark, where["silver"], "id")) == {1: ("u", 7, "later in the log", False), 3_000_000_000: ("c", 1, "large id", False)}
    rejected = spark.read.parquet(str(tmp_path / "cp" / "rejects"))
    assert [r.reject_reason for r in rejected.collect()] == ["malformed"]


def test_nothing_landed_is_no_error(spark, tmp_path):
    where = dict(landing=str(tmp_path / "none"), silver=str(tmp_path / "silver"), checkpoint=str(tmp_path / "cp"))
    assert run_change_feed(spark, "orders", **where) == {}
    assert not (tmp_path / "silver").exists()


def test_key_without_before_image(spark):
    feed = spark.createDataFrame([("c", 1, (3, "x"))], "op STRING, ts_ms BIGINT, after STRUCT<id: INT, status: STRING>")
    assert rows(ops.flatten(feed).select("id", "status", "is_deleted")) == [(3, "x", False)]


def test_every_captured_table_has_a_schema(spark):
    for name in ("orders", "products", "users"):
        assert spark.createDataFrame([], change_schema(name)).columns[0] == "before"


def test_deletes_of_unknown_keys_only(spark, tmp_path):
    path, stage = str(tmp_path / "t"), str(tmp_path / "s")
    for _ in range(2):
        upsert(table(spark, ("d", 1, 1, None)), path, "id", buckets=4, stage=stage)
    assert state(read_keyed(spark, path)) == {}
    upsert(table(spark, ("c", 0, 1, "before its delete")), path, "id", buckets=4)
    assert state(read_keyed(spark, path)) == {}
    upsert(table(spark, ("c", 2, 1, "a")), path, "id", buckets=4)
    assert state(read_keyed(spark, path)) == {1: ("c", 2, "a", False)}
    upsert(table(spark, ("d", 1, 9, None)), str(tmp_path / "u"), "id", buckets=4, guard=False)
    assert not files.exists(spark, str(tmp_path / "u"))


def test_live_rows_do_not_depend_on_the_batches(spark, tmp_path):
    rng = random.Random(8)
    events = [(rng.choice("cuudd"), ts, rng.randrange(12), f"s{ts}") for ts in range(60)]
    rng.shuffle(events)                                             # they arrive in any order
    states = []
    for size in (60, 25, 9):
        path = str(tmp_path / str(size))
        for at in range(0, len(events), size):
            upsert(ops.latest_per_key(table(spark, *events[at:at + size]), "id", ("ts_ms",)), path, "id", buckets=2)
        states.append(state(ops.live(read_keyed(spark, path))))
    assert states[0] and states[0] == states[1] == states[2]


def test_buckets_are_sorted_by_the_chosen_column(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(table(spark, *[("c", 1, i, f"{i * 37 % 100:02d}") for i in range(100)]), path, "id", buckets=2, sort_by="status")
    upsert(table(spark, *[("u", 2, i, f"{i * 53 % 100:02d}") for i in range(0, 100, 3)]), path, "id", buckets=2, sort_by="status")
    for file in files_of(spark, path):
        stored = [r.status for r in spark.read.parquet(file.path).collect()]
        assert stored == sorted(stored) and len(stored) > 10
