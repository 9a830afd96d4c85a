import random

import pytest
from conftest import SMALL, plan_of, rows, scanned_rows
from pyspark.sql import functions as F

from cartwheel.operators.changes import initial_rows, merge_changes, without_tombstones
from cartwheel.sinks import files, runs
from cartwheel.sinks.upkeep import list_files

SCHEMA = "op STRING, ts_ms BIGINT, id BIGINT, v STRING, is_deleted BOOLEAN, lsn BIGINT"


def changes(spark, *data):
    """(op, time, key, value) → flat changes; the log position follows the time."""
    return spark.createDataFrame([(op, ts, i, None if op == "d" else v, op == "d", ts * 10) for op, ts, i, v in data], SCHEMA)


def seen(df):
    return rows(df.select("id", "op", "ts_ms", "v", "is_deleted"))


def size(spark, path):
    return sum(r.length for r in list_files(spark, path).collect())


def random_batches(seed, n=6, keys=40):
    """Batches with one change per key each, times all different, many late."""
    rng = random.Random(seed)
    times = rng.sample(range(1000), n * keys)
    out = []
    for b in range(n):
        out.append([(rng.choice("cuuud"), times[b * keys + k], k, f"{b}-{k}") for k in range(keys) if b == 0 or rng.random() < 0.4])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_reads_do_not_depend_on_folding_or_order(spark, tmp_path, seed):
    batches = random_batches(seed)
    want = {}
    for op, ts, key, v in sorted((c for b in batches for c in b), key=lambda c: c[1]):
        if op == "d":
            if key in want:
                want[key] = (key, *want[key][1:2], ts, want[key][3], True)
        else:
            want[key] = (key, op, ts, v, False)
    deletes_first = {c[2] for b in batches for c in b if c[0] == "d"} - set(want)
    assert len(want) > 20 and not deletes_first & set(want)
    rng = random.Random(seed)
    for attempt in range(2):
        path = str(tmp_path / f"t{attempt}")
        order = list(enumerate(batches))
        rng.shuffle(order)
        for number, batch in order:
            runs.write_run(changes(spark, *batch), path, "id", 4, f"b{number}")
            if attempt and rng.random() < 0.7:
                runs.fold_runs(spark, path, "id", [F.col("ts_ms"), F.col("id")], fan_in=2, base_share=rng.choice([0.1, 0.5, 9]))
            if attempt and rng.random() < 0.3:
                runs.write_run(changes(spark, *batch), path, "id", 4, f"b{number}")  # the batch is repeated
        assert seen(runs.read_runs(spark, path, "id")) == sorted(want.values(), key=repr)


def test_same_live_rows_as_the_merge(spark, tmp_path):
    batches = random_batches(3)
    path, table = str(tmp_path / "t"), None
    for number, batch in enumerate(batches):
        df = changes(spark, *batch)
        table = initial_rows(df) if table is None else merge_changes(table, df, "id")
        runs.write_run(df, path, "id", 4, f"b{number}")
    live = "not is_deleted"
    assert seen(runs.read_runs(spark, path, "id").filter(live)) == seen(without_tombstones(table).filter(live))


def test_bytes_written_follow_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    big = spark.range(200_000).selectExpr("'c' as op", "1L as ts_ms", "id", "sha2(cast(id as string), 256) as v", "false as is_deleted", "id as lsn")
    runs.write_run(big, path, "id", 4, "b0")
    before = size(spark, path)
    runs.write_run(changes(spark, ("u", 2, 7, "x"), ("d", 2, 8, None)), path, "id", 4, "b1")
    assert size(spark, path) - before < before / 500
    assert runs.fold_runs(spark, path, "id") == {"base": 4, "tier": 0}          # the first load; the last batch is left alone
    for number in range(2, 8):
        runs.write_run(changes(spark, ("u", number, 7, "x"), ("u", number, 8, "y")), path, "id", 4, f"b{number}")
    before = {r.path for r in list_files(spark, path).collect()}
    folded = runs.fold_runs(spark, path, "id")
    assert folded["base"] == 0 and folded["tier"] in (1, 2)                      # few small runs do not touch the base
    written = [r for r in list_files(spark, path).collect() if r.path not in before]
    assert sum(r.length for r in written) < 20_000
    got = {r.id: r for r in runs.read_runs(spark, path, "id").filter("id in (7, 8, 9)").collect()}
    assert (got[7].v, got[8].v, got[8].is_deleted, got[9].ts_ms) == ("x", "y", False, 1)


def test_a_fold_that_died_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for number, batch in enumerate(random_batches(4)):
        runs.write_run(changes(spark, *batch), path, "id", 2, f"b{number}")
    want = seen(runs.read_runs(spark, path, "id"))
    for where in ("move", "each"):  # before anything is published, and before anything is deleted
        with monkeypatch.context() as m:
            m.setattr(files, where, lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                runs.fold_runs(spark, path, "id", base_share=0)
        assert seen(runs.read_runs(spark, path, "id")) == want
    assert runs.fold_runs(spark, path, "id", base_share=9) == {"base": 0, "tier": 0}  # only what was left is done
    assert seen(runs.read_runs(spark, path, "id")) == want and not files.exists(spark, f"{path}/_fold")
    bases, left, stale = runs._layout(spark, path)
    assert len(bases) == 2 and len(left) <= 2 and stale == []


def test_unchanged_buckets_are_not_compared(spark, tmp_path):
    path = str(tmp_path / "t")
    runs.write_run(changes(spark, *[("c", 1, i, "a") for i in range(40)]), path, "id", 4, "b0")
    runs.write_run(changes(spark, ("u", 2, 1, "b")), path, "id", 4, "b1")
    runs.fold_runs(spark, path, "id")
    state = runs.read_runs(spark, path, "id").filter("ts_ms >= 0")
    assert rows(state.filter("ts_ms = 2").select("id", "v")) == [(1, "b")] and state.count() == 40
    one = max(r["count"] for r in runs.read_state(spark, path, "id").groupBy("bucket_4").count().collect())
    assert scanned_rows(spark, state, "v") <= 40 + one + 1                       # only one bucket is read twice


def test_bucket_count_is_part_of_the_table(spark, tmp_path):
    path, other = str(tmp_path / "t"), str(tmp_path / "u")
    for number, batch in enumerate(random_batches(5)):
        runs.write_run(changes(spark, *batch), path, "id", 2, f"b{number}")
    with pytest.raises(ValueError, match="2 buckets|3 buckets"):
        runs.write_run(changes(spark, ("c", 1, 1, "a")), path, "id", 3, "b9")
    runs.rebuild(runs.read_state(spark, path, "id"), other, "id", 5, [F.col("ts_ms")])
    assert seen(runs.read_runs(spark, other, "id")) == seen(runs.read_runs(spark, path, "id"))
    runs.write_run(changes(spark, ("u", 5000, 1, "new")), other, "id", 5, "b9")
    assert runs.read_runs(spark, other, "id").filter("id = 1").first().v == "new"
    with pytest.raises(ValueError, match="already"):
        runs.rebuild(runs.read_state(spark, path, "id"), other, "id", 5)


def test_columns_may_be_added(spark, tmp_path):
    path = str(tmp_path / "t")
    runs.write_run(changes(spark, ("c", 1, 1, "a"), ("c", 1, 2, "a")), path, "id", 1, "b0")
    runs.write_run(changes(spark, ("u", 2, 2, "b")).selectExpr("*", "7 as w"), path, "id", 1, "b1")
    want = [(1, "a", None), (2, "b", 7)]
    assert rows(runs.read_runs(spark, path, "id").select("id", "v", "w")) == want
    runs.fold_runs(spark, path, "id", base_share=0)
    assert rows(runs.read_runs(spark, path, "id").select("id", "v", "w")) == want
    runs.write_run(changes(spark, ("c", 3, 3, "c")).selectExpr("*", "8 as w"), path, "id", 1, "b2")
    runs.fold_runs(spark, path, "id", base_share=0)
    assert rows(runs.read_runs(spark, path, "id").select("id", "v", "w")) == [*want, (3, "c", 8)]


def test_empty_batch_and_single_run(spark, tmp_path):
    path = str(tmp_path / "t")
    runs.write_run(changes(spark, ("c", 1, 1, "a"), ("d", 1, 2, None)), path, "id", 2, "b0")
    runs.write_run(changes(spark, ("c", 1, 1, "a")).limit(0), path, "id", 2, "b1")
    assert runs.fold_runs(spark, path, "id") == {"base": 0, "tier": 0}
    assert seen(runs.read_runs(spark, path, "id")) == [(1, "c", 1, "a", False)]
    assert runs.is_runs(spark, path) and not runs.is_runs(spark, str(tmp_path))


def test_the_curve_is_cut_by_stored_rows(spark, tmp_path, monkeypatch):
    """Folding looks at the runs as they lie there for the curve, without merging them once more for it."""
    plans, curve = [], runs.along_curve

    def seen(rows, columns):
        plans.append(plan_of(rows))
        return curve(rows, columns)

    monkeypatch.setattr(runs, "along_curve", seen)
    path = str(tmp_path / "t")
    for number in range(3):
        changes = spark.range(50).selectExpr("id", "'u' as op", f"id + {number} as ts_ms", "id as lsn", "false as is_deleted", f"{number} as v")
        runs.write_run(changes, path, "id", 2, f"batch-{number}")
    assert runs.fold_runs(spark, path, "id", [F.col("ts_ms"), F.col("id")], base_share=0)["base"] == 2
    assert len(plans) == 1 and "Aggregate" not in plans[0] and "Exchange" not in plans[0]
    assert sorted((r.id, r.v) for r in runs.read_runs(spark, path, "id").collect()) == [(i, 2) for i in range(50)]


@pytest.mark.parametrize("query,source", [("c2_versioned_feed", "orders"), ("c8_incremental_job", "orders"), ("c7_folded_tiers", "orders"),
                                          ("c7_folded_base", "orders"), ("t1_compacted_silver", "clicks"), ("e3_late_events", "clicks")])
def test_parts_of_a_feed_come_from_stored_rows(spark, monkeypatch, query, source):
    """The joins below a feed that is read part by part run once."""
    from cartwheel.inventory import QUERIES
    from cartwheel.sources import domain

    calls, made = [], getattr(domain, source)
    monkeypatch.setattr(domain, source, lambda *a: calls.append(a) or made(*a))
    QUERIES[query].run(spark, SMALL)
    assert len(calls) == 1
