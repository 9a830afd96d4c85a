import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import vptree

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def brute(rows, k=20, every=20):
    good = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in good:
        if q % every == 0:
            pairs = sorted((-float(vptree.inner_products(v[None], good[q][None])[0]), i) for i, v in good.items()
                           if i != q and len(v) == len(good[q]))[:k]
            out[q] = [(i, -s) for s, i in pairs]
    return out


def random_rows(n, dim, seed=0, scale=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * (rng.uniform(0.2, 3, (n, 1)) if scale else 1)
    return [(i, [float(np.float32(v)) for v in r], 0) for i, r in enumerate(x)]


def result(df):
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_factor_one_is_exact(spark, tmp_path, monkeypatch):
    rows = random_rows(900, 6)
    rows += [(2000 + i, rows[40][1], 0) for i in range(60)]  # copies of one vector
    rows += [(3000, None, 0), (3020, [], 0), (3040, [0.0] * 6, 0), (3060, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0),
             (3080, [float("nan")] * 6, 0), (3100, [float("inf")] * 6, 0), (None, [1.0] * 6, 0), (3120, [1.0, 2.0], 0), (3121, [2.0, 1.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit("x")).withColumn("shard", F.lit("y"))
    monkeypatch.setattr(vptree, "LEAF", 16)
    for shard_rows in (200, 10**6):
        got = result(vptree.nearest(df, F.col("vec_id") % 20 == 0, factor=1.0, shard_rows=shard_rows))
        assert got == brute(rows)


def test_query_recall(spark, tmp_path):
    rows = random_rows(5000, 32, 3, scale=False)
    got, want = result(vptree.op10_vptree_search(spark, table(spark, tmp_path, rows))), brute(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert got.keys() == want.keys() and hits >= 0.9 * sum(map(len, want.values()))


def test_pruning_leaves_out_and_finds():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 3))
    tree = vptree.VPTree(x, float((x * x).sum(1).max()), leaf=32)
    best = np.argsort(-(x[:50] @ x.T), axis=1)[:, :10]
    exact = tree.nearest(x[:50], 10, 1.0).copy()
    assert all(set(a) == set(b) for a, b in zip(exact, best))


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], 0)], [(0, [1.0], 0), (0, [1.0], 0), (1, [2.0], 0)]])
def test_few_rows(spark, tmp_path, rows):
    got = result(vptree.op10_vptree_search(spark, table(spark, tmp_path, rows)))
    assert got == {q: p for q, p in brute(rows).items() if p}


def test_queries_stream_through_a_shard():
    """Answers come as the queries do: before the last of them are read, and without the answered ones being held."""
    rows = random_rows(2000, 8)
    x = np.array([v for _, v, _ in rows])

    def batch(asks, part):
        n = len(part)
        return pa.RecordBatch.from_arrays([pa.array([0] * n), pa.array([8] * n, pa.int32()), pa.array([asks] * n), pa.array(part, pa.int64()),
                                           pa.array(x[part].tolist(), pa.list_(pa.float64()))], names=["shard", "size", "asks", "vec_id", "embedding"])

    read = []

    def batches():
        for asks in (False, True):
            for start in range(0, 2000, 100):
                read.append(asks)
                yield batch(asks, list(range(start, start + 100)))

    answered, longest = 0, float((x * x).sum(axis=1).max())
    for out in vptree.answers(batches(), longest, 20, 1.0):
        answered += out.num_rows
        assert answered == 100 * sum(read)
    assert answered == 2000


def test_copies_of_queries_are_bounded():
    assert vptree.shard_count(0, 64) == 1 and vptree.shard_count(100_000, 64) == 13
    assert vptree.shard_count(20_000_000, 64) == 256
    assert 256 < vptree.shard_count(117_000_000, 64) < 500
