import re

import pytest
from cases import DOCS, edge_docs, stored

from cartwheel.llm import mixing


def brute_targets(sizes: dict, percent=150):
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want = sum(sizes.values()) * percent / 100
    full = set()
    while True:
        open_ = [s for s in names if s not in full]
        left = want - sum(2 * sizes[s] for s in full)
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * level > 2 * sizes[s] + 1e-9]
        if not over:
            return {s: 2 * sizes[s] if s in full else weight[s] * level for s in names}
        full |= set(over)


@pytest.mark.parametrize("extra", [False, True])
def test_against_brute_force(spark, tmp_path, extra):
    docs = edge_docs(spark, extra=extra)
    rows = mixing.op3_mix_sources(spark, stored(docs, tmp_path)).collect()
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    sizes: dict = {}
    for text, source in texts.values():
        sizes[source] = sizes.get(source, 0) + len(re.findall(mixing.WORD, text or ""))
    want = brute_targets(sizes)
    assert len(rows) == len(texts)
    taken: dict = {}
    for r in rows:
        assert r["size"] == len(re.findall(mixing.WORD, texts[r.doc_id][0] or ""))
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: int(t + 1e-9) for s, t in want.items()}


def test_slices_agree_with_one_slice(spark):
    sized = mixing.sizes(edge_docs(spark))
    many = mixing.mix(sized, slice_docs=3).select("doc_id", "taken").collect()
    assert sorted(many) == sorted(mixing.mix(sized, slice_docs=10**6).select("doc_id", "taken").collect())


def test_repeated_ids_and_no_rows(spark):
    docs = edge_docs(spark)
    twice = mixing.mix(mixing.sizes(docs.unionByName(docs)))
    assert twice.count() == 2 * docs.count()
    assert mixing.mix(mixing.sizes(spark.createDataFrame([], DOCS))).count() == 0
    empty = spark.createDataFrame([(1, None, None, "a", 0), (2, "", None, "b", 0)], DOCS)
    assert {r.taken for r in mixing.mix(mixing.sizes(empty)).collect()} == {0}


def test_a_third_without_ids_spreads_over_the_slices(spark, tmp_path):
    from pyspark.sql import functions as F

    docs = spark.range(12_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
                                      F.when(F.col("id") % 6 > 0, F.concat(F.lit("w "), F.col("id").cast("string"))).alias("text"),
                                      F.lit("en").alias("lang"), F.when(F.col("id") % 2 == 0, "hot").alias("source"), F.lit(0).cast("bigint").alias("n_chars"))
    folder = stored(docs, tmp_path)
    sized = mixing.sizes(spark.read.parquet(f"{folder}/documents.parquet"))
    got = mixing.mix(sized, slice_docs=200, ties=("digest",))
    keys = sized.withColumn("k", mixing.shuffle_key(F.col("doc_id"), otherwise=F.col("digest"))).filter("size > 0")
    assert keys.groupBy(F.floor(F.col("k") / F.lit(2**mixing.KEY_BITS / 60))).count().agg(F.max("count")).first()[0] < 300
    import duckdb

    db = duckdb.connect()
    db.execute(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    columns = ["doc_id", "size", "source", "source_size", "target", "taken"]
    want = db.execute(f"select {', '.join(columns)} from ({mixing.SQL})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.select(columns).collect())


def test_first_words_keep_white_space(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(" a  b\n c d ",)], "t string").select(mixing.first_words(F.col("t"), F.lit(3)).alias("x")).first()
    assert row.x == " a  b\n c"


def test_no_python_in_the_plan(spark):
    from conftest import plan_of

    df = mixing.mix(mixing.sizes(edge_docs(spark)))
    df.collect()
    assert "Python" not in plan_of(df) and "Arrow" not in plan_of(df) and "CartesianProduct" not in plan_of(df)


def test_documents_of_the_mix(spark):
    docs = edge_docs(spark, extra=True)
    docs = docs.unionByName(docs.filter("doc_id in (20, 21)"))
    got: dict = {}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        got.setdefault(r.doc_id, []).append(r.text)
    once = docs.dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in docs.collect()}
    # a repeated row weighs twice in its source, so the targets are those of all rows
    for i, parts in got.items():
        n = len(re.findall(mixing.WORD, texts[i]))
        taken = sum(len(re.findall(mixing.WORD, p)) for p in parts)
        assert taken <= 2 * n * (2 if i in (20, 21) else 1) and all(texts[i].startswith(p) for p in parts)
    total = sum(len(re.findall(mixing.WORD, t or "")) for t in [*texts.values(), texts[20], texts[21]])
    words = sum(len(re.findall(mixing.WORD, p)) for parts in got.values() for p in parts)
    assert once.count() < docs.count() and abs(words - 1.5 * total) <= 20
    assert mixing.mixed_documents(spark.createDataFrame([], DOCS)).count() == 0
