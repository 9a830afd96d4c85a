"""The stages on a small corpus, against what each is for."""

import re

import pytest
from cases import DOCS, edge_docs, stored
from test_packing import check_sequences
from test_suffix_dedup import brute, passages

import corpus_pipeline
from cartwheel.llm.textops import WORD


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Documents before the first and after every stage."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = passages(spark, 60).unionByName(edge_docs(spark)).unionByName(passages(spark, 60).selectExpr("doc_id + 500 as doc_id", "text", "lang", "source", "n_chars"))
    sf_dir = stored(docs, folder)
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, out[-1], sf_dir)
        df.write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return sf_dir, out


def test_columns(stages):
    assert all(df.columns == corpus_pipeline.COLUMNS for df in stages[1][:-1])


def test_every_stage_takes_effect(spark, stages):
    raw, good, single, cut, mixed, packed = [df.collect() for df in stages[1]]
    assert all(len(re.findall(WORD, r.text)) >= 20 for r in good) and len(good) < len(raw)
    ids = {r.doc_id for r in single}
    assert len(ids) == len(single) < len(good) and not ids & set(range(1500, 1560))  # the copies had the greater ids
    # what is left, and how many bytes of cut characters may go besides
    want = {i: (n - gone, 6 * spans) for i, n, gone, spans, _ in brute([(r.doc_id, r.text) for r in single], corpus_pipeline.PASSAGE_BYTES)}
    assert {r.doc_id for r in cut} == {i for i, (n, _) in want.items() if n}
    assert all(want[r.doc_id][0] - want[r.doc_id][1] <= len(r.text.encode()) <= want[r.doc_id][0] for r in cut)

    def words(rows):
        return sum(len(re.findall(WORD, r.text)) for r in rows)

    assert abs(words(mixed) - 1.5 * words(cut)) <= 10 and {r.doc_id for r in mixed} <= {r.doc_id for r in cut}
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed} and check_sequences(packed)


def test_run_is_the_stages(spark, stages):
    sf_dir, out = stages
    assert corpus_pipeline.run(spark, sf_dir).count() == out[-1].count()


def test_no_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, stored(spark.createDataFrame([], DOCS), tmp_path)).count() == 0
