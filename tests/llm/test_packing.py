import zlib

import numpy as np
import pytest
from cases import DOCS, edge_docs, stored
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cartwheel.llm import packing
from cartwheel.llm.tokenize import Encoder, default_path


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(default_path())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(), st.sampled_from(" \n\t\x0b\x0c\r\x1c\x1f\x85  　'sdabc1!.é"))))
@example("a <|endoftext|>b  <|endoftext|>  c <|endoftext|>")
@example("é" * 3000 + " " * 700 + "a" * 3000)
def test_ids_are_those_of_tokenizers(text):
    model, mine = test_ids_are_those_of_tokenizers.both
    assert np.frombuffer(mine.encode([text])[0], "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


test_ids_are_those_of_tokenizers.both = (Tokenizer.from_file(default_path()), Encoder(default_path()))


@pytest.mark.parametrize("extra", [False, True])
def test_round_trip(spark, tmp_path, model, extra):
    docs = edge_docs(spark, extra=extra)
    rows = packing.op2_pack_best_fit(spark, stored(docs, tmp_path)).collect()
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = model.encode(text or "", add_special_tokens=False).ids + [2]
        parts = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert sum(p.length for p in parts) == len(ids) and all(p.length == 1024 for p in parts[1:])
        at = 0
        for p in parts:
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at: at + p.length], "<u4").tobytes())
            at += p.length
    check_sequences(rows)


def check_sequences(rows):
    places: dict = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    return len(places)


def test_few_sequences_and_many_lanes(spark):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1024, 6000)
    cut = spark.createDataFrame([(i, 0, 0, int(n), i) for i, n in enumerate(lengths)],
                                "doc_id long, piece int, start long, length long, ids_crc32 long")
    used = check_sequences(packing.pack(cut, lane_pieces=2000).collect())
    assert used <= 1.04 * lengths.sum() / 1024  # evenly spread lengths: pieces above a half have few partners


def test_the_bound_acts_in_the_querys_own_path(spark, monkeypatch):
    """The lanes of the query, replayed from its rows in their order of arrival: the same places, and bins that close."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    cut = spark.createDataFrame([tuple(r) for r in packing.pieces(docs).collect()], "doc_id long, piece int, start long, length long, ids_crc32 long").cache()
    rows = [r for r in packing.pack(cut).collect() if r.length < 1024]
    assert len(rows) > 900 and {r.sequence_id >> packing._LANE_BITS for r in rows} == {0}
    fit = packing.BestFit(1024, packing.OPEN_BINS)
    lengths = np.array([r.length for r in rows])
    places = [fit.place_all(lengths[i: i + packing.HANDFUL]) for i in range(0, len(rows), packing.HANDFUL)]
    assert np.concatenate([p[0] for p in places]).tolist() == [r.sequence_id for r in rows]
    assert np.concatenate([p[1] for p in places]).tolist() == [r.offset for r in rows]
    for _ in range(8):  # a lane of the usual length
        for i in range(0, len(rows), packing.HANDFUL):
            fit.place_all(lengths[i: i + packing.HANDFUL])
    assert fit.closed > 0 and fit.open <= packing.OPEN_BINS
    assert fit.count <= 1.015 * 9 * lengths.sum() / 1024


def test_fullest_bin_closes_first():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # bin 1 (7 of 10) closed
    assert fit.place(3) == (0, 6) and fit.place(2) == (2, 8)


def test_no_rows_and_repeated_rows(spark):
    assert packing.pack_documents(spark.createDataFrame([], DOCS)).count() == 0
    docs = spark.createDataFrame([(1, "a b", None, None, 0)] * 3, DOCS)
    rows = packing.pack_documents(docs, with_ids=True).collect()
    assert len(rows) == 3 and check_sequences(rows) == 1 and all(len(r.ids) == 4 * r.length for r in rows)


@pytest.mark.parametrize("run", [" " * 2_000_000, "\n" * 2_000_000, " \n" * 60_000])
def test_very_long_white_space(model, run):
    for text in (f"a{run}b <|endoftext|> c", run):
        got = np.frombuffer(Encoder(default_path()).encode([text])[0], "<u4").tolist()
        assert got == model.encode(text, add_special_tokens=False).ids


def test_whole_pieces_and_rows_alike_need_no_common_lane(spark):
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    cut = spark.createDataFrame([(1, i, 1024 * i, 1024, i) for i in range(3000)] + [(2, 0, 0, 700, 5)] * 3000, schema).repartition(3)
    rows = packing.pack(cut, lane_pieces=100).collect()
    assert len(rows) == 6000 and check_sequences(rows) == 6000
    lanes = {r.sequence_id >> 24 for r in rows if r.length == 700}
    assert len(lanes) == 30 and all(r.sequence_id < 0 for r in rows if r.length == 1024)
