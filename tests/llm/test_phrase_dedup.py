import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from cases import DOCS, edge_docs, sentence, stored

from cartwheel.llm import phrase_dedup
from cartwheel.llm.textops import WORD_RE


def brute(rows, window=13):
    """{(id, text): (n_words, n_removed, sha256)}; a null id is greater than all."""
    first: dict = {}
    split = [(float("inf") if i is None else i, WORD_RE.findall(t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k: k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for (doc, _), (i, w) in zip(rows, split):
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k: k + window])] < i:
                gone |= set(range(k, k + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def passages(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(2000)] + ["ä", "b.", "c,"]
    shared = [sentence(rng, n, vocabulary) for n in (12, 13, 14, 30, 80)]
    rows = []
    for i in range(80):
        parts = [sentence(rng, rng.randint(0, 40), vocabulary), rng.choice(shared), sentence(rng, rng.randint(0, 5), vocabulary), rng.choice(shared)]
        rows.append((1000 - i, " ".join(parts), None, "s", 0))
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("extra,block_bytes,words,shard", [(False, 1 << 23, 30_000, 1 << 20), (True, 700, 7, 500)])
def test_against_brute_force(spark, tmp_path, extra, block_bytes, words, shard):
    docs = edge_docs(spark, extra=extra).select("doc_id", "text", "lang", "source", "n_chars").unionByName(passages(spark))
    docs = docs.unionByName(docs.filter("doc_id > 990")).unionByName(spark.createDataFrame([(None, "x " * 40, None, None, 0)] * 2, DOCS))
    df = spark.read.parquet(stored(docs, tmp_path) + "/documents.parquet")
    rows = phrase_dedup.without_phrases(df, ["doc_id"], block_bytes=block_bytes, automaton_words=words, shard_bytes=shard).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((tuple(r) for r in rows), key=repr) == want
    assert sum(w[2] for w in want) > 500


def test_query_and_texts(spark, tmp_path):
    docs = passages(spark)
    rows = phrase_dedup.op9_phrase_dedup(spark, stored(docs, tmp_path)).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == brute([(r.doc_id, r.text) for r in docs.collect()])
    for r in phrase_dedup.without_phrases(docs, docs.columns, with_text=True).collect():
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 and r.source == "s"


def test_automata_find_every_occurrence():
    rng = np.random.default_rng(2)
    tokens = rng.integers(0, 4, 3000).astype(np.uint32)
    phrases = np.unique(rng.integers(0, 4, (40, 4)).astype(np.uint32), axis=0)
    got = {(int(s), int(p)) for a, b in phrase_dedup.locate(tokens, phrases, 9) for s, p in zip(a, b)}
    want = {(i, p) for i in range(len(tokens) - 3) for p in range(len(phrases)) if (tokens[i: i + 4] == phrases[p]).all()}
    assert got == want


def test_passages_that_branch_and_repeat(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("aab") for _ in range(rng.randint(0, 60))), None, "s", 0) for i in range(40)]
    rows += [(50 + i, rows[i % 7][1] + " q " + "c " * i, None, "s", 0) for i in range(20)]
    docs = spark.createDataFrame(rows, DOCS)
    for words, block_bytes in ((9, 300), (1000, 1 << 20)):
        got = phrase_dedup.without_phrases(docs, ["doc_id"], window=5, block_bytes=block_bytes, automaton_words=words, shard_bytes=900).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute([r[:2] for r in rows], 5)


def test_the_automata_decide(spark, monkeypatch):
    """With empty automata nothing is found, and windows are neither hashed nor compared where phrases are located."""
    docs = passages(spark)
    want = {r.doc_id: r.n_removed for r in phrase_dedup.without_phrases(docs, ["doc_id"]).collect()}
    assert sum(want.values()) > 500
    stream = phrase_dedup._Stream([b"a b c d e f g h i j k l m n", b"x a b c d e f g h i j k l m"], 13)
    table = pa.table({"shard": [0, 0], "text": [b"a b c d e f g h i j k l m n", b"x a b c d e f g h i j k l m"], "low": [1, 2], "high": [1, 2]})
    made = phrase_dedup._confirmed(table, 13, 1000)
    with monkeypatch.context() as m:
        for name in ("window_keys", "RollingHash", "passages"):
            m.setattr(phrase_dedup, name, None)
        found = phrase_dedup._located(table.select(["shard", "text"]), made, 13)
        nothing = phrase_dedup._located(table.select(["shard", "text"]), made.slice(0, 0), 13)
    none = phrase_dedup._NO_ID
    assert [np.frombuffer(o, np.int64).tolist() for o in found["owners"].to_pylist()] == [[1, none], [none, 1]]
    assert found["key"].to_pylist() == [phrase_dedup._key(t) for t in table["text"].to_pylist()]
    assert nothing.num_rows == 0 and len(stream.starts) == 4


def test_segments_of_equal_windows_meet(spark):
    """Windows with the same words have the same anchor, wherever they stand."""
    docs = passages(spark)
    rows = [r.asDict() for r in phrase_dedup.blocks(docs, ["doc_id"], 3000).collect()]
    anchors: dict = {}
    for row in rows:
        b = phrase_dedup.Block(row, 13)
        first, n, anchor = b.segments(np.ones(len(b.starts), bool))
        assert n.sum() == len(b.starts)
        word = b.texts()
        for f, k, a in zip(first.tolist(), n.tolist(), anchor.tolist()):
            for i in b.starts[f: f + k].tolist():
                anchors.setdefault(tuple(word[t] for t in b.tokens[i: i + 13].tolist()), set()).add(a)
    assert len(anchors) > 1000 and all(len(a) == 1 for a in anchors.values())


def test_characters_tell_codes_and_digits_apart():
    codes = np.arange(70_000)
    text = phrase_dedup._characters(codes, 3)
    assert len({text[3 * i: 3 * i + 3] for i in codes}) == len(codes)
    assert not set(text[0::3]) & set(text[1::3]) and not set(text[1::3]) & set(text[2::3])


def test_no_rows(spark):
    assert phrase_dedup.without_phrases(spark.createDataFrame([], DOCS), ["doc_id"]).count() == 0
    assert [tuple(r)[:3] for r in phrase_dedup.without_phrases(spark.createDataFrame([(1, None, None, None, 0)], DOCS), ["doc_id"]).collect()] == [(1, 0, 0)]
