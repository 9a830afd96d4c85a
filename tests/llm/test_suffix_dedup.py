import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import DOCS, edge_docs, sentence, stored

from cartwheel.llm import suffix_dedup


def brute(rows, length=400):
    """[(id, n_bytes, n_removed, n_spans, sha256)]."""
    seen: Counter = Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, t in raw:
        seen.update(t[k: k + length] for k in range(len(t) - length + 1))
    out = []
    for i, t in raw:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k: k + length]] > 1:
                gone[k: k + length] = b"\1" * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(spark, n=70, seed=8):
    """Texts that share passages a little shorter and longer than the length, whole or cut, with near copies."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)] + ["ä", "é.", "c,"]
    # not all of one byte length per word, so that borders fall anywhere
    shared = [sentence(rng, 400, vocabulary)[:size] for size in (250, 360, 398, 399, 400, 401, 430, 700, 1500)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts.append(sentence(rng, rng.randint(0, 60), vocabulary))
            passage = rng.choice(shared)
            if rng.random() < 0.3:
                cut = rng.randrange(len(passage))
                passage = passage[:cut] + "#" + passage[cut + 1:]
            elif rng.random() < 0.3:
                passage = passage[rng.randrange(60):]
            parts.append(passage)
        rows.append((i + 1000, rng.choice(["", " "]).join(parts), None, "s", 0))
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("extra,block_bytes", [(False, 1 << 23), (True, 3000)])
def test_against_brute_force(spark, tmp_path, extra, block_bytes):
    docs = edge_docs(spark, extra=extra).select("doc_id", "text", "lang", "source", "n_chars").filter("length(text) < 20000 or text is null")
    docs = docs.unionByName(passages(spark)).unionByName(spark.createDataFrame([(None, "y" * 399, None, None, 0)], DOCS))
    df = spark.read.parquet(stored(docs, tmp_path) + "/documents.parquet")
    rows = suffix_dedup.deduplicated(df, ["doc_id"], block_bytes).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((tuple(r) for r in rows), key=repr) == want
    assert sum(w[2] for w in want) > 10_000 and any(w[3] > 2 for w in want)


def test_very_long_texts_against_brute_force(spark):
    """Texts of hundreds of thousands of bytes, longer than a piece and a block, that share passages with each other."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(5000)]
    shared = sentence(rng, 300, words)
    texts = [sentence(rng, 40_000, words) + shared + sentence(rng, n, words) for n in (10, 20_000)] + ["x" + shared[100:900] + "y", "z" * 70_000]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], DOCS)
    got = suffix_dedup.deduplicated(docs, ["doc_id"], 50_000).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(list(enumerate(texts)))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_query_on_many_partial_repeats(spark, tmp_path, seed):
    docs = passages(spark, 120, seed)
    rows = suffix_dedup.op1_suffix_dedup(spark, stored(docs.repartition(3), tmp_path)).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("length", [256, 101])
def test_other_lengths(spark, length):
    docs = passages(spark, 60, 5).unionByName(edge_docs(spark).filter("length(text) < 3000 or text is null"))
    rows = suffix_dedup.deduplicated(docs, ["doc_id"], 20_000, length=length).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == brute([(r.doc_id, r.text) for r in docs.collect()], length)


def test_passages_of_fifty_words_go(spark):
    """The length of the pipeline's stage: passages of 51 words and more go whole, those of 20 stay."""
    import corpus_pipeline

    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 10))) for _ in range(4000)]
    long, short = [[sentence(rng, n, words) for _ in range(20)] for n in (51, 20)]
    rows = [(i, " | ".join([f"{i} " + sentence(rng, 30, words), long[i % 20], sentence(rng, 30, words), short[i % 20], f"end {i}"]), "en", "s", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    for r in corpus_pipeline.repeated_passages(spark, docs, "").collect():
        assert long[r.doc_id % 20] not in r.text and short[r.doc_id % 20] in r.text


def test_one_passage_in_every_text(spark):
    """A hot passage whose suffixes fill several buckets: equals across boundaries are found."""
    rng = random.Random(4)
    passage = sentence(rng, 200, [f"w{i}" for i in range(500)])
    rows = [(i, f"{rng.random()}{passage[:380 + i % 40]}{rng.random()}", None, None, 0) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    got = suffix_dedup.deduplicated(docs, ["doc_id"], 4000).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute([(r[0], r[1]) for r in rows])


def test_anchors_do_not_depend_on_the_pieces():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 110, 30_000).astype(np.uint8)
    text[5000:9000] = 120
    for offsets in ([0, 30_000], [0, 399, 400, 12_000, 30_000]):
        whole = suffix_dedup.anchors(text, np.array(offsets))
        pieces = suffix_dedup.anchors(text, np.array(offsets), 1500)
        assert all((a == b).all() for a, b in zip(whole, pieces))


def test_multikey_sort():
    tokens = np.random.default_rng(3).integers(0, 3, (500, 4)).astype(np.uint64)
    order, segment = suffix_dedup.multikey_sort(tokens)
    rows = [tuple(t) for t in tokens[order].tolist()]
    assert rows == sorted(rows)
    assert all((a == b) == (s == t) for a, b, s, t in zip(rows, rows[1:], segment, segment[1:]))


def test_texts_that_remain(spark):
    docs = passages(spark, 30).withColumn("n_chars", __import__("pyspark").sql.functions.length("text"))
    want = {i: h for i, _, _, _, h in brute([(r.doc_id, r.text) for r in docs.collect()])}
    rows = suffix_dedup.without_repeats(docs).collect()
    assert len(rows) == 30 and all(r.n_chars == len(r.text) for r in rows)
    assert sum(hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id] for r in rows) >= 25


def test_small_tables(spark):
    assert suffix_dedup.deduplicated(spark.createDataFrame([], DOCS), ["doc_id"]).count() == 0
    for texts in ([(1, None)], [(1, "a" * 400)], [(1, "a" * 401)], [(1, "ab" * 300), (1, "ab" * 300)]):
        docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in texts], DOCS)
        assert sorted((tuple(r) for r in suffix_dedup.deduplicated(docs, ["doc_id"]).collect()), key=repr) == brute(texts)


def test_only_cut_characters_go(spark):
    """A removal that ends inside a character takes its rest, and the replacement characters of the text stay."""
    rng = random.Random(8)
    passage = " ".join(f"w{rng.randrange(10**6)}" for _ in range(80))
    docs = spark.createDataFrame([(i, f"own {i} � {i} ñ {passage} {end} tail {i} �", "en", "s", 0) for i, end in enumerate("éèê")], DOCS)
    texts = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs).collect()}
    cut = {i: text for i, text in texts.items() if passage not in text}
    assert len(cut) >= 2 and cut == {i: f"own {i} � {i} tail {i} �" for i in cut}
