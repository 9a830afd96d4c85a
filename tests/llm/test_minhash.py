import random

import numpy as np
import pyarrow as pa
import pytest
from cases import DOCS, edge_docs, sentence, stored

from cartwheel.llm import minhash
from cartwheel.llm.textops import WORD_RE


def brute_set(text, k=5):
    words = WORD_RE.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, percent=85):
    """{row number: (n_shingles, component_id)}"""
    sets = [brute_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for shingle in s:
            holders.setdefault(shingle, []).append(i)
    for i, s in enumerate(sets):
        shared = {}
        for shingle in s:
            for j in holders[shingle]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                root[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)] = min(doc, ids.get(find(i), doc))
    return [(doc, len(sets[i]), ids.get(find(i)), doc == ids.get(find(i))) for i, (doc, _) in enumerate(rows)]


def same(df, rows, percent=85):
    got = [tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()]
    assert sorted(got, key=repr) == sorted(brute(rows, percent), key=repr)


def copies(rng, groups=12, size=10, n=120):
    """Groups of texts that differ in some words: pairs on both sides of the limit, and chains."""
    out = []
    for _ in range(groups):
        text = [f"w{rng.randrange(900)}" for _ in range(n)]
        chain = rng.random() < 0.5
        for _ in range(size):
            copy = list(text)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(n)] = f"X{rng.randrange(99)}"
            out.append(" ".join(copy))
            if chain:
                text = copy
    return out


@pytest.mark.parametrize("extra", [False, True])
def test_query_against_brute_force(spark, tmp_path, extra):
    docs = edge_docs(spark, extra=extra)
    rng = random.Random(4)
    more = [(1000 + i, text, "en", "s", 0) for i, text in enumerate(copies(rng) + ["one two", "ONE two", "one  two\t", "two one"])]
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(more, DOCS))
    rows = rows.unionByName(rows.limit(8)).unionByName(rows.limit(9).selectExpr("cast(null as bigint) as doc_id", *rows.columns[1:]))
    if extra:
        rows = rows.selectExpr("*", "'x' as `set`", "1 as node", "'y' as bands", "'z' as _doc", "0 as n_shingles", "1 as signature")
    same(minhash.op13_minhash_near_dedup(spark, stored(rows, tmp_path)), [(r.doc_id, r.text) for r in rows.collect()])


@pytest.mark.parametrize("pieces, stars", [((2, 3, 1000), 2), ((1, 1, 1), 1), ((512, 4096, 4 << 20), 0)])
def test_pieces_and_rounds_lose_no_link(spark, monkeypatch, pieces, stars):
    asker_rows, member_rows, piece_bytes = pieces
    monkeypatch.setattr(minhash, "ASKER_ROWS", asker_rows)
    monkeypatch.setattr(minhash, "MEMBER_ROWS", member_rows)
    texts = copies(random.Random(7), groups=6, size=14)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    same(minhash.near_duplicates(docs, star_rounds=stars, piece_bytes=piece_bytes), list(enumerate(texts)))


def test_limit_is_exact(spark):
    """Pairs of texts of distinct words at and just below 85 of 100 shingles, and at 86."""
    rng = random.Random(3)
    rows = []
    for both, each in [(85, 100), (170, 200), (84, 100), (169, 200), (86, 100)] * 8:
        own = 2 * each - both - each  # words only one of the two has, each side
        left = [f"{rng.getrandbits(60):x}" for _ in range(both + 4)]
        total = own
        a = left + [f"{rng.getrandbits(60):x}" for _ in range(total // 2)]
        b = left + [f"{rng.getrandbits(60):x}" for _ in range(total - total // 2)]
        rows += [(len(rows), " ".join(a)), (len(rows) + 1, " ".join(b))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    same(minhash.near_duplicates(docs), rows)
    assert {r[2] for r in brute(rows)} < set(range(len(rows)))


def test_other_limits(spark):
    texts = copies(random.Random(8), groups=4)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    same(minhash.near_duplicates(docs, percent=95), list(enumerate(texts)), 95)


def test_no_rows_and_one_row(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    one = minhash.near_duplicates(spark.createDataFrame([(None, None, None, None, 0)], DOCS)).collect()
    assert [(r.n_shingles, r.component_id, r.kept) for r in one] == [(0, None, True)]


def test_sets_and_minima():
    texts = ["a b c d e f", "A  b\tc d e f", "b a", "", None, sentence(random.Random(1), 3000, ["x", "y", "zz"])]
    sets = list(minhash.shingle_sets(pa.array(texts, pa.string())))
    assert [len(s) for s in sets] == [len(brute_set(t)) for t in texts] and (sets[0] == sets[1]).all()
    x = np.arange(1, 1200, dtype=np.uint64) << np.uint64(32)
    want = ((minhash._FACTOR * (x >> np.uint64(32)) + minhash._TERM) >> np.uint64(32)).min(axis=1)
    assert (minhash.minima(x) == want).all()


def test_bands_and_signatures_miss_no_pair():
    rng = np.random.default_rng(6)
    for _ in range(300):
        words = rng.integers(0, 1 << 64, 437, dtype=np.uint64)  # 400 and 400 of which 370 are shared: 0.86
        a, b = (minhash.minima(part) for part in (words[:400], words[-400:]))
        assert (minhash.band_keys(a) == minhash.band_keys(b)).any()
        assert (a.astype(np.uint8) == b.astype(np.uint8)).mean() >= minhash.PERCENT / 100 - minhash.SLACK
