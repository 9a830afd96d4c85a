import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash
from cases import DOCS, edge_docs, sentence, stored

from cartwheel.llm import simhash
from cartwheel.llm.textops import WORD_RE


def brute_fingerprint(text, k=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD_RE.findall(lowered)
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps: dict, radius=4):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= radius:
                ra, rb = sorted((find(a), find(b)))
                root[rb] = ra
    return {i: find(i) for i in ids}


def near_docs(spark, n=60):
    rng = random.Random(5)
    rows = []
    for group in range(8):
        base = [f"w{rng.randrange(500)}" for _ in range(150)]
        for _ in range(n // 8):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(150)] = f"x{rng.randrange(9)}"
            rows.append((len(rows) + 100, " ".join(copy), "en", "s", 0))
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("extra", [False, True])
def test_query_against_brute_force(spark, tmp_path, extra):
    docs = edge_docs(spark, extra=extra)
    docs = docs.select(near_docs(spark).columns).unionByName(near_docs(spark))
    rows = simhash.op6_simhash_groups(spark, stored(docs, tmp_path)).collect()
    fps = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    want = brute_groups(fps)
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {r.doc_id: r.component_id for r in rows} == want
    assert len(rows) == len(fps)


@pytest.mark.parametrize("tree_nodes", [3, 4096])
def test_links_connect_what_pairs_connect(spark, tree_nodes):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(20)]
    fps = {i: f for i, f in enumerate({s ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (2**64 - 1) for s in seeds for _ in range(12)})}
    signed = [(int(np.uint64(f).astype(np.int64)),) * 2 for f in fps.values()]
    found = simhash.links(spark.createDataFrame(signed, "node long, fp0 long"), simhash.block_masks(), tree_nodes=tree_nodes)
    roots = {r.node: r.root for r in simhash.components(found).collect()}
    number = {s[0]: i for i, s in zip(fps, signed)}
    want = brute_groups(fps)
    got = {i: number[roots[s]] if s in roots else i for s, i in number.items()}

    def classes(m):
        return Counter(frozenset(k for k in m if m[k] == v) for v in set(m.values()))

    assert classes(got) == classes(want)


def test_bk_tree_finds_all_pairs():
    rng = np.random.default_rng(1)
    items = np.unique(rng.integers(0, 2**10, 300, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    q, i = simhash.BKTree(items[:, None]).within(items[:, None], 18)
    want = np.bitwise_count(items[:, None] ^ items[None, :]) <= 18
    got = np.zeros_like(want)
    got[q, i] = True
    assert (got == want).all() and len(q) == want.sum()


def test_components_of_a_long_chain(spark):
    chain = spark.range(1, 200).selectExpr("id as a", "id - 1 as b")
    assert {r.root for r in simhash.components(chain).collect()} == {0}


def test_no_rows_repeated_rows_null_ids(spark):
    assert simhash.grouped(spark.createDataFrame([], DOCS)).count() == 0
    docs = spark.createDataFrame([(5, "a b c d e", None, None, 0), (5, "a b c d e", None, None, 0), (None, "a b c d e", None, None, 0)], DOCS)
    assert [r.component_id for r in simhash.grouped(docs).collect()] == [5, 5, 5]


def test_near_copies_at_a_similarity_of_four_fifths(spark):
    """One document of each group of near copies stays, and documents like no other all stay."""
    rng = random.Random(9)
    rows, similar = [], []
    for group in range(40):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        rows.append((len(rows), " ".join(base), "en", "s", 0))
        copy = list(base)
        for k in rng.sample(range(300), 4):  # twenty of 296 shingles
            copy[k] = f"x{rng.randrange(5000)}"
        rows.append((len(rows), " ".join(copy), "en", "s", 0))
        similar.append(rows[-1][0])
    alone = [(1000 + i, sentence(rng, 300, [f"w{k}" for k in range(5000)]), "en", "s", 0) for i in range(40)]
    docs = spark.createDataFrame(rows + alone, DOCS)
    kept = {r.doc_id for r in simhash.keep_first(docs, 5).collect()}
    assert {i for i, *_ in alone} <= kept and {r[0] for r in rows} - set(similar) <= kept
    assert len(kept & set(similar)) <= 4


def test_near_copies_by_fingerprints(spark, monkeypatch):
    """Fingerprints link near copies that share no band; what their shingles do not confirm stays apart."""
    rng, signatures = random.Random(4), simhash._signatures
    base = [[f"w{rng.randrange(9000)}" for _ in range(1500)] for _ in range(8)]
    rows = [(2 * i + k, " ".join(words[k:]), "en", "s", 0) for i, words in enumerate(base) for k in (0, 1)]
    short = [(100 + i, text, "en", "s", 0) for i, text in enumerate(("", " ", "one two", "three four"))]
    monkeypatch.setattr(simhash, "_signatures", lambda *a: signatures(*a).withColumn("keys", F.when(F.size("keys") > 0, F.array("node")).otherwise(F.col("keys"))))
    found = {r.doc_id: r.component for r in simhash.near_copies(spark.createDataFrame(rows + short, DOCS), 5).collect()}
    prints = [simhash.fingerprint(r[1], 5)[0] for r in rows]
    close = [int(prints[2 * i] ^ prints[2 * i + 1]).bit_count() <= 4 for i in range(8)]
    assert sum(close) >= 5 and [found[2 * i] == found[2 * i + 1] for i in range(8)] == close
    assert len({found[2 * i] for i in range(8)} | {found[101], found[102], found[103]}) == 11


def test_keep_first_of_repeated_rows(spark):
    docs = edge_docs(spark, extra=True)
    docs = docs.unionByName(docs).unionByName(docs.limit(1).selectExpr("cast(null as bigint) as doc_id", *[f"`{c}`" for c in docs.columns[1:]]))
    kept = simhash.keep_first(docs, 5)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and None not in ids and 0 in ids and 1 not in ids
    assert simhash.keep_first(spark.createDataFrame([], DOCS), 5).count() == 0


def pair_at(rng, share):
    """Two texts of distinct words that share the share of their 200 five-word shingles."""
    both = round(200 * share)
    n = (200 + both) // 2
    words = [f"{rng.getrandbits(60):x}" for _ in range(n + 4)]
    return " ".join(words), " ".join(words[: both + 4] + [f"{rng.getrandbits(60):x}" for _ in range(n - both)])


@pytest.mark.parametrize("piece_bytes", [simhash.PIECE_BYTES, 1000])
def test_near_copies_are_decided_by_their_shingles(spark, piece_bytes):
    rng = random.Random(11)
    texts = {share: [pair_at(rng, share) for _ in range(40)] for share in (0.7, 0.75, 0.78, 0.8, 0.82, 0.85)}
    rows = [(share, text) for share, pairs in texts.items() for pair in pairs for text in pair]
    docs = spark.createDataFrame([(i, text, "en", "s", 0) for i, (_, text) in enumerate(rows)], DOCS)
    groups = {}
    for r in simhash.near_copies(docs, 5, piece_bytes).collect():
        groups.setdefault(r.component, []).append(r.doc_id)
    linked = Counter(rows[g[0]][0] for g in groups.values() if len(g) == 2)
    assert linked == {0.8: 40, 0.82: 40, 0.85: 40} and max(map(len, groups.values())) == 2
    if piece_bytes == simhash.PIECE_BYTES:
        kept = Counter(rows[r.doc_id][0] for r in simhash.keep_first(docs, 5).collect())
        assert kept == {0.7: 80, 0.75: 80, 0.78: 80, 0.8: 40, 0.82: 40, 0.85: 40}


@pytest.mark.parametrize("seed", range(5))
def test_similar_links_connect_what_pairs_connect(seed):
    rng = np.random.default_rng(seed)
    sets = [np.arange(0, dtype=np.uint64)]
    for start in rng.integers(0, 60, 150):
        sets.append(np.arange(start, start + rng.integers(1, 25), dtype=np.uint64))
    nodes = list(range(len(sets)))

    def groups(pairs):
        root = dict(zip(nodes, nodes))
        for a, b in pairs:
            old, new = root[a], root[b]
            root = {k: new if v == old else v for k, v in root.items()}
        return sorted(map(sorted, ({k for k in nodes if root[k] == v} for v in set(root.values()))))

    pairs = [(a, b) for a in nodes for b in nodes[:a] if (s := len(np.intersect1d(sets[a], sets[b])))
             and 10 * s >= 8 * (len(sets[a]) + len(sets[b]) - s)]
    found = simhash.similar_links(sets)
    assert groups(found) == groups(pairs) and len(found) == len(nodes) - len(groups(pairs))


def test_bands_miss_almost_no_pair():
    rng = np.random.default_rng(5)
    missed = 0
    for _ in range(400):
        words = rng.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2)
        a, b = (simhash.band_keys(np.sort(words[part])) for part in (slice(0, 180), slice(20, 200)))
        missed += not set(a) & set(b)
    assert missed == 0
