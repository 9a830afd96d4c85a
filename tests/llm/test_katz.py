import math
import random
import re
import zlib
from collections import Counter

import pytest
from cases import DOCS, edge_docs, sentence, stored

from cartwheel.llm import katz
from cartwheel.llm.textops import WORD


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(WORD, lowered), None]


def gt(counts):
    n = Counter(counts.values())
    return katz.Discounts.of([0, *[n[r] for r in range(1, katz.KATZ_K + 2)]]).by_count


def brute(texts):
    """{id: (n_tokens, n_known, N, base, score)} and the model as a function p(word, context)."""
    train = [tokens(t) for i, t in texts if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    one = Counter(w for t in train for w in t)
    two = Counter((v, w) for t in train for v, w in zip(["<s>", *t], t))
    total, d1, d2 = sum(one.values()), gt(one), gt(two)

    def disc(d, c):
        return c * (d[c] if c < len(d) else 1.0)

    left = total - sum(disc(d1, c) for c in one.values())
    big = total if left > 1e-9 else total + 1
    unknown = (big - sum(disc(d1, c) for c in one.values())) / big

    def alone(w):
        return disc(d1, one[w]) / big if w in one else unknown

    followers: dict = {}
    for (v, w), c in two.items():
        followers.setdefault(v, {})[w] = c

    def p(w, v):
        seen = followers.get(v)
        if not seen:
            return alone(w)
        count, kept = sum(seen.values()), sum(disc(d2, c) for c in seen.values())
        if count - kept <= 1e-9:
            count += 1
        if w in seen:
            return disc(d2, seen[w]) / count
        return (1 - kept / count) / (1 - sum(map(alone, seen))) * alone(w)

    out = []
    for i, t in texts:
        ts = tokens(t)
        if not total:
            out.append((i, len(ts), 0, 0, 0.0, 0.0))
            continue
        base = sum(math.log10((one[w] + 1) / (total + len(one) + 1)) for w in ts)
        out.append((i, len(ts), sum(w in one for w in ts), total, base, sum(math.log10(p(w, v)) for v, w in zip(["<s>", *ts], ts))))
    return out, p, one, followers


def check(got, want):
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=repr)
    want = sorted(want, key=repr)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1])), sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1]))):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4]) and g[5] == pytest.approx(w[5]), (g, w)


def prose(n, seed=0):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    return [(i, sentence(rng, rng.randint(1, 60), vocabulary)) for i in range(n)]


@pytest.mark.parametrize("extra,block_bytes", [(False, 1 << 23), (True, 500)])
def test_query_against_brute_force(spark, tmp_path, extra, block_bytes):
    docs = edge_docs(spark, extra=extra).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.unionByName(spark.createDataFrame([(i + 1000, t, None, None, 0) for i, t in prose(250)], DOCS))
    rows = katz.score(spark.read.parquet(stored(docs, tmp_path) + "/documents.parquet"), block_bytes).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want, *_ = brute(texts)
    check(rows, want)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_the_model_sums_to_one():
    _, p, one, followers = brute(prose(120))
    for v in [*list(followers)[:40], "never"]:
        assert sum(p(w, v) for w in one) + p("unknown", v) == pytest.approx(1)


def test_small_tables(spark):
    for texts in ([], [(0, "a b a")], [(2, None)], [(None, "a b"), (1, "a b"), (1, "a b"), (9, "")]):
        docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in texts], DOCS)
        check(katz.score(docs).collect(), brute(texts)[0])
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2)
    check(katz.score(spark.createDataFrame([(held, "a b", None, None, 0)], DOCS)).collect(), brute([(held, "a b")])[0])
