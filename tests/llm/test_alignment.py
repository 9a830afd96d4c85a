import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from cases import DOCS, edge_docs, stored
from tokenizers import Tokenizer

from cartwheel.llm import alignment
from cartwheel.llm.tokenize import byte_letters, default_path


def models():
    a = Tokenizer.from_file(default_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.default_pieces())


def tokens(text, a, b):
    """[(id, first byte, byte after)] of both tokenizers, by the libraries themselves; nothing for texts that do not come back."""
    if not text:
        return [], []
    letters = byte_letters()
    found = []
    for ids, spelt in (((x := a.encode(" " + text, add_special_tokens=False)).ids, [bytes(letters[c] for c in t) for t in x.tokens]),
                       ((ids := b.encode(text)), [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                                                  for i, p in zip(ids, b.encode(text, out_type=str))])):
        if b"".join(spelt) != (" " + text).encode():
            return [], []
        at, mine = 0, []
        for i, piece in zip(ids, spelt):
            mine.append((i, at, at + len(piece)))
            at += len(piece)
        found.append(mine)
    return tuple(found)


def brute(rows):
    a, b = models()
    both = [tokens(text, a, b) for _, text in rows]
    links = [[(i, j) for i, s, e in x for j, u, v in y if s < v and u < e] if len(x) < 3000 else linked(x, y) for x, y in both]
    counts = Counter(p for found in links for p in found)
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(n, most.get(j, 0))
    out = []
    for (doc, _), (x, y), found in zip(rows, both, links):
        cuts = sorted({e for *_, e in x} & {e for *_, e in y})
        text = ";".join(",".join(str(i) for i, s, e in x if lo < e <= hi) + "|" + ",".join(str(i) for i, s, e in y if lo < e <= hi)
                        for lo, hi in zip([0, *cuts], cuts)) if len(x) < 3000 else written(x, y, cuts)
        out.append((doc, len(x), len(y), len(cuts), len(found), sum(counts[p] == most[p[1]] for p in found), sum(counts[p] for p in found),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=repr)


def linked(x, y):
    out, j = [], 0
    for i, s, e in x:
        while y[j][2] <= s:
            j += 1
        k = j
        while k < len(y) and y[k][1] < e:
            out.append((i, y[k][0]))
            k += 1
    return out


def written(x, y, cuts):
    number = {e: n for n, e in enumerate(cuts)}
    parts = [([], []) for _ in cuts]
    for side, found in enumerate((x, y)):
        at = 0
        for i, _, e in found:
            parts[at][side].append(str(i))
            at += e in number
    return ";".join(",".join(p) + "|" + ",".join(q) for p, q in parts)


ODD = ["a▁b", "▁", "<s> <0x41> </s>", "<|endoftext|><|endoftext|>", "a\u0000b", "  two  spaces ", "\n\n\n\t\t x", "日本語のテキスト、漢字。" * 9, "क्षत्रिय " * 7,
       "😀😃👩‍👩‍👧‍👦" * 5, "éé", "ﬁne ﬀ", " ", " ", "x" * 500, "1234567890" * 20, " " * 3000, "don't I'll we've"]


@pytest.mark.parametrize("extra", [False, True])
def test_query_against_brute_force(spark, tmp_path, extra):
    docs = edge_docs(spark, extra=extra).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.unionByName(spark.createDataFrame([(500 + i, t, "en", "s", 0) for i, t in enumerate(ODD)], DOCS))
    docs = docs.unionByName(docs.limit(5)).unionByName(docs.limit(7).selectExpr("cast(null as bigint) as doc_id", *docs.columns[1:]))
    if extra:
        docs = docs.selectExpr("*", "'x' as block", "'y' as tokens", "1 as pair", "2 as n_a", "3 as best", "4 as a", "5 as b")
    got = sorted((tuple(r) for r in alignment.op12_cross_tokenizer_alignment(spark, stored(docs, tmp_path)).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_blocks_and_chunks_change_nothing(spark, monkeypatch):
    docs = edge_docs(spark).repartition(3)
    want = sorted(map(repr, alignment.align(docs).collect()))
    monkeypatch.setattr(alignment, "CHUNK_TOKENS", 50)
    assert sorted(map(repr, alignment.align(docs, block_bytes=2000).collect())) == want


def test_no_rows_and_no_tokens(spark):
    assert alignment.align(spark.createDataFrame([], DOCS)).count() == 0
    docs = spark.createDataFrame([(1, None, None, None, 0), (None, "", None, None, 0), (3, "a▁b", None, None, 0)], DOCS)
    assert {tuple(r)[1:] for r in alignment.align(docs).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_groups_give_the_texts_back(spark):
    docs = edge_docs(spark)
    found = {}
    for r in alignment.groups(docs).collect():
        found.setdefault(r.doc_id, []).append(r)
    model = alignment.Pair(default_path(), alignment.default_pieces())
    for row in docs.collect():
        mine = sorted(found.get(row.doc_id, []), key=lambda r: r.number)
        sides = [[b"".join(table[i] for i in r[side]) for r in mine] for side, table in (("a", model.bytes_a), ("b", model.bytes_b))]
        assert sides[0] == sides[1] and b"".join(sides[0]) == (" " + row.text if row.text else "").encode()
        assert [r.start for r in mine] == np.cumsum([0, *map(len, sides[0])])[:-1].tolist() and [r.number for r in mine] == list(range(len(mine)))


@pytest.mark.parametrize("seed", range(30))
def test_cuts_of_random_ends(seed):
    rng = random.Random(seed)
    ends, whole, base = ([], []), ([0], [0]), 0
    for _ in range(rng.randint(1, 6)):
        size = rng.choice([1, 2, 9, 60, 700])
        share = rng.random()
        for side in (0, 1):
            ends[side].extend(sorted({base + size} | {base + i for i in range(1, size) if rng.random() < share}))
            whole[side].append(len(ends[side]))
        base += size
    a, b = alignment.shared_cuts(*map(np.array, (*ends, *whole)))
    common = sorted(set(ends[0]) & set(ends[1]))
    assert a.tolist() == [0, *(ends[0].index(c) + 1 for c in common)] and b.tolist() == [0, *(ends[1].index(c) + 1 for c in common)]
