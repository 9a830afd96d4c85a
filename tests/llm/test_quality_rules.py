import re
from collections import Counter

import pytest
from cases import DOCS, edge_docs, stored

from cartwheel.llm import quality_rules as rules
from cartwheel.llm.textops import WORD_RE


def brute(text):
    text = text or ""
    w = WORD_RE.findall(text)
    lines = [x for x in text.split("\n") if WORD_RE.search(x)]
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("extra", [False, True])
def test_measures_against_brute_force(spark, tmp_path, extra):
    docs = edge_docs(spark, extra=extra)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = rules.op7_quality_rules(spark, stored(docs, tmp_path)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute(texts[r.doc_id]), (r.doc_id, (texts[r.doc_id] or "")[:80])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_outliers_go_and_the_rest_stays(spark):
    good = [(i, " ".join(f"word{(i * 7 + j * j) % 997}" for j in range(60)), "en", "s", 0) for i in range(300)]
    junk = [(1000 + i, " ".join(f"### w{i}x{j}" for j in range(60)), "en", "s", 0) for i in range(60)]
    docs = spark.createDataFrame(good + junk, DOCS)
    kept = {r.doc_id for r in rules.keep_good(docs).collect()}
    assert kept == {r[0] for r in good}
    assert rules.keep_good(docs).columns == docs.columns


def test_no_rows_and_repeated_rows(spark):
    none = spark.createDataFrame([], DOCS)
    assert rules.keep_good(none).count() == 0
    docs = edge_docs(spark)
    one = Counter(r.doc_id for r in rules.keep_good(docs).collect())
    two = Counter(r.doc_id for r in rules.keep_good(docs.unionByName(docs)).collect())
    assert two == {k: 2 * n for k, n in one.items()}
