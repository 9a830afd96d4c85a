import random
from collections import Counter

import pytest
from cases import DOCS, edge_docs, stored
from tokenizers import Tokenizer

from cartwheel.llm import token_rollup as rollup
from cartwheel.llm.textops import WORD_RE
from cartwheel.llm.tokenize import default_path
from cartwheel.session import scratch_dir

CHANGE = "doc_id bigint, source string, lang string, tokenizer string, tokens bigint"


def test_query_against_recounting(spark, tmp_path):
    docs = edge_docs(spark, extra=True)
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.op4_token_rollup(spark, stored(docs, tmp_path)).collect()}
    model = Tokenizer.from_file(default_path())
    seen, want = set(), {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        if r.text is not None and r.text in seen:
            continue
        seen.add(r.text)
        text = "\n".join(dict.fromkeys((r.text or "").split("\n")))
        for version, n in ((rollup.WORDS, len(WORD_RE.findall(text))),
                           (rollup.BPE, len(model.encode(text, add_special_tokens=False).ids))):
            a, b = want.get((r.source, r.lang, version), (0, 0))
            want[r.source, r.lang, version] = (a + 1, b + n)
    assert got == want


def changes(spark, rows):
    return spark.createDataFrame(rows, CHANGE)


def totals(t):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in t.totals().collect()}


def test_signed_changes_and_replays(spark):
    t = rollup.TokenRollup(spark, scratch_dir(spark, "rollup"))
    assert totals(t) == {}
    assert t.apply("1", changes(spark, [(1, "a", "en", "v1", 10), (2, "a", "en", "v1", 5), (2, "a", "en", "v1", 5), (None, None, None, "v1", 3)]))
    assert totals(t) == {("a", "en", "v1"): (2, 15), (None, None, "v1"): (1, 3)}
    assert t.apply("2", changes(spark, [(1, "b", "en", "v1", 7), (2, "a", "en", "v1", None), (9, "z", "en", "v1", None)]))
    after = {("b", "en", "v1"): (1, 7), (None, None, "v1"): (1, 3)}
    assert totals(t) == after
    assert not t.apply("1", changes(spark, [(1, "a", "en", "v1", 999)])) and totals(t) == after
    assert t.apply("3", changes(spark, [])) and totals(t) == after


def test_torn_batch_does_not_count(spark):
    t = rollup.TokenRollup(spark, scratch_dir(spark, "rollup"))
    t.apply("1", changes(spark, [(1, "a", "en", "v1", 10)]))
    # a batch that died between its totals and its commit
    spark.createDataFrame([("a", "en", "v1", 1, 99)], rollup.TOTALS).write.parquet(f"{t.root}/totals/batch=2")
    assert totals(t) == {("a", "en", "v1"): (1, 10)}
    t.apply("2", changes(spark, [(1, "a", "en", "v1", 11)]))
    assert totals(t) == {("a", "en", "v1"): (1, 11)}


def test_the_last_revision_of_a_batch_counts(spark):
    t = rollup.TokenRollup(spark, scratch_dir(spark, "rollup"))
    t.apply("1", changes(spark, [(1, "a", "en", "v1", 10), (2, "a", "en", "v1", 5), (3, "a", "en", "v1", 1)]))
    ordered = [(1, "a", "en", "v1", 9, 1), (1, "a", "en", "v1", 4, 2), (2, "a", "en", "v1", None, 1), (2, "b", "en", "v1", 6, 2),
               (3, "a", "en", "v1", 70, 1), (3, "a", "en", "v1", None, 2)]
    t.apply("2", spark.createDataFrame(ordered, CHANGE + ", sequence int"))
    assert totals(t) == {("a", "en", "v1"): (1, 4), ("b", "en", "v1"): (1, 6)}


def test_folding_changes_nothing(spark):
    """Random lives of documents, folded often, rarely and not at all; batches come twice; a fold dies."""
    rng = random.Random(5)
    batches = [[(rng.choice([None, *range(12)]), rng.choice("ab"), None, rng.choice(["v1", "v2"]), rng.choice([None, rng.randrange(9)]), i)
                for i in range(15)] for _ in range(5)]
    want: dict = {}
    for batch in batches:
        for doc, source, _, version, n, _ in batch:
            want.pop((doc, version), None)
            if n is not None:
                want[doc, version] = (source, n)
    sums = Counter()
    for (_, version), (source, n) in want.items():
        sums[source, version] += n
    for every in (2, 99):
        t = rollup.TokenRollup(spark, scratch_dir(spark, "rollup"), buckets=3, fold_every=every)
        for i, batch in enumerate(batches):
            df = spark.createDataFrame(batch, CHANGE + ", sequence int")
            assert t.apply(f"b{i}", df) and not t.apply(f"b{i // 2}", df)
        assert {(k[0], k[2]): v[1] for k, v in totals(t).items() if v[0]} == {k: sums[k] for k in {(s, v) for (_, v), (s, _) in want.items()}}
        assert len(t.recent()) < every and sum(1 for _ in t.current().collect()) == len(want)
        # a fold that died before its commit, and one that died before it deleted anything
        before = totals(t)
        spark.createDataFrame([("a", None, "v1", 1, 99)], rollup.TOTALS).write.mode("overwrite").parquet(f"{t.root}/state/fold=50/totals")
        assert totals(t) == before
        with pytest.MonkeyPatch.context() as m:
            m.setattr(rollup.files, "delete", lambda *a: False)
            t.fold()
        assert totals(t) == before and t.recent() == [] and not t.apply("b3", changes(spark, [(1, "a", None, "v1", 999)]))


def test_a_batch_reads_its_buckets_only(spark):
    from conftest import scanned_rows

    t = rollup.TokenRollup(spark, scratch_dir(spark, "rollup"), buckets=8, fold_every=1)
    t.apply("1", spark.range(4000).selectExpr("id as doc_id", "'a' as source", "'en' as lang", "'v1' as tokenizer", "id as tokens"))
    assert scanned_rows(spark, t.current([3]), "doc_id") < 1000


@pytest.mark.parametrize("split", [1, 2, 3])
def test_split_into_batches_gives_the_same(spark, split):
    rows = [(i, "ab"[i % 2], None, "v1", i * 3) for i in range(9)]
    t = rollup.TokenRollup(spark, scratch_dir(spark, "rollup"))
    for k in range(split):
        t.apply(str(k), changes(spark, rows[k::split]))
    want = Counter()
    for _, s, _, _, n in rows:
        want[s] += n
    assert {k[0]: v[1] for k, v in totals(t).items()} == dict(want)


def test_no_documents(spark, tmp_path):
    assert rollup.op4_token_rollup(spark, stored(spark.createDataFrame([], DOCS), tmp_path)).count() == 0


def test_null_and_repeated_ids_are_all_counted(spark, tmp_path):
    rows = [(None, "a b c", "en", "s", 0), (None, "a b c", "en", "s", 0), (None, "d e", "en", "s", 0), (None, "d e", None, "s", 0), (None, None, "en", "s", 0),
            (None, None, "en", "s", 0), (7, "f g h i", "en", "s", 0), (7, "j", "en", "s", 0), (7, "j", "en", "s", 0), (7, "j", "en", "t", 0),
            (7, "k\nk", "en", "t", 0), (8, "j", "en", "s", 0), (9, "l m", "en", "s", 0)]
    got = totals_of(rollup.op4_token_rollup(spark, stored(spark.createDataFrame(rows, DOCS), tmp_path)))
    # 8 is a copy of 7; the text of two lines is revised
    words = {("s", "en"): (9, 3 + 3 + 2 + 0 + 0 + 4 + 1 + 1 + 2), ("s", None): (1, 2), ("t", "en"): (2, 1 + 1)}
    assert {k[:2]: v for k, v in got.items() if k[2] == rollup.WORDS} == words
    assert {k[:2]: v[0] for k, v in got.items() if k[2] == rollup.BPE} == {k: v[0] for k, v in words.items()}


def totals_of(df):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in df.collect()}
