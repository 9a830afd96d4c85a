import random
import time
import zlib

import pytest
from cases import DOCS, edge_docs, sentence, stored

from cartwheel.llm import toxicity

BAD = ["idiot", "stupid", "worthless", "gruntel"]
LABELS = "doc_id bigint, quality int, toxic int"


def world(spark, folder, n=900, extra=False):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(600)]
    rows, labels = [], []
    for i in range(n):
        words = sentence(rng, rng.randint(5, 80), vocabulary).split()
        toxic = i % 5 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ".", ",", "ing" if i % 2 else ""]))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    docs = edge_docs(spark, extra=extra).select("doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", -1 - __import__("pyspark").sql.functions.col("doc_id"))
    docs = docs.unionByName(spark.createDataFrame(rows, DOCS))
    spark.createDataFrame(labels + [(None, None, None), (5, 1, None)], LABELS).write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    return stored(docs, folder), {i: t for i, _, t in labels}


def test_held_out_accuracy(spark, tmp_path):
    folder, toxic = world(spark, tmp_path)
    rows = {r.doc_id: r for r in toxicity.op8_toxicity(spark, folder).collect()}
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [i for i in toxic if rows[i].held_out]
    assert sum(rows[i].predicted == toxic[i] for i in held) >= 0.97 * len(held)
    assert all(r.predicted == 0 for i, r in rows.items() if i < 0)


def test_clashing_columns_change_nothing(spark, tmp_path):
    folder, _ = world(spark, tmp_path, 300)
    want = sorted(map(tuple, toxicity.op8_toxicity(spark, folder).collect()))
    other = tmp_path / "other"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stored(docs.selectExpr("*", "'x' as toxic", "1 as score", "true as held_out", "2 as predicted", "'y' as quality", "'z' as _text", "3 as features"), other)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    labels.selectExpr("*", "'x' as text", "'y' as lang", "1 as score").write.parquet(f"{other}/labels.parquet")
    assert sorted(map(tuple, toxicity.op8_toxicity(spark, str(other)).collect())) == want


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    folder, _ = world(spark, tmp_path_factory.mktemp("world"))
    return toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))


@pytest.mark.parametrize("token,word", [("1d10t", "idiot"), ("$tup1d", "stupid"), ("stuuuupid", "stupid"), ("s.t.u.p.i.d", "stupid"),
                                        ("w0rthl3ss", "worthless"), ("IDIOT!!", "idiot"), ("st-u-pid", "stupid")])
def test_disguises(model, token, word):
    assert word in model.weights
    assert model.score(f"nelo bara {token} mopi") >= 0.3
    if toxicity.suspicious(token.lower()) and token.isascii():
        assert toxicity.restore(token.lower().rstrip("!"), model.letters) == word


def test_spaced_letters(model):
    assert model.score("nelo i d i o t bara") >= 0.3
    assert model.score("nelo a b bara 1 2 3 4 555-1234 c3po $$$ !!!") < 0.3


def test_clean_and_empty_texts(model):
    assert {model.score(t) for t in (None, "", " \n", "nelo bara")} == {model.no_hit}
    assert model.no_hit < 0.3


def brute_restore(token, model):
    """All readings of a short token, scored one by one."""
    best = None

    def walk(at, word, cost):
        nonlocal best
        if at == len(token):
            marked = "^^" + word + "$"
            total = cost + sum(model.log(marked[i - 2:i], marked[i]) for i in range(2, len(marked)))
            best = max(best or (total, word), (total, word))
            return
        c = token[at]
        options = [(r, toxicity.COST_READING) for r in toxicity.READINGS.get(c, "")]
        options += [(c, toxicity.COST_ITSELF)] if c.isalpha() else []
        options += [("", toxicity.COST_SEPARATOR)] if c in toxicity.SEPARATORS else []
        options += [("", toxicity.COST_REPEAT)] if at and c == token[at - 1] else []
        for r, k in options or [(c, toxicity.COST_ITSELF)]:
            walk(at + 1, word + r, cost + k)

    walk(0, "", 0.0)
    return best[1]


@pytest.mark.parametrize("token", ["1d10t", "aa1!", "b.a.d", "s5$t", "xx-yy", "0", "la11a"])
def test_viterbi_is_the_best_reading(model, token):
    assert toxicity.restore(token, model.letters) == brute_restore(token, model.letters)


def test_without_labels_or_rows(spark, tmp_path):
    none = spark.createDataFrame([], LABELS)
    docs = edge_docs(spark)
    rows = toxicity.scored(docs, toxicity.fit(docs, none)).collect()
    assert len(rows) == docs.count() and {r.predicted for r in rows} == {0}
    empty = spark.createDataFrame([], DOCS)
    assert toxicity.scored(empty, toxicity.fit(empty, none)).count() == 0


@pytest.mark.parametrize("run", ["a s t u p i d", "y o u i d i o t", "i d i o t.", "$ t u p 1 d", "i  d  i  o  t", "s\tt\tu\tp\ti\td", "i\nd\ni\no\nt",
                                 "i - d - i - o - t", "s | t | u | p | i | d", "(i d 1 0 t)!", "a. b. s t u p i d", "9 r u n t e l"])
def test_spaced_runs(model, run):
    assert model.score(f"nelo bara {run} bara mopi") >= 0.3 and model.score(run) >= 0.3


@pytest.mark.parametrize("token", ["st" + "u" * 200 + "pid", "s---t---u---p---i---d" + "-" * 20 + "x", "s" + "-" * 100 + "tup" + "." * 100 + "id", "s--t--u--p--i--d", "9runtel",
                                   "nelo.bara.mopi.bara.nelo.bara.nelo.bara.nelo.stupid.bara", "1d10t" + "." * 200, "i" * 3000 + "d" * 3000 + "iot"])
def test_tokens_of_any_length_and_every_sign(model, token):
    assert model.score(f"nelo bara {token} mopi") >= 0.3


def test_long_tokens_in_time(model):
    began = time.monotonic()
    for token in ("a_" * 20_000 + "!", "_" * 50_000 + "a!", "ab1" * 20_000, "a" * 100_000, "x " * 50_000, "-" * 50_000 + "ab", "1 a" * 20_000):
        model.score(token)
    assert time.monotonic() - began < 60


def test_every_labelled_text_teaches(spark):
    """More toxic and clean texts than any sample that the model once took; copies and repeated rows count once."""
    words = {1: [f"{a}{b}{c}" for a in "bcdf" for b in "aeiou" for c in "lmnp"], 0: [f"{a}{b}{c}" for a in "ghjk" for b in "aeiou" for c in "rstv"]}
    rows = [(i, f"{words[int(i < 5600)][i % 80]} nelo{''.join(chr(97 + int(d)) for d in str(i))}") for i in range(19_200)]
    rows += [(100_000 + i, rows[0][1]) for i in range(50)] + rows[:100]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i < 5600 or i >= 100_000)) for i, _ in rows[:19_250]], LABELS)
    teach = {t for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    toxic = {t for i, t in rows if (i < 5600 or i >= 100_000) and t in teach}
    assert len(toxic) > 3000 and len(teach - toxic) > 6000
    taught = toxicity.labelled_texts(docs, labels)
    assert sorted(map(tuple, taught.collect())) == sorted((int(t in toxic), t) for t in teach)
    model = toxicity.fit(docs, labels)
    assert sum(n for g, n in model.letters.three.items() if g.startswith("^^")) == 2 * len(teach)
