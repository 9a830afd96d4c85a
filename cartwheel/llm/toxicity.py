"""Toxicity of texts that may be disguised: a noisy channel restores them, a lexicon of learnt features scores them.

Restoring: a token with digits or signs among its letters, stretched letters or separators inside, and
a run of single characters spaced apart, is a lattice of readings per character (a sign may stand for letters, a repeat or
separator for nothing). The Viterbi path under a character trigram model, times the channel's costs, is the restored
word; in runs, and at separators, a path may also end a word and begin another, and every word on the best one counts.
Tokens and runs of any length are restored; of a word only as many letters are held as the longest feature has. Scoring: words and word beginnings that are far more frequent among toxic than among other labelled texts carry
their log odds; a text adds up those of its distinct words, each with its best feature.

The lexicon and the character model are learnt from every labelled document that teaches (exact copies once); Spark counts
features and trigrams. What is sent to all tasks does not grow with the table: a feature is in a share ``MIN_SHARE`` of the
toxic texts at least, so at most 1 / ``MIN_SHARE`` times as many qualify as a toxic text has on average, and trigrams are
bounded by the letters that words are made of. Every text is scored in whole.

Defined results: null, empty and blank texts get the score of a text without features; without labels of both kinds
every text gets the prior; repeated rows are scored alike; null labels and ids do not teach; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.tables import materialise

MIN_SHARE, MIN_DOCS = 0.01, 5
MIN_LOG_ODDS = 4.0
BEGINNINGS = (4, 5, 6, 7)
PREDICT_FROM = 0.3
MEMORY_TOKENS = 400_000

# What a sign can stand for.
READINGS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
SEPARATORS = ".-_*~'"
COST_READING, COST_ITSELF, COST_SEPARATOR, COST_REPEAT = math.log(0.2), math.log(0.8), math.log(0.5), math.log(0.4)

_EDGE = ".,;:?\"()[]{}<>«»&%#*=/\\'`~_-"
_SIGNS = re.compile(f"[{re.escape(''.join(READINGS))}]")
_LETTER = re.compile(r"[^\W\d_]")
_STRETCHED = re.compile(r"(.)\1\1")
_SEPARATED = re.compile(r"^[^\W_]+(?:[.\-_*~]+[^\W_]+)+$")
_SPACED = re.compile(r"(?<!\S)\w(?:[ ]\w){2,}(?!\S)")
# three or more tokens of one letter, digit or sign at most
_RUN = re.compile(r"(?<!\S)(?:(?=\S)(?:[^\w\s]|_)*+[^\W_]?+(?:[^\w\s]|_)*+(?:\s++|\Z)){3,}+")
_MARK = re.compile(r"[^\W_]|" + _SIGNS.pattern)


class CharacterModel:
    """Trigram model of the letters of words, add-k smoothed."""

    def __init__(self, counts: dict[str, int], k: float = 0.1):
        self.three = counts
        self.two: Counter = Counter()
        for gram, n in counts.items():
            self.two[gram[:2]] += n
        self.k, self.size = k, len({g[2] for g in counts}) + 1

    def log(self, before: str, letter: str) -> float:
        return math.log((self.three.get(before + letter, 0) + self.k) / (self.two[before] + self.k * self.size))


def suspicious(token: str) -> bool:
    """Whether a token may hide another one."""
    if not _LETTER.search(token):
        return False
    return bool(_SIGNS.search(token) or _STRETCHED.search(token) or _SEPARATED.match(token))


def _readings(sign: str, before: str) -> list[tuple[str, float]]:
    readings = [(r, COST_READING) for r in READINGS.get(sign, "")]
    if sign.isalpha():
        readings.append((sign, COST_ITSELF))
    if sign in SEPARATORS:
        readings.append(("", COST_SEPARATOR))
    if sign == before:
        readings.append(("", COST_REPEAT))
    return readings or [(sign, COST_ITSELF)]


def restore(token: str, model: CharacterModel, held: int | None = None) -> str:
    """The most likely word behind a token: Viterbi over the lattice, the state being the last two letters. All of the
    token counts for the path; with ``held`` only the first letters of the word are given."""
    held = len(token) if held is None else held
    paths = {"^^": (0.0, "")}
    before = ""
    for sign in token:
        after: dict[str, tuple[float, str]] = {}
        readings = _readings(sign, before)
        before = sign
        for state, (score, word) in paths.items():
            for reading, cost in readings:
                if reading:
                    new = (score + cost + model.log(state, reading), word + reading if len(word) < held else word)
                    key = state[1] + reading
                else:
                    new, key = (score + cost, word), state
                if key not in after or new > after[key]:
                    after[key] = new
        paths = after
    return max((score + model.log(state, "$"), word) for state, (score, word) in paths.items())[1]


def restored_words(run: str, model: CharacterModel, look: Callable[[str], tuple[str, float]], prefixes: set[str]) -> set[str]:
    """The words with a feature on the most likely path through a run of characters. White space, and signs beside
    letters, may stand for nothing or for the end of a word, and a word with a feature is likelier by its weight: hence
    the state is the last two letters and the word, as long as it can make a difference."""
    dead = " "
    paths: dict[tuple[str, str], tuple[float, frozenset]] = {("^^", ""): (0.0, frozenset())}
    before = ""

    def longer(word: str, letter: str) -> str:
        if word == dead:
            return dead
        word += letter
        return word if word in prefixes else word[: BEGINNINGS[-1]] + dead if look(word)[1] else dead

    def ended(score: float, found: frozenset, state: str, word: str) -> tuple[float, frozenset]:
        feature, weight = ("", 0.0) if word == dead else look(word)
        return score + model.log(state, "$") + weight, found | {word} if feature else found

    for sign in " ".join(run.split()):
        between = not sign.isalnum()
        if sign == " ":
            readings = [("", COST_SEPARATOR)]
        else:
            readings = [r for r in _readings(sign, before) if r[0] != sign or not between]
            if between and ("", COST_SEPARATOR) not in readings:
                readings.append(("", COST_SEPARATOR))
            before = sign
        after: dict[tuple[str, str], tuple[float, frozenset]] = {}
        for (state, word), (score, found) in paths.items():
            ways = []
            for reading, cost in readings:
                if reading:
                    ways.append(((state[1] + reading, longer(word, reading)), (score + cost + model.log(state, reading), found)))
                else:
                    ways.append(((state, word), (score + cost, found)))
            if between and state != "^^":
                ways.append((("^^", ""), ended(score + COST_SEPARATOR, found, state, word)))
            for key, new in ways:
                if key not in after or new[0] > after[key][0]:
                    after[key] = new
        paths = after
    return set(max((ended(*path, *key) if key[0] != "^^" else path for key, path in paths.items()), key=lambda p: p[0])[1])


def plain(token: str) -> str:
    return token.strip(_EDGE).rstrip("!$+|")


def spaced_words(text: str) -> list[str]:
    return [m.replace(" ", "") for m in _SPACED.findall(text)]


def features(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) > n]]


def trained_on(doc_id: Column) -> Column:
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """toxic, text of the labelled documents to learn from: each different text once, toxic if any of its labels says so.

    Copies are found by their digests, so that of every text only one row meets its label.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & trained_on(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.filter(F.col("text").isNotNull() & trained_on(F.col("doc_id"))).select("doc_id", "text", F.md5("text").alias("_digest"))
    named = texts.select("doc_id", "_digest").join(known, F.col("doc_id") == F.col("_id"))
    first = materialise(named.groupBy(F.col("_digest").alias("_of")).agg(F.min("doc_id").alias("_first"), F.max("toxic").alias("toxic")), "taught")
    found = texts.join(first, (F.col("doc_id") == F.col("_first")) & (F.col("_digest") == F.col("_of"))).select("toxic", "text")
    found = materialise(found, "labelled")
    return found if found.count() == first.count() else found.dropDuplicates(["text"])  # rows may be repeated


def _words(text: str) -> set[str]:
    lowered = text.lower()
    return {plain(t) for t in set(lowered.split())} | set(spaced_words(lowered))


def _document_features(rows: DataFrame, only: set[str] | None) -> DataFrame:
    """feature, docs: in how many of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0).to_pylist():
                found = {f for w in _words(text) if w for f in features(w)}
                seen.update(found if only is None else found & only)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["feature", "docs"])

    return rows.select("text").mapInArrow(run, "feature string, docs long").groupBy("feature").agg(F.sum("docs").alias("docs"))


def _trigrams(rows: DataFrame) -> dict[str, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0).to_pylist():
                for word in _words(text):
                    if word.isalpha():
                        marked = f"^^{word}$"
                        seen.update(marked[i: i + 3] for i in range(len(marked) - 2))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["gram", "n"])

    found = rows.select("text").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r.gram: r.n for r in found.collect()}


class ToxicityModel:
    """Lexicon, character model and the two constants of the score."""

    def __init__(self, weights: dict[str, float], trigrams: dict[str, int], hit_bias: float, no_hit: float):
        self.weights, self.letters = weights, CharacterModel(trigrams)
        self.hit_bias, self.no_hit = hit_bias, no_hit
        # a longer word cannot be a feature, and its beginnings are within
        self.held = 1 + max([*map(len, weights), *BEGINNINGS])
        self.prefixes = {f[:n] for f in (w.rstrip("*") for w in weights) for n in range(1, len(f) + 1)}
        self.memory: dict[str, list[tuple[str, float]]] = {}

    def _look(self, word: str) -> tuple[str, float]:
        best = max(((self.weights[f], f) for f in features(word) if f in self.weights), default=(0.0, ""))
        return best[1], best[0]

    def token(self, token: str) -> list[tuple[str, float]]:
        """(feature, weight) of one token, of the words behind it if it looks disguised."""
        word = plain(token)
        found = self._look(word)
        if found[1]:
            return [found]
        restored = set()
        for form in {word, token.strip(_EDGE)}:
            if suspicious(form):
                restored.add(restore(form, self.letters, self.held))
                if _SEPARATED.match(form):
                    restored |= restored_words(form, self.letters, self._look, self.prefixes)
        return [f for f in map(self._look, sorted(restored)) if f[1]]

    def evidence(self, text: str) -> float:
        lowered = text.lower()
        memory = self.memory
        if len(memory) > MEMORY_TOKENS:
            memory.clear()
        tokens = set(lowered.split())
        for t in tokens.difference(memory):
            memory[t] = self.token(t)
        found = dict(f for t in tokens for f in memory[t])
        for word in spaced_words(lowered):
            for form in (word, restore(word, self.letters, self.held)):
                found.update([self._look(form)])
        for run in _RUN.findall(lowered):
            if _LETTER.search(run) and len(_MARK.findall(run)) >= 3:
                found.update(map(self._look, restored_words(run, self.letters, self._look, self.prefixes)))
        return sum(found.values())

    def score(self, text: str | None) -> float:
        evidence = self.evidence(text or "")
        if evidence <= 0:
            return self.no_hit
        return 1 / (1 + math.exp(-min(max(self.hit_bias + evidence, -50), 50)))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    totals = {r.toxic: r.n for r in labels.filter(F.col("toxic").isin(0, 1) & trained_on(F.col("doc_id")))
              .groupBy(F.col("toxic").cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    all_toxic, all_clean = totals.get(1, 0), totals.get(0, 0)
    prior = (all_toxic + 0.5) / (all_toxic + all_clean + 5)
    taught = labelled_texts(docs, labels)
    toxic, clean = taught.filter("toxic = 1"), taught.filter("toxic = 0")
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic or not n_clean:
        return ToxicityModel({}, {}, 0.0, prior)
    # an exact copy counts once, yet near copies share words by chance: hence a share of all toxic texts at least
    least = max(MIN_DOCS, math.ceil(MIN_SHARE * n_toxic))
    among_toxic = {r.feature: r.docs for r in _document_features(toxic, None).filter(F.col("docs") >= least).collect()}
    among_clean = {r.feature: r.docs for r in _document_features(clean, set(among_toxic)).collect()}
    odds = {f: math.log((n + 0.5) / (n_toxic + 1)) - math.log((among_clean.get(f, 0) + 0.5) / (n_clean + 1)) for f, n in among_toxic.items()}
    weights = dict(sorted(((f, w) for f, w in odds.items() if w >= MIN_LOG_ODDS), key=lambda x: (-x[1], x[0])))
    model = ToxicityModel(weights, _trigrams(taught), math.log(prior / (1 - prior)), prior)
    missed = _scores(toxic.select(F.lit(0).cast("bigint").alias("doc_id"), "text"), model).filter(F.col("score") == prior).count()
    model.no_hit = (missed / n_toxic * all_toxic + 0.5) / (missed / n_toxic * all_toxic + all_clean + 1)
    return model


def _scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.letters.three, model.hit_bias, model.no_hit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ToxicityModel(*sent.value)
        for batch in batches:
            scores = [own.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return _scores(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                       (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


QUERIES = {"op8_toxicity": (op8_toxicity, None)}
