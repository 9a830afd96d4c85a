"""Katz back-off language model: learnt from and evaluated over a whole corpus.

Words are 64-bit hashes. A block of documents holds its texts as numbers of its own word list. It sends its distinct
words and bigrams with their training counts to the key ranges (``exchange``) and gets the counts of the corpus back;
the ranges also give the counts of counts for the Good-Turing discounts. For the back-off weights the blocks send, for
every context, the sums over those bigrams that are theirs to report (the first block that counts a bigram owns it),
and get one weight per context back. All answers are tables partitioned by kind; every block then scores its tokens
recursively: a seen bigram by its discounted count, any other by the weight of its context times the word alone.

The model, exactly normalised over the training words and one event for all others:
  p(w) = d(c) c / N, and what the discounts leave for the event of an unknown word;
  p(w | v) = d(c) c / D(v) for seen pairs, else a(v) p(w), a(v) = (1 - sum seen p(w | v)) / (1 - sum seen p(w)).
d is Katz's discount for counts up to ``KATZ_K``, or for fewer where the counts of counts do not allow it. Where nothing is
discounted, one is added to N or D(v), so that something is left. The context of the first token is the begin of text; a
context that was never seen backs off with weight 1.

Defined results: a null or blank text is its end token; repeated rows teach as often as they come; a null id teaches
and is not held out; without training rows every token has base probability 1 and model probability 1; an empty
table gives no rows; other columns are not read. Words and pairs are 64-bit hashes: of 10**11 different pairs about 270
are expected to share their hash with another one, and those would be counted as one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import exchange
from cartwheel.llm.tables import bucketed
from cartwheel.llm.textops import LOWER, RollingHash, chunks, mix, text_buffer, words

KATZ_K = 5
END = np.uint64(0x7F4A7C159E3779B9)
BEGIN = np.uint64(0x1CE4E5B9BF58476D)
ONE, TWO, CONTEXT = 1, 2, 3
BLOCK = "block long, doc_ids binary, lengths binary, train binary, vocabulary binary, tokens binary, null_ids binary"


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


class _Builder:
    """Collects documents until they make a block."""

    def __init__(self):
        self.ids, self.nulls, self.train, self.lengths, self.hashes = [], [], [], [], []
        self.size = 0

    def add(self, ids, nulls, train, lengths, hashes, size) -> None:
        for held, more in zip((self.ids, self.nulls, self.train, self.lengths, self.hashes), (ids, nulls, train, lengths, hashes)):
            held.append(more)
        self.size += size

    def row(self, block: int) -> pa.RecordBatch:
        hashes = np.concatenate(self.hashes)
        vocabulary, tokens = np.unique(hashes, return_inverse=True)
        cells = [block, exchange.squeeze(np.concatenate(self.ids)), exchange.squeeze(np.concatenate(self.lengths).astype(np.int32)),
                 exchange.squeeze(np.concatenate(self.train).astype(np.uint8)), exchange.squeeze_sorted(vocabulary),
                 exchange.squeeze(tokens.astype(np.uint32)), exchange.squeeze(np.concatenate(self.nulls).astype(np.uint8))]
        kinds = [pa.int64(), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=[f.split()[0] for f in BLOCK.split(", ")])


def _with_ends(doc: np.ndarray, hashes: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(token counts, tokens) of documents whose words are ``hashes``: an end token behind each."""
    lengths = np.bincount(doc, minlength=n_docs) + 1
    out = np.full(int(lengths.sum()), END, np.uint64)
    out[np.arange(len(hashes)) + doc] = hashes
    return lengths, out


def blocks(docs: DataFrame, block_bytes: int = exchange.BLOCK_BYTES) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held = _Builder()
        for batch in batches:
            buffer, offsets = text_buffer(batch.column(1))
            ids = batch.column(0)
            nulls = np.asarray(ids.is_null())
            ids = ids.fill_null(0).to_numpy()
            train = np.asarray(batch.column(2))
            for a, b in chunks(offsets):
                part = LOWER[buffer[offsets[a]: offsets[b]]]
                starts, ends, doc = words(part, offsets[a: b + 1] - offsets[a])
                lengths, hashes = _with_ends(doc, RollingHash(part).of(starts, ends), b - a)
                held.add(ids[a:b], nulls[a:b], train[a:b], lengths, hashes, len(part))
                if held.size >= block_bytes:
                    yield held.row(number)
                    held, number = _Builder(), number + 1
        if held.ids:
            yield held.row(number)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), (~held_out()).alias("train"))
    return bucketed(rows.mapInArrow(run, BLOCK), "katz_blocks", "block", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@dataclass
class Block:
    """The arrays of one block."""

    doc: np.ndarray  # document number of each token
    train: np.ndarray  # per document
    vocabulary: np.ndarray  # sorted hashes
    word: np.ndarray  # number in the vocabulary of each token
    context: np.ndarray  # that of the token before, len(vocabulary) for the begin
    pair_keys: np.ndarray  # sorted hashes of the distinct pairs
    pair: np.ndarray  # number of each token's pair

    @classmethod
    def of(cls, row: dict) -> Block:
        lengths = exchange.expand(row["lengths"], np.int32)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        vocabulary = exchange.expand_sorted(row["vocabulary"])
        word = exchange.expand(row["tokens"], np.uint32).astype(np.int64)
        context = np.empty_like(word)
        context[1:] = word[:-1]
        context[np.cumsum(lengths) - lengths] = len(vocabulary)
        named = np.append(vocabulary, BEGIN)
        keys = mix(named[context] * np.uint64(0x9FB21C651E98DF25) + mix(vocabulary[word]))
        pair_keys, pair = np.unique(keys, return_inverse=True)
        return cls(doc, exchange.expand(row["train"], np.uint8).astype(bool), vocabulary, word, context, pair_keys, pair)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of words and pairs."""
        taught = self.train[self.doc]
        return (np.bincount(self.word[taught], minlength=len(self.vocabulary)).astype(np.uint32),
                np.bincount(self.pair[taught], minlength=len(self.pair_keys)).astype(np.uint32))

    def pair_ends(self) -> tuple[np.ndarray, np.ndarray]:
        """(context, word) of each distinct pair."""
        context, word = np.empty(len(self.pair_keys), np.int64), np.empty(len(self.pair_keys), np.int64)
        context[self.pair], word[self.pair] = self.context, self.word
        return context, word


# An answer for a word or pair: its count in the corpus, and in the lowest bit whether this block reports it. For
# words the second bit says whether other blocks have the word.
_OWNED, _SHARED = 1, 2


def _merge_counts(kind: int, keys: np.ndarray, extra: np.ndarray, sender: np.ndarray) -> tuple[np.ndarray, dict]:
    order, new, group = exchange.grouped_keys(keys)
    total = np.bincount(group, weights=extra).astype(np.int64)
    owner = exchange.first_of_group(order, new, extra > 0)
    shared = np.bincount(group) > 1
    found = {f"n{r}": int((total == r).sum()) for r in range(1, KATZ_K + 2)}
    found |= {"types": int((total > 0).sum()), "tokens": int(total.sum())}
    return ((total[group] << 2) | (shared[group] * _SHARED) | (owner * _OWNED)).astype(np.uint64), found


@dataclass
class Discounts:
    """Good-Turing discounts of Katz for one kind of counts."""

    by_count: list[float]  # of the counts 0, 1, ... k

    @classmethod
    def of(cls, n: list[int]) -> Discounts:
        """``n[r]`` is the number of types counted r times."""
        for k in range(KATZ_K, 0, -1):
            if not all(n[1: k + 2]):
                continue
            a = (k + 1) * n[k + 1] / n[1]
            if a >= 1:
                continue
            d = [((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, k + 1)]
            if all(0 < x <= 1 for x in d):
                return cls([1.0, *d])
        return cls([1.0])

    def apply(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        d = np.array([*self.by_count, 1.0])
        return counts * d[np.minimum(counts, len(d) - 1)]


@dataclass
class Model:
    """The few numbers of the model that are not in tables."""

    tokens: int
    types: int
    words: Discounts
    pairs: Discounts
    denominator: float
    unknown: float

    @classmethod
    def of(cls, totals: dict[int, dict]) -> Model:
        def histogram(kind: int) -> list[int]:
            return [0, *[totals[kind][f"n{r}"] for r in range(1, KATZ_K + 2)]]

        if ONE not in totals:
            return cls(0, 0, Discounts([1.0]), Discounts([1.0]), 1.0, 1.0)
        n, one = totals[ONE]["tokens"], histogram(ONE)
        d = Discounts.of(one)
        kept = n - sum(one[r] * r * (1 - x) for r, x in enumerate(d.by_count) if r)
        denominator = n if n - kept > 1e-9 else n + 1
        return cls(n, totals[ONE]["types"], d, Discounts.of(histogram(TWO)), denominator, (denominator - kept) / denominator)

    def alone(self, counts: np.ndarray) -> np.ndarray:
        """p(w) of words by their counts."""
        return np.where(counts > 0, self.words.apply(counts) / self.denominator, self.unknown)


def _weights(counts: np.ndarray, kept: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Weight of each context, negative where one is added to its count: ``kept`` and ``lower`` are the sums over its seen
    pairs of the discounted counts and of p(w)."""
    added = counts - kept <= 1e-9
    weight = (1 - kept / (counts + added)) / (1 - lower)
    return np.where(counts > 0, np.where(added, -weight, weight), 1.0)


def _merge_contexts(kind: int, keys: np.ndarray, extra: np.ndarray, sender: np.ndarray) -> tuple[np.ndarray, dict]:
    _, _, group = exchange.grouped_keys(keys)
    sums = [np.bincount(group, weights=extra[f]) for f in ("count", "kept", "lower")]
    return _weights(*sums)[group], {}


_SUMS = np.dtype([("count", "<f8"), ("kept", "<f8"), ("lower", "<f8")])


class _Seen:
    """What a block knows after the first answers: corpus counts, and the sums of its own pairs per context."""

    def __init__(self, row: dict, model: Model):
        self.block = Block.of(row)
        words_, pairs = (exchange.answer_of(row["counts"], kind, np.uint64) for kind in (ONE, TWO))
        self.word_counts, self.pair_counts = (words_ >> np.uint64(2)).astype(np.int64), (pairs >> np.uint64(2)).astype(np.int64)
        self.kept = model.pairs.apply(self.pair_counts)
        self.alone = model.alone(self.word_counts)
        # the begin of text is a context of all blocks
        self.shared = np.append((words_ & np.uint64(_SHARED)) > 0, True)
        context, word = self.block.pair_ends()
        own = (pairs & np.uint64(_OWNED)) > 0
        n = len(self.block.vocabulary) + 1
        self.sums = np.zeros(n, _SUMS)
        for field, values in (("count", self.pair_counts), ("kept", self.kept), ("lower", self.alone[word])):
            self.sums[field] = np.bincount(context[own], weights=values[own], minlength=n)
        self.named = np.append(self.block.vocabulary, BEGIN)
        # words of this block alone need no exchange; the end is never a context
        self.asks = np.flatnonzero(self.shared & (self.named != END))
        self.asks = self.asks[np.argsort(self.named[self.asks], kind="stable")]


def _context_requests(row: dict, model: Model, edges: np.ndarray) -> Iterator[tuple]:
    seen = _Seen(row, model)
    yield from exchange.requests(CONTEXT, row["block"], seen.named[seen.asks], seen.sums[seen.asks], edges)


def _scores(row: dict, model: Model) -> pa.RecordBatch:
    seen = _Seen(row, model)
    b = seen.block
    weight = _weights(seen.sums["count"], seen.sums["kept"], seen.sums["lower"])
    weight[seen.asks] = exchange.answer_of(row["weights"], CONTEXT, np.float64)
    # the count of a context is that of its word; every document that teaches counts for the begin
    if model.tokens:
        counts = np.append(seen.word_counts, row["train_docs"])[b.context]
        pair = seen.pair_counts[b.pair]
        with np.errstate(divide="ignore", invalid="ignore"):
            known = np.log10(seen.kept[b.pair]) - np.log10(counts + (weight[b.context] < 0))
            backed = np.log10(np.abs(weight[b.context])) + np.log10(seen.alone[b.word])
        p = np.where(pair > 0, known, backed)
        base = np.log10((seen.word_counts[b.word] + 1) / (model.tokens + model.types + 1))
    else:
        p = base = np.zeros(len(b.word))
    n = len(b.train)
    ids = pa.array(exchange.expand(row["doc_ids"], np.int64), mask=exchange.expand(row["null_ids"], np.uint8).astype(bool))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(~b.train), pa.array(np.bincount(b.doc, minlength=n)),
         pa.array(np.bincount(b.doc[seen.word_counts[b.word] > 0], minlength=n)), pa.array(np.full(n, model.tokens)),
         pa.array(np.bincount(b.doc, weights=base, minlength=n)), pa.array(np.bincount(b.doc, weights=p, minlength=n))],
        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def score(docs: DataFrame, block_bytes: int = exchange.BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of all documents."""
    table = blocks(docs, block_bytes)
    edges = exchange.range_edges(exchange.ranges_for(docs))

    def count_requests(row: dict) -> Iterator[tuple]:
        b = Block.of(row)
        one, two = b.counts()
        yield from exchange.requests(ONE, row["block"], b.vocabulary, one, edges)
        yield from exchange.requests(TWO, row["block"], b.pair_keys, two, edges)

    names = [*[f"n{r}" for r in range(1, KATZ_K + 2)], "types", "tokens"]
    counts, totals = exchange.answered(exchange.sent(table, count_requests), _merge_counts, lambda kind: np.uint32, names, "katz-counts")
    model = Model.of({r.kind: r.asDict() for r in totals.collect()})  # a row of sums per kind
    counted = exchange.with_answers(table, counts=counts)
    weights, _ = exchange.answered(exchange.sent(counted, lambda row: _context_requests(row, model, edges)), _merge_contexts,
                                   lambda kind: _SUMS, [], "katz-weights")
    taught = docs.filter(~held_out()).count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}
                yield _scores(row | {"train_docs": taught}, model)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return exchange.with_answers(table, counts=counts, weights=weights).mapInArrow(run, schema)


def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op5_katz_scores": (op5_katz_scores, None)}
