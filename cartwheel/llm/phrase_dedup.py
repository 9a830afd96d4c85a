"""Repeated phrases: every word inside a run of ``WINDOW`` words that a document with a smaller id has too.

Sieving: blocks of documents send their distinct window hashes to the key ranges (``exchange``) and learn which occur in
several documents; what is not among them is no phrase anywhere. Of the other windows, neighbours with the same anchor (the
three words of least hash in a window) are a segment; a block sends its distinct segments as text, each with the least and
the greatest id that has it. Equal segments of all blocks become one, and anchors deal them into shards, so windows with the
same words always meet, however often they occur.

Confirming: in a shard windows are compared word by word; those of several ids are phrases, and each belongs to its
smallest id. Phrases that always follow each other are joined into passages, and these are stored as a table with a row for
each Aho-Corasick automaton of about ``AUTOMATON_WORDS`` words. Locating: every automaton is compiled once, from its row (the
library's own stored form is eight times as large, and compiling is cheaper than reading that), and the text of all segments
of the shard streams through it; no window is hashed or compared there. What is found goes back to the blocks that sent the
segments. Words are numbers of as many digits in an automaton, so matches fall on word borders.

Defined results: a null or blank text has no words; documents shorter than a window keep everything; rows that repeat
an id do not remove each other's words; a null id counts as greater than any other; an empty table gives no rows; other
columns pass through ``without_phrases`` and are not read by the query.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import exchange
from cartwheel.llm.carried import pack_columns, unpack_columns
from cartwheel.llm.tables import bucketed, materialise
from cartwheel.llm.textops import RollingHash, chunks, mix, text_buffer, window_keys, words

WINDOW = 13
ANCHOR_WORDS = 3
AUTOMATON_WORDS = 60_000
# Text of the distinct segments of a shard.
SHARD_BYTES = 1 << 20
_LETTERS = 64
RECURS = 1
BLOCK = "block long, carried binary, doc_ids binary, lengths binary, vocabulary binary, word_lengths binary, tokens binary"
_HIT = np.dtype([("end", "<i8"), ("phrase", "<i8")])
_NO_ID = np.iinfo(np.int64).max


class _Builder:
    def __init__(self):
        self.carried, self.ids, self.lengths, self.numbers, self.size = [], [], [], [], 0
        self.vocabulary: dict[bytes, int] = {}

    def add(self, carried: pa.RecordBatch, ids: np.ndarray, part: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, doc = words(part, offsets)
        hashes = RollingHash(part).of(starts, ends)
        _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        raw = part.tobytes()
        known = self.vocabulary
        numbers = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(starts[first].tolist(), ends[first].tolist())], np.uint32)
        self.numbers.append(numbers[word] if len(word) else np.zeros(0, np.uint32))
        self.lengths.append(np.bincount(doc, minlength=len(ids)).astype(np.int32))
        self.ids.append(ids)
        self.carried.append(carried)
        self.size += len(part)

    def row(self, block: int) -> pa.RecordBatch:
        cells = [block, pack_columns(self.carried), exchange.squeeze(np.concatenate(self.ids)), exchange.squeeze(np.concatenate(self.lengths)),
                 b"".join(self.vocabulary), exchange.squeeze(np.array([len(w) for w in self.vocabulary], np.uint32)),
                 exchange.squeeze(np.concatenate(self.numbers))]
        kinds = [pa.int64(), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=[f.split()[0] for f in BLOCK.split(", ")])


def blocks(docs: DataFrame, columns: list[str], block_bytes: int = exchange.BLOCK_BYTES) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held = _Builder()
        for batch in batches:
            buffer, offsets = text_buffer(batch.column(1))
            ids = batch.column(0).fill_null(_NO_ID).to_numpy()
            carried = pa.RecordBatch.from_arrays(batch.columns[2:], names=columns)
            for a, b in chunks(offsets):
                held.add(carried.slice(a, b - a), ids[a:b], buffer[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                if held.size >= block_bytes:
                    yield held.row(number)
                    held, number = _Builder(), number + 1
        if held.ids:
            yield held.row(number)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").cast("string").alias("_text"), *[F.col(f"`{c}`") for c in columns])
    return bucketed(rows.mapInArrow(run, BLOCK), "phrase_blocks", "block", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


class Block:
    """The words of a block and its windows."""

    def __init__(self, row: dict, window: int):
        self.ids = exchange.expand(row["doc_ids"], np.int64)
        self.lengths = exchange.expand(row["lengths"], np.int32)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.tokens = exchange.expand(row["tokens"], np.uint32)
        self.ends = np.cumsum(exchange.expand(row["word_lengths"], np.uint32), dtype=np.int64)
        self.vocabulary = row["vocabulary"]
        n = max(len(self.tokens) - window + 1, 0)
        self.starts = np.flatnonzero(self.doc[:n] == self.doc[window - 1:]) if n else np.zeros(0, np.int64)
        self.window = window

    def word_starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]).astype(np.int64)[: len(self.ends)]

    def word_hashes(self) -> np.ndarray:
        return RollingHash(np.frombuffer(self.vocabulary, np.uint8)).of(self.word_starts(), self.ends)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted distinct keys of windows, key number of each window)."""
        return np.unique(window_keys(self.word_hashes()[self.tokens], self.window)[self.starts], return_inverse=True)

    def segments(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first window, number of windows, hash of the anchor) of the runs of wanted windows with one anchor."""
        none = np.zeros(0, np.int64)
        if not wanted.any():
            return none, none, np.zeros(0, np.uint64)
        size = min(ANCHOR_WORDS, self.window)
        order = window_keys(self.word_hashes()[self.tokens], size)
        place = np.arange(len(order), dtype=np.uint64)
        least = _sliding_min((order & ~_POSITION) | place, self.window - size + 1)
        anchor = (least[self.starts] & _POSITION).astype(np.int64)
        goes_on = np.zeros(len(wanted), bool)
        goes_on[1:] = wanted[:-1] & wanted[1:] & (np.diff(self.starts) == 1) & (np.diff(anchor) == 0)
        first = np.flatnonzero(wanted & ~goes_on)
        edge = np.flatnonzero(np.append(~(wanted & goes_on), True))
        return first, edge[np.searchsorted(edge, first, "right")] - first, order[anchor[first]]

    def texts(self) -> list[bytes]:
        """The words by their numbers."""
        begins = self.word_starts().tolist()
        return [self.vocabulary[s:e] for s, e in zip(begins, self.ends.tolist())]


# Bits that hold the place of a word in its block (268 million words); the others are its hash.
_POSITION = np.uint64((1 << 28) - 1)


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` consecutive values."""
    done, out = 1, values
    while 2 * done <= size:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = size - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _extremes(values: np.ndarray, group: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.full(n, _NO_ID), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(low, group, values)
    np.maximum.at(high, group, values)
    return low, high


def _merge(kind: int, keys: np.ndarray, extra: np.ndarray, sender: np.ndarray) -> tuple[np.ndarray, dict]:
    _, _, group = exchange.grouped_keys(keys)
    recurs = (np.bincount(group) > 1) | (np.bincount(group, weights=extra) > 0)
    return recurs[group].astype(np.uint8), {}


def _recurring_requests(row: dict, window: int, edges: np.ndarray) -> Iterator[tuple]:
    b = Block(row, window)
    keys, key = b.distinct()
    low, high = _extremes(b.ids[b.doc[b.starts]], key, len(keys))
    yield from exchange.requests(RECURS, row["block"], keys, (low < high).astype(np.uint8), edges)


class _Candidates:
    """The segments of a block that may hold phrases; equal ones have one number."""

    def __init__(self, row: dict, window: int):
        self.block = b = Block(row, window)
        keys, key = b.distinct()
        recurs = exchange.answer_of(row["recurs"], RECURS, np.uint8).astype(bool)
        self.first, self.windows, self.anchor = b.segments(recurs[key] if len(keys) else np.zeros(0, bool))
        known: dict[bytes, int] = {}
        begin = b.starts[self.first]
        self.number = np.array([known.setdefault(b.tokens[i: i + n].tobytes(), len(known))
                                for i, n in zip(begin.tolist(), (self.windows + window - 1).tolist())], np.int64)
        self.tokens = [np.frombuffer(t, np.uint32) for t in known]


SEGMENT = "block long, number long, anchor long, key binary, text binary, low long, high long"


def _key(text: bytes) -> bytes:
    """The name of a segment, by which what is found comes back to those who sent it: 128 bits."""
    return xxhash.xxh3_128_digest(text)


def _sent(row: dict, window: int) -> pa.RecordBatch:
    """The distinct segments of a block with the least and the greatest id that has them."""
    found = _Candidates(row, window)
    b, n = found.block, len(found.tokens)
    low, high = _extremes(b.ids[b.doc[b.starts[found.first]]], found.number, n)
    anchor = np.zeros(n, np.uint64)
    anchor[found.number] = found.anchor
    word = b.texts()
    texts = [b" ".join([word[t] for t in part.tolist()]) for part in found.tokens]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, row["block"], np.int64)), pa.array(np.arange(n)), pa.array(mix(anchor).view(np.int64)),
         pa.array([_key(t) for t in texts], pa.binary()), pa.array(texts, pa.binary()), pa.array(low), pa.array(high)], names=[f.split()[0] for f in SEGMENT.split(", ")])


def _characters(codes: np.ndarray, digits: int) -> str:
    """Every code as ``digits`` characters. Each digit has letters of its own, so a match begins with a first digit; few
    letters per digit keep the nodes of an automaton small."""
    out = np.empty((len(codes), digits), "<u4")
    for d in reversed(range(digits)):
        out[:, d] = codes % _LETTERS + d * _LETTERS + 1
        codes = codes // _LETTERS
    return out.tobytes().decode("utf-32-le")


class PhraseAutomaton:
    """An Aho-Corasick automaton over passages of numbered words, of which it knows only its own."""

    def __init__(self, phrases: Sequence[np.ndarray]):
        self.lengths = np.array([len(p) for p in phrases], np.int64)
        part = np.concatenate(phrases)
        self.words = np.unique(part)  # the numbers, in the numbering of the maker, that it knows as 1, 2, ...
        self.digits = 1
        while _LETTERS**self.digits <= len(self.words):
            self.digits += 1
        text = _characters(np.searchsorted(self.words, part) + 1, self.digits)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        ends = np.cumsum(self.lengths) * self.digits
        for i, (start, end) in enumerate(zip((ends - self.lengths * self.digits).tolist(), ends.tolist())):
            self.automaton.add_word(text[start:end], i)
        self.automaton.make_automaton()

    def find(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, phrase numbers) of all occurrences among words as the automaton knows them; others are 0."""
        hits = np.fromiter(self.automaton.iter(_characters(numbers, self.digits)), _HIT)
        return hits["end"] // self.digits - self.lengths[hits["phrase"]] + 1, hits["phrase"]


def shards_of(phrases: Sequence[np.ndarray], most: int) -> list[tuple[int, int]]:
    """Ranges of phrases of about ``most`` words. Phrases that overlap had better be neighbours, so that a range has few words."""
    lengths = np.array([len(p) for p in phrases], np.int64)
    number = (np.cumsum(lengths) - lengths) // most
    cuts = np.flatnonzero(np.diff(number, prepend=-1, append=-1))
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def locate(tokens: np.ndarray, phrases: Sequence[np.ndarray], most: int = AUTOMATON_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, phrase numbers) of all occurrences of ``phrases`` among ``tokens``, automaton by automaton."""
    for a, b in shards_of(phrases, most):
        made = PhraseAutomaton(phrases[a:b])
        at = np.searchsorted(made.words, tokens)
        known = made.words[np.minimum(at, len(made.words) - 1)] == tokens
        starts, phrase = made.find(np.where(known, at + 1, 0))
        yield starts, phrase + a


def _ways(key: np.ndarray, beside: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` keys the key that stands beside it wherever it occurs, or -1."""
    only = np.full(n, -1)
    only[key] = beside
    only[key[only[key] != beside]] = -1
    return only


def passages(starts: np.ndarray, key: np.ndarray, wanted: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(first window, number of windows) of passages that hold every wanted key once.

    A wanted window and the next one belong to one passage if neither ever occurs without the other in its place. So
    an occurrence of any of its windows lies in an occurrence of the whole passage, and to find that is to find them all.
    ``starts`` and ``key`` describe all windows of a block; a passage of more than ``longest`` windows is cut.
    """
    mine = wanted[key]
    beside = mine[:-1] & mine[1:] & (np.diff(starts) == 1)
    after, before = np.full(len(key), -1), np.full(len(key), -1)
    after[:-1][beside], before[1:][beside] = key[1:][beside], key[:-1][beside]
    after, before = _ways(key, after, len(wanted)), _ways(key, before, len(wanted))
    joined = np.zeros(len(key), bool)  # to the window before
    joined[1:] = beside & (after[key[:-1]] == key[1:]) & (before[key[1:]] == key[:-1])
    heads = np.flatnonzero(mine & ~joined)
    begins = np.flatnonzero(~joined)
    lengths = np.diff(np.append(begins, len(key)))[np.searchsorted(begins, heads)]
    _, once = np.unique(key[heads], return_index=True)
    once.sort()
    heads, lengths = heads[once], lengths[once]
    pieces = -(-lengths // longest)
    piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return np.repeat(heads, pieces) + piece * longest, np.minimum(np.repeat(lengths, pieces) - piece * longest, longest)


class _Stream:
    """The segments of a shard one after the other, as numbers of their words; between two stands a word of its own."""

    def __init__(self, texts: list[bytes], window: int):
        split = [t.split(b" ") for t in texts]
        self.known: dict[bytes, int] = {}
        number = self.known.setdefault
        self.lengths = np.array([len(w) for w in split], np.int64)
        self.begin = np.cumsum(self.lengths + 1) - self.lengths - 1
        self.tokens = np.zeros(int((self.lengths + 1).sum()), np.uint32)
        flat = np.array([number(w, len(self.known) + 1) for words in split for w in words], np.uint32)
        inside = np.ones(len(self.tokens), bool)
        inside[self.begin + self.lengths] = False
        self.tokens[inside] = flat
        self.windows = self.lengths - window + 1
        self.of = np.repeat(np.arange(len(texts)), self.windows)
        self.starts = self.begin[self.of] + np.arange(len(self.of)) - np.repeat(np.cumsum(self.windows) - self.windows, self.windows)


AUTOMATON = "shard long, words binary, passages binary, windows binary, owners binary"


def _confirmed(table: pa.Table, window: int, most: int) -> pa.Table:
    """A row per automaton of a shard: its words, its passages as numbers of them, and the owner of every window of each."""
    stream = _Stream(table["text"].to_pylist(), window)
    rows = np.lib.stride_tricks.sliding_window_view(stream.tokens, window)[stream.starts] if len(stream.starts) else np.zeros((0, window), np.uint32)
    _, key = np.unique(np.ascontiguousarray(rows).view(f"V{4 * window}").ravel(), return_inverse=True)
    n = int(key.max(initial=-1)) + 1
    low, _ = _extremes(table["low"].to_numpy()[stream.of], key, n)
    _, high = _extremes(table["high"].to_numpy()[stream.of], key, n)
    head, windows = passages(stream.starts, key, low < high, most) if n else (np.zeros(0, np.int64),) * 2
    phrases = [stream.tokens[i: i + k] for i, k in zip(stream.starts[head].tolist(), (windows + window - 1).tolist())]
    word = [b"", *stream.known]
    out = []
    for a, b in shards_of(phrases, most):
        known, text = np.unique(np.concatenate(phrases[a:b]), return_inverse=True)
        inside = np.repeat(head[a:b], windows[a:b]) + np.arange(windows[a:b].sum()) - np.repeat(np.cumsum(windows[a:b]) - windows[a:b], windows[a:b])
        out.append((table["shard"][0].as_py(), b" ".join([word[i] for i in known.tolist()]), exchange.squeeze(text.astype(np.uint32)),
                    exchange.squeeze(windows[a:b]), exchange.squeeze(low[key[inside]])))
    kinds = [pa.int64(), *[pa.binary()] * 4]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)], names=[f.split()[0] for f in AUTOMATON.split(", ")])


LOCATED = "key binary, owners binary"


def _located(segments: pa.Table, automata: pa.Table, window: int) -> pa.Table:
    """The names of the segments that hold phrases, with the owner of each of their windows (the greatest number: no phrase)."""
    texts = segments["text"].to_pylist()
    stream = _Stream(texts, window)
    owner = np.full(len(stream.tokens) + 1, _NO_ID)  # of the window that begins at a word
    for known, text, lengths, owners in zip(*[automata[c].to_pylist() for c in ("words", "passages", "windows", "owners")]):
        windows, own = exchange.expand(lengths, np.int64), exchange.expand(owners, np.int64)
        cuts = np.cumsum(windows + window - 1)[:-1]
        made = PhraseAutomaton(np.split(exchange.expand(text, np.uint32) + np.uint32(1), cuts))
        number = np.zeros(len(stream.known) + 1, np.int64)  # of the shard's words among the automaton's, 0 for others
        for i, w in enumerate(known.split(b" ")):
            number[stream.known[w]] = i + 1
        starts, phrase = made.find(number[stream.tokens])
        n = windows[phrase]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owner[np.repeat(starts, n) + inside] = own[np.repeat(np.cumsum(windows)[phrase] - n, n) + inside]
    found = owner[stream.starts]
    some = np.unique(stream.of[found < _NO_ID]).tolist()
    cuts = np.concatenate([[0], np.cumsum(stream.windows)]).tolist()
    return pa.Table.from_arrays([pa.array([_key(texts[i]) for i in some], pa.binary()), pa.array([found[cuts[i]: cuts[i + 1]].tobytes() for i in some], pa.binary())],
                                names=["key", "owners"])


def _removed(row: dict, answers: pa.Table, window: int) -> tuple[Block, np.ndarray]:
    """(block, whether each word goes)."""
    found = _Candidates(row, window)
    b = found.block
    begins = np.zeros(len(b.tokens) + window, np.int64)  # of windows that go, shifted by a window
    owners = {n: np.frombuffer(o, np.int64) for n, o in zip(answers["number"].to_pylist(), answers["owners"].to_pylist())}
    some = np.flatnonzero(np.isin(found.number, list(owners)))
    if len(some):
        n = found.windows[some]
        at = np.repeat(b.starts[found.first[some]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        goes = np.concatenate([owners[i] for i in found.number[some].tolist()]) < b.ids[b.doc[at]]
        begins[at[goes] + window] = 1
    begun = np.cumsum(begins)
    return b, begun[window:] > begun[:-window]


def without_phrases(docs: DataFrame, columns: list[str], window: int = WINDOW, block_bytes: int = exchange.BLOCK_BYTES,
                    automaton_words: int = AUTOMATON_WORDS, with_text: bool = False, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The columns with n_words, n_removed, kept_sha256 and, if asked for, kept_text (kept words joined by a space)."""
    columns = [c for c in columns if c not in ("n_words", "n_removed", "kept_sha256", "kept_text")]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = blocks(docs, columns, block_bytes)
    edges = exchange.range_edges(exchange.ranges_for(docs))
    recurs, _ = exchange.answered(exchange.sent(table, lambda row: _recurring_requests(row, window, edges)), _merge,
                                  lambda kind: np.uint8, [], "phrases-recurring")

    def rows_of(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
        for i in range(batch.num_rows):
            yield {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                yield _sent(row, window)

    known = exchange.with_answers(table.drop("carried"), recurs=recurs)
    sent = bucketed(known.mapInArrow(send, SEGMENT), "phrase_segments", "block", partitions)
    shards = max(1, -(-(sent.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_bytes))
    same = sent.groupBy("text").agg(F.first("anchor").alias("anchor"), F.min("low").alias("low"), F.max("high").alias("high"))
    dealt = bucketed(same.select(F.pmod("anchor", F.lit(shards)).alias("shard"), "text", "low", "high"), "phrase_shards", "shard", partitions)
    automata = bucketed(dealt.groupBy("shard").applyInArrow(lambda t: _confirmed(t, window, automaton_words), AUTOMATON), "phrase_automata", "shard", partitions)
    located = (dealt.select("shard", "text").groupBy("shard").cogroup(automata.groupBy("shard"))
               .applyInArrow(lambda segments, made: _located(segments, made, window), LOCATED))
    answers = sent.select("block", "number", "key").join(materialise(located, "phrases-located"), "key").select("block", "number", "owners")

    def finish(row: dict, answers: pa.Table) -> pa.Table:
        b, gone = _removed(row, answers, window)
        vocabulary = b.texts()
        at = np.concatenate([[0], np.cumsum(b.lengths)])
        n_removed = np.bincount(b.doc[gone], minlength=len(b.lengths))
        texts = []
        for i in range(len(b.lengths)):
            part, out = b.tokens[at[i]: at[i + 1]], gone[at[i]: at[i + 1]]
            texts.append(b" ".join([vocabulary[t] for t in (part[~out] if n_removed[i] else part).tolist()]))
        carried = unpack_columns(row["carried"]).to_batches()
        kept = carried[0].columns if carried else []
        new = [pa.array(b.lengths.astype(np.int64)), pa.array(n_removed), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
        if with_text:
            new.append(pa.array([t.decode() for t in texts], pa.string()))
        return pa.Table.from_arrays([*kept, *new], names=[*columns, "n_words", "n_removed", "kept_sha256", "kept_text"][: len(kept) + len(new)])

    types = dict(docs.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in columns], "n_words long, n_removed long, kept_sha256 string"])
    return (exchange.with_answers(table, recurs=recurs).groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(lambda own, found: pa.concat_tables([finish(row, found) for row in rows_of(own)]),
                          schema + (", kept_text string" if with_text else "")))


def op9_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])


QUERIES = {"op9_phrase_dedup": (op9_phrase_dedup, None)}
