"""Alignment of two tokenizers' tokens over the same bytes, by divide and conquer at shared cuts.

A text's tokens of either tokenizer cover the bytes of a space and the text. A byte offset where tokens of both end is a
cut. An interval (at first a whole text) probes for a cut from its middle outwards, finding the other tokenizer's end by
bisect; it is divided there and both halves go on, and an interval without a cut inside, or with a single token on either
side, is a leaf: one group. All intervals of a level are probed together in numpy.

Within a group the tokens whose byte ranges overlap are links. How many links join two ids is counted over the corpus:
documents are gathered into blocks of ``BLOCK_BYTES`` of text (a row each, in a table bucketed by block), a block sends every pair
of ids it holds once, with its number, and gets every pair's corpus-wide number back; so a pair that occurs everywhere is
a row per block, and the answer of a block is no larger than what it sent.

Defined results: a text that is null, empty, or whose bytes either tokenizer does not give back (a space and the text) has
no tokens; texts are whole, whatever their length; strings of special tokens are text; repeated rows and ids, and null ids,
each get their row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.tables import bucketed, materialise
from cartwheel.llm.tokenize import byte_letters, default_path, tokenizer

BLOCK_BYTES = 2 << 20
# Tokens worked on together, both tokenizers.
CHUNK_TOKENS = 1 << 19
SPACE = "▁"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pair:
    """Two tokenizers: a byte-level file A and a sentencepiece model B, with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.path_a = path_a
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocabulary = spec["model"]["vocab"]
        self.bytes_a = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.bytes_a[i] = bytes(letters[c] for c in token)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.length_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.length_b = np.array([len(b) for b in self.bytes_b], np.int64)
        # a token's decimal id and what follows: a comma within its side, a bar after A's last, a semicolon after B's, the end
        self.written = np.array([f"{i}{end}" for i in range(max(len(self.bytes_a), size)) for end in (",", "|", ";", "")], object)

    @cached_property
    def encode_a(self):
        return tokenizer(self.path_a, True).one

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.uint32)
        if not text:
            return none, none
        whole = " " + text
        a = np.frombuffer(self.encode_a(whole), "<u4")
        b = np.array(self.model.encode(text), np.uint32)
        want = whole.encode()
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != want or b"".join(map(self.bytes_b.__getitem__, b.tolist())) != want:
            return none, none
        return a, b


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    """One pair of tokenizers per Python worker."""
    return Pair(path_a, path_b)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, whole_a: np.ndarray, whole_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of tokens of A and of B before each cut, in ascending order.

    ``ends_a`` and ``ends_b`` ascend over several texts; ``whole_a`` and ``whole_b`` are the numbers of tokens before the
    first text and up to the end of each, which are cuts.
    """
    found_a, found_b = [whole_a], [whole_b]
    low, high, low_b, high_b = whole_a[:-1], whole_a[1:], whole_b[:-1], whole_b[1:]
    while True:
        divisible = (high - low > 1) & (high_b - low_b > 1)
        low, high, low_b, high_b = (x[divisible] for x in (low, high, low_b, high_b))
        if not len(low):
            break
        middle = (low + high) // 2
        cut_a, cut_b = np.full(len(low), -1), np.full(len(low), -1)
        active, away = np.arange(len(low)), 0
        while len(active):
            for probe in (away, -away)[: 1 if not away else 2]:
                at = middle[active] + probe
                inside = (at > low[active]) & (at < high[active])
                who, at = active[inside], at[inside]
                end = ends_a[at - 1]
                spot = np.searchsorted(ends_b, end)
                common = ends_b[spot] == end
                cut_a[who[common]], cut_b[who[common]] = at[common], spot[common] + 1
                active = active[cut_a[active] < 0]
            away += 1
            active = active[(middle[active] + away < high[active]) | (middle[active] - away > low[active])]
        cut = cut_a >= 0
        cut_a, cut_b = cut_a[cut], cut_b[cut]
        found_a.append(cut_a)
        found_b.append(cut_b)
        low, high, low_b, high_b = low[cut], high[cut], low_b[cut], high_b[cut]
        low, high = np.concatenate([low, cut_a]), np.concatenate([cut_a, high])
        low_b, high_b = np.concatenate([low_b, cut_b]), np.concatenate([cut_b, high_b])
        order = np.argsort(low, kind="stable")  # bisecting in order is kinder to the cache
        low, high, low_b, high_b = (x[order] for x in (low, high, low_b, high_b))
    return np.unique(np.concatenate(found_a)), np.unique(np.concatenate(found_b))


class Chunk:
    """Some texts' tokens, one after the other, with the numbers of tokens before each text."""

    def __init__(self, model: Pair, a: np.ndarray, b: np.ndarray, whole_a: np.ndarray, whole_b: np.ndarray):
        self.model, self.a, self.b, self.whole_a, self.whole_b = model, a, b, whole_a, whole_b
        self.ends_a, self.ends_b = np.cumsum(model.length_a[a]), np.cumsum(model.length_b[b])

    def cuts(self) -> tuple[np.ndarray, np.ndarray]:
        some = np.concatenate([[True], np.diff(self.whole_a) > 0])  # texts without tokens have no interval
        return shared_cuts(self.ends_a, self.ends_b, self.whole_a[some], self.whole_b[some])

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(token of A, token of B) of every link: each stretch between neighbouring ends, of either side, is one."""
        ends = np.concatenate([self.ends_a, self.ends_b])
        ends.sort(kind="stable")
        new = np.ones(len(ends), bool)
        new[1:] = ends[1:] != ends[:-1]
        ends = ends[new]
        return np.searchsorted(self.ends_a, ends), np.searchsorted(self.ends_b, ends)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(key of the ids, token of A) of every link."""
        i, j = self.links()
        return self.a[i].astype(np.int64) << 32 | self.b[j].astype(np.int64), i

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups as `a1,a2|b1;a3|b2,b3`; an empty string where there are none."""
        cut_a, cut_b = self.cuts()
        kind_a, kind_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        kind_a[cut_a[1:] - 1], kind_b[cut_b[1:] - 1] = 1, 2
        kind_b[self.whole_b[1:][np.diff(self.whole_b) > 0] - 1] = 3
        # the tokens of a group stand behind A's and B's of all groups before, and B's behind A's of its own
        place_a = np.arange(len(self.a)) + np.repeat(cut_b[:-1], np.diff(cut_a))
        place_b = np.arange(len(self.b)) + np.repeat(cut_a[1:], np.diff(cut_b))
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[place_a], codes[place_b] = 4 * self.a.astype(np.int64) + kind_a, 4 * self.b.astype(np.int64) + kind_b

        def digest(start: int, stop: int) -> str:
            found = hashlib.sha256()
            for at in range(start, stop, CHUNK_TOKENS):
                found.update("".join(self.model.written[codes[at: min(stop, at + CHUNK_TOKENS)]].tolist()).encode())
            return found.hexdigest() if stop > start else ""

        at = (self.whole_a + self.whole_b).tolist()
        return [digest(x, y) for x, y in zip(at, at[1:])]

    def group_counts(self) -> np.ndarray:
        cut_a, _ = self.cuts()
        return np.searchsorted(cut_a, self.whole_a[1:]) - np.searchsorted(cut_a, self.whole_a[:-1])


def _lists(arrays: list[np.ndarray], kind: type) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, kind), *arrays]).astype(kind)))


def _packed(ids: list, tokens: list[tuple[np.ndarray, np.ndarray]], kinds: tuple[type, type]) -> bytes:
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), _lists([a for a, _ in tokens], kinds[0]), _lists([b for _, b in tokens], kinds[1])],
                                       names=["doc_id", "a", "b"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _chunks(data: bytes, model: Pair) -> Iterator[tuple[pa.Array, Chunk]]:
    """Ids and tokens of a block in parts of about ``CHUNK_TOKENS``; a longer text is a part of its own."""
    table = pa.ipc.open_stream(data).read_next_batch()
    at = [c.offsets.to_numpy().astype(np.int64) for c in table.columns[1:]]
    values = [c.values.to_numpy() for c in table.columns[1:]]
    total = at[0] + at[1]
    first = 0
    while first < table.num_rows:
        last = max(first + 1, int(np.searchsorted(total, total[first] + CHUNK_TOKENS, "right")) - 1)
        whole = [x[first: last + 1] for x in at]
        yield (table.column(0).slice(first, last - first),
               Chunk(model, *[v[w[0]: w[-1]] for v, w in zip(values, whole)], *[w - w[0] for w in whole]))
        first = last


def blocks(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """block and tokens: all texts as tokens of both tokenizers, in blocks of about ``block_bytes`` of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pair(path_a, path_b)
        kinds = tuple(np.uint16 if n <= 1 << 16 else np.uint32 for n in (len(model.bytes_a), len(model.bytes_b)))
        number = TaskContext.get().partitionId() << 32
        ids, tokens, held = [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([_packed(ids, tokens, kinds)], pa.binary())], names=["block", "tokens"])

        for batch in batches:
            for doc, text in zip(*batch.columns):
                text = text.as_py()
                ids.append(doc.as_py())
                tokens.append(model.encode(text))
                held += len(text or "") + 64
                if held >= block_bytes:
                    yield block()
                    ids, tokens, held, number = [], [], 0, number + 1
        if ids:
            yield block()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "block long, tokens binary")


def _summed(keys: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(place, weights=np.concatenate(numbers), minlength=len(key)).astype(np.int64)


def block_links(stored: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """block, pair (A's id above B's 32 bits) and n: its links in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pair(path_a, path_b)
        for batch in batches:
            for number, data in zip(*batch.columns):
                found = [np.unique(chunk.pairs()[0], return_counts=True) for _, chunk in _chunks(data.as_py(), model)]
                keys, numbers = _summed([k for k, _ in found], [n for _, n in found])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), number.as_py())), pa.array(keys), pa.array(numbers)], names=["block", "pair", "n"])

    return stored.select("block", "tokens").mapInArrow(run, "block long, pair long, n long")


def link_counts(sent: DataFrame) -> DataFrame:
    """pair, count (links corpus-wide) and best: no other pair of its B id has more."""
    counts = sent.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1))
    # a row per id of B's vocabulary, which is the bound of what is broadcast
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


REPORT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per document: tokens, groups, links, links of the best pairs, their counts, and the digest of the groups."""
    path_a, path_b = path_a or default_path(), path_b or default_pieces()
    stored = bucketed(blocks(docs, path_a, path_b, block_bytes), "aligned_blocks", "block",
                      int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sent = materialise(block_links(stored, path_a, path_b), "aligned-links")
    answers = sent.select("block", "pair").join(materialise(link_counts(sent), "aligned-counts"), "pair")

    def sums(values: np.ndarray, whole: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[whole[1:]] - total[whole[:-1]]

    def report(own: pa.Table, known: pa.Table) -> pa.Table:
        model = pair(path_a, path_b)
        key, count, best = (known[c].to_numpy() for c in ("pair", "count", "best"))
        order = np.argsort(key)
        key, count, best = key[order], count[order], best[order]
        parts = []
        for data in own["tokens"]:
            for ids, chunk in _chunks(data.as_py(), model):
                keys, token = chunk.pairs()
                at = np.searchsorted(key, keys)
                of = np.searchsorted(token, chunk.whole_a)  # links before each text
                numbers = [np.diff(chunk.whole_a), np.diff(chunk.whole_b), chunk.group_counts(), np.diff(of),
                           sums(best[at].astype(np.int64), of), sums(count[at], of)]
                parts.append(pa.Table.from_arrays([ids, *[pa.array(x, pa.int64()) for x in numbers], pa.array(chunk.digests(), pa.string())],
                                                  names=[f.split()[0] for f in REPORT.split(", ")]))
        return pa.concat_tables(parts)

    return stored.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(report, REPORT)


def groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """A row per group: doc_id, number in its text, start (byte offset in a space and the text), A's and B's ids."""
    path_a, path_b = path_a or default_path(), path_b or default_pieces()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pair(path_a, path_b)
        for batch in batches:
            for data in batch.column(0):
                for ids, chunk in _chunks(data.as_py(), model):
                    cut_a, cut_b = chunk.cuts()
                    doc = np.searchsorted(chunk.whole_a, cut_a[:-1], "right") - 1
                    first = np.searchsorted(cut_a, chunk.whole_a)[doc]
                    ends = np.concatenate([[0], chunk.ends_a])
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(doc)), pa.array(np.arange(len(doc)) - first, pa.int64()),
                         pa.array(ends[cut_a[:-1]] - ends[chunk.whole_a[doc]], pa.int64()),
                         pa.ListArray.from_arrays(pa.array(cut_a.astype(np.int32)), pa.array(chunk.a.astype(np.int32))),
                         pa.ListArray.from_arrays(pa.array(cut_b.astype(np.int32)), pa.array(chunk.b.astype(np.int32)))],
                        names=["doc_id", "number", "start", "a", "b"])

    return blocks(docs, path_a, path_b).select("tokens").mapInArrow(run, "doc_id long, number long, start long, a array<int>, b array<int>")


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op12_cross_tokenizer_alignment": (op12_cross_tokenizer_alignment, None)}
