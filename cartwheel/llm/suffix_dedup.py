"""Exact repeats of strings of a given length anywhere in a corpus, from a suffix array over sampled suffixes.

The figures below are those of 400 bytes; other lengths follow from ``Strings``.

Sampling. Of the 200-byte cores inside every 400-byte string the one with the smallest hash is its anchor, so equal
strings have equal anchors at equal places and it is enough to look at the suffixes that begin at anchors (about one in
a hundred bytes), each with the bytes around it that a 400-byte string over its core can reach.

Sieving. Blocks of documents send core and context hashes to the key ranges (``exchange``). An anchor whose whole
context occurs twice is settled: all strings over it repeat. An anchor whose core is alone has none. Of the others, only
those that share one of five 350-byte strings (one lies in every 400-byte string over the core) can have any.

Sorting. What is left, with its text, is range-partitioned by the leading tokens (eight bytes each) of its suffix,
with splitters that Spark samples; a bucket sorts its suffixes by multikey quicksort, one token after the other among
suffixes equal so far, and strings over equal cores are compared at every offset. Suffixes that begin like the first or
last of their bucket may have equals across its boundary; their strings are compared across buckets by their hashes.

Defined results: a null text is empty; texts shorter than the length keep everything; repeated rows repeat each other, so
they are removed whole; matches never cross documents; an empty table gives no rows; other columns pass through
``without_repeats`` and are not read by the query. Removal may cut a character in two; ``without_repeats`` leaves out the
bytes of such a character that remain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import exchange
from cartwheel.llm.carried import pack_columns, unpack_columns
from cartwheel.llm.tables import bucketed, materialise
from cartwheel.llm.textops import CHUNK_BYTES, RollingHash, chunks, mix, text_buffer

TOKEN = 8


@dataclass(frozen=True)
class Strings:
    """Which strings count as repeats: their length in bytes, and what follows from it."""

    length: int = 400

    def __post_init__(self):
        if self.length < 32:
            raise ValueError("repeats of under 32 bytes are not supported")

    @property
    def core(self) -> int:
        """Bytes of the anchor of a string: half of it, in whole tokens."""
        return self.length // 2 // TOKEN * TOKEN

    @property
    def slack(self) -> int:
        return self.length - self.core

    @property
    def step(self) -> int:
        """How far apart the shorter strings begin of which one lies in every string over a core."""
        return -(-self.slack // 4)

    @property
    def ladder(self) -> int:
        return self.length - self.step

    @property
    def rungs(self) -> range:
        return range(0, self.slack + self.step, self.step)


LONG = Strings()
ANCHORED, LADDERED, EDGE = 1, 2, 3

BLOCK = "block long, carried binary, text binary, lengths binary, at binary, core binary, wide binary"
_WIDE = np.dtype([("wide", "<u8"), ("many", "u1")])
# Answers for an anchor.
_SETTLED, _OPEN, _SPEAKS = 1, 2, 4
_POSITION_BITS = np.uint64(24)
_POSITION = np.uint64((1 << 24) - 1)


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    done, out = 1, values
    while 2 * done <= size:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = size - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _anchors_of(part: np.ndarray, offsets: np.ndarray, strings: Strings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, core hashes, context hashes) of the anchors of some texts."""
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    length = strings.length
    if len(part) < length:
        return none
    hashes = RollingHash(part)
    begin = np.arange(len(part) - strings.core + 1)
    core = hashes.of(begin, begin + strings.core)
    # the place in the lowest bits: among equal hashes the first wins
    low = _sliding_min((core & ~_POSITION) | begin.astype(np.uint64), strings.slack + 1)
    inside = np.zeros(len(part) + 1, np.int32)
    long = np.diff(offsets) >= length
    np.add.at(inside, offsets[:-1][long], 1)
    np.subtract.at(inside, offsets[1:][long] - length + 1, 1)
    found = low[np.cumsum(inside)[: len(low)] > 0]
    if not len(found):
        return none
    at = (found[np.append(True, found[1:] != found[:-1])] & _POSITION).astype(np.int64)
    at = np.unique(at)
    doc = np.searchsorted(offsets, at, "right") - 1
    left = np.maximum(at - strings.slack, offsets[doc])
    right = np.minimum(at + length, offsets[doc + 1])
    wide = mix(hashes.of(left, right) + (at - left).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return at, core[at], wide


def anchors(text: np.ndarray, offsets: np.ndarray, piece: int = CHUNK_BYTES,
            strings: Strings = LONG) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the texts, a bounded piece of them at a time; a long text is worked on in overlapping pieces."""
    found = []
    for a, b in chunks(offsets, piece):
        start, stop = int(offsets[a]), int(offsets[b])
        if b - a > 1 or stop - start <= 2 * piece:
            at, core, wide = _anchors_of(text[start:stop], offsets[a: b + 1] - start, strings)
            found.append((at + start, core, wide))
            continue
        for s in range(start, stop, piece):
            # strings that begin in [s, s + piece) and the contexts of their anchors
            low, high = max(start, s - strings.slack), min(stop, s + piece + 2 * strings.length)
            at, core, wide = _anchors_of(text[low:high], np.array([0, high - low]), strings)
            at += low
            # contexts cut short by the piece belong to the next one, which has them whole
            whole = ((at - strings.slack >= low) | (low == start)) & ((at + strings.length <= high) | (high == stop))
            found.append((at[whole], core[whole], wide[whole]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at, core, wide = (np.concatenate(x) for x in zip(*found))
    at, first = np.unique(at, return_index=True)
    return at, core[first], wide[first]


class _Builder:
    def __init__(self, strings: Strings):
        self.strings = strings
        self.carried, self.texts, self.lengths, self.size = [], [], [], 0

    def add(self, carried: pa.RecordBatch, text: np.ndarray, lengths: np.ndarray) -> None:
        self.carried.append(carried)
        self.texts.append(text)
        self.lengths.append(lengths)
        self.size += len(text)

    def row(self, block: int) -> pa.RecordBatch:
        text, lengths = np.concatenate(self.texts), np.concatenate(self.lengths)
        at, core, wide = anchors(text, np.concatenate([[0], np.cumsum(lengths)]), strings=self.strings)
        cells = [block, pack_columns(self.carried), text.tobytes(), exchange.squeeze(lengths),
                 exchange.squeeze_sorted(at.astype(np.uint64)), exchange.squeeze(core), exchange.squeeze(wide)]
        kinds = [pa.int64(), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=[f.split()[0] for f in BLOCK.split(", ")])


def blocks(docs: DataFrame, columns: list[str], block_bytes: int, strings: Strings = LONG) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held = _Builder(strings)
        for batch in batches:
            buffer, offsets = text_buffer(batch.column(0))
            carried = pa.RecordBatch.from_arrays(batch.columns[1:], names=columns)
            for a, b in chunks(offsets):
                held.add(carried.slice(a, b - a), buffer[offsets[a]: offsets[b]], np.diff(offsets[a: b + 1]))
                if held.size >= block_bytes:
                    yield held.row(number)
                    held, number = _Builder(strings), number + 1
        if held.lengths:
            yield held.row(number)

    rows = docs.select(F.col("text").cast("string").alias("_text"), *[F.col(f"`{c}`") for c in columns])
    return bucketed(rows.mapInArrow(run, BLOCK), "suffix_blocks", "block", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# --- sieving --------------------------------------------------------------------------------


def _pairs(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(core hashes, context hashes, order that sorts by both) of the anchors of a block."""
    core, wide = exchange.expand(row["core"], np.uint64), exchange.expand(row["wide"], np.uint64)
    return core, wide, np.lexsort((wide, core))


def _distinct_pairs(core: np.ndarray, wide: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each distinct pair in the order, pair number along the order)."""
    new = np.ones(len(order), bool)
    new[1:] = (core[order[1:]] != core[order[:-1]]) | (wide[order[1:]] != wide[order[:-1]])
    return np.flatnonzero(new), np.cumsum(new) - 1


def _anchor_requests(row: dict, edges: np.ndarray) -> Iterator[tuple]:
    core, wide, order = _pairs(row)
    first, number = _distinct_pairs(core, wide, order)
    extra = np.empty(len(first), _WIDE)
    extra["wide"] = wide[order[first]]
    extra["many"] = np.bincount(number, minlength=len(first)) > 1
    yield from exchange.requests(ANCHORED, row["block"], core[order[first]], extra, edges)


def _merge(kind: int, keys: np.ndarray, extra: np.ndarray, sender: np.ndarray) -> tuple[np.ndarray, dict]:
    if kind != ANCHORED:
        _, _, group = exchange.grouped_keys(keys)
        return ((np.bincount(group) > 1) | (np.bincount(group, weights=extra) > 0))[group].astype(np.uint8), {}
    order = np.lexsort((extra["wide"], keys))  # stable: equal pairs stay in the order of the senders
    first, number = _distinct_pairs(keys, extra["wide"], order)
    pair = np.empty(len(keys), np.int64)
    pair[order] = number
    twice = (np.bincount(pair) > 1) | (np.bincount(pair, weights=extra["many"]) > 0)
    _, core = np.unique(keys[order[first]], return_inverse=True)
    several = np.bincount(core) > 1
    some_open = several & (np.bincount(core, weights=~twice) > 0)
    speaker = np.zeros(len(keys), bool)
    speaker[order[first]] = True
    open_ = ~twice & several[core]
    answer = twice[pair] * _SETTLED | open_[pair] * _OPEN | (speaker & some_open[core][pair]) * _SPEAKS
    return answer.astype(np.uint8), {}


class _Sieved:
    """The anchors of a block with the first answers."""

    def __init__(self, row: dict, strings: Strings):
        self.strings = strings
        core, wide, order = _pairs(row)
        first, number = _distinct_pairs(core, wide, order)
        answers = exchange.answer_of(row["anchored"], ANCHORED, np.uint8)
        flags = np.zeros(len(core), np.uint8)
        flags[order] = answers[number] if len(answers) else 0
        # one anchor of a pair speaks for all of the block
        speaker = np.zeros(len(core), bool)
        speaker[order[first]] = True
        self.at = exchange.expand_sorted(row["at"]).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(exchange.expand(row["lengths"], np.int64))])
        self.doc = np.searchsorted(self.offsets, self.at, "right") - 1
        self.settled = (flags & _SETTLED) > 0
        self.open = (flags & _OPEN) > 0
        self.compared = np.flatnonzero(((flags & _SPEAKS) > 0) & speaker)
        self.core = core

    def bounds(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context of anchors."""
        doc = self.doc[which]
        return (np.maximum(self.at[which] - self.strings.slack, self.offsets[doc]),
                np.minimum(self.at[which] + self.strings.length, self.offsets[doc + 1]))

    def ladder(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each string of the ladder, whether it lies in its text), a row per compared anchor."""
        left, right = self.bounds(self.compared)
        ladder = self.strings.ladder
        begin = (self.at[self.compared] - self.strings.slack)[:, None] + np.array(self.strings.rungs)
        inside = (begin >= left[:, None]) & (begin + ladder <= right[:, None])
        safe = np.where(inside, begin, 0)
        keys = np.zeros(safe.shape, np.uint64)
        if inside.any():
            hashes = RollingHash(text)
            keys[inside] = hashes.of(safe[inside], safe[inside] + ladder)
        return keys, inside


def _text(row: dict) -> np.ndarray:
    return np.frombuffer(row["text"], np.uint8)


def _ladder_requests(row: dict, edges: np.ndarray, strings: Strings) -> Iterator[tuple]:
    keys, inside = _Sieved(row, strings).ladder(_text(row))
    distinct, count = np.unique(keys[inside], return_counts=True)
    yield from exchange.requests(LADDERED, row["block"], distinct, (count > 1).astype(np.uint8), edges)


SUFFIX = "t0 long, t1 long, salt long, context binary, left int, mask int, open boolean, block long, place long"


def _survivors(row: dict, strings: Strings) -> pa.RecordBatch:
    """The suffixes of a block that have to be sorted: leading tokens, context, and what it is for."""
    sieved, text = _Sieved(row, strings), _text(row)
    keys, inside = sieved.ladder(text)
    distinct = np.unique(keys[inside])
    shared = exchange.answer_of(row["laddered"], LADDERED, np.uint8).astype(bool)
    hit = np.zeros(keys.shape, bool)
    hit[inside] = shared[np.searchsorted(distinct, keys[inside])]
    rows = hit.any(axis=1)
    which, mask = sieved.compared[rows], (hit[rows] << np.arange(hit.shape[1])).sum(axis=1)
    left, right = sieved.bounds(which)
    at = sieved.at[which]
    flipped = np.uint64(1 << 63)  # the order of unsigned bytes as the order of signed numbers
    tokens = [((np.frombuffer(b"".join(row["text"][a + t: a + t + TOKEN] for a in at.tolist()), ">u8").astype(np.uint64)) ^ flipped).view(np.int64)
              for t in (0, TOKEN)]
    context = [row["text"][a:b] for a, b in zip(left.tolist(), right.tolist())]
    salt = mix(at.astype(np.uint64) ^ np.uint64(row["block"] & (2**64 - 1))).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(tokens[0]), pa.array(tokens[1]), pa.array(salt), pa.array(context, pa.binary()), pa.array((at - left).astype(np.int32)),
         pa.array(mask.astype(np.int32)), pa.array(sieved.open[which]), pa.array(np.full(len(at), row["block"], np.int64)), pa.array(at)],
        names=[f.split()[0] for f in SUFFIX.split(", ")])


# --- sorting --------------------------------------------------------------------------------


def multikey_sort(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, class along the order) of rows of tokens: suffixes that agree so far are sorted by their next token.

    Three-way partitioning by token, all segments of one depth together; a segment of one is done.
    """
    n, depth = tokens.shape
    order = np.arange(n)
    segment = np.zeros(n, np.int64)
    active = np.arange(n) if n > 1 else np.zeros(0, np.int64)
    for d in range(depth):
        if not len(active):
            break
        rows, key = order[active], tokens[order[active], d]
        sort = np.lexsort((key, segment[active]))
        order[active] = rows[sort]
        key, seg = key[sort], segment[active]
        new = np.ones(len(active), bool)
        new[1:] = (key[1:] != key[:-1]) | (seg[1:] != seg[:-1])
        # a segment is named by where it begins
        segment[active] = active[np.flatnonzero(new)][np.cumsum(new) - 1]
        size = np.bincount(np.cumsum(new) - 1)
        active = active[(size > 1)[np.cumsum(new) - 1]]
    if n:
        fresh = np.arange(n)
        rest = np.ones(n, bool)
        rest[active] = False
        segment[rest] = fresh[rest]
    return order, segment


class _Suffixes:
    """Contexts of suffixes side by side, with the hashes of the strings over their cores."""

    def __init__(self, contexts: list[bytes], left: np.ndarray, mask: np.ndarray, of: Strings):
        self.of = of
        self.left, self.mask = left.astype(np.int64), mask
        self.length = np.array([len(c) for c in contexts], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.raw = np.frombuffer(b"".join(contexts), np.uint8)
        self.hashes = RollingHash(self.raw)

    def strings(self, back: int) -> tuple[np.ndarray, np.ndarray]:
        """(suffixes with a string that begins ``back`` bytes before the core and can repeat, its hash)."""
        # the ladder strings that such a string holds
        length, step = self.of.length, self.of.step
        wanted = sum(1 << s for s, begin in enumerate(self.of.rungs) if 0 <= begin - (self.of.slack - back) <= step)
        rows = np.flatnonzero((self.left >= back) & (self.length - self.left >= length - back) & ((self.mask & wanted) > 0))
        start = self.begin[rows] + self.left[rows] - back
        return rows, mix(self.hashes.of(start, start + length) ^ np.uint64(back + 1))

    def cores(self) -> np.ndarray:
        """The cores as rows of tokens."""
        at = (self.begin + self.left)[:, None] + np.arange(self.of.core)
        return np.ascontiguousarray(self.raw[at]).view(">u8").astype(np.uint64)


class _Reach:
    """How far before the core repeated strings begin, least and most, of each suffix."""

    def __init__(self, n: int, strings: Strings):
        self.length = strings.length
        self.least, self.most = np.full(n, strings.length), np.full(n, -1)

    def add(self, rows: np.ndarray, back: int) -> None:
        self.least[rows] = np.minimum(self.least[rows], back)
        self.most[rows] = np.maximum(self.most[rows], back)

    def spans(self, block: np.ndarray, place: np.ndarray, wanted: np.ndarray) -> pa.RecordBatch:
        """block, spans: begins and ends of what repeats, for the wanted suffixes, by block."""
        rows = np.flatnonzero(wanted & (self.most >= 0))
        rows = rows[np.argsort(block[rows], kind="stable")]
        start, end = place[rows] - self.most[rows], place[rows] - self.least[rows] + self.length
        cuts = np.flatnonzero(np.diff(block[rows])) + 1
        parts = [exchange.squeeze(np.concatenate(x)) for x in zip(np.split(start, cuts), np.split(end, cuts))] if len(rows) else []
        heads = block[rows][np.concatenate([[0], cuts])] if len(rows) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(heads, pa.int64()), pa.array(parts, pa.binary())], names=["block", "spans"])


SORTED = "block long, spans binary, owners binary, contexts binary, lengths binary, lefts binary, masks binary, blocks binary, places binary, opens binary"


def _sort_bucket(number: int, rows: pa.Table, strings: Strings) -> pa.RecordBatch:
    """One bucket: the spans found inside it, and the suffixes that may have equals across its boundaries."""
    contexts = rows["context"].to_pylist()
    column = {c: rows[c].to_numpy() for c in ("t0", "t1", "left", "mask", "open", "block", "place")}
    all_ = _Suffixes(contexts, column["left"], column["mask"], strings)
    order, segment = multikey_sort(all_.cores())
    equal = np.zeros(len(order), np.int64)
    equal[order] = segment
    size = np.bincount(equal, minlength=len(order))
    reach = _Reach(len(order), strings)
    for back in range(strings.slack + 1):
        which, keys = all_.strings(back)
        same = size[equal[which]] > 1  # others have no equal core in this bucket
        which, keys = which[same], keys[same]
        sort = np.lexsort((keys, equal[which]))
        which, keys = which[sort], keys[sort]
        twin = (keys[1:] == keys[:-1]) & (equal[which[1:]] == equal[which[:-1]])
        reach.add(np.unique(np.concatenate([which[1:][twin], which[:-1][twin]])), back)
    found = reach.spans(column["block"], column["place"], column["open"])
    lead = list(zip(column["t0"].tolist(), column["t1"].tolist()))
    ends = {min(lead), max(lead)}
    edge = np.array([x in ends for x in lead])
    some = np.flatnonzero(edge)
    spans = [exchange.expand(s.as_py(), np.int64) for s in found["spans"]]
    cells = [number, exchange.squeeze(np.concatenate([np.zeros(0, np.int64), *spans])),
             exchange.squeeze(np.array([x for b, s in zip(found["block"].to_pylist(), spans) for x in (b, len(s))], np.int64)),
             b"".join(contexts[i] for i in some.tolist()), exchange.squeeze(all_.length[some]), exchange.squeeze(all_.left[some]),
             exchange.squeeze(column["mask"][some].astype(np.int64)), exchange.squeeze(column["block"][some]),
             exchange.squeeze(column["place"][some]), exchange.squeeze(column["open"][some].astype(np.uint8))]
    kinds = [pa.int64(), *[pa.binary()] * 9]
    return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=[f.split()[0] for f in SORTED.split(", ")])


def _edge_suffixes(row: dict, strings: Strings) -> tuple[_Suffixes, np.ndarray, np.ndarray, list]:
    """(suffixes at the ends of a bucket, distinct keys of their strings, whether each is there twice, its parts)."""
    length = exchange.expand(row["lengths"], np.int64)
    at = np.concatenate([[0], np.cumsum(length)]).tolist()
    contexts = [row["contexts"][a:b] for a, b in zip(at, at[1:])]
    suffixes = _Suffixes(contexts, exchange.expand(row["lefts"], np.int64), exchange.expand(row["masks"], np.int64), strings)
    parts = [(back, *suffixes.strings(back)) for back in range(strings.slack + 1)] if contexts else []
    keys, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *[p[2] for p in parts]]), return_counts=True)
    return suffixes, keys, count > 1, parts


def _edge_requests(row: dict, edges: np.ndarray, strings: Strings) -> Iterator[tuple]:
    _, keys, twice, _ = _edge_suffixes(row, strings)
    yield from exchange.requests(EDGE, row["block"], keys, twice.astype(np.uint8), edges)


def _bucket_spans(row: dict, strings: Strings) -> Iterator[pa.RecordBatch]:
    """block, spans of a bucket: those it found itself, then those across its boundaries."""
    flat, owners = exchange.expand(row["spans"], np.int64), exchange.expand(row["owners"], np.int64)
    cuts = np.cumsum(owners[1::2])[:-1] if len(owners) else []
    own = [exchange.squeeze(s) for s in np.split(flat, cuts)] if len(owners) else []
    yield pa.RecordBatch.from_arrays([pa.array(owners[0::2], pa.int64()), pa.array(own, pa.binary())], names=["block", "spans"])
    suffixes, keys, _, parts = _edge_suffixes(row, strings)
    repeats = exchange.answer_of(row["across"], EDGE, np.uint8).astype(bool)
    reach = _Reach(len(suffixes.length), strings)
    for back, rows, own_keys in parts:
        reach.add(rows[repeats[np.searchsorted(keys, own_keys)]], back)
    yield reach.spans(*(exchange.expand(row[c], np.int64) for c in ("blocks", "places")), exchange.expand(row["opens"], np.uint8).astype(bool))


def _each_row(make, schema: str, df: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = make({n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)})
                yield from made if isinstance(made, Iterator) else [made]

    return df.mapInArrow(run, schema)


def _sorted_spans(suffixes: DataFrame, edges: np.ndarray, strings: Strings) -> DataFrame:
    """block, spans of the suffixes that have to be sorted."""
    partitions = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = suffixes.repartitionByRange(partitions, "t0", "t1", "salt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield _sort_bucket(TaskContext.get().partitionId(), pa.Table.from_batches(held), strings)

    buckets = bucketed(dealt.mapInArrow(run, SORTED), "suffix_buckets", "block", partitions)
    across, _ = exchange.answered(exchange.sent(buckets, lambda row: _edge_requests(row, edges, strings)), _merge, lambda kind: np.uint8, [], "suffix-edges")
    return _each_row(lambda row: _bucket_spans(row, strings), "block long, spans binary", exchange.with_answers(buckets, across=across))


# --- result ---------------------------------------------------------------------------------


def _cover(row: dict, strings: Strings) -> tuple[np.ndarray, np.ndarray]:
    """(document offsets, whether each byte of the block goes)."""
    sieved = _Sieved(row, strings)
    cover = np.zeros(sieved.offsets[-1] + 1, np.int32)
    left, right = sieved.bounds(np.flatnonzero(sieved.settled))
    spans = [(left, right), *[np.split(exchange.expand(s, np.int64), 2) for s in row["spans"] or []]]
    for start, end in spans:
        np.add.at(cover, start, 1)
        np.subtract.at(cover, end, 1)
    return sieved.offsets, np.cumsum(cover[:-1]) > 0


def _whole_characters(text: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Which bytes of a text remain if characters that a removal cuts in two go in whole."""
    of = np.cumsum((text & 0xC0) != 0x80)
    return np.bincount(of, gone, minlength=of[-1] + 1)[of] == 0


def deduplicated(docs: DataFrame, columns: list[str], block_bytes: int = exchange.BLOCK_BYTES, with_text: bool = False,
                 whole_characters: bool = False, length: int = LONG.length) -> DataFrame:
    """The columns with n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the remaining bytes, or only
    those of whole characters)."""
    columns = [c for c in columns if c not in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")]
    strings = Strings(length)
    table = blocks(docs, columns, block_bytes, strings)
    edges = exchange.range_edges(exchange.ranges_for(docs))
    slim = table.select("block", "core", "wide")
    anchored, _ = exchange.answered(exchange.sent(slim, lambda row: _anchor_requests(row, edges)), _merge, lambda kind: _WIDE, [], "suffix-anchors")
    sieved = exchange.with_answers(table.drop("carried"), anchored=anchored)
    laddered, _ = exchange.answered(exchange.sent(sieved, lambda row: _ladder_requests(row, edges, strings)), _merge, lambda kind: np.uint8, [], "suffix-ladder")
    left = _each_row(lambda row: _survivors(row, strings), SUFFIX, exchange.with_answers(table.drop("carried"), anchored=anchored, laddered=laddered))
    spans = _sorted_spans(materialise(left, "suffixes"), edges, strings)
    spans = spans.groupBy(F.col("block").alias("_spans_of")).agg(F.collect_list("spans").alias("spans"))
    final = exchange.with_answers(table, anchored=anchored).join(spans.hint("shuffle_hash"), F.col("block") == F.col("_spans_of"), "left")

    def finish(row: dict) -> pa.RecordBatch:
        offsets, gone = _cover(row, strings)
        total = np.concatenate([[0], np.cumsum(gone)])
        before = np.zeros(len(gone), bool)
        before[1:] = gone[:-1]
        before[offsets[:-1][offsets[:-1] < len(gone)]] = False
        runs = np.concatenate([[0], np.cumsum(gone & ~before)])
        n_removed = total[offsets[1:]] - total[offsets[:-1]]
        text, kept = _text(row), []
        for a, b, n in zip(offsets[:-1].tolist(), offsets[1:].tolist(), n_removed.tolist()):
            kept.append((text[a:b][~gone[a:b]] if n else text[a:b]).tobytes())
        carried = unpack_columns(row["carried"]).to_batches()
        own = carried[0].columns if carried else []
        new = [pa.array(np.diff(offsets)), pa.array(n_removed), pa.array(runs[offsets[1:]] - runs[offsets[:-1]]),
               pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
        if with_text and whole_characters:
            for i in np.flatnonzero(n_removed).tolist():
                a, b = offsets[i], offsets[i + 1]
                kept[i] = text[a:b][_whole_characters(text[a:b], gone[a:b])].tobytes()
        if with_text:
            new.append(pa.array(kept, pa.binary()))
        names = [*columns, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        return pa.RecordBatch.from_arrays([*own, *new], names=names[: len(own) + len(new)])

    types = dict(docs.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in columns], "n_bytes long, n_removed long, n_spans long, kept_sha256 string"])
    return _each_row(finish, schema + (", kept binary" if with_text else ""), final)


def without_repeats(docs: DataFrame, length: int = LONG.length) -> DataFrame:
    """``docs`` without strings of ``length`` bytes that repeat; n_chars, if there, follows. Bytes of characters cut in two
    are left out."""
    others = [c for c in docs.columns if c != "text"]
    found = deduplicated(docs, others, with_text=True, whole_characters=True, length=length)
    found = found.withColumn("text", F.coalesce(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("")))
    if "n_chars" in others:
        found = found.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])


QUERIES = {"op1_suffix_dedup": (op1_suffix_dedup, None)}
