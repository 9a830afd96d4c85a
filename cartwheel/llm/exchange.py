"""Counting very many 64-bit keys across a corpus.

Documents are grouped into blocks (one row each, in a table bucketed by block). A block sends each of its distinct keys
once, as sorted and compressed arrays, to the key ranges; a range merges what all blocks sent and answers every block
with one value per key, in the order of the request. So a key that occurs in every document costs one entry per block,
no key is gathered row by row, and answers are small. Ranges and blocks are rows that Spark shuffles; the arrays in
them are worked on with numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.tables import materialise

BLOCK_BYTES = 4 << 20
# Ranges per shuffle partition: several, so that partitions get about the same number of keys.
RANGES_PER_PARTITION = 6

REQUEST = "kind int, range long, block long, size int, keys binary, extra binary"
ANSWER = "kind int, range long, block long, answer binary"


def squeeze(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, the bytes of equal weight together."""
    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(len(raw), -1).T if len(raw) else raw.view(np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def expand(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel() if len(raw) else np.zeros(0, dtype)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def expand_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data, np.uint64), dtype=np.uint64)


def ranges_for(df: DataFrame) -> int:
    return RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_edges(n: int) -> np.ndarray:
    """Upper ends of equal ranges of the 64-bit numbers."""
    return np.array([(i + 1) * 2**64 // n - 1 for i in range(n)], np.uint64)


def requests(kind: int, block: int, keys: np.ndarray, extra: np.ndarray, edges: np.ndarray) -> Iterator[tuple]:
    """Rows of one block for sorted distinct ``keys`` with one ``extra`` value each."""
    cuts = np.concatenate([[0], np.searchsorted(keys, edges, "right")])
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        a, b = cuts[i], cuts[i + 1]
        yield kind, i, block, int(b - a), squeeze_sorted(keys[a:b]), squeeze(extra[a:b])


def request_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    names = ["kind", "range", "block", "size", "keys", "extra"]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def sent(blocks: DataFrame, make: Callable[[dict], Iterator[tuple]]) -> DataFrame:
    """Requests of every block; ``make`` gets the row of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}
                yield request_batch(list(make(row)))

    return blocks.mapInArrow(run, REQUEST)


Merge = Callable[[int, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, dict]]


def answered(requested: DataFrame, merge: Merge, extra_type: Callable[[int], type], totals: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """(answers per block and range, totals per kind), both from a written table.

    ``merge(kind, keys, extra, sender)`` sees all keys of a range in the order of the senders, those of one sender
    sorted, and returns one value per key and the totals of the range. Totals are whole numbers.
    """
    partitions = int(requested.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = requested.repartition(partitions, "kind", "range").sortWithinPartitions("kind", "range", "block")
    schema = ", ".join([ANSWER, *[f"{t} long" for t in totals]])

    def solve(kind: int, number: int, part: list[tuple]) -> pa.RecordBatch:
        blocks, sizes, keys, extra = zip(*part)
        sizes = np.array(sizes)
        dtype = extra_type(kind)
        values, found = merge(kind, np.concatenate([expand_sorted(k) for k in keys]),
                              np.concatenate([expand(e, dtype) for e in extra]), np.repeat(np.arange(len(blocks)), sizes))
        answers = [squeeze(x) for x in np.split(values, np.cumsum(sizes)[:-1])]
        # the totals of a range stand in its first row
        own = [pa.array([int(found.get(t, 0))] + [0] * (len(blocks) - 1), pa.int64()) for t in totals]
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(blocks), pa.int32()), pa.array([number] * len(blocks), pa.int64()),
                                           pa.array(blocks, pa.int64()), pa.array(answers, pa.binary()), *own],
                                          names=["kind", "range", "block", "answer", *totals])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = None, []
        for batch in batches:
            for kind, number, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if at != (kind, number) and part:
                    yield solve(*at, part)
                    part = []
                at = (kind, number)
                part.append(row)
        if part:
            yield solve(*at, part)

    stored = materialise(dealt.mapInArrow(run, schema), label)
    summed = stored.groupBy("kind").agg(F.count("*").alias("ranges"), *[F.sum(t).alias(t) for t in totals])
    return stored.select("kind", "range", "block", "answer"), summed


def with_answers(blocks: DataFrame, **answers: DataFrame) -> DataFrame:
    """Blocks with one column per name: its answers (kind, range, answer) in the order of the ranges, null if none.

    The blocks are read by bucket and not shuffled; the answers of a block are as many as its ranges.
    """
    for name, found in answers.items():
        mine = found.groupBy(F.col("block").alias("_block")).agg(F.sort_array(F.collect_list(F.struct("kind", "range", "answer"))).alias(name))
        blocks = blocks.join(mine.hint("shuffle_hash"), F.col("block") == F.col("_block"), "left").drop("_block")
    return blocks


def answer_of(parts: list | None, kind: int, dtype) -> np.ndarray:
    """One value per key that the block requested for ``kind``."""
    found = [expand(p["answer"], dtype) for p in parts or [] if p["kind"] == kind]
    return np.concatenate(found) if found else np.zeros(0, dtype)


def first_of_group(order: np.ndarray, new: np.ndarray, eligible: np.ndarray) -> np.ndarray:
    """Marks the first eligible item of each group; ``order`` sorts stably by group and ``new`` begins a group in it."""
    group = np.cumsum(new) - 1
    picked = np.flatnonzero(eligible[order])
    _, first = np.unique(group[picked], return_index=True)
    out = np.zeros(len(order), bool)
    out[order[picked[first]]] = True
    return out


def grouped_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, new, group of each key): a stable sort by key, where groups begin in it, and the groups in input order."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(new) - 1
    return order, new, group
