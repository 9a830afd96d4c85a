"""Packing documents into training sequences by bounded-space best fit.

Texts become token ids and an end id; longer documents are cut into whole sequences and one shorter first piece. The
shorter pieces are dealt into lanes of about ``LANE_PIECES`` pieces, whatever the table holds, so a lane is a bounded
piece of work and more data means more lanes; whole sequences need none. Pieces arrive in a lane in the order of a hash,
in handfuls of ``HANDFUL`` that are placed longest first, and are packed online: open bins hang in lists by free space, a
bitset has a bit for every free space that occurs, and the smallest sufficient one is its lowest set bit from the piece's
length on. At most ``OPEN_BINS`` bins are open; when another is needed, the fullest closes for good. So a task holds a
handful of pieces and the open bins, however long its lane is.

Defined results: a null or empty text is the end id alone; repeated rows are packed as often as they come; very long
texts are cut, never shortened; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.tables import materialise
from cartwheel.llm.tokenize import default_path, groups, tokenizer

SEQUENCE = 1024
END_ID = 2
LANE_PIECES = 8192
OPEN_BINS = 256
HANDFUL = 512
_LANE_BITS = 24


class BestFit:
    """Online best fit with a bounded number of open bins."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.spaces = 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.count = self.closed = 0

    def _take(self, space: int) -> int:
        found = self.bins[space].pop()
        if not self.bins[space]:
            self.spaces &= ~(1 << space)
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fitting = self.spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(space)
        else:
            chosen, space = self.count, self.capacity
            self.count += 1
        left = space - length
        if left:
            if self.open == self.open_bins:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest closes
                self.closed += 1
            self.bins[left].append(chosen)
            self.spaces |= 1 << left
            self.open += 1
        return chosen, self.capacity - space


    def place_all(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bins, offsets) of a handful of pieces, which are placed longest first."""
        where = np.empty((len(lengths), 2), np.int64)
        for i in np.argsort(-lengths, kind="stable").tolist():
            where[i] = self.place(int(lengths[i]))
        return where[:, 0], where[:, 1]


def pieces(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids."""
    path = path or default_path()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    end = np.array([end_id], "<u4").tobytes()

    def cut(doc: int, ids: bytes):
        n, start, piece = len(ids) // 4, 0, 0
        while start < n:
            length = (n - start) % sequence or sequence
            part = ids[4 * start: 4 * (start + length)]
            yield (doc, piece, start, length, zlib.crc32(part), *([part] if with_ids else []))
            start, piece = start + length, piece + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode
        names = [f.split()[0] for f in schema.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]
        for batch in batches:
            ids = iter(batch.column(0).to_pylist())
            for part in groups([t or "" for t in batch.column(1).to_pylist()]):
                rows = [row for got in encode(part) for row in cut(next(ids), got + end)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


def _lanes(batches: Iterator[pa.RecordBatch], handful: int) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """(lane, its rows in handfuls) of rows sorted by lane, their first column."""

    def cut() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            lane = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(lane[1:] != lane[:-1]) + 1).tolist(), len(lane)]
            for a, b in zip(edges, edges[1:]):
                if b > a:
                    yield int(lane[a]), batch.slice(a, b - a)

    def whole(parts: Iterator[tuple[int, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for _, part in parts:
            while part.num_rows:
                taken = part.slice(0, handful - n)
                held.append(taken)
                n += taken.num_rows
                part = part.slice(taken.num_rows)
                if n == handful:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, n = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for lane, parts in groupby(cut(), key=lambda x: x[0]):
        yield lane, whole(parts)


def pack(cut: DataFrame, sequence: int = SEQUENCE, lane_pieces: int = LANE_PIECES, open_bins: int = OPEN_BINS,
         handful: int = HANDFUL) -> DataFrame:
    """The pieces with sequence_id and offset. ``cut`` (no columns _lane, _arrival) is read twice, so it should be a stored table."""
    whole = F.col("length") == sequence
    lanes = max(1, -(-cut.filter(~whole).count() // lane_pieces))
    columns = cut.columns
    # a row's number parts rows alike, too; the stored table gives a repeated task the same numbers
    row = F.monotonically_increasing_id()
    arrival = F.xxhash64("doc_id", "piece", "_row")
    laned = (cut.withColumn("_row", row).filter(~whole).withColumn("_arrival", arrival).withColumn("_lane", F.pmod("_arrival", F.lit(lanes)))
             .select("_lane", "_arrival", *columns).repartition("_lane").sortWithinPartitions("_lane", "_arrival"))
    schema = cut.schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lane, handfuls in _lanes(batches, handful):
            fit = BestFit(sequence, open_bins)
            for batch in handfuls:
                number, offset = fit.place_all(batch.column("length").to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array((lane << _LANE_BITS) | number), pa.array(offset)],
                                                 names=[*columns, "sequence_id", "offset"])

    # whole pieces need no place beside others: sequences of their own, numbered below zero
    alone = cut.withColumn("sequence_id", -1 - row).withColumn("offset", F.lit(0).cast("bigint")).filter(whole)
    return laned.mapInArrow(run, schema).unionByName(alone)


def pack_documents(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    return pack(materialise(pieces(docs, path, with_ids=with_ids), "pieces"))


def op2_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_pack_best_fit": (op2_pack_best_fit, None)}
