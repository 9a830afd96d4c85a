"""Nearest neighbours by inner product with vantage-point trees.

Inner products become distances: every vector gets one more component that brings its length to that of the longest,
the query a zero, and the nearest by distance is the largest by inner product. The rows are dealt into shards of about
``SHARD_ROWS`` by a hash of their id, in large tables of more (``shard_count``); every shard is a vantage-point tree, and
the queries stream through all shards in blocks, so a task holds its rows and one batch of queries.
A search leaves the far side of a vantage point out when ``FACTOR`` times its distance to the border exceeds the
distance of the k-th best so far: factor 1 is the triangle inequality and exact, a greater factor prunes more. Equal
vectors are one item of a tree, with the smallest ids they need.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, and rows without an id,
take no part; vectors of different length do not meet; ties go to the smaller id; rows of a query's own id are not its
candidates; rows repeated in whole are one candidate; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.tables import materialise

NEAREST = 20
QUERY_EVERY = 20
SHARD_ROWS = 8192
LEAF = 256
FACTOR = 2.0
QUERY_BLOCK = 1024
MOST_SHARDS = 256
SHARD_BYTES = 128 << 20


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision and always summed in the order of the components."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


class VPTree:
    """Distinct vectors below vantage points; ``longest`` is the squared length all are brought to."""

    def __init__(self, vectors: np.ndarray, longest: float, leaf: int = LEAF, seed: int = 7):
        self.vectors, self.longest, self.leaf = vectors, longest, leaf
        extra = np.sqrt(np.maximum(longest - (vectors * vectors).sum(axis=1), 0.0))
        self.lifted = np.column_stack([vectors, extra])
        self.random = np.random.default_rng(seed)
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(vectors)))

    def _build(self, items: np.ndarray) -> int:
        number = len(self.nodes)
        self.nodes.append(())
        if len(items) > self.leaf:
            vantage = int(items[self.random.integers(len(items))])
            distance = np.linalg.norm(self.lifted[items] - self.lifted[vantage], axis=1)
            border = float(np.median(distance))
            inside = distance < border
            if inside.any():
                self.nodes[number] = (vantage, border, self._build(items[inside]), self._build(items[~inside]))
                return number
        self.nodes[number] = (items,)  # small, or all equally far from the vantage point
        return number

    def nearest(self, queries: np.ndarray, k: int, factor: float) -> np.ndarray:
        """Numbers of the k items found for each query (-1: none); as many items at least have the k best products."""
        self.queries, self.k, self.factor = queries, k, factor
        self.lengths = (queries * queries).sum(axis=1)
        self.score = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), -1, np.int64)
        self._visit(self.root, np.arange(len(queries)))
        return self.found

    def _reach(self, q: np.ndarray) -> np.ndarray:
        """Distance of the k-th best so far."""
        return np.sqrt(np.maximum(self.longest + self.lengths[q] - 2 * self.score[q].min(axis=1), 0.0))

    def _visit(self, number: int, q: np.ndarray) -> None:
        if not len(q):
            return
        node = self.nodes[number]
        if len(node) == 1:
            items = node[0]
            score = np.concatenate([self.score[q], self.queries[q] @ self.vectors[items].T], axis=1)
            found = np.concatenate([self.found[q], np.broadcast_to(items, (len(q), len(items)))], axis=1)
            best = np.argpartition(-score, self.k - 1, axis=1)[:, : self.k]
            self.score[q] = np.take_along_axis(score, best, axis=1)
            self.found[q] = np.take_along_axis(found, best, axis=1)
            return
        vantage, border, inside, outside = node
        square = self.longest + self.lengths[q] - 2 * (self.queries[q] @ self.vectors[vantage])
        distance = np.sqrt(np.maximum(square, 0.0))
        within = distance < border
        self._visit(inside, q[within])
        self._visit(outside, q[~within])
        cross = self.factor * np.abs(distance - border) <= self._reach(q) + 1e-9
        self._visit(outside, q[within & cross])
        self._visit(inside, q[~within & cross])


class Shard:
    """The tree of a shard's rows, for any number of queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, k: int, factor: float, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        _, first, group = np.unique(vectors.view([("", vectors.dtype)] * vectors.shape[1]).ravel(), return_index=True, return_inverse=True)
        self.members = np.split(ids[np.argsort(group, kind="stable")], np.cumsum(np.bincount(group))[:-1])
        self.distinct = vectors[first].astype(np.float64)
        self.tree = VPTree(self.distinct, longest, leaf)
        self.k, self.factor = k, factor

    def search(self, query_ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[int, list[int], list[float]]]:
        """(query id, ids, scores) of the k nearest of the shard."""
        distinct, k = self.distinct, self.k
        # one more than asked for: the query itself may be among them
        wanted = min(k + 1, len(distinct))
        for start in range(0, len(query_ids), QUERY_BLOCK):
            block = queries[start: start + QUERY_BLOCK].astype(np.float64)
            for own, query, found in zip(query_ids[start: start + QUERY_BLOCK], block, self.tree.nearest(block, wanted, self.factor)):
                found = found[found >= 0]
                score = inner_products(distinct[found], np.broadcast_to(query, (len(found), len(query))))
                pairs = sorted((-s, i) for s, f in zip(score.tolist(), found.tolist())
                               for i in np.unique(self.members[f])[: k + 1].tolist() if i != own)[:k]
                if pairs:
                    yield int(own), [i for _, i in pairs], [-s for s, _ in pairs]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding, size, square (squared length) of the rows that take part."""
    def bad(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0))
    rows = rows.filter(~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0))
    square = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x * x)
    return rows.select("vec_id", "embedding", F.size("embedding").alias("size"), square.alias("square"))


def shard_count(rows: int, size: int, shard_rows: int = SHARD_ROWS) -> int:
    """``MOST_SHARDS`` at most, as every query is copied to each, unless a shard would hold more than ``SHARD_BYTES``."""
    largest = max(shard_rows, SHARD_BYTES // (8 * size))
    return max(1, min(-(-rows // shard_rows), MOST_SHARDS), -(-rows // largest))


def answers(batches: Iterator[pa.RecordBatch], longest: float, k: int, factor: float) -> Iterator[pa.RecordBatch]:
    """Batches of (shard, size, asks, vec_id, embedding), the rows of a shard and size before its queries, to (query_id,
    ids, scores). Of the queries no more than a batch is held."""
    at, held, shard = None, [], None
    types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()))
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            *group, asks = key[:, a].tolist()
            if group != at:
                at, held, shard = group, [], None
            part = batch.slice(a, b - a)
            ids, vectors = part.column(3).to_numpy(), part.column(4).flatten().to_numpy().reshape(b - a, -1)
            if not asks:
                held.append((ids, vectors))
                continue
            if held:
                shard, held = Shard(*(np.concatenate(x) for x in zip(*held)), longest, k, factor), []
            found = list(shard.search(ids, vectors)) if shard else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=["query_id", "ids", "scores"])


def nearest(vectors: DataFrame, is_query, k: int = NEAREST, factor: float = FACTOR, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k rows nearest to each row for which the column ``is_query`` is true."""
    rows = materialise(usable(vectors), "vectors")
    n, longest, size = rows.agg(F.count("*"), F.max("square"), F.max("size")).first()
    shards = shard_count(n, size or 1, shard_rows)
    longest = float(longest or 0.0)
    own = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), "size", F.lit(False).alias("asks"), "vec_id", "embedding")
    asked = (rows.filter(is_query).dropDuplicates(["vec_id", "embedding"])
             .select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"), "size",
                     F.lit(True).alias("asks"), "vec_id", "embedding"))
    met = own.unionByName(asked).repartition("shard", "size").sortWithinPartitions("shard", "size", "asks", "vec_id")
    schema = "query_id long, ids array<long>, scores array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return answers(batches, longest, k, factor)

    near = met.mapInArrow(run, schema).select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("p"))
    near = near.select("query_id", F.col("p.ids").alias("vec_id"), F.col("p.scores").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op10_vptree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % QUERY_EVERY == 0)


QUERIES = {"op10_vptree_search": (op10_vptree_search, None)}
