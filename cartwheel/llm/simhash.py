"""SimHash near-duplicates, found with BK-trees.

A fingerprint has a bit for every bit that more than half of the shingle hashes have. Equal fingerprints are one node.
Two fingerprints within ``RADIUS`` bits agree on at least blocks - radius of any ``BLOCKS`` blocks of bits, so every
choice of that many blocks is a way to deal fingerprints into shards, and two linked ones share a shard in at least one
way. Each shard is a BK-tree: children hang below their parent by Hamming distance, and a search follows only the
edges within the radius of its own distance. The trees reach their queries by the shuffle: together they grow with the
corpus, so they are not broadcast. A shard gives links that span its groups, never all its pairs; a shard larger than
``TREE_NODES`` is split into pieces, and every pair of pieces is a shard of its own. The links then shrink to stars in
rounds, each written to the shared folder; they settle in a number of rounds that grows with the logarithm of the longest
chain, and if ``MAX_ROUNDS`` were not enough the query would end with an error, not with wrong groups.

Near copies in the pipeline have a Jaccard similarity of 0.8 and more, which fingerprints only estimate and which reaches
beyond a radius of four. There the candidates are the links of the fingerprints, found by the same BK-trees, and those of
MinHash: ``BANDS`` groups of ``BAND_ROWS`` minima, whatever the table's size, so a pair at 0.8 shares no band with a chance
of 3 in 100,000 and closer pairs far more rarely. Only links confirmed on the shingle hashes themselves count: texts that
candidates connect meet in a shard, in pieces if there are many, and every pair of pieces is a shard.

Defined results: a null, empty or blank text has fingerprint zero and is linked like any other; fewer words than a
shingle needs are one shingle; repeated rows and ids each get their row; a null id is in the component of its
fingerprint and never names it; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.tables import materialise
from cartwheel.llm.textops import mix

SHINGLE = 4
RADIUS = 4
BLOCKS = 6
TREE_NODES = 4096
SEED = 42
MAX_ROUNDS = 60


def fingerprint(text: str | None, shingle: int = SHINGLE, words: int = 1) -> np.ndarray:
    """SimHash of one text, 64 bits per word: bytes lower-cased A-Z, split at the six ASCII spaces, shingles joined by a
    space. The first word is of the shingles' hashes, the others of further hashes of those."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(words, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(parts))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())]
    ones = np.zeros((words, 64), np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[i: i + (1 << 14)], "<u8")
        for word in range(words):
            mine = mix(part + np.uint64(word) * np.uint64(0x9E3779B97F4A7C15)) if word else part
            ones[word] += np.unpackbits(mine.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), axis=1, bitorder="little").view("<u8").ravel()


def columns_of(words: int) -> list[str]:
    return [f"fp{i}" for i in range(words)]


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, words: int = 1) -> DataFrame:
    """doc_id, digest (of the text) and the fingerprint as signed numbers fp0, fp1, ..."""
    names = ["doc_id", "digest", *columns_of(words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle, words) for t in batch.column(2)], np.uint64).reshape(-1, words).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *[pa.array(np.ascontiguousarray(found[:, i])) for i in range(words)]], names=names)

    schema = "doc_id long, digest string, " + ", ".join(f"{c} long" for c in columns_of(words))
    return (docs.select(F.col("doc_id").cast("bigint"), F.md5("text").alias("digest"), F.col("text").cast("string"))
            .mapInArrow(run, schema))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distance of fingerprints, one per row."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


_EDGES = 1 << 16


class BKTree:
    """Levels of nodes; all items are inserted together, and many queries descend together."""

    def __init__(self, items: np.ndarray):
        self.items = items
        n = len(items)
        self.child_parent, self.child_distance, self.child = [], [], []
        left, parent = np.arange(1, n), np.zeros(max(n - 1, 0), np.int64)
        while len(left):
            apart = distance(self.items[left], self.items[parent])
            # the first item at each distance of each parent is a child, the others go below it
            edge, first, belongs = np.unique(parent * _EDGES + apart, return_index=True, return_inverse=True)
            self.child_parent.append(edge // _EDGES)
            self.child_distance.append(edge % _EDGES)
            self.child.append(left[first])
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, parent = left[rest], left[first][belongs][rest]
        self._index(n)

    def _index(self, n: int) -> None:
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.child_parent, self.child_distance, self.child)]
        order = np.argsort(joined[0], kind="stable")
        self.of, self.distance, self.child = (x[order] for x in joined)
        self.begin = np.searchsorted(self.of, np.arange(n + 1))

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, item number) of every pair within the radius."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        found_q, found_i = [], []
        while len(q):
            d = distance(queries[q], self.items[node])
            near = d <= radius
            found_q.append(q[near])
            found_i.append(node[near])
            count = self.begin[node + 1] - self.begin[node]
            edges = np.repeat(self.begin[node], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            q, d = np.repeat(q, count), np.repeat(d, count)
            follow = np.abs(self.distance[edges] - d) <= radius
            q, node = q[follow], self.child[edges[follow]]
        return np.concatenate(found_q), np.concatenate(found_i)


def spanning_links(items: np.ndarray, radius: int, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the items of links that connect exactly what the pairs within the radius connect; fewer than items."""
    tree = BKTree(items)
    root = np.arange(len(items))
    out_a, out_b = [], []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for start in range(0, len(items), block):
        q, i = tree.within(items[start: start + block], radius)
        q += start
        later = q > i
        q, i = q[later], i[later]
        # pairs whose ends are in one group already say nothing new
        flat = np.array([find(x) for x in range(len(items))]) if len(q) > len(items) else root
        new = flat[q] != flat[i]
        for a, b in zip(q[new].tolist(), i[new].tolist()):
            ra, rb = find(a), find(b)
            if ra != rb:
                root[max(ra, rb)] = min(ra, rb)
                out_a.append(a)
                out_b.append(b)
    return np.array(out_a, np.int64), np.array(out_b, np.int64)


def block_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[list[int]]:
    """One mask per choice of blocks - radius blocks of a 64-bit fingerprint: links within the radius share all bits of one."""
    if blocks <= radius:
        raise ValueError("more blocks than the radius are needed")
    edges = np.linspace(0, 64, blocks + 1).astype(int).tolist()
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [[sum(chosen)] for chosen in combinations(masks, blocks - radius)]


def links(fps: DataFrame, masks: list[list[int]], radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Spanning links (a, b) between the numbers ``node`` of distinct fingerprints fp0, ..."""
    words = len(masks[0])
    columns = columns_of(words)

    def signed(mask: int) -> Column:
        return F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask)

    # a clash of two shards' hashes only makes one tree of two
    keys = F.array(*[F.xxhash64(F.lit(n), *[F.col(c).bitwiseAND(signed(m)) for c, m in zip(columns, mask)]) for n, mask in enumerate(masks)])
    dealt = fps.select("node", *columns, F.explode(keys).alias("shard"))
    large = materialise(dealt.groupBy("shard").agg(F.count("*").alias("n")).filter(F.col("n") > tree_nodes), "large-shards")
    if not large.isEmpty():
        dealt = dealt.join(large, "shard", "left")
        pieces = F.coalesce(F.ceil(F.col("n") / F.lit(tree_nodes)), F.lit(1))
        dealt = (dealt.withColumn("own", F.pmod(F.xxhash64("node"), pieces))
                 .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1)))
                 .withColumn("shard", F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other"))))
    rows = dealt.select("shard", "node", *columns).repartition("shard").sortWithinPartitions("shard", "node")

    def solve(shard: np.ndarray, node: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(shard):
            return
        begin = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1])
        size = np.diff(np.append(begin, len(shard)))
        two = begin[size == 2]
        near = two[distance(fp[two], fp[two + 1]) <= radius]
        a, b = [node[near]], [node[near + 1]]
        for start, n in zip(begin[size > 2].tolist(), size[size > 2].tolist()):
            x, y = spanning_links(fp[start: start + n], radius)
            a.append(node[start + x])
            b.append(node[start + y])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, words), np.uint64)]
        for batch in batches:
            new = [c.to_numpy() for c in batch.columns]
            fresh = new[0], new[1], np.column_stack(new[2:]).astype(np.int64).view(np.uint64).reshape(-1, words)
            held = [np.concatenate(x) for x in zip(held, fresh)]
            # the last shard of the batch may go on in the next
            cut = int(np.flatnonzero(held[0] == held[0][-1])[0]) if len(held[0]) else 0
            yield from solve(*[h[:cut] for h in held])
            held = [h[cut:] for h in held]
        yield from solve(*held)

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) of the nodes that occur in ``edges`` (a, b).

    Large-star and small-star in turn: every node hangs its greater, then its smaller neighbours below the smallest
    one, until nothing changes. Neighbourhoods are reduced to their minimum map side and joined back, so a node with
    very many neighbours is never gathered in one task.
    """
    def stars(e: DataFrame, center: str, leaf: str, least: Column) -> DataFrame:
        m = e.groupBy(F.col(center).alias("c")).agg(F.min(leaf).alias("m")).withColumn("m", least)
        return e.join(m, F.col(center) == F.col("c"))

    e = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stars(both, "u", "v", F.least("c", "m")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = stars(large, "u", "v", F.col("m"))
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        e = materialise(small, "stars")
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("the components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def grouped(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """doc_id, digest, the fingerprint, component (a number) and component_id (smallest document id reachable over links)."""
    rows = materialise(fingerprints(docs, shingle), "fingerprints")
    nodes = materialise(rows.groupBy("fp0").agg(F.min("doc_id").alias("first")).withColumn("node", F.col("fp0")), "nodes")
    found = components(links(nodes, block_masks(radius), radius, tree_nodes))
    rooted = nodes.drop("fp0").join(found, "node", "left").withColumn("component", F.coalesce("root", "node"))
    named = rooted.groupBy("component").agg(F.min("first").alias("component_id"))
    by_node = rooted.select("node", "component").join(named, "component")
    # few nodes hold many rows when there are many copies: adaptive execution splits them on the side of the rows
    return rows.withColumn("node", F.col("fp0")).join(by_node, "node").drop("node")


SIMILAR = 0.8
BANDS, BAND_ROWS = 56, 8
PIECE_BYTES = 4 << 20
_FACTORS = np.random.default_rng(11).integers(0, 1 << 31, BANDS * BAND_ROWS, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text, words and shingles as for ``fingerprint``."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(parts))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())], np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A signed number for each band: its minima of the hashes under ``BAND_ROWS`` of the fixed multiplications."""
    if not len(hashes):
        return []
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_FACTORS), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(short), 512):
        np.minimum(least, (_FACTORS * short[i: i + 512]).min(axis=1), out=least)
    return [xxhash.xxh64_intdigest(row.tobytes(), n) - (1 << 63) for n, row in enumerate(least.reshape(BANDS, BAND_ROWS))]


def similar_links(sets: list[np.ndarray], least: float = SIMILAR) -> list[tuple[int, int]]:
    """Links that connect exactly what the pairs with a Jaccard similarity of ``least`` connect; fewer than sets."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)[np.argsort(place, kind="stable")]
    begin = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(values)))])
    own = np.concatenate([[0], np.cumsum(sizes)])

    def near(i: int) -> np.ndarray:
        shared = np.zeros(n, np.int64)
        mine = place[own[i]: own[i + 1]]
        for at in range(0, len(mine), 256):
            part = mine[at: at + 256]
            count = begin[part + 1] - begin[part]
            held = np.repeat(begin[part] - np.cumsum(count) + count, count) + np.arange(count.sum())
            shared += np.bincount(owner[held], minlength=n)
        return np.flatnonzero((shared > 0) & (shared >= least * (sizes + sizes[i] - shared) - 1e-9))

    label, out, asked = np.full(n, -1), [], np.zeros(n, bool)

    def join(i: int, found: np.ndarray) -> None:
        for x in found[label[found] != label[i]].tolist():
            if label[x] != label[i]:
                out.append((i, x))
                label[label == label[x]] = label[i]

    for i in range(n):  # stars first
        if label[i] < 0:
            asked[i] = True
            found = near(i)
            new = found[label[found] < 0]
            label[new] = label[i] = i
            out += [(i, x) for x in new.tolist() if x != i]
            join(i, found)
    # a link between two groups has an end outside the largest one
    for i in np.flatnonzero((label != np.bincount(label).argmax()) & ~asked).tolist():
        join(i, near(i))
    return out


def _signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, digest (of the text), node (of its set of shingles), the keys of its bands and the fingerprint fp0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys, prints = [], [], []
            for text in batch.column(2):
                hashes = shingle_hashes(text.as_py(), shingle)
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED) - (1 << 63))
                keys.append(band_keys(hashes))
                prints.append(fingerprint(text.as_py(), shingle))
            found = np.array(prints, np.uint64).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(found)],
                                             names=["doc_id", "digest", "node", "keys", "fp0"])

    return (docs.select(F.col("doc_id").cast("bigint"), F.md5("text").alias("digest"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, digest string, node long, keys array<long>, fp0 long"))


def _print_links(rows: DataFrame, radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Links (a, b) of nodes whose fingerprints are within the radius: equal ones to the least node, the others by BK-trees."""
    held = rows.filter(F.size("keys") > 0).select("node", "fp0").distinct()
    prints = materialise(held.groupBy("fp0").agg(F.min("node").alias("least")), "prints")
    equal = held.join(prints, "fp0").filter("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    near = links(prints.select("fp0", F.col("fp0").alias("node")), block_masks(radius), radius, tree_nodes)
    named = near.join(prints.select(F.col("fp0").alias("a"), F.col("least").alias("_a")), "a")
    named = named.join(prints.select(F.col("fp0").alias("b"), F.col("least").alias("_b")), "b")
    return equal.unionByName(named.select(F.col("_a").alias("a"), F.col("_b").alias("b")).filter("a <> b"))


def _confirmed(texts: DataFrame, shingle: int, piece_bytes: int) -> DataFrame:
    """Links (a, b) of ``texts`` (node, root, text) that share the root and are similar."""
    total = texts.groupBy("root").agg(F.sum(F.octet_length("text")).alias("_bytes"))
    pieces = F.greatest(F.ceil(F.col("_bytes") / F.lit(piece_bytes)), F.lit(1).cast("bigint"))
    dealt = texts.join(total, "root").withColumn("pieces", pieces).withColumn("own", F.pmod(F.xxhash64("node"), F.col("pieces")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1))).filter("pieces = 1 or own <> other")
    dealt = dealt.select(F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("shard"), "node", "text")
    rows = dealt.repartition("shard").sortWithinPartitions("shard", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, sets = None, [], []

        def solve() -> Iterator[pa.RecordBatch]:
            found = similar_links(sets) if len(sets) > 1 else []
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array([nodes[x] for x in a], pa.int64()), pa.array([nodes[x] for x in b], pa.int64())], names=["a", "b"])

        for batch in batches:
            for shard, node, text in zip(*batch.columns):
                if shard.as_py() != at:
                    yield from solve()
                    at, nodes, sets = shard.as_py(), [], []
                nodes.append(node.as_py())
                sets.append(shingle_hashes(text.as_py(), shingle))
        yield from solve()

    return rows.mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, shingle: int, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """doc_id, digest and component (a number): texts linked by a Jaccard similarity of ``SIMILAR`` of their shingles."""
    rows = materialise(_signatures(docs, shingle), "signatures")
    best = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    nodes = materialise(rows.groupBy("node").agg(F.min(best).alias("k"), F.first("keys").alias("keys")), "nodes")
    banded = nodes.select("node", F.explode("keys").alias("key"))
    least = banded.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    met = banded.join(least, "key").filter("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    met = components(met.unionByName(_print_links(rows)))
    wanted = nodes.select("node", F.col("k.doc_id").alias("_id"), F.col("k.digest").alias("_digest")).join(met, "node")
    texts = docs.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & F.md5("text").eqNullSafe(F.col("_digest")))
    texts = materialise(texts.groupBy("node", "root").agg(F.min("text").alias("text")), "candidates")
    found = components(_confirmed(texts, shingle, piece_bytes))
    return rows.drop("keys", "fp0").join(found, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("node", "root")


def keep_first(docs: DataFrame, shingle: int) -> DataFrame:
    """One row of every group of near copies: the smallest id, a null id last; of rows with that id, one text."""
    found = materialise(near_copies(docs, shingle), "groups")
    best = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    kept = found.groupBy("component").agg(F.min(best).alias("k"))
    kept = materialise(kept.select(F.col("k.doc_id").alias("_id"), F.col("k.digest").alias("_digest")).distinct(), "kept-ids")
    rows = docs.join(kept.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & F.md5("text").eqNullSafe(F.col("_digest")))
    repeated = found.groupBy("doc_id", "digest").count().filter("count > 1").isEmpty()
    return (rows if repeated else rows.dropDuplicates(["_id", "_digest"])).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = grouped(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digits = F.lower(F.lpad(F.hex("fp0"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


QUERIES = {"op6_simhash_groups": (op6_simhash_groups, None)}
