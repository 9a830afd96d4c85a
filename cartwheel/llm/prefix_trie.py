"""The prefix trie of conversations as double-array tries, one per prefix shard.

A conversation is its sequence of turns (role, text), in the order of ``turn`` (null first; equal ones by a digest of the
turn). Equal sequences are one, with the number of conversations that have it. Sequences are dealt into shards of about
``SHARD_TURNS`` turns by the digest of a prefix: of one turn, or, where more than a shard's turns begin alike, of two,
four, eight and so on, so a first turn that everything begins with is split further down. In a shard the turns become
dense numbers, and the trie is packed into the arrays BASE and CHECK: the child of state s by turn t is BASE[s] + t, and
is there if CHECK of it is s. All sequences then walk the arrays together and leave their numbers at the states.

Nodes from the prefix of their shard on are complete there. Those above it are shared by shards: each gives its part, and
numbers, smallest members, children, leaves and savings are merged over all shards; their subtree sums travel along the
digests of their ancestors, which are as few as the depth at which the shards were cut.

The digest of the conversations that end in a node is taken over a stream of sorted ids, so it needs no list of them.

Defined results: rows without conversation id belong to no conversation; a null role or text is empty; repeated rows are
turns like any other; a conversation whose rebuilt sequence is empty is a member of the root; an empty table gives no
rows; other columns are not read. A conversation's turn digests (about 50 bytes a turn, no text) are held as one row.
Digests of turns and prefixes have 128 bits of SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.arrow_groups import groups_of
from cartwheel.llm.tables import materialise

SHARD_TURNS = 1 << 18
# Conversation ids of one end that are joined in one row before they are hashed: 2 ** ID_BITS.
ID_BITS = 12
FAMILY, HEADS = 5, 9
DIGITS = 32
NOTHING = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and turns: an array of (key, size), the digest of role and text and the bytes of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGITS)
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.struct(F.col("turn").cast("bigint").alias("turn"), key.alias("key"), F.octet_length(text).cast("bigint").alias("size")).alias("t"))
    turns = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def rebuilt(own: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Sequences whose first h turns are those of the first conversation of their family; h is a hash of the id."""
    first = own.filter(F.pmod("conv_id", F.lit(family)) == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, heads - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    head = F.when(F.col("_head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("_head", F.lit(1), h))
    rest = F.slice("turns", h + 1, F.size("turns"))
    return (own.join(first, F.col("conv_id") - F.pmod("conv_id", F.lit(family)) == F.col("_base"), "left")
            .select("conv_id", F.concat(head, rest).alias("turns")))


def prefix_digest(keys: Column, depth: int | None = None) -> Column:
    """The digest of a sequence's first turns (all, without ``depth``)."""
    chosen = keys if depth is None else F.slice(keys, 1, depth)
    return F.substring(F.sha2(F.array_join(chosen, ""), 256), 1, DIGITS)


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """keys, sizes, n (conversations), conv_id (the smallest) and ends (the digest of their ids) of every distinct sequence."""
    keys = F.transform("turns", lambda t: t["key"])
    parts = (convs.withColumn("whole", prefix_digest(keys)).groupBy("whole", F.shiftright("conv_id", ID_BITS).alias("part"))
             .agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns"),
                  F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))
    rows = (parts.select("whole", "part", "n", "conv_id", "ids", keys.alias("keys"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
            .repartition("whole").sortWithinPartitions("whole", "part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, n, least, digest = None, None, 0, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([held.column("keys"), held.column("sizes"), pa.array([n], pa.int64()), pa.array([least], pa.int64()),
                                               pa.array([digest.hexdigest()])], names=["keys", "sizes", "n", "conv_id", "ends"])

        for batch in batches:
            finished = []
            for i, (whole, count, conv, ids) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("whole", "n", "conv_id", "ids")])):
                if whole != at:
                    if at is not None:
                        finished.append(done())
                    at, held, n, least, digest = whole, batch.slice(i, 1), count, conv, hashlib.sha256(ids.encode())
                else:  # parts come in ascending order of their ids
                    n += count
                    digest.update(b"," + ids.encode())
            if finished:
                yield from pa.Table.from_batches(finished).combine_chunks().to_batches()
        if at is not None:
            yield done()

    return rows.mapInArrow(run, "keys array<string>, sizes array<bigint>, n long, conv_id long, ends string")


class DoubleArray:
    """BASE and CHECK over dense turn numbers (from 1 on); state 0 is the root, and CHECK of a free place is -1."""

    def __init__(self, parent: np.ndarray, code: np.ndarray):
        """``parent`` and ``code`` of the nodes 1, 2, ... (root: 0), any order with parents first."""
        n = len(parent) + 1
        order = np.lexsort((code, parent))
        kids = np.bincount(parent, minlength=n)
        begin = np.concatenate([[0], np.cumsum(kids)])
        top = int(code.max(initial=0))
        used = np.zeros(n + top + 1, bool)
        used[0] = True
        base = np.zeros(n, np.int64)
        self.place = np.zeros(n, np.int64)
        free = 1
        many = np.flatnonzero(kids > 1)
        for node in many[np.argsort(-kids[many], kind="stable")].tolist():
            mine = order[begin[node]: begin[node + 1]]
            codes = code[mine]
            while used[free]:
                free += 1
            base[node], used = self._fit(used, codes, free)
            self.place[mine + 1] = base[node] + codes
            used[base[node] + codes] = True
        # a single child fits everywhere: they fill the places between
        single = np.flatnonzero(kids == 1)
        mine = order[begin[single]]
        gaps = np.flatnonzero(~used)[: len(single)]
        if len(gaps) < len(single):
            gaps = np.concatenate([gaps, np.arange(len(used), len(used) + len(single) - len(gaps))])
        self.place[mine + 1] = gaps
        base[single] = gaps - code[mine]
        self.base = np.zeros(max(int(self.place.max()) + 1, 1), np.int64)
        self.check = np.full(len(self.base), -1, np.int64)
        self.base[self.place] = base
        self.check[self.place[1:]] = self.place[parent]

    @staticmethod
    def _fit(used: np.ndarray, codes: np.ndarray, free: int) -> tuple[int, np.ndarray]:
        """The first base at which all codes meet free places, and the places, more of them if needed."""
        at, span = free, int(codes[-1] - codes[0])
        while True:
            if at + span + 64 >= len(used):
                used = np.concatenate([used, np.zeros(len(used) // 2 + span + 65, bool)])
            firsts = at + np.flatnonzero(~used[at: at + 64])
            bases = firsts - codes[0]
            fits = ~used[bases[:, None] + codes].any(axis=1)
            if fits.any():
                return int(bases[np.argmax(fits)]), used
            at += 64

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The next states, -1 where the trie does not go on."""
        to = self.base[states] + codes
        inside = (to > 0) & (to < len(self.check)) & (codes > 0)
        out = np.full(len(states), -1, np.int64)
        out[inside] = np.where(self.check[to[inside]] == states[inside], to[inside], -1)
        return out


def edges(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, code) of the nodes of sequences of codes, level by level."""
    node, known, width = np.zeros(len(start), np.int64), 1, int(flat.max(initial=0)) + 1
    parents, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    alive = np.flatnonzero(length > 0)
    depth = 0
    while len(alive):
        edge, which = np.unique(node[alive] * width + flat[start[alive] + depth], return_inverse=True)
        parents.append(edge // width)
        codes.append(edge % width)
        node[alive] = known + which
        known += len(edge)
        depth += 1
        alive = alive[length[alive] > depth]
    return np.concatenate(parents), np.concatenate(codes)


NODE = ("upper boolean, node string, path array<string>, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, size long, ends_sha256 string")


def shard_nodes(table: pa.Table) -> pa.Table:
    """Rows of ``NODE`` for the sequences (shard, cut, keys, sizes, n, conv_id, ends) of a shard.

    From depth ``cut`` on nodes are complete, except that those at ``cut`` have, as ``path``, the digests down to their
    parent. Nodes above are parts: the sums are those of complete nodes below them that hang on them directly.
    """
    keys, sizes = table["keys"].combine_chunks(), table["sizes"].combine_chunks()
    offsets = keys.offsets.to_numpy().astype(np.int64)
    start, length = offsets[:-1] - offsets[0], np.diff(offsets)
    turns = keys.flatten()
    spelt = turns.dictionary_encode()
    flat = spelt.indices.to_numpy().astype(np.int64) + 1
    bytes_of = np.zeros(len(spelt.dictionary) + 1, np.int64)
    bytes_of[flat] = sizes.flatten().to_numpy()
    weight, first, cut = (table[c].to_numpy() for c in ("n", "conv_id", "cut"))
    trie = DoubleArray(*edges(flat, start, length))

    places = len(trie.base)
    n, least = np.zeros(places, np.int64), np.full(places, np.iinfo(np.int64).max)
    depth, size, limit, holder = (np.zeros(places, np.int64) for _ in range(4))
    state, alive, levels, level = np.zeros(len(start), np.int64), np.arange(len(start)), [], 0
    while len(alive):
        here = state[alive]
        np.add.at(n, here, weight[alive])
        np.minimum.at(least, here, first[alive])
        depth[here], limit[here], holder[here] = level, cut[alive], alive
        levels.append(np.unique(here))
        alive = alive[length[alive] > level]
        codes = flat[start[alive] + level]
        state[alive] = trie.step(state[alive], codes)
        size[state[alive]] = bytes_of[codes]
        level += 1
    children = np.bincount(trie.check[trie.check >= 0], minlength=places)
    whole = depth >= limit
    leaves = (children == 0).astype(np.int64)
    saved = (n - 1) * size
    # what hangs above the cut is summed over all shards later: there only the parts of the complete nodes count
    leaves[~whole] = saved[~whole] = children[~whole] = 0
    for mine in reversed(levels[1:]):
        mine = mine[whole[mine]]
        up = trie.check[mine]
        np.add.at(leaves, up, leaves[mine])
        np.add.at(saved, up, saved[mine])
        np.add.at(children, up[~whole[up]], 1)
    ends = np.full(places, None, object)
    ends[state] = table["ends"].to_numpy()

    every = np.concatenate(levels)
    digests: dict[tuple[int, int], str] = {}

    def path(place: int, upto: int) -> list[str]:
        """Digests of the first prefixes, from the root to depth ``upto``."""
        at = int(start[holder[place]])
        out, running = [], hashlib.sha256()
        for i in range(upto + 1):
            if i:
                running.update(turns[at + i - 1].as_py().encode())
            out.append(running.copy().hexdigest()[:DIGITS])
        return out

    paths: list[list[str] | None] = [None] * len(every)
    for i in np.flatnonzero(depth[every] <= limit[every]).tolist():
        place = int(every[i])
        above = int(depth[place]) - bool(whole[place])
        # children of one parent share its digests
        known = (int(trie.check[place]) if whole[place] else place, above)
        if known not in digests:
            digests[known] = path(place, above)
        paths[i] = digests[known]
    up = trie.check[every]
    inner = (up >= 0) & (depth[every] > limit[every])
    return pa.Table.from_arrays([
        pa.array(~whole[every]), pa.array([p[-1] if p else None for p in paths], pa.string()), pa.array(paths, pa.list_(pa.string())),
        pa.array(least[every]), pa.array(depth[every]), pa.array(np.where(inner, least[up], 0), mask=~inner), pa.array(n[every]),
        pa.array(children[every]), pa.array(leaves[every]), pa.array(saved[every]), pa.array(size[every]),
        pa.array(ends[every], pa.string())], names=[f.split()[0] for f in NODE.split(", ")])


def sharded(found: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The sequences with shard and cut: how many turns long the prefix is that names the shard."""
    weight = F.size("keys") + 1
    shards = max(1, -(-(found.agg(F.sum(weight)).first()[0] or 0) // shard_turns))
    rows, depth = found.withColumn("cut", F.lit(1)), 1
    left = found.select("keys")
    while True:
        named = left.withColumn("_p", prefix_digest(F.col("keys"), depth))
        # one sequence alone is not split, nor are those that all end here
        hot = (named.groupBy("_p").agg(F.sum(weight).alias("w"), F.count("*").alias("c"), F.max(F.size("keys")).alias("m"))
               .filter((F.col("w") > shard_turns) & (F.col("c") > 1) & (F.col("m") > depth)).select("_p"))
        hot = materialise(hot, "trie-hot")
        if hot.isEmpty():
            break
        left = named.join(hot, "_p", "left_semi").drop("_p")
        marked = rows.withColumn("_p", F.when(F.col("cut") == depth, prefix_digest(F.col("keys"), depth)))
        rows = (marked.join(hot.withColumn("_hot", F.lit(True)), "_p", "left")
                .withColumn("cut", F.when(F.col("_hot"), F.lit(2 * depth)).otherwise(F.col("cut"))).drop("_p", "_hot"))
        depth *= 2
    prefix = F.substring(F.sha2(F.array_join(F.slice("keys", F.lit(1), F.col("cut")), ""), 256), 1, DIGITS)
    return rows.withColumn("shard", F.pmod(F.xxhash64(prefix), F.lit(shards)))


def merged(parts: DataFrame) -> DataFrame:
    """All nodes, from the rows of all shards."""
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    upper = parts.filter("upper").groupBy("node").agg(
        F.first("path").alias("path"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max("size").alias("size"), F.max("ends_sha256").alias("ends_sha256"))
    upper = upper.withColumn("parent", F.when(F.col("depth") > 0, F.element_at("path", -2)))
    below = upper.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    upper = upper.join(below, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    upper = (upper.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("bigint"))
             .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")))
    upper = materialise(upper, "trie-upper")
    sums = (upper.select(F.explode("path").alias("node"), "n_leaves", "saved_tokens").groupBy("node")
            .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    named = upper.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    shared = upper.drop("n_leaves", "saved_tokens").join(sums, "node").join(named, "parent", "left").select(columns)
    # a node right below the cut has its parent's digest as its own name
    top = parts.filter("not upper and node is not null").drop("parent_conv_id").join(named, F.col("node") == F.col("parent")).select(columns)
    deep = parts.filter("not upper and node is null").select(columns)
    return shared.unionByName(top).unionByName(deep).fillna({"ends_sha256": NOTHING})


def prefix_nodes(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of ``convs`` (conv_id, turns): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256."""
    found = materialise(distinct_sequences(convs), "trie-sequences")
    dealt = sharded(found, shard_turns).select("shard", "cut", "keys", "sizes", "n", "conv_id", "ends").repartition("shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches):
            yield from shard_nodes(table).to_batches(max_chunksize=1 << 14)

    return merged(materialise(dealt.mapInArrow(run, NODE), "trie-nodes"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_nodes(rebuilt(sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


QUERIES = {"op11_conversation_trie": (op11_conversation_trie, None)}
