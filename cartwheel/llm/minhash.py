"""MinHash near-duplicates: universal hash minima, banding, signature verification, alternating stars.

A text is the set of its distinct five-word shingles; two texts are linked when 100 * intersection >= ``PERCENT`` * union.
``BANDS`` x ``ROWS`` minima under multiply-add-shift functions (strongly universal from 32 to 32 bits) make the keys of
the bands; a pair at a similarity of 0.85 shares no band with a chance of 4 in 10 million, closer pairs far more rarely.
Equal sets are one node. A byte of every minimum is the signature, on which pairs are verified before any text travels: a
pair at 0.85 falls ``SLACK`` below its similarity with a chance below 1 in a billion. What remains is confirmed on the full sets.

A bucket never gives all its pairs. In ``STAR_ROUNDS`` rounds every node is compared with one pivot only, the one it
shares most bands with; every bucket draws its own pivot. Alternating large-star and small-star turns the confirmed links
into components, and a bucket that lies in one component is done. In the others every member outside the component with
most members there is then compared with all members of other components, in pieces of bounded size, so no link between
components can be left. Pieces that meet in pairs are the price for groups that are neither one component after the star
rounds nor small; nothing is dropped.

Defined results: a null, empty or blank text has no shingles and is linked with nothing; fewer than five words are one
shingle; repeated rows and ids each get their row; a null id never names a component, and is kept when its component has
no id at all; texts of any length are whole; an empty table gives no rows; other columns are not read. Words and shingles
are 64-bit hashes: two of the n different shingles of a pair of texts clash with a chance of n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import textops
from cartwheel.llm.arrow_groups import groups_of
from cartwheel.llm.simhash import components
from cartwheel.llm.tables import materialise

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 56, 9
# How far the share of agreeing bytes may lie below the similarity asked for.
SLACK = 0.1
STAR_ROUNDS = 1
# Rows of signatures and bytes of shingle hashes that a pair of pieces holds at most (a single longer text is a piece).
ASKER_ROWS, MEMBER_ROWS = 512, 4096
PIECE_BYTES = 4 << 20

_RNG = np.random.default_rng(13)
_FACTOR, _TERM = _RNG.integers(0, 1 << 64, (2, BANDS * ROWS, 1), dtype=np.uint64)
_BAND = _RNG.integers(0, 1 << 64, BANDS, dtype=np.uint64)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text."""
    buffer, offsets = textops.text_buffer(column)
    for first, last in textops.chunks(offsets):
        part = textops.LOWER[buffer[offsets[first]: offsets[last]]]
        starts, ends, doc = textops.words(part, offsets[first: last + 1] - offsets[first])
        hashes = textops.RollingHash(part).of(starts, ends)
        bounds = np.searchsorted(doc, np.arange(last - first + 1))
        keys = textops.window_keys(hashes, size)
        inside = doc[: len(keys)] == doc[size - 1: size - 1 + len(keys)]
        keys, owner = keys[inside], doc[: len(keys)][inside]
        order = np.lexsort((keys, owner))
        keys, owner = keys[order], owner[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        cuts = np.searchsorted(owner[new], np.arange(last - first + 1))
        keys = keys[new]
        for i in range(last - first):
            n = bounds[i + 1] - bounds[i]
            yield keys[cuts[i]: cuts[i + 1]] if n >= size or not n else textops.window_keys(hashes[bounds[i]: bounds[i + 1]], int(n))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of a set under each of the universal functions, 32 bits."""
    x = hashes >> np.uint64(32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i in range(0, len(x), 512):
        values = _FACTOR * x[i: i + 512]
        values += _TERM
        np.minimum(least, values.min(axis=1), out=least)
    return least >> np.uint64(32)


def band_keys(least: np.ndarray) -> np.ndarray:
    """A number for each band of each row of minima."""
    grouped = least.reshape(-1, BANDS, ROWS)
    out = np.broadcast_to(_BAND, grouped.shape[:2]).copy()
    for i in range(ROWS):
        out = textops.mix(out * np.uint64(0x9FB21C651E98DF25) + grouped[:, :, i])
    return out.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text), set (128 bits, null if empty), n_shingles, bands and signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sets = list(shingle_sets(part.column(2)))
                least = np.array([minima(s) for s in sets], np.uint64).reshape(-1, BANDS * ROWS)
                full = np.array([len(s) > 0 for s in sets], bool)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(band_keys(least).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()), bands,
                     pa.array([row.tobytes() if some else None for row, some in zip(least.astype(np.uint8), full)], pa.binary())],
                    names=["doc_id", "digest", "set", "n_shingles", "bands", "signature"])

    return (docs.select(F.col("doc_id").cast("bigint"), F.md5("text").alias("digest"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, digest string, set binary, n_shingles long, bands array<long>, signature binary"))


def _paired(rows: DataFrame, ask_weight: str, ask_most: int, weight: str, most: int) -> DataFrame:
    """Members and askers of every shard dealt into pieces; each piece of askers meets each piece of members.

    ``rows`` (shard, node, comp, asks, ...): members have ``asks`` false, and askers come a second time with true.
    """
    total = rows.groupBy("shard").agg(
        F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("asks"), F.expr(ask_weight))) / F.lit(ask_most))).cast("int").alias("_ask"),
        F.greatest(F.lit(1), F.ceil(F.sum(F.when(~F.col("asks"), F.expr(weight))) / F.lit(most))).cast("int").alias("_all"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("asks"), F.col("_ask")).otherwise(F.col("_all"))).cast("int")
    others = F.sequence(F.lit(0), F.when(F.col("asks"), F.col("_all")).otherwise(F.col("_ask")) - 1)
    dealt = rows.join(total, "shard").withColumn("_own", own).withColumn("_other", F.explode(others))
    piece = F.when(F.col("asks"), F.struct(F.col("_own").alias("x"), F.col("_other").alias("y"))).otherwise(F.struct(F.col("_other").alias("x"), F.col("_own").alias("y")))
    return dealt.select("shard", piece["x"].alias("x"), piece["y"].alias("y"), *[c for c in rows.columns if c != "shard"])


def _verified(rows: DataFrame, marks: DataFrame, agreeing: float) -> DataFrame:
    """The rows (shard, node, comp, asks) that agree, by their signatures, with one of the other kind from another component."""
    dealt = _paired(rows, "1", ASKER_ROWS, "1", MEMBER_ROWS).join(marks, "node")
    dealt = (dealt.select("shard", "x", "y", "node", "comp", "asks", "signature").repartition("shard", "x", "y")
             .sortWithinPartitions("shard", "x", "y", "asks", "node"))
    need = int(np.ceil(agreeing * BANDS * ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, 3):
            asks = table["asks"].combine_chunks().to_numpy(zero_copy_only=False)
            node, comp = (table[c].to_numpy() for c in ("node", "comp"))
            marks = np.array([np.frombuffer(s.as_py(), np.uint8) for s in table["signature"]])
            keep = np.zeros(len(node), bool)
            members, askers = np.flatnonzero(~asks), np.flatnonzero(asks)
            step = max(1, (8 << 20) // (max(1, len(members)) * BANDS * ROWS))
            for i in range(0, len(askers), step):
                part = askers[i: i + step]
                near = (marks[part][:, None] == marks[members]).sum(axis=2, dtype=np.int32) >= need
                near &= comp[part][:, None] != comp[members]
                keep[part] |= near.any(axis=1)
                keep[members] |= near.any(axis=0)
            shard = table["shard"].to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(shard[keep]), pa.array(node[keep]), pa.array(comp[keep]), pa.array(asks[keep])],
                                             names=["shard", "node", "comp", "asks"])

    return dealt.mapInArrow(run, "shard long, node long, comp long, asks boolean")


def set_links(askers: list[np.ndarray], asker_comp: np.ndarray, members: list[np.ndarray], member_comp: np.ndarray,
              percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links (asker, member) that connect exactly the components that similar pairs of an asker and a member connect."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sizes = np.array([len(s) for s in members])
    values, place = np.unique(np.concatenate(members), return_inverse=True)
    holder = np.repeat(np.arange(len(members)), sizes)[np.argsort(place, kind="stable")]
    begin = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(values)))])
    out = []
    for i, own in enumerate(askers):
        at = np.searchsorted(values, own)
        own_in = at < len(values)
        own_in[own_in] = values[at[own_in]] == own[own_in]
        at = at[own_in]
        shared = np.zeros(len(members), np.int64)
        for start in range(0, len(at), 256):
            part = at[start: start + 256]
            count = begin[part + 1] - begin[part]
            held = np.repeat(begin[part] - np.cumsum(count) + count, count) + np.arange(count.sum())
            shared += np.bincount(holder[held], minlength=len(members))
        near = (shared > 0) & (100 * shared >= percent * (sizes + len(own) - shared)) & (member_comp != asker_comp[i])
        for j in np.flatnonzero(near).tolist():
            a, b = find(int(asker_comp[i])), find(int(member_comp[j]))
            if a != b:
                root[a] = b
                out.append((i, j))
    return out


def _confirmed(rows: DataFrame, texts: DataFrame, percent: int, shingle: int, piece_bytes: int) -> DataFrame:
    """Links (a, b) between the nodes of ``rows`` (shard, node, comp, asks), decided on the full sets."""
    sized = rows.join(texts.select("node", "n_shingles"), "node")
    dealt = _paired(sized, "8 * n_shingles", piece_bytes, "8 * n_shingles", piece_bytes).join(texts.select("node", "text"), "node")
    dealt = (dealt.select("shard", "x", "y", "node", "comp", "asks", "text").repartition("shard", "x", "y")
             .sortWithinPartitions("shard", "x", "y", "asks", "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, 3):
            asks = table["asks"].combine_chunks().to_numpy(zero_copy_only=False)
            if asks.all() or not asks.any():
                continue
            node, comp = (table[c].to_numpy() for c in ("node", "comp"))
            # pieces of signatures may have found a row several times
            new = np.ones(len(node), bool)
            new[1:] = (node[1:] != node[:-1]) | (asks[1:] != asks[:-1])
            table, node, comp, asks = table.filter(pa.array(new)), node[new], comp[new], asks[new]
            sets = [s for chunk in table["text"].chunks for s in shingle_sets(chunk, shingle)]
            members, askers = np.flatnonzero(~asks), np.flatnonzero(asks)
            found = set_links([sets[i] for i in askers], comp[askers], [sets[i] for i in members], comp[members], percent)
            a, b = np.array(found, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(node[askers[a]]), pa.array(node[members[b]])], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _with_component(buckets: DataFrame, found: DataFrame | None) -> DataFrame:
    """Rows (key, node, comp) of the buckets that are not of one component."""
    if found is None:
        return buckets.withColumn("comp", F.col("node"))
    named = buckets.join(found.select("node", "root"), "node", "left").select("key", "node", F.coalesce("root", "node").alias("comp"))
    several = named.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b").select("key")
    return named.join(several, "key")


def _star_shards(opened: DataFrame, number: int) -> DataFrame:
    """Every node with the pivot, of another component, that it shares most buckets with."""
    order = F.xxhash64("node", "key", F.lit(number))
    pivots = opened.groupBy("key").agg(F.min_by(F.struct("node", "comp"), order).alias("p"))
    # dealt by node once, for both groupings
    asked = (opened.join(pivots, "key").filter("comp <> p.comp").repartition("node")
             .groupBy("node", "comp", "p").agg(F.count("*").alias("n")))
    best = asked.groupBy("node", "comp").agg(F.max_by("p", F.struct("n", "p.node")).alias("p"))
    members = best.select(F.col("p.node").alias("shard"), "node", "comp", F.lit(False).alias("asks"))
    return members.unionByName(best.select(F.col("p.node").alias("shard"), F.col("p.node").alias("node"), F.col("p.comp").alias("comp"), F.lit(True).alias("asks")).distinct())


def _whole_shards(opened: DataFrame) -> DataFrame:
    """Every bucket, those of the same members once; who is not of its greatest component asks all others."""
    alike = opened.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("s"))
    once = alike.groupBy("n", "s").agg(F.min("key").alias("key")).select("key")
    rows = opened.join(once, "key")
    most = rows.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("most"))
    rows = rows.join(most, "key").select(F.col("key").alias("shard"), "node", "comp", (F.col("comp") != F.col("most")).alias("outside"))
    kinds = F.when(F.col("outside"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return rows.select("shard", "node", "comp", F.explode(kinds).alias("asks"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, star_rounds: int = STAR_ROUNDS,
                    piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """doc_id, digest, n_shingles, component_id (smallest id reachable over links, itself included) and kept."""
    rows = materialise(signatures(docs), "minhash-signatures")
    best = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    nodes = (rows.filter("n_shingles > 0").groupBy("set")
             .agg(F.min(best).alias("k"), F.first("bands").alias("bands"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"))
             .withColumn("node", F.monotonically_increasing_id()))
    nodes = materialise(nodes, "minhash-nodes")
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    buckets = materialise(banded.join(shared, "key"), "minhash-buckets")
    wanted = (nodes.select("node", "n_shingles", "signature", F.col("k.doc_id").alias("_id"), F.col("k.digest").alias("_digest"))
              .join(buckets.select("node").distinct(), "node", "left_semi"))
    plain = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), F.col("text").cast("string").alias("text"))
    texts = plain.join(wanted.hint("shuffle_hash"), F.col("_doc").eqNullSafe(F.col("_id")) & (F.md5("text") == F.col("_digest")))
    texts = materialise(texts.groupBy("node", "n_shingles", "signature").agg(F.min("text").alias("text")), "minhash-candidates")
    marks = texts.select("node", "signature")
    found = None
    for number in range(star_rounds + 1):
        opened = _with_component(buckets, found)
        if number:
            opened = materialise(opened, "minhash-open")
            if opened.isEmpty():
                break
        shards = materialise(_star_shards(opened, number) if number < star_rounds else _whole_shards(opened), "minhash-shards")
        close = materialise(_verified(shards, marks, percent / 100 - SLACK), "minhash-verified")
        new = materialise(_confirmed(close, texts, percent, SHINGLE, piece_bytes), "minhash-links")
        # the components so far are links too
        found = components(new if found is None else new.unionByName(found.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    rooted = nodes.select("set", "node", F.col("k.doc_id").alias("first")).join(found, "node", "left").withColumn("component", F.coalesce("root", "node"))
    named = rooted.groupBy("component").agg(F.min("first").alias("component_id"))
    # a set with very many copies: adaptive execution splits the side of the documents
    by_set = rooted.select("set", "component").join(named, "component").select(F.col("set").alias("_set"), F.col("component_id").alias("_least"))
    out = rows.select("doc_id", "digest", "set", "n_shingles").join(by_set, F.col("set") == F.col("_set"), "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("_least")))
    return out.select("doc_id", "digest", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("digest")


QUERIES = {"op13_minhash_near_dedup": (op13_minhash_near_dedup, None)}
