import hashlib
import random
import zlib

import numpy as np
import pytest

from cartwheel.llm import prefix_trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute_rebuilt(rows):
    """{conv_id: turns} as the query rebuilds them; turns in the order of (turn, null first)."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own.setdefault(conv, []).append(((turn is not None, turn or 0), key, (role, text)))
    own = {c: [t for *_, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute_nodes(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in kids) or 1
        saved[node] = sum(saved[k] for k in kids) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()) for node, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=lambda r: (r[0], r[1]))


def some_rows(seed, n=120):
    """Conversations that begin alike, copies, hot first turns, null turns, roles and texts, long ones, ties."""
    rng = random.Random(seed)
    shared = [("user", f"häufig {i}") for i in range(4)]
    rows = []
    for c in rng.sample(range(6000, 6000 + 3 * n), n):
        kind = rng.random()
        if kind < 0.3:
            turns = [*shared, ("a", f"t{rng.randrange(4)}"), ("b", f"u{rng.randrange(3)}")][: rng.randint(1, 6)]
        elif kind < 0.5:
            turns = [("system", "same"), ("user", str(rng.randrange(3))), ("assistant", str(rng.randrange(60)))]
        elif kind < 0.6:
            turns = [("x", f"{c} {i % 3}") for i in range(rng.choice([30, 300]))]
        else:
            turns = [(rng.choice(["user", None, ""]), rng.choice([None, "", "é😀", f"own {c}"])) for _ in range(rng.randint(1, 10))]
        start = rng.choice([0, 1, -3])
        rows += [(c, None if i == 0 and rng.random() < 0.2 else start + i, role, text) for i, (role, text) in enumerate(turns)]
    rows += [(6000, 5, "r", "one"), (6000, 5, "r", "two"), (6000, 5, "r", "one"), (None, 1, "r", "nobody"), (0, 0, "user", "first"), (7, 0, "user", "short")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("extra", [False, True])
def test_query_against_brute_force(spark, tmp_path, extra):
    rows = some_rows(1)
    df = spark.createDataFrame(rows, TURNS)
    if extra:
        df = df.selectExpr("*", "'x' as turns", "'y' as keys", "1 as n", "2 as node", "3 as depth", "4 as _base", "'z' as path", "5 as shard")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    assert found(prefix_trie.op11_conversation_trie(spark, str(tmp_path))) == brute_nodes(brute_rebuilt(rows))


@pytest.mark.parametrize("shard_turns", [1, 40, 400])
def test_shards_cut_deeper_give_the_same(spark, shard_turns, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ID_BITS", 2)
    rows = some_rows(2, 90)
    convs = prefix_trie.rebuilt(prefix_trie.sequences(spark.createDataFrame(rows, TURNS)))
    assert found(prefix_trie.prefix_nodes(convs, shard_turns)) == brute_nodes(brute_rebuilt(rows))


def test_hot_prefixes_are_split(spark):
    rows = [(5 * i, t, "r", text) for i in range(60) for t, text in enumerate(["sys", "sys", "sys", f"{i % 20}", f"{i}"])]
    seqs = prefix_trie.distinct_sequences(prefix_trie.sequences(spark.createDataFrame(rows, TURNS)))
    cuts = {r["cut"] for r in prefix_trie.sharded(seqs, 40).collect()}
    assert cuts == {4}
    assert found(prefix_trie.prefix_nodes(prefix_trie.sequences(spark.createDataFrame(rows, TURNS)), 40)) == brute_nodes(
        {5 * i: [("r", "sys")] * 3 + [("r", f"{i % 20}"), ("r", f"{i}")] for i in range(60)})


def test_no_rows_and_turnless_members(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.prefix_nodes(prefix_trie.rebuilt(prefix_trie.sequences(empty))).count() == 0
    short = next(c for c in range(6, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(short, 0, "user", "hello")]
    got = found(prefix_trie.prefix_nodes(prefix_trie.rebuilt(prefix_trie.sequences(spark.createDataFrame(rows, TURNS)))))
    assert got == [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())] == brute_nodes(brute_rebuilt(rows))


@pytest.mark.parametrize("seed", range(8))
def test_double_array_holds_what_went_in(seed):
    rng = np.random.default_rng(seed)
    words = [tuple(rng.integers(1, rng.choice([3, 30, 400]), rng.integers(0, 9)).tolist()) for _ in range(rng.integers(1, 300))]
    length = np.array([len(w) for w in words])
    flat = np.array([c for w in words for c in w], np.int64)
    trie = prefix_trie.DoubleArray(*prefix_trie.edges(flat, np.cumsum(length) - length, length))
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    assert (trie.check >= 0).sum() + 1 == len(prefixes)  # every node but the root has a place of its own
    for word in [*prefixes, *[(*w, c) for w in words for c in (1, 2, 399, 500)]]:
        state = np.zeros(1, np.int64)
        for c in word:
            state = trie.step(state, np.array([c])) if state[0] >= 0 else state
        assert (state[0] >= 0) == (word in prefixes)
