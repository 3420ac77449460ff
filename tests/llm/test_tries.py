"""Double-array tries, conversation prefixes and phrases against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from rollcall.llm import conversation_trie
from rollcall.llm.double_array import DoubleArray, step

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("symbols", [2, 1000, 3_000_000])
def test_double_array_equals_a_dictionary(symbols):
    rng = np.random.Generator(np.random.PCG64(symbols))
    paths = np.minimum((rng.pareto(0.8, size=(3000, 3)) * 4).astype(np.int64), symbols - 1)
    trie, states = DoubleArray(symbols), np.zeros(len(paths), dtype=np.int64)
    for level in range(3):
        states = trie.extend(states, paths[:, level])
    known = dict(zip(map(tuple, paths.tolist()), states.tolist(), strict=True))
    assert len(set(known.values())) == len(known)
    asked = np.concatenate([paths, rng.integers(-1, min(symbols, 20), size=(2000, 3))])
    base, check = trie.packed()
    live, states = np.arange(len(asked)), np.zeros(len(asked), dtype=np.int64)
    for level in range(3):
        on, states = step(base, check, trie.width, states, asked[live, level])
        live = live[on]
    got = dict(zip(live.tolist(), states.tolist(), strict=True))
    assert all(got.get(i) == known.get(tuple(path)) for i, path in enumerate(asked.tolist()))
    base, check = DoubleArray(symbols).packed()
    assert not len(step(base, check, 1, np.zeros(9, np.int64), np.arange(9))[0])


def ordered(rows):
    """conv_id -> its turns in order."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            convs.setdefault(c, []).append(((turn is not None, turn or 0, role, digest), (role, text)))
    return {c: [t for _, t in sorted(turns, key=lambda x: x[0])] for c, turns in convs.items()}


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        out[c] = [*convs.get(base, [])[:h], *own[h:]]
    return out


def brute_trie(convs):
    members = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1]) if node else 0
    rows = set()
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(node))
        sha = hashlib.sha256(ends.encode()).hexdigest()
        up = min(members[node[:-1]]) if node else None
        rows.add((min(who), len(node), up, len(who), children[node], leaves[node], saved[node], sha))
    return rows


def tuples(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    rows = [tuple(r[n] for n in names) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made_conversations(seed):
    rng, rows = random.Random(seed), []
    for c in [*range(0, 40), *range(100, 130), *range(-5, 0), 10**15, None]:
        path = [(rng.choice("ua"), rng.choice(["", "x", "yy", "zß"])) for _ in range(rng.choice([1, 2, 3, 5, 9, 14]))]
        if c is not None and c % 3 == 0:
            path = [("u", "hello"), ("a", "hé")] * rng.choice([1, 3, 4])
        rows += [(c, i if i % 4 else None, role if rng.random() > 0.1 else None, text or None) for i, (role, text) in enumerate(path)]
    return rows


@pytest.mark.parametrize("segment,shard_turns", [(1024, 20_000), (1024, 6), (5, 4)])
def test_tries_equal_brute_force(spark, segment, shard_turns):
    rows = made_conversations(segment)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.selectExpr("*", "1 AS c", "2 AS d", "3 AS key", "4 AS `a.b`")
    convs = ordered(rows)
    assert tuples(conversation_trie.rebuilt_trie(frame, segment, shard_turns)) == brute_trie(rebuild(convs))
    if shard_turns == 6:
        assert tuples(conversation_trie.prefix_trie(frame, segment, shard_turns)) == brute_trie(convs)


def test_trie_of_nothing_and_of_copies(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert conversation_trie.rebuilt_trie(spark.createDataFrame([], schema)).count() == 0
    rows = [(c, t, "u", "same" * t) for c in range(100, 160) for t in range(4)] + [(100, 3, "u", "same" * 3)] * 2
    got = tuples(conversation_trie.rebuilt_trie(spark.createDataFrame(rows, schema), 1024, 5))
    assert got == brute_trie(rebuild(ordered(rows)))


def test_turnless_conversations_end_at_the_root(spark):
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 5)
    frame = spark.createDataFrame([(c, 0, "u", "x")], "conv_id long, turn long, role string, text string")
    assert tuples(conversation_trie.rebuilt_trie(frame)) == {(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}
    assert len(tuples(conversation_trie.prefix_trie(frame))) == 2


def test_op12_on_the_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert tuples(conversation_trie.op12_prefix_trie(spark, SMALL)) == brute_trie(rebuild(ordered(rows)))
