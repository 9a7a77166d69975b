"""The prefix trie against a brute-force trie of dictionaries."""

import hashlib
import random
import zlib

import pytest

from rowcast.llm import common, prefix_trie

COLUMNS = "conv_id long, turn long, role string, text string, depth int, key string, ids string"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, 1, "k", "i") for r in rows], COLUMNS).repartition(parts)


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows, group=100):
    """Every node's row, from the definition."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    if group:
        heads = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
        base = {c: c - (c % group if c >= 0 else -(-c % group)) for c in own}
        whole = {c: own.get(base[c], [])[: heads[c]] + own[c][heads[c] :] for c in own}
    else:
        whole = own
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = sorted(c for c in convs if len(whole[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(n) == len(node) + 1 for n in below),
            sum(not any(m[: len(n)] == n and m != n for m in below) for n in below),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def made(table):
    return sorted(map(tuple, table.collect()), key=str)


def some_rows(seed, n_convs=120, deep=6):
    """Conversations from few turns, so that they share prefixes."""
    rng = random.Random(seed)
    turns = [("user", "hi"), ("user", ""), ("assistant", "yes é😀"), ("system", "b:c"), (None, None), ("a", "bc")]
    rows = []
    for c in rng.sample(range(-20, 400), n_convs):
        for t in range(rng.randint(1, deep)):
            rows.append((c, t, *rng.choice(turns[: rng.choice([2, 6])])))
    return rows


@pytest.mark.parametrize("seed,per_shard", [(1, 1 << 15), (2, 40), (3, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, per_shard):
    """One shard, some, and so many that they are merged in rounds."""
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", per_shard)
    rows = some_rows(seed)
    assert made(prefix_trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_taken_as_they_are(spark):
    rows = some_rows(4, 40)
    assert made(prefix_trie.prefix_trie(frame(spark, rows), group=None)) == brute(rows, None)


def test_nulls_ties_repeated_rows_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 60)
    rows = [(None, 0, "user", "lost"), (7, None, "user", "first"), (7, 0, None, None), (7, 0, "", "x" * 200_000),
            (7, 0, "", "x" * 200_000), (100, 1, "u", "tie"), (100, 1, "a", "tie"), (101, 5, "u", "tie")]
    rows += [(200 + c, t, "user", "same") for c in range(3) for t in range(150)]
    rows += [(300, t, "user", "same") for t in range(151)] + [(1234, 0, "only", "few")]
    assert made(prefix_trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_hot_conversation_and_hot_turn(spark, monkeypatch):
    """A third of the conversations are equal, all begin alike, ids by range."""
    monkeypatch.setattr(common, "HOT_KEYS", 10)
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 30)
    rows = [(c, 0, "system", "be nice") for c in range(300)]
    rows += [(c, 1, "user", "again" if c % 3 == 0 else f"ask {c}") for c in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = made(prefix_trie.prefix_trie(frame(spark, rows), group=None))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(rows, None)


def test_conversations_without_turns_are_members_of_the_root(spark):
    """Id 205 takes over more turns than it has, and conversation 200 has none."""
    conv = next(c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6 >= 1)
    got = made(prefix_trie.prefix_trie(frame(spark, [(conv, 0, "user", "gone")])))
    ends = hashlib.sha256(str(conv).encode()).hexdigest()
    assert got == [(conv, 0, None, 1, 0, 1, 0, ends)] == brute([(conv, 0, "user", "gone")])


def test_empty_table(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        got = prefix_trie.prefix_trie(frame(spark, rows))
        assert got.count() == 0 and got.columns == [
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_tree_is_balanced():
    tree = prefix_trie.TernaryTree()
    for i in prefix_trie._medians_first(1023):
        tree.insert([i], [1], (i, 1, ""))
    depth, at = {tree.first[0]: 1}, [tree.first[0]]
    for node in at:
        for child in (tree.low[node], tree.high[node]):
            if child >= 0:
                depth[child] = depth[node] + 1
                at.append(child)
    assert len(depth) == 1023 and max(depth.values()) == 10
