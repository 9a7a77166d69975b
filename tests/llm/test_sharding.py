"""Sharding against a brute-force minimax partition."""

import hashlib
import zlib

import numpy as np
import pytest

from rowcast.llm import sharding


def best_capacity(sizes, shards):
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [0] + [min(max(best[j], sum(sizes[j:i])) for j in range(i + 1)) for i in range(1, len(sizes) + 1)]
    return best[-1]


@pytest.mark.parametrize("shards,copies", [(4, 1), (7, 60), (24, 5)])
def test_largest_shard_is_the_smallest_possible(spark, shards, copies):
    rng = np.random.default_rng(shards)
    texts = ["é" * int(n) + str(i) for i, n in enumerate(rng.integers(0, 200, 60))] + ["hot text " * 5] * copies
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, None), (None, "x"), (5, texts[5])]
    frame = spark.createDataFrame([(i, t, 3, "d") for i, t in rows], "doc_id long, text string, shard int, digest string")
    out = sharding.shard(frame.repartition(3), shards).collect()
    sizes, home = {}, {}
    for i, t in rows:
        d = hashlib.sha256((t or "").encode()).hexdigest()
        sizes[d] = sizes.get(d, 0) + len((t or "").encode()) + 8
    total = [0] * shards
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, []).append(t or "")
    for r in out:
        assert r.law == "bytes" and r.grown_shard is None
        total[r.shard] += r.size
    assert max(total) == best_capacity([sizes[d] for d in sorted(sizes)], shards)
    for i, ts in by_id.items():
        mine = [r for r in out if r.doc_id == i]
        assert sorted((r.size, r.text_crc32) for r in mine) == sorted((len(t.encode()) + 8, zlib.crc32(t.encode())) for t in ts)
    for r in out:  # equal texts share a shard
        key = (r.size, r.text_crc32)
        assert home.setdefault(key, r.shard) == r.shard
    for s in range(shards):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))


def test_shards_are_even_without_large_groups(spark):
    frame = spark.range(3000).selectExpr("id as doc_id", "repeat('a', cast(pmod(hash(id), 50) as int)) || id as text")
    total = sharding.shard(frame, 24).groupBy("shard").sum("size").collect()
    bytes_ = [r[1] for r in total]
    assert len(bytes_) == 24 and max(bytes_) - min(bytes_) < 120


def greedy(sizes, capacity):
    shards, used = 1, 0
    for s in sizes:
        if used + s > capacity:
            shards, used = shards + 1, 0
        used += s
    return shards


@pytest.mark.parametrize("n,shards,cells", [(3000, 24, 40), (3000, 5, 3), (400, 24, 1), (2000, 7, 65536)])
def test_search_over_coarse_cells_is_exact(spark, n, shards, cells):
    rng = np.random.default_rng(n + cells)
    sizes = [int(s) for s in np.where(rng.random(n) < 0.01, rng.integers(8, 90_000, n), rng.integers(8, 900, n))]
    sums = np.cumsum(sizes).tolist()
    table = spark.createDataFrame([(s,) for s in sums], "prefix long").cache()
    known = sharding.Cells(table, sums[-1], cells)
    capacity = sharding.smallest_capacity(known, shards, max(sizes))
    assert greedy(sizes, capacity) <= shards < greedy(sizes, capacity - 1) or capacity == max(sizes)
    cuts = sharding.cut_points(known, shards, capacity, [s for s in sizes if s * shards > sums[-1]])
    assert set(cuts) <= set(sums)
    ends = [0, *cuts, sums[-1]]
    assert max(b - a for a, b in zip(ends, ends[1:])) == capacity or capacity > max(sizes)
    # The cuts are those of the rule when every sum is known.
    exact = sharding.Cells(table, sums[-1], sums[-1])
    assert cuts == sharding.cut_points(exact, shards, capacity, [s for s in sizes if s * shards > sums[-1]])


def test_few_jobs_and_a_sorted_prefix_table(spark):
    frame = spark.range(3000).selectExpr("id as doc_id", "repeat('a', cast(pmod(hash(id), 50) as int)) || id as text")
    sc = spark.sparkContext
    sc.setJobGroup("op9-few-jobs", "")
    out = sharding.shard(frame, 24)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("op9-few-jobs")) < 20
    assert out.count() == 3000


def test_one_id_and_long_texts(spark):
    """A third of the rows share one null id, another text is very long."""
    rows = [(None, f"t{i % 40}") for i in range(300)] + [(i, f"u{i}") for i in range(599)] + [(7, "word " * 200_000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 24).collect()
    assert len(out) == len(rows) and sum(r.size for r in out) == sum(len(t) + 8 for _, t in rows)
    for s in {r.shard for r in out}:
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))


def test_empty_table(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    one = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [(r.shard, r.slot) for r in sharding.shard(one).collect()] == [(0, 0)]
