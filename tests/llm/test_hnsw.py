"""Embedding near-dedup against a comparison of all pairs."""

import numpy as np
import pytest
from pyspark.sql import types as T

from rowcast.llm import common, hnsw, queries


def frame(spark, rows, element=T.FloatType(), parts=5):
    schema = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(element)),
        T.StructField("node", T.StringType()), T.StructField("copies", T.IntegerType()), T.StructField("root", T.LongType()),
    ])
    return spark.createDataFrame([(i, v, "x", 3, 0) for i, v in rows], schema).repartition(parts)


def brute(rows, threshold, kind=np.float32):
    """Links and components of all pairs, from the definition."""
    usable = [v is not None and len(v) > 0 and all(e is not None and np.isfinite(kind(e)) for e in v) and any(v) for _, v in rows]
    at = [i for i, ok in enumerate(usable) if ok]
    x = np.array([rows[i][1] for i in at], dtype=kind).astype(float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= threshold
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for a, b in zip(*np.nonzero(close)):
        if a != b:
            links[at[a]] += 1
            parent[root(at[a])] = root(at[b])
    ids = {}
    for i, (vec, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(vec)
    least = {r: min((v for v in vs if v is not None), default=None) for r, vs in ids.items()}
    return sorted(((v, links[i], least[root(i)], v == least[root(i)]) for i, (v, _) in enumerate(rows)), key=str)


def made(table):
    return sorted(map(tuple, table.collect()), key=str)


def groups(n, width, seed):
    """Single vectors, chains and groups of near and equal copies."""
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        base = rng.standard_normal(width)
        out.append(base)
        kind = rng.integers(0, 6)
        for _ in range(int(rng.integers(1, 12)) if kind < 3 else 0):
            base = base if kind else out[-1]  # kind 0: a chain
            step = rng.standard_normal(width) * 0.3
            out.append(base * (2 if kind == 2 else 1) + (0 if kind == 1 else step))
    return [(i, v.tolist()) for i, v in enumerate(out)]


@pytest.mark.parametrize("element,kind", [(T.FloatType(), np.float32), (T.DoubleType(), float)])
def test_equals_all_pairs(spark, element, kind):
    rows = groups(900, 24, 3)
    assert made(hnsw.near_duplicates(frame(spark, rows, element))) == brute(rows, 0.9, kind)


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "shard_count", lambda n: 3)
    rows = groups(700, 16, 4)
    assert made(hnsw.near_duplicates(frame(spark, rows), threshold=0.8)) == brute(rows, 0.8)


def test_hot_groups_of_equal_and_near_copies(spark, monkeypatch):
    """A third equal, a third so near that one beam cannot hold them."""
    monkeypatch.setattr(common, "HOT_KEYS", 10)
    rng = np.random.default_rng(5)
    hot, near = rng.standard_normal(32), rng.standard_normal(32)
    rows = [(i, hot.tolist()) for i in range(300)]
    rows += [(300 + i, (near + 0.05 * rng.standard_normal(32)).tolist()) for i in range(300)]
    rows += [(600 + i, rng.standard_normal(32).tolist()) for i in range(300)]
    assert made(hnsw.near_duplicates(frame(spark, rows))) == brute(rows, 0.9)


def test_vectors_that_link_with_nothing(spark):
    one = [1.0, 0.0, 2.0]
    rows = [(1, None), (2, [None, 1.0, 1.0]), (3, [0.0] * 3), (4, [-0.0] * 3), (5, [float("nan"), 1.0, 1.0]),
            (6, [float("inf"), 1.0, 1.0]), (7, []), (None, None), (9, one), (8, one), (8, one), (None, one),
            (10, [1.0, -0.0, 2.0]), (11, [1e-30, 0.0, 2e-30]), (12, [1e30, 0.0, 2e30]), (None, [0.0, 5.0, 0.0])]
    got = made(hnsw.near_duplicates(frame(spark, rows)))
    want = brute(rows, 0.9)
    # A null id is kept where its whole component has none.
    want = sorted(((v, n, c, True if v is None and c is None else bool(k)) for v, n, c, k in want), key=str)
    assert got == want


def test_empty_tables_and_other_lengths(spark):
    assert hnsw.near_duplicates(frame(spark, [])).collect() == []
    assert made(hnsw.near_duplicates(frame(spark, [(4, None)]))) == [(4, 0, 4, True)]
    assert made(hnsw.near_duplicates(frame(spark, [(4, [1.0])]))) == [(4, 0, 4, True)]
    with pytest.raises(Exception, match="different lengths"):
        hnsw.near_duplicates(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])])).collect()


def test_search_is_a_graph_search_that_the_audit_widens():
    """Without the audit a beam of one misses links; with it the recall passes,
    though only a part of the nodes is compared."""
    rng = np.random.default_rng(6)
    unit = hnsw._as_unit(rng.standard_normal((3000, 48))).astype(np.float32)
    levels = np.sort(np.floor(-np.log(rng.random(3000)) / np.log(16)).astype(int))[::-1]
    graph = hnsw.Graph.build(unit, levels, 0.9)
    assert graph.beam < len(unit) and [len(x) for x in graph.layers] == [(levels >= k).sum() for k in range(levels[0] + 1)]
    step = rng.standard_normal(unit.shape)
    queries_ = hnsw._as_unit(unit + 0.45 * step / np.linalg.norm(step, axis=1, keepdims=True)).astype(np.float32)
    row, node = graph.links(queries_, 0.9)
    true = (queries_ @ unit.T >= 0.9 - hnsw.SLACK).sum()
    assert len(row) >= 0.99 * true
    assert ((queries_[row] * unit[node]).sum(axis=1) >= 0.9 - 2e-5).all()
    narrow = hnsw.Graph(unit, graph.layers, beam=1)
    assert len(narrow.links(queries_, 0.9)[0]) < len(row)


def test_recall_and_links_of_the_query(spark):
    """Against all pairs: nothing below 0.9, and hardly a link lost."""
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = made(queries.queries()["op12_embedding_near_dedup"](spark, sf))
    assert got == brute(rows, 0.9)


def shared(cells, a, b):
    """Which pairs of rows have a cell in common."""
    return ((cells[a][:, :, None] == cells[b][:, None, :]) & (cells[a] >= 0)[:, :, None]).any(axis=(1, 2))


def test_a_vector_is_compared_in_a_few_cells_only():
    """Pairs at the threshold share a cell, though each vector meets few others."""
    rng = np.random.default_rng(7)
    n, wide = 20000, 64
    unit = hnsw._as_unit(rng.standard_normal((n, wide)))
    aside = rng.standard_normal((n // 2, wide))
    aside -= np.einsum("ij,ij->i", aside, unit[::2])[:, None] * unit[::2]
    unit[1::2] = 0.9001 * unit[::2] + np.sqrt(1 - 0.9001**2) * hnsw._as_unit(aside)
    unit = unit[rng.permutation(n)].astype(np.float32)
    nodes = hnsw.shard_count(1_000_000)
    cells = hnsw.audited(unit[:nodes], unit[nodes : nodes + hnsw.AUDIT], 1_000_000, 0.9).of(unit)
    assert (np.bincount(cells[cells >= 0]).astype(float) ** 2).sum() / 2 < 0.02 * n * n
    a, b = np.concatenate([np.add(np.nonzero(unit[i : i + 500] @ unit.T >= 0.9), [[i], [0]]) for i in range(0, n, 500)], axis=1)
    a, b = a[a < b], b[a < b]
    assert len(a) == n // 2 and shared(cells, a, b).mean() > 0.985


def test_a_dense_group_is_not_parted_by_its_landmarks():
    """Half of the landmarks are near copies of each other: one of them is kept."""
    rng = np.random.default_rng(8)
    unit = rng.standard_normal((12000, 64))
    unit[::2] = unit[0] + 0.1 * rng.standard_normal((6000, 64))
    unit = hnsw._as_unit(unit).astype(np.float32)
    found = hnsw.audited(unit[:2000], unit[2000:6000], 2_000_000, 0.9)
    dense = unit[np.arange(6000, 12000, 2)]
    assert (found.graph.unit @ dense[0] >= 0.9).sum() < 10 and len(found.graph.unit) > 100
    cells = found.of(dense)
    assert shared(cells, np.arange(1000), np.arange(1000, 2000)).mean() > 0.99
    assert (cells >= 0).sum() < 2 * len(cells)


@pytest.mark.parametrize("outright", [1 << 17, 16])
def test_cells_blocks_passes_and_a_graph_of_landmarks(spark, monkeypatch, outright):
    """Over many cells, some of them split, shuffled in passes; landmarks searched through their layers."""
    for name, value in (("LEAST", 256), ("AUDIT", 600), ("COPY_COST", 1), ("OUTRIGHT", outright), ("BLOCK", 128),
                        ("TASK_BYTES", 1 << 15), ("PASS_LEAST", 100)):
        monkeypatch.setattr(hnsw, name, value)
    made_of = []
    monkeypatch.setattr(hnsw, "audited", lambda *x, f=hnsw.audited: made_of.append(f(*x)) or made_of[-1])
    rng = np.random.default_rng(9)
    rows = groups(2500, 32, 9)
    near = rng.standard_normal(32)
    rows += [(10000 + i, (near + 0.1 * rng.standard_normal(32)).tolist()) for i in range(300)]
    rows += rows[:50] + [(None, rows[60][1])]
    got, want = made(hnsw.near_duplicates(frame(spark, rows))), brute(rows, 0.9)
    graph = made_of[0].graph
    assert len(graph.unit) > 16 and made_of[0].count < len(graph.unit) and bool(graph.layers) == (outright == 16)
    most = {}
    for v, n, _, _ in want:
        most[v] = max(n, most.get(v, 0))
    assert len(got) == len(want) and all(n <= most[v] for v, n, _, _ in got)
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want)
    assert np.mean([a[2] == b[2] for a, b in zip(got, want)]) > 0.99


def test_links_of_a_group_are_summed_where_they_are_found(spark, monkeypatch):
    """Written are a sum for each node and the links that span the group, not its pairs."""
    kept = []
    monkeypatch.setattr(hnsw, "decided", lambda links, *x, f=hnsw.decided: kept.append(links) or f(links, *x))
    rng = np.random.default_rng(10)
    near = rng.standard_normal(32)
    rows = [(i, (near + 0.05 * rng.standard_normal(32)).tolist()) for i in range(400)]
    assert made(hnsw.near_duplicates(frame(spark, rows))) == brute(rows, 0.9)
    assert kept[0].count() <= 2 * 400


def test_cosines_at_the_threshold_are_decided_in_double(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(hnsw, "decided", lambda links, *x, f=hnsw.decided: kept.append(links.where("kind = 2").count()) or f(links, *x))
    rows = [(1, [1.0, 0.0]), (2, [3.0, 4.0]), (3, [-0.6 - 1e-7, 0.8]), (4, [3.0, 4.0 + 1e-6]), (5, [3.0 + 1e-6, 4.0]),
            (6, [-1.0, 0.0]), (7, [3.0, -4.0])]
    for threshold in (0.6, 0.28):
        assert made(hnsw.near_duplicates(frame(spark, rows, T.DoubleType()), threshold)) == brute(rows, threshold, float)
    assert min(kept) > 0
