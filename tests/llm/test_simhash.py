"""SimHash near-dedup against brute force over all pairs."""

import numpy as np
import pytest
import xxhash

from rowcast.llm import simhash


def brute_fp(text, shingle=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or (
        [b" ".join(words)] if words else []
    )
    out = 0
    for bit in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(g, 42) >> bit & 1 for g in grams) > len(grams):
            out |= 1 << bit
    return out


def brute_components(fps, max_bits):
    """Smallest id reachable, for (id, fingerprint) rows."""
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= max_bits:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, least[root(i)]) for i, (d, _) in enumerate(fps)]


def near_copies(n, seed):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(words, 120)) for _ in range(n)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(n):
        for k in range(int(rng.integers(0, 6))):
            w = base[i].split(" ")
            w[int(rng.integers(0, len(w)))] = f"x{k}"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + 1, ""), (len(rows) + 2, None), (len(rows) + 3, " \n\t"), (len(rows) + 4, "One two"),
             (len(rows) + 5, "oNE two"), (len(rows) + 6, "one  TWO"), (0, base[0])]
    return rows


@pytest.mark.parametrize("limit", [4096, 3])
def test_components_equal_brute_force(spark, limit):
    rows = near_copies(60, 5)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, root int")
    got = sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs, list_limit=limit).collect())
    fps = [(i, brute_fp(t)) for i, t in rows]
    assert got == sorted(brute_components(fps, 4))
    seen = {(r.doc_id, r.fp & (2**64 - 1)) for r in simhash.fingerprints(docs).collect()}
    assert seen == set(fps)


@pytest.mark.parametrize("limit", [4096, 8])
def test_links_keep_components_in_a_dense_ball(spark, limit):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 2**63))
    values = {centre}
    for _ in range(300):
        v = centre
        for b in rng.choice(64, int(rng.integers(1, 9)), replace=False):
            v ^= 1 << int(b)
        values.add(v)
    values |= {int(x) for x in rng.integers(0, 2**63, 100)}
    fps = sorted(values)
    frame = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in fps], "fp long")
    found = simhash.components(simhash.links(frame, 4, list_limit=limit)).collect()
    root = {r.node & (2**64 - 1): r.root & (2**64 - 1) for r in found}
    classes = {}
    for v in fps:
        classes.setdefault(root.get(v, v), set()).add(v)
    want = {}
    for v, c in brute_components([(v, v) for v in fps], 4):
        want.setdefault(c, set()).add(v)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("max_bits,limit", [(4, 4096), (4, 2), (2, 2), (6, 4096), (0, 1)])
def test_every_pair_within_the_distance_is_retained(spark, max_bits, limit):
    """Pairs alone in their component: the links are exactly the brute-force pairs."""
    rng = np.random.default_rng(max_bits)
    values = []
    for i in range(120):
        v = int(rng.integers(0, 2**63))
        w = v
        for b in rng.choice(64, int(rng.integers(1, max_bits + 3)), replace=False):
            w ^= 1 << int(b)
        values += [v, w]
    # Frequent bytes: many values with the same first four or last four bytes.
    values += [(i * 0x9E3779B1 % 2**32) << 32 for i in range(1, 60)] + [i * 0x85EBCA77 % 2**32 for i in range(1, 60)]
    values = sorted(set(values))
    frame = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in values], "fp long")
    found = simhash.links(frame, max_bits, list_limit=limit).collect()
    got = {tuple(sorted((r.a & (2**64 - 1), r.b & (2**64 - 1)))) for r in found}
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if bin(a ^ b).count("1") <= max_bits}
    assert got == want and len(want) > (20 if max_bits else -1)


def test_count_filter_drops_pairs_below_the_minimum():
    """Three shared bytes bring a pair into a list; the tally needs four."""
    owners = simhash._owners(sorted({c[:3] for c in simhash.combinations(range(8), 4)}), 4)
    base = np.uint64(0x1122334455667788)
    three, four = np.uint64(0xFFFFFFFFFF000000), np.uint64(0x0101010100000000)
    assert owners[simhash._shared(np.array([three]))][0] == -1
    assert owners[simhash._shared(np.array([four]))][0] == 0
    values = np.array([base, base ^ three, base ^ four])
    assert simhash._forest(values, 0, owners, 64) == [(0, 2)]
    assert simhash._forest(values, 1, owners, 64) == []  # belongs to list 0


def test_very_long_text_and_a_hot_fingerprint(spark):
    long_text = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, long_text), (2, long_text + " end")] + [(i, "same words in all of these") for i in range(10, 3010)]
    got = {r.doc_id: (r.fp, r.component_id)
           for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows) and {got[i][1] for i in range(10, 3010)} == {10}
    assert got[1][0] & (2**64 - 1) == brute_fp(long_text) and got[2][1] == 1


def test_keep_one_leaves_one_document_of_each_group(spark):
    rows = near_copies(20, 9)
    docs = spark.createDataFrame([(i, t, i % 3) for i, t in rows], "doc_id long, text string, lang int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = sorted({c for _, c in brute_components([(i, brute_fp(t)) for i, t in rows], 4)})
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []
    docs = spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e"), (None, "zz yy xx ww")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(None, 7), (7, 7), (None, None)}
    assert simhash.keep_one(docs).count() == 3


def test_odd_distance_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_keep_one_decides_per_row(spark):
    one, two, three = "a b c d e", "zz yy xx ww", "k l m n o p"
    rows = [(1, one), (1, two), (1, two), (2, one), (3, three), (3, two), (None, three), (None, two),
            (None, "only here once"), (None, "only here once"), (4, "f g h i j")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _fp string")
    with_id = sorted([(1, one), (1, two), (3, three), (4, "f g h i j")])
    kept = simhash.keep_one(docs.where("doc_id is not null"))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == with_id
    got = {(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()}
    assert got == {*with_id, *((i, t) for i, t in rows if i is None)}
    kept = [(r.doc_id, r.text) for r in simhash.keep_one(docs, keep_null_ids=False).collect()]
    assert len(kept) == 5 and set(kept) == {*with_id, (None, "only here once")}
