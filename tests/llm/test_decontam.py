"""Benchmark decontamination against a brute-force window search."""

import hashlib
import re

import numpy as np
import pytest

from rowcast.llm import common, decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item_id, item in items:
            v = words(item)
            for i in range(max(1, len(v) - window + 1) if v else 0):
                g = v[i : i + window]
                for j in range(len(w) - len(g) + 1):
                    if w[j : j + len(g)] == g:
                        hit.update(range(j, j + len(g)))
                        found.add(str(item_id))
        out.append((doc_id, len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def case():
    rng = np.random.default_rng(1)
    vocab = [f"w{i}" for i in range(12)] + ["É", "ß", "日本"]
    say = lambda n: " ".join(rng.choice(vocab, n))
    items = [(i, say(int(rng.integers(10, 16)))) for i in range(12)]
    items += [(100, "W1, w2"), (101, ""), (102, None), (103, "!!"), (5, "É w3 ß?"), (100, "W1, w2")]
    docs = [(i, say(30)) for i in range(30)]
    docs += [(50 + i, f"{say(5)}\n{t.replace(' ', ' - ').upper()}... {say(3)}") for i, t in enumerate(x for _, x in items[:12])]
    docs += [(90, None), (91, ""), (92, "w1"), (93, "W1-W2"), (93, "W1-W2"), (94, "..."), (95, say(4000))]
    return docs, items


@pytest.mark.parametrize("block_bytes", [4 << 20, 300])
def test_scan_equals_brute_force(spark, block_bytes):
    docs, items = case()
    d = spark.createDataFrame([(i, t, "q") for i, t in docs], "doc_id long, text string, items string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, pattern int")
    found = decontam.scan(d, b, block_bytes=block_bytes)
    got = sorted(tuple(r) for r in decontam.digest(found).collect())
    assert got == brute(docs, items)
    texts = dict(docs)
    for r in found.collect():
        cut = [w for s in r.spans for w in words(texts[r.doc_id][s.start : s.end])]
        assert len(cut) == r.n_hit
        for s in r.spans:
            assert words(texts[r.doc_id][s.start - 1 : s.start]) == [] or s.start == 0


@pytest.mark.parametrize("block_bytes", [4 << 20, 300])
def test_clean_drops_only_documents_with_a_window(spark, block_bytes):
    docs, items = case()
    d = spark.createDataFrame([(i, t, "q") for i, t in docs], "doc_id long, text string, text_key string")
    b = spark.createDataFrame(items, "item_id long, text string")
    kept = decontam.clean(d, b, block_bytes=block_bytes)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in brute(docs, items) if not r[5]]


@pytest.mark.parametrize("hot_keys", [1, 5, 1000])
@pytest.mark.parametrize("bits", [6, 26])
def test_large_benchmark_with_groups_of_copies(spark, monkeypatch, hot_keys, bits):
    """Copies of a clean and of a contaminated text, by broadcast or not; a
    bitmap that lets every place pass changes nothing."""
    monkeypatch.setattr(decontam, "HOT_KEYS", hot_keys)
    monkeypatch.setattr(common, "HOT_KEYS", hot_keys)
    monkeypatch.setattr(decontam, "SIEVE_BITS", bits)
    docs, items = case()
    docs = [(i, t) for i, t in docs if len(t or "") < 1000][::3]
    docs += [(200 + i, "nothing of it here") for i in range(40)] + [(300 + i, f"so {items[0][1]} there") for i in range(40)]
    docs += [(300, None), (301, "É w3 ß?")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert sorted(tuple(r) for r in decontam.digest(decontam.scan(d, b, block_bytes=0)).collect()) == want
    kept = sorted(r.doc_id for r in decontam.clean(d, b, block_bytes=0).collect())
    assert kept == [r[0] for r in want if not r[5]]


def test_spans_are_the_same_with_and_without_the_automaton(spark):
    docs, items = case()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    one, two = (sorted(map(str, decontam.scan(d, b, block_bytes=n).collect())) for n in (4 << 20, 0))
    assert one == two


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in decontam.digest(decontam.scan(d, none)).collect()] == [(1, 3, 0, 0)]
    assert decontam.clean(d, none).count() == 1
    assert decontam.scan(d.limit(0), none).collect() == []
