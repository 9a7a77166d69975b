"""Toxicity: the segment scan, log-odds and calibration against brute force, the model on held-out rows."""

import math
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rowcast.llm import toxicity


def brute_segments(walk):
    """Maximal-scoring segments by their definition: repeatedly take the best
    contiguous piece (the shortest of equals), then look on either side."""

    def best(lo, hi):
        top = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += walk[b]
                key = (total, -(b + 1 - a), -a)
                if total > 0 and (top is None or key > top[0]):
                    top = key, a, b + 1
        if top is None:
            return []
        _, a, b = top
        return [*best(lo, a), (a, b, sum(walk[a:b])), *best(b, hi)]

    return best(0, len(walk))


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(0, 24))
def test_segments_are_all_maximal_scoring_ones(seed, n):
    walk = np.random.default_rng(seed).normal(-0.2, 1.0, n)
    got, want = toxicity.segments(walk), brute_segments(list(walk))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def corpus(n=600, seed=4):
    rng = np.random.default_rng(seed)
    plain = [f"word{i}" for i in range(300)]
    bad = ["vilea", "vileb", "nastyc", "nastyd", "grimy"]
    docs, labels = [], []
    for i in range(n):
        words = list(rng.choice(plain, int(rng.integers(20, 200))))
        toxic = int(rng.random() < 0.15)
        for _ in range(int(rng.integers(2, 6)) * toxic):
            words.insert(int(rng.integers(0, len(words))), str(rng.choice(bad)).upper())
        docs.append((i, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((i, toxic))
    truth = {i: int(any(w.lower() in bad for w in t.split())) for i, t in docs}
    return docs, labels, truth


def test_held_out_documents_are_told_apart(spark):
    docs, labels, truth = corpus()
    frame = spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(frame, marks)
    rows = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 50 and all((rows[i].score >= 0.5) == bool(truth[i]) for i in held)
    for i in held:
        words = dict(docs)[i].lower().split()
        for s in rows[i].segments:
            assert any(w[:4] in ("vile", "nast", "grim") for w in words[s.start : s.end])
    kept = toxicity.clean(frame, model)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.score < 0.5}


def test_edges(spark):
    docs, labels, _ = corpus(80, 6)
    frame = spark.createDataFrame(docs + [(900, None), (901, ""), (902, "!"), (None, "x"), (0, docs[0][1])], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(frame, none)
    assert all(r.score < 0.5 and not r.segments for r in toxicity.score(frame, model).collect())
    assert toxicity.clean(frame, model).count() == len(docs) + 5
    model = toxicity.train(frame, spark.createDataFrame(labels * 2, "doc_id long, toxic int"), max_labelled=40)
    assert toxicity.score(frame.limit(0), model).collect() == []
    assert toxicity.score(frame, model).count() == len(docs) + 5


def test_every_token_with_a_score_is_kept_and_no_other(spark):
    """Frequent neutral tokens do not push out rare toxic ones."""
    none = [0.0] * toxicity.PARTS
    rows = [(b"neutral%d" % i, *[900.0 + i] * 4, *[110.0] * 4) for i in range(300)]
    rows += [(b"bad%d" % i, *none, *[6.0 + i % 2] * 4) for i in range(40)] + [(b"rare", *none, 1.0, 1.0, 1.0, 0.0)]
    counts = spark.createDataFrame(rows, ", ".join(["token binary", *(f"{c} double" for c in toxicity.CLASSES)]))
    models = toxicity._token_models(counts)
    want = {b"bad%d" % i for i in range(40)}
    assert len(models) == toxicity.PARTS + 1 and all(set(m.tokens) == want for m in models)
    many = spark.range(100_100).selectExpr(
        "cast(cast(id as string) as binary) as token", *(f"{9 * c.startswith('toxic')}D as {c}" for c in toxicity.CLASSES)
    ).union(counts.where("clean_0 > 0").select("token", *[100 * counts[c] for c in toxicity.CLASSES]))
    assert {len(m.tokens) for m in toxicity._token_models(many)} == {100_100}


def test_a_stock_phrase_of_different_documents_counts_in_full_and_copies_once(spark):
    rng = np.random.default_rng(8)
    say = lambda n: " ".join(rng.choice([f"word{i}" for i in range(300)], n))
    docs = [(i, f"{say(60)} utter vilea scum {say(60)}") for i in range(80)] + [(100 + i, say(120)) for i in range(400)]
    copy = f"{say(40)} grimy {say(80)}"
    docs += [(1000 + i, copy if i % 2 else f"{copy} end{i}") for i in range(60)]
    marks = [(i, int(i < 100 or i >= 1000)) for i, _ in docs]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    labelled = toxicity._labelled(frame, labels, 5, 0, 10_000, "doc_id", "text", "toxic")
    counts = {bytes(r["token"]): sum(r[c] for c in toxicity.CLASSES) for r in toxicity._token_counts(labelled).collect()}
    taught = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 5]
    assert counts[b"vilea"] == sum(i < 80 for i in taught) > 50
    assert sum(i >= 1000 for i in taught) > 30 and counts[b"grimy"] <= 2
    model = toxicity.train(frame, labels)
    assert model.tokens.get(b"vilea", 0) > 0 and b"grimy" not in model.tokens


def test_log_odds_with_dirichlet_prior_equal_brute_force(spark):
    rng = np.random.default_rng(12)
    rows = [(b"t%d" % i, *[float(x) for x in rng.integers(0, 40, 8) * rng.integers(0, 2, 8)]) for i in range(60)]
    counts = spark.createDataFrame(rows, ", ".join(["token binary", *(f"{c} double" for c in toxicity.CLASSES)]))
    models = toxicity._token_models(counts)
    for part, model in enumerate(models):
        used = [p for p in range(4) if p != part]  # part 4: all of them
        clean = {r[0]: sum(r[1 + p] for p in used) for r in rows}
        toxic = {r[0]: sum(r[5 + p] for p in used) for r in rows}
        n_clean, n_toxic = sum(clean.values()), sum(toxic.values())
        mass = 0.05 * (n_clean + n_toxic)
        want = {}
        for r in rows:
            if sum(r[1:]) < toxicity.MIN_DOCS:
                continue
            prior = 0.05 * max(toxic[r[0]] + clean[r[0]], 1.0)
            t, c = toxic[r[0]] + prior, clean[r[0]] + prior
            odds = math.log(t / (n_toxic + mass - t)) - math.log(c / (n_clean + mass - c))
            sure = abs(odds) - toxicity.CAUTION * math.sqrt(1 / t + 1 / c)
            if sure >= toxicity.LEAST:
                want[r[0]] = math.copysign(sure, odds)
        assert set(model.tokens) == set(want) and want
        assert all(abs(model.tokens[k] - v) < 1e-9 for k, v in want.items())


def test_extreme_values_and_logistic_curve_solve_their_equations():
    rng = np.random.default_rng(2)
    words = [("word", int(b), int(n)) for b, n in zip([-8, -7, 9, 17, 30], [9000, 800, 60, 20, 3])]
    rate, scale = toxicity._extreme_value([*words, ("segment", 9, 55), ("segment", 17, 18)])
    seen = {b / 10: n for _, b, n in words}
    for s in (1.0, 2.0, 4.0):
        seen[s] = seen.get(s, 0) + 1
    total = sum(seen.values())
    assert abs(sum(n * math.exp(rate * s) for s, n in seen.items()) / total - 1) < 1e-9
    # As many segments of the least height or more are expected as there were.
    assert abs(scale * total * math.exp(-rate * 0.9) / 74 - 1) < 0.01
    rated = [("clean", int(b), int(n)) for b, n in zip(range(0, 60, 7), rng.integers(1, 300, 9))]
    rated += [("toxic", int(b), int(n)) for b, n in zip(range(20, 400, 40), rng.integers(1, 90, 10))]
    a, b = toxicity._logistic(rated)

    def loss(a, b):
        points = [(x / 4, k == "toxic", n) for k, x, n in rated] + [(0.0, True, 1), (toxicity.BEND, False, 1)]
        fit = sum(n * np.logaddexp(0, -(a + b * x) if y else a + b * x) for x, y, n in points)
        return fit + 5e-4 * (a * a + b * b)

    assert b > 0 and all(loss(a, b) <= loss(a + i * 1e-3, b + j * 1e-4) for i in (-1, 0, 1) for j in (-1, 0, 1))


def test_evidence_is_never_cut_and_scores_of_half_are_toxic(spark):
    model = toxicity.Model({b"bad": 5.0}, rate=1.0, scale=0.01, intercept=-4.0, slope=0.05)
    scores = [toxicity._probability(toxicity._walk("bad " * n, toxicity._Scores(model.tokens)), model)[0]
              for n in (1, 5, 10, 14, 15, 40, 400, 4000)]
    assert all(x < y for x, y in zip(scores, scores[1:])) and scores[-1] < 1
    sure = toxicity.Model({}, intercept=0.0)
    half = spark.createDataFrame([(1, "x"), (2, None), (3, "long " * 300_000)], "doc_id long, text string")
    assert {r.score for r in toxicity.score(half, sure).collect()} == {0.5}
    assert toxicity.clean(half, sure).count() == 0
