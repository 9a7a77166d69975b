"""Token counts against the lengths themselves."""

import numpy as np

from rowcast.llm import token_counts
from rowcast.llm.common import encoder, tokenizer_path


def test_suffix_sums_answer_every_limit(spark):
    rng = np.random.default_rng(2)
    texts = ["word " * int(n) for n in rng.integers(0, 300, 120)] + [None, "", "x " * 9000, "x " * 9000]
    frame = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_docs int")
    encode = encoder(tokenizer_path()).encode
    lengths = np.array([len(encode(t or "")) for t in texts])
    hist = token_counts.histogram(frame.repartition(3)).cache()
    sums = token_counts.suffix_sums(hist).collect()
    assert {r.n_tokens: r.n_docs for r in sums} == dict(zip(*np.unique(lengths, return_counts=True)))
    for r in sums:
        at = r.n_tokens
        assert r.docs_ge == (lengths >= at).sum() and r.docs_le == (lengths <= at).sum()
        assert r.tokens_ge == lengths[lengths >= at].sum() and r.tokens_total == lengths.sum()
        assert r.truncated_total == np.minimum(lengths, at).sum()
        assert r.quantile == (lengths <= at).mean()
    limits = [0, 1, 100, 4096, 10**6]
    got = {r.context_limit: r.total for r in token_counts.truncated_totals(hist, limits).collect()}
    assert got == {x: np.minimum(lengths, x).sum() for x in limits}
    asked = token_counts.quantiles(token_counts.suffix_sums(hist), [0.1, 0.5, 1.0]).collect()
    ordered = np.sort(lengths)
    assert {r.prob: r.n_tokens for r in asked} == {p: ordered[int(np.ceil(p * len(ordered))) - 1] for p in (0.1, 0.5, 1.0)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.suffix_sums(token_counts.histogram(empty)).collect() == []
    totals = token_counts.truncated_totals(token_counts.histogram(empty), [5, 7]).collect()
    assert sorted(map(tuple, totals)) == [(5, 0), (7, 0)]


def test_limits_between_the_lengths_come_from_the_suffix_sums(spark):
    """Lengths in several blocks, limits below, between, at and above them."""
    rng = np.random.default_rng(7)
    lengths = rng.choice([0, 1, 5, 4095, 4096, 9000, 20_000], 300)
    values, counts = np.unique(lengths, return_counts=True)
    hist = spark.createDataFrame([(int(v), int(c)) for v, c in zip(values, counts)], "n_tokens long, n_docs long")
    limits = [0, 2, 5, 4000, 4096, 4097, 8192, 19_999, 30_000, 5]
    made = token_counts.truncated_totals(hist, limits)
    assert {r.context_limit: r.total for r in made.collect()} == {x: np.minimum(lengths, x).sum() for x in limits}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "least(" not in plan
