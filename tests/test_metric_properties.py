"""Property tests: the distributed metrics against direct formulas on random tables."""

from __future__ import annotations

from collections import Counter

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rowcast.operators.metrics import auc_roc, weighted_f1

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def f1_direct(pairs):
    """Per-class F1 2tp/(t+q), weighted by true-class counts."""
    if not pairs:
        return 0.0
    t = Counter(y for y, _ in pairs)
    q = Counter(p for _, p in pairs)
    tp = Counter(y for y, p in pairs if y == p)
    return sum(n * 2 * tp[k] / (n + q[k]) for k, n in t.items()) / len(pairs)


def auc_direct(rows):
    """Mann-Whitney with mid-ranks, via pandas' average rank."""
    df = pd.DataFrame(rows, columns=["y", "s"])
    p = int(df.y.sum())
    n = len(df) - p
    if p == 0 or n == 0:
        return 1.0 if p else (0.0 if n else 0.5)
    r = df.s.rank(method="average")
    return float((r[df.y == 1].sum() - p * (p + 1) / 2) / (p * n))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 6)), max_size=60))
def test_weighted_f1_property(spark, pairs):
    df = spark.createDataFrame([(float(y), float(p)) for y, p in pairs], "y double, p double")
    got = weighted_f1(df, "y", "p").first()["f1"]
    assert got == pytest.approx(f1_direct(pairs), abs=1e-12)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(-5, 5)), max_size=80),
       st.integers(1, 6))
def test_auc_property(spark, rows, buckets):
    df = spark.createDataFrame([(y, float(s)) for y, s in rows], "y int, s double")
    got = auc_roc(df, "y", "s", buckets=buckets).first()["auc"]
    assert got == pytest.approx(auc_direct(rows), abs=1e-12)
