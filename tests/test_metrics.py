"""A1, A2: weighted F1 and area under ROC against MLlib's evaluators."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

from rowcast.operators.metrics import auc_roc, auc_roc_evaluator, confusion_counts, weighted_f1


def _f1(df, label="y", pred="p"):
    return weighted_f1(df, label, pred).first()["f1"]


def _evaluator_f1(df, label="y", pred="p"):
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=pred, metricName="f1"
    ).evaluate(df)


def _auc(df, **kw):
    return auc_roc(df, "y", "s", **kw).first()["auc"]


def _exact_evaluator_auc(df):
    return BinaryClassificationEvaluator(
        labelCol="y", rawPredictionCol="s", metricName="areaUnderROC", numBins=0
    ).evaluate(df)


def test_weighted_f1_matches_the_evaluator_with_unseen_predictions(spark):
    rng = np.random.default_rng(0)
    rows = [(float(rng.integers(0, 5)), float(rng.integers(0, 7))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "y double, p double")
    assert _f1(df) == pytest.approx(_evaluator_f1(df), abs=1e-12)


def test_weighted_f1_int_label_against_double_prediction(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 1.0), (3, 3.0)], "y int, p double")
    assert _f1(df) == pytest.approx(_evaluator_f1(df), abs=1e-12)


def test_weighted_f1_edge_cases(spark):
    one = spark.createDataFrame([(1.0, 1.0)] * 5, "y double, p double")
    assert _f1(one) == 1.0 == _evaluator_f1(one)
    empty = spark.createDataFrame([], "y double, p double")
    assert _f1(empty) == 0.0
    assert confusion_counts(one, "y", "p").count() == 1


def test_weighted_f1_null_label_raises(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, 1.0)], "y double, p double")
    with pytest.raises(Exception, match="NULL"):
        _f1(df)


@pytest.mark.parametrize("buckets", [1, 3, 16, 64])
def test_auc_matches_the_exact_evaluator_with_ties(spark, buckets):
    rng = np.random.default_rng(buckets)
    # "+ 0.0" turns -0.0 into 0.0: the evaluator keeps the two apart.
    rows = [(int(rng.random() < 0.4), float(np.round(rng.normal(), 1)) + 0.0) for _ in range(3000)]
    df = spark.createDataFrame(rows, "y int, s double")
    assert _auc(df, buckets=buckets) == pytest.approx(_exact_evaluator_auc(df), abs=1e-12)


def test_auc_treats_negative_zero_as_a_tie_with_zero(spark):
    rows = [(1, -0.0), (0, 0.0), (1, 0.5), (0, -0.5)]
    df = spark.createDataFrame(rows, "y int, s double")
    # positives: -0.0 beats -0.5 and ties 0.0 (1.5); 0.5 beats both (2) -> 3.5 / 4
    assert _auc(df, buckets=2) == pytest.approx(3.5 / 4)


def test_auc_on_a_raw_prediction_vector(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(i % 2, Vectors.dense([-float(i % 7), float(i % 7)])) for i in range(200)]
    df = spark.createDataFrame(rows, ["y", "rawPrediction"])
    got = auc_roc(df, "y").first()["auc"]
    assert got == pytest.approx(auc_roc_evaluator(df, "y", num_bins=0), abs=1e-12)


def test_auc_edge_cases(spark):
    pos = spark.createDataFrame([(1, 0.3), (1, 0.7)], "y int, s double")
    neg = spark.createDataFrame([(0, 0.3), (0, 0.7)], "y int, s double")
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5)] * 10, "y int, s double")
    empty = spark.createDataFrame([], "y int, s double")
    assert _auc(pos) == 1.0 == _exact_evaluator_auc(pos)
    assert _auc(neg) == 0.0 == _exact_evaluator_auc(neg)
    assert _auc(tied) == 0.5
    assert _auc(empty) == 0.5


def test_auc_one_hot_score_holding_a_third_of_rows(spark):
    rows = [(i % 3 == 0, 0.25 if i % 3 else float(i)) for i in range(3000)]
    df = spark.createDataFrame([(int(a), b) for a, b in rows], "y int, s double")
    assert _auc(df, buckets=8) == pytest.approx(_exact_evaluator_auc(df), abs=1e-12)


def test_auc_on_gbt_scores_with_many_ties_matches_the_exact_evaluator(spark):
    """Brute force on real model output: GBT margins are sums of leaf values,
    so many rows share a score."""
    from pyspark.sql import functions as F

    from rowcast.functions.labels import add_threshold_label
    from rowcast.plans.jobs import fit_and_score, release

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    res = fit_and_score(add_threshold_label(li, "l_linenumber", "y", 4), "gbt", "y", feats,
                        metric="auc", maxIter=5)
    scored = res.model.transform(res.cached[0])
    assert scored.select(F.countDistinct("rawPrediction")).first()[0] < scored.count()
    want = auc_roc_evaluator(scored, "y", num_bins=0)
    assert res.metrics.first()["auc"] == pytest.approx(want, abs=1e-12)
    release(res)


def test_area_counts_pairs_beyond_a_bigint(spark):
    """Per-range totals as of 2e10 rows: P * N is far above 2**63."""
    from pyspark.sql import functions as F

    from rowcast.operators.metrics import _area_parts

    many = 10_000_000_000
    rows = spark.createDataFrame([(many, 0, many), (0, many, 0)], "p long, n long, n_lower long")
    r = rows.agg(*_area_parts(F.col("n_lower"))).first()
    assert r.u == float(many) * float(many) and (r.p, r.n) == (many, many)


def test_null_scores_and_predictions_raise(spark):
    import pytest

    from rowcast.operators.metrics import auc_roc, weighted_f1

    rows = spark.createDataFrame([(1, 0.5), (0, None), (1, 0.2)], "y int, prediction double")
    with pytest.raises(Exception, match="score column 'prediction' holds NULL"):
        auc_roc(rows, "y", "prediction").collect()
    with pytest.raises(Exception, match="prediction column 'prediction' holds NULL"):
        weighted_f1(rows, "y").collect()
