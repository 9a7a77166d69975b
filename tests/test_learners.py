"""The three learners, scoring, the fitted unit of scaler + assembler + learner."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import GRADE, wine_rows
from rowcast.functions.labels import add_threshold_label
from rowcast.operators.features import assemble
from rowcast.operators.learners import build_pipeline, fit, make_learner, score
from rowcast.plans.jobs import FEATURES, score_with
from rowcast.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def wine(spark):
    return spark.createDataFrame(wine_rows(300, seed=5), [*FEATURES, GRADE]).cache()


def test_reference_defaults_and_explicit_seed():
    assert make_learner("lr", GRADE).getMaxIter() == 10
    assert make_learner("rf", GRADE).getNumTrees() == 100
    gbt = make_learner("gbt", "binary_quality")
    assert gbt.getMaxIter() == 100 and gbt.getSeed() == 42
    assert make_learner("gbt", "y", maxIter=10).getMaxIter() == 10


def test_lr_probability_is_softmax_of_the_coefficients(wine):
    data = assemble(wine, FEATURES)
    model = fit(make_learner("lr", GRADE), data)
    top = wine.agg(F.max(GRADE)).first()[0]
    assert model.numClasses == top + 1  # the grade is the class index, from 0
    rows = score(model, data).select("features", "probability").collect()
    x = np.array([r.features.toArray() for r in rows])
    c = model.coefficientMatrix.toArray()
    b = model.interceptVector.toArray()
    z = x @ c.T + b
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    got = np.array([r.probability.toArray() for r in rows])
    assert np.allclose(got, p, atol=1e-12)


def test_refit_on_another_label_changes_predictions(wine):
    data = assemble(wine, FEATURES)
    preds = []
    for cut in (6, 5):
        labelled = add_threshold_label(data, GRADE, "y", cut)
        model = fit(make_learner("gbt", "y", maxIter=5), labelled)
        preds.append([r.prediction for r in score(model, labelled).select("prediction").collect()])
    assert preds[0] != preds[1]


def test_scoring_without_the_label_gives_the_same_predictions(wine):
    data = assemble(wine, FEATURES)
    model = fit(make_learner("rf", GRADE, numTrees=5), data)
    with_label = score_with(model, wine).predictions.select("prediction").collect()
    without = score_with(model, wine.drop(GRADE)).predictions
    assert without.columns == ["prediction", "features_str"]
    assert without.select("prediction").collect() == with_label


def test_same_seed_same_forest(wine):
    data = assemble(wine, FEATURES)
    a = fit(make_learner("rf", GRADE, numTrees=5), data)
    b = fit(make_learner("rf", GRADE, numTrees=5), data)
    def shape(m):  # each tree without its header line (which carries a fresh uid)
        return [t.toDebugString.split("\n", 1)[1] for t in m.trees]

    assert shape(a) == shape(b)


def test_gbt_needs_a_binary_label(wine):
    data = assemble(wine, FEATURES)
    with pytest.raises(Exception):
        fit(make_learner("gbt", GRADE, maxIter=2), data)


@pytest.mark.parametrize("bad", [-1.0, 2.5])
def test_forest_rejects_negative_or_fractional_labels(spark, bad):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 1.0), (3.0, bad)], "x double, y double")
    with pytest.raises(Exception):
        fit(make_learner("rf", "y", numTrees=2), assemble(df, ["x"]))


def test_gbt_trains_on_one_class(spark):
    df = spark.createDataFrame([(float(i), 1) for i in range(20)], "x double, y int")
    model = fit(make_learner("gbt", "y", maxIter=2), assemble(df, ["x"]))
    assert {r.prediction for r in score(model, assemble(df, ["x"])).collect()} == {1.0}


def test_pipeline_scales_then_fits_and_round_trips(wine, scratch):
    labelled = add_threshold_label(wine, GRADE, "y")
    stages = build_pipeline(FEATURES, "y", kind="rf", numTrees=5)
    model = fit(stages, labelled)
    scaler = model.stages[0]
    x = np.array(wine.select(*FEATURES).collect())
    assert np.allclose(scaler.getStds(), x.std(axis=0))
    save_model(model, f"{scratch}/p")
    back = load_model(f"{scratch}/p", "pipeline")
    a = model.transform(labelled).select("prediction").collect()
    b = back.transform(labelled.drop("y")).select("prediction").collect()
    assert a == b
    assert score(back, wine).where(F.col("prediction").isNull()).count() == 0
