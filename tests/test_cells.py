"""L2-L4: tree fits over counted cells give the trees of fits over the rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rowcast.operators import cells
from rowcast.operators.features import assemble
from rowcast.operators.learners import build_pipeline, fit, make_learner, score
from rowcast.sources.models import load_model, save_model


@pytest.fixture
def large(monkeypatch):
    """Every table counts as large."""
    monkeypatch.setattr(cells, "LEAST_ROWS", 1)


@pytest.fixture(scope="module")
def few(spark):
    """20,000 rows, two features of 12 and 9 values, labels that no tree gets all right."""
    r = spark.range(20_000).select(
        (F.col("id") * 7 % 12 - 3).cast("double").alias("a"), (F.hash("id") % 5).cast("double").alias("b"),
        (F.abs(F.hash("id", F.lit(1))) % 10).alias("noise"), "id",
    )
    return r.withColumn("y", ((F.col("a") * F.col("b") > 2).cast("int") + (F.col("noise") == 0).cast("int")) % 2).cache()


def shape(model):
    return model.toDebugString.split("\n", 1)[1]


def test_boosting_over_cells_is_boosting_over_rows(few, large, monkeypatch):
    data = assemble(few, ["a", "b"])
    taken = []
    monkeypatch.setattr(cells, "_fit_boosted", lambda e, c, b, f=cells._fit_boosted: taken.append(c.count()) or f(e, c, b))
    learner = make_learner("gbt", "y", maxIter=5)
    model, plain = fit(learner, data), learner.fit(data)
    assert taken and taken[0] <= 12 * 9 * 2  # MLlib gets cells, not 20,000 rows
    raw = vector_to_array("rawPrediction")[1]
    a, b = ([r[0] for r in score(m, data).orderBy("id").select(raw).collect()] for m in (model, plain))
    assert np.allclose(a, b, atol=1e-9)
    assert model.getMaxIter() == 5 and model.getNumTrees == 5 and model.numFeatures == 2


def test_trees_of_many_values_split_where_their_cells_did(spark, large):
    """Thresholds lie between bins: training rows fall as their cells did."""
    rows = spark.range(30_000).select(
        F.randn(3).alias("x"), F.lit(4.0).alias("same"), (F.abs(F.hash("id")) % 4).cast("double").alias("z"),
    ).withColumn("y", (F.col("x") > 0.3).cast("int")).cache()
    data = assemble(rows, ["x", "same", "z"])
    learner = make_learner("gbt", "y", maxIter=1, maxDepth=2, maxBins=16)
    model = cells.fit_cells(learner, data)
    values = np.array(rows.select("x", "y").collect())
    root = model._java_obj.trees()[0].rootNode()
    t = root.split().threshold()
    assert root.split().featureIndex() == 0
    left = values[values[:, 0] <= t]
    assert root.leftChild().prediction() == pytest.approx(np.mean(2 * left[:, 1] - 1))
    # 16 bins over all rows: the cut is a quantile to within one part in 1,600.
    share = len(left) / len(values) * 16
    assert abs(share - round(share)) < 0.05


def test_a_forest_draws_rows_not_cells(spark, few, large, scratch):
    data = assemble(few, ["a", "b"])
    learner = make_learner("rf", "y", numTrees=12)
    model = cells.fit_cells(learner, data)
    assert len(model.trees) == 12 and model.numClasses == 2
    counts = [t._java_obj.rootNode().impurityStats().count() for t in model.trees]
    # A bootstrap of 20,000 rows: mean 20,000, deviation 141 (drawn by cells it would be some 1,600).
    assert len(set(counts)) > 1 and all(abs(c - 20_000) < 5 * 141 for c in counts)
    again = cells.fit_cells(learner, assemble(few.repartition(7, "noise"), ["a", "b"]))
    assert shape(again) == shape(model)  # wherever the rows lie
    other = cells.fit_cells(make_learner("rf", "y", numTrees=12, seed=5), data)
    assert shape(other) != shape(model)
    plain = learner.fit(data)
    agree = score(model, data).select("id", "prediction").join(
        score(plain, data).select("id", F.col("prediction").alias("p")), "id")
    assert agree.where("prediction = p").count() >= 0.97 * 20_000
    save_model(model, f"{scratch}/rf")
    assert shape(load_model(f"{scratch}/rf", "rf")) == shape(model)


def test_a_pipeline_fits_its_forest_over_cells(few, large, monkeypatch, scratch):
    taken = []
    monkeypatch.setattr(cells, "_fit_forest", lambda *a, f=cells._fit_forest: taken.append(1) or f(*a))
    model = fit(build_pipeline(["a", "b"], "y", kind="rf", numTrees=3), few)
    assert taken
    save_model(model, f"{scratch}/p")
    back = load_model(f"{scratch}/p", "pipeline")
    assert score(back, few).select("prediction").collect() == score(model, few).select("prediction").collect()


@pytest.mark.parametrize("rate, bootstrap", [(0.5, True), (0.5, False), (1.0, False)])
def test_draws_of_other_rates(few, large, rate, bootstrap):
    learner = make_learner("rf", "y", numTrees=3, subsamplingRate=rate, bootstrap=bootstrap)
    model = cells.fit_cells(learner, assemble(few, ["a", "b"]))
    for t in model.trees:
        assert abs(t._java_obj.rootNode().impurityStats().count() - rate * 20_000) <= (600 if rate < 1 else 0)


def test_what_only_rows_can_give_is_fitted_over_rows(spark, few, large):
    data = assemble(few, ["a", "b"])
    for learner in (make_learner("lr", "y"), make_learner("rf", "y", minInstancesPerNode=2),
                    make_learner("gbt", "y", subsamplingRate=0.5), make_learner("gbt", "y", weightCol="noise")):
        assert cells.fit_cells(learner, data) is None
    distinct = assemble(few.select("y", F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c")), ["a", "b", "c"])
    assert cells.fit_cells(make_learner("rf", "y"), distinct) is None  # as many cells as rows
    assert cells.fit_cells(make_learner("rf", "y"), assemble(few.where("id < 0"), ["a", "b"])) is None
    for bad in (-1.0, 2.5, None):
        odd = few.withColumn("y", F.when(F.col("id") == 3, F.lit(bad)).otherwise(F.col("y").cast("double")))
        assert cells.fit_cells(make_learner("rf", "y"), assemble(odd, ["a", "b"])) is None
    endless = few.withColumn("a", F.when(F.col("id") == 3, float("inf")).otherwise(F.col("a")))
    assert cells.fit_cells(make_learner("rf", "y"), assemble(endless, ["a", "b"])) is None


def test_a_class_that_a_bootstrap_misses_stays(spark, large):
    rows = spark.range(4_000).select((F.col("id") % 5).cast("double").alias("a"), F.when(F.col("id") == 9, 7).otherwise(F.col("id") % 2).alias("y"))
    model = cells.fit_cells(make_learner("rf", "y", numTrees=8), assemble(rows, ["a"]))
    assert model.numClasses == 8 and {t.numClasses for t in model.trees} == {8}
