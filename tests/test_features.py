"""vector assembly and the population-std scaler."""

from __future__ import annotations

import math

import numpy as np
import pytest

from conftest import GRADE, wine_rows
from rowcast.operators.features import PopulationScaler, PopulationScalerModel, assemble
from rowcast.plans.jobs import FEATURES


def test_assembler_raises_on_null_and_nan_only_when_consumed(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    out = assemble(df, ["a", "b"])
    assert out.count() == 2  # the vector is pruned away
    with pytest.raises(Exception):
        out.select("features").collect()
    nan = spark.createDataFrame([(1.0, float("nan"))], "a double, b double")
    with pytest.raises(Exception):
        assemble(nan, ["a", "b"]).select("features").collect()
    assert assemble(df, ["a", "b"], handle_invalid="skip").select("features").count() == 1


def test_assembler_casts_int_and_rejects_strings(spark):
    df = spark.createDataFrame([(1, True)], "a int, b boolean")
    assert assemble(df, ["a", "b"]).first().features.toArray().tolist() == [1.0, 1.0]
    with pytest.raises(Exception):
        assemble(spark.createDataFrame([("x",)], "s string"), ["s"]).collect()


def test_scaler_uses_population_std_and_centres(spark):
    rows = wine_rows(200, seed=3)
    df = spark.createDataFrame(rows, [*FEATURES, GRADE])
    out = [f"{c}_z" for c in FEATURES]
    model = PopulationScaler(inputCols=FEATURES, outputCols=out).fit(df)
    got = np.array(model.transform(df).select(*out).collect())
    x = np.array([r[:11] for r in rows])
    want = (x - x.mean(axis=0)) / x.std(axis=0)  # numpy's default is the population std
    assert np.allclose(got, want, rtol=1e-12, atol=1e-12)
    assert np.allclose(got.std(axis=0), 1.0) and np.allclose(got.mean(axis=0), 0.0)


def test_scaler_constant_column_gives_zero_and_keeps_null(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (None, 3.0)], "c double, v double")
    model = PopulationScaler(inputCols=["c", "v"], outputCols=["cz", "vz"]).fit(df)
    rows = model.transform(df).select("cz", "vz").collect()
    assert [r.cz for r in rows] == [0.0, 0.0, None]
    assert math.isclose(rows[0].vz, -math.sqrt(1.5))


def test_scaler_fit_is_one_aggregate(spark):
    df = spark.createDataFrame(wine_rows(20), [*FEATURES, GRADE])
    sc = spark.sparkContext
    before = set(sc.statusTracker().getJobIdsForGroup())
    PopulationScaler(inputCols=FEATURES, outputCols=[f"{c}_z" for c in FEATURES]).fit(df)
    assert len(set(sc.statusTracker().getJobIdsForGroup()) - before) <= 2


def test_scaler_saves_and_loads(spark, scratch):
    df = spark.createDataFrame(wine_rows(30), [*FEATURES, GRADE])
    model = PopulationScaler(inputCols=["alcohol"], outputCols=["alcohol_z"]).fit(df)
    model.write().overwrite().save(f"{scratch}/scaler")
    back = PopulationScalerModel.load(f"{scratch}/scaler")
    assert back.getMeans() == model.getMeans() and back.getStds() == model.getStds()
    a = model.transform(df).select("alcohol_z").collect()
    assert back.transform(df).select("alcohol_z").collect() == a


def test_scaler_refuses_nan_and_keeps_a_constant_column_at_zero(spark):
    import pytest

    from rowcast.operators.features import PopulationScaler

    rows = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (float("nan"), 5.0)], "a double, b double")
    with pytest.raises(ValueError, match="'a'"):
        PopulationScaler(inputCols=["a", "b"], outputCols=["x", "y"]).fit(rows)
    model = PopulationScaler(inputCols=["b"], outputCols=["y"]).fit(rows)
    assert [r.y for r in model.transform(rows).collect()] == [0.0, 0.0, 0.0]
