"""Name cleaning, threshold labels, vectors as text."""

from __future__ import annotations

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException

from rowcast.functions.labels import add_threshold_label, threshold_label
from rowcast.functions.names import clean_columns, clean_name
from rowcast.functions.vectors import vector_columns, vector_text
from rowcast.operators.features import assemble


def test_clean_name_replaces_spaces_before_stripping():
    assert clean_name(" pH ") == "_pH_"
    assert clean_name('"fixed acidity"') == "fixed_acidity"
    assert clean_name('""""alcohol""""') == "alcohol"
    assert clean_name("density\t") == "density"
    assert clean_name("a b") == "a_b"


def test_clean_columns_is_one_projection_and_rejects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], ['"a b"', "c"])
    assert clean_columns(df).columns == ["a_b", "c"]
    clash = spark.createDataFrame([(1, 2)], ["a b", "a_b"])
    with pytest.raises(ValueError, match="collide"):
        clean_columns(clash)


def test_label_new_and_in_place(spark):
    df = spark.createDataFrame([(5,), (6,), (7,), (None,)], "quality int")
    new = add_threshold_label(df, "quality", "binary_quality").collect()
    assert [(r.quality, r.binary_quality) for r in new] == [(5, 0), (6, 1), (7, 1), (None, 0)]
    inplace = add_threshold_label(df, "quality", "quality")
    assert inplace.columns == ["quality"]
    assert [r.quality for r in inplace.collect()] == [0, 1, 1, 0]
    field = inplace.schema["quality"]
    assert field.dataType.simpleString() == "int" and not field.nullable


def test_label_on_malformed_grade_raises(spark):
    df = spark.createDataFrame([("5",), ("five",)], "quality string")
    with pytest.raises((NumberFormatException, ArithmeticException, Exception)):
        df.select(threshold_label("quality")).collect()


def test_vector_text_dense_and_sparse(spark):
    df = spark.createDataFrame([(1.5, 0.0, 0.0, 0.0), (1.0, 2.0, 3.0, 4.0)], "a double, b double, c double, d double")
    rows = assemble(df, ["a", "b", "c", "d"]).select(vector_text("features").alias("t")).collect()
    assert rows[0].t == "(4,[0],[1.5])"
    assert rows[1].t == "[1.0,2.0,3.0,4.0]"


def test_vector_columns_expand_the_vector(spark):
    df = spark.createDataFrame([(1.5, 2.5)], "a double, b double")
    out = assemble(df, ["a", "b"]).select(*vector_columns("features", ["x", "y"])).first()
    assert (out.x, out.y) == (1.5, 2.5)


def test_label_is_a_single_projection(spark):
    df = spark.createDataFrame([(6,)], "quality int")
    plan = add_threshold_label(df, "quality", "b")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1
