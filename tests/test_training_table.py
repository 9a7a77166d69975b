"""L2-L4: fits over a training table are repeatable and do not shuffle."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import GRADE, wine_rows, write_delimited_text
from rowcast.operators.learners import fit, make_learner
from rowcast.plans.jobs import FEATURES, main, prepared, train_and_score_job
from rowcast.runtime import Layout, laid_out
from rowcast.sources import training_table
from rowcast.sources.training_table import read_training_table, write_training_table


def wine(spark, parts):
    return spark.createDataFrame(wine_rows(400, seed=7), [*FEATURES, GRADE]).repartition(parts)


def places(df):
    """Rows by partition, in their order."""
    return [[tuple(r) for r in part] for part in df.rdd.glom().collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_have_the_places_of_the_layout(spark, scratch):
    layout = Layout(5, ["alcohol", "density"])
    write_training_table(wine(spark, 3), f"{scratch}/t", layout)
    table = read_training_table(spark, f"{scratch}/t")
    assert places(table) == places(laid_out(wine(spark, 7), layout))
    assert len([f for f in os.listdir(f"{scratch}/t") if f.endswith(".parquet")]) == 5


def test_equal_trees_without_a_shuffle(spark, scratch):
    """From other partitionings, split sizes and shuffle widths."""
    layout, trees = Layout(4), []
    for parts, width, split in ((1, "8", "128m"), (9, "3", "2k")):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            path = f"{scratch}/t{parts}"
            write_training_table(wine(spark, parts), path, layout)
            for _ in range(2):
                data = prepared(read_training_table(spark, path), GRADE)
                assert "Exchange" not in plan(data) and "Sort" not in plan(data)
                assert "SelectedBucketsCount: 4 out of 4" in plan(data)
                assert data.rdd.getNumPartitions() == 4
                model = fit(make_learner("rf", GRADE, numTrees=5), data)
                trees.append(model.toDebugString.split("\n", 1)[1])
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by_layout = fit(make_learner("rf", GRADE, numTrees=5), prepared(wine(spark, 6), GRADE, layout=layout))
    assert set(trees) == {by_layout.toDebugString.split("\n", 1)[1]}
    # The caller's session reads tables as before.
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"
    assert spark.catalog.listTables() == []


def test_a_failing_write_keeps_the_table(spark, scratch):
    path, layout = f"{scratch}/t", Layout(3, ["id"])
    write_training_table(spark.range(10), path, layout)
    bad = spark.range(50).select(F.when(F.col("id") == 49, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_training_table(bad, path, layout)
    assert read_training_table(spark, path).count() == 10
    with pytest.raises(ValueError, match="reads from"):
        write_training_table(read_training_table(spark, path), path, layout)
    write_training_table(spark.range(4), path, layout, commit="manifest")
    assert read_training_table(spark, path).count() == 4
    write_training_table(spark.range(0), path, layout)
    assert read_training_table(spark, path).count() == 0


def test_odd_names_and_nulls(spark, scratch):
    df = spark.createDataFrame([(None, "a'b", 1), (2.5, None, 2), (2.5, None, 2)], "`a b` double, `c'd` string, e int")
    write_training_table(df, f"{scratch}/it's", Layout(2))
    assert sorted(map(str, read_training_table(spark, f"{scratch}/it's").collect())) == sorted(map(str, df.collect()))


def test_jobs_train_from_a_prepared_table(spark, scratch):
    path = write_delimited_text(f"{scratch}/w.csv", [*FEATURES, GRADE], wine_rows(200, seed=8))
    assert main(["prepare", path, f"{scratch}/table", "3"], spark) == 0
    models = []
    for i in range(2):
        res = train_and_score_job(spark, f"{scratch}/table", f"{scratch}/m{i}", f"{scratch}/o{i}", kind="rf", numTrees=3)
        assert res.predictions.count() == 200
        models.append(res.model.toDebugString.split("\n", 1)[1])
    assert models[0] == models[1]
    with pytest.raises(ValueError, match="refusing"):
        train_and_score_job(spark, f"{scratch}/table", f"{scratch}/m", f"{scratch}/table", kind="rf", numTrees=2)


@pytest.mark.parametrize("keys", [None, ["id"]])
def test_a_large_table_has_buckets_of_bounded_size(spark, scratch, monkeypatch, keys):
    """Whatever few partitions are asked for, and though most rows are equal."""
    monkeypatch.setattr(training_table, "BUCKET_ROWS", 400)
    df = spark.range(6_000).select(
        F.when(F.col("id") < 5_000, F.col("id") % 2).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 4 == 2, -0.0).when(F.col("id") % 4 == 0, 0.0).alias("x y"),
    )
    found = []
    for parts in (1, 9):
        write_training_table(df.repartition(parts), f"{scratch}/{parts}", Layout(2, keys))
        table = read_training_table(spark, f"{scratch}/{parts}")
        assert table.columns == df.columns and table.schema["id"].dataType == df.schema["id"].dataType
        assert sorted(map(str, table.collect())) == sorted(map(str, df.collect()))
        assert "Exchange" not in plan(table) and table.rdd.getNumPartitions() == 15
        found.append(places(table))
    assert found[0] == found[1]
    assert max(map(len, found[0])) <= 2 * 400  # in two buckets: 2,500 and more


def test_more_buckets_only_where_rows_fill_them(spark, scratch, monkeypatch):
    monkeypatch.setattr(training_table, "BUCKET_ROWS", 100)
    write_training_table(spark.range(350), f"{scratch}/a", Layout(4, ["id"]))
    assert places(read_training_table(spark, f"{scratch}/a")) == places(laid_out(spark.range(350), Layout(4, ["id"])))
    write_training_table(spark.range(950), f"{scratch}/b", Layout(4, ["id"]))
    assert places(read_training_table(spark, f"{scratch}/b")) == places(laid_out(spark.range(950), Layout(10, ["id"])))
