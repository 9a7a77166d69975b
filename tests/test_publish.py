"""A failing write leaves what was there; both ways to publish."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import GRADE, SCRATCH, wine_rows
from rowcast.operators.features import assemble
from rowcast.operators.learners import fit, make_learner
from rowcast.plans.jobs import FEATURES
from rowcast.sources import models, publish
from rowcast.sources.delimited import write_csv
from rowcast.sources.models import load_model, save_model


def numbers(spark, path):
    place = publish.current(spark, path)
    return sorted(int(r.id) for r in spark.read.option("header", True).csv(place).collect())


def failing(spark, rows=1000):
    """Some tasks write whole files, then one fails."""
    bad = F.when(F.col("id") == rows - 1, F.raise_error(F.lit("task failed"))).otherwise(F.col("id"))
    return spark.range(0, rows, 1, 8).select(bad.cast("long").alias("id"))


def stores(scratch):
    """The folder by its local path and through a file system of another scheme."""
    return [scratch, f"viewfs://store/data/{os.path.relpath(scratch, SCRATCH)}"]


@pytest.mark.parametrize("commit", ["switch", "manifest"])
def test_a_failing_overwrite_keeps_the_previous_output(spark, scratch, commit):
    for i, root in enumerate(stores(scratch)):
        path = f"{root}/out{i}"
        write_csv(spark.range(5), path, commit=commit)
        before = sorted(os.listdir(scratch))
        with pytest.raises(Exception, match="task failed"):
            write_csv(failing(spark), path, commit=commit)
        assert numbers(spark, path) == [0, 1, 2, 3, 4]
        assert sorted(os.listdir(scratch)) == before  # nothing half-written is left
        write_csv(spark.range(7, 9), path, commit=commit)
        assert numbers(spark, path) == [7, 8]


def test_a_failing_first_write_leaves_nothing(spark, scratch):
    for commit in publish.WAYS:
        with pytest.raises(Exception, match="task failed"):
            write_csv(failing(spark), f"{scratch}/{commit}", commit=commit)
        assert not publish.exists(spark, f"{scratch}/{commit}")


def test_the_old_output_is_readable_while_the_new_one_is_written(spark, scratch):
    path = f"{scratch}/out"
    write_csv(spark.range(3), path)
    with publish.staged(spark, path) as place:
        spark.range(4).write.option("header", True).csv(place)
        assert numbers(spark, path) == [0, 1, 2]
        # Readers of the folder around it do not see the new one either.
        assert spark.read.option("header", True).option("recursiveFileLookup", True).csv(scratch).count() == 3
    assert numbers(spark, path) == [0, 1, 2, 3]


def test_a_writer_that_died_between_its_renames(spark, scratch):
    path = f"{scratch}/out"
    write_csv(spark.range(3), path)
    os.rename(path, f"{scratch}/_out.replaced-0123")
    assert numbers(spark, path) == [0, 1, 2]  # reading through the library puts it back
    os.rename(path, f"{scratch}/_out.replaced-0123")
    write_csv(spark.range(2), path)
    assert numbers(spark, path) == [0, 1] and os.listdir(scratch) == ["out"]


def test_a_failing_rename_restores_the_old_output(spark, scratch, monkeypatch):
    path = f"{scratch}/out"
    write_csv(spark.range(3), path)
    with pytest.raises(OSError, match="cannot move"):
        with publish.staged(spark, path):
            pass  # nothing was written, so there is nothing to move
    assert numbers(spark, path) == [0, 1, 2] and os.listdir(scratch) == ["out"]


def test_manifest_versions(spark, scratch):
    path = f"{scratch}/out"
    write_csv(spark.range(1), path)  # by switch before
    for n in range(2, 6):
        write_csv(spark.range(n), path, commit="manifest")
    assert numbers(spark, path) == [0, 1, 2, 3, 4]
    kept = publish.versions(spark, path)
    assert len(kept) == publish.KEPT_VERSIONS
    assert sorted(os.listdir(path)) == sorted([publish.COMMITS, *[v for _, v in kept]])
    # A commit file that was cut off, and a version that no commit names, do not count.
    with open(f"{path}/{publish.COMMITS}/{99:012d}", "w") as f:
        f.write("version-cut")
    os.makedirs(f"{path}/version-unnamed")
    assert numbers(spark, path) == [0, 1, 2, 3, 4]
    write_csv(spark.range(2), path, commit="manifest")
    assert numbers(spark, path) == [0, 1]
    write_csv(spark.range(1), path)
    assert numbers(spark, path) == [0] and publish.versions(spark, path) == []


def test_two_writers_of_one_manifest(spark, scratch):
    path = f"{scratch}/out"
    with publish.staged(spark, path, "manifest") as one:
        spark.range(1).write.option("header", True).csv(one)
        with publish.staged(spark, path, "manifest") as two:
            spark.range(2).write.option("header", True).csv(two)
        assert numbers(spark, path) == [0, 1]
    assert numbers(spark, path) == [0] and len(publish.versions(spark, path)) == 2


def test_modes_and_ways(spark, scratch):
    path = f"{scratch}/out"
    write_csv(spark.range(1), path, mode="errorifexists")
    write_csv(spark.range(5, 6), path, mode="append")
    write_csv(spark.range(9), path, mode="ignore")
    assert numbers(spark, path) == [0, 5]
    with pytest.raises(ValueError, match="commit"):
        write_csv(spark.range(1), path, commit="hope")


@pytest.mark.parametrize("commit", ["switch", "manifest"])
def test_a_failing_save_keeps_the_previous_model(spark, scratch, commit, monkeypatch):
    df = assemble(spark.createDataFrame(wine_rows(120), [*FEATURES, GRADE]), FEATURES)
    model, other = (fit(make_learner("lr", GRADE, maxIter=n), df) for n in (10, 1))
    path = f"{scratch}/lr"
    save_model(model, path, overwrite=False, commit=commit)

    class Half:
        """A model whose save fails after some of its files."""

        def write(self):
            return self

        def save(self, place):
            other.write().save(f"{place}/part")
            raise RuntimeError("disk full")

    with pytest.raises(RuntimeError, match="disk full"):
        save_model(Half(), path, commit=commit)
    assert load_model(path, "lr").coefficientMatrix == model.coefficientMatrix
    with pytest.raises(FileExistsError, match="already exists"):
        models.save_model(other, path, overwrite=False, commit=commit)
    save_model(other, path, commit=commit)
    assert load_model(path, "lr").coefficientMatrix == other.coefficientMatrix
