"""Delimited scan, CSV sink, model folders."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import GRADE, wine_rows, write_delimited_text
from rowcast.functions.vectors import with_vector_text
from rowcast.operators.features import assemble
from rowcast.operators.learners import fit, make_learner
from rowcast.plans.jobs import FEATURES
from rowcast.sources.delimited import read_delimited, write_csv
from rowcast.sources.models import load_model, save_model

EXPECTED_TYPES = {c: "double" for c in FEATURES} | {GRADE: "int"}


@pytest.mark.parametrize("quotes", [0, 1, 3, 4])
def test_scan_infers_types_and_cleans_quoted_headers(spark, scratch, quotes):
    q = '"' * quotes
    header = [f"{q}{c}{q}" for c in [*FEATURES, GRADE]]
    path = write_delimited_text(f"{scratch}/t.csv", header, wine_rows(40, seed=quotes))
    df = read_delimited(spark, path)
    assert df.columns == [*FEATURES, GRADE]
    assert dict(df.dtypes) == EXPECTED_TYPES
    assert df.count() == 40


def test_scan_with_given_schema_skips_inference(spark, scratch):
    path = write_delimited_text(f"{scratch}/t.csv", [*FEATURES, GRADE], wine_rows(10))
    schema = ", ".join(f"{c} double" for c in FEATURES) + f", {GRADE} int"
    df = read_delimited(spark, path, schema=schema)
    assert dict(df.dtypes) == EXPECTED_TYPES
    assert df.count() == 10


SCHEMA = ", ".join(f"{c} double" for c in FEATURES) + f", {GRADE} int"


def test_schema_is_matched_by_header_name(spark, scratch):
    order = [GRADE, *reversed(FEATURES)]
    rows = [tuple(reversed(r)) for r in wine_rows(10)]
    path = write_delimited_text(f"{scratch}/r.csv", [f'"{c.replace("_", " ")}"' for c in order], rows)
    df = read_delimited(spark, path, schema=SCHEMA)
    assert df.columns == order and dict(df.dtypes) == EXPECTED_TYPES
    assert sorted(map(tuple, df.select(*FEATURES, GRADE).collect())) == sorted(wine_rows(10))
    more = write_delimited_text(f"{scratch}/m.csv", ["note", *FEATURES, GRADE], [("x", *r) for r in wine_rows(3)])
    assert dict(read_delimited(spark, more, schema=SCHEMA).dtypes) == EXPECTED_TYPES | {"note": "string"}


def test_schema_mismatches_raise(spark, scratch):
    rows = wine_rows(5)
    rows[2] = (*rows[2][:-1], "five")
    path = write_delimited_text(f"{scratch}/bad.csv", [*FEATURES, GRADE], rows)
    with pytest.raises(Exception, match="MALFORMED|five"):
        read_delimited(spark, path, schema=SCHEMA).collect()
    short = write_delimited_text(f"{scratch}/short.csv", FEATURES, [r[:-1] for r in wine_rows(3)])
    with pytest.raises(ValueError, match="lacks"):
        read_delimited(spark, short, schema=SCHEMA)
    write_delimited_text(f"{scratch}/two/a.csv", ["a", "b"], [(1, 2)])
    write_delimited_text(f"{scratch}/two/b.csv", ["b", "a"], [(1, 2)])
    with pytest.raises(Exception, match="header"):
        read_delimited(spark, f"{scratch}/two", schema="a int, b int").collect()


def test_duplicate_headers_are_suffixed_by_the_reader(spark, scratch):
    path = write_delimited_text(f"{scratch}/d.csv", ["a", "a", "b"], [(1, 2, 3)])
    assert read_delimited(spark, path).columns == ["a0", "a1", "b"]


def test_malformed_grade_makes_the_column_text(spark, scratch):
    rows = wine_rows(5)
    rows[2] = (*rows[2][:-1], "five")
    path = write_delimited_text(f"{scratch}/m.csv", [*FEATURES, GRADE], rows)
    assert dict(read_delimited(spark, path).dtypes)[GRADE] == "string"


def test_csv_sink_round_trips_vector_text_with_commas(spark, scratch):
    df = spark.createDataFrame(wine_rows(20), [*FEATURES, GRADE])
    rows = with_vector_text(assemble(df, FEATURES)).select(GRADE, "features_str")
    out = f"{scratch}/out"
    write_csv(rows, out)
    write_csv(rows, out)  # overwrite is the default
    back = spark.read.option("header", True).schema(rows.schema).csv(out)
    assert sorted(back.collect()) == sorted(rows.collect())
    assert all("," in r.features_str for r in back.collect())


def test_csv_sink_refuses_a_vector_column(spark, scratch):
    df = assemble(spark.createDataFrame(wine_rows(3), [*FEATURES, GRADE]), FEATURES)
    with pytest.raises(AnalysisException):
        write_csv(df.select("features"), f"{scratch}/vec")


def test_csv_sink_default_refuses_existing_path_in_errorifexists_mode(spark, scratch):
    df = spark.range(3)
    write_csv(df, f"{scratch}/x")
    with pytest.raises(AnalysisException):
        write_csv(df, f"{scratch}/x", mode="errorifexists")


def test_model_save_load_overwrite_and_typed_load(spark, scratch):
    df = assemble(spark.createDataFrame(wine_rows(120), [*FEATURES, GRADE]), FEATURES)
    model = fit(make_learner("lr", GRADE), df)
    path = f"{scratch}/lr"
    save_model(model, path, overwrite=False)
    with pytest.raises(Exception, match="already exists"):
        save_model(model, path, overwrite=False)
    save_model(model, path, overwrite=True)
    loaded = load_model(path, "lr")
    a = model.transform(df).select("prediction").collect()
    b = loaded.transform(df).select("prediction").collect()
    assert a == b
    with pytest.raises(Exception, match="(?i)class"):
        load_model(path, "rf")


def test_scan_reads_a_folder_of_part_files(spark, scratch):
    df = spark.createDataFrame(wine_rows(50), [*FEATURES, GRADE]).repartition(4)
    write_csv(df, f"{scratch}/parts", sep=";")
    back = read_delimited(spark, f"{scratch}/parts")
    assert back.count() == 50
    assert back.agg(F.sum(GRADE)).first()[0] == df.agg(F.sum(GRADE)).first()[0]


def test_overwrite_onto_the_path_being_read_is_refused_and_keeps_the_input(spark, scratch):
    write_csv(spark.range(5), f"{scratch}/self")
    src = spark.read.option("header", True).csv(f"{scratch}/self")
    with pytest.raises(ValueError, match="reads from"):
        write_csv(src, f"{scratch}/self")
    with pytest.raises(ValueError):
        write_csv(src, f"file://{scratch}/self/")
    assert spark.read.option("header", True).csv(f"{scratch}/self").count() == 5
    write_csv(src, f"{scratch}/self-copy")  # a sibling with a common prefix is fine
    assert spark.read.option("header", True).csv(f"{scratch}/self-copy").count() == 5


def test_overwrite_check_sees_through_a_cache_and_both_ways(spark, scratch):
    from rowcast.sources.delimited import reads_from

    src = f"{scratch}/src"
    spark.range(3).write.parquet(src)
    df = spark.read.parquet(src)
    assert reads_from(df, src) and reads_from(df, f"file:{src}/")
    assert reads_from(df, scratch)  # a folder above the input
    assert reads_from(df, f"{src}/below")  # a folder inside it
    assert not reads_from(df, f"{scratch}/not-there")
    assert not reads_from(df, f"{src}-sibling")
    cached = df.where("id > 0").cache()
    try:
        assert cached.count() == 2
        assert reads_from(cached.join(spark.range(2), "id"), src)
        with pytest.raises(ValueError, match="reads from"):
            write_csv(cached, src)
    finally:
        cached.unpersist()
    assert spark.read.parquet(src).count() == 3


def test_other_file_systems_are_read_and_written(spark, scratch):
    """Everything goes through the Hadoop path's own file system."""
    import os

    from conftest import SCRATCH
    from rowcast.plans.jobs import score_job, train_validate_job

    write_delimited_text(f"{scratch}/t.csv", [*FEATURES, GRADE], wine_rows(60))
    store = f"viewfs://store/data/{os.path.relpath(scratch, SCRATCH)}"
    assert read_delimited(spark, f"{store}/t.csv").count() == 60
    train_validate_job(spark, f"{store}/t.csv", f"{store}/t.csv", f"{store}/lr")
    score_job(spark, f"{store}/t.csv", f"{store}/lr", f"{store}/out")
    assert spark.read.option("header", True).csv(f"{scratch}/out").count() == 60
    with pytest.raises(ValueError, match="refusing"):
        score_job(spark, f"{store}/t.csv", f"{store}/lr", f"{store}/t.csv")
