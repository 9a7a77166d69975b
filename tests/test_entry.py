"""The driver contract: entry, and every query against its DuckDB oracle."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _canon(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)]
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["f1"] and len(rows) == 1 and 0.0 <= rows[0].f1 <= 1.0


# The training-data operators have tests of their own.
OWN = [n for n in E.queries() if not n.startswith("op") and n != "pipeline"]


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(OWN) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    a, b = _canon(got), _canon(want)
    for c in a.columns:
        x, y = a[c].astype(object), b[c].astype(object)
        assert ((x == y) | (x.isna() & y.isna())).all(), c


def _mllib_rows(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F

    li = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    va = VectorAssembler(inputCols=E.FEATURES, outputCol="features")
    cut = F.col("l_shipdate") < F.lit(E.VALIDATION_START).cast("timestamp_ntz")
    return li, va.transform(li.where(cut)), va.transform(li.where(~cut)), cut


def test_multinomial_train_validate_equals_plain_mllib(spark):
    """The reference's settings on a grade that no model can learn: the same
    fit with plain MLlib calls, measured by the evaluator."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    from rowcast.plans.jobs import train_validate

    li, one, two, cut = _mllib_rows(spark)
    model = LogisticRegression(labelCol=E.GRADE, maxIter=10).fit(one)
    want = MulticlassClassificationEvaluator(labelCol=E.GRADE, metricName="f1").evaluate(model.transform(two))
    got = train_validate(li.where(cut), li.where(~cut), "lr", E.GRADE, E.FEATURES).metrics.first()["f1"]
    assert 0.0 < got < 1.0 and got == pytest.approx(want, abs=1e-6)


def test_gbt_self_score_equals_plain_mllib(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    from rowcast.plans.jobs import fit_and_score, release

    li, one, _, cut = _mllib_rows(spark)
    model = GBTClassifier(labelCol="returned", maxIter=5, seed=42).fit(one)
    want = BinaryClassificationEvaluator(labelCol="returned", numBins=0).evaluate(model.transform(one))
    result = fit_and_score(li.where(cut), "gbt", "returned", E.FEATURES, metric="auc", maxIter=5)
    release(result)
    assert 0.5 < want < 1.0 and result.metrics.first()["auc"] == pytest.approx(want, abs=1e-9)


def test_embeddings_fit_equals_plain_mllib(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from rowcast.operators.learners import fit, make_learner, score
    from rowcast.operators.metrics import weighted_f1

    emb = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), "label")
    want = MulticlassClassificationEvaluator(labelCol="label", metricName="f1").evaluate(
        LogisticRegression(labelCol="label", maxIter=10).fit(emb).transform(emb))
    got = weighted_f1(score(fit(make_learner("lr", "label"), emb), emb), "label").first()["f1"]
    assert 0.0 < got < 1.0 and got == pytest.approx(want, abs=1e-6)
