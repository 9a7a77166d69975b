"""


The driver tables carry none of the reference's wine columns, so
``lineitem`` stands in: four measures ``l_quantity, l_extendedprice,
l_discount, l_tax`` are the features and ``l_linenumber`` (1..7) is the
grade. For the learners the label ``l_quantity >= 25`` is separable by the
features, so a correctly fitted model reproduces it exactly and the oracle
is the label itself (tests separately prove the model is really used). The
queries with the reference's own tree settings (100 trees, 100 iterations, all
else at its default) use four features that rise or fall with one value of 25
steps, so that every tree of a random forest can be exact. Metrics of a fitted
model are taken against another column than it learned, so their value is one
that SQL can give and is not 1.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.functions.labels import add_threshold_label
from rowcast.functions.names import clean_columns
from rowcast.functions.vectors import array_vector, vector_columns, with_vector_text
from rowcast.operators.features import PopulationScaler, assemble
from rowcast.operators.frames import drop_columns, preview, project
from rowcast.operators.learners import build_pipeline, fit, make_learner, score
from rowcast.operators.metrics import auc_roc, auc_roc_evaluator, weighted_f1
from rowcast.plans.jobs import (
    fit_and_score,
    output_rows,
    prepare_training_job,
    refit_and_score_job,
    release,
    score_job,
    train_and_score_job,
    train_validate,
    train_validate_job,
)
from rowcast.runtime import Layout, scratch_path
from rowcast.sources.delimited import read_delimited, write_csv
from rowcast.sources.models import load_model, save_model
from rowcast.sources.publish import current, place_of
from rowcast.sources.quarantine import quarantine
from rowcast.sources.training_table import read_training_table, write_training_table
from rowcast.streaming.score_stream import score_rows, write_stream

# The training-data operators are an optional subpackage with a pipeline file
# of their own; each is registered only if it can be imported.
llm_queries = corpus_pipeline = None
try:
    from rowcast.llm import queries as llm_queries
except ImportError:
    pass
else:
    try:
        import corpus_pipeline
    except ImportError:
        pass

SMOKE_DIR = "/root/testdata/sf0.001"

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
GRADE = "l_linenumber"
KEY = "l_orderkey"
PLAIN_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
# Separable stand-in label for the learners.
SEPARABLE_SOURCE, SEPARABLE_CUT = "l_quantity", 25
# Tree settings under which the separable label is learned exactly: the
# quantity has 50 values, so 64 bins give every value its own threshold.
GBT_PARAMS = {"maxIter": 10, "maxBins": 64}
LR_PARAMS = {"maxIter": 100}
# Features for the tree learners at the reference's settings: each is a
# strictly rising or falling function of a step of 0..24, and never zero.
STEP = "CAST(floor((l_quantity - 1) / 2) AS INT)"
STEP_FEATURES = {"rise one": f"{STEP} + 1", "rise two": f"3 * {STEP} + 1",
                 "rise three": f"({STEP} + 1) * ({STEP} + 1)", "fall one": f"100 - {STEP}"}
STEP_NAMES = [n.replace(" ", "_") for n in STEP_FEATURES]
STEP_GRADE = f"CAST(floor({STEP} / 5) AS INT) + 4"
# One feature on which three ordered classes lie far apart.
THIRD = "CASE WHEN l_quantity <= 16 THEN 0 WHEN l_quantity <= 33 THEN 1 ELSE 2 END"
THIRD_FEATURE = f"20 * ({THIRD}) + CAST(l_quantity AS INT) % 3 + 1"
# ``part`` as lines: every 7th has no number as its size, every 11th a value too
# many and every 13th one too few; the first of these that applies.
PART_KIND = "CASE WHEN p_partkey % 7 = 0 THEN 1 WHEN p_partkey % 11 = 0 THEN 2 WHEN p_partkey % 13 = 0 THEN 3 ELSE 0 END"
PART_LINE = (
    "CAST(p_partkey AS STRING) || ';' || p_name || ';' || CASE WHEN p_partkey % 7 = 0 THEN 'size ' ELSE '' END "
    "|| CAST(p_size AS STRING) || CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 13 = 0 THEN '' "
    "ELSE ';' || CAST(p_retailprice AS STRING) END "
    "|| CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 11 = 0 THEN ';more' ELSE '' END"
)
# Features that are mostly zero for some rows and never for others.
SPARSE_FEATURES = {
    "first": "CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_quantity AS INT) ELSE 0 END",
    "second": "CASE WHEN l_linenumber >= 4 THEN l_linenumber ELSE 0 END",
    "third": "0",
    "fourth": "CASE WHEN l_linenumber >= 6 THEN 7 ELSE 0 END",
    "fifth": "CASE WHEN l_linenumber >= 5 THEN 0 - l_linenumber ELSE 0 END",
}
# Time split for train / validate: the past trains, the future validates.
VALIDATION_START = "2000-01-01"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem")


def _separable(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lineitem(spark, sf_dir).select(KEY, *FEATURES)
    return add_threshold_label(li, SEPARABLE_SOURCE, "label", SEPARABLE_CUT)


def _graded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's output layout over lineitem: grade, 0/1 label, vector text."""
    li = _lineitem(spark, sf_dir).select(KEY, GRADE, *FEATURES)
    li = add_threshold_label(li, GRADE, "binary_quality")
    return with_vector_text(assemble(li, FEATURES)).select(
        KEY, F.col(GRADE).alias("quality"), "binary_quality", "features_str"
    )


def _past(past: bool):
    """The time split; a row without a ship date validates."""
    before = F.coalesce(F.col("l_shipdate") < F.lit(VALIDATION_START).cast("timestamp_ntz"), F.lit(False))
    return before if past else ~before


def _grade_csv(spark: SparkSession, rows: DataFrame, features: dict[str, str], grade: str) -> str:
    """The reference's input layout, derived from ``lineitem``: a ';' file
    whose header has spaces (``rise one``) and an integer ``quality`` grade
    last. Written under the shared scratch folder; returns its path."""
    path = scratch_path(spark, "wine-layout")
    columns = [F.expr(e).alias(n) for n, e in features.items()]
    write_csv(rows.select(*columns, F.expr(grade).alias("quality")), path, sep=";")
    return path


def _step_csv(spark: SparkSession, sf_dir: str) -> str:
    """Grade 4..8, rising with the step of 0..24: ``quality >= 6`` is ``step >= 10``."""
    return _grade_csv(spark, _lineitem(spark, sf_dir), STEP_FEATURES, STEP_GRADE)


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [F.expr(e).alias(n.replace(" ", "_")) for n, e in STEP_FEATURES.items()]
    rows = _lineitem(spark, sf_dir).select(KEY, *columns, F.expr(STEP).alias("step"))
    return add_threshold_label(rows, "step", "label", 12)


# ------------------------------------------------------------------ queries


def q_csv_scan_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` written as ';' CSV under spaced header names
    (``p partkey``), read back with header, inferred types and cleaned names."""
    part = _table(spark, sf_dir, "part")
    path = scratch_path(spark, "part-csv")
    write_csv(part.toDF(*[c.replace("_", " ") for c in part.columns]), path, sep=";")
    return read_delimited(spark, path)


def q_clean_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers with spaces, quotes and a trailing tab clean back to plain names."""
    li = _lineitem(spark, sf_dir).select(*PLAIN_COLUMNS)
    dirty = []
    for i, c in enumerate(PLAIN_COLUMNS):
        spaced = c.replace("_", " ")
        dirty.append([f'"{spaced}"', f'"""{spaced}"""', f"{c}\t", f'""""{spaced}""""'][i % 4])
    return clean_columns(li.toDF(*dirty))


def q_label_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grade >= 6 as a new 0/1 column."""
    li = _lineitem(spark, sf_dir).select(KEY, GRADE)
    return add_threshold_label(li, GRADE, "binary_quality")


def q_label_inplace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grade replaced by its 0/1 label."""
    li = _lineitem(spark, sf_dir).select(KEY, GRADE)
    return add_threshold_label(li, GRADE, GRADE)


def q_label_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NULL grade is labelled 0."""
    li = _lineitem(spark, sf_dir).select(KEY, F.nullif(F.col(GRADE), F.lit(7)).alias("grade"))
    return add_threshold_label(li, "grade", "binary_quality")


def q_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrow select before a fit."""
    return project(_lineitem(spark, sf_dir), [KEY, GRADE, *FEATURES])


def q_drop_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector dropped after use."""
    li = _lineitem(spark, sf_dir).select(KEY, GRADE, *FEATURES)
    return drop_columns(assemble(li, FEATURES), "features")


def q_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the assembled vector, expanded back to one column per slot."""
    li = _lineitem(spark, sf_dir).select(KEY, *FEATURES)
    return assemble(li, FEATURES).select(KEY, *vector_columns("features", FEATURES))


def q_features_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector rendered as text."""
    li = _lineitem(spark, sf_dir).select(KEY, *FEATURES)
    return with_vector_text(assemble(li, FEATURES)).select(KEY, "features_str")


def q_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output rows written as CSV (overwrite) and read back."""
    rows = _graded_rows(spark, sf_dir)
    path = scratch_path(spark, "rows-csv")
    write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: five output rows in the order of all columns."""
    return preview(_graded_rows(spark, sf_dir).drop(KEY), 5)


def q_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """centred and divided by the population std.

    Rounded to 6 decimals: the fit is one pass of plain double sums, whose
    last bit depends on summation order (Spark's mean of the price at sf0.01
    is 1 ulp from the exact one, DuckDB's is exact), and at 9 decimals that
    flipped one of 240,000 rounded values.
    """
    li = _lineitem(spark, sf_dir).select(KEY, *FEATURES)
    out = [f"{c}_scaled" for c in FEATURES]
    model = PopulationScaler(inputCols=FEATURES, outputCols=out).fit(li)
    return model.transform(li).select(KEY, *[F.round(c, 6).alias(c) for c in out])


def q_weighted_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: weighted F1 of a fixed rule against the grade."""
    li = _lineitem(spark, sf_dir).select(GRADE, (F.col("l_quantity") % 8).alias("prediction"))
    return weighted_f1(li, GRADE).select(F.round("f1", 9).alias("f1"))


def q_auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: exact area under ROC of the price as a score for returned items."""
    li = _lineitem(spark, sf_dir).select(
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        F.col("l_extendedprice").alias("score"),
    )
    return auc_roc(li, "returned", "score").select(F.round("auc", 9).alias("auc"))


def _fit_score(spark: SparkSession, sf_dir: str, kind: str, params: dict) -> DataFrame:
    data = assemble(_separable(spark, sf_dir), FEATURES)
    model = fit(make_learner(kind, "label", **params), data)
    return output_rows(score(model, data), "label")


def q_lr_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression fitted and applied."""
    return _fit_score(spark, sf_dir, "lr", LR_PARAMS)


def _fit_score_steps(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    data = assemble(_steps(spark, sf_dir), STEP_NAMES)
    model = fit(make_learner(kind, "label"), data)
    return score(model, data).select(KEY, "prediction", "label")


def q_rf100_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest of 100 trees, every other parameter at its default."""
    return _fit_score_steps(spark, sf_dir, "rf")


def q_gbt100_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gradient-boosted trees, 100 iterations, all else at its default."""
    return _fit_score_steps(spark, sf_dir, "gbt")


def q_lr_multinomial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multinomial logistic regression (maxIter=10) on three classes."""
    rows = _lineitem(spark, sf_dir).select(
        KEY, F.expr(THIRD_FEATURE).alias("x"), F.expr(THIRD).alias("label")
    )
    data = assemble(rows, ["x"])
    model = fit(make_learner("lr", "label"), data)
    return score(model, data).select(KEY, "prediction", "label")


def q_gbt_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gradient-boosted trees fitted and applied."""
    return _fit_score(spark, sf_dir, "gbt", GBT_PARAMS)


def q_save_load_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save (refusing to overwrite), load through the typed class,
    score rows that carry no label."""
    data = assemble(_separable(spark, sf_dir), FEATURES)
    model = fit(make_learner("lr", "label", **LR_PARAMS), data)
    path = scratch_path(spark, "lr-model")
    save_model(model, path, overwrite=False)
    loaded = load_model(path, "lr")
    return output_rows(score(loaded, data.drop("label")), None)


def q_scaled_rf_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaler, assembler and forest fitted as one unit, saved,
    reloaded and applied to rows without a label."""
    data = _steps(spark, sf_dir)
    model = fit(build_pipeline(STEP_NAMES, "label", kind="rf", scale=True), data)
    path = scratch_path(spark, "scaled-rf")
    save_model(model, path)
    loaded = load_model(path, "pipeline")
    return score(loaded, data.drop("label")).select(KEY, "prediction")


def q_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 over a stream: the lineitem file read as a file stream, scored by a
    fitted model in micro-batches, appended to parquet and read back."""
    li = _separable(spark, sf_dir)
    model = fit(make_learner("gbt", "label", **GBT_PARAMS), assemble(li, FEATURES))
    stream = (
        spark.readStream.schema(_lineitem(spark, sf_dir).schema)
        .option("pathGlobFilter", "lineitem.parquet")
        .parquet(sf_dir)
    )
    rows = add_threshold_label(stream.select(KEY, *FEATURES), SEPARABLE_SOURCE, "label", SEPARABLE_CUT)
    out = scratch_path(spark, "stream-scored")
    query = write_stream(score_rows(rows, model, "label", FEATURES), out,
                         scratch_path(spark, "stream-ckpt"), fmt="parquet")
    query.awaitTermination()
    return spark.read.parquet(out)


def q_train_validate_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1/A1: multinomial LR (maxIter=10) on three classes, trained on the
    past; weighted F1 on the future, against a third of the line numbers."""
    li = _lineitem(spark, sf_dir)
    x = F.expr(THIRD_FEATURE).alias("x")
    result = train_validate(
        li.where(_past(True)).select(x, F.expr(THIRD).alias("class")),
        li.where(_past(False)).select(x, (F.col(GRADE) % 3).alias("class")),
        "lr", "class", ["x"],
    )
    return result.metrics.select(F.round("f1", 9).alias("f1"))


def q_train_self_score_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3/A2: GBT (100 iterations) on whether a line was returned, from one
    0/1 feature; area under ROC on its own rows (the reference's training
    job). The scores of the feature's two values rank the rows."""
    li = _lineitem(spark, sf_dir).select(
        (F.col(SEPARABLE_SOURCE) >= SEPARABLE_CUT).cast("int").alias("many"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
    )
    result = fit_and_score(li, "gbt", "returned", ["many"], metric="auc")
    release(result)  # the exact AUC is computed eagerly; the cached rows are done
    return result.metrics.select(F.round("auc", 9).alias("auc"))


def q_embeddings_lr_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1/L6/A1 on a ready vector: LR (maxIter=10) over 64 values learns the
    sign of the first embedding value, given with the 63 others in small;
    weighted F1 of its prediction against the parity of the row's label."""
    value = F.col("embedding")
    sign = F.when(value[0] >= 0, 1.0).otherwise(-1.0)
    rest = F.transform(F.slice(value, 2, 63), lambda v: v.cast("double") * 0.001)
    emb = _table(spark, sf_dir, "embeddings").select(
        F.concat(F.array(sign), rest).alias("values"),
        (value[0] >= 0).cast("int").alias("positive"),
        (F.col("label") % 2).alias("parity"),
    ).select(array_vector("values").alias("features"), "positive", "parity")
    model = fit(make_learner("lr", "positive"), emb)
    return weighted_f1(score(model, emb), "parity").select(F.round("f1", 9).alias("f1"))


def q_job_train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3/J4 with S1, P1, P2, F1, L3, L6, A2, P8, S4, S5: the training job on a
    ';' file. Names cleaned, 0/1 label added beside the grade, GBT (100
    iterations) fitted, AUC on its own rows, rows written as CSV, then the
    model saved refusing to overwrite. Returns the written rows, read back."""
    result = train_and_score_job(
        spark, _step_csv(spark, sf_dir), scratch_path(spark, "gbt-model"),
        scratch_path(spark, "gbt-rows"), kind="gbt", overwrite=False, features=STEP_NAMES,
    )
    return result.predictions


def q_job_train_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3/J4 with L2: the forest training job (100 trees) on the raw grade,
    weighted F1 on its own rows. Returns the written rows, read back."""
    result = train_and_score_job(
        spark, _step_csv(spark, sf_dir), scratch_path(spark, "rf-model"),
        scratch_path(spark, "rf-rows"), kind="rf", features=STEP_NAMES,
    )
    return result.predictions


def q_job_score_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 with S7, L6, A1: the forest saved by the training job, loaded
    through its class by the score job, applied to the file, rows written
    and weighted F1 measured from them. Returns the written rows."""
    csv = _step_csv(spark, sf_dir)
    model = scratch_path(spark, "rf-model")
    train_and_score_job(spark, csv, model, scratch_path(spark, "rf-rows"), kind="rf", features=STEP_NAMES)
    return score_job(spark, csv, model, scratch_path(spark, "scored"), kind="rf", features=STEP_NAMES).predictions


def q_job_score_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 with P3: a saved GBT applied by the score job. The grade becomes the
    0/1 label the model knows; rows in the short form with the measured F1."""
    csv = _step_csv(spark, sf_dir)
    model = scratch_path(spark, "gbt-model")
    train_and_score_job(spark, csv, model, scratch_path(spark, "gbt-rows"), kind="gbt",
                        features=STEP_NAMES, maxIter=10)
    result = score_job(spark, csv, model, scratch_path(spark, "scored"), kind="gbt",
                       features=STEP_NAMES, with_features=False)
    return result.predictions.withColumn("f1", F.lit(result.metrics.first()["f1"]))


def q_job_refit_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 with P3, L4: the refit job. The grade is replaced in place by its
    0/1 label, GBT (maxIter=10) fitted on the file and applied to it,
    weighted F1, rows written. Returns the written rows."""
    result = refit_and_score_job(
        spark, _step_csv(spark, sf_dir), scratch_path(spark, "refit-rows"), features=STEP_NAMES,
    )
    return result.predictions


def q_job_validate_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 with L1, A1, S6: the validation job. Two ';' files (ship dates
    before 2000 train, the rest validate), multinomial LR (maxIter=10) on
    three classes, weighted F1 on the second file, whose grade is a third of
    the line numbers, model saved with overwrite."""
    li = _lineitem(spark, sf_dir)
    feature = {"one value": THIRD_FEATURE}
    result = train_validate_job(
        spark,
        _grade_csv(spark, li.where(_past(True)), feature, THIRD),
        _grade_csv(spark, li.where(_past(False)), feature, "l_linenumber % 3"),
        scratch_path(spark, "lr-model"), kind="lr", features=["one_value"],
    )
    return result.metrics.select(F.round("f1", 9).alias("f1"))


def q_csv_scan_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 with a schema: ``part`` written as ';' CSV with its columns reversed,
    read by name with given types, without an inference pass."""
    part = _table(spark, sf_dir, "part")
    path = scratch_path(spark, "part-csv")
    write_csv(part.select(*reversed(part.columns)), path, sep=";")
    return read_delimited(spark, path, schema=part.schema).select(*part.columns)


def _broken(rows: DataFrame) -> DataFrame:
    """``rows`` whose tasks fail where a line has number 7, after many others."""
    return rows.withColumn("quality", F.expr(
        "CASE WHEN quality = 7 THEN CAST(raise_error('planted failure') AS INT) ELSE -quality END"))


def _fails(action: Callable[[], None], error: str) -> None:
    """Runs an action that must fail with ``error``."""
    try:
        action()
    except Exception as raised:
        if error not in str(raised):
            raise
    else:
        raise AssertionError(f"no failure with {error!r}")


def q_csv_sink_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An overwrite whose tasks fail leaves the output before it readable."""
    rows = _graded_rows(spark, sf_dir)
    path = scratch_path(spark, "rows-csv")
    write_csv(rows, path)
    _fails(lambda: write_csv(_broken(rows), path), "planted failure")
    return spark.read.schema(rows.schema).option("header", True).csv(path)


def q_csv_sink_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 for object stores: versions published by manifest. The second one is
    current, and a third whose tasks fail changes nothing."""
    rows = _graded_rows(spark, sf_dir)
    path = scratch_path(spark, "rows-csv")
    write_csv(rows.where("quality = 1"), path, commit="manifest")
    write_csv(rows, path, commit="manifest")
    _fails(lambda: write_csv(_broken(rows), path, commit="manifest"), "planted failure")
    return spark.read.schema(rows.schema).option("header", True).csv(current(spark, path))


def q_job_train_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 in the training job: a second run, on other grades, that may not
    replace the model is refused before it reads, fits or writes. Returns the
    output of the first run, which still belongs to the model that lies there,
    with that model's own predictions for it."""
    csv = _step_csv(spark, sf_dir)
    model, out = scratch_path(spark, "rf-model"), scratch_path(spark, "rf-rows")
    first = train_and_score_job(spark, csv, model, out, kind="rf", features=STEP_NAMES)
    other = _grade_csv(spark, _lineitem(spark, sf_dir), STEP_FEATURES, GRADE)
    _fails(lambda: train_and_score_job(spark, other, model, out, kind="rf", overwrite=False, features=STEP_NAMES),
           "already exists")
    again = score_job(spark, csv, model, scratch_path(spark, "scored"), kind="rf", features=STEP_NAMES)
    kept = spark.read.schema(first.predictions.schema).option("header", True).csv(out)
    pairs = again.predictions.groupBy("features_str").agg(F.min("prediction").alias("model_prediction"))
    return kept.join(pairs, "features_str").select(*kept.columns, "model_prediction")


def q_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 with malformed rows: ``part`` as ';' lines of which some have a size
    that is no number, some a value too many and some one too few. They are
    parsed once; good rows come back typed, malformed ones as their lines."""
    part = _table(spark, sf_dir, "part")
    path = scratch_path(spark, "part-lines")
    part.select(F.expr(PART_LINE).alias("line")).write.text(path)
    fields = "p_partkey LONG, p_name STRING, p_size INT, p_retailprice DOUBLE"
    found = quarantine(spark, path, fields, scratch_path(spark, "part-checked"), header=False)
    total = found.counts.agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")).first()
    good = found.rows.withColumn("line", F.lit(None).cast("string"))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in found.rows.schema.fields]
    bad = found.rejects.select(*none, F.col("rejected_line").alias("line"))
    return good.unionByName(bad).select(
        "*", F.lit(total["accepted"]).alias("n_accepted"), F.lit(total["rejected"]).alias("n_rejected"))


def q_csv_scan_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` written and read by full URIs, scheme and all, in two folders
    scanned together, as inputs in an object store are named."""
    part = _table(spark, sf_dir, "part")
    paths = []
    for odd in (0, 1):
        fs, place = place_of(spark, scratch_path(spark, "part-uri"))
        paths.append(fs.makeQualified(place).toString())
        write_csv(part.where(F.col("p_partkey") % 2 == odd), paths[-1], sep=";")
    return read_delimited(spark, paths, schema=part.schema)


def q_csv_quoted_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` under a header whose names stand in doubled quotes, as in
    the reference's input (``\"\"\"p partkey\"\"\"``), inferred and cleaned."""
    part = _table(spark, sf_dir, "part")
    path = scratch_path(spark, "part-quoted")
    quoted = part.toDF(*[f'"{c.replace("_", " ")}"' for c in part.columns])
    quoted.write.option("header", True).option("sep", ";").option("escape", '"').csv(path)
    return read_delimited(spark, path)


def q_features_text_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with many zeros rendered as text; the assembler keeps those
    as ``(size,[indices],[values])`` and the others as ``[values]``."""
    rows = _lineitem(spark, sf_dir).select(KEY, GRADE, *[F.expr(e).alias(n) for n, e in SPARSE_FEATURES.items()])
    return with_vector_text(assemble(rows, list(SPARSE_FEATURES))).select(KEY, GRADE, "features_str")


def q_auc_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 as the evaluator bins it: the quantity's 50 values as scores, down-sampled
    to ten points of the curve. Equal rows are summed first and lie in one
    partition, as MLlib groups neighbouring scores partition by partition."""
    counted = _lineitem(spark, sf_dir).select(
        (F.col("l_returnflag") == "R").cast("double").alias("returned"), F.col("l_quantity").cast("double").alias("score"),
    ).groupBy("returned", "score").agg(F.count(F.lit(1)).cast("double").alias("n")).coalesce(1)
    value = auc_roc_evaluator(counted, "returned", "score", num_bins=10, weight_col="n")
    return spark.range(1).select(F.round(F.lit(value), 9).alias("auc"))


def q_lr_empty_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: grades 3 to 8 as they are, so that classes 0 to 2 of the nine are
    empty; multinomial LR (maxIter=10) on one indicator per grade."""
    grade = f"3 + {GRADE} % 6"
    indicators = [F.expr(f"CAST({grade} = {g} AS INT) * 5 + 1").alias(f"is_{g}") for g in range(3, 9)]
    rows = _lineitem(spark, sf_dir).select(KEY, *indicators, F.expr(grade).alias("quality"))
    data = assemble(rows, [f"is_{g}" for g in range(3, 9)])
    model = fit(make_learner("lr", "quality"), data)
    return score(model, data).select(KEY, "quality", "prediction", F.lit(model.numClasses).alias("n_classes"))


def q_training_table_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 over a training table: rows bucketed and sorted once, two forests (100
    trees) fitted from them without a shuffle. Their predictions agree, as do
    their trees."""
    path = scratch_path(spark, "training-table")
    write_training_table(_steps(spark, sf_dir), path, Layout(4, [KEY]))
    data = assemble(read_training_table(spark, path), STEP_NAMES)
    models = [fit(make_learner("rf", "label"), data) for _ in range(2)]
    trees = {m.toDebugString.split("\n", 1)[1] for m in models}
    scored = score(models[1], data)
    return scored.select(KEY, "prediction", "label", F.lit(len(trees)).alias("distinct_forests"))


def q_job_train_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 over a training table: the file parsed once by the preparing job, then
    taken by the GBT training job (10 iterations) as its input."""
    table = scratch_path(spark, "wine-table")
    prepare_training_job(spark, _step_csv(spark, sf_dir), table, 4, features=STEP_NAMES)
    return train_and_score_job(spark, table, scratch_path(spark, "gbt-model"), scratch_path(spark, "gbt-rows"),
                               kind="gbt", features=STEP_NAMES, maxIter=10).predictions


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """
    training-data operators if they are installed."""
    named = {
        "csv_scan_infer": q_csv_scan_infer,
        "csv_scan_schema": q_csv_scan_schema,
        "clean_columns": q_clean_columns,
        "label_new": q_label_new,
        "label_inplace": q_label_inplace,
        "label_null": q_label_null,
        "project": q_project,
        "drop_column": q_drop_column,
        "assemble": q_assemble,
        "features_text": q_features_text,
        "csv_sink": q_csv_sink,
        "preview": q_preview,
        "scale": q_scale,
        "weighted_f1": q_weighted_f1,
        "auc_roc": q_auc_roc,
        "lr_fit_score": q_lr_fit_score,
        "lr_multinomial": q_lr_multinomial,
        "rf100_fit_score": q_rf100_fit_score,
        "gbt_fit_score": q_gbt_fit_score,
        "gbt100_fit_score": q_gbt100_fit_score,
        "save_load_score": q_save_load_score,
        "scaled_rf_roundtrip": q_scaled_rf_roundtrip,
        "stream_score": q_stream_score,
        "train_validate_f1": q_train_validate_f1,
        "train_self_score_auc": q_train_self_score_auc,
        "embeddings_lr_f1": q_embeddings_lr_f1,
        "job_train_gbt": q_job_train_gbt,
        "job_train_rf": q_job_train_rf,
        "job_score_saved": q_job_score_saved,
        "job_score_gbt": q_job_score_gbt,
        "job_refit_gbt": q_job_refit_gbt,
        "job_validate_lr": q_job_validate_lr,
        "csv_sink_failure": q_csv_sink_failure,
        "csv_sink_manifest": q_csv_sink_manifest,
        "csv_rejects": q_csv_rejects,
        "csv_scan_uri": q_csv_scan_uri,
        "csv_quoted_header": q_csv_quoted_header,
        "features_text_sparse": q_features_text_sparse,
        "auc_binned": q_auc_binned,
        "lr_empty_classes": q_lr_empty_classes,
        "training_table_rf": q_training_table_rf,
        "job_train_refused": q_job_train_refused,
        "job_train_table": q_job_train_table,
    }
    if llm_queries is not None:
        named.update(llm_queries.queries())
    if corpus_pipeline is not None:
        named["pipeline"] = corpus_pipeline.run
    return named


def entry(spark: SparkSession) -> DataFrame:
    """Flagship on sf0.001: grade label, assembled features, logistic
    regression fitted on the past, weighted F1 on the future."""
    return q_train_validate_f1(spark, SMOKE_DIR)


# ------------------------------------------------------------------ oracles

_FEATURE_TEXT = (
    "'[' || CAST(l_quantity AS VARCHAR) || ',' || CAST(l_extendedprice AS VARCHAR) || ','"
    " || CAST(l_discount AS VARCHAR) || ',' || CAST(l_tax AS VARCHAR) || ']'"
)
_SEPARABLE_PREDICTION = "CAST(CASE WHEN l_quantity >= 25 THEN 1.0 ELSE 0.0 END AS DOUBLE)"
_SEPARABLE_LABEL = "CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END"
_GRADED_ROWS = f"""
    SELECT l_orderkey, l_linenumber AS quality,
           CASE WHEN l_linenumber >= 6 THEN 1 ELSE 0 END AS binary_quality,
           {_FEATURE_TEXT} AS features_str
    FROM lineitem"""
_STEP_TEXT = " || ',' || ".join(f"CAST(CAST({e} AS DOUBLE) AS VARCHAR)" for e in STEP_FEATURES.values())
_STEP_ROWS = f"""
    SELECT CAST({{0}} AS DOUBLE) AS prediction, {{0}} AS {{1}}, '[' || {_STEP_TEXT} || ']' AS features_str
    FROM lineitem"""
_STEP_SCORE = f"""
    SELECT l_orderkey, CAST(CASE WHEN {STEP} >= 12 THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
           CASE WHEN {STEP} >= 12 THEN 1 ELSE 0 END AS label
    FROM lineitem"""
_STEP_LABEL = f"CASE WHEN {STEP_GRADE} >= 6 THEN 1 ELSE 0 END"


_SPARSE_LIST = ", ".join(f"CAST({e} AS DOUBLE)" for e in SPARSE_FEATURES.values())
# The assembler keeps a vector sparse where that takes no more room: 12 bytes a
# non-zero entry and 20 besides, against 8 bytes an entry.
_SPARSE_TEXT = f"""
    WITH v AS (SELECT l_orderkey, l_linenumber, [{_SPARSE_LIST}] AS v FROM lineitem),
         t AS (SELECT *, list_filter(range(0, len(v)), lambda i: v[i + 1] <> 0) AS nz FROM v)
    SELECT l_orderkey, l_linenumber, CASE
        WHEN 12 * len(nz) + 20 <= 8 * len(v)
        THEN '(' || len(v) || ',[' || array_to_string(nz, ',') || '],['
             || array_to_string(list_transform(nz, lambda i: CAST(v[i + 1] AS VARCHAR)), ',') || '])'
        ELSE '[' || array_to_string(list_transform(v, lambda x: CAST(x AS VARCHAR)), ',') || ']' END AS features_str
    FROM t"""


def _f1_sql(rows: str) -> str:
    """Weighted F1 of ``p`` against ``y`` in ``rows``, rounded."""
    return f"""
        WITH t AS ({rows}),
             l AS (SELECT y AS k, count(*) AS n, count(*) FILTER (WHERE y = p) AS tp FROM t GROUP BY 1),
             q AS (SELECT p AS k, count(*) AS n FROM t GROUP BY 1)
        SELECT ROUND(sum(l.n * (2.0::DOUBLE * tp / (l.n + coalesce(q.n, 0)))) / sum(l.n), 9) AS f1
        FROM l LEFT JOIN q USING (k)"""


_VALIDATE_F1 = _f1_sql(
    f"SELECT l_linenumber % 3 AS y, {THIRD} AS p FROM lineitem "
    f"WHERE l_shipdate IS NULL OR l_shipdate >= TIMESTAMP '{VALIDATION_START}'"
)
_FIT_SCORE = f"""
    SELECT {_SEPARABLE_PREDICTION} AS prediction, {_SEPARABLE_LABEL} AS label,
           {_FEATURE_TEXT} AS features_str
    FROM lineitem"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each query that SQL can express."""
    plain = ", ".join(PLAIN_COLUMNS)
    scaled = ", ".join(
        f"ROUND(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}_scaled"
        for c in FEATURES
    )
    named = {
        "csv_scan_infer": """
            SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type,
                   p_size, p_retailprice
            FROM part""",
        "clean_columns": f"SELECT {plain} FROM lineitem",
        "label_new": """
            SELECT l_orderkey, l_linenumber,
                   CASE WHEN l_linenumber >= 6 THEN 1 ELSE 0 END AS binary_quality
            FROM lineitem""",
        "label_inplace": """
            SELECT l_orderkey, CASE WHEN l_linenumber >= 6 THEN 1 ELSE 0 END AS l_linenumber
            FROM lineitem""",
        "label_null": """
            SELECT l_orderkey, NULLIF(l_linenumber, 7) AS grade,
                   CASE WHEN NULLIF(l_linenumber, 7) >= 6 THEN 1 ELSE 0 END AS binary_quality
            FROM lineitem""",
        "project": """
            SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
            FROM lineitem""",
        "drop_column": """
            SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
            FROM lineitem""",
        "assemble": """
            SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax
            FROM lineitem""",
        "features_text": f"SELECT l_orderkey, {_FEATURE_TEXT} AS features_str FROM lineitem",
        "csv_sink": _GRADED_ROWS,
        "preview": f"""
            SELECT quality, binary_quality, features_str FROM ({_GRADED_ROWS}) r
            ORDER BY quality, binary_quality, features_str
            LIMIT 5""",
        "scale": f"SELECT l_orderkey, {scaled} FROM lineitem",
        "weighted_f1": _f1_sql(
            "SELECT CAST(l_linenumber AS DOUBLE) AS y, l_quantity % 8 AS p FROM lineitem"),
        "auc_roc": """
            WITH t AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
                              l_extendedprice AS s
                       FROM lineitem),
                 r AS (SELECT y, rank() OVER (ORDER BY s)
                                 + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk
                       FROM t)
            SELECT ROUND(CAST(sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2.0
                              AS DOUBLE)
                         / (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y))), 9) AS auc
            FROM r""",
        "lr_fit_score": _FIT_SCORE,
        "lr_multinomial": f"""
            SELECT l_orderkey, CAST({THIRD} AS DOUBLE) AS prediction, {THIRD} AS label FROM lineitem""",
        "rf100_fit_score": _STEP_SCORE,
        "gbt100_fit_score": _STEP_SCORE,
        "gbt_fit_score": _FIT_SCORE,
        "save_load_score": f"""
            SELECT {_SEPARABLE_PREDICTION} AS prediction, {_FEATURE_TEXT} AS features_str
            FROM lineitem""",
        "scaled_rf_roundtrip": f"SELECT l_orderkey, prediction FROM ({_STEP_SCORE}) r",
        "stream_score": _FIT_SCORE,
        "train_validate_f1": _VALIDATE_F1,
        "job_validate_lr": _VALIDATE_F1,
        "train_self_score_auc": f"""
            WITH t AS (SELECT l_returnflag = 'R' AS y, l_quantity >= {SEPARABLE_CUT} AS g FROM lineitem)
            SELECT ROUND(0.5 + abs(CAST(count(*) FILTER (WHERE y AND g) AS DOUBLE) / count(*) FILTER (WHERE y)
                         - CAST(count(*) FILTER (WHERE NOT y AND g) AS DOUBLE) / count(*) FILTER (WHERE NOT y)) / 2,
                         9) AS auc
            FROM t""",
        "embeddings_lr_f1": _f1_sql(
            "SELECT label % 2 AS y, CASE WHEN embedding[1] >= 0 THEN 1 ELSE 0 END AS p FROM embeddings"),
        "job_train_gbt": _STEP_ROWS.format(_STEP_LABEL, "binary_quality"),
        "job_train_rf": _STEP_ROWS.format(STEP_GRADE, "quality"),
        "job_score_saved": _STEP_ROWS.format(STEP_GRADE, "quality"),
        "job_score_gbt": f"""
            SELECT CAST({_STEP_LABEL} AS DOUBLE) AS prediction, {_STEP_LABEL} AS quality,
                   CAST(1 AS DOUBLE) AS f1
            FROM lineitem""",
        "job_refit_gbt": _STEP_ROWS.format(_STEP_LABEL, "quality"),
        "csv_scan_schema": "SELECT * FROM part",
        "csv_scan_uri": "SELECT * FROM part",
        "csv_sink_failure": _GRADED_ROWS,
        "csv_sink_manifest": _GRADED_ROWS,
        "csv_rejects": f"""
            WITH p AS (SELECT *, {PART_KIND} AS kind, {PART_LINE.replace("STRING", "VARCHAR")} AS l FROM part)
            SELECT CASE WHEN kind = 0 THEN p_partkey END AS p_partkey, CASE WHEN kind = 0 THEN p_name END AS p_name,
                   CASE WHEN kind = 0 THEN p_size END AS p_size, CASE WHEN kind = 0 THEN p_retailprice END AS p_retailprice,
                   CASE WHEN kind > 0 THEN l END AS line, count(*) FILTER (WHERE kind = 0) OVER () AS n_accepted,
                   count(*) FILTER (WHERE kind > 0) OVER () AS n_rejected
            FROM p""",
        "csv_quoted_header": """
            SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part""",
        "features_text_sparse": _SPARSE_TEXT,
        "auc_binned": f"""
            WITH c AS (SELECT l_quantity AS s, count(*) FILTER (WHERE l_returnflag = 'R') AS p,
                              count(*) FILTER (WHERE l_returnflag <> 'R') AS n FROM lineitem GROUP BY 1),
                 g AS (SELECT p, n, (row_number() OVER (ORDER BY s DESC) - 1) // ((SELECT count(*) FROM c) // 10) AS g FROM c),
                 b AS (SELECT g, sum(p) AS p, sum(n) AS n FROM g GROUP BY g),
                 k AS (SELECT sum(p) OVER w AS tp, sum(n) OVER w AS fp, p, n FROM b WINDOW w AS (ORDER BY g))
            SELECT ROUND(CAST(sum(n * (tp + tp - p)) AS DOUBLE) / 2 / max(tp) / max(fp), 9) AS auc FROM k""",
        "lr_empty_classes": f"""
            SELECT l_orderkey, 3 + {GRADE} % 6 AS quality, CAST(3 + {GRADE} % 6 AS DOUBLE) AS prediction, 9 AS n_classes
            FROM lineitem""",
        "training_table_rf": f"SELECT r.*, 1 AS distinct_forests FROM ({_STEP_SCORE}) r",
        "job_train_refused": f"""
            SELECT r.*, r.prediction AS model_prediction FROM ({_STEP_ROWS.format(STEP_GRADE, "quality")}) r""",
        "job_train_table": _STEP_ROWS.format(_STEP_LABEL, "binary_quality"),
    }
    if llm_queries is not None:
        named.update(llm_queries.oracle_sql())
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL is not None:
        named["pipeline"] = corpus_pipeline.ORACLE_SQL
    return named
