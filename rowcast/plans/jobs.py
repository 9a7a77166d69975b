"""The jobs: train and score, train and validate, score with a saved model.

Each job is a thin sequence of library calls over DataFrames; the
``*_job`` variants read and write files. Paths are parameters, a session is
passed in, and every result (metrics included) comes back as a DataFrame.

Command line: ``python -m rowcast.plans.jobs <score|train|validate|refit> ...``
(see ``USAGE``); the score job takes three positional paths and a wrong
count exits with -1.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from rowcast.functions.labels import (
    BINARY_LABEL,
    GRADE_COLUMN,
    GRADE_THRESHOLD,
    add_threshold_label,
)
from rowcast.functions.names import clean_name
from rowcast.functions.vectors import with_vector_text
from rowcast.operators.features import assemble
from rowcast.operators.frames import preview
from rowcast.operators.learners import fit, make_learner, score
from rowcast.operators.metrics import auc_roc, auc_roc_evaluator, weighted_f1
from rowcast.runtime import Layout, laid_out
from rowcast.sources.delimited import INPUT_SEPARATOR, paths_overlap, read_delimited, write_csv
from rowcast.sources.models import load_model, save_model
from rowcast.sources.publish import current, refuse_existing, staged
from rowcast.sources.quarantine import quarantine
from rowcast.sources.training_table import is_training_table, read_training_table, write_training_table

# Fixed values of the reference jobs: the measurement columns, in order.
FEATURES = [
    "fixed_acidity",
    "volatile_acidity",
    "citric_acid",
    "residual_sugar",
    "chlorides",
    "free_sulfur_dioxide",
    "total_sulfur_dioxide",
    "density",
    "pH",
    "sulphates",
    "alcohol",
]

# Where the refit job reads and writes when nothing is said.
DEFAULT_INPUT, DEFAULT_OUTPUT = "input.csv", "predictions"


def grade_schema(features: Sequence[str] = FEATURES, label_col: str = GRADE_COLUMN) -> StructType:
    """The jobs' known types: measurements are doubles, the grade an integer."""
    measures = [StructField(name, DoubleType()) for name in features]
    return StructType([*measures, StructField(label_col, IntegerType())])


def read_grades(
    spark: SparkSession,
    path: str,
    features: Sequence[str] = FEATURES,
    label_col: str = GRADE_COLUMN,
    label_required: bool = True,
    rejects_path: str | None = None,
    max_rejects: float | None = None,
) -> DataFrame:
    """The jobs' input: typed by its header, without an inference pass.

    Only the header line is read before the scan; a malformed value raises.
    With ``rejects_path`` malformed rows are written there instead
    (:func:`rowcast.sources.quarantine.quarantine`), and only a share of them
    above ``max_rejects`` raises. A training table is read in its layout.
    """
    if is_training_table(spark, path):
        return read_training_table(spark, path)
    schema = grade_schema(features, label_col)
    if not label_required:
        header = spark.read.option("header", True).option("sep", INPUT_SEPARATOR).csv(path).columns
        if label_col not in map(clean_name, header):
            schema = StructType(schema.fields[:-1])
    if rejects_path is not None:
        return quarantine(spark, path, schema, rejects_path, max_share=max_rejects).rows
    return read_delimited(spark, path, schema=schema)


@dataclass
class JobResult:
    model: Model
    predictions: DataFrame  # prediction, [label], features_str
    metrics: DataFrame | None  # one row, or None when no label is present
    cached: list[DataFrame] = field(default_factory=list)  # persisted, released by release()


def prepared(
    df: DataFrame,
    label_col: str | None,
    features: Sequence[str] = FEATURES,
    features_col: str = "features",
    layout: Layout | None = None,
) -> DataFrame:
    """Only the label and the assembled vector: the narrow input a learner needs.

    Columns are pruned first (the scan reads only these). Rows stay where they
    are, without a shuffle, unless a ``layout`` is asked for.
    """
    label = [label_col] if label_col else []
    narrow = laid_out(df.select(*dict.fromkeys([*features, *label])), layout)
    return assemble(narrow, features, features_col).select(features_col, *label)


def output_rows(
    scored: DataFrame,
    label_col: str | None,
    features_col: str = "features",
    with_features: bool = True,
) -> DataFrame:
    """``prediction``, the label if present, and the vector as text (the short
    form leaves the text out)."""
    cols = ["prediction"] + ([label_col] if label_col else [])
    if not with_features:
        return scored.select(*cols)
    return with_vector_text(scored, features_col).select(*cols, "features_str")


def fit_and_score(
    df: DataFrame,
    kind: str,
    label_col: str,
    features: Sequence[str] = FEATURES,
    metric: str = "f1",
    auc_num_bins: int | None = None,
    layout: Layout | None = None,
    **params,
) -> JobResult:
    """Fit on ``df`` and score the same rows (a train-set metric).

    ``metric`` is ``"f1"`` (weighted F1) or ``"auc"`` (area under ROC on
    the raw prediction; exact unless ``auc_num_bins`` asks for MLlib's
    binned curve, e.g. its default 1000). The assembled input is persisted
    for the fit and the scoring. For the AUC the scored rows (prediction,
    label, text, raw score) are persisted too, so the model is applied once.
    :func:`release` frees both; a failure frees them at once.
    """
    data = prepared(df, label_col, features, layout=layout).persist()
    held = [data]
    try:
        model = fit(make_learner(kind, label_col, **params), data)
        scored = score(model, data)
        if metric == "auc":
            raw = vector_to_array("rawPrediction")[1].alias("raw_score")
            kept = with_vector_text(scored).select("prediction", label_col, "features_str", raw).persist()
            held.append(kept)
            return JobResult(model, kept.drop("raw_score"), _area(kept, label_col, "raw_score", auc_num_bins), held)
        return JobResult(model, output_rows(scored, label_col), weighted_f1(scored, label_col), held)
    except BaseException:
        for frame in held:
            frame.unpersist()
        raise


def _area(scored: DataFrame, label_col: str, score_col: str, num_bins: int | None) -> DataFrame:
    if not num_bins:
        return auc_roc(scored, label_col, score_col)
    value = auc_roc_evaluator(scored, label_col, score_col, num_bins=num_bins)
    return scored.sparkSession.range(1).select(F.lit(value).alias("auc"))


def train_validate(
    train_df: DataFrame,
    valid_df: DataFrame,
    kind: str = "lr",
    label_col: str = GRADE_COLUMN,
    features: Sequence[str] = FEATURES,
    metric: str = "f1",
    layout: Layout | None = None,
    **params,
) -> JobResult:
    """Fit on one table, score another, and measure on the second: weighted F1,
    or with ``metric="auc"`` the area under ROC of a 0/1 label.

    The training input is persisted for the fit: MLlib reads it more than once
    before it caches its own copy.
    """
    train = prepared(train_df, label_col, features, layout=layout).persist()
    try:
        model = fit(make_learner(kind, label_col, **params), train)
    finally:
        train.unpersist()
    scored = score(model, prepared(valid_df, label_col, features))
    metrics = auc_roc(scored, label_col) if metric == "auc" else weighted_f1(scored, label_col)
    return JobResult(model, output_rows(scored, label_col), metrics)


def score_with(
    model: Model,
    df: DataFrame,
    label_col: str | None = GRADE_COLUMN,
    features: Sequence[str] | None = FEATURES,
    threshold: float | None = None,
    with_features: bool = True,
) -> JobResult:
    """Score with a fitted model; the label is optional.

    With ``threshold`` the label is first replaced by 0/1 (at or above it), as
    a model trained on 0/1 labels needs for its F1. A fitted pipeline
    assembles its own features, so ``features=None`` passes the rows through
    unchanged.
    """
    if label_col is not None and label_col not in df.columns:
        label_col = None
    if label_col is not None and threshold is not None:
        df = add_threshold_label(df, label_col, label_col, threshold)
    data = df if features is None else prepared(df, label_col, features)
    scored = score(model, data)
    metrics = weighted_f1(scored, label_col) if label_col else None
    return JobResult(model, output_rows(scored, label_col, with_features=with_features), metrics)


def release(result: JobResult) -> None:
    """Unpersist what a job cached."""
    while result.cached:
        result.cached.pop().unpersist()


# ---------------------------------------------------------------- file jobs


def train_and_score_job(
    spark: SparkSession,
    input_path: str,
    model_path: str,
    output_path: str,
    kind: str = "gbt",
    binary: bool | None = None,
    overwrite: bool = True,
    features: Sequence[str] = FEATURES,
    layout: Layout | None = None,
    rejects_path: str | None = None,
    max_rejects: float | None = None,
    commit: str = "switch",
    **params,
) -> JobResult:
    """Train on a file or training table, save the model, score the training
    rows, write CSV.

    With ``binary`` the grade becomes a new 0/1 ``binary_quality`` label and
    the metric is the area under ROC (exact; ``auc_num_bins=1000`` gives
    MLlib's default binned value instead); otherwise the raw grade is the
    label and the metric is weighted F1. By default GBT (binary labels only)
    gets the 0/1 label and the other learners the raw grade, as in the
    reference's two training jobs.

    With ``overwrite=False`` an existing model is refused before anything is
    read. The model and the output are written beside their places and
    published together at the end, so an output always belongs to the model
    that lies there, and a failing run changes neither.
    """
    refuse_overlap(spark, [input_path], [output_path, model_path])
    refuse_overlap(spark, [output_path], [model_path])
    if not overwrite:
        refuse_existing(spark, model_path)
    df = read_grades(spark, input_path, features, rejects_path=rejects_path, max_rejects=max_rejects)
    if binary is None:
        binary = kind == "gbt"
    if binary:
        df = add_threshold_label(df, GRADE_COLUMN, BINARY_LABEL, GRADE_THRESHOLD)
        label, metric = BINARY_LABEL, "auc"
    else:
        label, metric = GRADE_COLUMN, "f1"
    result = fit_and_score(df, kind, label, features, metric=metric, layout=layout, **params)
    try:
        with ExitStack() as places:
            write_csv(result.predictions, places.enter_context(staged(spark, output_path, commit)))
            save_model(result.model, places.enter_context(staged(spark, model_path, commit)))
            if not overwrite:  # another run may have been faster
                refuse_existing(spark, model_path)
        # F1 is read from two narrow columns of the written rows; the AUC's raw
        # score is not among them, it was measured from the persisted rows.
        return _read_back(spark, result, output_path, measure=metric == "f1")
    finally:
        release(result)


def prepare_training_job(
    spark: SparkSession,
    input_path: str,
    table_path: str,
    partitions: int | str,
    keys: Sequence[str] | None = None,
    features: Sequence[str] = FEATURES,
    label_col: str = GRADE_COLUMN,
    rejects_path: str | None = None,
    max_rejects: float | None = None,
    commit: str = "switch",
) -> None:
    """Parse a file once into a training table, which the training jobs take as
    their input: fits over it need no shuffle and are repeatable."""
    refuse_overlap(spark, [input_path], [table_path])
    df = read_grades(spark, input_path, features, label_col, rejects_path=rejects_path, max_rejects=max_rejects)
    narrow = df.select(*dict.fromkeys([*features, label_col]))
    write_training_table(narrow, table_path, Layout(int(partitions), keys), commit)


def refuse_overlap(spark: SparkSession, inputs: Sequence[str], outputs: Sequence[str]) -> None:
    """Raise before anything is read if writing an output would delete an input."""
    for a in inputs:
        for b in outputs:
            if paths_overlap(spark, a, b):
                raise ValueError(f"refusing to write {b!r}: it lies at {a!r}, in it or around it")


def train_validate_job(
    spark: SparkSession,
    train_path: str,
    valid_path: str,
    model_path: str,
    kind: str = "lr",
    features: Sequence[str] = FEATURES,
    layout: Layout | None = None,
    overwrite: bool = True,
    commit: str = "switch",
    **params,
) -> JobResult:
    """Train on one file, weighted F1 on another, save. With ``overwrite=False``
    an existing model is refused before anything is read."""
    refuse_overlap(spark, [train_path, valid_path], [model_path])
    if not overwrite:
        refuse_existing(spark, model_path)
    result = train_validate(
        read_grades(spark, train_path, features),
        read_grades(spark, valid_path, features),
        kind,
        features=features,
        layout=layout,
        **params,
    )
    save_model(result.model, model_path, overwrite, commit)
    return result


def score_job(
    spark: SparkSession,
    input_path: str,
    model_path: str,
    output_path: str,
    kind: str = "lr",
    features: Sequence[str] = FEATURES,
    binary: bool | None = None,
    with_features: bool = True,
    rejects_path: str | None = None,
    max_rejects: float | None = None,
    commit: str = "switch",
) -> JobResult:
    """Load a saved model through its class, score a file, write CSV.

    With ``binary`` (the default for GBT, which knows only 0/1 labels) the
    grade is replaced by its 0/1 label before it is compared and written.
    ``with_features=False`` writes the short form without the vector's text.
    The weighted F1 (when the input has a label) is read from the written
    output, not recomputed: one pass scores the input, and the metric reads
    two narrow columns of a durable result instead of re-parsing the input.
    """
    refuse_overlap(spark, [input_path, model_path], [output_path])
    model = load_model(model_path, kind)
    df = read_grades(
        spark, input_path, features, label_required=False, rejects_path=rejects_path, max_rejects=max_rejects
    )
    if binary is None:
        binary = kind == "gbt"
    result = score_with(
        model,
        df,
        features=None if kind == "pipeline" else features,
        threshold=GRADE_THRESHOLD if binary else None,
        with_features=with_features,
    )
    return _written(spark, result, output_path, commit)


def _written(spark: SparkSession, result: JobResult, output_path: str, commit: str) -> JobResult:
    """Write the rows, return them read back; F1 from what was written."""
    write_csv(result.predictions, output_path, commit=commit)
    return _read_back(spark, result, output_path)


def _read_back(spark: SparkSession, result: JobResult, output_path: str, measure: bool = True) -> JobResult:
    place = current(spark, output_path)
    written = spark.read.schema(result.predictions.schema).option("header", True).csv(place)
    result.predictions = written
    if measure and result.metrics is not None:
        label = [c for c in written.columns if c not in ("prediction", "features_str")][0]
        result.metrics = weighted_f1(written, label)
    return result


def refit_and_score_job(
    spark: SparkSession,
    input_path: str = DEFAULT_INPUT,
    output_path: str = DEFAULT_OUTPUT,
    kind: str = "gbt",
    maxIter: int = 10,
    features: Sequence[str] = FEATURES,
    layout: Layout | None = None,
    rejects_path: str | None = None,
    max_rejects: float | None = None,
    commit: str = "switch",
    **params,
) -> JobResult:
    """Replace the grade by its 0/1 label, fit GBT on the file, score it,
    weighted F1, write CSV. Named apart from :func:`score_job` because it
    never loads a model."""
    refuse_overlap(spark, [input_path], [output_path])
    rows = read_grades(spark, input_path, features, rejects_path=rejects_path, max_rejects=max_rejects)
    df = add_threshold_label(rows, GRADE_COLUMN, GRADE_COLUMN)
    result = fit_and_score(
        df, kind, GRADE_COLUMN, features, metric="f1", layout=layout, maxIter=maxIter, **params
    )
    try:
        return _written(spark, result, output_path, commit)
    finally:
        release(result)


def sample_rows(result: JobResult, n: int = 5) -> DataFrame:
    """The jobs' five-row preview, in a stated order."""
    return preview(result.predictions, n)


USAGE = """usage: python -m rowcast.plans.jobs <command> ...
  score    <input_csv> <model> <output_csv> [lr|rf|gbt|pipeline]   load a model, score, write
  train    <input> <model> <output_csv> [gbt|rf]                   fit (gbt: 0/1 label, rf: grade), score own rows, save
  validate <train> <valid_csv> <model>  [lr|rf]                    fit, F1 on the second file, save
  refit    [<input> <output_csv>]                                  GBT on the 0/1 grade, score, write
  prepare  <input_csv> <table> <partitions>                        training table, an <input> of train, validate, refit
options
  --keep-model          train, validate: refuse an existing model, before anything is read
  --manifest            publish by manifest (object stores) instead of by renames
  --rejects=<path>      score, train, refit, prepare: write malformed rows there instead of stopping
  --max-rejects=<share> with --rejects: stop above this share of malformed rows"""

# command -> (job, number of required paths, default kind or None)
COMMANDS = {
    "score": (score_job, 3, "lr"),
    "train": (train_and_score_job, 3, "gbt"),
    "validate": (train_validate_job, 3, "lr"),
    "refit": (refit_and_score_job, 2, None),
    "prepare": (prepare_training_job, 3, None),
}
# option -> (keyword of the job, its value from the text after "=", the commands that know it)
OPTIONS = {
    "--keep-model": ("overwrite", lambda _: False, ("train", "validate")),
    "--manifest": ("commit", lambda _: "manifest", tuple(COMMANDS)),
    "--rejects": ("rejects_path", str, ("score", "train", "refit", "prepare")),
    "--max-rejects": ("max_rejects", float, ("score", "train", "refit", "prepare")),
}


def _options(command: str, given: Sequence[str]) -> dict | None:
    """Keyword arguments of the ``--`` options; None if one does not fit."""
    chosen = {}
    for option in given:
        name, _, value = option.partition("=")
        keyword, parse, commands = OPTIONS.get(name, (None, None, ()))
        if command not in commands or bool(value) != name.endswith("rejects"):
            return None
        try:
            chosen[keyword] = parse(value)
        except ValueError:
            return None
    return chosen


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run one job; a wrong argument count prints the usage and returns -1."""
    args = list(sys.argv[1:] if argv is None else argv)
    options = _options(args[0], [a for a in args[1:] if a.startswith("--")]) if args else None
    if options is None or args[0] not in COMMANDS:
        print(USAGE, file=sys.stderr)
        return -1
    job, n_paths, kind = COMMANDS[args[0]]
    paths = [a for a in args[1:] if not a.startswith("--")]
    defaults = args[0] == "refit" and not paths
    if not (defaults or len(paths) == n_paths or (kind is not None and len(paths) == n_paths + 1)):
        print(USAGE, file=sys.stderr)
        return -1
    own = spark is None
    session = spark or SparkSession.builder.appName(f"rowcast-{args[0]}").getOrCreate()
    try:
        chosen = paths[n_paths:] or ([kind] if kind else [])
        result = job(session, *paths[:n_paths], *chosen, **options)
        if result is not None and result.metrics is not None:
            print(f"{result.metrics.columns[0]}: {result.metrics.first()[0]}")
    finally:
        if own:
            session.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
