"""The score job over a folder of arriving delimited files.

Same computation as :func:`rowcast.plans.jobs.score_job`, run incrementally:
each micro-batch of new files is cleaned, assembled, scored and appended to
a CSV folder. Scoring is a per-row projection, so the query holds no state;
its progress (which files are done) is kept in a checkpoint folder that
belongs to the output folder, so a restarted query resumes where it stopped:
no file is scored twice and none is left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rowcast.functions.names import clean_columns
from rowcast.plans.jobs import FEATURES, output_rows
from rowcast.operators.features import assemble
from rowcast.sources.delimited import INPUT_SEPARATOR


def scored_stream(
    spark: SparkSession,
    input_dir: str,
    schema: StructType | str,
    model: Model,
    label_col: str | None = None,
    features: Sequence[str] | None = FEATURES,
    sep: str = INPUT_SEPARATOR,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming DataFrame of ``prediction, [label], features_str``.

    A stream cannot infer types, so ``schema`` is required. A fitted
    pipeline assembles its own features (pass ``features=None``).
    """
    # A file with other headers, or a value of another type, stops the query.
    reader = spark.readStream.schema(schema).option("header", True).option("sep", sep).option(
        "enforceSchema", False).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return score_rows(clean_columns(reader.csv(input_dir)), model, label_col, features)


def score_rows(
    rows: DataFrame,
    model: Model,
    label_col: str | None = None,
    features: Sequence[str] | None = FEATURES,
) -> DataFrame:
    """Score a (streaming or batch) DataFrame: assemble, transform, render."""
    if features is not None and not isinstance(model, PipelineModel):
        rows = assemble(rows, features)
    return output_rows(model.transform(rows), label_col)


def write_stream(
    out: DataFrame,
    output_dir: str,
    checkpoint: str,
    fmt: str = "csv",
    available_now: bool = True,
) -> StreamingQuery:
    """Append a scored stream to files; progress is kept in ``checkpoint``."""
    writer = out.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(output_dir)


def score_stream(
    spark: SparkSession,
    input_dir: str,
    schema: StructType | str,
    model: Model,
    output_dir: str,
    label_col: str | None = None,
    features: Sequence[str] | None = FEATURES,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the query; with ``available_now`` it scores what is there and stops.

    ``checkpoint`` defaults to ``_checkpoint`` inside the output folder, which
    readers of the folder skip. An output folder keeps a log of the batches
    written to it, so it must always be used with the same checkpoint.
    """
    out = scored_stream(spark, input_dir, schema, model, label_col, features)
    ckpt = checkpoint or f"{output_dir.rstrip('/')}/_checkpoint"
    return write_stream(out, output_dir, ckpt, "csv", available_now)
