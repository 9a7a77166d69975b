"""MLlib model folders: save with or without overwrite, typed load."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import SparkSession

from rowcast.sources.publish import current, refuse_existing, staged

MODEL_CLASSES: dict[str, type] = {
    "lr": LogisticRegressionModel,
    "rf": RandomForestClassificationModel,
    "gbt": GBTClassificationModel,
    "pipeline": PipelineModel,
}


def save_model(model: MLWritable, path: str, overwrite: bool = True, commit: str = "switch") -> None:
    """Save ``model`` to ``path``.

    With ``overwrite=False`` an existing path is an error, so a second run
    of a job stops instead of replacing the first run's model. The folder is
    published once it is complete, as by :func:`rowcast.write_csv`: a failing
    save leaves the model that was there.
    """
    spark = SparkSession.active()
    if not overwrite:
        refuse_existing(spark, path)
    with staged(spark, path, commit) as place:
        model.write().save(place)


def load_model(path: str, kind: str | type[MLReadable] = "pipeline"):
    """Load a model through its class; a folder of another class raises."""
    cls = MODEL_CLASSES[kind] if isinstance(kind, str) else kind
    return cls.load(current(SparkSession.active(), path))
