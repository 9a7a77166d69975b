"""rowcast: classify rows of numeric tables with Spark.

Every step is a DataFrame expression or a public MLlib stage:

* ``rowcast.sources``   delimited scan and CSV sink, model save / load
* ``rowcast.functions`` column expressions (name cleaning, threshold labels,
  vectors as text)
* ``rowcast.operators`` feature assembly and scaling, learners, metrics,
  projections and preview
* ``rowcast.plans``     the train / validate / score jobs
* ``rowcast.streaming`` the score job over a file stream

A session is always passed in; nothing in the library creates one.
"""

from rowcast.functions.labels import add_threshold_label, threshold_label
from rowcast.functions.names import clean_columns, clean_name
from rowcast.functions.vectors import vector_columns, vector_text, with_vector_text
from rowcast.operators.features import (
    PopulationScaler,
    PopulationScalerModel,
    assemble,
    assembler,
)
from rowcast.operators.learners import (
    build_pipeline,
    fit,
    make_learner,
    score,
)
from rowcast.operators.metrics import auc_roc, confusion_counts, weighted_f1
from rowcast.operators.frames import drop_columns, preview, project
from rowcast.sources.delimited import read_delimited, write_csv
from rowcast.sources.models import load_model, save_model

__all__ = [
    "PopulationScaler",
    "PopulationScalerModel",
    "add_threshold_label",
    "assemble",
    "assembler",
    "auc_roc",
    "build_pipeline",
    "clean_columns",
    "clean_name",
    "confusion_counts",
    "drop_columns",
    "fit",
    "load_model",
    "make_learner",
    "preview",
    "project",
    "read_delimited",
    "save_model",
    "score",
    "threshold_label",
    "vector_columns",
    "vector_text",
    "weighted_f1",
    "with_vector_text",
    "write_csv",
]
