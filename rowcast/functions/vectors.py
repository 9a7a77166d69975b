"""Vectors as text and as plain columns.

A vector column cannot be written to CSV, so outputs carry it as text. The
cast runs in the JVM and keeps MLlib's own format: dense rows print as
``[1.0,2.5]``, sparse rows as ``(size,[indices],[values])``. The assembler
picks the layout per row, so one column can hold both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector_text(column: str = "features") -> Column:
    """The vector in ``column`` rendered as a string."""
    return F.col(column).cast("string")


def with_vector_text(
    df: DataFrame, column: str = "features", target: str = "features_str"
) -> DataFrame:
    return df.withColumn(target, vector_text(column))


def vector_columns(column: str, names: Sequence[str]) -> list[Column]:
    """One double column per vector slot, named by ``names``."""
    arr = vector_to_array(F.col(column))
    return [arr[i].alias(n) for i, n in enumerate(names)]


def array_vector(column: str) -> Column:
    """A numeric array column (e.g. ``array<float>``) as a dense vector."""
    return array_to_vector(F.col(column).cast("array<double>"))
