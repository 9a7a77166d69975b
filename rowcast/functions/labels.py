"""Threshold labels: turn an integer grade into a 0/1 class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference jobs: the grade column and the cut-off.
GRADE_COLUMN = "quality"
BINARY_LABEL = "binary_quality"
GRADE_THRESHOLD = 6


def threshold_label(column: str | Column, threshold: float = GRADE_THRESHOLD) -> Column:
    """``1`` where ``column >= threshold``, else ``0`` (a NULL grade gives ``0``).

    The result is a non-null integer. A grade column that is not numeric is
    cast under ANSI rules, so a malformed value raises instead of becoming 0.
    """
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c >= threshold, 1).otherwise(0)


def add_threshold_label(
    df: DataFrame,
    source: str = GRADE_COLUMN,
    target: str = BINARY_LABEL,
    threshold: float = GRADE_THRESHOLD,
) -> DataFrame:
    """Add ``target`` as the 0/1 label of ``source``.

    With ``target == source`` the grade is replaced in place.
    """
    return df.withColumn(target, threshold_label(source, threshold))
