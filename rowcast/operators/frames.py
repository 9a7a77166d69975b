"""Projections and the ordered preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows in a stated order (all columns by default).

    An unordered ``limit`` returns any ``n`` rows; ordering makes the preview
    repeatable. Spark plans this as a per-partition top-``n`` merged in one
    task, so only ``n`` rows per partition move.
    """
    return df.orderBy(*(order_by or df.columns)).limit(n)
