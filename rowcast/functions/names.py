"""Column-name cleaning for delimited inputs whose headers carry spaces or quotes."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame


def clean_name(name: str) -> str:
    """Spaces become underscores, double quotes are removed, then the rest is stripped.

    The order is significant: a header ``' pH '`` becomes ``'_pH_'`` because
    the spaces are replaced before ``strip`` runs, so ``strip`` only removes
    tabs and line breaks.
    """
    return name.replace(" ", "_").replace('"', "").strip()


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`clean_name` in one projection.

    Two headers that clean to the same name would make later references
    ambiguous, so that is rejected here rather than at first use.
    """
    cleaned = [clean_name(c) for c in df.columns]
    clashes = sorted(n for n, k in Counter(cleaned).items() if k > 1)
    if clashes:
        raise ValueError(f"column names collide after cleaning: {clashes}")
    if cleaned == df.columns:
        return df
    return df.toDF(*cleaned)
