"""Malformed rows of a delimited input kept apart, written and counted.

A scan with given types stops at the first value that is not of its type, so
one bad line in a large input ends a job. Here the input is parsed once, good
rows are kept typed in Parquet, and each malformed line is kept beside them as
it stood, with its file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from rowcast.functions.names import clean_columns
from rowcast.sources.delimited import INPUT_SEPARATOR, paths_overlap, read_delimited
from rowcast.sources.publish import current, staged

LINE, FILE, REJECTED = "rejected_line", "source_file", "rejected"


class TooManyRejects(ValueError):
    """More rows of an input are malformed than its reader allows."""


@dataclass(frozen=True)
class Quarantine:
    """A parsed input: ``rows`` (typed, cleaned names), ``rejects``
    (``source_file, rejected_line``) and ``counts`` (``source_file, accepted,
    rejected``, a row per file)."""

    rows: DataFrame
    rejects: DataFrame
    counts: DataFrame


def quarantine(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    out: str,
    sep: str = INPUT_SEPARATOR,
    header: bool = True,
    max_share: float | None = None,
    commit: str = "switch",
) -> Quarantine:
    """Parse ``path`` once and publish its good and its malformed rows at ``out``.

    ``schema`` is matched by header name, as by :func:`read_delimited`; a field
    that the header lacks and a further file with another header still raise.
    With more than ``max_share`` of all rows malformed, :class:`TooManyRejects`
    is raised and what ``out`` held before stays. An input without rows gives
    empty tables. Columns named like the three of the reports raise.
    """
    for one in [path] if isinstance(path, str) else path:
        if paths_overlap(spark, one, out):
            raise ValueError(f"refusing to write {out!r}: the input {one!r} lies there")
    scan = read_delimited(spark, path, sep, schema, header, clean=False, corrupt_column=LINE)
    named = clean_columns(scan.select("*", F.col("_metadata.file_path").alias(FILE)))
    taken = [c for c in named.columns if c in (FILE, LINE, REJECTED)]
    if sorted(taken) != sorted((FILE, LINE)):
        raise ValueError(f"the input has columns of its own named {FILE}, {LINE} or {REJECTED}")
    with staged(spark, out, commit) as place:
        named.withColumn(REJECTED, F.col(LINE).isNotNull()).write.partitionBy(REJECTED).parquet(place)
        if max_share is not None:
            good, bad = _totals(_open(spark, place, named.schema).counts)
            if bad > max_share * (good + bad):
                raise TooManyRejects(f"{bad} of {good + bad} rows of {path!r} are malformed, more than {max_share:.2%}")
    return _open(spark, current(spark, out), named.schema)


def _totals(counts: DataFrame) -> tuple[int, int]:
    return tuple(counts.agg(F.coalesce(F.sum("accepted"), F.lit(0)), F.coalesce(F.sum(REJECTED), F.lit(0))).first())


def _open(spark: SparkSession, place: str, schema: StructType) -> Quarantine:
    own = [StructField(f.name, f.dataType) for f in schema.fields if f.name not in (FILE, LINE)]
    full = StructType([*own, StructField(LINE, StringType()), StructField(FILE, StringType()),
                       StructField(REJECTED, BooleanType())])
    written = spark.read.schema(full).parquet(place)
    bad = F.col(REJECTED)
    counts = written.groupBy(FILE).agg(F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))
    return Quarantine(
        written.where(~bad).drop(LINE, FILE, REJECTED), written.where(bad).select(FILE, LINE), counts
    )
