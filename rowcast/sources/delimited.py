"""Delimited scan and CSV sink.

Paths are plain Hadoop URIs (local, HDFS, object stores); credentials come
from the cluster's configuration, never from this code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from rowcast.functions.names import clean_columns, clean_name
from rowcast.sources.publish import exists, staged

# Fixed value of the reference jobs: inputs are semicolon separated.
INPUT_SEPARATOR = ";"


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = INPUT_SEPARATOR,
    schema: StructType | str | None = None,
    header: bool = True,
    sampling_ratio: float | None = None,
    clean: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read a delimited file (or folder of files) with a header row.

    Without ``schema`` the column types are inferred, which costs one extra
    pass over the input (a ``sampling_ratio`` below 1 shortens it, accepting
    that a rare malformed value may then go unseen). With ``schema`` only the
    header line is read first: its columns take the types of the schema's
    fields of the same (cleaned) name, in the file's order, and columns the
    schema lacks are text. A schema field the header lacks, a value that is
    not of its type and a further file with another header all raise.
    With ``corrupt_column`` (and a schema) a malformed row does not raise: that
    column, null otherwise, holds its line. A row is malformed if it has more
    or fewer values than the header, or a value that is not of its type in a
    column that the query uses: Spark parses no other. It refuses queries that
    use the corrupt column alone. :func:`rowcast.sources.quarantine.quarantine`
    parses all columns once and keeps the outcome.
    Duplicate header names are suffixed by the reader (``a0``, ``a1``).
    Column names are cleaned with :func:`clean_columns` unless ``clean`` is
    false.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if corrupt_column is not None and schema is None:
        raise ValueError("corrupt_column needs a schema: without one no value is malformed")
    if schema is not None:
        schema = _parsed(spark, schema)
        if header:
            schema = _in_header_order(reader.csv(path).columns, schema)
            reader = reader.option("enforceSchema", False)
        if corrupt_column is None:
            reader = reader.option("mode", "FAILFAST")
        else:
            schema = StructType([*schema.fields, StructField(corrupt_column, StringType())])
            # Without pruning the values of a row are counted in every query.
            reader = reader.option("mode", "PERMISSIVE").option("columnPruning", False)
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", sampling_ratio)
    df = reader.csv(path)
    return clean_columns(df) if clean else df


def _parsed(spark: SparkSession, schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _in_header_order(columns: list[str], schema: StructType) -> StructType:
    """The header's columns with the types of the schema's fields of that name."""
    types = {clean_name(f.name): f.dataType for f in schema.fields}
    names = [clean_name(c) for c in columns]
    if missing := [n for n in types if n not in names]:
        raise ValueError(f"the header lacks the columns {missing}")
    fields = [StructField(c, types.get(n, StringType())) for c, n in zip(columns, names)]
    return StructType(fields)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    header: bool = True,
    sep: str = ",",
    commit: str = "switch",
) -> None:
    """Write ``df`` as CSV part files, one per partition, with a header.

    Vector columns must be rendered first (:func:`rowcast.vector_text`);
    values containing the separator are quoted by the writer.

    The folder is written beside its place and published once it is complete
    (:func:`rowcast.sources.publish.staged`, which explains ``commit``): a
    failing write leaves what was there readable. ``mode="append"`` adds files
    to the folder as Spark does; ``"errorifexists"`` and ``"ignore"`` leave an
    existing folder alone.

    Overwriting a folder that ``df`` itself reads from is refused up front:
    the DataFrame could not be read again afterwards.
    """
    spark = df.sparkSession
    if mode == "overwrite" and reads_from(df, path):
        raise ValueError(f"refusing to overwrite {path!r}: the DataFrame reads from it")
    if mode == "append" or mode != "overwrite" and exists(spark, path):
        df.write.mode(mode).option("header", header).option("sep", sep).csv(path)
        return
    with staged(spark, path, commit) as place:
        df.write.option("header", header).option("sep", sep).csv(place)


def reads_from(df: DataFrame, path: str) -> bool:
    """Whether overwriting ``path`` would delete files ``df`` reads.

    Compares the root paths of the file relations in the analysed plan, where
    a cached input still shows the files it came from; no file is listed.
    """
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() != "HadoopFsRelation":
            continue
        roots = relation.location().rootPaths()
        if any(paths_overlap(spark, roots.apply(k).toString(), path) for k in range(roots.size())):
            return True
    return False


def paths_overlap(spark: SparkSession, a: str, b: str) -> bool:
    """Whether one path is the other or lies below it."""
    full = []
    for p in (a, b):
        hpath = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
        uri = fs.makeQualified(hpath).toUri()
        full.append((uri.getScheme(), uri.getAuthority(), uri.getPath().rstrip("/") + "/"))
    (s1, h1, p1), (s2, h2, p2) = full
    return s1 == s2 and h1 == h2 and (p1.startswith(p2) or p2.startswith(p1))
