"""A training table: rows written once in a fixed layout that every fit reads as is.

MLlib's tree learners draw their samples partition by partition and row by row.
:class:`rowcast.runtime.Layout` gives rows fixed places, but shuffles and sorts
all of them for every fit. A training table is that layout on disk: a bucketed
and sorted Parquet table with one file per bucket, read with one task per
bucket. A fit over it needs no shuffle, and gives equal trees each time,
whatever the session's cores, split sizes or shuffle width.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from rowcast.runtime import Layout, laid_out
from rowcast.sources.delimited import reads_from
from rowcast.sources.publish import child, current, place_of, read_text, staged, write_text

SPEC = "_layout.json"
# Rows a bucket should hold; a larger table gets more buckets than its layout asks for.
BUCKET_ROWS = 2_000_000
# Of a table with more buckets, a key of more rows than this part of a bucket is dealt over several.
PIECES = 8
PIECE, COPIES, SIGNS = "_piece", "_copies", "_signs"


def write_training_table(df: DataFrame, path: str, layout: Layout, commit: str = "switch") -> None:
    """Write ``df`` in ``layout`` at ``path``, replacing what is there once the
    new table is complete.

    One shuffle and sort, after which the rows' places follow from the rows
    alone. Keys are hashed as by a ``repartition``, so row order and places are
    those of :func:`rowcast.runtime.laid_out`. Choose as many partitions as
    tasks should train in parallel. Above ``BUCKET_ROWS`` rows a partition, the
    table gets as many partitions as its rows fill, so that one fits a task's
    memory at any size, and a frequent key's rows are dealt over several
    (:func:`_dealt`). Places then still follow from the rows alone.
    """
    spark = df.sparkSession
    if reads_from(df, path):
        raise ValueError(f"refusing to overwrite {path!r}: the DataFrame reads from it")
    keys, columns = list(layout.keys or df.columns), list(df.columns)
    name = f"rowcast_write_{uuid.uuid4().hex}"
    rows, schema = laid_out(df, layout), df.schema
    n = df.count()
    if n > BUCKET_ROWS * layout.partitions:
        layout = Layout(-(-n // BUCKET_ROWS), keys)
        rows = laid_out(df, layout)
        most = max(1, BUCKET_ROWS // PIECES)
        frequent = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).drop("n")
        if not frequent.isEmpty():
            rows = _dealt(df, frequent, keys, layout.partitions, most)
            keys = [PIECE]
            schema = rows.schema
    with staged(spark, path, commit) as place:
        # The rows of a bucket are one task's, so every bucket is one file.
        writer = rows.write.format("parquet").option("path", place)
        try:
            writer.bucketBy(layout.partitions, *keys).sortBy(*columns).saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
        spec = {"partitions": layout.partitions, "keys": keys, "sorted": columns, "schema": schema.jsonValue()}
        fs, folder = place_of(spark, place)
        write_text(spark, fs, child(spark, folder, SPEC), json.dumps(spec))


def _dealt(df: DataFrame, frequent: DataFrame, keys: list[str], partitions: int, most: int) -> DataFrame:
    """``df`` in ``partitions`` parts by a column ``PIECE``, sorted: a hash of the
    keys, which deals the rows of ``frequent`` ones over several.

    Equal rows cannot be told apart, so of those keys they are counted, dealt
    as pieces of at most ``most`` copies by a hash of the row and the piece's
    number, and repeated where they come to lie.
    """
    columns = df.columns
    taken = {c.lower() for c in columns} & {PIECE, COPIES, SIGNS}
    if taken:
        raise ValueError(f"columns {sorted(taken)} have names that a dealt table needs")

    def col(name: str):
        return F.col(f"`{name.replace('`', '``')}`")

    named = frequent.toDF(*[f"_k{i}" for i in range(len(keys))])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & col(k).eqNullSafe(F.col(f"_k{i}"))
    named = F.broadcast(named)  # at most a key for every ``most`` rows
    plain = df.join(named, same, "left_anti").withColumns({PIECE: F.xxhash64(*map(col, keys)), COPIES: F.lit(1).cast("long")})
    # Grouping takes -0.0 for 0.0; the signs keep them apart and bring them back.
    real = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    signs = F.array(*[F.coalesce(col(c).cast("string") == "-0.0", F.lit(False)) for c in real] or [F.lit(False)])
    counted = df.join(named, same, "left_semi").groupBy(*map(col, columns), signs.alias(SIGNS)).agg(
        F.count(F.lit(1)).alias(COPIES))
    types = {f.name: f.dataType for f in df.schema.fields}
    back = [F.when(F.col(SIGNS)[real.index(c)], F.lit(-0.0).cast(types[c])).otherwise(col(c)).alias(c)
            if c in real else col(c) for c in columns]
    pieces = counted.select(
        *back, F.posexplode(F.expr(f"transform(sequence(0, {COPIES} - 1, {most}), i -> least({most}, {COPIES} - i))"))
        .alias("_at", COPIES))
    dealt = pieces.select(*map(col, columns), F.xxhash64(*map(col, columns), "_at").alias(PIECE), COPIES)
    placed = plain.unionByName(dealt).repartition(partitions, PIECE)
    return placed.select(*map(col, columns), PIECE, F.explode(F.expr(f"sequence(1, {COPIES})")).alias("_copy")).drop(
        "_copy").sortWithinPartitions(*map(col, columns))


def is_training_table(spark: SparkSession, path: str) -> bool:
    fs, folder = place_of(spark, current(spark, path))
    return fs.exists(child(spark, folder, SPEC))


def read_training_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, one partition per bucket, rows in their order.

    Spark reads a table by its buckets only where a query asks for them, unless
    told otherwise. That setting is made in a session of its own, which shares
    the caller's catalog, so the caller's settings stay as they are.
    """
    place = current(spark, path)
    fs, folder = place_of(spark, place)
    spec = json.loads(read_text(spark, fs, child(spark, folder, SPEC)))
    schema = StructType.fromJson(spec["schema"])
    own = spark.newSession()
    own.conf.set("spark.sql.sources.bucketing.enabled", "true")
    own.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    name = f"rowcast_table_{uuid.uuid4().hex}"

    def quoted(names: list[str]) -> str:
        return ", ".join(f"`{n.replace('`', '``')}`" for n in names)

    columns = ", ".join(f"{quoted([f.name])} {f.dataType.simpleString()}" for f in schema.fields)
    at = place.replace("\\", "\\\\").replace("'", "\\'")
    own.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{at}' "
        f"CLUSTERED BY ({quoted(spec['keys'])}) SORTED BY ({quoted(spec['sorted'])}) INTO {spec['partitions']} BUCKETS"
    )
    table = own.table(name)
    table.schema  # resolved now: the plan keeps the files, the name is not needed any more
    own.sql(f"DROP TABLE {name}")
    # Spark reads by buckets where their column is read, so it is named in a filter.
    return table.where(F.col(PIECE).isNotNull()).drop(PIECE) if spec["keys"] == [PIECE] else table
