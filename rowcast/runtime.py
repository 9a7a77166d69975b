"""Session-level helpers: the shared scratch folder and a fixed row layout.

Intermediate files (CSV round trips, saved models, lineage cuts) go to the
folder the cluster names in ``spark.checkpoint.dir``. It is read from the
session; only when it is unset (local runs, tests) is a folder chosen here.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    MLlib's tree learners and GBT cut their lineage every
    ``checkpointInterval`` iterations, but only once the context has a
    checkpoint directory. A configured ``spark.checkpoint.dir`` is
    registered by Spark itself at start-up; this only fills the gap when
    the setting is absent in a one-JVM local session (local runs, tests),
    with a folder of its own. On a cluster a folder on the driver's disk is
    not shared with the executors, so there the setting is required.
    The setting itself is a core config and cannot be changed at runtime.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        root = sc.getConf().get(CHECKPOINT_KEY, None)
        if root is None:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError(
                    f"{CHECKPOINT_KEY} is not set: on a cluster it must name shared "
                    "storage (HDFS, an object store) for lineage cuts and scratch files"
                )
            root = tempfile.mkdtemp(prefix="rowcast-ckpt-")
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


_scratch: dict[str, list[str]] = {}  # by application: the paths handed out and not yet deleted


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder.

    What is written there stays until :func:`discard` or :func:`clear_scratch`:
    results are read lazily, so only the caller knows when they are done with.
    """
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete one scratch path; anything else is refused."""
    ours = _scratch.get(spark.sparkContext.applicationId, [])
    if path not in ours:
        raise ValueError(f"not a scratch path of this session: {path!r}")
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)
    ours.remove(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch path of this session, once its results are used."""
    for path in list(_scratch.get(spark.sparkContext.applicationId, [])):
        discard(spark, path)


@dataclass(frozen=True)
class Layout:
    """Where a learner's rows lie: by hash of ``keys`` in ``partitions`` parts.

    MLlib's tree learners draw their samples partition by partition and row by
    row, so a forest is repeatable only over the same rows in the same places.
    With a layout the places follow from the rows alone, not from the files,
    the cores or the machine. ``keys`` defaults to all columns: only rows equal
    in every column then share a partition for sure. Give a key that spreads
    (an id) where few distinct rows make up the table.
    """

    partitions: int
    keys: Sequence[str] | None = None


def laid_out(df: DataFrame, layout: Layout | None) -> DataFrame:
    """``df`` in its layout, sorted by all columns; as read without one."""
    if layout is None:
        return df
    keys = list(layout.keys or df.columns)
    return df.repartition(layout.partitions, *keys).sortWithinPartitions(*df.columns)
