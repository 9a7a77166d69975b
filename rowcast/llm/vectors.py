"""Vector columns as arrays, and small arrays of many tasks merged into one."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowcast.llm.common import Rounds

FAN_IN = 16


def finite_rows(column: pa.ListArray, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows whose vector is there, not empty and holds only
    finite entries, and those vectors as one matrix of doubles.

    ``width`` is their required length; without it they must agree among
    themselves. Other lengths raise.
    """
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    row_of = np.repeat(np.arange(len(length)), length)
    good = pc.is_valid(column).to_numpy(zero_copy_only=False).copy()
    good[row_of[~np.isfinite(flat)]] = False
    good &= length > 0
    rows = np.flatnonzero(good)
    sizes = np.unique(length[rows])
    if width is None and len(sizes):
        width = int(sizes[0])
    if len(sizes) > 1 or len(sizes) == 1 and sizes[0] != width:
        raise ValueError(f"vectors of different lengths: {sorted({width, *sizes.tolist()})}")
    return rows, flat[good[row_of]].reshape(len(rows), width or 0)


def partials(df: DataFrame, fold: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None]) -> DataFrame:
    """``part, data``: the array that ``fold`` makes of a task's rows, one row a
    task; none where it returns none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = fold(batches)
        if made is not None:
            part = TaskContext.get().partitionId()
            yield pa.record_batch([pa.array([part]), pa.array([made.tobytes()], pa.binary())], names=["part", "data"])

    return df.mapInArrow(run, "part long, data binary")


def merged(parts: DataFrame, dtype: str, merge: Callable[[list[np.ndarray]], np.ndarray], name: str) -> np.ndarray | None:
    """The arrays of :func:`partials` merged sixteen by sixteen, in order, until
    one is left; only that one reaches the driver. None without rows."""

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        made = merge([np.frombuffer(b.as_py(), dtype=dtype) for b in table["data"]])
        part = table["part"][0].as_py() // FAN_IN
        return pa.table({"part": pa.array([part]), "data": pa.array([made.tobytes()], pa.binary())})

    rounds = Rounds(parts.sparkSession, name)
    now = rounds.put(parts)
    while now.count() > 1:
        group = F.floor(F.col("part") / FAN_IN)
        now = rounds.put(now.groupBy(group).applyInArrow(join, "part long, data binary"))
    last = now.first()
    return None if last is None else np.frombuffer(bytes(last["data"]), dtype=dtype)
