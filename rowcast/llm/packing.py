"""Best-two-fit packing of token sequences.

Documents are encoded, closed with an end id, and only those longer than a
sequence are cut (the short piece first). Packing depends on piece lengths
alone, so it is solved on the histogram of lengths, which has at most
``max_len`` rows however large the corpus is: fill a bin greedily from the
longest piece down, then replace its smallest piece by the two unpacked
pieces that fit the widened gap most tightly. A bin's pattern is repeated as
often as the counts allow. The pieces of one length are then numbered in
parallel, and the number says which bin and place a piece gets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowcast.llm.common import encoder, id_and_text, ship, stored, tokenizer_path

MAX_LEN = 1024
END_ID = 2
ROWS_PER_SLICE = 20_000


def pieces(
    docs: DataFrame,
    max_len: int = MAX_LEN,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, ids]``: the pieces of every document.

    A null or empty text is the end id alone. A document of more than
    ``max_len`` ids is cut into full pieces; what is over comes first.
    """
    path = tokenizer or tokenizer_path()
    schema = "doc_id {}, piece int, start long, length long, ids_crc32 long".format(
        docs.schema[id_col].dataType.simpleString()
    ) + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            where, piece, start, length, crc, ids_out = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = encode(text.as_py())
                ids.append(end_id)
                n = len(ids)
                raw = memoryview(np.array(ids, dtype="<u4")).cast("B")
                a, k = 0, 0
                b = n % max_len or min(n, max_len)
                while a < n:
                    where.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(raw[4 * a : 4 * b]))
                    if with_ids:
                        ids_out.append(ids[a:b])
                    a, b, k = b, b + max_len, k + 1
            columns = [
                batch.column(0).take(pa.array(where, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids_out, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(columns, names=names)

    return id_and_text(docs, id_col, text_col).mapInArrow(cut, schema)


def plan_bins(counts: np.ndarray, max_len: int) -> list[tuple[int, list[int]]]:
    """Best-two-fit over a histogram: ``(repeats, piece lengths of the bin)``.

    ``counts[n]`` is the number of pieces of length ``n``. A bin is filled with
    the largest pieces that fit; if a gap is left, its smallest piece gives way
    to the two unpacked ones that fill more, the fullest pair and of those the
    one with the smallest piece. A bin of one piece keeps it: that piece is the
    largest unpacked one and would only move on to the next bin. A pattern is
    repeated while its pieces last. Every entry uses
    up at least one length's supply for its pattern, so the list's size
    depends on ``max_len``, not on the number of pieces.
    """
    left = np.array(counts, dtype=np.int64)
    lengths = np.arange(max_len + 1)
    bins = []
    while True:
        largest_upto = np.maximum.accumulate(np.where(left > 0, lengths, 0))
        size = int(largest_upto[max_len])
        if size == 0:
            return bins
        used: dict[int, int] = {}
        content: list[int] = []
        gap = max_len
        while size:
            n = min(int(left[size]) - used.get(size, 0), gap // size)
            if n > 0:
                used[size] = used.get(size, 0) + n
                content += [size] * n
                gap -= n * size
            size = int(largest_upto[min(gap, size - 1)])
        if gap > 0 and len(content) > 1:
            small = content[-1]
            room = small + gap
            free = left.copy()
            for s, n in used.items():
                free[s] -= n
            upto = np.maximum.accumulate(np.where(free > 0, lengths, 0))
            first = np.flatnonzero(free[: room // 2 + 1] > 0)
            if len(first):
                second = upto[room - first]
                # The same length twice needs two pieces of it.
                same = (second == first) & (free[first] < 2)
                second = np.where(same, upto[np.maximum(first - 1, 0)], second)
                total = np.where(second > 0, first + second, 0)
                best = int(np.argmax(total))
                if total[best] > small:
                    content[-1:] = sorted([int(first[best]), int(second[best])], reverse=True)
        need: dict[int, int] = {}
        for s in content:
            need[s] = need.get(s, 0) + 1
        repeats = min(int(left[s]) // n for s, n in need.items())
        for s, n in need.items():
            left[s] -= repeats * n
        bins.append((repeats, content))


def _places(bins: list[tuple[int, list[int]]], counts: np.ndarray) -> dict[str, np.ndarray]:
    """For runs of equal-length pieces: first number, bin, pieces per bin, offset.

    Numbers run over all pieces: those of length ``n`` start where the
    shorter ones end.
    """
    cursor = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    rows, sequence = [], 0
    for repeats, content in bins:
        offset = 0
        for size in dict.fromkeys(content):
            per_bin = content.count(size)
            rows.append((int(cursor[size]), sequence, per_bin, offset))
            cursor[size] += repeats * per_bin
            offset += per_bin * size
        sequence += repeats
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return {"first": table[:, 0], "sequence": table[:, 1], "per_bin": table[:, 2], "offset": table[:, 3]}


def place(parts: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (``doc_id, piece, length``, more may follow).

    Only the histogram of lengths (``max_len`` rows) reaches the driver, and
    only its plan, bounded the same way, is broadcast.
    """
    spark = parts.sparkSession
    ship(spark)
    counts = np.zeros(max_len + 1, dtype=np.int64)
    for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["length"]] = r["n"]
    table = spark.sparkContext.broadcast(_places(plan_bins(counts, max_len), counts))
    below = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)

    # Numbering: pieces of a length are dealt into slices by a hash and
    # numbered inside a slice, so a length that holds a third of all pieces
    # is many small windows.
    slices = max(1, -(-int(counts.sum()) // ROWS_PER_SLICE))
    dealt = parts.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)).cast("int"))
    per_slice = dealt.groupBy("length", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    base = per_slice.select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_slice").orderBy("doc_id", "piece")
    numbered = (
        dealt.withColumn("_inner", F.row_number().over(inside) - 1)
        .join(base, ["length", "_slice"])
        .withColumn("_number", (F.col("_base") + F.col("_inner")).cast("long"))
        .select(*parts.columns, "_number")
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("_number").to_numpy() + below[length]
            run = np.searchsorted(t["first"], number, side="right") - 1
            nth = number - t["first"][run]
            sequence = t["sequence"][run] + nth // t["per_bin"][run]
            offset = t["offset"][run] + nth % t["per_bin"][run] * length
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    return numbered.mapInArrow(assign, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, max_len: int = MAX_LEN, end_id: int = END_ID, tokenizer: str | None = None,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their sequence and place in it.

    Returns ``doc_id, piece, start, length, ids_crc32[, ids], sequence_id,
    offset``. Null and empty texts are one piece holding the end id; repeated
    rows are packed once each; an empty table gives no rows.
    """
    parts = stored(pieces(docs, max_len, end_id, tokenizer, with_ids, id_col, text_col), "pack-pieces")
    return place(parts, max_len)
