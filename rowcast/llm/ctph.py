"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes cuts a text where it falls below a
threshold, so cuts follow the content and an edit moves only the pieces around
it. Each piece gives one letter; the letters for the chosen block size and for
twice that size are the fingerprint ``size:letters:letters``. Two fingerprints
are compared only at an equal block size, by the edit distance (insertions and
deletions) of their letters, and only if they share a run of letters.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowcast.llm.common import id_and_text, stored

WINDOW = 7
LETTERS = 64  # letters a signature has at most; the last covers the rest
SMALLEST = 4  # smallest block size
SHARED_RUN = 4  # letters two signatures must share in a row
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def _byte_values() -> np.ndarray:
    """A well-mixed 32-bit value for every byte (a multiplicative finaliser)."""
    v = np.arange(1, 257, dtype=np.uint32) * np.uint32(0x9E3779B1)
    v ^= v >> np.uint32(15)
    v *= np.uint32(0x85EBCA6B)
    v ^= v >> np.uint32(13)
    return v


BYTE_VALUES = _byte_values()
WEIGHTS = [np.uint32(2 * i * i * 0x9E3779B1 % (1 << 32) | 1) for i in range(1, WINDOW + 1)]


def _rolling(raw: np.ndarray) -> np.ndarray:
    """The hash of the seven bytes that end at each byte (fewer at the start)."""
    values = BYTE_VALUES[raw]
    out = values * WEIGHTS[0]
    for back in range(1, min(WINDOW, len(raw))):
        out[back:] += values[:-back] * WEIGHTS[back]
    return out


def _signature(raw: bytes, ends: np.ndarray) -> str:
    """One letter for each piece that ends at ``ends``, and for what is left."""
    out, start = [], 0
    for end in ends[: LETTERS - 1].tolist():
        out.append(ALPHABET[zlib.crc32(raw[start:end]) & 63])
        start = end
    if start < len(raw):
        out.append(ALPHABET[zlib.crc32(raw[start:]) & 63])
    return "".join(out)


def fingerprint(text: str) -> str:
    """``size:letters:letters`` of one whole text; ``4::`` without bytes."""
    raw = text.encode("utf-8", "surrogatepass")
    size = SMALLEST
    while size * LETTERS < len(raw):
        size *= 2
    if not raw:
        return f"{size}::"
    rolled = _rolling(np.frombuffer(raw, dtype=np.uint8))
    # Cuts of a larger block size are cuts of every smaller one.
    while True:
        ends = np.flatnonzero(rolled < (1 << 32) // size) + 1
        if len(ends) >= LETTERS // 2 or size == SMALLEST:
            break
        size //= 2
    coarse = ends[rolled[ends - 1] < (1 << 32) // (2 * size)]
    return f"{size}:{_signature(raw, ends)}:{_signature(raw, coarse)}"


def _alike(a: str, b: str) -> float:
    """1 less the share of letters to insert or delete; 0 without a shared run."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    run = min(SHARED_RUN, len(a), len(b))
    grams = {a[i : i + run] for i in range(len(a) - run + 1)}
    if not any(b[i : i + run] in grams for i in range(len(b) - run + 1)):
        return 0.0
    # Longest common subsequence, one machine-word row per letter of ``b``.
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    common = len(a) - row.bit_count()
    return 2 * common / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1: how alike two fingerprints are; 1 for equal ones, 0 at
    incompatible block sizes (more than a factor of two apart)."""
    if a == b:
        return 1.0
    (size_a, a1, a2), (size_b, b1, b2) = a.split(":"), b.split(":")
    m, n = int(size_a), int(size_b)
    if m == n:
        return max(_alike(a1, b1), _alike(a2, b2))
    if m == 2 * n:
        return _alike(a1, b2)
    if 2 * m == n:
        return _alike(a2, b1)
    return 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every row; a null text is empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.record_batch(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([fingerprint(t) for t in texts], pa.string())],
                names=["doc_id", "n_chars", "fingerprint"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def _edited(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def edit_probe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its own edit and against its neighbour.

    Documents follow one another by descending id, after the last comes the
    first. ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. Null ids come last; rows that share an id follow
    by a hash of their text, then the text. A null text is empty. A table of
    one row follows itself; an empty table gives no rows.

    Texts are shuffled once, into ranges of ids. A task handles every pair
    inside its range and hands out the range's first and last document; those
    few are paired afterwards.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    told = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [c.split(" ")[0] for c in told.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compare(text: str, mark: str, following: str, next_mark: str) -> tuple:
        edited = _edited(text, following)
        edited_mark = fingerprint(edited)
        sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return len(text), sha, mark, edited_mark, likeness(mark, edited_mark), likeness(mark, next_mark)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None  # the row whose follower comes next: id, text, fingerprint
        id_type = None

        def rows(ids, found, edge, texts):
            columns = [pa.concat_arrays(ids) if ids else pa.array([], id_type)]
            columns += [pa.array([f[i] if f else None for f in found], t) for i, t in enumerate(types)]
            columns += [pa.array(edge, pa.string()), pa.array([part] * len(edge), pa.int32()), pa.array(texts, pa.string())]
            return pa.record_batch(columns, names=["doc_id", *names, "edge", "part", "text"])

        for batch in batches:
            ids, found, edge, texts = [], [], [], []
            id_type = batch.column(0).type
            for at, value in enumerate(batch.column(1)):
                text = value.as_py()
                mark = fingerprint(text)
                here = batch.column(0).slice(at, 1)
                if held is None:
                    ids.append(here), found.append(None), edge.append("first"), texts.append(text)
                else:
                    ids.append(held[0]), found.append(compare(held[1], held[2], text, mark))
                    edge.append(None), texts.append(None)
                held = here, text, mark
            yield rows(ids, found, edge, texts)
        if held is not None:
            yield rows([held[0]], [None], ["last"], [held[1]])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                compare(t, fingerprint(t), n, fingerprint(n))
                for t, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate(types)]
            yield pa.record_batch([batch.column(0), *columns], names=["doc_id", *names])

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    ranged = id_and_text(docs, id_col, text_col).repartitionByRange(width, F.desc_nulls_last("doc_id"), tie)
    done = stored(
        ranged.sortWithinPartitions(F.desc_nulls_last("doc_id"), tie, "text").mapInArrow(
            within, f"doc_id {kind}, {told}, edge string, part int, text string"
        ),
        "ctph-pairs",
    )
    # One first and one last row per range: a few numbers in one window.
    firsts = done.where("edge = 'first'").select("part", F.col("text").alias("following"))
    in_order = Window.orderBy("part")
    after = firsts.select(
        F.col("part").alias("here"),
        F.coalesce(
            F.lead("part").over(in_order),
            F.min("part").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("part"),
    )
    lasts = done.where("edge = 'last'").select("doc_id", "text", F.col("part").alias("here"))
    seams = lasts.join(after, "here").join(firsts, "part").select("doc_id", "text", "following")
    return done.where("edge is null").select("doc_id", *names).unionByName(
        seams.mapInArrow(across, f"doc_id {kind}, {told}")
    )
