"""SimHash near-duplicate detection over a byte-position inverted index.

A 64-bit fingerprint is eight positional bytes. Two fingerprints within ``k``
bits differ in at most ``k`` bytes, so they share at least ``8 - k`` positional
bytes: the guaranteed minimum. A list of all fingerprints with one byte at one
position holds 1/256 of the corpus, so lists are intersected three at a time
before they are posted: every distinct fingerprint is posted under the choices
of three positions that can come first among the shared ones of a pair. Inside
a list the shared positional bytes of each pair are tallied; pairs that reach
the minimum are retained in the one list made of their first three shared
positions, and verified by their bit distance.

Frequent lists, above ``list_limit`` distinct fingerprints, are split by more
positions, up to the minimum. What is still longer then (a large group of near
copies) is not compared pair by pair but linked through the points between:
two values within ``k`` bits share a value within ``k / 2`` bits of both, so
grouping by those values finds every link with work linear in the list.

Copies of a text never meet in the index: it holds distinct fingerprints, and
documents join their class at the end. Inside a posting list only a spanning
forest of the verified links is emitted, not all pairs. Keys with more than a
thousandth of the rows (copies of one text, hubs of the component search) are
joined by broadcast, the others by shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rowcast.llm.common import Rounds, id_and_text, joined_by, ship, stored

N_BYTES = 8
POSTED = 3  # positional bytes of a posting list before it is split
SEED = 42


def fingerprint(text: str, shingle: int = 4) -> int:
    """The SimHash of one text, unsigned; 0 without words.

    Words are runs of non-blank characters, A-Z lower-cased; a text of fewer
    than ``shingle`` words is one shingle.
    """
    norm = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    if not norm:
        return 0
    blanks = np.flatnonzero(np.frombuffer(norm, dtype=np.uint8) == 32)
    starts = np.concatenate([[0], blanks + 1])
    ends = np.concatenate([blanks, [len(norm)]])
    n = max(1, len(starts) - shingle + 1)
    last = ends[shingle - 1 :] if len(ends) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(norm[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())], dtype=np.uint64
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp``: the fingerprint of every row, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, fp long")


def with_fingerprint(docs: DataFrame, text_col: str, name: str, shingle: int = 4) -> DataFrame:
    """``docs`` with the fingerprint of every row as one more column, ``name``."""
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py() or "", shingle) for t in batch.column(at)], dtype=np.uint64)
            yield pa.record_batch([*batch.columns, pa.array(fps.view(np.int64))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def _shared(differing: np.ndarray) -> np.ndarray:
    """Which positional bytes each pair shares, as the bits of one byte, from their XOR."""
    same = differing.astype("<u8").view(np.uint8).reshape(-1, N_BYTES) == 0
    return np.packbits(same, axis=1, bitorder="little")[:, 0]


def _owners(positions: list[tuple[int, ...]], least: int) -> np.ndarray:
    """For each set of shared positions (as bits) the number of the list that
    retains such pairs: the one of the first shared positions if at least
    ``least`` bytes are shared, else -1."""
    number = {c: i for i, c in enumerate(positions)}
    owners = np.full(1 << N_BYTES, -1)
    for bits in range(1 << N_BYTES):
        shared = tuple(p for p in range(N_BYTES) if bits >> p & 1)
        if len(shared) >= least:
            owners[bits] = number[shared[: len(positions[0])]]
    return owners


def _retained(differing: np.ndarray, lists, owners: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter, then bit distance, of pairs that meet in ``lists``."""
    return (owners[_shared(differing)] == lists) & (np.bitwise_count(differing) <= max_bits)


def _forest(values: np.ndarray, number: int, owners: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that span the components of one posting list, by breadth-first search."""
    left = np.arange(1, len(values))
    links, queue = [], [0]
    while True:
        if not queue:
            if not len(left):
                return links
            queue, left = [int(left[0])], left[1:]
        here = queue.pop()
        near = _retained(values[left] ^ values[here], number, owners, max_bits)
        for there in left[near].tolist():
            links.append((here, there))
            queue.append(there)
        left = left[~near]


def links(fps: DataFrame, max_bits: int = 4, list_limit: int = 4096) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that have
    the same connected components as all pairs within ``max_bits`` bits.
    ``max_bits`` is even and below 8."""
    if max_bits % 2 or not 0 <= max_bits < N_BYTES:
        raise ValueError("max_bits must be 0, 2, 4 or 6")
    least = N_BYTES - max_bits
    full = list(combinations(range(N_BYTES), least))
    width = min(POSTED, least)
    short = sorted({c[:width] for c in full})
    posted = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(len(short) - 1))).alias("list"))
    compared = _compared(posted, short, least, max_bits, list_limit)
    found = compared.where("list < 0").select("a", "b")
    long_lists = compared.where("list >= 0").select("list", F.col("a").alias("fp"))
    if long_lists.isEmpty():
        return found
    if width < least:
        finer = F.array(*[F.array(*[F.lit(i) for i, c in enumerate(full) if c[:width] == head]) for head in short])
        split = long_lists.select("fp", F.explode(F.element_at(finer, F.col("list") + 1)).alias("list"))
        compared = _compared(split, full, least, max_bits, list_limit)
        found = found.unionByName(compared.where("list < 0").select("a", "b"))
        long_lists = compared.where("list >= 0").select("list", F.col("a").alias("fp"))
        if long_lists.isEmpty():
            return found
    return found.unionByName(_long_links(long_lists, full, max_bits)).distinct()


def _compared(posted: DataFrame, positions: list[tuple[int, ...]], least: int, max_bits: int,
              list_limit: int) -> DataFrame:
    """``a, b, list``: links of every posting list (``list`` -1), and the members
    (``a`` = ``b``) of those with more than ``list_limit`` entries. ``posted``
    holds ``list``, a number in ``positions``, and ``fp``."""
    masks = [sum(255 << (8 * p) for p in c) for c in positions]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    mask_of = F.element_at(F.array(*[F.lit(m).cast("long") for m in signed]), F.col("list") + 1)
    key = F.col("fp").bitwiseAND(mask_of)
    tasks = int(posted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = posted.repartition(tasks, "list", key).sortWithinPartitions("list", key).select("list", "fp")
    mask_array = np.array(masks, dtype=np.uint64)
    owners = _owners(positions, least)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One pass over sorted posting lists; the list cut by a batch end is
        carried on, and from ``list_limit`` entries on passed through."""
        tail_l = np.zeros(0, dtype=np.int32)
        tail_v = np.zeros(0, dtype=np.uint64)
        passing: tuple[int, int] | None = None  # the long list being passed through

        def out(pairs_a, pairs_b, which):
            return pa.record_batch(
                [
                    pa.array(np.asarray(pairs_a, dtype=np.uint64).view(np.int64)),
                    pa.array(np.asarray(pairs_b, dtype=np.uint64).view(np.int64)),
                    pa.array(np.asarray(which, dtype=np.int32)),
                ],
                names=["a", "b", "list"],
            )

        def finish(lists, values):
            """Compare whole posting lists."""
            if not len(values):
                return
            keys = values & mask_array[lists]
            first = np.flatnonzero(
                np.concatenate([[True], (lists[1:] != lists[:-1]) | (keys[1:] != keys[:-1])])
            )
            size = np.diff(np.concatenate([first, [len(values)]]))
            two = first[size == 2]
            two = two[_retained(values[two] ^ values[two + 1], lists[two], owners, max_bits)]
            a, b = [values[two]], [values[two + 1]]
            for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
                group = values[at : at + n]
                if n > list_limit:
                    yield out(group, group, np.full(n, lists[at]))
                    continue
                forest = _forest(group, int(lists[at]), owners, max_bits)
                if forest:
                    pairs = np.array(forest)
                    a.append(group[pairs[:, 0]])
                    b.append(group[pairs[:, 1]])
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                yield out(a, b, np.full(len(a), -1))

        for batch in batches:
            lists = np.concatenate([tail_l, batch.column(0).to_numpy()])
            values = np.concatenate([tail_v, batch.column(1).to_numpy().view(np.uint64)])
            keys = values & mask_array[lists]
            if passing is not None and len(values):
                same = (lists == passing[0]) & (keys == np.uint64(passing[1]))
                if same.any():
                    yield out(values[same], values[same], lists[same])
                lists, values, keys = lists[~same], values[~same], keys[~same]
                passing = passing if not len(values) else None
            if not len(values):
                continue
            start = int(np.argmax((lists == lists[-1]) & (keys == keys[-1])))
            yield from finish(lists[:start], values[:start])
            tail_l, tail_v = lists[start:], values[start:]
            if len(tail_v) > list_limit:
                passing = (int(lists[-1]), int(keys[-1]))
                yield out(tail_v, tail_v, tail_l)
                tail_l, tail_v = tail_l[:0], tail_v[:0]
        yield from finish(tail_l, tail_v)

    return stored(dealt.mapInArrow(compare, "a long, b long, list int"), "simhash-links")


def _long_links(members: DataFrame, positions: list[tuple[int, ...]], max_bits: int) -> DataFrame:
    """Links inside long posting lists, through the values between members."""
    free = [[8 * p + i for p in range(N_BYTES) if p not in c for i in range(8)] for c in positions]
    flips = [
        np.array(
            [sum(1 << b for b in pick) for r in range(max_bits // 2 + 1) for pick in combinations(bits, r)],
            dtype=np.uint64,
        )
        for bits in free
    ]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).to_numpy().view(np.uint64)
            lists = batch.column(0).to_numpy()
            for at in range(0, len(values), 512):
                v, k = values[at : at + 512], lists[at : at + 512]
                points = [x ^ flips[i] for x, i in zip(v, k)]
                n = [len(p) for p in points]
                yield pa.record_batch(
                    [
                        pa.array(np.repeat(k, n)),
                        pa.array(np.repeat(v, n).view(np.int64)),
                        pa.array(np.concatenate(points).view(np.int64)),
                    ],
                    names=["list", "fp", "point"],
                )

    width = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = members.repartition(width).mapInArrow(spread, "list int, fp long, point long")
    # All values around a point are within max_bits of each other: a star
    # around the smallest one links them.
    hub = F.min("fp").over(Window.partitionBy("list", "point"))
    return points.select("fp", hub.alias("hub")).where("fp <> hub").select(
        F.col("hub").alias("a"), F.col("fp").alias("b")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of each connected component of ``a, b``.

    Alternating large and small stars; nodes without a link are not listed.
    Each round is written to the shared folder and replaces the one before, so
    lineage stays short. Hubs meet their smallest neighbour by broadcast.
    """
    big, small = F.greatest("a", "b"), F.least("a", "b")
    rounds, large_stars = (Rounds(edges.sparkSession, name) for name in ("components", "large-stars"))
    now = rounds.put(edges.where("a <> b").select(big.alias("u"), small.alias("v")).distinct())
    mark, n = None, now.count()
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        upper = F.sum((F.col("v") > F.col("u")).cast("int"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), upper.alias("n"))
        large = large_stars.put(
            joined_by(both.where("v > u"), low, "u", "n", n).select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        star = (
            joined_by(large, lowest, "u", "n", n)
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v")))
        )
        now = rounds.put(star.distinct())
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1000000007)).first()
        if tuple(seen) == mark:
            break
        mark, n = tuple(seen), seen[0]
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def roots(nodes: DataFrame, max_bits: int = 4, list_limit: int = 4096) -> DataFrame:
    """``nodes`` (one row per fingerprint ``fp``) with ``root``, the smallest fingerprint of the component."""
    found = components(links(nodes.select("fp"), max_bits, list_limit))
    return nodes.join(found, nodes.fp == found.node, "left").select(*nodes.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, list_limit: int = 4096,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` of every row.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at
    most ``max_bits`` differing bits. Null, empty and blank texts have
    fingerprint 0 and are linked like any other. Repeated rows share their
    fingerprint. A null id is never a component's id unless all of its ids
    are null. An empty table gives no rows.
    """
    rows, rooted = _rooted(docs, shingle, max_bits, list_limit, id_col, text_col)
    rooted = stored(rooted, "simhash-roots")
    n_nodes, n_rows = rooted.agg(F.count(F.lit(1)), F.coalesce(F.sum("copies"), F.lit(0))).first()
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("members"))
    by_fp = stored(
        joined_by(rooted, named, "root", "members", n_nodes).select("fp", "component_id", "copies"), "simhash-named"
    )
    return joined_by(rows, by_fp, "fp", "copies", n_rows).select("doc_id", "fp", "component_id")


def _rooted(docs: DataFrame, shingle: int, max_bits: int, list_limit: int, id_col: str,
            text_col: str) -> tuple[DataFrame, DataFrame]:
    """``doc_id, fp`` of every row, and ``fp, least_id, copies, root`` of every distinct fingerprint."""
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    return rows, roots(nodes, max_bits, list_limit)


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
             text_col: str = "text", keep_null_ids: bool = True) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id (of
    rows that share it, one with the smallest fingerprint).

    All columns stay. Rows are told apart by id and fingerprint, so rows that
    repeat an id but hold different texts are decided one by one. Rows without
    an id are all kept, unless ``keep_null_ids`` is false: then they are rows
    of their groups like any other, and stay only where no row has an id.
    """
    rows, rooted = _rooted(docs, shingle, max_bits, 4096, id_col, text_col)
    first = F.min(F.struct(F.col("least_id").isNull().alias("none"), F.col("least_id").alias("id"), "fp"))
    firsts = stored(
        rooted.groupBy("root").agg(first.alias("k")).select(F.col("k.id").alias("_id"), F.col("k.fp").alias("_first")),
        "simhash-first",
    )
    per_id = (
        rows.where("doc_id is not null")
        .join(firsts, (F.col("doc_id") == F.col("_id")) & (F.col("fp") == F.col("_first")), "left")
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("_first").isNotNull()).alias("first"))
    )
    # Few documents differ from "one row, first of its group"; only they are
    # listed, so the join needs no shuffle of texts when the list is small.
    odd = stored(per_id.where("rows > 1 or not first").withColumnRenamed("doc_id", "_id"), "simhash-odd")
    kept = docs.join(odd, docs[id_col] == odd["_id"], "left_anti")
    twice = odd.where("first")
    # The rows whose id does not tell whether they stay.
    again = None if twice.isEmpty() else docs.join(twice, docs[id_col] == twice["_id"], "left_semi")
    if not keep_null_ids:
        kept = kept.where(F.col(id_col).isNotNull())
        if not rows.where("doc_id is null").isEmpty():
            nameless = docs.where(docs[id_col].isNull())
            again = nameless if again is None else again.unionByName(nameless)
    if again is None:
        return kept
    name = "_fp"
    while name in docs.columns:
        name += "_"
    marked = with_fingerprint(again, text_col, name, shingle)
    mine = marked[id_col].eqNullSafe(firsts["_id"]) & (marked[name] == firsts["_first"])
    once = marked.join(firsts, mine, "left_semi").dropDuplicates([id_col, name]).drop(name)
    return kept.unionByName(once)
