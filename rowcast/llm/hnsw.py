"""Embedding near-dedup over hierarchical navigable small-world graphs.

1. Equal vectors become one class with their number of rows and smallest id.
2. Some classes, even by hash, are landmarks. They are the nodes of the graph:
   a node's level falls off geometrically, each layer links a node with diverse
   near ones, and a search descends from the top layer with a beam. Up to
   ``OUTRIGHT`` nodes a beam as wide as the graph costs less than a search:
   then all nodes are compared in matrix products, and no layers are built.
3. Every class belongs to the cells of its nearest landmarks. How many an audit
   says, of pairs just at the threshold and of links inside a sample: as many as
   it takes for ``TARGET_RECALL`` of them to share a cell. Landmarks of a dense
   group would part its members, so none is nearer to another than a distance
   that the audit chooses too.
4. All pairs inside a cell are compared, whatever its size, and a pair counts in
   the largest cell that it shares. Classes travel there at 16 bits an entry.
5. Cosines that these bits cannot decide are computed from the vectors, in double
   precision, and components are found from links that span each cell's.

For ``n`` vectors there are about ``6 sqrt(n)`` landmarks, so time grows with
``n ** 1.5`` slowly: the products take a few nanoseconds a pair. What is shuffled
grows with ``n``. Links are summed where they are found, never written one by one.
"""

from __future__ import annotations

import gc
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from rowcast.llm.common import Rounds, joined_by, ship, stored
from rowcast.llm.simhash import components
from rowcast.llm.vectors import finite_rows

DEGREE = 16  # links of a node in the upper layers; twice as many in the lowest
BUILD_BEAM = 64
FIRST_BEAM = 64
UPPER_BEAM = 16
BATCH = 512
SEEN_CELLS = 1 << 26  # queries searched at once times nodes of the shard
PROBES = 256
OUTRIGHT = 1 << 17  # nodes up to which a product of all beats a search
TILE = (256, 2048)  # cosines computed at once
LEAST = 1 << 15  # vectors up to which all pairs are compared
LANDMARK_BYTES = 1 << 26
AUDIT = 4096  # vectors of the sample that the audit compares
SPREAD_MOST = 64  # cells of a vector
COPY_COST = 2000  # cosines that take as long as one more copy of a vector
BLOCK = 1 << 15  # members of a cell that are compared in one piece
TASK_BYTES = 1 << 24
PASS_COPIES = 3  # copies of a vector that are shuffled at a time
PASS_LEAST = 1 << 22
TARGET_RECALL = 0.99
# Single precision decides what is verified, with this much to spare.
SLACK = 1e-5


# ------------------------------------------------------------ one shard's graph


def beam_search(near: np.ndarray, unit: np.ndarray, queries: np.ndarray, entries: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes that a best-first search of one layer finds
    for each query, and their cosines, falling; -1 fills up.

    ``near`` holds each node's links (-1: none), ``entries`` each query's first
    nodes. All queries advance together, four nodes of each at a time.
    """
    q, n = len(queries), len(near)
    seen = np.zeros(q * n, dtype=bool)
    ids = np.full((q, beam), -1, dtype=np.int64)
    cosines = np.full((q, beam), -np.inf, dtype=np.float32)
    waiting = np.zeros((q, beam), dtype=bool)

    def offer(flat: np.ndarray) -> None:
        flat = np.unique(flat)
        flat = flat[~seen[flat]]
        seen[flat] = True
        row, node = flat // n, flat % n
        cosine = np.einsum("ij,ij->i", queries[row], unit[node])
        better = cosine > cosines[row, -1]
        row, node, cosine = row[better], node[better], cosine[better]
        if not len(row):
            return
        touched, start, count = np.unique(row, return_index=True, return_counts=True)
        at = (np.repeat(np.arange(len(touched)), count), beam + np.arange(len(row)) - np.repeat(start, count))
        shape = (len(touched), beam + int(count.max()))
        all_cos = np.full(shape, -np.inf, dtype=np.float32)
        all_ids = np.full(shape, -1, dtype=np.int64)
        all_open = np.zeros(shape, dtype=bool)
        all_cos[:, :beam], all_ids[:, :beam], all_open[:, :beam] = cosines[touched], ids[touched], waiting[touched]
        all_cos[at], all_ids[at], all_open[at] = cosine, node, True
        best = np.argsort(-all_cos, axis=1, kind="stable")[:, :beam]
        cosines[touched] = np.take_along_axis(all_cos, best, 1)
        ids[touched] = np.take_along_axis(all_ids, best, 1)
        waiting[touched] = np.take_along_axis(all_open, best, 1)

    row, column = np.nonzero(entries >= 0)
    offer(row * n + entries[row, column])
    active = np.arange(q)
    while True:
        held = waiting[active]
        active, held = active[held.any(axis=1)], held[held.any(axis=1)]
        if not len(active):
            return ids, cosines
        row, column = np.nonzero(held & (np.cumsum(held, axis=1) <= 4))
        row = active[row]
        waiting[row, column] = False
        links = near[ids[row, column]]
        owner = np.repeat(row, links.shape[1])
        links = links.ravel()
        offer(owner[links >= 0] * n + links[links >= 0])


def diverse(unit: np.ndarray, ids: np.ndarray, cosines: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` of each row's candidates (nearest first, -1: none): those
    nearer to the row's own vector than to any chosen before, then the rest."""
    vectors = unit[ids]
    between = vectors @ vectors.transpose(0, 2, 1)
    chosen = np.zeros(ids.shape, dtype=bool)
    for j in range(ids.shape[1]):
        hidden = (chosen[:, :j] & (between[:, j, :j] > cosines[:, j, None])).any(axis=1)
        chosen[:, j] = (ids[:, j] >= 0) & ~hidden
    rank = np.where(ids < 0, 2, np.where(chosen, 0, 1))
    order = np.argsort(rank, axis=1, kind="stable")[:, :degree]
    out = np.full((len(ids), degree), -1, dtype=np.int64)
    out[:, : order.shape[1]] = np.take_along_axis(ids, order, 1)
    return out


def _nearest_first(ids: np.ndarray, cosines: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-cosines, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(cosines, order, 1)


def _link_back(near: np.ndarray, unit: np.ndarray, sources: np.ndarray) -> None:
    """Adds the links of ``sources`` in the other direction, pruned to the degree."""
    degree = near.shape[1]
    targets = near[sources]
    src, dst = np.repeat(sources, degree), targets.ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    order = np.lexsort((-np.einsum("ij,ij->i", unit[src], unit[dst]), dst))
    src, dst = src[order], dst[order]
    nodes, start, count = np.unique(dst, return_index=True, return_counts=True)
    place = np.arange(len(dst)) - np.repeat(start, count)
    row = np.repeat(np.arange(len(nodes)), count)
    close = place < 2 * degree  # the nearest of the new ones
    for a in range(0, len(nodes), BATCH):
        some = nodes[a : a + BATCH]
        here = close & (row >= a) & (row < a + len(some))
        new = np.full((len(some), 2 * degree), -1, dtype=np.int64)
        new[row[here] - a, place[here]] = src[here]
        old = near[some]
        new[(new[:, :, None] == old[:, None, :]).any(axis=2)] = -1
        ids = np.concatenate([old, new], axis=1)
        cosines = np.einsum("ijk,ik->ij", unit[ids], unit[some])
        cosines[ids < 0] = -np.inf
        near[some] = diverse(unit, *_nearest_first(ids, cosines, 2 * degree), degree)


def _hits(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the true entries, eight entries looked at together."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    at = (words[:, None] * 8 + np.arange(8)).ravel()
    at = np.concatenate([at[flat[at]], whole + np.flatnonzero(flat[whole:])])
    return at // mask.shape[1], at % mask.shape[1]


def all_nearest(unit: np.ndarray, queries: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` nearest of ``unit`` (which has as many) to each query, by
    falling cosine. The best of groups of them bound from below what can be one."""
    out = np.empty((len(queries), count), dtype=np.int64)
    for a in range(0, len(queries), TILE[0]):
        some = queries[a : a + TILE[0]]
        least, best = np.full(len(some), -np.inf, dtype=np.float32), np.zeros((len(some), 0), dtype=np.float32)
        found = []
        for b in range(0, len(unit), TILE[1]):
            cosines = some @ unit[b : b + TILE[1]].T
            groups = cosines
            while groups.shape[1] >= max(128, 2 * count):
                half = groups.shape[1] // 2
                groups = np.maximum(groups[:, :half], groups[:, half : 2 * half])
            best = np.concatenate([best, groups], axis=1)
            if best.shape[1] >= count:
                best = -np.partition(-best, count - 1, axis=1)[:, :count]
                least = best[:, -1]
            row, column = _hits(cosines >= least[:, None])
            found.append((row, column + b, cosines[row, column]))
        row, node, cosine = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-cosine, row))
        row, node = row[order], node[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        out[a : a + len(some)] = node[place < count].reshape(len(some), count)
    return out


class Graph:
    """The layers of a set of nodes, none where all of them are compared. Nodes are
    numbered by falling level, so layer ``k`` consists of the first
    ``len(layers[k])`` nodes."""

    def __init__(self, unit: np.ndarray, layers: list[np.ndarray], beam: int = FIRST_BEAM):
        self.unit, self.layers, self.beam = unit, layers, beam
        self.stray = self._unreached() if layers else np.zeros(0, dtype=np.int64)

    @classmethod
    def of(cls, unit: np.ndarray, threshold: float) -> Graph:
        """The graph of vectors in random order; up to ``OUTRIGHT`` without layers."""
        n = len(unit)
        if n <= OUTRIGHT:
            return cls(unit, [], n)
        return cls.build(unit, np.floor(np.log((n + 1) / np.arange(1, n + 1)) / math.log(DEGREE)).astype(np.int64), threshold)

    @classmethod
    def build(cls, unit: np.ndarray, levels: np.ndarray, threshold: float) -> Graph:
        """The graph of the vectors ``unit``, whose ``levels`` fall, audited."""
        layers: list[np.ndarray] = []
        for level in range(int(levels.max()), -1, -1):
            size = int((levels >= level).sum())
            layers.insert(0, cls._layer(unit[:size], DEGREE if level else 2 * DEGREE, layers))
        graph = cls(unit, layers)
        graph.audit(threshold)
        return graph

    @classmethod
    def _layer(cls, unit: np.ndarray, degree: int, upper: list[np.ndarray]) -> np.ndarray:
        near = np.full((len(unit), degree), -1, dtype=np.int64)
        done = 0
        while done < len(unit):
            batch = np.arange(done, min(len(unit), done + max(BATCH // 2, min(BATCH, done))))
            vectors = unit[batch]
            own = vectors @ vectors.T
            np.fill_diagonal(own, -np.inf)
            pool = min(2 * degree, len(batch) - 1)
            ids = np.argsort(-own, axis=1, kind="stable")[:, :pool]
            cosines = np.take_along_axis(own, ids, 1)
            ids = ids + done
            if done:
                entries = cls._descend(unit, upper, vectors)
                entries[entries >= done] = -1
                entries = np.column_stack([entries, np.zeros(len(batch), dtype=np.int64)])
                found, there = beam_search(near[:done], unit[:done], vectors, entries, min(BUILD_BEAM, done))
                ids, cosines = np.concatenate([ids, found], axis=1), np.concatenate([cosines, there], axis=1)
            if ids.shape[1]:
                near[batch] = diverse(unit, *_nearest_first(ids, cosines, 3 * degree), degree)
                _link_back(near, unit, batch)
            done = batch[-1] + 1
        return near

    @staticmethod
    def _descend(unit: np.ndarray, upper: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
        """Entry nodes for the layer below ``upper``."""
        entries = np.zeros((len(queries), 1), dtype=np.int64)
        for near in reversed(upper):
            ids, _ = beam_search(near, unit[: len(near)], queries, entries, min(UPPER_BEAM, len(near)))
            entries = ids[:, :4]
        return entries

    def _unreached(self) -> np.ndarray:
        """Nodes that no path from node 0 reaches in the lowest layer; a search
        compares them one by one."""
        near = self.layers[0]
        reached = np.zeros(len(near), dtype=bool)
        frontier = np.zeros(1, dtype=np.int64)
        while len(frontier):
            reached[frontier] = True
            links = np.unique(near[frontier])
            links = links[links >= 0]
            frontier = links[~reached[links]]
        return np.flatnonzero(~reached)

    def nearest(self, queries: np.ndarray, count: int) -> np.ndarray:
        """About the ``count`` nearest nodes (there are as many) to each query, by
        falling cosine; -1 where a search finds fewer."""
        n = len(self.unit)
        if self.beam >= n:
            return all_nearest(self.unit, queries, count)
        step = max(16, min(BATCH, SEEN_CELLS // n))
        out = np.full((len(queries), count), -1, dtype=np.int64)
        for a in range(0, len(queries), step):
            some = queries[a : a + step]
            entries = self._descend(self.unit, self.layers[1:], some)
            ids, cosines = beam_search(self.layers[0], self.unit, some, entries, max(count, self.beam))
            ids = np.concatenate([ids, np.tile(self.stray, (len(some), 1))], axis=1)
            cosines = np.concatenate([cosines, some @ self.unit[self.stray].T], axis=1)
            out[a : a + step] = _nearest_first(ids, cosines, count)[0]
        return out

    def links(self, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of ``queries`` and nodes whose cosine is about the
        threshold or more."""
        least, n = threshold - SLACK, len(self.unit)
        step = max(16, min(BATCH, SEEN_CELLS // n))
        rows, nodes = [], []
        for a in range(0, len(queries), step):
            left, beam = np.arange(a, min(a + step, len(queries))), self.beam
            if len(self.stray):
                r, c = np.nonzero(queries[left] @ self.unit[self.stray].T >= least)
                rows.append(left[r])
                nodes.append(self.stray[c])
            entries = self._descend(self.unit, self.layers[1:], queries[left]) if beam < n else None
            while len(left):
                if beam >= n:
                    r, c = np.nonzero(queries[left] @ self.unit.T >= least)
                    rows.append(left[r])
                    nodes.append(c)
                    break
                ids, cosines = beam_search(self.layers[0], self.unit, queries[left], entries, beam)
                full = cosines[:, -1] >= least
                r, c = np.nonzero((cosines >= least) & ~full[:, None])
                rows.append(left[r])
                nodes.append(ids[r, c])
                left, entries, beam = left[full], entries[full], 2 * beam
        pairs = np.unique(np.concatenate(rows) * n + np.concatenate(nodes)) if rows else np.zeros(0, dtype=np.int64)
        return pairs // n, pairs % n

    def audit(self, threshold: float) -> None:
        """Doubles the beam until probes at the threshold find the nodes that a
        plain comparison finds, up to ``TARGET_RECALL``."""
        n = len(self.unit)
        at = np.unique(np.linspace(0, n - 1, min(n, PROBES)).astype(np.int64))
        rng = np.random.default_rng(n)
        aside = rng.standard_normal((len(at), self.unit.shape[1]))
        aside -= np.einsum("ij,ij->i", aside, self.unit[at])[:, None] * self.unit[at]
        size = np.linalg.norm(aside, axis=1, keepdims=True)
        aside = np.divide(aside, size, out=np.zeros_like(aside), where=size > 0)
        probes = (threshold * self.unit[at] + math.sqrt(max(0.0, 1 - threshold * threshold)) * aside).astype(np.float32)
        true = int((probes @ self.unit.T >= threshold - SLACK).sum())
        while self.beam < n and len(self.links(probes, threshold)[0]) < TARGET_RECALL * true:
            self.beam *= 2


# ------------------------------------------------------------ over tables


def _as_unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double; their largest entry first, so that
    no square over- or underflows."""
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=kind).reshape(len(column), -1).astype(float)


def _forget(spark: SparkSession) -> None:
    """Spark deletes the files of shuffles that are over once the driver has
    collected its garbage; by itself it may not do so before the disk is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def classes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, Rounds, str]:
    """``vec_id, key`` of every row (null key: it links with nothing); where
    ``key, raw, least_id, copies, node`` of every distinct vector are kept; and
    how ``raw`` is encoded: single precision where the column is, else double."""
    ship(vectors.sparkSession)
    kind = "<f4" if vectors.schema[vector_col].dataType.elementType.simpleString() == "float" else "<f8"
    id_kind = vectors.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, entries = finite_rows(batch.column(1))
            raw: list[bytes | None] = [None] * batch.num_rows
            there = (entries != 0).any(axis=1)
            kept = (entries[there] + 0.0).astype(kind)  # -0.0 becomes 0.0
            for row, vector in zip(rows[there].tolist(), kept):
                raw[row] = vector.tobytes()
            keys = [None if r is None else hashlib.sha256(r).digest() for r in raw]
            yield pa.record_batch([batch.column(0), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())],
                                  names=["vec_id", "key", "raw"])

    narrow = vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].alias("v"))
    kept_rows, kept_classes = (Rounds(vectors.sparkSession, name) for name in ("hnsw-rows", "hnsw-classes"))
    rows = kept_rows.put(narrow.mapInArrow(read, f"vec_id {id_kind}, key binary, raw binary"))
    found = rows.where("key is not null").groupBy("key").agg(
        F.first("raw").alias("raw"), F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies")
    )
    kept_classes.put(found.withColumn("node", F.monotonically_increasing_id()))
    names = kept_rows.put(rows.select("vec_id", "key"))
    _forget(vectors.sparkSession)
    return names, kept_classes, kind


def shard_count(n: int) -> int:
    """Cells for ``n`` vectors before the audit: ``6 sqrt(n)``, or one for few."""
    return 1 if n <= LEAST else math.ceil(6 * math.sqrt(n))


# ------------------------------------------------------------ landmarks and cells


def _apart(unit: np.ndarray, most: float) -> np.ndarray:
    """``unit`` without vectors whose cosine with one kept before is ``most`` or more."""
    kept = unit[:0]
    for a in range(0, len(unit), TILE[0]):
        some = unit[a : a + TILE[0]]
        for b in range(0, len(kept), TILE[1]):
            some = some[~(some @ kept[b : b + TILE[1]].T >= most).any(axis=1)]
        near = np.tril(some @ some.T >= most, -1)
        stays = ~near.any(axis=1)
        for i in np.flatnonzero(~stays):
            stays[i] = not (near[i] & stays).any()
        kept = np.concatenate([kept, some[stays]])
    return kept


def _probes(unit: np.ndarray, threshold: float) -> list[np.ndarray]:
    """For each of ``unit`` a vector just at the threshold in a random direction,
    and one in the direction of another of them."""
    rng = np.random.default_rng(len(unit))
    out = []
    for aside in (rng.standard_normal(unit.shape), np.roll(unit, 1, axis=0).astype(float)):
        aside -= np.einsum("ij,ij->i", aside, unit)[:, None] * unit
        size = np.linalg.norm(aside, axis=1, keepdims=True)
        aside = np.divide(aside, size, out=np.zeros_like(aside), where=size > 1e-6)
        out.append((threshold * unit + math.sqrt(max(0.0, 1 - threshold * threshold)) * aside).astype(np.float32))
    return out


def _needed(a: np.ndarray, b: np.ndarray) -> int:
    """How many of the nearest landmarks (rows of ``a`` and ``b``, by pair) must
    be taken so that ``TARGET_RECALL`` of the pairs share one; one more than are
    there if these do not do."""
    if not len(a):
        return 1
    none = a.shape[1] + 1
    rank = np.maximum.outer(np.arange(1, none), np.arange(1, none)).astype(np.int16)
    need = []
    for i in range(0, len(a), 256):
        x, y = a[i : i + 256, :, None], b[i : i + 256, None, :]
        need.append(np.where((x == y) & (x >= 0), rank, np.int16(none)).min(axis=(1, 2)))
    return int(np.sort(np.concatenate(need))[math.ceil(TARGET_RECALL * len(a)) - 1])


@dataclass(frozen=True)
class Cells:
    """The cells of a vector: those of the ``count`` nearest nodes of ``graph``
    (None: one cell for all), or of the nearest one alone if its cosine is at
    least ``alone``."""

    graph: Graph | None = None
    count: int = 1
    alone: float = math.inf

    def of(self, unit: np.ndarray) -> np.ndarray:
        """The cells of each row, nearest first; -1 fills up."""
        if self.graph is None:
            return np.zeros((len(unit), 1), dtype=np.int64)
        near = self.graph.nearest(unit, self.count)
        close = np.einsum("ij,ij->i", unit, self.graph.unit[near[:, 0]]) >= self.alone
        near[close, 1:] = -1
        return near


def audited(nodes: np.ndarray, sample: np.ndarray, n: int, threshold: float) -> Cells:
    """Cells around some of ``nodes``: of those with which the pairs around
    ``sample`` pass, the ones that are expected to cost least for ``n`` vectors.

    With landmarks at least twice the threshold's angle apart, a vector within
    half that angle of one belongs to this cell alone: a vector that it links
    with cannot belong to another one alone. So the members of a dense group,
    which have the same landmarks around them, meet once and not in each cell.
    """
    some = sample[: 4 * PROBES]
    probes = _probes(some, threshold)
    everything = np.concatenate([sample, *probes])
    row, column = np.nonzero(np.triu(sample @ sample.T >= threshold, 1))
    linked = np.unique(np.linspace(0, max(0, len(row) - 1), min(len(row), 8 * PROBES)).astype(np.int64))
    best, least = Cells(), n / 2
    for size in sorted({len(nodes) >> shift for shift in (0, 2, 4, 6)} - {0}, reverse=True):
        before = 0
        for most, alone in ((2 * threshold * threshold - 1, math.sqrt((1 + threshold) / 2)), (threshold, math.inf)):
            unit = _apart(nodes[:size], most)
            if len(unit) >= least or len(unit) == before:  # dear however few cells a vector has, or known
                continue
            before, graph = len(unit), Graph.of(unit, threshold)
            for tried in (16, SPREAD_MOST):
                near = Cells(graph, min(len(unit), tried), alone).of(everything)
                own, asides = near[: len(sample)], np.split(near[len(sample) :], len(probes))
                count = max(_needed(own[: len(some)], x) for x in asides)
                count = max(count, _needed(own[row[linked]], own[column[linked]]))
                if count <= near.shape[1]:
                    break
            else:
                continue
            chosen = own[:, :count]
            cells = np.bincount(chosen[chosen >= 0]).astype(float)
            pairs = (cells * (cells - 1)).sum() / 2 * n / len(sample) ** 2
            cost = len(unit) + pairs + COPY_COST * count
            if cost < least:
                best, least = Cells(graph, count, alone), cost
    return best


def landmarks(distinct: DataFrame, n: int, width: int, kind: str, threshold: float) -> Cells:
    """:func:`audited`, of the vectors with the smallest hashes; the next ones are the sample."""
    most = min(shard_count(n), max(1, LANDMARK_BYTES // (4 * width)))
    if most == 1:
        return Cells()
    wanted = most + AUDIT
    share = min(1.0, (wanted + 6 * math.sqrt(wanted)) / n)
    spread = F.shiftrightunsigned(F.xxhash64("key"), 1)
    rows = distinct.select(spread.alias("spread"), "raw").where(F.col("spread") <= min(2**63 - 1, int(share * 2**63))).collect()
    raw = [bytes(r.raw) for r in sorted(rows, key=lambda r: (r.spread, r.raw))]
    unit = _as_unit(np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(float)).astype(np.float32)
    return audited(unit[:most], unit[most : most + AUDIT] if len(unit) > most + PROBES else unit[-AUDIT:], n, threshold)


def routed(distinct: DataFrame, cells: Cells, kind: str) -> DataFrame:
    """``distinct`` with ``cells``, the numbers of each vector's cells."""
    shared = distinct.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = shared.value.of(_as_unit(_matrix(batch.column("raw"), kind)).astype(np.float32))
            ends = np.concatenate([[0], (at >= 0).sum(axis=1).cumsum()]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(at[at >= 0].astype(np.int32)))
            yield pa.record_batch([*batch.columns, lists], names=[*batch.schema.names, "cells"])

    return distinct.mapInArrow(run, StructType([*distinct.schema.fields, StructField("cells", ArrayType(IntegerType()))]))


# ------------------------------------------------------------ links inside cells


def _joined(label: np.ndarray, row: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the links ``row, column`` that join components, and no others;
    ``label`` has each node's component and is brought up to date."""
    rows, columns = [row[:0]], [column[:0]]
    while True:
        a, b = label[row], label[column]
        row, column, a, b = (x[a != b] for x in (row, column, a, b))
        if not len(row):
            return np.concatenate(rows), np.concatenate(columns)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        # One link of each component in each direction: all of them shrink.
        picked = np.union1d(np.unique(a, return_index=True)[1], np.unique(b, return_index=True)[1])
        for i in picked.tolist():
            x, y = root(int(a[i])), root(int(b[i]))
            if x != y:
                parent[x] = y
                rows.append(row[i : i + 1])
                columns.append(column[i : i + 1])
        new = np.arange(len(label))
        names = list(parent)
        new[names] = [root(x) for x in names]
        label[:] = new[label]


def _record(width: int, count: int) -> np.dtype:
    """A class as a member of a cell: ``lower`` has its cells before that one
    (the larger ones), -1 fills up; ``code`` times ``scale`` is the vector of length one."""
    return np.dtype([
        ("unit", "<i4"), ("own", "<i4"), ("other", "<i4"), ("scale", "<f4"), ("copies", "<i8"), ("node", "<i8"),
        ("lower", "<i4", (max(1, count - 1),)), ("code", "<i2", (width,)),
    ])


def _compared(members: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """``kind, a, b, more``: of one piece of work. Kind 0: node ``a`` has links
    with ``more`` rows; 1: a link that joins components; 2: a link or not,
    which 16 bits an entry cannot say.

    Members of a block are compared with each other if their own block is the
    other one too, else with those of the other block.
    """
    width = members["code"].shape[1]
    same = members["own"][0] == members["other"][0]
    unit = members["code"] * members["scale"][:, None]
    # An entry is off by half a scale at most, so a vector by this much, and a cosine by ``band``.
    off = float(members["scale"].max()) * (0.51 * math.sqrt(width))
    band = 2 * off + off * off + max(SLACK, width * 2.0**-22)
    ids = np.arange(len(members))
    first = members["own"] <= members["other"]
    left, right = (ids, ids) if same else (ids[first], ids[~first])
    label, more = ids.copy(), np.zeros(len(ids), dtype=np.int64)
    copies, node = members["copies"], members["node"]
    lower = members["lower"][:, : int((members["lower"] >= 0).sum(axis=1).max())]
    out = [[], [], []]
    for i in range(0, len(left), TILE[0]):
        l = left[i : i + TILE[0]]
        for j in range(i if same else 0, len(right), TILE[1]):
            r = right[j : j + TILE[1]]
            cosines = unit[l[0] : l[-1] + 1] @ unit[r[0] : r[-1] + 1].T if same else unit[l] @ unit[r].T
            a, b = _hits(cosines >= np.float32(threshold - band))
            cosine, a, b = cosines[a, b], l[a], r[b]
            if same:
                cosine, a, b = (x[a < b] for x in (cosine, a, b))
            for at in range(0, len(a), 1 << 16):
                c, x, y = (v[at : at + (1 << 16)] for v in (cosine, a, b))
                if lower.shape[1]:
                    mine, theirs = lower[x], lower[y]
                    again = ((mine[:, :, None] == theirs[:, None, :]) & (mine >= 0)[:, :, None]).any(axis=(1, 2))
                    c, x, y = c[~again], x[~again], y[~again]
                true = c > threshold + band
                out[0].append(node[x[~true]])
                out[1].append(node[y[~true]])
                out[2].append(np.full(int((~true).sum()), 2))
                x, y = x[true], y[true]
                more += np.bincount(x, copies[y], len(ids)).astype(np.int64) + np.bincount(y, copies[x], len(ids)).astype(np.int64)
                x, y = _joined(label, x, y)
                out[0].append(node[x])
                out[1].append(node[y])
                out[2].append(np.full(len(x), 1))
    some = np.flatnonzero(more)
    a, b, kind = (np.concatenate([np.zeros(0, dtype=np.int64), *v]) for v in out)
    a, b = np.minimum(a, b), np.maximum(a, b)
    none = np.zeros(len(some), dtype=np.int64)
    return (np.concatenate([none, kind]), np.concatenate([node[some], a]), np.concatenate([none, b]),
            np.concatenate([more[some], np.zeros(len(a), dtype=np.int64)]))


def linked(asked: DataFrame, n: int, width: int, count: int, kind: str, threshold: float) -> DataFrame:
    """``kind, a, b, more`` (see :func:`_compared`) of all cells of :func:`routed`.

    A cell of more than a block's members is compared block with block. Pieces
    of work follow each other in tasks of about as many bytes, and tasks in
    passes, so that only a few copies of each vector are shuffled at a time.
    """
    spark = asked.sparkSession
    record = _record(width, count)
    found = asked.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()
    found.sort(key=lambda r: (-r.n, r.cell))  # large cells come first: a dense group's pairs count in one
    number = np.zeros(max(r.cell for r in found) + 1, dtype=np.int64)
    number[[r.cell for r in found]] = np.arange(len(found))
    members = np.array([r.n for r in found])
    total = int(members.sum())
    block = max(1, min(BLOCK, TASK_BYTES // (2 * width), max(LEAST // 8, total // 16)))
    blocks = np.maximum(1, -(-members // block))
    start = np.concatenate([[0], np.cumsum(blocks * (blocks + 1) // 2)])
    # Each piece's cost: the bytes of its members, and its cosines as bytes.
    per_block = np.repeat(members / blocks, np.diff(start))
    copies = np.where(np.repeat(blocks, np.diff(start)) > 1, 2, 1) * per_block
    cost = np.cumsum(copies * record.itemsize + copies * per_block / 16)
    tasks = max(min(12, len(cost)), math.ceil(cost[-1] / TASK_BYTES))
    task_of = np.minimum(tasks - 1, (cost - cost[0]) / max(1.0, cost[-1] - cost[0]) * tasks).astype(np.int32)
    shuffled = copies.sum()
    passes = math.ceil(shuffled / (PASS_COPIES * n)) if shuffled > PASS_LEAST else 1
    shared = spark.sparkContext.broadcast((number, blocks, start, task_of))

    def deal(low: int, high: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, blocks, start, task_of = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                lists = batch.column("cells")
                length = np.diff(lists.offsets.to_numpy())
                cell = number[lists.flatten().to_numpy()]
                row = np.repeat(np.arange(len(length)), length)
                cell = cell[np.lexsort((cell, row))]
                place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
                padded = np.full((len(length), record["lower"].shape[0]), -1, dtype=np.int32)
                early = place < padded.shape[1]
                padded[row[early], place[early]] = cell[early]
                node = batch.column("node").to_numpy()
                many = blocks[cell]
                own = (node[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % many
                at = np.repeat(np.arange(len(cell)), many)
                other = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
                i, j = np.minimum(own[at], other), np.maximum(own[at], other)
                piece = start[cell[at]] + i * many[at] - i * (i - 1) // 2 + j - i
                task = task_of[piece]
                order = np.argsort(task, kind="stable")
                order = order[(task[order] >= low) & (task[order] < high)]
                if not len(order):
                    continue
                unit = _as_unit(_matrix(batch.column("raw"), kind))
                scale = (np.abs(unit).max(axis=1) / 32767).astype(np.float32)
                code = np.rint(unit / scale[:, None]).astype(np.int16)
                for part in np.array_split(order, -(-len(order) * record.itemsize // TASK_BYTES)):
                    of, out = row[at[part]], np.zeros(len(part), dtype=record)
                    out["unit"], out["own"], out["other"] = piece[part], own[at[part]], other[part]
                    out["scale"], out["code"], out["node"] = scale[of], code[of], node[of]
                    out["copies"] = batch.column("copies").to_numpy()[of]
                    before = np.arange(padded.shape[1]) < place[at[part]][:, None]
                    out["lower"] = np.where(before, padded[of], -1)
                    cut = np.flatnonzero(np.diff(task[part], prepend=-1))
                    ends = np.append(cut, len(part)).astype(np.int32) * record.itemsize
                    data = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(ends), pa.py_buffer(out.tobytes())])
                    yield pa.record_batch([pa.array(task[part][cut], pa.int32()), data], names=["task", "data"])
        return run

    def compare(table: pa.Table) -> pa.Table:
        members = np.frombuffer(b"".join(table["data"].to_pylist()), record)
        members = members[np.lexsort((members["node"], members["unit"]))]
        pieces = np.split(members, np.flatnonzero(np.diff(members["unit"])) + 1)
        parts = zip(*(_compared(x, threshold) for x in pieces))
        return pa.table({name: np.concatenate(x) for name, x in zip(("kind", "a", "b", "more"), parts)})

    made = None
    for k in range(passes):
        low, high = tasks * k // passes, tasks * (k + 1) // passes
        if low == high:
            continue
        dealt = asked.select("raw", "node", "copies", "cells").mapInArrow(deal(low, high), "task int, data binary")
        part = stored(dealt.repartition(high - low, "task").groupBy("task").applyInArrow(
            compare, "kind long, a long, b long, more long"), "hnsw-links")
        made = part if made is None else made.unionByName(part)
        _forget(spark)
    return made


def decided(links: DataFrame, asked: DataFrame, kind: str, threshold: float) -> DataFrame:
    """``links`` with kinds 0 and 1 only: those of kind 2 are decided in double precision."""
    doubtful = links.where("kind = 2").select("a", "b")
    sure = links.where("kind < 2")
    if doubtful.isEmpty():
        return sure
    a, b = (asked.select(F.col("node").alias(x), F.col("raw").alias(f"raw_{x}"), F.col("copies").alias(f"copies_{x}")) for x in "ab")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_as_unit(_matrix(batch.column(f"raw_{x}"), kind)) if batch.num_rows else np.zeros((0, 1)) for x in "ab")
            true = pa.array(np.einsum("ij,ij->i", left, right) >= threshold)
            yield batch.select(["a", "b", "copies_a", "copies_b"]).filter(true)

    pairs = doubtful.join(a, "a").join(b, "b").select("a", "b", "raw_a", "raw_b", "copies_a", "copies_b")
    true = stored(pairs.mapInArrow(check, "a long, b long, copies_a long, copies_b long"), "hnsw-decided")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    rows = F.explode(F.array(
        F.struct(zero.alias("kind"), F.col("a").alias("a"), zero.alias("b"), F.col("copies_b").alias("more")),
        F.struct(zero.alias("kind"), F.col("b").alias("a"), zero.alias("b"), F.col("copies_a").alias("more")),
        F.struct(one.alias("kind"), F.col("a").alias("a"), F.col("b").alias("b"), zero.alias("more")),
    )).alias("r")
    return sure.unionByName(true.select(rows).select("r.*"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Rows link whose vectors have a cosine of at least ``threshold``, computed
    in double precision; ``n_links`` counts the other rows. ``component_id`` is
    the smallest id reachable. Null, empty and zero vectors and those that hold
    null or non-finite entries link with nothing. Repeated rows, and rows with
    equal vectors, are linked like any other; their number costs nothing. A
    null id is a component's id only if all of its ids are null, and is kept
    then. Vectors of different lengths raise. An empty table gives no rows.
    Other columns do not matter.
    """
    rows, kept, kind = classes(vectors, id_col, vector_col)
    distinct = vectors.sparkSession.read.parquet(kept.path)
    n, total, short, long = distinct.agg(
        F.count(F.lit(1)), F.sum("copies"), F.min(F.length("raw")), F.max(F.length("raw"))
    ).first()
    if short != long:
        raise ValueError(f"vectors of different lengths: {short // int(kind[-1])} and {long // int(kind[-1])}")
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    width = short // int(kind[-1])
    cells = landmarks(distinct, n, width, kind, threshold)
    distinct = kept.put(routed(distinct, cells, kind))
    links = decided(linked(distinct, n, width, cells.count, kind, threshold), distinct, kind, threshold)
    degrees = links.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("more").alias("more"))
    found = components(links.where("kind = 1").select("a", "b"))
    rooted = stored(
        distinct.drop("raw", "cells").join(degrees, "node", "left").join(found, "node", "left")
        .withColumn("root", F.coalesce("root", "node")),
        "hnsw-rooted",
    )
    names = stored(
        rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("members")), "hnsw-names"
    )
    n_links = (F.coalesce("more", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    per_class = stored(
        joined_by(rooted, names, "root", "members", n).select("key", n_links, "component_id", "copies"), "hnsw-result"
    )
    usable = joined_by(rows.where("key is not null"), per_class, "key", "copies", total)
    alone = rows.where("key is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return usable.select("vec_id", "n_links", "component_id").unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
