"""Sharding by minimax contiguous partition (DataFrame functions only).

Equal texts form one atomic group. Groups are ordered by the SHA-256 of their
text, so a shard is a contiguous range of digests: a well-mixed sample of the
corpus that does not depend on the order of the input. The smallest capacity
``C`` for which a greedy walk over the ordered sizes needs at most
``shards`` shards is searched, and the cuts are made under that capacity.

The search never brings group sizes to the driver. A table of prefix sums is
written once, sorted by them. The driver knows it as cells: of neighbouring
sums the least, the largest and their number, a bounded count of cells however
many groups there are. A greedy walk over cells gives the least and the most a
capacity can reach; where that leaves a capacity open, the cells that its walk
meets are read again in finer steps. A few such rounds settle the search, each
of them one job over the part of the table still in question.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowcast.llm.common import joined_by, stored

HEADER_BYTES = 8
GROUPS_PER_BUCKET = 20_000
ROWS_PER_SLICE = 20_000
CELLS = 1 << 16  # cells a round brings to the driver, about
RANGES = 48  # ranges of the prefix table a round reads, at most
LEAST, MOST = 0, 1  # the two ends of what a lookup may give


def sized_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, digest`` of every row. A null text is an
    empty one (size 8, crc 0) and shares its group."""
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return rows.select(
        "doc_id",
        (F.octet_length("text") + F.lit(HEADER_BYTES)).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.sha2("text", 256).alias("digest"),
    )


def _above(value: Column, cuts: list[int]) -> Column:
    """How many of ``cuts`` lie below ``value``."""
    if not cuts:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [F.when(value > F.lit(c), 1).otherwise(0) for c in cuts])


def prefix_sums(groups: DataFrame, n_groups: int) -> DataFrame:
    """``digest, size, copies, prefix``: running sum of ``size`` in digest order.

    Buckets are ranges of digests (their first hex digits), each sorted on
    its own; only bucket totals meet in one window. Groups are distinct
    digests, so no bucket is hot. Rows are dealt by ranges of buckets, so a
    file of the written table holds one stretch of prefix sums.
    """
    digits = 1
    while 16**digits * GROUPS_PER_BUCKET < n_groups:
        digits += 1
    cut = groups.withColumn("bucket", F.substring("digest", 1, digits))
    totals = cut.groupBy("bucket").agg(F.sum("size").alias("total"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("bucket").orderBy("digest").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    dealt = cut.repartitionByRange("bucket").withColumn("inner", F.sum("size").over(inside))
    return dealt.join(F.broadcast(base), "bucket").select(
        "digest", "size", "copies", (F.col("base") + F.col("inner")).alias("prefix")
    )


class Cells:
    """The prefix sums as far as the driver knows them: per cell the least,
    the largest and the number of its sums, in order."""

    def __init__(self, prefixes: DataFrame, total: int, cells: int = CELLS):
        self.prefixes, self.total, self.cells = prefixes, total, cells
        self.rows = self._read([(1, total)], max(1, -(-total // cells)))
        self._index()

    def _index(self) -> None:
        self.starts = [least for least, _, _ in self.rows]

    def _read(self, ranges: list[tuple[int, int]], width: int) -> list[tuple[int, int, int]]:
        """The cells of ``width`` inside each of a few disjoint ranges."""
        self.width, p = width, F.col("prefix")
        within = reduce(lambda x, y: x | y, [p.between(a, b) for a, b in ranges])
        found = (
            self.prefixes.where(within)
            .groupBy(_above(p, [b for _, b in ranges]).alias("r"), F.floor(p / F.lit(width)).alias("c"))
            .agg(F.min("prefix").alias("least"), F.max("prefix").alias("most"), F.count(F.lit(1)).alias("n"))
        )
        return sorted((r["least"], r["most"], r["n"]) for r in found.collect())

    def _at(self, target: int) -> int:
        return bisect_right(self.starts, target) - 1

    def _open(self, i: int, target: int) -> bool:
        """Whether sums that lie inside cell ``i`` decide a lookup of ``target``."""
        return i >= 0 and target < self.rows[i][1] and self.rows[i][2] > 2

    def below(self, target: int) -> tuple[int, int]:
        """Bounds on the largest prefix sum not above ``target`` (0 if none)."""
        i = self._at(target)
        if i < 0:
            return 0, 0
        least, most, _ = self.rows[i]
        if target >= most:
            return most, most
        return (least, target) if self._open(i, target) else (least, least)

    def above(self, target: int) -> int:
        """The smallest prefix sum above ``target``; a bound where :meth:`unsure`."""
        i = self._at(target)
        if i >= 0 and target < self.rows[i][1]:
            return self.rows[i][1]
        return self.starts[i + 1] if i + 1 < len(self.starts) else self.total

    def unsure(self, target: int) -> bool:
        return self._open(self._at(target), target)

    def walk(self, capacity: int, shards: int, end: int) -> list[int]:
        """Ends of the shards of a greedy walk, each the least or the most possible."""
        x, ends = 0, []
        while x < self.total and len(ends) < shards:
            x = self.below(x + capacity)[end]
            ends.append(x)
        return ends

    def refine(self, windows: list[tuple[int, int]]) -> None:
        """Read the cells that lookups in ``windows`` meet again in finer steps."""
        chosen: set[int] = set()
        for a, b in windows:
            chosen.update(i for i in range(max(self._at(a), 0), self._at(b) + 1) if self.rows[i][2] > 2)
        if not chosen:
            return
        runs: list[list[int]] = []
        for i in sorted(chosen):
            if runs and runs[-1][1] == i - 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
        while len(runs) > RANGES:  # close the smallest gap
            gap = min(range(1, len(runs)), key=lambda k: self.rows[runs[k][0]][0] - self.rows[runs[k - 1][1]][1])
            runs[gap - 1 : gap + 1] = [[runs[gap - 1][0], runs[gap][1]]]
        ranges = [(self.rows[i][0], self.rows[j][1]) for i, j in runs]
        span = max(self.rows[i][1] - self.rows[i][0] + 1 for i in chosen)
        width = max(1, min(-(-sum(b - a + 1 for a, b in ranges) // self.cells), -(-span // 2)))
        inside = {k for i, j in runs for k in range(i, j + 1)}
        kept = [row for i, row in enumerate(self.rows) if i not in inside]
        self.rows = sorted(kept + self._read(ranges, width))
        self._index()


def _first(low: int, high: int, holds) -> int:
    """The smallest number from ``low`` on that holds, ``high`` if none below does."""
    while low < high:
        mid = (low + high) // 2
        if holds(mid):
            high = mid
        else:
            low = mid + 1
    return high


def smallest_capacity(cells: Cells, shards: int, largest: int) -> int:
    """The smallest capacity with which a greedy walk needs ``shards`` shards.

    A binary search with the most that walks can reach gives a lower bound,
    one with the least an upper bound; finer cells bring the two together.
    """
    total = cells.total
    low = max(largest, -(-total // shards))
    high = min(total, total // shards + largest)  # always feasible
    while True:
        low = _first(low, high, lambda c: cells.walk(c, shards, MOST)[-1] >= total)
        high = _first(low, high, lambda c: cells.walk(c, shards, LEAST)[-1] >= total)
        if low == high:
            return low
        from_, to = [0, *cells.walk(low, shards, LEAST)], [0, *cells.walk(high, shards, MOST)]
        to += [total] * (len(from_) - len(to))
        cells.refine([(a + low, b + high) for a, b in zip(from_, to)])


def cut_points(cells: Cells, shards: int, capacity: int, big: list[int]) -> list[int]:
    """End prefix of each shard: no shard above ``capacity``, and inside that
    bound each cut as near as possible to an even share.

    A plain greedy cut would fill every shard to a capacity that one huge
    group dictates and leave the last shards empty. ``big`` holds the groups
    larger than a mean shard (fewer than ``shards``): the even share is that
    of the remaining groups over the remaining shards. Cells are refined until
    every sum the cuts ask for is known.
    """
    left, rest = shards, cells.total
    for b in sorted(big, reverse=True):
        if left > 1 and b > rest / left:
            rest, left = rest - b, left - 1
    while True:
        cuts, asked = _even_cuts(cells, shards, capacity, rest / left)
        unsure = [t for t in asked if cells.unsure(t)]
        if not unsure:
            return cuts
        # What is learned may move later lookups by about a cell.
        cells.refine([(t - cells.width, t + cells.width) for t in unsure])


def _even_cuts(cells: Cells, shards: int, capacity: int, share: float) -> tuple[list[int], list[int]]:
    """The cuts as far as ``cells`` tells, and all targets looked up for them.

    ``earliest`` walks backwards, so the rest always still fits.
    """
    total, asked = cells.total, []
    earliest = [0] * (shards + 1)
    earliest[shards] = total
    for j in range(shards - 1, 0, -1):
        need = earliest[j + 1] - capacity
        if need <= 0:
            break
        asked.append(need - 1)
        earliest[j] = cells.above(need - 1)
    cuts, x = [], 0
    for j in range(1, shards):
        goal = round(x + share)
        asked += [goal, x + capacity]
        under, over, cap = cells.below(goal)[0], cells.above(goal), cells.below(x + capacity)[0]
        pick = over if over <= cap and (over - goal < goal - under or under <= x) else under
        x = min(max(pick, earliest[j], x), cap)
        cuts.append(x)
        if x >= total:
            break
    return cuts, asked


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    The law is ``bytes``: equal texts share a shard and the largest shard is
    as small as contiguous ranges of groups allow. ``slot`` is gapless from 0
    in each shard. An empty table gives no rows; a null text counts as empty;
    repeated rows keep one slot each; with fewer groups than shards some
    shards stay empty.
    """
    rows = stored(sized_rows(docs, id_col, text_col), "shard-rows")
    groups = stored(
        rows.groupBy("digest").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("copies")), "shard-groups"
    )
    stat = groups.agg(F.count(F.lit(1)), F.sum("size"), F.max("size"), F.sum("copies")).first()
    n_groups, total, largest, n_rows = stat[0], stat[1] or 0, stat[2] or 0, stat[3] or 0
    cuts: list[int] = []
    prefixes = groups.withColumn("prefix", F.col("size"))
    if n_groups:
        prefixes = stored(prefix_sums(groups, n_groups), "shard-prefix")
        # Groups above the mean shard: fewer than ``shards`` of them can exist.
        big = [r[0] for r in groups.where(F.col("size") * shards > total).select("size").collect()]
        cells = Cells(prefixes, total)
        cuts = cut_points(cells, shards, smallest_capacity(cells, shards, largest), big)
    home = prefixes.select("digest", "copies", _above(F.col("prefix"), cuts).cast("int").alias("shard"))
    placed = joined_by(rows, home, "digest", "copies", n_rows)
    slices = max(1, -(-n_rows // (shards * ROWS_PER_SLICE)))
    # Slots: rows of a shard are dealt into slices by a hash of id and text (one
    # id may be on many rows), numbered inside the slice, and moved up by the
    # counts of the slices before.
    dealt = stored(
        placed.withColumn("slice", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(slices)).cast("int")), "shard-placed"
    )
    counts = dealt.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "slice").orderBy("doc_id", "digest")
    return (
        dealt.withColumn("inner", F.row_number().over(inside) - 1)
        .join(base, ["shard", "slice"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("base") + F.col("inner")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
