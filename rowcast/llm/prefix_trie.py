"""Conversation prefix trie: ternary search trees over range shards of turn ids.

1. Turns are encoded by a dictionary: one whole number per distinct role and
   text. Texts are read once and not shuffled, only their digests are.
2. Conversations become sequences of those numbers. Equal sequences are one row
   with their count, their smallest id and the hash of their ids.
3. The distinct sequences are sorted into range shards. Each shard inserts its
   own into a ternary search tree, medians first, so that the tree is balanced;
   passes over its nodes, children before parents, add up members, leaves and
   savings.
4. Nodes on the paths of a shard's first and last sequence may go on in its
   neighbours. They are the boundary: it is merged sixteen shards at a time,
   and what lies inside the merged range is finished each time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowcast.llm.common import Rounds, joined_by, ship, stored

FAN_IN = 16
# Turn ids a range shard holds on average; its tree takes about 1 kB for each.
SHARD_TURNS = 1 << 15
# Most leading turns that the rebuilding takes over from the group's first conversation.
LEADING = 6
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = "depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
PART = f"shard long, side int, key binary, up binary, chars long, {NODE}"
NODE_NAMES = [field.split()[0] for field in NODE.split(", ")]
PART_NAMES = [field.split()[0] for field in PART.split(", ")]


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of a turn; the role's length keeps role and text apart."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def encoded(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, turn_id, chars``: every turn as a dictionary number.

    ``at`` sorts a conversation's turns: by turn number, null first; turns
    that share a number are ordered by their digest.
    """
    role = F.coalesce("role", F.lit(""))
    text = F.coalesce("text", F.lit(""))
    turns = stored(
        conversations.where("conv_id is not null").select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            turn_digest(role, text).alias("digest"),
            F.length(text).cast("long").alias("chars"),
        ),
        "trie-turns",
    )
    counts = turns.groupBy("digest").agg(F.first("chars").alias("chars"), F.count(F.lit(1)).alias("copies"))
    dictionary = stored(counts.withColumn("turn_id", F.monotonically_increasing_id()), "trie-dictionary")
    rows = turns.drop("chars")
    return joined_by(rows, dictionary, "digest", "copies", turns.count()).select(
        "conv_id", F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "digest").alias("at"), "turn_id", "chars"
    )


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, ids, chars``: a row per conversation, its turns in order."""
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "turn_id", "chars"))).alias("t"))
    return listed.select("conv_id", F.col("t.turn_id").alias("ids"), F.col("t.chars").alias("chars"))


def rebuilt(whole: DataFrame, group: int = 100) -> DataFrame:
    """Each conversation ``c`` with its first ``h`` turns replaced by those of
    conversation ``c - c % group``; ``h`` is crc32 of the id as text, modulo 6.
    """
    heads = whole.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"),
        F.slice("ids", 1, LEADING - 1).alias("head_ids"),
        F.slice("chars", 1, LEADING - 1).alias("head_chars"),
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % LEADING).cast("int")
    both = whole.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn("h", h)
    nothing = F.array().cast("array<long>")

    def put(head: str, own: str) -> Column:
        mine = F.slice(F.col(own), F.col("h") + 1, F.greatest(F.size(own), F.lit(1)))
        return F.concat(F.slice(F.coalesce(F.col(head), nothing), F.lit(1), F.col("h")), mine)

    return both.join(heads, "base", "left").select(
        "conv_id", put("head_ids", "ids").alias("ids"), put("head_chars", "chars").alias("chars")
    )


def _id_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one key in sorted ``key, conv_id`` rows, their ids comma-joined."""
    for batch in batches:
        keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        ends = [*starts[1:], len(keys)]
        yield pa.record_batch(
            [
                pa.array([keys[i] for i in starts], pa.binary()),
                pa.array([ids[i] for i in starts], pa.int64()),
                pa.array([z - i for i, z in zip(starts, ends)], pa.int64()),
                pa.array([",".join(map(str, ids[i:z])) for i, z in zip(starts, ends)], pa.string()),
            ],
            names=["key", "conv_id", "n", "ids"],
        )


def _id_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the sorted chunks of each key, one chunk at a time."""
    key = first = digest = None
    n = 0
    for batch in batches:
        done: list[tuple] = []
        for k, c, m, ids in zip(*[column.to_pylist() for column in batch.columns]):
            if k != key:
                if key is not None:
                    done.append((key, first, n, digest.hexdigest()))
                key, first, n, digest = k, c, 0, hashlib.sha256()
            digest.update(("," if n else "").encode() + ids.encode())
            n += m
        yield _hash_rows(done)
    if key is not None:
        yield _hash_rows([(key, first, n, digest.hexdigest())])


def _hash_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["key", "first", "n", "sha"])


def distinct_sequences(whole: DataFrame) -> DataFrame:
    """``ids, chars, first, n, sha``: the distinct sequences, with the smallest
    conversation that has each, their number, and the hash of their ids in
    ascending order.

    The ids of a sequence that very many conversations share are sorted by
    range over many tasks and joined to chunks there; only chunks meet in the
    one task that hashes them, and they pass it one by one.
    """
    width = int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = stored(
        whole.withColumn("key", F.unhex(F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256))), "trie-keyed"
    )
    chunks = (
        keyed.select("key", "conv_id")
        .repartitionByRange(width, "key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(_id_chunks, "key binary, conv_id long, n long, ids string")
    )
    hashes = (
        chunks.repartition(width, "key")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(_id_hashes, "key binary, first long, n long, sha string")
    )
    one_each = keyed.groupBy("key").agg(F.first(F.struct("ids", "chars")).alias("s"))
    return one_each.join(hashes, "key").select("s.ids", "s.chars", "first", "n", "sha")


def _medians_first(n: int) -> Iterator[int]:
    """0 .. n-1, the middle of every range before its halves."""
    queue = [(0, n)]
    for a, z in queue:
        if a < z:
            middle = (a + z) // 2
            yield middle
            queue.append((a, middle))
            queue.append((middle + 1, z))


class TernaryTree:
    """A ternary search tree over sequences of whole numbers.

    Node 0 is the root, which has no number. ``low`` and ``high`` lead to
    siblings, ``first`` to the tree of a node's children; ``up`` is the node
    whose children it is among. A parent has a smaller number than its children.
    """

    def __init__(self):
        self.low, self.high, self.first, self.value = [-1], [-1], [-1], [-1]
        self.up, self.chars, self.depth = [-1], [0], [0]
        self.ends: list[tuple | None] = [None]

    def insert(self, ids: list[int], chars: list[int], payload: tuple) -> None:
        """Add a sequence; ``payload`` stays at the node where it ends."""
        at = 0
        for value, length in zip(ids, chars):
            at = self._child(at, value, length)
        self.ends[at] = payload

    def _child(self, parent: int, value: int, length: int) -> int:
        way, at, where = self.first, self.first[parent], parent
        while at >= 0:
            here = self.value[at]
            if value == here:
                return at
            way, where = (self.low, at) if value < here else (self.high, at)
            at = way[at]
        way[where] = new = len(self.value)
        for column, entry in ((self.low, -1), (self.high, -1), (self.first, -1), (self.value, value), (self.up, parent),
                              (self.chars, length), (self.depth, self.depth[parent] + 1), (self.ends, None)):
            column.append(entry)
        return new

    def path(self, ids: list[int]) -> list[int]:
        """The nodes of a stored sequence, from the root on."""
        nodes = [0]
        for value in ids:
            nodes.append(self._child(nodes[-1], value, 0))
        return nodes


def _prefix_keys(ids: list[int]) -> list[bytes]:
    """A key for every prefix of a sequence, the empty one included."""
    digest = hashlib.sha256()
    keys = [digest.digest()]
    for value in ids:
        digest.update(value.to_bytes(8, "big", signed=True))
        keys.append(digest.digest())
    return keys


def shard_rows(shard: int, rows: list[tuple]) -> list[tuple]:
    """The nodes of one range shard as rows of ``PART``.

    ``rows`` are sorted sequences with their payload. ``side`` tells whether a
    node is finished (0) or on the boundary: on the path of the first sequence
    (1), of the last (2) or of both (3). Boundary nodes carry what their
    finished children and theirs add up to; they are counted themselves only
    once they are finished.
    """
    tree = TernaryTree()
    for i in _medians_first(len(rows)):
        ids, chars, *payload = rows[i]
        tree.insert(ids, chars, tuple(payload))
    size = len(tree.value)
    side, key = [0] * size, [None] * size
    for bit, ids in ((1, rows[0][0]), (2, rows[-1][0])):
        for node, name in zip(tree.path(ids), _prefix_keys(ids)):
            side[node] |= bit
            key[node] = name
    members, least = [0] * size, [None] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    out = []
    for node in range(size - 1, -1, -1):
        end = tree.ends[node]
        if end is not None:
            members[node] += end[1]
            least[node] = end[0] if least[node] is None else min(least[node], end[0])
        if not side[node]:
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * tree.chars[node]
        up = tree.up[node]
        if up >= 0:
            members[up] += members[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            children[up] += not side[node]
            leaves[up] += leaves[node] if not side[node] else 0
            saved[up] += saved[node] if not side[node] else 0
    for node in range(size):
        up = tree.up[node]
        boundary_up = up >= 0 and side[up]
        out.append((
            shard, side[node], key[node], key[up] if boundary_up else None, tree.chars[node], tree.depth[node],
            least[node], members[node], children[node], leaves[node], saved[node],
            EMPTY if tree.ends[node] is None else tree.ends[node][2],
            None if up < 0 or boundary_up else least[up],
        ))
    return out


def merged_rows(shard: int, rows: list[tuple], last: bool) -> list[tuple]:
    """Boundary rows of neighbouring shards as those of one shard.

    A node that stands on several of their paths is added up. With ``last``
    every node is finished; else those are that lie on neither the first path
    of the first shard nor the last path of the last one.
    """
    first_shard, last_shard = min(r[0] for r in rows), max(r[0] for r in rows)
    nodes: dict[bytes, list] = {}
    for s, side, key, up, chars, depth, conv, n, children, leaves, saved, ends in rows:
        keep = (side & 1 if s == first_shard else 0) | (side & 2 if s == last_shard else 0)
        if (node := nodes.get(key)) is None:
            nodes[key] = [0 if last else keep, key, up, chars, depth, conv, n, children, leaves, saved, ends]
            continue
        node[0] |= 0 if last else keep
        node[5] = min(node[5], conv)
        for i, more in ((6, n), (7, children), (8, leaves), (9, saved)):
            node[i] += more
        node[10] = ends if node[10] == EMPTY else node[10]
    for node in sorted(nodes.values(), key=lambda x: -x[4]):
        side, key, up, chars, depth, conv, n, children, leaves, saved, _ = node
        if side:
            continue
        if not children:
            node[8] = leaves = 1
        node[9] = saved = saved + (n - 1) * chars
        if up is not None:
            above = nodes[up]
            above[7] += 1
            above[8] += leaves
            above[9] += saved
    out = []
    for side, key, up, *node in nodes.values():
        above = nodes[up] if up is not None else None
        waits = above is not None and above[0]
        out.append((shard, side, key, up if side or waits else None, *node, above[5] if above and not waits else None))
    return out


def _part_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    types = [kinds[field.split()[1]] for field in PART.split(", ")] + [pa.int64()]
    columns = list(zip(*rows)) if rows else [[]] * len(types)
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types)], names=[*PART_NAMES, "parent_conv_id"])


SCHEMA = f"{PART}, parent_conv_id long"


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns])]
    if rows:
        made = shard_rows(TaskContext.get().partitionId(), rows)
        for i in range(0, len(made), 10_000):
            yield _part_batch(made[i : i + 10_000])


def _merge(last: bool) -> Callable[[pa.Table], pa.Table]:
    def merge(table: pa.Table) -> pa.Table:
        rows = list(zip(*[table[name].to_pylist() for name in PART_NAMES]))
        return pa.Table.from_batches([_part_batch(merged_rows(rows[0][0] // FAN_IN, rows, last))])

    return merge


def trie(whole: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of ``whole`` (``conv_id, ids, chars``).

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    spark = whole.sparkSession
    ship(spark)
    distinct = stored(distinct_sequences(whole), "trie-sequences")
    turns = distinct.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(1, -(-turns // SHARD_TURNS))
    sorted_in = distinct.repartitionByRange(shards, "ids").sortWithinPartitions("ids")
    built = stored(sorted_in.mapInArrow(_build, SCHEMA), "trie-nodes")
    finished = [built.where("side = 0")]
    boundary = Rounds(spark, "trie-boundary")
    now = boundary.put(built.where("side > 0").drop("parent_conv_id"))
    while not now.isEmpty():
        widest = now.agg(F.max("shard")).first()[0]
        last = widest < FAN_IN
        group = F.floor(F.col("shard") / FAN_IN)
        made = stored(now.groupBy(group).applyInArrow(_merge(last), SCHEMA), "trie-merged")
        finished.append(made.where("side = 0"))
        now = boundary.put(made.where("side > 0").drop("parent_conv_id"))
    nodes = finished[0]
    for more in finished[1:]:
        nodes = nodes.unionByName(more)
    done = nodes.where("up is null")
    waiting = nodes.where("up is not null").drop("parent_conv_id").withColumnRenamed("up", "parent")
    merged = None
    for more in finished[1:]:
        merged = more if merged is None else merged.unionByName(more)
    if merged is not None:
        above = stored(merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
                                     F.col("n_children").alias("copies")), "trie-parents")
        found = joined_by(waiting, above, "parent", "copies", nodes.count())
        done = done.select(*NODE_NAMES, "parent_conv_id").unionByName(found.select(*NODE_NAMES, "parent_conv_id"))
    return done.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    )


def prefix_trie(conversations: DataFrame, group: int | None = 100) -> DataFrame:
    """The prefix trie of ``conversations`` (``conv_id, turn, role, text``).

    With ``group`` the conversations are rebuilt first (:func:`rebuilt`); with
    None they are taken as they are. Turns are ordered by their number, null
    first, and turns that share one by their digest; repeated rows are repeated
    turns. A null role or text is empty; rows without a ``conv_id`` belong to
    no conversation. Negative ids belong to the group that the remainder of
    SQL gives. A conversation may be left without turns: it is then a member of
    the root only. An empty table has no nodes. Other columns do not matter.

    A conversation's turn numbers have to fit one row (16 bytes a turn); its
    texts do not.
    """
    whole = sequences(encoded(conversations))
    return trie(rebuilt(whole, group) if group else whole)
