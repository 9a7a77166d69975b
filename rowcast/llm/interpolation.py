"""Language-model scoring by deleted interpolation.

A token's probability mixes the maximum-likelihood estimates of the bigram,
the unigram and the uniform model. The weights depend on how often the context
occurs: contexts are put in buckets by the power of two of their count. They
are learned by expectation-maximisation: one fold of the training documents is
held out, the other folds give the counts, and the weights are those under
which the held-out bigrams are likeliest. The final model uses the counts of
all training documents.

Counts never travel word by word. A task turns its documents into chunks of
local word numbers; a chunk sends each bucket of the hash space one packed
message with its words (then its bigrams), sorted by hash. A bucket adds up
what all chunks sent and answers each with the sums in its own order, so a
word that is a third of the corpus is one entry per chunk. With the answers a
chunk scores its documents alone.

The exchanges are keyed RDDs of packed messages, because they are read more
than once: chunks by the word counts, the bigrams, the weights and the scores.
An RDD reads its shuffle files again where a DataFrame would shuffle anew, and
several copies of the corpus would not fit the disks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowcast.llm.common import fold, id_and_text

CHUNK_TOKENS = 1 << 19
BUCKET_BYTES = 16 << 20  # text per bucket of the hash space: what a task holds at a time
END = b"\n"  # the end token; no word holds a line end
MAX_BUCKET = 40  # context buckets: unseen, 1, 2-3, 4-7, ...
GRID = 8  # steps per factor of two in the table of held-out events
FAN_IN = 8  # tables that a task, or the driver, adds up at a time
CELLS = 1 << 12  # more steps than any share of a 64-bit count takes


# ------------------------------------------------------------ packed columns


def _pack(*columns: np.ndarray) -> bytes:
    """Unsigned columns, each as the byte planes it needs, compressed."""
    squeeze = zstandard.ZstdCompressor(level=1)
    out = []
    for column in columns:
        column = np.ascontiguousarray(column, dtype="<u8")
        width = max(1, (int(column.max()).bit_length() + 7) // 8) if len(column) else 1
        planes = np.ascontiguousarray(column.view(np.uint8).reshape(-1, 8)[:, :width].T)
        body = squeeze.compress(planes.tobytes())
        out.append(np.array([len(column), width, len(body)], dtype="<u8").tobytes() + body)
    return b"".join(out)


def _unpack(blob: bytes, columns: int = 1 << 30) -> list[np.ndarray]:
    """The columns of :func:`_pack`, or the first few of them."""
    grow = zstandard.ZstdDecompressor()
    out, at = [], 0
    while at < len(blob) and len(out) < columns:
        n, width, size = (int(x) for x in np.frombuffer(blob, dtype="<u8", count=3, offset=at))
        planes = np.frombuffer(grow.decompress(blob[at + 24 : at + 24 + size], max_output_size=max(1, n * width)), np.uint8)
        column = np.zeros((n, 8), dtype=np.uint8)
        column[:, :width] = planes.reshape(width, n).T
        out.append(column.reshape(-1).view("<u8"))
        at += 24 + size
    return out


def _steps(sorted_values: np.ndarray) -> np.ndarray:
    """Differences of an ascending column, which need fewer bytes."""
    return np.diff(sorted_values, prepend=np.uint64(0))


def _pair_hash(context: np.ndarray, word: np.ndarray, bits: int) -> np.ndarray:
    """A well-mixed hash of two hashes, of so many bits."""
    x = context * np.uint64(0x9E3779B97F4A7C15) + (word ^ (word >> np.uint64(29)))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) >> np.uint64(64 - bits)


def _pair_bits(n_tokens: int) -> int:
    """Hash bits with which at most one pair among so many different bigrams is
    expected to collide; all 64 from four billion tokens on."""
    return min(64, 2 * max(1, n_tokens).bit_length() - 1)


# -------------------------------------------------------------------- chunks


def _chunks(chunk_tokens: int):
    """``chunk, (ids, body)``: whole documents as local word numbers. ``body``
    packs per document its fold and length, the tokens, and the hash of every
    local word; the end token is word 0."""

    def run(rows: Iterator[Row]) -> Iterator[tuple[str, tuple[list, bytes]]]:
        part, serial = TaskContext.get().partitionId(), 0
        ids, folds_in, lengths, tokens = [], [], [], []
        words: dict[bytes, int] = {END: 0}

        def close() -> tuple[str, tuple[list, bytes]]:
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
            body = _pack(np.array(folds_in), np.array(lengths), np.array(tokens), hashes)
            made = f"{part}-{serial}", (list(ids), body)
            for held in (words, ids, folds_in, lengths, tokens):
                held.clear()
            words[END] = 0
            return made

        for doc_id, text, f in rows:
            number = words.setdefault
            own = [number(w, len(words)) for w in text.encode("utf-8", "surrogatepass").lower().split()]
            ids.append(doc_id)
            folds_in.append(f)
            lengths.append(len(own) + 1)
            tokens.extend(own)
            tokens.append(0)
            if len(tokens) >= chunk_tokens:
                yield close()
                serial += 1
        if ids:
            yield close()

    return run


def _by_bucket(hashes: np.ndarray, bits: int, n_buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order by hash, and ``(bucket, from, to)`` of each bucket's run; buckets
    are equal ranges of hashes of so many bits."""
    order = np.argsort(hashes)
    top = hashes[order] >> np.uint64(max(0, bits - 32)) << np.uint64(max(0, 32 - bits))
    bucket = (top * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    last = np.append(first[1:], len(order))
    return order, [(int(bucket[a]), int(a), int(b)) for a, b in zip(first, last)]


def _read_chunk(body: bytes) -> tuple[np.ndarray, ...]:
    folds_in, lengths, tokens, hashes = _unpack(body)
    return folds_in.astype(np.int64), lengths.astype(np.int64), tokens.astype(np.int64), hashes


# -------------------------------------------------------------------- counts


def _word_messages(n_buckets: int, held_out: int, tune: int):
    """``bucket, (chunk, blob)``: a chunk's words with their counts in the
    training folds and in those less the tuning fold."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple[int, tuple[str, bytes]]]:
        for chunk, (_, body) in rows:
            folds_in, lengths, tokens, hashes = _read_chunk(body)
            f = np.repeat(folds_in, lengths)
            learn = np.bincount(tokens[f != held_out], minlength=len(hashes))
            kept = np.bincount(tokens[(f != held_out) & (f != tune)], minlength=len(hashes))
            order, runs = _by_bucket(hashes, 64, n_buckets)
            for bucket, a, b in runs:
                o = order[a:b]
                yield bucket, (chunk, _pack(_steps(hashes[o]), learn[o], kept[o]))

    return run


def _gathered(rows: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, list[tuple]]]:
    """A task's messages by bucket, each let go once it is used."""
    found: dict[int, list[tuple]] = {}
    for bucket, message in rows:
        found.setdefault(bucket, []).append(message)
    while found:
        yield found.popitem()


def _summed(columns: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For messages of (hash steps, count, count): which hash each entry has,
    and both counts summed by hash."""
    which = np.unique(np.concatenate([np.cumsum(c[0], dtype=np.uint64) for c in columns]), return_inverse=True)[1]
    one = np.bincount(which, weights=np.concatenate([c[1] for c in columns]))
    two = np.bincount(which, weights=np.concatenate([c[2] for c in columns]))
    return which, one, two


def _add_words(rows: Iterator[tuple]) -> Iterator[tuple[str, tuple[str, int, bytes]]]:
    """All counts of a bucket's words, answered to every chunk in its order;
    an answer to no chunk gives the distinct words and the totals."""
    for bucket, messages in _gathered(rows):
        parts = [_unpack(blob) for _, blob in messages]
        which, learn, kept = _summed(parts)
        at = 0
        for (chunk, _), p in zip(messages, parts):
            own = which[at : at + len(p[0])]
            at += len(p[0])
            yield chunk, ("words", bucket, _pack(learn[own], kept[own]))
        yield "", ("totals", bucket, _pack(np.array([(learn > 0).sum(), learn.sum(), kept.sum()])))


class _Chunk:
    """A chunk with the answers to its words."""

    def __init__(self, body: bytes, answers: list[tuple[str, int, bytes]], n_buckets: int, bits: int):
        self.folds, self.lengths, self.tokens, self.hashes = _read_chunk(body)
        order, _ = _by_bucket(self.hashes, 64, n_buckets)
        self.learn, self.kept = _placed(order, answers, "words")
        # A document's first word follows the end token of the one before.
        code = np.concatenate([[0], self.tokens[:-1]]) * len(self.hashes) + self.tokens
        pairs, self.which = np.unique(code, return_inverse=True)
        self.context, self.word = pairs // len(self.hashes), pairs % len(self.hashes)
        pair_hash = _pair_hash(self.hashes[self.context], self.hashes[self.word], bits)
        self.pair_hash, (self.order, self.runs) = pair_hash, _by_bucket(pair_hash, bits, n_buckets)

    def count(self, where: np.ndarray) -> np.ndarray:
        """How often each pair occurs in the documents that ``where`` marks."""
        return np.bincount(self.which[np.repeat(where, self.lengths)], minlength=len(self.context))


def _placed(order: np.ndarray, answers: list[tuple[str, int, bytes]], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The two columns of one kind of answers, put back in the chunk's order."""
    told = [_unpack(blob) for k, _, blob in sorted(answers, key=lambda a: a[1]) if k == kind]
    one, two = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    one[order] = np.concatenate([t[0] for t in told]).astype(np.int64)
    two[order] = np.concatenate([t[1] for t in told]).astype(np.int64)
    return one, two


def _pair_messages(n_buckets: int, held_out: int, tune: int, bits: int):
    """A chunk's bigrams with their counts in the training folds less the
    tuning fold, and in the tuning fold: ``bucket, (chunk, blob)``."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple[int, tuple[str, bytes]]]:
        for chunk, (bodies, answers) in rows:
            for _, body in bodies:
                c = _Chunk(body, list(answers), n_buckets, bits)
                kept, tuned = c.count((c.folds != held_out) & (c.folds != tune)), c.count(c.folds == tune)
                for bucket, a, b in c.runs:
                    o = c.order[a:b]
                    yield bucket, (chunk, _pack(_steps(c.pair_hash[o]), kept[o], tuned[o]))

    return run


def _add_pairs(rows: Iterator[tuple]) -> Iterator[tuple[str, tuple[str, int, bytes]]]:
    """Both counts of a bucket's bigrams, answered to every chunk in its order."""
    for bucket, messages in _gathered(rows):
        parts = [_unpack(blob) for _, blob in messages]
        which, kept, tuned = _summed(parts)
        at = 0
        for (chunk, _), p in zip(messages, parts):
            own = which[at : at + len(p[0])]
            at += len(p[0])
            yield chunk, ("pairs", bucket, _pack(kept[own], tuned[own]))


# ------------------------------------------------------------------- weights


def _context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two of its count."""
    _, exponent = np.frexp(count.astype(float))
    return np.minimum(exponent, MAX_BUCKET)


def _events(n_buckets: int, tune: int, bits: int, totals: dict[str, int]):
    """Held-out bigrams counted by context bucket and by the two estimates, on a
    logarithmic grid: what the weights depend on, and of bounded size."""
    n_kept = max(1, totals["n_kept"])
    none = np.iinfo(np.int32).min

    def run(rows: Iterator[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        table = np.zeros(0, np.int64), np.zeros(0)
        for _, (bodies, answers) in rows:
            for _, body in bodies:
                c = _Chunk(body, list(answers), n_buckets, bits)
                pair, _ = _placed(c.order, answers, "pairs")
                held = np.flatnonzero(n := c.count(c.folds == tune))
                context, word, pair = c.kept[c.context[held]], c.kept[c.word[held]], pair[held]
                cells = (_context_bucket(context) * CELLS + _cell(pair, context)) * CELLS + _cell(word, n_kept)
                table = _add_events(table, (cells, n[held].astype(float)))
        yield table

    return run


def _cell(count: np.ndarray, of: np.ndarray | int) -> np.ndarray:
    """Grid step of a relative frequency: 1 for all of it, more for less, 0 for none."""
    share = np.maximum(count, 1) / np.maximum(of, 1)
    return np.where(count > 0, 1 + np.round(-GRID * np.log2(share)), 0).astype(np.int64)


def _add_events(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    cells, where = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return cells, np.bincount(where, weights=np.concatenate([a[1], b[1]]), minlength=len(cells))


def learn_weights(events: tuple[np.ndarray, np.ndarray], n_words: int, rounds: int = 60) -> np.ndarray:
    """``weights[bucket] = (bigram, unigram, uniform)`` by expectation-
    maximisation. Each bucket is given one unseen word more than it held, so no
    token is impossible. A bucket without events takes the weights of all
    events; an unseen context has no bigram estimate."""
    weights = np.tile([0.6, 0.3, 0.1], (MAX_BUCKET + 1, 1))
    cells, n = events
    if len(cells):
        bucket, two, one = cells // CELLS**2, cells // CELLS % CELLS, cells % CELLS
        estimate = np.stack(
            [np.where(c > 0, np.exp2((1 - c) / GRID), 0.0) for c in (two, one)] + [np.full(len(n), 1.0 / (n_words + 1))],
            axis=1,
        )

        def fit(rows: np.ndarray) -> np.ndarray:
            w = np.array([0.6, 0.3, 0.1])
            for _ in range(rounds):
                mixed = estimate[rows] * w
                w = (n[rows, None] * mixed / mixed.sum(axis=1, keepdims=True)).sum(axis=0)
                w[2] += 1  # one more held-out token, of an unseen word
                w /= w.sum()
            return w

        weights[:] = fit(np.arange(len(n)))
        for b in range(MAX_BUCKET + 1):
            rows = np.flatnonzero(bucket == b)
            if len(rows):
                weights[b] = fit(rows)
    unseen = weights[0, 1:].sum()
    weights[0] = [0.0, *(weights[0, 1:] / unseen)]
    return weights


def _scores(n_buckets: int, bits: int, totals: dict[str, int], weights: Broadcast):
    """``id, tokens, known tokens, base score, score`` of a chunk's documents."""
    n, v = max(1, totals["n_learn"]), totals["n_words"]

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, (bodies, answers) in rows:
            for ids, body in bodies:
                c = _Chunk(body, list(answers), n_buckets, bits)
                kept, tuned = _placed(c.order, answers, "pairs")
                context, word = c.learn[c.context], c.learn[c.word]
                mix = weights.value[_context_bucket(context)]
                value = mix[:, 0] * (kept + tuned) / np.maximum(context, 1) + mix[:, 1] * word / n + mix[:, 2] / (v + 1)
                first = np.concatenate([[0], np.cumsum(c.lengths)[:-1]])
                base = np.log10((c.learn + 0.5) / (totals["n_learn"] + 0.5 * (v + 1)))
                yield from zip(
                    ids,
                    c.lengths.tolist(),
                    np.add.reduceat((c.learn > 0)[c.tokens].astype(np.int64), first).tolist(),
                    np.add.reduceat(base[c.tokens], first).tolist(),
                    np.add.reduceat(np.log10(value)[c.which], first).tolist(),
                )

    return run


# --------------------------------------------------------------------- score


def score(docs: DataFrame, folds: int = 5, held_out: int = 1, tune: int = 0, chunk_tokens: int = CHUNK_TOKENS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Documents of fold ``held_out`` are scored but not learned from; fold
    ``tune`` gives the mixture weights. A null or empty text is the end token
    alone. Repeated rows are learned and scored as often as they occur; a null
    id has the fold of the empty text; an empty table gives no rows. Without
    training documents every token is unseen.
    """
    spark = docs.sparkSession
    text_bytes = docs.agg(F.sum(F.octet_length(docs[text_col]))).first()[0] or 0
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes // BUCKET_BYTES))
    rows = id_and_text(docs, id_col, text_col).withColumn("f", fold(F.col("doc_id"), folds))
    # Answers find their chunk by its number. Rows in a fixed order give the same
    # chunks when a task is run again, also where they come out of a shuffle.
    rows = rows.sortWithinPartitions("doc_id", "text")
    by_chunk = rows.rdd.mapPartitions(_chunks(chunk_tokens)).partitionBy(n_buckets)
    counted = (
        by_chunk.mapPartitions(_word_messages(n_buckets, held_out, tune))
        .partitionBy(n_buckets)
        .mapPartitions(_add_words)
        .partitionBy(n_buckets)
    )
    depth = max(2, math.ceil(math.log(n_buckets, FAN_IN)))
    add = lambda a, b: [x + y for x, y in zip(a, b)]
    told = counted.filter(lambda r: not r[0]).map(lambda r: _unpack(r[1][2])[0].astype(int).tolist())
    totals = dict(zip(("n_words", "n_learn", "n_kept"), told.treeAggregate([0, 0, 0], add, add, depth)))
    bits = _pair_bits(text_bytes // 2 + 1)  # no more tokens than that, ends apart

    answers = counted.filter(lambda r: r[0])
    answers = answers.union(
        by_chunk.cogroup(answers, n_buckets)
        .mapPartitions(_pair_messages(n_buckets, held_out, tune, bits))
        .partitionBy(n_buckets)
        .mapPartitions(_add_pairs)
        .partitionBy(n_buckets)
    )
    told = by_chunk.cogroup(answers, n_buckets)
    events = told.mapPartitions(_events(n_buckets, tune, bits, totals)).treeReduce(_add_events, depth)
    weights = spark.sparkContext.broadcast(learn_weights(events, totals["n_words"]))
    scored = told.mapPartitions(_scores(n_buckets, bits, totals, weights))

    schema = StructType().add("doc_id", rows.schema["doc_id"].dataType).add("n_tokens", "long").add("n_known", "long").add(
        "base_score", "double").add("score", "double")
    return spark.createDataFrame(scored, schema).select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(totals["n_learn"]).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
