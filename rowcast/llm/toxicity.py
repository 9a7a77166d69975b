"""Toxic passages by maximum-scoring segments.

Each token has a log-odds of toxic against clean documents, smoothed by an
informative Dirichlet prior (the token's share of all counts) and drawn
towards zero by its own uncertainty; a token without evidence takes that of
its stem. Less a drift, the scores form a walk that falls in clean text. A
linear-time scan finds all maximal-scoring segments of a document, that is
every passage whose score rises above what surrounds it. As for alignment
scores, extreme-value theory says how many segments of score ``S`` a clean text
of ``n`` words holds: ``E = K n exp(-rate S)``. Segments with ``E`` below 1 are
significant; a document's evidence is the sum of ``-ln E`` over them, which
beyond ``BEND`` grows by its logarithm only, so that a few long documents do
not dominate the fit and more evidence still means a higher score. A logistic
curve turns it into a probability.

The curve and the extreme-value constants are fitted on each of a few parts of
the labelled documents with token counts of the other parts, so they are not
misled by tokens that a model has only seen in the document it scores.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowcast.llm.common import fold, id_and_text, ship, stored, word_bytes
from rowcast.llm.simhash import roots, with_fingerprint

MAX_LABELLED = 200_000  # labelled documents the model is fitted on, at most about
MIN_DOCS = 4  # labelled documents a token must occur in
STEM = 5  # characters of a stem
PRIOR = 0.05  # Dirichlet prior mass, as a share of all counts
CAUTION = 1.645  # standard errors by which a log-odds is drawn towards zero
LEAST = 1.5  # log-odds left after that below which a token counts as neutral
PARTS = 4  # parts of the labelled documents, each scored by a model of the others
DRIFT = 0.75  # what every word costs
MEMO = 60_000  # words whose scores or counts a task remembers at a time
BEND = 60.0  # evidence from which on it counts by its logarithm


@dataclass
class Model:
    """Token scores (stems end in ``*``) and the fitted constants."""

    tokens: dict[bytes, float]
    rate: float = 1.0
    scale: float = 1.0
    intercept: float = -4.0
    slope: float = 0.0


class _Scores(dict):
    """Score of a word, drift taken off; forgets all when it grows too long."""

    def __init__(self, tokens: dict[bytes, float]):
        super().__init__()
        self.tokens = tokens

    def __missing__(self, word: bytes) -> float:
        value = self.tokens.get(word, 0.0) or self.tokens.get(_stem(word), 0.0)
        if len(self) >= MEMO:
            self.clear()
        self[word] = value - DRIFT
        return value - DRIFT


def _stem(word: bytes) -> bytes:
    return word.decode("utf-8", "replace")[:STEM].encode() + b"*"


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(start, end, score)`` of a walk, in order.

    Only positive entries open a segment, so the scan runs over those and
    reads everything between from the running sum. Each entry is linked to
    the last earlier one that starts lower, which keeps it linear.
    """
    rises = np.flatnonzero(scores > 0)
    if not len(rises):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    low: list[float] = []
    high: list[float] = []
    span: list[tuple[int, int]] = []
    lower: list[int] = []
    for i in rises.tolist():
        a, b, lo, hi = i, i + 1, float(total[i]), float(total[i + 1])
        while True:
            j = len(low) - 1
            while j >= 0 and low[j] >= lo:
                j = lower[j]
            if j < 0 or high[j] >= hi:
                break
            a, lo = span[j][0], low[j]
            del low[j:], high[j:], span[j:], lower[j:]
        low.append(lo), high.append(hi), span.append((a, b)), lower.append(j)
    return [(a, b, h - lo) for (a, b), lo, h in zip(span, low, high)]


def _labelled(docs: DataFrame, labels: DataFrame, folds: int, held_out: int, max_labelled: int,
              id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``text, toxic, part, copies`` of the training documents. ``copies`` names
    the group of near copies that a document stands in, null if it stands alone;
    a group falls into one part. A document labelled twice is toxic if any
    label says so; null ids and labels teach nothing."""
    told = (
        labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("toxic"))
        .where((fold(F.col("doc_id"), folds) != held_out) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = told.count()
    if n > max_labelled:
        share = int(max_labelled / n * 1_000_000)
        told = told.where(F.pmod(F.xxhash64("doc_id", F.lit("labelled")), F.lit(1_000_000)) < share)
    # At most about max_labelled rows of two numbers: the bound of the broadcast.
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(told), "doc_id").select("text", "toxic")
    rows = stored(with_fingerprint(texts, "text", "fp"), "toxic-labelled")
    sizes = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    groups = roots(sizes)
    copied = groups.groupBy("root").agg(F.sum("n").alias("n")).where("n > 1").select(F.col("root").alias("copies"))
    # Fewer rows than labelled texts: the bound of the broadcast.
    copied = F.broadcast(groups.join(copied, F.col("root") == F.col("copies")).select("fp", "copies"))
    part = F.pmod(F.xxhash64(F.coalesce("copies", "fp"), F.lit("part")), F.lit(PARTS)).cast("int")
    return rows.join(copied, "fp", "left").select("text", "toxic", part.alias("part"), "copies")


CLASSES = [f"{kind}_{part}" for kind in ("clean", "toxic") for part in range(PARTS)]


def _tokens(text: str) -> set[bytes]:
    """The words of a text, and the stems of the longer ones."""
    words = set(word_bytes(text).split())
    return words | {_stem(w) for w in words if len(w) > STEM}


def _token_counts(labelled: DataFrame) -> DataFrame:
    """``token`` and :data:`CLASSES`: documents of each class and part that hold the token (words, and the stems of longer words).

    Copies and near copies of one document must not pass for many witnesses:
    of a group of them, those of a class that hold the token count once.
    Different documents that share a passage all count.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, list[int]] = defaultdict(lambda: [0] * len(CLASSES))

        def flush() -> pa.RecordBatch:
            keys = list(counts)
            columns = [pa.array([counts[k][i] for k in keys], pa.int64()) for i in range(len(CLASSES))]
            made = pa.record_batch([pa.array(keys, pa.binary()), *columns], names=["token", *CLASSES])
            counts.clear()
            return made

        for batch in batches:
            for text, toxic, part in zip(batch.column(0), *(batch.column(i).to_pylist() for i in (1, 2))):
                for token in _tokens(text.as_py()):
                    counts[token][PARTS * (toxic > 0) + part] += 1
                if len(counts) > MEMO:
                    yield flush()
        yield flush()

    def witness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[int, int, bytes]] = set()

        def flush() -> pa.RecordBatch:
            copies, at, token = zip(*known) if known else ((), (), ())
            made = pa.record_batch(
                [pa.array(token, pa.binary()), pa.array(copies, pa.int64()), pa.array(at, pa.int32())],
                names=["token", "copies", "at"],
            )
            known.clear()
            return made

        for batch in batches:
            for text, toxic, part, copies in zip(batch.column(0), *(batch.column(i).to_pylist() for i in (1, 2, 3))):
                known.update((copies, PARTS * (toxic > 0) + part, token) for token in _tokens(text.as_py()))
                if len(known) > MEMO:
                    yield flush()
        yield flush()

    alone = labelled.where("copies is null").mapInArrow(count, ", ".join(["token binary", *(f"{c} long" for c in CLASSES)]))
    once = labelled.where("copies is not null").mapInArrow(witness, "token binary, copies long, at int").distinct()
    grouped = once.select("token", *[(F.col("at") == i).cast("long").alias(c) for i, c in enumerate(CLASSES)])
    return alone.unionByName(grouped).groupBy("token").agg(*[F.sum(c).cast("double").alias(c) for c in CLASSES])


def _log_odds(toxic: Column, clean: Column, all_toxic: float, all_clean: float) -> Column:
    """Cautious log-odds: drawn towards zero by CAUTION standard errors."""
    mass = PRIOR * (all_toxic + all_clean)
    # The prior of a token that this part lacks is its smallest count's.
    prior = PRIOR * F.greatest(toxic + clean, F.lit(1.0))
    t, c = toxic + prior, clean + prior
    least = F.lit(1e-9)
    odds = F.log(t / F.greatest(all_toxic + mass - t, least)) - F.log(c / F.greatest(all_clean + mass - c, least))
    sure = F.abs(odds) - CAUTION * F.sqrt(1 / t + 1 / c)
    return F.when(sure >= LEAST, F.signum(odds) * sure).otherwise(0.0)


def _token_models(counts: DataFrame) -> list[Model]:
    """For each part the model of all other parts, then the model of all.

    Every token with a score in one of them reaches the driver, no other.
    """
    sums = np.array([float(x or 0) for x in counts.agg(*[F.sum(c) for c in CLASSES]).first()]).reshape(2, PARTS)
    scores = []
    for left_out in [*range(PARTS), None]:
        used = [p for p in range(PARTS) if p != left_out]
        c, t = (sum(F.col(CLASSES[i + p]) for p in used) for i in (0, PARTS))
        scores.append(_log_odds(t, c, float(sums[1, used].sum()), float(sums[0, used].sum())).alias(f"s{len(scores)}"))
    rated = counts.where(sum(F.col(c) for c in CLASSES) >= MIN_DOCS).select("token", *scores)
    kept = rated.where(" or ".join(f"s{i} <> 0" for i in range(len(scores)))).collect()
    return [Model({bytes(r["token"]): r[i] for r in kept if r[i]}) for i in range(1, len(scores) + 1)]


def _walk(text: str, scores: _Scores) -> np.ndarray:
    return np.array([scores[w] for w in word_bytes(text).split()], dtype=float)


def _tally(labelled: DataFrame, models: Broadcast, what) -> list[tuple[str, int, int]]:
    """Counts of ``what(scores, toxic, model)``'s keys over the labelled
    documents, each scored by the model of the other parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = models.value
        memo = [_Scores(m.tokens) for m in made[:PARTS]]
        counts: dict[tuple[str, int], int] = defaultdict(int)
        for batch in batches:
            for text, toxic, part in zip(batch.column(0), *(batch.column(i).to_pylist() for i in (1, 2))):
                for key, n in what(_walk(text.as_py(), memo[part]), toxic, made[part]):
                    counts[key] += n
        keys = list(counts)
        yield pa.record_batch(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
             pa.array([counts[k] for k in keys], pa.int64())],
            names=["kind", "bin", "n"],
        )

    rows = labelled.mapInArrow(run, "kind string, bin long, n long").groupBy("kind", "bin").agg(F.sum("n").alias("n"))
    return [(r["kind"], r["bin"], r["n"]) for r in rows.collect()]


def _background(walk: np.ndarray, toxic: int, model: Model):
    """Word scores and segment scores of clean documents, in tenths."""
    if toxic:
        return
    bins, n = np.unique(np.round(walk * 10).astype(int), return_counts=True)
    yield from ((("word", int(b)), int(k)) for b, k in zip(bins, n))
    for _, _, s in segments(walk):
        yield ("segment", int(s * 10)), 1


def _evidence(walk: np.ndarray, model: Model) -> tuple[float, list[tuple[int, int, float, float]]]:
    """Sum of ``-ln E`` over the significant segments, bent, and those segments."""
    found, total = [], 0.0
    for a, b, s in segments(walk):
        log_e = math.log(model.scale * len(walk)) - model.rate * s
        if log_e < 0:
            found.append((a, b, s, math.exp(max(log_e, -700.0))))
            total -= log_e
    return total if total <= BEND else BEND * (1 + math.log(total / BEND)), found


def _rated(walk: np.ndarray, toxic: int, model: Model):
    x, _ = _evidence(walk, model)
    yield ("toxic" if toxic else "clean", int(x * 4)), 1


def _extreme_value(rows: list[tuple[str, int, int]]) -> tuple[float, float]:
    """``rate`` solves E[exp(rate * score)] = 1 over clean words; ``scale``
    makes the expected number of segments that of clean documents."""
    words = {b / 10: n for kind, b, n in rows if kind == "word"}
    if not words:
        return 1.0, 1.0
    n_words = sum(words.values())
    # One unseen rise of each size keeps the equation solvable.
    for s in (1.0, 2.0, 4.0):
        words[s] = words.get(s, 0) + 1
    s, p = np.array(list(words)), np.array(list(words.values()), dtype=float)
    p /= p.sum()
    lo, hi = 1e-6, 20.0
    for _ in range(100):
        mid = (lo + hi) / 2
        if (p * np.exp(np.minimum(mid * s, 700))).sum() < 1:
            lo = mid
        else:
            hi = mid
    rate = lo
    heights = [(b / 10, n) for kind, b, n in rows if kind == "segment"]
    least = min((h for h, _ in heights), default=1.0)
    scale = (1 + sum(n for _, n in heights)) / (n_words * math.exp(-rate * least))
    return rate, scale


def _logistic(rows: list[tuple[str, int, int]]) -> tuple[float, float]:
    """Intercept and slope of P(toxic | evidence), with one doubtful document
    added to each class, by Newton steps under a small ridge."""
    x = np.array([b / 4 for _, b, _ in rows] + [0.0, BEND])
    y = np.array([float(k == "toxic") for k, _, _ in rows] + [1.0, 0.0])
    n = np.array([float(c) for _, _, c in rows] + [1.0, 1.0])
    a, b = 0.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -500, 500)))
        w = n * p * (1 - p) + 1e-12
        g = np.array([(n * (y - p)).sum() - 1e-3 * a, (n * x * (y - p)).sum() - 1e-3 * b])
        h = np.array([[w.sum() + 1e-3, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-3]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(max(b, 0.0))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, max_labelled: int = MAX_LABELLED,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on the labelled documents whose fold is not ``held_out``.

    Only the tokens that have a score and small histograms reach the driver.
    Without usable labels the model finds nothing toxic.
    """
    spark = docs.sparkSession
    labelled = _labelled(docs, labels, folds, held_out, max_labelled, id_col, text_col, label_col)
    models = _token_models(stored(_token_counts(labelled), "toxic-tokens"))
    rows = _tally(labelled, spark.sparkContext.broadcast(models), _background)
    rate, scale = _extreme_value(rows)
    for m in models:
        m.rate, m.scale = rate, scale
    rated = _tally(labelled, spark.sparkContext.broadcast(models), _rated)
    model = models[-1]
    if rated:
        model.intercept, model.slope = _logistic(rated)
    return model


def _probability(walk: np.ndarray, model: Model) -> tuple[float, list[tuple[int, int, float, float]]]:
    x, found = _evidence(walk, model)
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, model.intercept + model.slope * x)))), found


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, segments`` of every row.

    ``segments`` are the significant passages: first word, word after the
    last, score and ``E``. Null and empty texts have none and get the score of
    no evidence; repeated rows score alike; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        memo = _Scores(fitted.tokens)
        for batch in batches:
            rated = [_probability(_walk(t.as_py(), memo), fitted) for t in batch.column(1)]
            found = [[{"start": a, "end": b, "score": s, "e_value": e} for a, b, s, e in f] for _, f in rated]
            yield pa.record_batch(
                [batch.column(0), pa.array([p for p, _ in rated], pa.float64()), pa.array(found, pa.list_(passage))],
                names=["doc_id", "score", "segments"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, score double, segments array<struct<start: long, end: long, score: double, e_value: double>>"
    )


def clean(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose score is ``least`` or more; all columns stay."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        memo = _Scores(fitted.tokens)
        for batch in batches:
            keep = [_probability(_walk(t.as_py() or "", memo), fitted)[0] < least for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
