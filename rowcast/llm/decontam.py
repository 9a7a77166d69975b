"""Benchmark decontamination with an Aho-Corasick automaton.

Every run of ``window`` consecutive words of a benchmark item is a pattern (a
shorter item is one pattern). The distinct patterns form one automaton, which
scans each normalised document once. Normalising keeps every byte's place
(A-Z lower-cased, separators blanked), so a hit's words map straight back to
offsets in the original text.

The automaton is broadcast as its pattern list and built once per worker
process; nothing is shuffled but the benchmark's own windows. The list's size
is checked: beyond ``block_bytes`` one automaton would not fit a worker. Then
each text is still scanned once, against a bitmap of the windows' hashes whose
size is fixed; the places that pass it are joined with the window table by the
window itself, so the result is the same and no window passes through the
driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowcast.llm.common import HOT_KEYS, joined_by, ship, stored, word_bounds, word_bytes

WINDOW = 10
BLOCK_BYTES = 4 << 20  # of windows in an automaton, which takes about 30 times as much
SIEVE_BITS = 26  # the bitmap of window hashes has 2^26 bits, 8 MB
SPANS = "array<struct<start: long, end: long>>"

_built: dict[str, tuple] = {}  # the automaton last used in this process


def windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``pattern, items``: each distinct window and the ids (as text, sorted)
    of the items that hold it. Null and wordless items have none; rows that
    repeat an item add nothing."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, patterns = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = word_bytes(text).split()
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    items.append(item)
                    patterns.append(b" ".join(words[i : i + window]))
            yield pa.record_batch([pa.array(items, pa.string()), pa.array(patterns, pa.binary())], names=["item", "pattern"])

    named = benchmark.select(
        F.coalesce(benchmark[id_col].cast("string"), F.lit("")).alias("item"),
        F.coalesce(benchmark[text_col], F.lit("")).alias("text"),
    )
    return (
        named.mapInArrow(cut, "item string, pattern binary")
        .groupBy("pattern")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def _weight(found: DataFrame) -> int:
    """Bytes of a window table in an automaton's pattern list."""
    return found.agg(F.sum(F.octet_length("pattern") + 8 + F.size("items") * 16)).first()[0] or 0


def _pattern_list(found: DataFrame) -> tuple[str, Broadcast]:
    """A window table of checked size as a named broadcast."""
    rows = [(bytes(r["pattern"]), r["items"]) for r in found.collect()]
    return uuid.uuid4().hex, found.sparkSession.sparkContext.broadcast(rows)


def _automaton(name: str, block: Broadcast) -> tuple:
    """The block's automaton, its pattern lengths in words, and its items."""
    if name not in _built:
        _built.clear()
        table = block.value
        made = ahocorasick.Automaton()
        for k, (pattern, _) in enumerate(table):
            made.add_word(f" {pattern.decode('latin-1')} ", k)
        made.make_automaton()
        _built[name] = (made, [p.count(b" ") + 1 for p, _ in table], [i for _, i in table])
    return _built[name]


def _scan(blanked: list[bytes], patterns: tuple[str, Broadcast]) -> list[tuple[int, np.ndarray, set[str]]]:
    """Per text: its words, a mask of the hit ones, and the items found.

    The automaton sees the words joined by single blanks, one Latin-1 character
    per byte.
    """
    lines = [f" {b' '.join(b.split()).decode('latin-1')} " for b in blanked]
    hits: list[list[tuple[int, int]]] = [[] for _ in lines]
    items: list[set[str]] = [set() for _ in lines]
    automaton, n_words, owners = _automaton(*patterns)
    if n_words:
        for i, line in enumerate(lines):
            for end, k in automaton.iter(line):
                hits[i].append((end, n_words[k]))
                items[i].update(owners[k])
    out = []
    for line, found, owned in zip(lines, hits, items):
        words = line.count(" ") - 1 if len(line) > 2 else 0
        mask = np.zeros(words, dtype=bool)
        if found:
            # Blank number i closes word i - 1.
            blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), dtype=np.uint8) == 32)
            edge = np.zeros(words + 1, dtype=np.int64)
            last = np.searchsorted(blanks, [e for e, _ in found])
            np.add.at(edge, last - np.array([n for _, n in found]), 1)
            np.add.at(edge, last, -1)
            mask = np.cumsum(edge[:-1]) > 0
        out.append((words, mask, owned))
    return out


def _slices(column: pa.Array) -> Iterator[list[str]]:
    """The texts (null: empty) of a batch, a few at a time."""
    for at in range(0, len(column), 64):
        yield [t or "" for t in column.slice(at, 64).to_pylist()]


def _spans(text: str, blank: bytes, mask: np.ndarray) -> list[dict]:
    """Runs of hit words as character offsets of the original text."""
    starts, ends = _char_bounds(text, blank)
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    return [{"start": int(starts[a]), "end": int(ends[b])} for a, b in zip(first, last)]


def _char_bounds(text: str, blank: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and last character offsets of the words of a text."""
    starts, ends = word_bounds(blank)
    raw = text.encode("utf-8", "surrogatepass")
    # Characters before a byte: bytes that do not continue one.
    lead = (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(lead)])
    return before[starts], before[ends]


# ------------------------------------------- beyond the size of an automaton


def _places(words: list[bytes], lengths: list[int], bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each window length: which of 2^bits the window at every word sets."""
    one = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
    total, factor = np.zeros(len(one), dtype=np.uint64), 1
    for n in range(1, min(max(lengths, default=0), len(words)) + 1):
        total = total[: len(one) - n + 1] + one[n - 1 :] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)
        if n in lengths:
            x = (total ^ (total >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(n)
            yield n, (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)


def _sieve(found: DataFrame) -> tuple[list[int], np.ndarray]:
    """The lengths of a table's windows, and the bitmap of their hashes. What
    comes to the driver is at most the bitmap, whatever the benchmark's size."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for pattern in batch.column(0).to_pylist():
                words = pattern.split(b" ")
                marks += [(n, int(bit[0])) for n, bit in _places(words, [len(words)], size)]
            lengths, bits = zip(*marks) if marks else ((), ())
            yield pa.record_batch([pa.array(lengths, pa.int32()), pa.array(bits, pa.int64())], names=["n", "bit"])

    size = SIEVE_BITS
    marks = stored(found.select("pattern").mapInArrow(mark, "n int, bit long").distinct(), "benchmark-marks")
    lengths = [r["n"] for r in marks.select("n").distinct().collect()]
    one = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    rows = marks.groupBy(F.expr("bit div 64").alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (size - 6), dtype=np.int64)
    bitmap[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return lengths, bitmap.view(np.uint64)


def _text_key(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _sifted(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_words, first, n, start, end, pattern``: a row per
    document (``first`` -1, in ``n`` the number of its places), and one for
    every place whose window passes the bitmap."""
    lengths, bitmap = _sieve(found)
    size = int(len(bitmap)).bit_length() + 5
    sieve = docs.sparkSession.sparkContext.broadcast(bitmap)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = sieve.value
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(2)):
                own, rows = [], []
                for i, text in enumerate(texts, at):
                    blank = word_bytes(text)
                    words, places, bounds = blank.split(), [], None
                    for n, bit in _places(words, lengths, size):
                        passed = marked[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)
                        for first in np.flatnonzero(passed).tolist():
                            bounds = bounds or _char_bounds(text, blank)
                            start, end = int(bounds[0][first]), int(bounds[1][first + n - 1])
                            places.append((0, first, n, start, end, b" ".join(words[first : first + n])))
                    rows += [(len(words), -1, len(places), 0, 0, None), *places]
                    own += [i] * (len(places) + 1)
                at += len(texts)
                long = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:5]]
                pattern = pa.array([r[5] for r in rows], pa.binary())
                yield pa.record_batch(
                    [batch.column(0).take(pa.array(own)), batch.column(1).take(pa.array(own)), *long, pattern],
                    names=["doc_id", "text_key", "n_words", "first", "n", "start", "end", "pattern"],
                )

    return stored(
        docs.select("doc_id", _text_key(F.col("text")).alias("text_key"), "text").mapInArrow(
            run,
            f"doc_id {kind}, text_key string, n_words long, first long, n long, start long, end long, pattern binary",
        ),
        "benchmark-places",
    )


def _confirmed(sifted: DataFrame, found: DataFrame) -> DataFrame:
    """``text_key, n_hit, items, spans`` of each distinct text that holds a
    window: its places joined with the table by the window itself."""
    places = stored(
        sifted.where("first >= 0").dropDuplicates(["text_key", "first", "n"]).drop("doc_id", "n_words"),
        "benchmark-distinct-places",
    )
    copies = places.groupBy("pattern").agg(F.count(F.lit(1)).alias("copies"))
    table = stored(found.join(copies, "pattern"), "benchmark-met")
    by_text = (
        joined_by(places, table, "pattern", "copies", places.count())
        .groupBy("text_key")
        .agg(
            F.array_sort(F.collect_list(F.struct("first", "n", "start", "end"))).alias("places"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, spans = [], []
            for places in batch.column(1).to_pylist():
                hit, to, own = 0, -1, []  # ``to``: the word after the last hit one
                for p in places:
                    if p["first"] > to or not own:
                        own.append({"start": p["start"], "end": p["end"]})
                        to = p["first"]
                    over = p["first"] + p["n"] - to
                    if over > 0:
                        hit, to, own[-1]["end"] = hit + over, to + over, p["end"]
                n_hit.append(hit)
                spans.append(own)
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch(
                [batch.column(0), pa.array(n_hit, pa.int64()), batch.column(2), pa.array(spans, span)],
                names=["text_key", "n_hit", "items", "spans"],
            )

    return stored(
        by_text.mapInArrow(merge, f"text_key string, n_hit long, items array<string>, spans {SPANS}"),
        "benchmark-confirmed",
    )


def _scan_joined(docs: DataFrame, found: DataFrame) -> DataFrame:
    """:func:`scan`'s rows without an automaton."""
    sifted = _sifted(docs, found)
    none = (F.lit(0).cast("long"), F.array().cast("array<string>"), F.array().cast(SPANS))
    rows = sifted.where("first = -1")
    met = rows.where("n > 0").select("doc_id", "text_key", "n_words")
    copies = met.groupBy("text_key").agg(F.count(F.lit(1)).alias("copies"))
    table = copies.join(_confirmed(sifted, found), "text_key", "left").select(
        "text_key", "copies", *(F.coalesce(c, v).alias(c) for c, v in zip(("n_hit", "items", "spans"), none))
    )
    hit = joined_by(met, stored(table, "benchmark-texts"), "text_key", "copies", met.count())
    clear = rows.where("n = 0").select("doc_id", "n_words", *(v.alias(c) for c, v in zip(("n_hit", "items", "spans"), none)))
    return hit.select(clear.columns).unionByName(clear)


def _clean_joined(docs: DataFrame, found: DataFrame, text_col: str) -> DataFrame:
    """:func:`clean`'s rows without an automaton. Texts of many rows are decided
    by broadcast, so no task gets the copies of one."""
    texts = docs.select(F.lit(0).alias("doc_id"), docs[text_col].alias("text"))
    sifted = _sifted(texts, found)
    bad = _confirmed(sifted, found).select(F.col("text_key").alias("bad_key"))
    rows = sifted.where("first = -1").groupBy("text_key").agg(F.count(F.lit(1)).alias("copies"))
    total = sifted.where("first = -1").count()
    hot = stored(rows.where(F.col("copies") * HOT_KEYS > total).select(F.col("text_key").alias("hot_key")), "benchmark-hot")
    spared = hot.join(bad, F.col("hot_key") == F.col("bad_key"), "left_anti")
    key = _text_key(docs[text_col])
    rest = docs.join(F.broadcast(hot), key == hot["hot_key"], "left_anti")
    return docs.join(F.broadcast(spared), key == spared["hot_key"], "left_semi").unionAll(
        rest.join(bad, key == bad["bad_key"], "left_anti")
    )


# ------------------------------------------------------------------ documents


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
         id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans`` of every document.

    ``items`` are the ids (as text, sorted as text) of the items with a window
    in the document, ``spans`` the hit passages as character offsets of the
    original text. A null text has no words. Repeated rows are scanned each;
    an empty benchmark hits nothing.
    """
    ship(docs.sparkSession)
    found = stored(windows(benchmark, window, item_col, item_text_col), "benchmark-windows")
    text = F.coalesce(docs[text_col], F.lit(""))
    named = docs.select(docs[id_col].alias("doc_id"), text.alias("text"))
    if _weight(found) > block_bytes:
        return _scan_joined(named, found)
    patterns = _pattern_list(found)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_hit, items, spans = [], [], [], []
            for texts in _slices(batch.column(1)):
                blanked = [word_bytes(t) for t in texts]
                for text, blank, (n, mask, found) in zip(texts, blanked, _scan(blanked, patterns)):
                    n_words.append(n)
                    n_hit.append(int(mask.sum()))
                    items.append(sorted(found))
                    spans.append(_spans(text, blank, mask) if n_hit[-1] else [])
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["doc_id", "n_words", "n_hit", "items", "spans"],
            )

    return named.mapInArrow(run, f"doc_id {kind}, n_words long, n_hit long, items array<string>, spans {SPANS}")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
          text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; all columns stay.

    Documents with null or empty texts are clean and stay.
    """
    ship(docs.sparkSession)
    found = stored(windows(benchmark, window), "benchmark-windows")
    if _weight(found) > block_bytes:
        return _clean_joined(docs, found, text_col)
    patterns = _pattern_list(found)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for texts in _slices(batch.column(at)):
                keep += [not mask.any() for _, mask, _ in _scan([word_bytes(t) for t in texts], patterns)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns of :func:`scan`'s rows."""
    return scanned.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
