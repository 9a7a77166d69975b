"""Token counts: one exact histogram of encoded lengths answers every limit.

Documents are encoded once, each task counts lengths and only (length,
documents) pairs are shuffled. Suffix sums over the histogram then give, for
any context limit, the documents that reach it, the tokens they hold, the
tokens left after truncation, and every quantile of the length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowcast.llm.common import encoder, id_and_text, stored, tokenizer_path

BLOCK = 4096


def histogram(docs: DataFrame, tokenizer: str | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``n_tokens, n_docs``: documents per encoded length, exact.

    A null or empty text has 0 tokens. Every row counts, repeated ones too.
    Whole texts are encoded; an empty table gives no rows.
    """
    path = tokenizer or tokenizer_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        lengths: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                lengths[len(encode(text.as_py()))] += 1
        yield pa.record_batch(
            [pa.array(list(lengths.keys()), pa.int64()), pa.array(list(lengths.values()), pa.int64())],
            names=["n_tokens", "n_docs"],
        )

    part = id_and_text(docs, id_col, text_col).select("text")
    return (
        part.mapInArrow(count, "n_tokens long, n_docs long")
        .groupBy("n_tokens")
        .agg(F.sum("n_docs").alias("n_docs"))
    )


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Adds, per length ``L``: ``docs_ge`` and ``tokens_ge`` (documents of at
    least ``L`` tokens and their tokens), ``docs_le``, ``tokens_total``,
    ``truncated_total`` (tokens left if every document is cut at ``L``) and
    ``quantile`` (share of documents of at most ``L`` tokens).

    Sums run inside blocks of lengths; only block totals meet in one window.
    The histogram is written down first, as both read it.
    """
    rows = stored(hist, "token-histogram").withColumns(
        {"tokens": F.col("n_tokens") * F.col("n_docs"), "block": F.floor(F.col("n_tokens") / BLOCK)}
    )
    totals = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = totals.select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_after"),
        F.sum("d").over(everything).alias("docs_total"),
        F.sum("t").over(everything).alias("tokens_total"),
    )
    down = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    out = rows.join(base, "block").withColumns(
        {
            "docs_ge": F.sum("n_docs").over(down) + F.col("d_after"),
            "tokens_ge": F.sum("tokens").over(down) + F.col("t_after"),
        }
    )
    docs_le = F.col("docs_total") - F.col("docs_ge") + F.col("n_docs")
    return out.select(
        "n_tokens",
        "n_docs",
        "docs_ge",
        "tokens_ge",
        docs_le.alias("docs_le"),
        "tokens_total",
        (F.col("tokens_total") - F.col("tokens_ge") + F.col("n_tokens") * F.col("docs_ge")).alias("truncated_total"),
        (docs_le / F.col("docs_total")).alias("quantile"),
    )


def truncated_totals(hist: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context_limit, total``: tokens left when documents are cut at each limit.

    A limit joins the histogram as a length without documents, so the suffix
    sums answer it like any length that occurs, whether or not it does. An
    empty histogram leaves 0 tokens at every limit.
    """
    asked = hist.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(int(x)).cast("long") for x in sorted(set(limits))])).alias("n_tokens"),
        F.lit(0).cast("long").alias("n_docs"),
    )
    both = hist.select("n_tokens", "n_docs").unionByName(asked).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    found = suffix_sums(both).where(F.col("n_tokens").isin([int(x) for x in limits]))
    return found.select(F.col("n_tokens").alias("context_limit"), F.col("truncated_total").alias("total"))


def quantiles(sums: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``prob, n_tokens``: the smallest length reached by that share of documents."""
    asked = sums.select("n_tokens", "quantile", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    return asked.where(F.col("quantile") >= F.col("prob")).groupBy("prob").agg(F.min("n_tokens").alias("n_tokens"))
