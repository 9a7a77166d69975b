"""Small helpers the operators share: table cuts, text bytes, tokenizers."""

from __future__ import annotations

import base64
import io
import zipfile
from functools import lru_cache
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import rowcast
from rowcast.runtime import discard, scratch_path

# A-Z become a-z; every other ASCII byte that is neither a digit
# nor a letter separates words; bytes of 128 and above belong to words.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
# Keys with more than this fraction of the rows are joined by broadcast: fewer
# than HOT_KEYS of them can exist, whatever the table.
HOT_KEYS = 1000


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read again.

    Cuts the lineage: a lost executor rereads files instead of replaying the
    plan, and the planner sees the true size of what follows.
    """
    return Rounds(df.sparkSession, name).put(df)


class Rounds:
    """A table that an iteration writes anew each round; only the last is kept."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.path = spark, name, None

    def put(self, df: DataFrame) -> DataFrame:
        """Write ``df``, which may read the round before, then delete that."""
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        if self.path:
            discard(self.spark, self.path)
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)


def joined_by(rows: DataFrame, table: DataFrame, key: str, copies: str, total: int) -> DataFrame:
    """``rows`` joined with ``table``, which has one row per key and in
    ``copies`` the number of rows with it (dropped from the result).

    Keys that hold more than one of ``HOT_KEYS`` shares of all rows are
    broadcast, so no task gets the rows of a hot key; the rest is shuffled.
    """
    often = table.where(F.col(copies) * HOT_KEYS > total)
    hot = often.drop(copies)
    seldom = table.where(F.col(copies) * HOT_KEYS <= total).drop(copies)
    if often.isEmpty():
        return rows.join(seldom, key)
    cold_rows = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(cold_rows.join(seldom, key))


def ship(spark: SparkSession) -> None:
    """Make this package importable for the session's Python workers.

    Their path need not hold the folder the driver imported it from. The
    package's modules go, zipped, to the shared scratch folder once a session,
    and Spark hands them to every executor.
    """
    sc = spark.sparkContext
    if getattr(sc, "_rowcast_shipped", False):
        return
    root = Path(rowcast.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, f"{root.name}/{file.relative_to(root)}")
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'modules')}.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(packed.getvalue()))
    finally:
        out.close()
    sc.addPyFile(path.toString())
    sc._rowcast_shipped = True


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty), whatever else ``docs`` carries."""
    ship(docs.sparkSession)
    return docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )


def fold(id_col: Column, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (null id: fold of the empty text)."""
    return (F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds).cast("int")


def word_bytes(text: str) -> bytes:
    """UTF-8 of ``text``, A-Z lower-cased, every separator byte a blank; same length."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_TABLE)


def word_bounds(blank: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of :func:`word_bytes`' output."""
    inside = np.zeros(len(blank) + 2, dtype=np.int8)
    inside[1:-1] = np.frombuffer(blank, dtype=np.uint8) != 32
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


class Encoder:
    """A public tokenizer file, opened once per process by :func:`encoder`.

    ``.tiktoken`` rank files go through tiktoken, ``.json`` files through
    tokenizers; special-token strings in a text are ordinary text.
    """

    def __init__(self, path: str):
        self.path = path
        if path.endswith(".tiktoken"):
            import public_tokenizers
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            enc = tiktoken.Encoding(
                "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
            self.encode = enc.encode_ordinary
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.encode_special_tokens = True
            self.encode = lambda text: tok.encode(text, add_special_tokens=False).ids


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where the installed vocabulary file ``name`` lies."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)
