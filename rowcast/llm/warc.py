"""WARC archives: write one record per page, read them back by boundary chains.

Writing is a text sink whose line separator is the record's closing blank
lines, so archives land on any file system Spark writes to. Of equal payloads
the page with the largest id is stored, the others are ``revisit`` records.

Reading splits archives like any text file, with the version line that opens
a record as separator. The same line may stand inside a payload, so a piece is
only a candidate record: its header gives the offset of the record after it.
Each task follows these successors inside its own split to the first offset
beyond it; between splits, pointer jumping from the start of every file finds
the reachable entry of each split in a logarithmic number of rounds. Only
records on the chain are kept; candidates inside payloads are not on it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowcast.llm.common import HOT_KEYS, Rounds, ship, stored
from rowcast.runtime import scratch_path

# Fixed values of the format: version line, line end, end of a record, base32 digits.
MAGIC = "WARC/1.1\r\n"
CRLF = "\r\n"
CLOSE = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SKIP = len(MAGIC)

CELL = 1 << 20  # bytes of an archive within which pieces look for their record

CANDIDATES = (
    "file string, block long, rel long, succ long, exit long, whole boolean, kind string, "
    "page string, refers string, said_bytes long, said_digest string, bytes long, digest string"
)


def sha1_base32(text: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string's UTF-8 bytes."""
    digest = F.sha1(text)
    out = []
    for group in range(8):  # five hex digits are four base32 digits
        v = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(v, shift).bitwiseAND(F.lit(31)) + 1
            out.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*out)


def records(pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
            id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``record``: the text of each page's record, without the closing blank lines.

    Pages whose payload has at least ``min_bytes`` bytes and equals that of a
    page with a larger id become revisits of it. A null payload is empty. Rows
    that repeat the largest id are all stored; a null id is never revisited.
    """
    rows = pages.select(
        pages[id_col].alias("page_id"),
        F.coalesce(pages[url_col], F.lit("")).alias("url"),
        F.coalesce(pages[payload_col], F.lit("")).alias("payload"),
    ).withColumns({"size": F.octet_length("payload"), "digest": sha1_base32(F.col("payload"))})
    # Only payloads that occur twice are listed, and written down first: the
    # planner then knows the list's size and moves the pages only if it must.
    twice = stored(
        rows.where(F.col("size") >= min_bytes)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 and first_id is not null"),
        "warc-copies",
    )
    # Payloads of many pages are fewer than HOT_KEYS and broadcast. Their pages
    # then look for nothing in the rest of the list, each under a key of its own.
    repeated = twice.agg(F.sum("copies")).first()[0] or 0
    often = F.col("copies") * HOT_KEYS > repeated
    hot = twice.where(often).select("digest", "size", F.col("first_id").alias("hot_id"))
    rest = twice.where(~often).select(F.col("digest").alias("key"), "size", "first_id")
    own = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    typed = (
        rows.join(F.broadcast(hot), ["digest", "size"], "left")
        .withColumn("key", F.when(F.col("hot_id").isNull(), F.col("digest")).otherwise(own))
        .join(rest, ["key", "size"], "left")
        .withColumn("first_id", F.coalesce("hot_id", "first_id"))
        .withColumn("refers", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))
    )
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("size").cast("string"),
        F.lit(CLOSE),
    )
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit(CRLF))
    # A header value holds no line ends: control characters and blanks are escaped.
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    common = F.concat(
        line("WARC-Record-ID", name),
        F.when(F.length("url") > 0, line("WARC-Target-URI", url)).otherwise(F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("size").cast("string")),
    )
    response = F.concat(
        F.lit(f"{MAGIC}WARC-Type: response{CRLF}"),
        common,
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.col("size")).cast("string")),
        F.lit(CRLF),
        http,
        F.col("payload"),
    )
    revisit = F.concat(
        F.lit(f"{MAGIC}WARC-Type: revisit{CRLF}"),
        common,
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers").cast("string"), F.lit(">"))),
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("Content-Length", F.lit("0")),
        F.lit(CRLF),
    )
    return typed.select(F.when(F.col("refers").isNull(), response).otherwise(revisit).alias("record"))


def write(pages: DataFrame, path: str, **options) -> None:
    """Write uncompressed archives of ``pages`` below ``path``."""
    records(pages, **options).write.option("lineSep", CLOSE).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, block``: the text after each version line, in file order
    within a split. The first piece of a file is what precedes its first one."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(piece: bytes) -> tuple[int, dict[str, str]] | None:
    """Where the block begins and the header fields; None if it is no header."""
    at = piece.find(b"\r\n\r\n")
    if at < 0:
        return None
    fields = {}
    for row in piece[:at].split(b"\r\n"):
        key, colon, value = row.partition(b":")
        if not colon:
            return None
        fields[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit():
        return None
    return at + 4, fields


def _payload(block: bytes) -> bytes:
    """The body of an HTTP response block."""
    return block[block.find(b"\r\n\r\n") + 4 :]


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per version line: offset in its split, successor, first
    successor beyond the split, header fields, payload size and digest.

    Offsets count from the split's first piece. ``succ`` and ``exit`` are null
    where no header can be read or the chain breaks. ``whole`` says that the
    piece is exactly one record; else its payload holds a version line and is
    put together later. Every split also gives its length, as ``rel`` of a row
    without a kind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, found, length = None, [], 0

        def close() -> pa.RecordBatch:
            exits: dict[int, int | None] = {}
            for row in reversed(found):
                succ = row["succ"]
                row["exit"] = succ if succ is None or succ >= length - SKIP else exits.get(succ)
                exits[row["rel"]] = row["exit"]
            end = {"rel": length}
            rows = [{"file": here[0], "block": here[1], **r} for r in [*found, end]]
            return pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

        for batch in batches:
            for value, file, block in zip(batch.column(0), batch.column(1), batch.column(2)):
                piece, where = value.as_py(), (file.as_py(), block.as_py())
                if where != here:
                    if here is not None:
                        yield close()
                    here, found, length = where, [], 0
                rel = length - SKIP
                length += len(piece) + SKIP
                if rel < 0 and where[1] == 0:
                    continue  # what stands before the file's first version line
                row = {"rel": rel, "kind": "none", "succ": None, "whole": False}
                header = _header(piece)
                if header:
                    at, fields = header
                    size = at + int(fields["content-length"])
                    row |= {
                        "succ": rel + SKIP + size + len(CLOSE),
                        "whole": len(piece) == size + len(CLOSE) and piece.endswith(b"\r\n\r\n"),
                        "kind": fields.get("warc-type", "none"),
                        "page": fields.get("warc-record-id", "")[10:-1],
                        "refers": fields.get("warc-refers-to", "")[10:-1] or None,
                        "said_bytes": int(fields.get("x-payload-length", -1)),
                        "said_digest": fields.get("warc-payload-digest", "")[5:],
                    }
                    if row["whole"] and row["kind"] == "response":
                        payload = _payload(piece[at:size])
                        row |= {"bytes": len(payload), "digest": _digest(payload)}
                found.append(row)
        if here is not None:
            yield close()

    SCHEMA = pa.schema(
        [
            (n, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[t])
            for n, t in (c.split() for c in CANDIDATES.split(", "))
        ]
    )
    ship(spark)
    return _pieces(spark, path).mapInArrow(run, CANDIDATES)


def chain(found: DataFrame) -> DataFrame:
    """The rows of :func:`candidates` on the chain of their file, with ``at``
    and ``after``, their absolute offset and that of the next record."""
    ends = found.where("kind is null")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select("file", "block", F.coalesce(F.sum("rel").over(before), F.lit(0)).alias("base"))
    rows = stored(
        found.where("kind is not null")
        .join(base, ["file", "block"])
        .withColumns(
            {
                "at": F.col("rel") + F.col("base"),
                "after": F.col("succ") + F.col("base"),
                "leave": F.col("exit") + F.col("base"),
            }
        ),
        "warc-candidates",
    )
    # Entries: the file's start, and every offset at which some chain enters a split.
    targets = rows.where("leave is not null").select("file", F.col("leave").alias("at")).distinct()
    entries = rows.select("file", "at", "leave").join(
        targets.unionByName(rows.where("at = 0").select("file", "at")).distinct(), ["file", "at"], "left_semi"
    )
    jumps, found_at = Rounds(rows.sparkSession, "warc-jump"), Rounds(rows.sparkSession, "warc-reached")
    jump = jumps.put(entries.select("file", "at", F.col("leave").alias("to")).where("to is not null"))
    reached = found_at.put(entries.where("at = 0").select("file", "at"))
    n = reached.count()
    while True:
        step = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = found_at.put(reached.unionByName(step).distinct())
        more = reached.count()
        if more == n:
            break
        n = more
        far = jump.select("file", F.col("at").alias("to"), F.col("to").alias("end"))
        jump = jumps.put(jump.join(far, ["file", "to"]).select("file", "at", F.col("end").alias("to")))

    def follow(cands: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
        """The path through one split from its reached entry."""
        succ = dict(zip(cands["at"], cands["after"]))
        on = set()
        for at in starts["start"]:
            while at in succ and at not in on:
                on.add(at)
                at = succ[at]
        return cands[cands["at"].isin(on)]

    entered = rows.join(reached, ["file", "at"]).select(
        F.col("file").alias("in_file"), F.col("block").alias("in_block"), F.col("at").alias("start")
    )
    return rows.groupBy("file", "block").cogroup(entered.groupBy("in_file", "in_block")).applyInPandas(
        follow, rows.schema
    )


def _joined(spark: SparkSession, path: str, parted: DataFrame) -> DataFrame:
    """``file, at, bytes, digest`` of records whose payload holds a version line:
    their pieces are read again and put together, one record at a time."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, length = None, 0
        for batch in batches:
            rel = []
            for value, file, block in zip(batch.column(0), batch.column(1), batch.column(2)):
                if (where := (file.as_py(), block.as_py())) != here:
                    here, length = where, 0
                rel.append(length - SKIP)
                length += len(value.as_py()) + SKIP
            yield pa.record_batch([*batch.columns, pa.array(rel, pa.int64())], names=["value", "file", "block", "rel"])

    placed = _pieces(spark, path).mapInArrow(place, "value binary, file string, block long, rel long")
    bases = stored(
        placed.groupBy("file", "block").agg(F.sum(F.octet_length("value") + SKIP).alias("total")), "warc-blocks"
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = bases.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    cell = lambda at: F.expr(f"{at} div {CELL}")
    # A record opens in every cell it reaches into. Records on the chain do not
    # overlap, so a piece belongs to the last one opened before it, if any.
    opened = parted.select(
        "file", F.col("at").alias("start"), "after",
        F.explode(F.sequence(cell("at"), cell("(after - 1)"))).alias("cell"),
    ).withColumn("at", F.greatest("start", F.col("cell") * CELL))
    near = (
        placed.join(base, ["file", "block"])
        .withColumn("at", F.col("rel") + F.col("base"))
        .withColumn("cell", cell("at"))
        .join(opened.select("file", "cell").distinct(), ["file", "cell"], "left_semi")
        .select("file", "cell", "at", "value")
    )
    so_far = Window.partitionBy("file", "cell").orderBy("at", F.col("value").isNotNull())
    record = F.last(F.col("record"), ignorenulls=True).over(so_far)
    inside = (
        near.withColumn("record", F.lit(None).cast("struct<start: long, after: long>"))
        .unionByName(opened.select("file", "cell", "at", F.lit(None).cast("binary").alias("value"), F.struct("start", "after").alias("record")))
        .withColumn("record", record)
        .where("value is not null and at < record.after")
        .select("file", F.col("record.start").alias("start"), "at", "value")
    )

    def merge(values: list[bytes]) -> tuple[int, str]:
        record = MAGIC.encode().join(values)
        at, fields = _header(record)
        payload = _payload(record[at : at + int(fields["content-length"])])
        return len(payload), _digest(payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [merge([p["value"] for p in pieces]) for pieces in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array([m[0] for m in made], pa.int64()),
                 pa.array([m[1] for m in made], pa.string())],
                names=["file", "at", "joined_bytes", "joined_digest"],
            )

    return (
        inside.groupBy("file", "start")
        .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("pieces"))
        .mapInArrow(run, "file string, at long, joined_bytes long, joined_digest string")
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """``page, payload_bytes, payload_digest, record_type, refers_to, file, at``
    of every record on the chains of the archives below ``path``.

    A response's size and digest are those of the payload read; a revisit's
    come from its header. Ids are text. No archive gives no rows.
    """
    on = stored(chain(stored(candidates(spark, path), "warc-pieces")), "warc-chain")
    parted = on.where("kind = 'response' and not whole").select("file", "at", "after")
    size, digest = F.col("bytes"), F.col("digest")
    if not parted.isEmpty():
        on = on.join(_joined(spark, path, stored(parted, "warc-parted")), ["file", "at"], "left")
        size, digest = F.coalesce(size, "joined_bytes"), F.coalesce(digest, "joined_digest")
    stored_here = F.col("kind") == "response"
    return on.where("kind in ('response', 'revisit')").select(
        "page",
        F.when(stored_here, size).otherwise(F.col("said_bytes")).alias("payload_bytes"),
        F.when(stored_here, digest).otherwise(F.col("said_digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers").alias("refers_to"),
        "file",
        "at",
    )


def round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as archives, read them back: one row per page."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write(pages, path, **options)
    kind = pages.schema[options.get("id_col", "page_id")].dataType
    # An empty id stands for null; casting an empty text would be an error.
    own = lambda c: F.when(F.length(c) > 0, F.col(c)).cast(kind)
    return read(spark, path).select(
        own("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", own("refers_to").alias("refers_to")
    )
