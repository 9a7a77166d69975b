"""WARC round trip with version lines and whole records inside payloads."""

import base64
import glob
import hashlib

import pytest

from rowcast.llm import warc


def brute(pages):
    rows, best = [], {}
    for page, _, html in pages:
        raw = (html or "").encode()
        if page is not None:
            best[raw] = max(best.get(raw, page), page)
    for page, _, html in pages:
        raw = (html or "").encode()
        first = best.get(raw)
        again = first is not None and page != first
        rows.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "revisit" if again else "response", first if again else None))
    return sorted(rows, key=str)


def case():
    fake = ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nHello\r\n\r\n")
    pages = [(i, f"http://x/{i}", f"<html>{'é' * (i * 7 % 90)}{i}</html>\r\n\r\n") for i in range(120)]
    pages += [(200, "u\r\nX: 1", "a WARC/1.1\r\n b"), (201, None, fake), (202, "u", fake * 3 + "WARC/1.1\r\n"),
              (203, "u", "WARC/1.1\r\nContent-Length: 40\r\n\r\n"), (204, "u", None), (205, "u", ""),
              (206, "u", "same"), (207, "u", "same"), (208, "u", "same"), (208, "u", "same"), (None, "u", "same"),
              (None, "u", "alone"), (209, "u", "z" * 30000 + fake + "y" * 3000), (210, "u", fake)]
    return pages


@pytest.mark.parametrize("split", ["128m", "700"])
def test_round_trip(spark, split):
    pages = case()
    frame = spark.createDataFrame([(*p, "k") for p in pages], "page_id long, url string, html string, digest string")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = sorted((tuple(r) for r in warc.round_trip(frame.repartition(3)).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert got == brute(pages)


def test_records_in_pieces_across_cells(spark, monkeypatch):
    """Payloads full of version lines, read in cells smaller than a record."""
    monkeypatch.setattr(warc, "CELL", 97)
    fake = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(i, "u", ("é" * i + fake) * (i % 4) + "WARC/1.1\r\n" * (i % 3) + str(i)) for i in range(60)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in warc.round_trip(frame.repartition(2)).collect()), key=str)
    assert got == brute(pages)


@pytest.mark.parametrize("hot_keys", [1, 4])
def test_payloads_of_many_pages(spark, monkeypatch, hot_keys):
    """One payload on a third of the pages, others on a few; some by broadcast, some not."""
    monkeypatch.setattr(warc, "HOT_KEYS", hot_keys)
    pages = [(i, f"u{i % 9}", "hot" if i % 3 else f"p{i % 41}") for i in range(300)] + [(7, "u", "hot"), (None, None, "hot")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in warc.round_trip(frame).collect()), key=str)
    assert got == brute(pages)


def test_no_shuffle_by_a_hot_payload(spark):
    pages = [(i, "u", "hot" if i % 3 else f"p{i}") for i in range(60)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = warc.records(frame)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "hashpartitioning(digest" not in plan and "hashpartitioning(key" in plan


def test_archives_follow_the_format(spark, scratch):
    frame = spark.createDataFrame([(1, "http://a b", "<p>é</p>"), (2, "u", "<p>é</p>")], "page_id long, url string, html string")
    warc.write(frame.coalesce(1), f"{scratch}/w")
    raw = b"".join(open(f, "rb").read() for f in glob.glob(f"{scratch}/w/part-*"))
    kinds = []
    while raw:
        assert raw.startswith(b"WARC/1.1\r\n")
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        n = int(fields[b"Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        kinds.append((fields[b"WARC-Type"], rest[:n].partition(b"\r\n\r\n")[2]))
        raw = rest[n + 4 :]
    assert sorted(kinds) == [(b"response", "<p>é</p>".encode()), (b"revisit", b"")]


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
