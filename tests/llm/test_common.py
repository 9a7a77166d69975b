"""Shared helpers: worker imports, table cuts, word bounds."""

import os
import re
import subprocess
import sys

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from rowcast.llm import common

SCRIPT = r"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {folder!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate())
from rowcast.llm import decontam, simhash
d = spark.createDataFrame([(1, "a b c"), (2, "d")], "doc_id long, text string")
print("ROWS", simhash.fingerprints(d).count(), decontam.clean(d, d.selectExpr("doc_id as item_id", "text").where("item_id = 2")).count())
"""


def test_workers_import_the_package_from_any_folder(scratch):
    """Only the driver knows the repository: neither the working folder nor
    PYTHONPATH leads the Python workers to it."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, folder=f"{scratch}/ck")],
                         capture_output=True, text=True, timeout=200, env=env, cwd=scratch)
    assert "ROWS 2 1" in out.stdout, out.stderr[-2000:]


@given(st.text(max_size=60))
def test_words_keep_their_places(text):
    blank = common.word_bytes(text)
    raw = text.encode("utf-8", "surrogatepass")
    assert len(blank) == len(raw)
    starts, ends = common.word_bounds(blank)
    found = [blank[a:b].decode("utf-8", "surrogatepass") for a, b in zip(starts, ends)]
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    assert found == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    assert [blank[a:b] for a, b in zip(starts, ends)] == blank.split()


def test_rounds_keep_the_last_table_only(spark):
    rounds = common.Rounds(spark, "round")
    table = rounds.put(spark.range(3))
    first = rounds.path
    table = rounds.put(table.where("id > 0"))
    assert sorted(r.id for r in table.collect()) == [1, 2]
    assert not os.path.exists(first.removeprefix("file:")) and os.path.exists(rounds.path.removeprefix("file:"))
    assert common.stored(spark.range(0), "none").count() == 0


def test_fold_is_the_crc_of_the_id_as_text(spark):
    import zlib

    rows = spark.createDataFrame([(i,) for i in [*range(50), None]], "i long")
    got = rows.select("i", common.fold(rows.i).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.i).encode() if r.i is not None else b"") % 5 for r in got)
    assert np.bincount([r.f for r in got]).min() > 0
