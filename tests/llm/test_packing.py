"""Packing: pieces against the tokenizer, places against their rules."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowcast.llm import packing
from rowcast.llm.common import encoder, tokenizer_path

ODD = ["<|endoftext|>", "a" * 3000, "é日本  x\x1c\x85y", "1234567890 ½ Ⅷ", "  \n\n\t x  ", "don't DON'T we'll", "😀👍🏽 ok"]


def test_both_vocabulary_files_give_the_same_ids():
    fast, slow = encoder(tokenizer_path()), encoder(tokenizer_path("byte_bpe_50k.json"))
    rng = np.random.default_rng(0)
    words = ["the", " of", "Ère", "tionç", "\n", "###", "42", " ", "ß", "'s", "…"]
    texts = ODD + ["".join(rng.choice(words, 200)) for _ in range(50)]
    for t in texts:
        assert fast.encode(t) == slow.encode(t)


@pytest.mark.parametrize("path", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json"])
def test_pack_follows_its_rules(spark, path):
    rng = np.random.default_rng(3)
    texts = [" ".join(["tok"] * int(n)) for n in rng.integers(0, 120, 200)] + ODD + [None, "", "x " * 500, "x " * 500]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, "b")]
    frame = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, length int, piece string")
    limit = 64
    out = packing.pack(frame.repartition(4), max_len=limit, tokenizer=tokenizer_path(path), with_ids=True).collect()
    encode = encoder(tokenizer_path("byte_bpe_50k.json")).encode
    got = sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in out)
    want = []
    for i, t in rows:
        ids = [*encode(t or ""), 2]
        cuts = list(range(len(ids) % limit or limit, len(ids) + 1, limit))
        for k, (a, b) in enumerate(zip([0, *cuts], cuts)):
            part = ids[a:b]
            want.append((str(i), k, a, b - a, zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)))
    assert got == sorted(want)
    used = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= limit
    assert len(used) <= 1.05 * -(-sum(r.length for r in out) // limit) + 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_plan_uses_every_piece_once(sizes):
    counts = np.bincount(sizes, minlength=31) if sizes else np.zeros(31, int)
    used = np.zeros(31, int)
    bins = 0
    for repeats, content in packing.plan_bins(counts, 30):
        assert sum(content) <= 30 and repeats > 0
        bins += repeats
        for s in content:
            used[s] += repeats
    assert (used == counts).all()
    assert bins <= 2 * (sum(sizes) / 30) + 1


def one_by_one(sizes, limit):
    """Best-two-fit as a sequence of bins over a list of pieces, by trying all pairs."""
    left, bins = sorted(sizes, reverse=True), []
    while left:
        content, gap = [], limit
        for size in list(left):
            if size <= gap:
                left.remove(size)
                content.append(size)
                gap -= size
        if gap and len(content) > 1:
            small = content[-1]
            pairs = [(a + b, -a, b) for i, b in enumerate(left) for a in left[i + 1 :] if a + b <= small + gap]
            if pairs and max(pairs)[0] > small:
                _, a, b = max(pairs)
                left.remove(-a)
                left.remove(b)
                left = sorted([*left, small], reverse=True)
                content[-1:] = [b, -a]
        bins.append(content)
    return bins


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=40))
def test_plan_equals_best_two_fit_one_by_one(sizes):
    counts = np.bincount(sizes, minlength=25) if sizes else np.zeros(25, int)
    planned = [content for repeats, content in packing.plan_bins(counts, 24) for _ in range(repeats)]
    assert planned == one_by_one(sizes, 24)


def test_two_pieces_replace_the_smallest():
    counts = np.zeros(11, int)
    counts[[6, 3, 2]] = [1, 1, 2]  # 6+3 leaves a gap of 1; 6+2+2 fills the bin
    assert packing.plan_bins(counts, 10)[0] == (1, [6, 2, 2])


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
