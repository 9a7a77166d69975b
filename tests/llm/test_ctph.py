"""Context-triggered fingerprints: neighbours and edits against brute force."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rowcast.llm import ctph


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] if x == y else 1 + min(row[j], new[j - 1]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("ABC", min_size=1, max_size=70), st.text("ABC", min_size=1, max_size=70))
def test_alike_is_the_insert_delete_distance(a, b):
    run = min(ctph.SHARED_RUN, len(a), len(b))
    shared = any(a[i : i + run] in b for i in range(len(a) - run + 1))
    want = 1 - edit_distance(a, b) / (len(a) + len(b)) if shared or a == b else 0.0
    assert abs(ctph._alike(a, b) - want) < 1e-12


def texts(n, seed=2):
    rng = np.random.default_rng(seed)
    words = [f"wörd{i}" for i in range(500)]
    return [" ".join(rng.choice(words, int(rng.integers(1, 300)))) for _ in range(n)]


def test_probe_equals_brute_force(spark):
    rows = list(enumerate(texts(60))) + [(100, None), (101, ""), (102, "ab"), (103, "x" * 200_000), (104, "same"), (105, "same")]
    frame = spark.createDataFrame([(i, t, "p") for i, t in rows], "doc_id long, text string, part string")
    got = {r.doc_id: tuple(r)[1:] for r in ctph.edit_probe(frame.repartition(5)).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        m = len(text) // 3
        edited = text[: len(text) - m] + following[:m]
        f, e, n = map(ctph.fingerprint, (text, edited, following))
        want = (len(text), hashlib.sha256(edited.encode()).hexdigest(), f, e, ctph.likeness(f, e), ctph.likeness(f, n))
        assert got[i] == want, i
    assert len(got) == len(rows)


def test_edits_stay_near_and_others_do_not(spark):
    frame = spark.createDataFrame(list(enumerate(texts(200, 7))), "doc_id long, text string")
    rows = ctph.edit_probe(frame).collect()
    assert np.mean([r.near_edited for r in rows]) > 0.5
    assert np.mean([r.near_next for r in rows]) < 0.02
    assert all(0 <= r.near_edited <= 1 for r in rows)


def test_signature_is_bounded_and_repeated_rows_are_kept(spark):
    for t in ("a" * 100_000, "ab" * 5_000, " ", "é"):
        size, one, two = ctph.fingerprint(t).split(":")
        assert len(one) <= ctph.LETTERS and len(two) <= ctph.LETTERS and int(size) >= ctph.SMALLEST
    frame = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert ctph.edit_probe(frame).count() == 3
    one = ctph.edit_probe(frame.where("doc_id is null")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert ctph.edit_probe(frame.limit(0)).collect() == []
    assert ctph.fingerprints(frame).count() == 3


def slow_crc32(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (0xEDB88320 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def slow_fingerprint(text):
    """The fingerprint byte by byte, without any of the module's code."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    raw, word = text.encode("utf-8", "surrogatepass"), 2**32

    def mixed(byte):
        v = (byte + 1) * 0x9E3779B1 % word
        v = (v ^ v >> 15) * 0x85EBCA6B % word
        return v ^ v >> 13

    def hash_at(end):
        return sum(mixed(raw[end - i]) * (2 * i * i * 0x9E3779B1 % word | 1) for i in range(1, min(7, end) + 1)) % word

    def signature(size):
        cuts = [end for end in range(1, len(raw) + 1) if hash_at(end) < word // size]
        bounds = [0, *cuts[:63]]
        if bounds[-1] < len(raw):
            bounds.append(len(raw))
        return len(cuts), "".join(letters[slow_crc32(raw[a:b]) % 64] for a, b in zip(bounds, bounds[1:]))

    size = 4
    while size * 64 < len(raw):
        size *= 2
    while raw and size > 4 and signature(size)[0] < 32:
        size //= 2
    return f"{size}:{signature(size)[1]}:{signature(2 * size)[1]}"


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(0, 900))
def test_fingerprint_equals_a_byte_by_byte_version(seed, n):
    rng = np.random.default_rng(seed)
    text = "".join(rng.choice(list("abc dé中\U0001F600"), n)) if seed % 2 else "ab " * (n // 3)
    assert ctph.fingerprint(text) == slow_fingerprint(text)
