"""Chunk fingerprints against a byte-by-byte version, and the query's columns against plain Python."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sqlyard.llm import chunks
from sqlyard.llm.chunks import Fingerprint, boundaries, edit_likeness


def slow_boundaries(raw, least=12, normal=32, most=128):
    ends, h, size = [], 0, 0
    for i, b in enumerate(raw):
        h = ((h << 1) + int(chunks._GEAR[b])) & 0xFFFFFFFF
        size += 1
        bits = 7 if size <= normal else 3
        if size == most or size >= least and h >> (32 - bits) == 0:
            ends.append(i + 1)
            size = 0
    return ends + [len(raw)] * bool(size)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000))
def test_boundaries(raw):
    assert boundaries(raw) == slow_boundaries(raw)


def test_boundaries_of_runs():
    for raw in (b"", b"a", b"a" * 1000, b"ab" * 400):
        assert boundaries(raw) == slow_boundaries(raw)


def test_shift_resistance():
    text = " ".join(f"word{i * i % 977}" for i in range(800)).encode()
    moved = Fingerprint(b"something in front " + text)
    assert Fingerprint(text).likeness(moved) > 0.95
    assert Fingerprint(text).containment(Fingerprint(text + b" and more" * 300)) > 0.95
    assert Fingerprint(text).likeness(Fingerprint(text)) == 1 == Fingerprint(b"").likeness(Fingerprint(b""))
    assert Fingerprint(text).likeness(Fingerprint(b"")) == 0


ROWS = [(5, "five " * 40), (3, None), (9, "nine is here, " * 9), (1, ""), (7, "é" * 31), (3, "three"), (None, "no id"), (4, "five " * 40), (12, "z" * 5000)]


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_next_and_edit(spark, parts):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in ROWS], "doc_id long, text string, bucket string, guest string")
    got = sorted(edit_likeness(docs, parts).collect(), key=lambda r: (r.doc_id or -1, r.n_chars))
    order = sorted(((i, t or "") for i, t in ROWS), key=lambda r: (-(r[0] if r[0] is not None else -99), r[1]))
    want = []
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b = Fingerprint(text.encode()), Fingerprint(edited.encode())
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.name(), b.name(), a.likeness(b),
                     a.likeness(Fingerprint(following.encode()))))
    assert [tuple(r)[:7] for r in got] == sorted(want, key=lambda r: (r[0] or -1, r[1]))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert edit_likeness(docs, 3).collect() == [] and chunks.fingerprints(docs).collect() == []


def test_equal_texts_equal_fingerprints(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    names = {}
    for r in chunks.fingerprints(docs).collect():
        names.setdefault(r.fingerprint, set()).add(r.doc_id)
    assert {4, 5} in names.values() and {1, 3} in names.values()
