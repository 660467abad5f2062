"""Counts after edits are those of encoding the edited text whole."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sqlyard.llm.edits import EDITS, Counter, CountTree, count_edits

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
COUNTER = Counter(PATH, PATTERN)
TEXTS = st.text(alphabet=st.sampled_from("ab Z\n\t'stredlm19.,é  "), max_size=60)


def whole(text):
    return len(COUNTER.library.encode_ordinary(text))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Z\n\t'stredlm19.,é  "), max_size=400),
       st.lists(st.tuples(st.integers(0, 500), st.integers(0, 40), TEXTS), max_size=8), st.sampled_from([1, 2, 3, 64]))
def test_any_edits(text, edits, leaf):
    tree = CountTree(text, COUNTER, leaf)
    for at, removed, inserted in edits:
        at = min(at, len(text))
        text = text[:at] + inserted + text[at + removed:]
        tree.edit(at, removed, inserted)
        assert tree.text() == text and tree.total() == whole(text)
        assert tree.chars[1] == len(text)


def test_only_the_touched_region_is_encoded():
    tree = CountTree("many words stand here, " * 5000, COUNTER)
    COUNTER.encoded = 0
    tree.edit(60_000, 5, "other")
    assert COUNTER.encoded < 200


ROWS = [(1, "some words in a row, don't they? " * 30), (2, None), (3, ""), (4, "a"), (4, "a"), (None, "no id"), (5, "x" * 3000 + " " * 500)]


def test_query(spark):
    docs = spark.createDataFrame([(i, t, 9) for i, t in ROWS], "doc_id long, text string, n_tokens int")
    want = []
    for i, text in ROWS:
        now = text or ""
        for share, removed, inserted in EDITS:
            at = int(len(now) * share)
            now = now[:at] + inserted + now[at + removed:]
        want.append((i, whole(text or ""), whole(now), len(text or ""), len(now)))
    got = [tuple(r)[:5] for r in count_edits(docs, PATH, PATTERN).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert count_edits(docs.limit(0), PATH, PATTERN).collect() == []


@pytest.mark.parametrize("text", ["", "a", "\n\n\n"])
def test_small(text):
    tree = CountTree(text, COUNTER)
    tree.edit(0, 100, "b's")
    assert tree.total() == whole("b's")
