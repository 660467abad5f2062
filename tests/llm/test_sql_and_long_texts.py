"""Queries beside their SQL over the small tables, and texts longer than a task's slice."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sqlyard.llm import leaks, packing, periods, queries, ranked, simhash, substring, tokenfiles
from tests.oracle_check import compare, duck


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL.keys() - {"op11_ranked_search"}))
def test_sql(spark, sf, name):
    assert compare(spark, duck(sf), sf, queries.QUERIES[name], queries.ORACLE_SQL[name]) == []


@pytest.fixture(scope="module")
def long():
    """Some nine megabytes: random words, then a stretch that repeats them, then a short period."""
    rng = random.Random(1)
    words = [f"word{rng.randrange(10**6)}" for _ in range(780_000)]
    return " ".join([*words, *words[1000:1040], *["tick", "tock"] * 20_000])


def test_longer_than_a_slice(spark, long):
    assert len(long) > 8 << 20
    passage = " ".join(long.split()[5000:5020])
    docs = spark.createDataFrame([(2, long), (1, passage), (3, "short")], "doc_id long, text string")
    n = len(long.split())

    runs = {r.doc_id: r for r in periods.periodic_runs(docs).collect()}
    assert [(r.start, r.length, r.period) for r in runs[2].runs] == [(n - 40_000, 40_000, 2)] and runs[2].n_words == n
    assert len(runs[2].collapsed.split()) == n - 39_998

    cut = {r.doc_id: r for r in substring.remove_repeats(docs).collect()}
    assert (cut[2].n_words, cut[2].n_removed, cut[1].n_removed) == (n, 20, 0)

    items = spark.createDataFrame([(7, passage), (8, "tick tock " * 5)], "item_id long, text string")
    found = {r.doc_id: r for r in leaks.contamination(docs, items).collect()}
    assert (found[2].n_words, found[2].n_hit, found[2].n_items) == (n, 20 + 40_000, 2)

    best = ranked.search(docs, items).collect()
    assert {(r.item_id, r.rank, r.doc_id) for r in best} == {(7, 1, 1), (7, 2, 2), (8, 1, 2)}
    prints = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(docs).collect()}
    assert prints[2] == f"{simhash.fingerprint(long.encode()):016x}"


def test_long_text_as_tokens(spark, long):
    docs = spark.createDataFrame([(2, long), (1, "short")], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    n = len(Tokenizer.from_file(path).encode(long, add_special_tokens=False).ids) + 1
    pieces = [r for r in packing.pack_documents(docs, path).collect() if r.doc_id == 2]
    assert sum(r.length for r in pieces) == n and sorted(r.start for r in pieces) == list(np.arange(0, n, 4096))
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = Tokenizer.from_file(path).encode(long, add_special_tokens=False).ids
    got = {r.doc_id: r for r in tokenfiles.write_and_read(docs, path).collect()}
    assert got[2].n_tokens == len(ids) + 1 and got[2].start == got[1].n_tokens
