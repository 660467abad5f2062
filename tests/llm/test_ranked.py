"""Ranked search against scores of every document, and bounds against the sums they bound."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from sqlyard.llm import queries, ranked
from tests.oracle_check import compare, duck

WORDS = [f"w{i}" for i in range(60)] + ["Été", "naïve", "ß", "x1", "Don"]


def slow_search(docs, items, top=10):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    out = []
    for item, ts in wanted.items():
        scored = []
        for i, c in counts:
            m = 100 - 90 + (90 * c.total() * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def sentence(rng, n):
    return " ".join(WORDS[min(int(rng.expovariate(0.08)), len(WORDS) - 1)] for _ in range(n))


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    docs = [(i, sentence(rng, rng.randrange(1, 120))) for i in range(400)]
    copy = sentence(rng, 40)
    docs += [(1000 + i, copy) for i in range(60)] + [(None, copy), (None, None), (7, copy), (7, copy), (2000, ""), (2001, "..."), (2002, sentence(rng, 9000)), (-4, "W1-w2\x00w3's DON'T")]
    items = [(i, sentence(rng, rng.randrange(1, 40))) for i in range(25)]
    items += [(50, copy), (51, None), (52, ""), (53, "nowhere at all"), (None, "w1 w2"), (54, "w3"), (54, "Été W4"), (55, "w1 " * 50), (56, " ".join(WORDS))]
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"block_terms": 30, "shard_bytes": 4000}, {"pair_share": 2.0, "shard_bytes": 4000}, {"pair_share": 0.0, "shard_bytes": 60_000, "top": 3}])
def test_search(spark, tables, settings):
    docs, items = tables
    frame = spark.createDataFrame([(i, t, 1, "a") for i, t in docs], "doc_id long, text string, item_id int, term string").repartition(5)
    asked = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, score int")
    got = [tuple(r) for r in ranked.search(frame, asked, **settings).collect()]
    assert sorted(got, key=repr) == slow_search(docs, items, settings.get("top", 10))


def test_empty(spark, tables):
    docs, items = (spark.createDataFrame(rows, schema) for rows, schema in zip(tables, ("doc_id long, text string", "item_id long, text string")))
    assert ranked.search(docs.limit(0), items).collect() == []
    assert ranked.search(docs, items.limit(0)).collect() == []


def test_bounds_hold_and_pairs_tighten_them():
    rng = np.random.default_rng(2)
    tighter = 0
    for _ in range(60):
        n_docs, n_terms = 50, 6
        doc = [np.sort(rng.choice(n_docs, rng.integers(1, 40), replace=False)).astype(np.int32) for _ in range(n_terms)]
        impact = [rng.integers(1, 1000, len(d)) for d in doc]
        joint = ranked.joint_maxima(doc, impact, combinations(range(n_terms), 2), n_docs)
        shard = ranked.Shard(np.arange(n_terms), np.array([len(d) for d in doc]), np.concatenate(doc), np.concatenate(impact), joint, n_docs)
        order = sorted(range(n_terms), key=lambda t: shard.most[t])
        total = np.zeros(n_docs, np.int64)
        bounds, alone = shard.bounds(order, lambda a, b: True), shard.bounds(order, lambda a, b: False)
        for j, t in enumerate(order, 1):
            total[doc[t]] += impact[t]
            assert total.max() <= bounds[j] <= alone[j]
        tighter += bounds[-1] < alone[-1]
    assert tighter > 50


def test_query(spark, sf):
    name = "op11_ranked_search"
    assert compare(spark, duck(sf), sf, queries.QUERIES[name], queries.ORACLE_SQL[name]) == []
