"""Rare words travel as counts; their shares come from the totals of their classes."""

import math

import numpy as np

from sqlyard.llm import lm


def test_rows_by_group_keep_their_order():
    classes = np.array([11, 0, 5, 4, 1, 0])
    order, spans, member = lm.Network(3, 4, 3, 2).by_group(classes)
    assert order.tolist() == [1, 4, 5, 2, 3, 0]
    assert spans == [(0, slice(0, 3)), (1, slice(3, 5)), (2, slice(5, 6))]
    assert member.tolist() == [0, 1, 0, 1, 0, 3]


def test_totals_and_counts_give_the_shares(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{k}" for k in rng.zipf(1.3, 40) % 500)) for i in range(30)] + [(30, None), (31, "")]
    model = lm.fit(spark.createDataFrame(rows, "doc_id long, text string"), breadth=2)
    n = {r["word"]: r["n"] for r in model.words.collect()}
    shares = model.shares.collect()
    assert shares
    assert all(math.isclose(r["share"], math.log(n[r["word"]] / model.totals[r["class"]]), abs_tol=1e-12) for r in shares)
    assert sum(model.totals) == sum(n[r["word"]] for r in shares)
    assert model.score().count() == 32
