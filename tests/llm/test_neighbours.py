"""Nearest neighbours: recall against every pair, exact scores, copies, odd vectors."""

import math
import random

import numpy as np
import pytest

from sqlyard.llm import neighbours
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, score string, node int"


def cosine(a, b):
    a, b = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(a @ b / math.sqrt((a @ a) * (b @ b)))


def slow_nearest(rows, top=5):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(np.float32(x) != 0 for x in v):
            good.setdefault((i, tuple(np.float32(x) + 0.0 for x in v)))
    out = {}
    for i, v in good:
        if i % 50 == 0:
            found = {}
            for j, u in good:
                if j != i and len(u) == len(v):
                    found.setdefault(j, []).append(cosine(u, v))
            flat = sorted((-round(s, 9), j) for j, scores in found.items() for s in scores)
            out[i, v] = flat[:top]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "s", 1) for i, v in rows], SCHEMA).repartition(5)


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(400)]
    copy = rng.normal(size=12).tolist()
    rows += [(1000 + i, copy) for i in range(80)] + [(50, rows[3][1]), (50, rows[3][1]), (2000, [2 * x for x in copy])]
    rows += [(3000, None), (3050, []), (3100, [0.0] * 12), (3150, [math.nan] + [1.0] * 11), (3200, [None] + [1.0] * 11), (3250, [math.inf] * 12), (None, copy)]
    rows += [(4000, [1.0, 2.0]), (4001, [2.0, 1.0]), (4050, [1.0]), (4100, [1e30] * 12), (4101, [1e-30] * 12), (-50, [-0.0] * 11 + [1.0]), (-51, [0.0] * 11 + [1.0])]
    want = slow_nearest(rows)
    got = {}
    for r in neighbours.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, -round(r.score, 9), r.vec_id))
    by_id = {}
    for (i, _), found in want.items():
        by_id.setdefault(i, []).extend((k, *f) for k, f in enumerate(found, 1))
    assert {i: sorted(f) for i, f in got.items()} == {i: sorted(f) for i, f in by_id.items() if f}
    assert neighbours.nearest(frame(spark, []), F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("spread, enough", [(0.35, 300), (10.0, 1500)])
def test_recall(spark, spread, enough):
    """Vectors around centres, and vectors around nothing."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 64))
    rows = [(i, (centres[i % 40] + spread * rng.normal(size=64)).tolist()) for i in range(4000)]
    found = neighbours.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, enough=enough)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    matrix = np.array([v for _, v in rows], np.float32).astype(float)
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    hits = 0
    for q, held in got.items():
        scores = unit @ unit[q]
        assert all(abs(scores[v] - s) < 1e-12 for _, v, s in held)
        assert [k for k, _, _ in sorted(held)] == [1, 2, 3, 4, 5] and [s for _, _, s in sorted(held)] == sorted((s for *_, s in held), reverse=True)
        scores[q] = -2
        hits += len({v for _, v, _ in held} & set(np.argsort(-scores)[:5].tolist()))
    assert len(got) == 80 and hits / 400 >= 0.9


def test_levels_are_the_longest_with_enough(spark):
    rng = random.Random(6)
    digits, trees = 7, 3
    keys = {(t, n): (rng.randrange(3) << 6) + rng.choice((0, 1, 2, 33, 34, 47)) for t in range(trees) for n in range(200)}
    entries = spark.createDataFrame([(5, t, 0, k, n, n % 10 == 0) for (t, n), k in keys.items()], "dim int, tree int, deal int, key long, node long, asks boolean")
    askers = spark.range(0, 200, 10).withColumnRenamed("id", "asker")
    for enough in (4, 20, 60, 150, 601):
        levels = neighbours._levels(entries, askers, digits, enough)
        got = {r.asker: r.level for r in levels.collect()}
        near = {n: {d: {(t, m) for t in range(trees) for m in range(200) if keys[t, m] >> digits - d == keys[t, n] >> digits - d} for d in range(1, digits + 1)} for n in range(0, 200, 10)}
        assert got == {n: max((d for d, found in ds.items() if len(found) >= enough), default=0) for n, ds in near.items()}
        taken = {}
        for r in neighbours._collected(entries, levels, digits).collect():
            taken.setdefault(r.asker, []).extend(np.frombuffer(r.nodes, np.int64).tolist())
        assert {n: sorted(x) for n, x in taken.items()} == {n: sorted(m for _, m in near[n][d]) for n, d in got.items() if d}
