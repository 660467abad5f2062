"""Periodic runs against a plain check of every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from sqlyard.llm import periods, queries

EMPTY = "doc_id long, text string"


def slow_runs(words, least=24, repeats=3):
    """Every maximal stretch of every period; of equal stretches the smallest period."""
    found, n = {}, len(words)
    for p in range(1, n // repeats + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, repeats * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((start, length, p) for (start, length), p in found.items())


def collapsed(words, runs):
    gone = {i for start, length, p in runs for i in range(start + p, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(rng):
    few = ["", None, "   ", "a", "a " * 23, "a " * 24, "a " * 25, "a b " * 12, "a b c " * 9 + "a b", "x " * 5000, "x y " * 900 + "z " * 800 + "x y " * 400]
    for period in (1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 33, 60, 127, 128, 129, 200):
        unit = [f"u{rng.randrange(3 * period)}" for _ in range(period)]
        for times in (2.9, 3, 3.3, 5, 11):
            lead, tail = ([f"n{rng.randrange(10**6)}" for _ in range(rng.randrange(40))] for _ in range(2))
            few.append(" ".join([*lead, *(unit * 12)[: round(period * times)], *tail]))
    for letters in (1, 2, 3):
        few += [" ".join(rng.choice("abc"[:letters]) for _ in range(rng.randrange(400))) for _ in range(25)]
    fib = ["a", "b"]
    while len(fib) < 1000:
        fib = [*fib, *fib[: rng.choice((len(fib) // 2, len(fib)))]]
    inner = "p q r " * 30
    return [*few, " ".join(fib), (inner + "s ") * 7, "\x00 \x0b\x1c a\xa0b " * 30, "Été " * 30 + "\x85 " * 40]


@pytest.mark.parametrize("least, repeats", [(24, 3), (5, 2), (1, 2), (9, 4), (2, 3)])
def test_tiles(least, repeats):
    rng = random.Random(least)
    raw = [t.encode() if t is not None else None for t in texts(rng) if len(t or "") < 4000]
    tiles = periods.Tiles(raw, least, repeats)
    parts = {}
    for doc, first, stop, step, at, mid, words in tiles.rows():
        ids = periods.np.frombuffer(words, "i4").tolist()
        assert len(ids) <= 2 * step + stop
        for p, left, right in periods.fragments(ids, mid, first, stop, step, least, repeats):
            parts.setdefault((doc, p), []).append((at - left, at + right))
    for doc, text in enumerate(raw):
        found = {}
        for (d, p), spans in sorted(parts.items()):
            if d == doc:
                whole = []
                for a, b in sorted(spans):
                    if whole and a <= whole[-1][1]:
                        whole[-1][1] = max(whole[-1][1], b)
                    else:
                        whole.append([a, b])
                for a, b in whole:
                    if b - a + p >= max(least, repeats * p):
                        found.setdefault((a, b - a + p), p)
        assert sorted((a, n, p) for (a, n), p in found.items()) == slow_runs((text or b"").split(), least, repeats)


def test_periodic_runs(spark):
    rows = [(i, t) for i, t in enumerate(texts(random.Random(7)))]
    rows += [(None, "a b " * 40), (None, None), (3, "a b " * 40), (3, "a b " * 40), (3, "b " * 50)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, digest int, runs string").repartition(3)
    want = []
    for i, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        runs = slow_runs(words)
        want.append((i, len(words), sorted((s, p, n) for s, n, p in runs), collapsed(words, runs)))
    got = [(r.doc_id, r.n_words, [(x.start, x.period, x.length) for x in r.runs], r.collapsed) for r in periods.periodic_runs(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert periods.periodic_runs(spark.createDataFrame([], EMPTY)).collect() == []


def test_query(spark, tmp_path):
    """The digests and the strongest run of the named query, with the period it plants."""
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(500)))) for i in range(150)]
    rows += [(500 + i, None if i % 2 else " ") for i in range(20)] + [(None, "a " * 30), (8, "a " * 30)]
    spark.createDataFrame(rows, EMPTY).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        n, h = len(words), zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        runs = slow_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(runs, key=lambda r: (r[0], r[2])))
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs)))))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = queries.op13_periodic_runs(spark, f"{tmp_path}").select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(r.n_runs > 0 for r in got) > 10
