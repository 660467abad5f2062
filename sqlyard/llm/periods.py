"""Periodic runs of words: a document falls into overlapping tiles per octave of periods; tiles are solved apart and their fragments stitched."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlyard.llm.common import byte_values, id_and_text, mix, run_hashes, text_slices
from sqlyard.sources.tables import stored


def z_values(s: list[int]) -> list[int]:
    """At each place, how many values from there on equal those from the start on."""
    n = len(s)
    z = [n] * min(n, 1) + [0] * (n - 1)
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def octaves(n: int, least_length: int, repeats: int) -> Iterator[tuple[int, int, int]]:
    """``(first, stop, step)``: periods from ``first`` on before ``stop`` and how far apart their tiles' boundaries are.

    Words of a run with period p that equal the word p further on form a stretch of its length less p: ``(repeats - 1) * p``
    at least, and no less than ``step`` in any octave. So every stretch meets a boundary.
    """
    base = max(1, least_length // repeats)
    if base > 1:
        yield 1, base, (repeats - 1) * base
    while repeats * base <= n:
        yield base, 2 * base, (repeats - 1) * base
        base *= 2


def fragments(words: list[int], mid: int, first: int, stop: int, step: int, least_length: int, repeats: int) -> Iterator[tuple[int, int, int]]:
    """``(period, left, right)`` for a tile with its boundary at ``mid``: how far words before and behind the boundary equal
    those a period later, ``step`` words at most on either side.

    Two Z-functions give this for all periods at once: one of the words from the boundary on, one of the words before it, read
    backwards, over all words read backwards. A fragment that ends inside the tile on both sides and is too short for a run is left out.
    """
    ahead = z_values(words[mid:])
    before = words[:mid][::-1]
    behind = z_values(before + [-1] + words[::-1])
    at = len(before) + 1 + len(words) - mid  # place of the word before the boundary, read backwards
    for p in range(first, min(stop, len(words) - mid + 1)):
        right = min(ahead[p], step) if p < len(ahead) else 0
        left = min(behind[at - p], step) if before else 0
        if left + right and (left == step or right == step or left + right >= max(least_length - p, (repeats - 1) * p)):
            yield p, left, right


class Tiles:
    """Tiles of many documents at once that may hold a part of a run.

    A stretch that a run needs goes ``reach`` words or more to one side of each boundary in it, so a tile is left out where at no
    period of its octave the hash of the ``reach`` words before the boundary, or behind it, is found a period later.
    """

    def __init__(self, texts: list[bytes | None], least_length: int, repeats: int):
        self.words = [t.split() if t else [] for t in texts]
        counts = np.array([len(w) for w in self.words], np.int64)
        codes: dict[bytes, int] = {}
        n = int(counts.sum())
        self.codes = np.fromiter((codes.setdefault(w, len(codes)) for ws in self.words for w in ws), np.int32, n)
        self.begins = np.cumsum(counts) - counts
        self.ends = self.begins + counts
        steps = [step for _, _, step in octaves(2 * least_length * repeats, least_length, repeats)]
        self.reach = max(1, min(8, min(steps) // 2))
        self.hashes = run_hashes(mix(self.codes.astype(np.uint64)), self.reach, 1)
        self.found = [(first, stop, step, *self._boundaries(counts, first, stop, step, max(least_length, repeats * first)))
                      for first, stop, step in octaves(int(counts.max(initial=0)), least_length, repeats)]
        self.open = np.zeros(len(texts), bool)
        for *_, doc, _ in self.found:
            self.open[doc] = True

    def _boundaries(self, counts: np.ndarray, first: int, stop: int, step: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Document and place of the boundaries that have a match at one of the periods."""
        docs = np.flatnonzero(counts >= least)
        each = -(-counts[docs] // step)
        doc = np.repeat(docs, each)
        at = self.begins[doc] + step * (np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each))
        hit, h, k, last = np.zeros(len(doc), bool), self.hashes, self.reach, len(self.codes) - 1
        periods = np.arange(first, stop)
        rows = max(1, (1 << 20) // len(periods))
        for i in range(0, len(at), rows):
            some = at[i: i + rows, None]
            later = some + periods
            ahead = h[np.minimum(later, last)] == h[some]
            behind = (h[np.clip(later - k, 0, last)] == h[np.maximum(some - k, 0)]) & (later <= last + 1)
            hit[i: i + rows] = (ahead | behind).any(axis=1)
        return doc[hit], at[hit]

    def rows(self) -> Iterator[tuple[int, int, int, int, int, int, bytes]]:
        """``(document, first, stop, step, at, mid, words)`` per tile; ``at`` is the boundary's word number in its document."""
        for first, stop, step, docs, places in self.found:
            for doc, place in zip(docs.tolist(), places.tolist()):
                begin, end = int(self.begins[doc]), int(self.ends[doc])
                low, high = max(begin, place - step), min(end, place + step + stop)
                yield doc, first, stop, step, place - begin, place - low, self.codes[low:high].tobytes()


_TILES = "doc_id long, digest long, text string, first int, stop int, step int, at long, mid int, words binary"
_TILE_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
_FRAGMENTS = "doc_id long, digest long, period long, first long, stop long"
_NAMES = [part.split()[0] for part in _TILES.split(", ")]


def _digest(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _cut_up(least_length: int, repeats: int, tile_rows: int = 4096):
    """One row per open document with its text, and one per tile of it."""
    def run(batches):
        for batch in text_slices(batches):
            ids, texts = batch.column("doc_id").to_pylist(), byte_values(batch.column("text"))
            tiles = Tiles(texts, least_length, repeats)
            digests = {i: _digest(texts[i]) for i in np.flatnonzero(tiles.open).tolist()}
            rows = [(ids[i], d, texts[i].decode(), *[None] * 6) for i, d in digests.items()]
            for doc, *tile in tiles.rows():
                rows.append((ids[doc], digests[doc], None, *tile))
                if len(rows) >= tile_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TILE_KINDS)], _NAMES)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TILE_KINDS)], _NAMES)
    return run


def _solve(least_length: int, repeats: int):
    """Fragments ``(doc_id, digest, period, first, stop)`` of each tile; those that touch are joined within a batch."""
    def run(batches):
        for batch in batches:
            found: dict[tuple, list[tuple[int, int]]] = {}
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "digest", "first", "stop", "step", "at", "mid", "words"))):
                doc, digest, first, stop, step, at, mid, raw = row
                for p, left, right in fragments(np.frombuffer(raw, np.int32).tolist(), mid, first, stop, step, least_length, repeats):
                    found.setdefault((doc, digest, p), []).append((at - left, at + right))
            rows = []
            for key, parts in found.items():
                joined: list[list[int]] = []
                for low, high in sorted(parts):
                    if joined and low <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], high)
                    else:
                        joined.append([low, high])
                rows += [(*key, low, high) for low, high in joined]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "digest", "period", "first", "stop"])
    return run


def _stitched(parts: DataFrame, least_length: int, repeats: int) -> DataFrame:
    """``(doc_id, digest, runs)`` from fragments, dealt by document and period: those that touch are one stretch. Of equal stretches
    only the smallest period is one of a run; the others are its multiples."""
    key = ["doc_id", "digest", "period"]
    order = Window.partitionBy(*key).orderBy("first", "stop")
    islands = parts.distinct().withColumn("reached", F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "island", F.sum(F.when(F.col("first") <= F.col("reached"), 0).otherwise(1)).over(order))
    length = F.col("stop") - F.col("first") + F.col("period")
    whole = islands.groupBy(*key, "island").agg(F.min("first").alias("first"), F.max("stop").alias("stop")).select(
        "doc_id", "digest", F.col("first").alias("start"), length.alias("length"), "period",
    ).where((F.col("length") >= least_length) & (F.col("length") >= repeats * F.col("period")))
    least = whole.groupBy("doc_id", "digest", "start", "length").agg(F.min("period").alias("period"))
    return least.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))


def _without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join(w for w, g in zip(words, np.cumsum(gone[:-1]).tolist()) if not g).decode()


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RESULT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _result(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(_RUN), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, kinds)], ["doc_id", "n_words", "runs", "collapsed"])


def _settled(least_length: int, repeats: int):
    """Results of documents without any tile."""
    def run(batches):
        for batch in text_slices(batches):
            tiles = Tiles(byte_values(batch.column("text")), least_length, repeats)
            yield _result([(i, len(ws), [], b" ".join(ws).decode()) for i, ws, o in zip(batch.column("doc_id").to_pylist(), tiles.words, tiles.open) if not o])
    return run


def _opened(batches):
    """Results of documents with tiles, from their text and the runs that came of the tiles."""
    for batch in text_slices(batches):
        rows = []
        for i, text, runs in zip(batch.column("doc_id").to_pylist(), byte_values(batch.column("text")), batch.column("runs").to_pylist()):
            words, found = text.split(), [(r["start"], r["length"], r["period"]) for r in runs or ()]
            rows.append((i, len(words), [dict(zip(("start", "length", "period"), r)) for r in found], _without_repeats(words, found)))
        yield _result(rows)


def periodic_runs(docs: DataFrame, least_length: int = 24, repeats: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` per row of ``docs``.

    A run is a stretch of consecutive words whose smallest period is q (words q apart are equal), ``least_length`` words and ``repeats``
    periods long at least, that no neighbouring word extends at this period; ``runs`` holds ``(start, length, period)`` by start, then
    period. ``collapsed`` is the text's words without those that any run holds after its first period, joined by one blank.

    Each document is exploded into overlapping tiles per octave of periods, of a few times the octave's period each, so the work per
    octave is linear in the text and one long document is many rows. Tiles are solved independently by Z-functions at their
    boundary; the fragments are shuffled by document and period and stitched. Tiles in which no word pattern recurs at a
    period of the octave are not written at all, and a document without tiles is done where it is read: only the others
    are written, and joined to their runs.

    Null and empty texts have no words. Rows without an id and rows that repeat one each get their own text's result. A single text
    is cut up in one task, whose memory grows with it; its tiles are not.
    """
    if repeats < 2:
        raise ValueError("a run repeats its period at least once")
    rows = id_and_text(docs, id_col, text_col)
    cut = stored(rows.mapInArrow(_cut_up(least_length, repeats), _TILES), "tiles")
    parts = cut.where("words IS NOT NULL").select("doc_id", "digest", "first", "stop", "step", "at", "mid", "words").mapInArrow(
        _solve(least_length, repeats), _FRAGMENTS)
    runs = _stitched(parts, least_length, repeats).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "runs")
    opened = cut.where("text IS NOT NULL").select("doc_id", "digest", "text").join(
        runs, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left").select("doc_id", "text", "runs")
    return rows.mapInArrow(_settled(least_length, repeats), _RESULT).union(opened.mapInArrow(_opened, _RESULT))


def strongest(runs: Column | str) -> Column:
    """The run with the greatest exact length over period; of equals the first, then that of the smallest period. Null without runs."""
    runs = F.col(runs) if isinstance(runs, str) else runs

    def order(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(x > y, -1).when(x < y, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))
    return F.get(F.array_sort(runs, order), F.lit(0))


def with_planted_period(doc_id: Column | str, text: Column | str) -> Column:
    """The text with a period made by its id: with h the crc32 of the decimal id and n words, one text in ten (h % 10 = 0) repeats
    the words from a = g % n on at period 1 + (n - a) div (3 + g % 8), g = h div 10. Other texts stay as they are."""
    doc_id, text = (F.col(c) if isinstance(c, str) else c for c in (doc_id, text))
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")

    def planted(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        order = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(order, lambda i: F.get(words, i.cast("int"))), " "))

    # bound by a function's argument, the words are found once and not again for each of them
    found = F.get(F.transform(F.array(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))), planted), F.lit(0))
    return F.when(h % 10 == 0, F.coalesce(found, text)).otherwise(text)
