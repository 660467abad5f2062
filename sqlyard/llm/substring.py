"""Repeated passages: documents meet on winnowed anchors, matches are extended both ways, long repeats removed."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sqlyard.llm.common import WordHashes, byte_values, carried, id_and_text, mix, per_batch, run_hashes, with_carry
from sqlyard.sources.tables import stored


class Anchors:
    """Winnowed anchors of many documents at once, from the concatenated hashes of their words.

    Every run of ``window`` words has one anchor: its ``seed_words``-gram of smallest hash, the leftmost of equals.
    Equal runs have equal anchors, wherever they stand. The *reach* of an anchor is the stretch of words
    covered by the runs that chose it: its match extended left and right as far as the choice goes.
    """

    def __init__(self, texts: list[bytes | None], hashes: WordHashes, window: int, seed_words: int):
        self.words = [t.split() if t else [] for t in texts]
        self.counts = np.array([len(w) for w in self.words], np.int64)
        n = int(self.counts.sum())
        h = np.fromiter((hashes[w] for ws in self.words for w in ws), np.uint64, n)
        self.begins = np.cumsum(self.counts) - self.counts
        doc = np.repeat(np.arange(len(texts)), self.counts)
        starts = np.flatnonzero(np.arange(n) + window <= (self.begins + self.counts)[doc])  # of runs inside one document
        grams = run_hashes(h, seed_words, 1)
        choices = window - seed_words + 1
        best, chosen = grams[starts], starts.copy()
        for j in range(1, choices):
            other = grams[starts + j]
            less = other < best
            best[less] = other[less]
            chosen[less] = (starts + j)[less]
        self.starts, self.run_doc = starts, doc[starts]
        self.run_hash = run_hashes(h, window, 2)[starts]
        new = np.r_[True, chosen[1:] != chosen[:-1]] if len(chosen) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        self.anchor_of_run = np.cumsum(new) - 1
        last = np.r_[first[1:], len(starts)] - 1 if len(first) else first
        self.doc, self.key = doc[starts[first]], grams[chosen[first]]
        self.left, self.right = starts[first], starts[last] + window if len(first) else first
        # the reach's own hash: its first and last runs, its length, and every run between
        sums = np.add.reduceat(mix(self.run_hash + (starts - self.left[self.anchor_of_run]).astype(np.uint64)), first) if len(first) else np.zeros(0, np.uint64)
        self.reach = mix(sums + self.key)


def _once_per_batch(key: np.ndarray, part: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Keeps the smallest document per (key, part) in its group; others of the batch are settled and go by their document.

    So a group that a third of all documents share gets one row per batch, not per document.
    """
    order = np.lexsort((doc, part, key))
    key, part, doc = key[order], part[order], doc[order]
    if len(key):
        same = np.r_[False, (key[1:] == key[:-1]) & (part[1:] == part[:-1])]
        again = same & np.r_[False, doc[1:] == doc[:-1]]
        key, part, doc, same = key[~again], part[~again], doc[~again], same[~again]
        begin = np.maximum.accumulate(np.where(~same, np.arange(len(key)), 0))
        settled = doc > doc[begin]
        key, part, doc, settled = (x[~same | settled] for x in (key, part, doc, settled))
        key = np.where(settled, mix(doc.view(np.uint64) + np.uint64(1)), key)
    else:
        settled = np.zeros(0, bool)
    return key.view(np.int64), part.view(np.int64), doc, settled


_ROWS = "key long, part long, doc_id long, settled boolean"


def _frame(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["key", "part", "doc_id", "settled"])


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    return batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), known


def _smallest_holder(rows: DataFrame) -> DataFrame:
    """Adds ``held``: a smaller document has the same (key, part); and ``forks``: the key has other parts too."""
    same, key = Window.partitionBy("key", "part"), Window.partitionBy("key")
    return rows.select(
        "*", (F.col("settled") | (F.min("doc_id").over(same) < F.col("doc_id"))).alias("held"),
        (~F.col("settled") & (F.min("part").over(key) < F.max("part").over(key))).alias("forks"),
    )


def _runs_of_open_reaches(window: int, seed_words: int):
    def build():
        hashes = WordHashes(3)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            opened = batch.column("opened").to_pylist()
            texts = [t if o else None for t, o in zip(byte_values(batch.column("text")), opened)]
            found = Anchors(texts, hashes, window, seed_words)
            ids, _ = _ids(batch)
            wanted = np.zeros(len(found.key), bool)
            begins = np.searchsorted(found.doc, np.arange(len(texts) + 1))
            for i, reaches in enumerate(opened):
                if reaches:
                    span = slice(begins[i], begins[i + 1])
                    wanted[span] = np.isin(found.reach[span], np.array(reaches, np.int64).view(np.uint64))
            runs = wanted[found.anchor_of_run] if len(found.key) else np.zeros(0, bool)
            key = mix(found.key[found.anchor_of_run[runs]] + found.run_hash[runs])
            return _frame(_once_per_batch(key, found.run_hash[runs], ids[found.run_doc[runs]]))
        return work
    return per_batch(build)


def _cut(window: int, seed_words: int):
    def build():
        hashes = WordHashes(3)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = byte_values(batch.column("text"))
            held, runs = batch.column("held").to_pylist(), batch.column("runs").to_pylist()
            found = Anchors(texts, hashes, window, seed_words)
            begins = np.searchsorted(found.doc, np.arange(len(texts) + 1))
            run_begins = np.searchsorted(found.run_doc, np.arange(len(texts) + 1))
            removed, kept_texts, digests, spans = [], [], [], []
            for i, words in enumerate(found.words):
                n, begin = len(words), found.begins[i]
                change = np.zeros(n + 1, np.int64)
                if held[i]:
                    span = slice(begins[i], begins[i + 1])
                    hit = np.isin(found.reach[span], np.array(held[i], np.int64).view(np.uint64))
                    np.add.at(change, found.left[span][hit] - begin, 1)
                    np.add.at(change, found.right[span][hit] - begin, -1)
                if runs[i]:
                    span = slice(run_begins[i], run_begins[i + 1])
                    hit = np.isin(found.run_hash[span], np.array(runs[i], np.int64).view(np.uint64))
                    np.add.at(change, found.starts[span][hit] - begin, 1)
                    np.add.at(change, found.starts[span][hit] + window - begin, -1)
                gone = np.cumsum(change[:-1]) > 0
                step = np.diff(np.r_[0, gone.astype(np.int8), 0])
                spans.append(list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist())))
                cut = bool(gone.any())
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if cut else b" ".join(words)
                removed.append(int(gone.sum()))
                kept_texts.append(kept.decode() if cut else None)
                digests.append(hashlib.sha256(kept).hexdigest())
            return with_carry(batch, {
                "doc_id": batch.column("doc_id"), "n_words": pa.array(found.counts), "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))),
                "kept_text": pa.array(kept_texts, pa.string()),
            })
        return work
    return per_batch(build)


def remove_repeats(
    docs: DataFrame, window: int = 13, seed_words: int = 5, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """Removes words of repeats of at least ``window`` words whose first holder is a smaller document.

    Returns ``(doc_id, n_words, n_removed, kept_sha256, spans, kept_text)`` per row: word counts, the digest of
    the kept words joined by one blank, the maximal removed repeats as word ranges, and, where words were removed,
    the kept words. Columns in ``carry`` come along in a struct ``carry``.

    Seeds: every run of ``window`` words has one winnowed anchor, so two documents that share a run share its
    anchor. Extension: first an anchor's whole reach is compared with those of all other documents (one row
    per anchor); where reaches differ although the anchor is the same, the runs inside the first holder's
    reach are compared one by one. Comparison is by equality of two 64-bit hashes each time, grouped, never
    in pairs. Matched runs that overlap or touch grow together to maximal repeats.

    Null text has no words. Rows without an id are kept whole and count as no holder. Rows that repeat an id
    are judged as one document and each returned; repeats inside one document stay.
    """
    everything = id_and_text(docs, id_col, text_col, carry)
    rows = everything.select("doc_id", "text")

    def seeds():
        hashes = WordHashes(3)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, known = _ids(batch)
            texts = [t if k else None for t, k in zip(byte_values(batch.column("text")), known)]
            found = Anchors(texts, hashes, window, seed_words)
            return _frame(_once_per_batch(found.key, found.reach, ids[found.doc]))
        return work

    matched = _smallest_holder(rows.mapInArrow(per_batch(seeds), _ROWS)).where("held OR forks")
    reaches = stored(
        matched.groupBy("doc_id").agg(
            F.collect_list(F.when(F.col("held"), F.col("part"))).alias("held"),
            F.collect_list(F.when(~F.col("held"), F.col("part"))).alias("opened"),
        ), "reaches")
    placed = rows.join(reaches.where(F.size("opened") > 0).select("doc_id", "opened"), "doc_id")
    runs = _smallest_holder(placed.mapInArrow(_runs_of_open_reaches(window, seed_words), _ROWS))
    runs = stored(runs.where("held").groupBy("doc_id").agg(F.collect_list("part").alias("runs")), "runs")
    marked = everything.join(reaches.select("doc_id", "held"), "doc_id", "left").join(runs, "doc_id", "left")
    return marked.mapInArrow(_cut(window, seed_words), carried(
        everything,
        "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<first: long, stop: long>>, kept_text string"))
