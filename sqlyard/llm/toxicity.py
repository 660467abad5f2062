"""Toxicity: words as bags of character n-grams, averaged into a linear softmax, both trained together."""

from __future__ import annotations

import string
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlyard.llm.common import id_and_text, per_batch

_EDGES = string.punctuation + "«»„“”‚‘’…–—¡¿"


def words(text: str | None) -> list[str]:
    """Lower-case words at white space, without punctuation at their ends; words of punctuation only stay."""
    return [w.strip(_EDGES) or w for w in (text or "").lower().split()]


def grams(word: str, buckets: int, shortest: int = 3, longest: int = 5) -> list[int]:
    """Buckets of the word's character n-grams, its ends marked, and of the word itself."""
    marked = f"<{word}>"
    found = [marked[i: i + n] for n in range(shortest, longest + 1) for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g.encode("utf-8", "replace")) % buckets for g in (marked, *found)]


@dataclass
class Model:
    """Embeddings per bucket, softmax weights for two classes, and the width of the window that is averaged."""

    embedding: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    window: int

    def parts(self) -> tuple[np.ndarray, float, int]:
        """All that scoring needs: average and softmax are linear up to the last step, so a bucket's part of the
        log-odds is one number."""
        return self.embedding @ (self.weights[:, 1] - self.weights[:, 0]), float(self.bias[1] - self.bias[0]), self.window


def _windows(values: np.ndarray, window: int) -> np.ndarray:
    """Mean over every ``window`` neighbours; one mean over all where there are fewer."""
    if len(values) <= window:
        return values.mean(keepdims=True) if len(values) else np.zeros(1)
    sums = np.r_[0.0, np.cumsum(values)]
    return (sums[window:] - sums[:-window]) / window


class Scorer:
    """Score of a text: softmax of the average over its worst window of words, so length does not thin it out."""

    def __init__(self, part: np.ndarray, bias: float, window: int, most: int = 1 << 18):
        self.part, self.bias, self.window, self.most, self.known = part, bias, window, most, {}

    def word(self, word: str) -> float:
        if len(self.known) >= self.most:
            self.known.clear()
        self.known[word] = found = float(self.part[grams(word, len(self.part))].mean())
        return found

    def score(self, text: str | None) -> float:
        known = self.known
        values = np.array([known[w] if w in known else self.word(w) for w in words(text)], np.float64)
        return float(1 / (1 + np.exp(-np.clip(_windows(values, self.window).max() + self.bias, -500, 500))))


def _numbered(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, dict[str, int]]:
    """Word numbers of all texts in a row, four bytes each, how many each text has, and the words in the order of their numbers."""
    number: dict[str, int] = {}
    tokens, lengths = array("i"), array("q")
    for text in texts:
        found = words(text)
        tokens.extend([number.setdefault(w, len(number)) for w in found])
        lengths.append(len(found))
    return np.array(tokens, np.int32), np.array(lengths, np.int64), number


def _spans(sizes: np.ndarray, most: int = 1 << 18) -> list[tuple[int, int]]:
    """Consecutive items in spans whose sizes add up to ``most`` at most, or one alone."""
    stops, out, start = np.cumsum(sizes), [], 0
    while start < len(sizes):
        stop = int(np.searchsorted(stops, most + (stops[start - 1] if start else 0), "right"))
        out.append((start, max(stop, start + 1)))
        start = out[-1][1]
    return out


def train(
    texts: Iterable[str | None], labels: Sequence[int], buckets: int = 1 << 17, dim: int = 8, window: int = 8, rounds: int = 80, pace: float = 0.2,
    floor: float = 0.003, scale: float = 8.0, decay: float = 0.015, seed: int = 1,
) -> Model:
    """Full-batch descent with momentum on embeddings and softmax together.

    In the first third of the rounds a text counts by the average of all its words; then by its worst window, and
    a clean text by one window drawn at random as well. Classes weigh alike whatever their numbers. Steps are scaled per
    parameter by its own slopes, but by no less than ``floor`` of the largest, so n-grams that many texts share move
    and those of one text hardly do. Repeatable for the same rows in the same order.

    Texts are read once, before the labels, and held as one number a word; sums over words and n-grams go span by span, in the
    same order as in one piece.
    """
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.01, (buckets, dim))
    weights, bias = rng.normal(0, scale, (dim, 2)), np.zeros(2)
    tokens, lengths, number = _numbered(texts)
    y = np.array(labels, np.float64)
    if not number or y.min(initial=1) == y.max(initial=0):
        bias[:] = (0, 50) if len(y) and y.min() == 1 else (0, -50)
        return Model(embedding * 0, weights, bias, window)
    bags, ends = array("i"), array("q")  # numbers of four bytes, not a list of objects per word
    for w in number:
        bags.extend(grams(w, buckets))
        ends.append(len(bags))
    del number
    flat, stops = np.frombuffer(bags, np.int32), np.frombuffer(ends, np.int64)
    sizes = np.diff(stops, prepend=0)
    begins, by_word = stops - sizes, _spans(sizes)
    worth = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    firsts = np.cumsum(lengths) - lengths
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (embedding, weights, bias)]
    for step in range(rounds):
        apart = weights[:, 1] - weights[:, 0]
        # the average of embeddings meets the softmax as the average of their products with it
        value, odds = embedding @ apart, np.empty(len(sizes))
        for a, b in by_word:
            odds[a:b] = np.add.reduceat(value[flat[begins[a]: stops[b - 1]]], begins[a:b] - begins[a]) / sizes[a:b]
        begin, share, of = firsts, lengths, np.arange(len(lengths))
        if 3 * step >= rounds:
            at, picks, text = array("q"), array("q"), array("q")
            for i, (first, length) in enumerate(zip(firsts.tolist(), lengths.tolist())):
                starts = [0]
                if length > window:
                    means = _windows(odds[tokens[first: first + length]], window)
                    starts = sorted({int(means.argmax())} if y[i] else {int(means.argmax()), int(rng.integers(len(means)))})
                for start in starts:
                    at.append(first + start)
                    picks.append(min(length, window))
                    text.append(i)
            begin, share, of = np.array(at), np.array(picks), np.array(text)
        target, weight = y[of], worth[of]
        error, per_word = np.empty(len(share)), np.zeros(len(sizes))
        for a, b in _spans(share):
            n = share[a:b]
            bag = np.repeat(np.arange(b - a), n)
            place = tokens[np.arange(len(bag)) + np.repeat(begin[a:b] - (np.cumsum(n) - n), n)]
            logit = np.bincount(bag, odds[place], b - a) / np.maximum(n, 1) + bias[1] - bias[0]
            error[a:b] = (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - target[a:b]) * weight[a:b]
            np.add.at(per_word, place, (error[a:b] / np.maximum(n, 1))[bag])
        per_word, per_bucket = per_word / sizes, np.zeros(buckets)
        for a, b in by_word:
            np.add.at(per_bucket, flat[begins[a]: stops[b - 1]], np.repeat(per_word[a:b], sizes[a:b]))
        toward = embedding.T @ per_bucket
        slopes = (np.outer(per_bucket, apart), np.stack([-toward, toward], 1), np.array([-error.sum(), error.sum()]))
        for p, slope, (mean, square) in zip((embedding, weights, bias), slopes, moments):
            mean += 0.2 * (slope - mean)
            square += 0.05 * (slope * slope - square)
            size = np.sqrt(square)
            p -= pace * (1 - step / rounds) * mean / (size + floor * size.max() + 1e-12)
        embedding *= 1 - decay
    return Model(embedding, weights, bias, window)


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Whether a row is kept from training: its id's crc32, as text, divides by ``folds``. Rows without an id are."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = 12_000, **settings) -> tuple[np.ndarray, float, int]:
    """Trains on labelled rows that are not held out, in one task; returns what a ``Scorer`` is made of.

    The sample is bounded: of the labelled rows, the ``most_rows`` whose ids hash smallest, whole texts each.
    """
    labelled = labels.where("toxic IS NOT NULL").where(~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    chosen = labelled.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    rows = id_and_text(docs).join(chosen, "doc_id").select("doc_id", "text", "toxic")

    def learn(batches):
        toxic: list[int] = []

        def texts():
            for batch in batches:
                toxic.extend(batch.column("toxic").to_pylist())
                yield from batch.column("text").to_pylist()

        model = train(texts(), toxic, **settings)
        if toxic:
            parts, bias, width = model.parts()
            yield pa.RecordBatch.from_arrays([pa.array([parts.tobytes()]), pa.array([bias]), pa.array([width])], ["parts", "bias", "width"])

    ordered = rows.repartition(1).sortWithinPartitions("doc_id", F.asc_nulls_last("text"))
    found = ordered.mapInArrow(learn, "parts binary, bias double, width long").collect()
    if not found:
        return train([], [], **settings).parts()
    return np.frombuffer(found[0]["parts"], np.float64), found[0]["bias"], found[0]["width"]


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``, by a model fitted on the labelled rows among them.

    Null and empty texts score as a text without words. Labels of unknown ids and null labels are not used; without any
    usable label, or with one class only, every score is that class's. A row's id decides only whether it trains. Rows that repeat
    an id are scored each by their own text; an empty table gives no rows; very long texts are scored whole.
    """
    rows = id_and_text(docs, id_col, text_col)
    parts = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, **settings))  # one number per bucket

    def build():
        model = Scorer(*parts.value)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = pa.array([model.score(t) for t in batch.column("text").to_pylist()], pa.float64())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])
        return work

    return rows.mapInArrow(per_batch(build), "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def rejected(fitted: tuple[np.ndarray, float, int], text: Column, threshold: float = 0.5) -> Column:
    """Whether a text scores at least ``threshold`` by what ``fit`` returned."""
    parts = SparkSession.active().sparkContext.broadcast(fitted)

    @F.pandas_udf("boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Scorer(*parts.value)
        for texts in batches:
            yield pd.Series([model.score(t) >= threshold for t in texts], dtype=bool)

    return judge(text)
