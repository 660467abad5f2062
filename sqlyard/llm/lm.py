"""Masked pseudo-likelihood: a window network predicts each token from both sides; documents score the sum of log-probabilities."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlyard.llm.common import byte_values, id_and_text, text_slices
from sqlyard.sources.tables import stored

#: Class of the places before and behind a text.
EDGE = 0


def shape(words: int, breadth: float = 3.5) -> int:
    """Groups, and classes in a group, for a corpus of so many distinct words: ``breadth`` times its sixth root, so the classes are
    that squared times the cube root of the words."""
    return max(2, math.ceil(breadth * max(1, words) ** (1 / 6)))


class Network:
    """Softmax over groups of classes, and over the classes of a group, from tanh of a sum of vectors, one table of vectors per place in the window.

    A class's probability is its group's times its own within the group, so a prediction costs the number of groups and of
    classes in one of them, not of all classes.
    """

    def __init__(self, groups: int, members: int, dim: int, reach: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.reach, self.groups, self.members = reach, groups, members
        self.tables = rng.normal(0, 0.1, (2 * reach, groups * members, dim)).astype(np.float32)
        self.to_group = rng.normal(0, 0.1, (dim, groups)).astype(np.float32)
        self.group_bias = np.zeros(groups, np.float32)
        self.to_member = rng.normal(0, 0.1, (groups, dim, members)).astype(np.float32)
        self.member_bias = np.zeros((groups, members), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.tables, self.to_group, self.group_bias, self.to_member, self.member_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def fill(self, flat: np.ndarray) -> Network:
        at = 0
        for p in self.parameters():
            p[...] = flat[at: at + p.size].reshape(p.shape)
            at += p.size
        return self

    def places(self) -> list[int]:
        return [j for j in range(-self.reach, self.reach + 1) if j]

    def hidden(self, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hidden vectors at the places ``at``, whose own token is never looked at."""
        total = self.tables[0].take(tokens[at - self.reach], axis=0)
        for table, j in zip(self.tables[1:], self.places()[1:]):
            total += table.take(tokens[at + j], axis=0)
        return np.tanh(total, out=total)

    def by_group(self, classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]], np.ndarray]:
        """The order of rows by group, the slice of each group that occurs, and each row's class within its group, in that order."""
        group = classes // self.members
        order = np.argsort(group.astype(np.int16) if self.groups < 1 << 15 else group, kind="stable")  # small numbers sort in one pass
        stops = np.cumsum(np.bincount(group, minlength=self.groups)).tolist()
        spans = [(g, slice(a, b)) for g, (a, b) in enumerate(zip([0, *stops], stops)) if a < b]
        return order, spans, (classes - group * self.members)[order]

    def log_probabilities(self, tokens: np.ndarray, at: np.ndarray, step: int = 16384) -> np.ndarray:
        out = np.empty(len(at), np.float64)
        for i in range(0, len(at), step):
            some = at[i: i + step]
            hidden, classes, total = self.hidden(tokens, some), tokens[some], out[i: i + step]
            total[:] = _log_shares(hidden @ self.to_group + self.group_bias, classes // self.members)
            order, spans, member = self.by_group(classes)
            held, found = hidden[order], np.empty(len(some), np.float32)
            for g, rows in spans:
                found[rows] = _log_shares(held[rows] @ self.to_member[g] + self.member_bias[g], member[rows])
            total[order] += found
        return out

    def learn(self, tokens: np.ndarray, at: np.ndarray, squares: list[np.ndarray], rate: float, step: int = 8192) -> None:
        """One pass of Adagrad over the places in the order given."""
        size = self.groups * self.members
        for i in range(0, len(at), step):
            some = at[i: i + step]
            hidden, classes, part = self.hidden(tokens, some), tokens[some], np.float32(1 / len(some))
            error = _softmax(hidden @ self.to_group + self.group_bias)
            error[np.arange(len(some)), classes // self.members] -= 1
            error *= part
            back = error @ self.to_group.T
            slopes = [np.empty_like(self.tables), hidden.T @ error, error.sum(axis=0), np.zeros_like(self.to_member), np.zeros_like(self.member_bias)]
            order, spans, member = self.by_group(classes)
            held, inner = hidden[order], np.empty_like(back)
            for g, rows in spans:
                error = _softmax(held[rows] @ self.to_member[g] + self.member_bias[g])
                error[np.arange(len(error)), member[rows]] -= 1
                error *= part
                inner[rows] = error @ self.to_member[g].T
                slopes[3][g], slopes[4][g] = held[rows].T @ error, error.sum(axis=0)
            back[order] += inner
            back *= 1 - hidden * hidden
            columns = np.ascontiguousarray(back.T, np.float64)
            for k, j in enumerate(self.places()):
                side = tokens[some + j]
                for d, column in enumerate(columns):
                    slopes[0][k, :, d] = np.bincount(side, column, size)
            for p, slope, square in zip(self.parameters(), slopes, squares):
                square += slope * slope
                p -= rate * slope / (np.sqrt(square) + 1e-8)


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _log_shares(logits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax of one entry of each row."""
    logits -= logits.max(axis=1, keepdims=True)
    own = logits[np.arange(len(wanted)), wanted]
    np.exp(logits, out=logits)
    return own - np.log(logits.sum(axis=1))


# ---- shards ---------------------------------------------------------------------------------------
#
# Texts are cut into words once. A shard is a slice of the documents with a dictionary of its own: codes of all its words in
# order, the words behind the codes, as 64-bit hashes, and how often each occurs. Two words share a hash, and so a count, with
# a chance of 2**-64.

_SHARDS = "ids array<long>, sizes binary, codes binary, words binary, counts binary"


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def _classes(keys: np.ndarray, own: tuple[np.ndarray, np.ndarray], first: int, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """The class of each word, and whether it is the word's own; ``own`` holds the keys that have one, sorted, and their classes."""
    held, numbers = own
    out = first + (keys.view(np.uint64) % np.uint64(shared)).astype(np.int64)
    if not len(held):
        return out, np.zeros(len(keys), bool)
    at = np.searchsorted(held, keys)
    at[at == len(held)] = 0
    hit = held[at] == keys
    out[hit] = numbers[at[hit]]
    return out, hit


def _cut(batches):
    for batch in text_slices(batches, 8 << 20):
        code: dict[bytes, int] = {}
        rows = []
        for text in byte_values(batch.column("text")):
            words = (text or b"").lower().split()
            rows.append(np.fromiter((code.setdefault(w, len(code)) for w in words), np.int32, len(words)))
        codes = np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int32)
        raw = [np.array([len(r) for r in rows], np.int64), codes, np.fromiter(map(word_key, code), np.int64, len(code)),
               np.bincount(codes, minlength=len(code)).astype(np.int64)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())), *[pa.array([x.tobytes()], pa.binary()) for x in raw]],
            ["ids", "sizes", "codes", "words", "counts"])


def _array(batch: pa.RecordBatch, column: str, row: int, kind) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_buffer(), kind)


def _count(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(_array(batch, c, row, np.int64)) for c in ("words", "counts")], ["word", "n"])


def _shared(own, first: int, shared: int):
    """``(shard, code, word)`` of the words without a class of their own."""
    def run(batches):
        for batch in batches:
            for row, shard in enumerate(batch.column("shard").to_pylist()):
                keys = _array(batch, "words", row, np.int64)
                rest = np.flatnonzero(~_classes(keys, own.value, first, shared)[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rest), shard)), pa.array(rest.astype(np.int32)), pa.array(keys[rest])], ["shard", "code", "word"])
    return run


def _tokens(batch: pa.RecordBatch, row: int, own: tuple[np.ndarray, np.ndarray], first: int, shared: int, reach: int) -> tuple[np.ndarray, ...]:
    """Classes of all texts of a shard with edges between, the places of real tokens, their codes, how many each text has, and the classes of
    the shard's words."""
    sizes, codes = _array(batch, "sizes", row, np.int64), _array(batch, "codes", row, np.int32)
    of, _ = _classes(_array(batch, "words", row, np.int64), own, first, shared)
    at = np.arange(len(codes)) + reach * (1 + np.repeat(np.arange(len(sizes)), sizes))
    tokens = np.full(len(codes) + reach * (len(sizes) + 1), EDGE, np.int64)
    tokens[at] = of[codes] if len(codes) else 0
    return tokens, at, codes, sizes, of


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up weighted parameters; one row out for any number of rows in."""
    total, weight = None, 0.0
    for batch in batches:
        for raw, w in zip(batch.column("values").to_pylist(), batch.column("weight").to_pylist()):
            values = np.frombuffer(raw, np.float64)
            total, weight = (values.copy() if total is None else total + values), weight + w
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([weight])], ["values", "weight"])


class Model:
    """Shards of a corpus, ``words`` (word, n), ``shares`` (word, class, log-probability in the class) of the words without a class of their
    own, the sum of their counts per class in ``totals``, and the network's parameters."""

    def __init__(self, docs: DataFrame, dim: int, reach: int, rounds: int, rate: float, breadth: float, own_share: float):
        context = docs.sparkSession.sparkContext
        self.dim, self.reach = dim, reach
        cut = docs.mapInArrow(_cut, _SHARDS).select(F.monotonically_increasing_id().alias("shard"), "*")
        self.shards = stored(cut, "shards")
        words = stored(self.shards.select("words", "counts").mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
        side = shape(words.count(), breadth)
        own = min(int(side * side * own_share), side * side - 2)
        self.side, self.first = side, 1 + own
        self.shared = side * side - self.first
        most = sorted((r["word"], i) for i, r in enumerate(words.orderBy(F.desc("n"), "word").limit(own).collect(), 1))
        held = np.array([k for k, _ in most], np.int64), np.array([i for _, i in most], np.int64)
        self.frequent = context.broadcast(held)
        first, shared = self.first, self.shared

        def rest(batches):
            for batch in batches:
                keys = batch.column("word").to_numpy()
                classes, hit = _classes(keys, held, first, shared)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[~hit]), batch.column("n").filter(pa.array(~hit)), pa.array(classes[~hit].astype(np.int32))], ["word", "n", "class"])

        rare = words.mapInArrow(rest, "word long, n long, class int")
        totals = rare.groupBy("class").agg(F.sum("n").alias("total"))
        self.words, self.shares = words, rare.join(totals, "class").select("word", "class", F.log(F.col("n") / F.col("total")).alias("share"))
        self.totals = np.zeros(side * side, np.int64)  # a number per class: some thousands
        for r in totals.collect():
            self.totals[r["class"]] = r["total"]
        self.flat = Network(side, side, dim, reach).flat()
        for _ in range(rounds):
            self._learn(rate)

    def _learn(self, rate: float) -> None:
        """Every task starts from the same parameters, learns from all its texts in turn, and the results are averaged by their numbers of
        tokens: first among groups of tasks, then among the groups, so no task or driver holds more than a few dozen at once."""
        side, dim, reach, first, shared, frequent = self.side, self.dim, self.reach, self.first, self.shared, self.frequent
        start = self.shards.sparkSession.sparkContext.broadcast(self.flat)

        def learn(batches):
            net = Network(side, side, dim, reach).fill(start.value)
            squares, seen = [np.full_like(p, 1e-6) for p in net.parameters()], 0
            for batch in batches:
                for row in range(batch.num_rows):
                    tokens, at, _, _, _ = _tokens(batch, row, frequent.value, first, shared, reach)
                    net.learn(tokens, at, squares, rate)
                    seen += len(at)
            if seen:
                values = net.flat().astype(np.float64) * seen
                yield pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary()), pa.array([float(seen)])], ["values", "weight"])

        schema = "values binary, weight double"
        learned = self.shards.select("sizes", "codes", "words").mapInArrow(learn, schema)
        total = learned.repartition(64).mapInArrow(_sum, schema).repartition(1).mapInArrow(_sum, schema).collect()
        if total:
            self.flat = (np.frombuffer(total[0]["values"], np.float64) / total[0]["weight"]).astype(np.float32)

    def score(self) -> DataFrame:
        """``(doc_id, n_tokens, total)`` per document: for every token the log-probability of its class, from both sides, and of the word in it."""
        side, dim, reach, first, shared, frequent = self.side, self.dim, self.reach, self.first, self.shared, self.frequent
        start = self.shards.sparkSession.sparkContext.broadcast(self.flat)
        totals = self.shards.sparkSession.sparkContext.broadcast(self.totals)
        asked = self.shards.select("shard", "words").mapInArrow(_shared(frequent, first, shared), "shard long, code int, word long")
        # plain arrays of numbers, both in the order of the rows, take a third of the room of an array of structs
        known = asked.join(self.words.hint("shuffle_hash"), "word").groupBy("shard").agg(F.collect_list("code").alias("known"), F.collect_list("n").alias("n"))

        def run(batches):
            net = Network(side, side, dim, reach).fill(start.value)
            for batch in batches:
                for row in range(batch.num_rows):
                    tokens, at, codes, sizes, classes = _tokens(batch, row, frequent.value, first, shared, reach)
                    share, held = np.zeros(len(classes)), batch.column("known")[row]
                    if held.is_valid:
                        rare = held.values.to_numpy()
                        share[rare] = np.log(batch.column("n")[row].values.to_numpy() / totals.value[classes[rare]])
                    found = net.log_probabilities(tokens, at) + share[codes]
                    total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), found, len(sizes))
                    yield pa.RecordBatch.from_arrays([batch.column("ids")[row].values, pa.array(sizes), pa.array(total)], ["doc_id", "n_tokens", "total"])

        placed = self.shards.select("shard", "ids", "sizes", "codes", "words").join(known.hint("shuffle_hash"), "shard", "left").drop("shard")  # rows of megabytes need no sort
        return placed.mapInArrow(run, "doc_id long, n_tokens long, total double")


def fit(
    docs: DataFrame, dim: int = 16, reach: int = 2, rounds: int = 1, rate: float = 0.1, breadth: float = 3.5, own_share: float = 0.75,
    id_col: str = "doc_id", text_col: str = "text",
) -> Model:
    """A model of every word of every text. ``own_share`` of the classes belong to a most frequent word each, the others are shared by hash."""
    return Model(id_and_text(docs, id_col, text_col), dim, reach, rounds, rate, breadth, own_share)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``(doc_id, n_tokens, log_likelihood, mean_log_likelihood)`` per row of ``docs``, by a model fitted on all of them.

    A token is a lower-case word, each predicted from ``reach`` words on either side, itself masked: the probability of its class, by
    the network, times that of the word in its class, by the word's count among the class's words in the whole corpus. The vocabulary is
    every distinct word, kept as a distributed table that is joined to the shards' dictionaries; the number of classes follows the
    cube root of its size. So different words score differently where their counts or classes do.

    Null and empty texts have no tokens, a sum of 0 and no mean. Rows that repeat an id, or have none, are scored each; repeated rows
    count as often as they occur. An empty table gives no rows. A very long text is in one shard, whose memory grows with it. Sums
    are rounded to six digits; parameters depend a little on how the input is dealt to tasks.
    """
    total = F.round("total", 6)
    return fit(docs, id_col=id_col, text_col=text_col, **settings).score().select(
        "doc_id", "n_tokens", total.alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, F.round(F.col("total") / F.col("n_tokens"), 6)).alias("mean_log_likelihood"))
