"""Benchmark decontamination: an FM-index per shard of documents, searched backwards for every phrase of the benchmark."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlyard.llm.common import byte_values, carried, id_and_text, text_slices, with_carry

#: A-Z becomes a-z; digits, letters and all bytes beyond ASCII stay; everything else parts words.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the stretches from the first to the last word of each span."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_FOLD))]
    kept, done = [], 0
    for first, stop in spans:
        kept.append(text[done: at[first][0]])
        done = at[stop - 1][1]
    return b"".join([*kept, text[done:]])


class WaveletRanks:
    """How often a symbol occurs before a place of a sequence: one bit plane per binary digit, zeros sorted before ones."""

    def __init__(self, symbols: np.ndarray, digits: int):
        self.shifts = list(range(digits - 1, -1, -1))
        self.planes, self.ones, self.zeros = [], [], []
        row = symbols
        for shift in self.shifts:
            bit = (row >> shift) & 1
            self.planes.append(bit.astype(np.int8))
            self.ones.append(np.r_[0, np.cumsum(bit)])
            self.zeros.append(int(len(bit) - bit.sum()))
            row = np.r_[row[bit == 0], row[bit == 1]]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        begin, end = np.zeros_like(place), place
        for shift, ones, zeros in zip(self.shifts, self.ones, self.zeros):
            one = (symbol >> shift) & 1 == 1
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return end - begin

    def at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each place and its rank there, in one descent."""
        symbol, end, begin = np.zeros_like(place), place, np.zeros_like(place)
        for plane, ones, zeros in zip(self.planes, self.ones, self.zeros):
            one = plane[end] == 1
            symbol = 2 * symbol + one
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return symbol, end - begin


class FMIndex:
    """Full-text index over symbols from 1; ``breaks`` marks the last symbol of each stretch, which no phrase may cross."""

    def __init__(self, symbols: np.ndarray, breaks: np.ndarray, alphabet: int, sample: int = 8):
        # a stop with a rank of its own follows every stretch, so suffixes differ within their stretch
        stops = np.flatnonzero(breaks)
        text = np.insert(symbols, stops + 1, 0)
        n = len(text)
        ends = np.flatnonzero(text == 0)
        rank = text + len(ends) - 1
        rank[ends] = np.arange(len(ends))
        span = 1
        while True:
            ahead = np.zeros(n, np.int64)
            ahead[: n - span] = rank[span:] + 1
            key = rank * (n + alphabet + 2) + ahead
            order = np.argsort(key, kind="stable")
            new = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])] if n else np.zeros(0, np.int64)
            rank = np.empty(n, np.int64)
            rank[order] = new
            if not n or new[-1] == n - 1:
                break
            span *= 2
        self.suffixes = order
        before = text[order - 1] if n else text  # the last stop stands before the first symbol
        self.ranks = WaveletRanks(before, max(1, int(alphabet).bit_length()))
        self.less = np.searchsorted(text[order], np.arange(alphabet + 2)) if n else np.zeros(alphabet + 2, np.int64)
        first = np.zeros(n, bool)
        first[np.r_[0, ends[:-1] + 1] if n else []] = True
        kept = first | (np.arange(n) % sample == 0)  # walks end at the start of their stretch at the latest
        self.known = kept[order]
        self.sampled = order[self.known]
        self.sample_rank = np.r_[0, np.cumsum(self.known)]
        self.original = np.cumsum(text != 0) - 1  # place in ``symbols``
        del self.suffixes

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of the sorted suffixes that begin with each phrase, all phrases at once, last word first."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.original))
        for j in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((j < lengths) & (low < high))
            c = phrases[live, j]
            low[live] = self.less[c] + self.ranks.rank(c, low[live])
            high[live] = self.less[c] + self.ranks.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffixes: walks to the left until a sampled one, then adds the steps."""
        rows, steps, out = rows.copy(), 0, np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            there = self.known[rows[open_]]
            done = open_[there]
            out[done] = self.sampled[self.sample_rank[rows[done]]] + steps
            open_ = open_[~there]
            symbol, rank = self.ranks.at(rows[open_])
            rows[open_] = self.less[symbol] + rank
            steps += 1
        return self.original[out]


class Phrases:
    """Distinct windows of a block of items, as numbers of the block's own words."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            row = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)]
            for i in range(max(1, len(row) - window + 1) if row else 0):
                owners.setdefault(tuple(row[i: i + window]), set()).add(item)
        self.owners = list(owners.values())
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.rows = np.zeros((len(owners), int(self.lengths.max(initial=0))), np.int64)
        for i, p in enumerate(owners):
            self.rows[i, : len(p)] = p
        self.shortest = int(self.lengths.min(initial=window))


def _blocks(items: DataFrame, window: int, most_words: int) -> Iterator[Phrases]:
    block, size = [], 0
    for item, text in items.toLocalIterator(prefetchPartitions=False):
        raw = None if text is None else text.encode()
        n = len(words(raw))
        if block and size + n > most_words:
            yield Phrases(block, window)
            block, size = [], 0
        block.append((item, raw))
        size += n
    yield Phrases(block, window)


def _search_shard(texts: list[list[bytes]], phrases: Phrases | SimpleNamespace) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word, stop word and phrase of every occurrence in a shard."""
    counts = np.array([len(w) for w in texts], np.int64)
    n = int(counts.sum())
    get = phrases.numbers.get
    symbols = np.fromiter((get(w, 0) for ws in texts for w in ws), np.int64, n)
    doc = np.repeat(np.arange(len(texts)), counts)
    word = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    # a phrase has no foreign word, so the index holds the stretches of known words that are long enough for one
    known = symbols > 0
    begin = known & ~(np.r_[False, known[:-1]] & (word > 0)) if n else known
    end = known & np.r_[~known[1:] | (word[1:] == 0), True] if n else known
    first, last = np.flatnonzero(begin), np.flatnonzero(end)
    fits = last - first + 1 >= phrases.shortest
    first, last = first[fits], last[fits]
    change = np.zeros(n + 1, np.int64)
    change[first] += 1
    change[last + 1] -= 1
    place = np.flatnonzero(np.cumsum(change[:-1]))
    breaks = np.zeros(n, bool)
    breaks[last] = True
    none = np.zeros(0, np.int64)
    if not len(place) or not len(phrases.lengths):
        return none, none, none, none
    index = FMIndex(symbols[place], breaks[place], len(phrases.numbers))
    low, high = index.search(phrases.rows, phrases.lengths)
    found = high - low
    phrase = np.repeat(np.arange(len(found)), found)
    rows = np.arange(int(found.sum())) - np.repeat(np.cumsum(found) - found, found) + np.repeat(low, found)
    at = place[index.locate(rows)]
    return doc[at], word[at], word[at] + phrases.lengths[phrase], phrase


def _mark(blocks: list[Broadcast], shard_bytes: int):
    def run(batches):
        for batch in text_slices(batches, shard_bytes):
            raw = byte_values(batch.column("text"))
            texts = [words(t) for t in raw]
            change = [np.zeros(len(w) + 1, np.int64) for w in texts]
            items: list[set[int]] = [set() for _ in texts]
            for block in blocks:
                phrases = SimpleNamespace(**block.value)
                doc, first, stop, phrase = _search_shard(texts, phrases)
                order = np.argsort(doc, kind="stable")
                begins = np.searchsorted(doc[order], np.arange(len(texts) + 1))
                for i in np.unique(doc):
                    span = order[begins[i]: begins[i + 1]]
                    np.add.at(change[i], first[span], 1)
                    np.add.at(change[i], stop[span], -1)
                    for p in np.unique(phrase[span]):
                        items[i] |= phrases.owners[p]
            hits, spans, digests = [], [], []
            for c, owners in zip(change, items):
                hit = np.cumsum(c[:-1]) > 0
                step = np.diff(np.r_[0, hit.astype(np.int8), 0])
                hits.append(int(hit.sum()))
                spans.append(list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist())))
                digests.append(hashlib.sha256(",".join(sorted(str(x) for x in owners if x is not None)).encode()).hexdigest())
            yield with_carry(batch, {
                "doc_id": batch.column("doc_id"), "n_words": pa.array([len(w) for w in texts], pa.int64()),
                "n_hit": pa.array(hits, pa.int64()), "n_items": pa.array([len(x) for x in items], pa.int64()),
                "items_sha256": pa.array(digests, pa.string()), "contaminated": pa.array([h > 0 for h in hits], pa.bool_()),
                "items": pa.array([sorted(x for x in o if x is not None) for o in items], pa.list_(pa.int64())),
                "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))),
                "kept_text": pa.array([without(t, s) if s else None for t, s in zip(raw, spans)], pa.binary()).cast(pa.string()),
            })
    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = 1_000_000, shard_bytes: int = 8 << 20,
    id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (),
) -> DataFrame:
    """Which words of each document lie in an occurrence of a benchmark phrase.

    Returns ``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans, kept_text)`` per row; ``spans`` are the
    merged word ranges to remove, ``kept_text`` is what stays where there are any. Columns in ``carry`` come along in
    a struct ``carry``. A phrase is ``window`` consecutive words of an item, or the whole of a shorter item.

    The phrases travel in blocks of at most ``block_words`` words, one broadcast each and searched one after
    another, so a benchmark of any size is searched whole. A task indexes its documents in shards of about
    ``shard_bytes``; a longer single text is a shard of its own. Nothing is shuffled.

    Null texts have no words, on either side. Rows of items that share an id are one item with the phrases of all of them; an empty
    table, on either side, gives no rows or no hits. Items without an id are searched, count in ``n_items`` as one,
    and are left out of ``items`` and the digest.
    """
    rows = id_and_text(docs, id_col, text_col, carry)
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    context = docs.sparkSession.sparkContext
    blocks = [context.broadcast(vars(p)) for p in _blocks(items, window, block_words)]
    return rows.mapInArrow(
        _mark(blocks, shard_bytes), carried(
            rows, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<long>, "
            "spans array<struct<first: long, stop: long>>, kept_text string"))
