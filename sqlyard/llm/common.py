"""Helpers the operators share: tables, words, hashes, token pieces, connected groups."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlyard.sources.tables import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """The two columns an operator reads, whatever else the table holds; ids as long.

    Columns named in ``carry`` come along in a struct of that name and go to the result row untouched.
    """
    along = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carry")] if carry else []
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), *along)


def carried(rows: DataFrame, schema: str) -> str:
    """The result schema with the carried struct at its end, if there is one."""
    return f"{schema}, carry {rows.schema['carry'].dataType.simpleString()}" if "carry" in rows.columns else schema


def with_carry(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    along = {"carry": batch.column("carry")} if "carry" in batch.schema.names else {}
    return pa.RecordBatch.from_pydict(columns | along)


def byte_values(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def text_slices(batches: Iterable[pa.RecordBatch], most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches by the length of their texts, so that arrays over words stay small. A longer single text stays whole."""
    for batch in batches:
        sizes = np.cumsum([0, *(len(t or b"") for t in byte_values(batch.column("text")))])
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(sizes, sizes[start] + most_bytes, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


class WordHashes(dict):
    """64-bit hash per word, kept for words seen before up to a number of words."""

    def __init__(self, seed: int, most: int = 1 << 18):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, self.seed)
        return found


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9FB21C651E98DF25)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def run_hashes(h: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hash of every ``length`` consecutive values; the last ``length - 1`` places hold hashes of shorter runs."""
    odd = np.uint64(2 * seed + 0x9E3779B97F4A7C15 | 1)
    out = np.zeros_like(h)
    for j in range(length):
        out *= odd
        out[: len(h) - j] += h[j:]
    return mix(out)


_L = "A-Za-zªµºÀ-ÖØ-öø-ÿ"  # all letters of Latin-1
#: Parts of a Latin-1 text at which the byte-level and word-level pre-tokenizers always cut: a run of letters with the blank
#: before it, and what lies between two of them. Letters after an apostrophe or two white spaces stay with those, since
#: a contraction or the end of the white space may reach there.
_PARTS = re.compile(rf" ?[{_L}]+|(?:[^{_L} ]| (?![{_L}]))+(?:(?<=')[{_L}]+|(?<=\s\s)[{_L}]+)?")
#: For any other text: before a blank between two characters that are no white space.
_CUTS = re.compile(r"(?<=\S)(?= \S)")
#: A word of Latin-1 letters with at most one blank before it.
_WORD = re.compile(rf" ?[{_L}]+")


def _byte_letters() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class _Places(dict):
    """A number per part in the order of their first look-up; parts that are new since the last batch are in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, part: str) -> int:
        self[part] = place = len(self)
        self.fresh.append(part)
        return place


class PieceEncoder:
    """Token ids of whole texts by the tokenizers library; each distinct part of them is encoded once.

    ``ends`` are ids appended to every text. Parts seen before are kept up to ``most`` of them. Words go straight to the
    library's merges, since the steps before change nothing but case and bytes there (tried out on the vocabulary when
    it is opened); all other parts take the library's full way.
    """

    def __init__(self, path: str, ends: tuple[int, ...] = (), most: int = 1 << 19):
        from tokenizers import Tokenizer

        self.library, self.ends, self.most = Tokenizer.from_file(path), np.array(ends, np.uint32), most
        self.letters = {b: chr(c) for b, c in _byte_letters().items()}
        self.fold = self._whole(["A"]) == self._whole(["a"])
        self.blank = self._whole([" a"]) != self._whole(["a"])
        tried = ["a", "Zebra", "thanonontioniner", "Été", "straße", "ª", "µm", "ÿÀß", "x" * 70]
        tried += [" " + w for w in tried]
        self.direct = [self._word(w) for w in tried] == self._whole(tried)
        self._forget()

    def _whole(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(parts, add_special_tokens=False)]

    def _word(self, part: str) -> list[int]:
        part = part.lower() if self.fold else part
        part = part if self.blank else part.lstrip(" ")
        # ASCII letters stand for themselves
        shown = part.replace(" ", self.letters[32]) if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.library.model.tokenize(shown)]

    def _forget(self) -> None:
        self.places = _Places()
        self.ids, self.begins, self.sizes = array("I"), array("q"), array("q")

    def _learn(self, fresh: list[str]) -> None:
        # a blank at a part's end is a token of its own
        words = [self.direct and bool(_WORD.fullmatch(p)) for p in fresh]
        others = iter(self._whole([p for p, w in zip(fresh, words) if not w]))
        for part, word in zip(fresh, words):
            found = self._word(part) if word else next(others)
            self.begins.append(len(self.ids))
            self.sizes.append(len(found))
            self.ids.extend(found)

    def _cut(self, text: str) -> list[str]:
        if "<|" in text:  # may begin a special token
            return _CUTS.split(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return _CUTS.split(text)
        return _PARTS.findall(text.lower() if self.fold else text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.places) > self.most:
            self._forget()
        places, rows = self.places, []
        for text in texts:
            keys = self._cut(text)
            rows.append(np.fromiter(map(places.__getitem__, keys), np.int64, len(keys)))
        self._learn(places.fresh)
        places.fresh = []
        if not rows:
            return []
        ids, begins, sizes = (np.frombuffer(a, t) if len(a) else np.zeros(0, t)
                              for a, t in ((self.ids, np.uint32), (self.begins, np.int64), (self.sizes, np.int64)))
        out = []
        for which in rows:
            n = sizes[which]
            stops = np.cumsum(n)
            where = np.arange(stops[-1] if len(stops) else 0) + np.repeat(begins[which] - (stops - n), n)
            out.append(np.concatenate([ids[where], self.ends]))
        return out


def components(edges: DataFrame, purpose: str = "groups") -> DataFrame:
    """Smallest node reachable, ``(node, root)``, for every node of the links ``(a, b)`` (longs, no nulls).

    Alternates between hanging larger neighbours on the smallest one and linking a node's smaller
    neighbours with each other, until every node hangs on one root. Each round is written to the
    shared folder, so a lost executor costs one round at most.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), purpose
    )
    while True:
        least = links.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("n"))
        hung = links.join(least.select(F.col("hi").alias("lo"), "m"), "lo", "left_semi")
        if hung.isEmpty() and least.where("n > 1").isEmpty():
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        up = stored(links.join(least.select(F.col("hi").alias("lo"), "m"), "lo", "left")
                    .select("hi", F.coalesce("m", "lo").alias("lo")).distinct(), purpose)
        least = up.groupBy("hi").agg(F.min("lo").alias("m"))
        flat = up.join(least, "hi").select(
            F.inline(F.when(F.col("lo") == F.col("m"), F.array(F.struct(F.col("hi"), F.col("m").alias("lo"))))
                     .otherwise(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                                        F.struct(F.col("hi"), F.col("m").alias("lo"))))))
        links = stored(flat.distinct(), purpose)


def per_batch(build: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> Callable:
    """A function for ``mapInArrow`` from one that makes a task's own batch function."""
    def run(batches):
        work = build()
        for piece in text_slices(batches):
            yield work(piece)
    return run
