"""Document fingerprints: content-defined chunks, and sets of chunk digests weighted by length."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlyard.llm.common import id_and_text, mix, text_slices

#: A random number per byte value; the same everywhere.
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(raw: bytes) -> np.ndarray:
    """The gear hash h = 2h + gear[byte] after every byte, mod 2^32: it depends on the last 32 bytes only, so all places are
    computed together, doubling the span that each has summed."""
    h = _GEAR[np.frombuffer(raw, np.uint8)]
    span = 1
    while span < 32:
        h[span:] = h[span:] + (h[:-span] << np.uint32(span)) if span < len(h) else h[span:]
        span *= 2
    return h


def boundaries(raw: bytes, least: int = 12, normal: int = 32, most: int = 128) -> list[int]:
    """Ends of the chunks. No chunk is shorter than ``least`` (but the last) or longer than ``most``.

    Normalised: up to ``normal`` bytes a boundary needs two bits more of the hash than average, after that two fewer, which
    keeps lengths near ``normal``. The bits looked at are the highest, on which all of the last 32 bytes have a say.
    """
    if not raw:
        return []
    bits = normal.bit_length() - 1
    hashes = gear_hashes(raw)
    loose = np.flatnonzero(hashes >> np.uint32(32 - bits + 2) == 0)
    strict = (hashes[loose] >> np.uint32(32 - bits - 2) == 0).tolist()
    ends, begin, n = [], 0, len(raw)
    for at, hard in zip((loose + 1).tolist(), strict):
        while at - begin > most:
            begin += most
            ends.append(begin)
        size = at - begin
        if size >= least and (hard or size > normal):
            ends.append(at)
            begin = at
    while n - begin > most:
        begin += most
        ends.append(begin)
    if begin < n:
        ends.append(n)
    return ends


class Fingerprint:
    """Distinct chunk digests of a text and the bytes behind each. Equal texts have equal fingerprints."""

    def __init__(self, raw: bytes):
        weights: dict[int, int] = {}
        begin = 0
        for end in boundaries(raw):
            digest = xxhash.xxh3_64_intdigest(raw[begin:end])
            weights[digest] = weights.get(digest, 0) + end - begin
            begin = end
        order = np.argsort(np.fromiter(weights, np.uint64, len(weights)))
        self.digests = np.fromiter(weights, np.uint64, len(weights))[order]
        self.weights = np.fromiter(weights.values(), np.int64, len(weights))[order]

    def name(self) -> str:
        """Digest of the whole set with its weights, 32 hex digits."""
        return xxhash.xxh3_128_hexdigest(self.digests.astype("<u8").tobytes() + self.weights.astype("<i8").tobytes())

    def shared(self, other: Fingerprint) -> int:
        """Bytes in chunks of both; a repeated chunk counts as often as both have it."""
        _, here, there = np.intersect1d(self.digests, other.digests, assume_unique=True, return_indices=True)
        return int(np.minimum(self.weights[here], other.weights[there]).sum())

    def containment(self, other: Fingerprint) -> float:
        """Share of this text's bytes that lie in chunks of the other; 1 for an empty text in an empty one, else 0."""
        size = int(self.weights.sum())
        return self.shared(other) / size if size else float(not other.weights.sum())

    def likeness(self, other: Fingerprint) -> float:
        """The larger text's share that both hold, from 0 to 1; 1 for equal texts."""
        return min(self.containment(other), other.containment(self))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, digests, weights)``: the digest set of every text, for joins of one's own. Null is empty."""
    def run(batches):
        for batch in text_slices(batches):
            found = [Fingerprint((t or "").encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([f.name() for f in found], pa.string()),
                pa.array([f.digests.view(np.int64) for f in found], pa.list_(pa.int64())),
                pa.array([f.weights for f in found], pa.list_(pa.int64())),
            ], ["doc_id", "fingerprint", "digests", "weights"])
    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string, digests array<long>, weights array<long>")


def beside_next(docs: DataFrame, parts: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts in ranges of their ids, ``(bucket, doc_id, text, guest)``, so that each range also holds its last text's next one.

    The order is descending ids, nulls last; after the last comes the first. Each range's first text is sent to the
    range before it as a ``guest``: one exchange of the texts, one extra text per range, and a driver list of two numbers per
    range. Rows that share an id stand together, in the order of their texts.
    """
    rows = id_and_text(docs, id_col, text_col)
    cuts = rows.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    cuts = np.unique(np.array(cuts, np.int64))

    def ranges(ids: pd.Series) -> np.ndarray:
        return np.where(ids.isna(), 0, np.searchsorted(cuts, ids.fillna(0).to_numpy(np.int64), "right"))  # nulls go with the smallest ids

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(ranges(ids))

    found = rows.groupBy(bucket("doc_id").alias("bucket")).agg(F.max("doc_id").alias("top")).collect()
    top = {r["bucket"]: r["top"] for r in found}
    order = sorted(top)
    before = dict(zip(order, order[1:] + order[:1]))  # the range whose last text is followed by this range's first

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        return pd.Series([
            [b, before[b]] if (top[b] is None if pd.isna(i) else top[b] == i) else [b] for b, i in zip(ranges(ids).tolist(), ids)
        ], dtype=object)

    return rows.select("doc_id", "text", F.posexplode(places("doc_id")).alias("guest", "bucket")).select(
        "bucket", "doc_id", "text", (F.col("guest") == 1).alias("guest"))


def edit_likeness(docs: DataFrame, parts: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of the text with its last half replaced by the next one's beginning.

    Returns ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, contained_edited)``.
    The next text is that of the next smaller id (after the smallest: of the largest); of rows that share an id, the next by text.
    Null text is empty. Repeated rows are each other's next; an empty table gives no rows. A very long text is chunked whole, in
    one task. ``parts`` is the number of id ranges, by default the session's number of shuffle partitions.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = beside_next(docs, 4 * parts, id_col, text_col)  # several ranges per task even out
    placed = placed.repartition(parts, "bucket").sortWithinPartitions(
        "bucket", "guest", F.col("doc_id").desc_nulls_last(), F.coalesce("text", F.lit("")))

    def run(batches):
        columns = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "contained_edited")
        last = None  # the text that waits for its next one: (bucket, guest, id, text, fingerprint)
        for batch in text_slices(batches):
            out: list[tuple] = []
            for bucket, doc_id, text, guest in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "text", "guest"))):
                text = text or ""
                if guest and last is not None and last[1]:
                    continue  # of the guests only the first is the next text
                mine = last[4] if last is not None and last[3] == text else Fingerprint(text.encode())
                if last is not None and not last[1] and last[0] == bucket:
                    out.append(_compared(*last[2:], text, mine))
                last = (bucket, guest, doc_id, text, mine)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(columns), kinds)], columns)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64()]
    return placed.select("bucket", "doc_id", "text", "guest").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
             "near_next double, contained_edited double")


def _compared(doc_id: int | None, text: str, mine: Fingerprint, following: str, theirs: Fingerprint) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    raw = edited.encode()
    changed = mine if edited == text else Fingerprint(raw)
    return (doc_id, len(text), hashlib.sha256(raw).hexdigest(), mine.name(), changed.name(), mine.likeness(changed), mine.likeness(theirs),
            mine.containment(changed))
