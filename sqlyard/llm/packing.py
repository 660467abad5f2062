"""Sequence packing by the sum-of-squares rule: a piece goes where the squared counts of open bins per gap become smallest."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlyard.llm.common import PieceEncoder, id_and_text, text_slices
from sqlyard.sources.tables import stored


def _fill(lengths: np.ndarray, order: np.ndarray, capacity: int) -> tuple[list[list[int]], list[list[int]]]:
    """Places pieces in the order given; the bins filled exactly and those with a gap left."""
    count = np.zeros(capacity + 1, np.int64)
    stacks: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    full = []
    for i in order.tolist():
        s = int(lengths[i])
        gaps = count[s:]
        change = 2 * (count[: capacity + 1 - s] - gaps) + 2
        change[0] = 1 - 2 * gaps[0]
        change[gaps == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())
        if change[best] <= (2 * count[capacity - s] + 1 if s < capacity else 0):
            gap = s + best
            held = stacks[gap].pop()
            count[gap] -= 1
        else:
            gap, held = capacity, []
        held.append(i)
        if gap > s:
            stacks[gap - s].append(held)
            count[gap - s] += 1
        else:
            full.append(held)
    return full, [held for stack in stacks for held in stack]


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece of 1 to ``capacity``; bins count from 0, their pieces lie one behind another.

    Pieces come longest first, equal ones in the order given. With N(g) open bins of gap g, a piece of length s changes
    the sum of N(g)^2 by 2(N(g-s) - N(g)) + 2 in a gap g > s, by 1 - 2N(s) where it fills a gap, and by 2N(c-s) + 1 in a
    new bin of capacity c. The smallest change wins; of equal ones the tightest gap, a new bin last. The rule keeps
    gaps of many sizes open, so the pieces of all bins with a gap left are placed once more, as long as that saves a bin.
    """
    order = np.argsort(-lengths, kind="stable")
    done, open_ = _fill(lengths, order, capacity)
    while open_:
        left = np.sort(np.array([i for held in open_ for i in held], np.int64))
        full, again = _fill(lengths, left[np.argsort(-lengths[left], kind="stable")], capacity)
        if len(full) + len(again) >= len(open_):
            break
        done, open_ = done + full, again
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k, held in enumerate(done + open_):
        bins[held] = k
        offsets[held] = np.cumsum(lengths[held]) - lengths[held]
    return bins, offsets


def encode_pieces(
    docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 4096, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, digest[, ids])``: each text's ids and the end id, cut only where longer than ``capacity``.

    ``digest`` tells rows apart that share an id.
    """
    def run(batches):
        encoder = PieceEncoder(vocabulary, (end_id,))
        for batch in text_slices(batches, 2 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for doc_id, text, ids in zip(batch.column("doc_id").to_pylist(), texts, encoder.encode(texts)):
                digest = zlib.crc32(text.encode())
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    raw = ids[start: start + capacity].astype("<u4").tobytes()
                    rows.append((doc_id, piece, start, len(raw) // 4, zlib.crc32(raw), digest) + ((raw,) if keep_ids else ()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "digest"] + ["ids"] * keep_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, digest long" + ", ids binary" * keep_ids
    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def place(pieces: DataFrame, capacity: int = 4096, group_pieces: int = 40_000) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` (column ``length``).

    Full pieces are a sequence each and take part in nothing. The others are dealt by their key's hash into groups of about
    ``group_pieces``, which are packed apart, one task each: a group that size wastes less than one sequence in a
    thousand, and any number of groups run side by side. The count of groups follows the count of pieces.
    """
    rest = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group_pieces))
    order = ["doc_id", "digest", "piece"]
    dealt = rest.withColumn("group", F.pmod(F.xxhash64("doc_id", "digest", "piece"), F.lit(groups)))
    kinds = dict(zip(dealt.columns, dealt.schema.fields))
    names = [c for c in dealt.columns if c != "group"]

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in order])
        bins, offsets = pack(table.column("length").to_numpy(), capacity)
        out = table.select(names)
        ids = bins * 2 * groups + 2 * table.column("group").to_numpy() if len(bins) else bins
        return out.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets))

    fields = ", ".join(f"`{c}` {kinds[c].dataType.simpleString()}" for c in names)
    packed = dealt.groupBy("group").applyInArrow(fill, f"{fields}, sequence_id long, offset long")
    full = pieces.where(F.col("length") >= capacity).select(
        *names, (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.union(full)


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 4096, group_pieces: int = 40_000, keep_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` per piece, and the piece's ``ids`` as
    little-endian 32-bit numbers if ``keep_ids``.

    Texts are encoded once, into a table in the shared folder; packing reads lengths only. Null and empty texts
    are the end id alone. Rows that repeat an id, a text or both are packed each.
    """
    pieces = stored(encode_pieces(docs, vocabulary, end_id, capacity, keep_ids, id_col, text_col), "pieces")
    placed = place(pieces.drop("ids"), capacity, group_pieces)
    if keep_ids:
        key = ["doc_id", "digest", "piece"]
        ids = pieces.select(*key, "ids").dropDuplicates(key)
        placed = placed.join(ids.select(*[F.col(c).alias(f"_{c}") for c in key], "ids"), F.expr(" AND ".join(f"{c} <=> _{c}" for c in key)))
        placed = placed.drop(*[f"_{c}" for c in key])
    return placed.drop("digest")
