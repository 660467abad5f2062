"""Approximate nearest neighbours by a hash-prefix forest: sorted strings of hash digits per tree, read at the longest prefix with enough matches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlyard.sources.tables import stored

#: Bits of the first digit of a hash string, and the most directions it looks at. Each further digit is one bit.
_FIRST_BITS, _FIRST_DIMS = 7, 64


class Digits:
    """Hash strings of unit vectors of one dimension, one long per tree, ``digits`` of them.

    The first digit says which of up to 64 random orthogonal directions, or of their opposites, is nearest to the vector; near vectors
    agree in it more often than in as many bits. Each further digit is the side of a random plane, so that prefixes grow in steps of two.
    """

    def __init__(self, dim: int, trees: int, digits: int, seed: int = 1):
        rng = np.random.default_rng([seed, dim])
        self.first = [np.linalg.qr(rng.normal(size=(dim, min(dim, _FIRST_DIMS))))[0].astype(np.float32) for _ in range(trees)]
        self.planes = [rng.normal(size=(dim, digits - 1)).astype(np.float32) for _ in range(trees)]
        self.weights = np.int64(1) << np.arange(digits - 2, -1, -1, dtype=np.int64)

    def strings(self, unit: np.ndarray) -> np.ndarray:
        unit = unit.astype(np.float32)
        out = np.zeros((len(self.first), len(unit)), np.int64)
        rows = np.arange(len(unit))
        for key, first, planes in zip(out, self.first, self.planes):
            sides = unit @ first
            nearest = np.abs(sides).argmax(axis=1)
            key += 2 * nearest + (sides[rows, nearest] > 0)
            key <<= len(self.weights)
            key += (unit @ planes > 0) @ self.weights
        return out


def _vectors(batch: pa.RecordBatch, column: str = "vec") -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each dimension, from their bytes."""
    raw = batch.column(column).to_pylist()
    sizes = np.array([len(r) // 8 for r in raw], np.int64)
    return {int(d): (at := np.flatnonzero(sizes == d), np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), d))
            for d in np.unique(sizes)}


def _scaled(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors times a power of two each, which changes no digit of a cosine but keeps squares from running over, and their lengths."""
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])
    return rows, np.sqrt((rows * rows).sum(axis=1))


def _usable(batches) -> Iterator[pa.RecordBatch]:
    """``(vec_id, vec)`` of the rows that take part: vectors as bytes, without those null, empty, zero or with a component null or not finite."""
    for batch in batches:
        column = batch.column("vec")
        values, offsets = column.values, column.offsets.to_numpy()
        good = values.is_valid().to_numpy(zero_copy_only=False)
        flat = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
        good &= np.isfinite(flat)
        kept, raw = [], []
        for i, known in enumerate(column.is_valid().to_numpy(zero_copy_only=False).tolist()):
            a, b = offsets[i], offsets[i + 1]
            if known and b > a and good[a:b].all() and flat[a:b].any():
                kept.append(i)
                raw.append((flat[a:b] + 0.0).tobytes())  # + 0.0: one zero only
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(kept, pa.int64())), pa.array(raw, pa.binary())], ["vec_id", "vec"])


def _plant(trees: int, digits: int):
    """``(dim, tree, key, node, asks)`` of every node in every tree."""
    def run(batches):
        forests: dict[int, Digits] = {}
        for batch in batches:
            node, asks = batch.column("node").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            for dim, (at, rows) in _vectors(batch).items():
                if dim not in forests:
                    forests[dim] = Digits(dim, trees, digits)
                rows, lengths = _scaled(rows)
                keys = forests[dim].strings(rows / lengths[:, None])
                n = trees * len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, dim, np.int32)), pa.array(np.repeat(np.arange(trees, dtype=np.int32), len(at))),
                     pa.array(keys.ravel()), pa.array(np.tile(node[at], trees)), pa.array(np.tile(asks[at], trees))], ["dim", "tree", "key", "node", "asks"])
    return run


class Array:
    """One tree's hash strings that share their first bits, in sorted order."""

    def __init__(self, table: pa.Table, digits: int):
        key, node = table.column("key").to_numpy(), table.column("node").to_numpy()
        order = np.lexsort((node, key))
        self.key, self.node, self.digits = key[order], node[order], digits

    def range(self, key: np.ndarray, level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Where the strings lie that share the first ``level`` digits of each key."""
        rest = np.asarray(self.digits - level, np.int64)
        low = key >> rest << rest
        return np.searchsorted(self.key, low, "left"), np.searchsorted(self.key, low + (np.int64(1) << rest) - 1, "right")


_DEAL = ["dim", "tree", "deal"]


def _matches(entries: DataFrame, digits: int) -> DataFrame:
    """``(asker, level, n)``: how many strings of a tree share that many digits with an asking node's, as long as there are others than its own."""
    def count(table: pa.Table) -> pa.Table:
        held = Array(table, digits)
        mine = table.filter(table.column("asks"))
        asker, key, out = mine.column("node").to_numpy(), mine.column("key").to_numpy(), []
        for level in range(1, digits + 1):
            low, high = held.range(key, level)
            others = high - low > 1
            asker, key = asker[others], key[others]
            out.append((asker, np.full(len(asker), level, np.int32), (high - low)[others]))
            if not len(asker):
                break
        return pa.table({c: pa.array(np.concatenate(x)) for c, x in zip(("asker", "level", "n"), zip(*out))})
    return entries.groupBy(*_DEAL).applyInArrow(count, "asker long, level int, n long")


def _levels(entries: DataFrame, askers: DataFrame, digits: int, enough: int) -> DataFrame:
    """``(asker, level)``: for each asking node the longest prefix at which all trees together hold ``enough`` matches, 0 where even one digit has fewer.

    The trees go up from their longest matches together, a digit at a time, and rest at the first level that has enough.
    """
    passed = _matches(entries, digits).groupBy("asker", "level").agg(F.sum("n").alias("n")).where(F.col("n") >= enough)
    return passed.select("asker", "level").union(askers.select("asker", F.lit(0).alias("level"))).groupBy("asker").agg(F.max("level").alias("level"))


def _collected(entries: DataFrame, levels: DataFrame, digits: int) -> DataFrame:
    """``(dim, asker, nodes)``: the matches of each asking node in each tree, at its level."""
    def collect(table: pa.Table) -> pa.Table:
        held = Array(table, digits)
        mine = table.filter(pc.greater(pc.fill_null(table.column("level"), 0), 0))
        low, high = held.range(mine.column("key").to_numpy(), mine.column("level").to_numpy())
        raw = [held.node[a:b].tobytes() for a, b in zip(low, high)]
        return pa.table({"dim": mine.column("dim"), "asker": mine.column("node"), "nodes": pa.array(raw, pa.binary())})
    known = entries.join(levels.withColumnRenamed("asker", "node"), "node", "left")
    return known.groupBy(*_DEAL).applyInArrow(collect, "dim int, asker long, nodes binary")


_REQUESTS = "dim int, block long, asker long, places binary"


def _requests(block_rows: int):
    """Matches, which come by asking node, as one row per asking node and block of vectors."""
    def rows(dim: int, asker: int, parts: list[bytes]) -> list[tuple]:
        nodes = np.unique(np.frombuffer(b"".join(parts), np.int64))
        block = nodes // block_rows
        new = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        places = np.split((nodes - block * block_rows).astype(np.int32), new[1:])
        return [(dim, int(b), asker, p.tobytes()) for b, p in zip(block[new], places)]

    def run(batches):
        held, parts = None, []
        for batch in batches:
            out = []
            for dim, asker, raw in zip(batch.column("dim").to_pylist(), batch.column("asker").to_pylist(), batch.column("nodes").to_pylist()):
                if held != (dim, asker):
                    out += rows(*held, parts) if held else []
                    held, parts = (dim, asker), []
                parts.append(raw)
            yield _batch(out)
        yield _batch(rows(*held, parts) if held else [])

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds)], ["dim", "block", "asker", "places"])
    return run


def _score(block_rows: int, keep: int):
    """The ``keep`` nearest of each request. Rows come by block: first its vectors, then the requests with the asking node's vector."""
    def run(batches):
        held, at, least, rows, lengths = None, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0)
        for batch in batches:
            kind, dims, blocks, nodes = (batch.column(c).to_numpy() for c in ("kind", "dim", "block", "node"))
            smallest, vecs, places = batch.column("least").to_numpy(), batch.column("vec").to_pylist(), batch.column("places")
            new = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | (dims[1:] != dims[:-1]) | (blocks[1:] != blocks[:-1])]) if len(kind) else []
            out = []
            for a, b in zip(new, [*new[1:], len(kind)]):
                dim, block = int(dims[a]), int(blocks[a])
                if kind[a] == 0:
                    if held != (dim, block):
                        held, at, least = (dim, block), np.full(block_rows, -1, np.int64), np.zeros(0, np.int64)
                        rows, lengths = np.zeros((0, dim)), np.zeros(0)
                    at[nodes[a:b] - block * block_rows] = len(rows) + np.arange(b - a)
                    more, long = _scaled(np.frombuffer(b"".join(vecs[a:b]), np.float64).reshape(-1, dim))
                    rows, lengths, least = np.vstack([rows, more]), np.r_[lengths, long], np.r_[least, smallest[a:b]]
                    continue
                i = a if held == (dim, block) else b  # else no vector of that length is in the block
                while i < b:  # all requests of one asking node that lie side by side
                    j = i
                    while j < b and nodes[j] == nodes[i]:
                        j += 1
                    whole = any(not places[k].is_valid for k in range(i, j))
                    wanted = np.flatnonzero(at >= 0) if whole else np.unique(
                        np.concatenate([np.frombuffer(places[k].as_buffer(), np.int32) for k in range(i, j)])).astype(np.int64)
                    own, long = _scaled(np.frombuffer(vecs[i], np.float64).reshape(1, dim))
                    where = at[wanted]
                    score = (rows[where] * own).sum(axis=1) / (lengths[where] * long)
                    best = np.lexsort((least[where], -score))[:keep]
                    out.append((np.full(len(best), nodes[i]), wanted[best] + block * block_rows, least[where[best]], score[best]))
                    i = j
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["asker", "node", "least", "score"])
    return run


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``node``, which counts the rows from 0 without gaps; only the number of rows of each partition passes the driver."""
    place = F.monotonically_increasing_id()
    held = stored(rows.select(F.shiftrightunsigned(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("place"), "*"), "nodes")
    before, offsets = 0, []
    for r in held.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        offsets.append((r["part"], before))
        before += r["n"]
    starts = rows.sparkSession.createDataFrame(offsets, "part long, start long")
    return held.join(starts, "part").select((F.col("start") + F.col("place")).alias("node"), *rows.columns)


def nearest(
    vectors: DataFrame, asks: Column, top: int = 5, trees: int = 64, digits: int = 31, enough: int = 9000, block_rows: int = 1024, array_rows: int = 500_000,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row whose id meets ``asks`` (a condition on the column ``vec_id``) the ``top`` rows
    found with the largest cosine, others than rows of its own id; equal cosines by ascending id.

    Equal vectors are one node of the forest, which keeps as many of their smallest ids as a result can hold; so copies of one vector
    cost nothing and none of them is lost. Every node has a string of ``digits`` hash digits in each of ``trees`` trees; all rows are
    indexed. An asking node takes, in all trees, the nodes that share its longest prefix at which the trees together hold ``enough``
    matches; where even one digit has too few, the whole table, which is then small or holds few vectors like it. All matches of that
    level are compared by their cosine, none is cut off. Sorted arrays are dealt out by tree and first bits, as many bits as leave
    about ``array_rows`` strings to an array; levels shorter than that have more than enough, or count what the array has.

    Matches meet their vectors in blocks of ``block_rows`` nodes, streamed, so no task holds a query's matches or a block's requests at once.
    Recall depends on how near neighbours are; more ``trees`` or a larger ``enough`` raise it.

    Vectors null, empty, zero or with null or non-finite components take no part, nor do rows without an id. Vectors of different
    lengths are not compared. Repeated rows count once; an id with several vectors asks with each, and is found with each.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vec"))
    usable = stored(rows.where("vec_id IS NOT NULL").mapInArrow(_usable, "vec_id long, vec binary").distinct(), "vectors")
    smallest = Window.partitionBy("vec").orderBy("vec_id")
    heads = usable.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= top + 1)
    nodes = _numbered(heads.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    askers = stored(usable.where(asks).join(nodes.select("node", "vec"), "vec").select(F.col("vec_id").alias("query_id"), F.col("node").alias("asker")), "askers")
    asking = askers.select("asker").distinct()

    count = nodes.count()
    deal = max(3, min(_FIRST_BITS + digits - 1, (count // array_rows).bit_length()))
    marked = nodes.join(asking.select(F.col("asker").alias("node"), F.lit(True).alias("asks")), "node", "left").select("node", "vec", F.coalesce("asks", F.lit(False)).alias("asks"))
    entries = stored(marked.mapInArrow(_plant(trees, digits), "dim int, tree int, key long, node long, asks boolean").withColumn(
        "deal", F.shiftright("key", _FIRST_BITS + digits - 1 - deal)), "forest")
    levels = stored(_levels(entries, asking, digits, enough), "levels")

    dim = (F.octet_length("vec") / 8).cast("int")
    none, nothing = F.lit(None).cast("binary"), F.lit(0).cast("long")
    placed = nodes.select(F.lit(0).alias("kind"), dim.alias("dim"), F.floor(F.col("node") / block_rows).cast("long").alias("block"),
                          "node", F.get("ids", F.lit(0)).alias("least"), "vec", none.alias("places"))
    matched = _collected(entries, levels, digits).repartition("asker").sortWithinPartitions("dim", "asker").mapInArrow(_requests(block_rows), _REQUESTS)
    blocks = F.explode(F.sequence(nothing, F.lit((max(count, 1) - 1) // block_rows).cast("long"))).alias("block")
    whole = levels.where("level = 0").join(nodes.select(F.col("node").alias("asker"), dim.alias("dim")), "asker").select("dim", blocks, "asker", none.alias("places"))
    requests = matched.union(whole).join(nodes.select(F.col("node").alias("asker"), "vec"), "asker").select(
        F.lit(1).alias("kind"), "dim", "block", F.col("asker").alias("node"), nothing.alias("least"), "vec", "places")
    scored = placed.union(requests).repartition("dim", "block").sortWithinPartitions("dim", "block", "kind", "node").mapInArrow(
        _score(block_rows, top + 1), "asker long, node long, least long, score double")
    best = Window.partitionBy("asker").orderBy(F.desc("score"), "least")
    heads = scored.groupBy("asker", "node", "least").agg(F.max("score").alias("score")).withColumn("place", F.row_number().over(best)).where(F.col("place") <= top + 1)
    near = stored(heads.join(nodes.select("node", "ids"), "node").select("asker", F.explode("ids").alias("vec_id"), "score"), "near")
    order = Window.partitionBy("query_id", "asker").orderBy(F.desc("score"), "vec_id")
    ranked = askers.join(near, "asker").where("vec_id <> query_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
