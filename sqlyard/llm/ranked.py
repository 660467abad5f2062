"""Ranked lexical search by MaxScore with pair bounds: shards hold postings and, for pairs of terms, the largest joint impact."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlyard.llm.common import byte_values, text_slices
from sqlyard.sources.tables import stored

#: A-Z become a-z; letters, digits and all bytes beyond ASCII stay; everything else separates terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# ---- shards ---------------------------------------------------------------------------------------

_POSTINGS = "docs array<long>, sizes binary, n_docs long, n_terms long, term binary, count binary, doc binary, tf binary"


def _arrays(batch: pa.RecordBatch, row: int, **kinds) -> dict[str, np.ndarray]:
    return {c: np.frombuffer(batch.column(c)[row].as_buffer(), kind) for c, kind in kinds.items()}


def _shards(numbers, shard_bytes: int):
    """One row per shard: how many documents have terms, how many terms, and the postings ``(term, doc, tf)`` of the block's terms by
    term and document; documents by ascending id, those without an id last, and only those with a posting."""
    def run(batches):
        get = numbers.value.get
        for batch in text_slices(batches, shard_bytes):
            batch = batch.take(pc.sort_indices(batch.column("doc_id"), null_placement="at_end"))
            sizes = np.zeros(batch.num_rows, np.int64)
            keys = []
            for i, text in enumerate(byte_values(batch.column("text"))):
                found = terms(text)
                sizes[i] = len(found)
                known = [k for k in map(get, found) if k is not None]
                keys.append(np.array(known, np.int64) * batch.num_rows + i)
            key, tf = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
            term, doc = key // max(1, batch.num_rows), key % max(1, batch.num_rows)
            held = np.zeros(batch.num_rows, bool)
            held[doc] = True
            doc = (np.cumsum(held) - 1)[doc]
            term, count = np.unique(term, return_counts=True)
            raw = [x.astype(kind).tobytes() for x, kind in ((sizes[held], np.int64), (term, np.int64), (count, np.int64), (doc, np.int32), (tf, np.int64))]
            ids = pa.array([batch.column("doc_id").filter(pa.array(held)).to_pylist()], pa.list_(pa.int64()))
            columns = [ids, pa.array([raw[0]], pa.binary()), pa.array([int((sizes > 0).sum())]), pa.array([int(sizes.sum())]),
                       *[pa.array([x], pa.binary()) for x in raw[1:]]]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _POSTINGS.split(", ")])
    return run


def _frequencies(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            part = _arrays(batch, row, term=np.int64, count=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part["term"]), pa.array(part["count"])], ["term", "df"])


_INDEX = "docs array<long>, term binary, count binary, doc binary, impact binary, a binary, b binary, joint binary"


def joint_maxima(doc: list[np.ndarray], impact: list[np.ndarray], pairs: Iterable[tuple[int, int]], n_docs: int) -> dict[tuple[int, int], int]:
    """The largest sum of two terms' impacts in one document, for each pair that meets in one."""
    joint, dense, held = {}, np.zeros(n_docs, np.int64), -1
    for a, b in sorted(pairs):
        if a != held:
            if held >= 0:
                dense[doc[held]] = 0
            dense[doc[a]], held = impact[a], a
        other = dense[doc[b]]
        both = (other + impact[b])[other > 0]
        if len(both):
            joint[a, b] = int(both.max())
    return joint


def _impacts(model):
    """The index row of each shard: impacts in place of term counts, and the joint maxima of the block's pairs."""
    def run(batches):
        weights, n_docs, n_terms, wanted = model.value
        for batch in batches:
            for row in range(batch.num_rows):
                part = _arrays(batch, row, sizes=np.int64, term=np.int64, count=np.int64, doc=np.int32, tf=np.int64)
                term, stops = part["term"], np.cumsum(part["count"])
                norms = 10 + 90 * part["sizes"] * n_docs // max(1, n_terms)
                tf = part["tf"]
                impact = np.repeat(weights[term], part["count"]) * (1_000_000_000 * tf // (1000 * tf + 8 * norms[part["doc"]]))
                spans = [slice(a, b) for a, b in zip(stops - part["count"], stops)]
                place = {t: i for i, t in enumerate(term.tolist())}
                pairs = [(place[a], place[b]) for a, b in wanted if a in place and b in place]
                docs = batch.column("docs").slice(row, 1)
                joint = joint_maxima([part["doc"][s] for s in spans], [impact[s] for s in spans], pairs, len(part["sizes"]))
                raw = [term, part["count"], part["doc"], impact, np.array([a for a, _ in joint], np.int32), np.array([b for _, b in joint], np.int32),
                       np.array(list(joint.values()), np.int64)]
                yield pa.RecordBatch.from_arrays([docs, *[pa.array([x.tobytes()], pa.binary()) for x in raw]], [c.split()[0] for c in _INDEX.split(", ")])
    return run


# ---- search ---------------------------------------------------------------------------------------

class Shard:
    """Postings of one shard by term, each term's largest impact, and the joint maxima of pairs."""

    def __init__(self, term: np.ndarray, count: np.ndarray, doc: np.ndarray, impact: np.ndarray, joint: dict[tuple[int, int], int], n_docs: int):
        stops = np.cumsum(count)
        self.doc = [doc[a:b] for a, b in zip(stops - count, stops)]
        self.impact = [impact[a:b] for a, b in zip(stops - count, stops)]
        self.most = [int(x.max()) for x in self.impact]
        self.place = {t: i for i, t in enumerate(term.tolist())}
        self.joint = joint | {(b, a): v for (a, b), v in joint.items()}
        self.measured: set[int] = {t for pair in joint for t in pair}
        self.total = np.zeros(n_docs, np.int64)

    def bounds(self, order: list[int], paired) -> list[int]:
        """An upper bound on what the first j terms of ``order`` add to a document, for each j.

        Independent maxima add up. Two terms whose joint maximum is stored add no more than the larger of it and of each one's
        own maximum; a term takes the free partner before it that saves most, and the bound of the set is that of its pairs and single terms.
        """
        found, free, total = [0], {}, 0
        for t in order:
            most, best, partner = self.most[t], 0, None
            for other, own in free.items():
                if paired(t, other):
                    saved = most + own - max(most, own, self.joint.get((t, other), 0))
                    if saved > best:
                        best, partner = saved, other
            if partner is None:
                free[t] = most
            else:
                del free[partner]
            total += most - best
            found.append(total)
        return found

    def scores(self, order: list[int], docs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(docs), np.int64)
        for t in order:
            self._add(t, docs, out)
        return out

    def _add(self, t: int, docs: np.ndarray, out: np.ndarray) -> None:
        at = np.searchsorted(self.doc[t], docs)
        at[at == len(self.doc[t])] = 0
        same = self.doc[t][at] == docs
        out[same] += self.impact[t][at[same]]

    def search(self, wanted: list[int], top: int, paired) -> tuple[np.ndarray, np.ndarray]:
        """The ``top`` documents of highest score and their scores, equal ones by document; none that scores 0.

        The terms with the smallest maxima whose bound together stays below the lowest score that counts so far cannot bring in a
        document: only the lists of the others are walked. Their documents then take in one of those terms after another, and drop
        out as soon as the bound of the terms to come no longer lifts them.
        """
        order = sorted((self.place[t] for t in wanted if t in self.place), key=lambda t: (self.most[t], t))
        order = [t for t in order if self.most[t]]
        bound = self.bounds(order, paired)
        least = 0
        first, seeds = len(order), 0
        while first and seeds < top:
            first -= 1
            seeds += len(self.doc[order[first]])
        if seeds >= top:  # the lowest of enough scores is a floor, whichever documents they are of
            tried = np.unique(np.concatenate([self.doc[t][np.argsort(-self.impact[t], kind="stable")[: 2 * top]] for t in order[first:]]))
            found = self.scores(order, tried)
            least = int(np.sort(found)[-top]) if len(found) >= top else 0
        first = max(j for j in range(len(order) + 1) if bound[j] < max(least, 1))
        for t in order[first:]:
            self.total[self.doc[t]] += self.impact[t]
        docs = np.unique(np.concatenate([self.doc[t] for t in order[first:]])) if first < len(order) else np.zeros(0, np.int32)
        total = self.total[docs]
        self.total[docs] = 0
        for j in range(first, 0, -1):
            if len(total) > top:
                least = max(least, int(np.partition(total, -top)[-top]))
            stay = total + bound[j] >= least
            docs, total = docs[stay], total[stay]
            self._add(order[j - 1], docs, total)
        best = np.lexsort((docs, -total))[:top]
        best = best[total[best] > 0]
        return docs[best], total[best]


def _search(items, frequent, top: int):
    def run(batches):
        queries, often = items.value, frequent.value
        for batch in batches:
            for row in range(batch.num_rows):
                part = _arrays(batch, row, term=np.int64, count=np.int64, doc=np.int32, impact=np.int64, a=np.int32, b=np.int32, joint=np.int64)
                ids = batch.column("docs")[row].values
                joint = dict(zip(zip(part["a"].tolist(), part["b"].tolist()), part["joint"].tolist()))
                shard = Shard(part["term"], part["count"], part["doc"], part["impact"], joint, len(ids))
                measured = {i for t, i in shard.place.items() if t in often}

                def paired(a: int, b: int) -> bool:
                    return a in measured and b in measured
                item_ids, docs, scores = [], [], []
                for item, wanted in queries:
                    found, score = shard.search(wanted, top, paired)
                    item_ids += [item] * len(found)
                    docs.append(found)
                    scores.append(score)
                if item_ids:
                    where = pa.array(np.concatenate(docs))
                    yield pa.RecordBatch.from_arrays([pa.array(item_ids, pa.int64()), ids.take(where), pa.array(np.concatenate(scores))], ["item_id", "doc_id", "score"])
    return run


def _best(found: DataFrame, top: int, *keys: str | Column) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _blocks(queries: DataFrame, id_col: str, text_col: str, block_terms: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their terms, once each, in blocks dealt by the item's hash: of about ``block_terms`` terms, an item never split."""
    def split(batches):
        for batch in text_slices(batches):
            rows = [(i, t) for i, text in zip(batch.column("item_id").to_pylist(), byte_values(batch.column("text"))) for t in set(terms(text))]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.binary())], ["item_id", "term"])

    items = queries.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    pairs = stored(items.mapInArrow(split, "item_id long, term binary").distinct(), "queries")
    blocks = max(1, -(-pairs.count() // block_terms))
    for block in range(blocks):
        some = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        rows = some.groupBy("item_id").agg(F.array_sort(F.collect_list("term")).alias("terms")).collect()
        if rows:
            yield sorted(((r["item_id"], [bytes(t) for t in r["terms"]]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0))


def search(
    docs: DataFrame, queries: DataFrame, top: int = 10, pair_share: float = 0.01, block_terms: int = 100_000, shard_bytes: int = 8 << 20,
    id_col: str = "doc_id", text_col: str = "text", query_id_col: str = "item_id", query_text_col: str = "text",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``top`` documents of highest score above 0, equal scores by ascending id.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case. With N documents that have terms, L terms in all,
    n terms in the document, df documents with the term and tf occurrences: a term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))), a
    document's m is 10 + 90 n N div L, and its score sums w * (1000000000 tf div (1000 tf + 8 m)) over the item's terms, once each.

    Documents are indexed in shards of about ``shard_bytes`` of text (a longer single text is one of its own), each written as a row:
    postings of the queries' terms with their impacts, and, for every two terms of one item that ``pair_share`` of all
    documents hold each, the largest joint impact in the shard. A search combines these with each term's own
    maximum into bounds, skips lists and documents by them, and returns ``top`` rows per item and shard at most; the best of all
    shards are taken in two steps, so no task sees every shard's.

    Items travel in blocks of about ``block_terms`` terms, searched one after another: at most that many terms, and the terms of one item
    more, are in the driver or a broadcast at a time. An item that occurs in several rows has the terms of all of them. Null and
    empty texts have no terms; an item without any, or without a document, has no rows. Rows of ``docs`` that repeat an id, or have
    none, are a document each; those without an id come last among equals.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    context, found = docs.sparkSession.sparkContext, None
    for block in _blocks(queries, query_id_col, query_text_col, block_terms):
        words = sorted({t for _, ts in block for t in ts})
        numbers = {t: i for i, t in enumerate(words)}
        items = [(item, [numbers[t] for t in ts]) for item, ts in block]
        shards = stored(rows.mapInArrow(_shards(context.broadcast(numbers), shard_bytes), _POSTINGS), "postings")
        sums = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
        df = np.zeros(len(words), np.int64)
        for r in shards.select("term", "count").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[r["term"]] = r["df"]
        weights = np.array([weight(sums["n"], int(x)) if x else 0 for x in df], np.int64)
        often = frozenset(np.flatnonzero((df > 0) & (df >= pair_share * sums["n"])).tolist())
        pairs = sorted({p for _, ts in items for p in combinations([t for t in ts if t in often], 2)})
        model = context.broadcast((weights, sums["n"], sums["l"], pairs))
        index = stored(shards.mapInArrow(_impacts(model), _INDEX), "index")
        some = index.mapInArrow(_search(context.broadcast(items), context.broadcast(often), top), "item_id long, doc_id long, score long")
        found = some if found is None else found.union(some)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    first = _best(found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64))), top, "item_id", "part")
    return _best(first.drop("rank"), top, "item_id").select("item_id", "rank", "doc_id", "score")
