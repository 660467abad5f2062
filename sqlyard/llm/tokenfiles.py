"""Token ids as Arrow stream files of fixed-size lists: equal-length sequences and masks, read in place without a copy."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sqlyard.llm.common import PieceEncoder, id_and_text, text_slices
from sqlyard.session import work_folder
from sqlyard.sources.tables import stored

#: One row per document: where its ids begin in the file, and how many there are.
DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])

_MANIFEST = "part int, path string, n_docs long, n_tokens long"


def sequences_schema(length: int, width: int) -> pa.Schema:
    """``ids``: ``length`` unsigned numbers of ``width`` bytes; ``mask``: a bit each, set where an id stands, not where the last
    rows are filled up."""
    kind = {2: pa.uint16(), 4: pa.uint32()}[width]
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))], {"length": str(length)})


class SequenceWriter:
    """Writes one stream of ids as rows of ``length``. Every batch holds ``rows`` rows, so all batches have the same size in bytes."""

    def __init__(self, sink, length: int, width: int, rows: int):
        self.length, self.rows = length, rows
        self.schema, self.kind = sequences_schema(length, width), np.dtype(f"<u{width}")
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.held = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids.astype(self.kind))
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.rows * self.length:
            flat = np.concatenate(self.parts)
            whole = self.rows * self.length
            for start in range(0, len(flat) - whole + 1, whole):
                self._batch(flat[start: start + whole], whole)
            rest = flat[len(flat) // whole * whole:]
            self.parts, self.held = [rest], len(rest)

    def _batch(self, flat: np.ndarray, used: int) -> None:
        mask = np.arange(len(flat)) < used
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((flat, mask), self.schema)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.held:
            rest = np.concatenate(self.parts)
            filled = np.zeros(self.rows * self.length, self.kind)
            filled[: len(rest)] = rest
            self._batch(filled, len(rest))
        self.writer.close()


class SequenceFile:
    """A sequence file as one array that lies in the file's own memory: row ``i`` is found by arithmetic, not by reading on.

    ``buffer`` is a memory map, or the file's bytes where it is not local.
    """

    def __init__(self, buffer: pa.Buffer):
        self.buffer = buffer
        stream = pa.BufferReader(buffer)
        message = pa.ipc.read_message(stream)
        self.schema = pa.ipc.read_schema(message)
        self.begin, self.length = stream.tell(), int(self.schema.metadata[b"length"])
        first = pa.ipc.read_message(stream)
        if first is None or first.type != "record batch":
            self.step, self.rows, self.batches = 1, 1, 0
            return
        self.step = stream.tell() - self.begin
        self.rows = pa.ipc.read_record_batch(first, self.schema).num_rows
        self.batches = (buffer.size - self.begin) // self.step  # the end mark is shorter than a batch

    def batch(self, k: int) -> pa.RecordBatch:
        message = pa.ipc.read_message(pa.BufferReader(self.buffer.slice(self.begin + k * self.step, self.step)))
        return pa.ipc.read_record_batch(message, self.schema)

    def __len__(self) -> int:
        return self.batches * self.rows

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``i``, both views into the file; the mask is an Arrow array, since numpy has no bits."""
        ids, mask = (c.values.slice(i % self.rows * self.length, self.length) for c in self.batch(i // self.rows).columns)
        return ids.to_numpy(zero_copy_only=True), mask

    def span(self, first: int, count: int) -> np.ndarray:
        """Ids ``first`` to ``first + count`` of the file's stream, whatever rows they lie in."""
        whole = self.rows * self.length
        out = [np.zeros(0, np.uint16)]
        while count:
            k, at = divmod(first, whole)
            part = self.batch(k).column(0).flatten().to_numpy(zero_copy_only=True)[at: at + count]
            out.append(part)
            first, count = first + len(part), count - len(part)
        return np.concatenate(out[1:]) if len(out) > 1 else out[0]


def open_sequences(path: str) -> SequenceFile:
    """Maps a local file; reads a file of another store into memory."""
    store, inner = _at(path)
    if isinstance(store, fs.LocalFileSystem):
        return SequenceFile(pa.memory_map(inner).read_buffer())
    with store.open_input_file(inner) as source:
        return SequenceFile(source.read_buffer())


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


def write(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2, length: int = 2048, rows: int = 64, width: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Encodes texts and writes them below ``folder`` in ascending id order, one pair of files per task.

    ``part-*.arrows`` holds sequences of ``length`` ids, ``part-*.docs.arrows`` where documents begin. Returns the manifest
    ``(part, path, n_docs, n_tokens)``, itself written to the shared folder: files of the order's first ids
    come first. A file's name is new in each attempt of a task and only the manifest says which files count, so
    tasks may be lost and repeated. ``width`` 2 fits vocabularies below 65,536 ids, 4 any.

    Null text is empty. Rows without an id come first; rows that share an id are ordered by text.
    """
    if width == 2 and end_id >= 1 << 16:
        raise ValueError("the end id needs width 4")

    def run(batches):
        store, inner = _at(folder)
        store.create_dir(inner, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        encoder = PieceEncoder(vocabulary, (end_id,))
        n_docs, ids, firsts, sizes = 0, [], [], []
        with store.open_output_stream(f"{inner}/{name}.arrows") as sink, store.open_output_stream(f"{inner}/{name}.docs.arrows") as index:
            out, listing = SequenceWriter(sink, length, width, rows), pa.ipc.new_stream(index, DOCUMENTS)
            for batch in text_slices(batches, 2 << 20):
                firsts, sizes = [], []
                for found in encoder.encode([t or "" for t in batch.column("text").to_pylist()]):
                    if width == 2 and int(found.max()) >= 1 << 16:
                        raise ValueError("this vocabulary needs width 4")
                    firsts.append(out.total)
                    sizes.append(len(found))
                    out.add(found)
                listing.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(firsts), pa.array(sizes)], schema=DOCUMENTS))
                n_docs += batch.num_rows
            out.close()
            listing.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([n_docs]), pa.array([out.total])],
            ["part", "path", "n_docs", "n_tokens"])

    ordered = id_and_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(run, _MANIFEST), "manifest")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, path)`` of every document in the files, read back from them.

    ``start`` counts the ids of all documents before it. One task per file; ids leave the file as views.
    """
    parts = [r for r in manifest.orderBy("part").collect()]  # a row per file
    before, start = [], 0
    for r in parts:
        before.append((r["path"], start))
        start += r["n_tokens"]

    def run(batches):
        for batch in batches:
            for path, begin in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                sequences = open_sequences(f"{path}.arrows")
                store, inner = _at(f"{path}.docs.arrows")
                with store.open_input_file(inner) as source:
                    for listing in pa.ipc.open_stream(source):
                        first, size = listing.column("first").to_pylist(), listing.column("n_tokens").to_pylist()
                        sums = [zlib.crc32(sequences.span(a, n).astype("<u4").tobytes()) for a, n in zip(first, size)]
                        yield pa.RecordBatch.from_arrays([
                            listing.column("doc_id"), pa.array([begin + a for a in first], pa.int64()), listing.column("n_tokens"),
                            pa.array(sums, pa.int64()), pa.array([path] * listing.num_rows, pa.string()),
                        ], ["doc_id", "start", "n_tokens", "ids_crc32", "path"])

    files = spark.createDataFrame(before, "path string, start long").repartition(max(1, len(before)), "path")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, path string")


def write_and_read(docs: DataFrame, vocabulary: str, **settings) -> DataFrame:
    """Writes to a new folder in the shared one and reads the files back."""
    spark = docs.sparkSession
    return read(spark, write(docs, work_folder(spark, "tokens"), vocabulary, **settings))
