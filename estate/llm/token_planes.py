"""Token ids in binary files of bit planes.

The ids of all documents, in the order of their ids, are one stream that is cut into shards.  A shard file holds the
stream in blocks of a fixed number of ids.  A block is transposed into bit planes (or byte planes), each plane is
compressed with zstandard, and planes that are all zero are left out.  After its planes stands the table of
the documents that start in the block; the end of the file is the index of the blocks, so that any stretch of ids
is read from the blocks that hold it.

    magic | block* | index | length of the index, 8 bytes | magic          block: plane* documents

A task writes one file under a name of its own attempt.  The table ``index`` of the folder names the files that count, so a
repeated task leaves at most a file that nothing names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estate.llm.encoder import WordEncoder
from estate.llm.words import fresh, text_slices, worker_model

#: id that ends each document
END = 2
#: ids in a block
BLOCK = 1 << 16
MAGIC = b"IDPLANE1"
LEVEL = 3
_BITS = 32
_INDEX = np.dtype([("at", "<i8"), ("before", "<i8"), ("ids", "<i8"), ("documents", "<i8"), ("width", "<i8"), ("planes", "<i8", (_BITS,))])


def to_planes(ids: np.ndarray, width: int) -> list[bytes]:
    """The planes of 32-bit ids, low ones first: of single bits (``width`` 1) or of bytes (8), down to the last that isn't zero."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    used = -(-int(ids.max(initial=0)).bit_length() // width)
    if width == 8:
        return [octets[:, k].tobytes() for k in range(used)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(used)]


def from_planes(planes: list[bytes], width: int, n: int) -> np.ndarray:
    """The inverse of ``to_planes`` for ``n`` ids."""
    octets = np.zeros((n, 4), np.uint8)
    if width == 8:
        for k, plane in enumerate(planes):
            octets[:, k] = np.frombuffer(plane, np.uint8)
    else:
        for k, plane in enumerate(planes):
            octets[:, k >> 3] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little") << np.uint8(k & 7)
    return octets.view("<u4").reshape(-1)


def _table(keys: pa.Array, starts: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([keys, pa.array(starts, pa.int64())], names=["key", "start"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


class PlaneWriter:
    """Writes one shard file; holds no more than a block and what was added last."""

    def __init__(self, sink, width: int = 1, block: int = BLOCK):
        import zstandard

        self.sink, self.width, self.block = sink, width, block
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.at = len(MAGIC)
        self.total = self.documents = self.done = self.waiting = 0
        self.ids: list[np.ndarray] = []
        self.keys: list[pa.Array] = []
        self.starts: list[np.ndarray] = []
        self.index: list[tuple] = []
        sink.write(MAGIC)

    def add(self, keys: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents one after the other, each of at least one id."""
        ends = np.cumsum(lengths)
        self.keys.append(keys)
        self.starts.append(self.total + ends - lengths)
        self.ids.append(ids)
        self.total += len(ids)
        self.documents += len(lengths)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            self._flush(self.waiting // self.block * self.block)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.ids)
        keys, starts = pa.concat_arrays(self.keys), np.concatenate(self.starts)
        for at in range(0, n, self.block):
            part = ids[at : min(at + self.block, n)]
            inside = np.searchsorted(starts, [self.done, self.done + len(part)])
            planes = [self.pack(p) for p in to_planes(part, self.width)]
            table = self.pack(_table(keys.slice(inside[0], inside[1] - inside[0]), starts[inside[0] : inside[1]]))
            for piece in (*planes, table):
                self.sink.write(piece)
            sizes = [len(p) for p in planes]
            self.index.append((self.at, self.done, len(part), len(table), self.width, sizes + [0] * (_BITS - len(sizes))))
            self.at += sum(sizes) + len(table)
            self.done += len(part)
        later = int(np.searchsorted(starts, self.done))
        self.ids, self.waiting = [ids[n:].copy()], len(ids) - n
        self.keys, self.starts = [pa.concat_arrays([keys.slice(later)])], [starts[later:].copy()]

    def close(self) -> None:
        if self.waiting:
            self._flush(self.waiting)
        index = self.pack(np.array(self.index, _INDEX).tobytes())
        self.sink.write(index + len(index).to_bytes(8, "little") + MAGIC)


class PlaneFile:
    """Reads a shard file block by block, or any stretch of its ids."""

    def __init__(self, source):
        import zstandard

        self.source, self.unpack = source, zstandard.ZstdDecompressor().decompress
        size = source.size()
        tail = self._read(size - len(MAGIC) - 8, len(MAGIC) + 8)
        if tail[8:] != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("this is no file of id planes")
        length = int.from_bytes(tail[:8], "little")
        self.index = np.frombuffer(self.unpack(self._read(size - len(tail) - length, length)), _INDEX)

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def block(self, k: int) -> np.ndarray:
        """Ids of block ``k``."""
        entry = self.index[k]
        sizes = [int(s) for s in entry["planes"] if s]
        data = self._read(int(entry["at"]), sum(sizes))
        ends = np.cumsum([0, *sizes])
        return from_planes([self.unpack(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)], int(entry["width"]), int(entry["ids"]))

    def documents(self, k: int) -> pa.RecordBatch:
        """``key, start`` of the documents that start in block ``k``."""
        entry = self.index[k]
        data = self._read(int(entry["at"]) + int(entry["planes"].sum()), int(entry["documents"]))
        return pa.ipc.open_stream(self.unpack(data)).read_next_batch()

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` up to ``end`` of the shard, from the blocks that hold them."""
        before = self.index["before"]
        found = [np.zeros(0, np.uint32)]
        for k in range(int(np.searchsorted(before, start, side="right")) - 1, int(np.searchsorted(before, end))):
            at = int(before[k])
            found.append(self.block(k)[max(0, start - at) : max(0, end - at)])
        return np.concatenate(found)


def _open(location: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(location)


def write_ids(
    docs: DataFrame, tokenizer: str, location: str, end: int = END, width: int = 1, block: int = BLOCK, id_column: str = "doc_id"
) -> DataFrame:
    """Write the ids of all ``docs``, each followed by ``end``, in ascending id order; returns the table of shards.

    ``location`` is a folder that all executors reach by a URI that Arrow's file systems know.  Shards are the ranges of a global sort,
    so ``shard, file, first_doc, documents, ids, before`` give the place of every id of the stream.

    Null text is one end id; texts are taken whole; a null document id comes first; rows of one id are ordered by a
    hash of their text, so that an id of very many rows is several shards; repeated rows stay; an empty table
    makes no shard; other columns are ignored.
    """
    from pyspark import TaskContext

    text, key, order = fresh(docs, "_text"), fresh(docs, "_key"), fresh(docs, "_order")
    folder = f"{location.rstrip('/')}/ids"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, out, first = TaskContext.get().partitionId(), None, None
        encoder = worker_model(WordEncoder, tokenizer)
        last = np.array([end], np.uint32)
        for batch in batches:
            for part in text_slices(batch, text):
                if out is None:
                    system, path = _open(folder)
                    system.create_dir(path, recursive=True)
                    name = f"{shard:06d}-{uuid.uuid4().hex}.planes"
                    sink = system.open_output_stream(f"{path}/{name}")
                    out, first = PlaneWriter(sink, width, block), part.column(key).slice(0, 1)
                ids, bounds = encoder.ids(part.column(text))
                out.add(part.column(key), np.diff(bounds) + 1, np.insert(ids, bounds[1:], last))
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([name]), first, pa.array([out.documents], pa.int64()), pa.array([out.total], pa.int64())],
                names=["shard", "file", "first_doc", "documents", "ids"],
            )

    ordered = (
        docs.select(F.col(id_column).alias(key), F.col("text").alias(text))
        .withColumn(order, F.xxhash64(text))
        .orderBy(F.col(key).asc_nulls_first(), order)
        .drop(order)
    )
    kind = docs.schema[id_column].dataType.simpleString()
    written = ordered.mapInArrow(run, f"shard int, file string, first_doc {kind}, documents bigint, ids bigint")
    written.write.parquet(f"{location.rstrip('/')}/index")
    return read_index(docs.sparkSession, location)


def read_index(spark: SparkSession, location: str) -> DataFrame:
    """The shards that count and the number of ids ``before`` each; a row per shard, so one task numbers them."""
    index = spark.read.parquet(f"{location.rstrip('/')}/index")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return index.withColumn("before", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))


def read_ids(spark: SparkSession, location: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of the files: place in the stream, and little-endian unsigned 32-bit ids.

    A task reads one shard, block by block, and holds a block and the document that reaches into it.
    """
    index = read_index(spark, location)
    folder = f"{location.rstrip('/')}/ids"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                system, path = _open(folder)
                with system.open_input_file(f"{path}/{shard['file']}") as source:
                    yield from _documents(PlaneFile(source), shard["before"])

    def _documents(file: PlaneFile, before: int) -> Iterator[pa.RecordBatch]:
        key, start, held = None, 0, []  # the document that the block before ended in
        blocks = len(file.index)
        for k in range(blocks):
            ids, begun = file.block(k), file.documents(k)
            at = int(file.index["before"][k])
            starts = begun.column("start").to_numpy()
            cuts = starts - at
            keys, places, found = [], [], []
            head = ids[: cuts[0]] if len(cuts) else ids
            if len(head):
                held.append(head)
            if key is not None and len(cuts):
                keys.append(key)
                places.append([start])
                found.append(np.concatenate(held))
            if len(cuts):
                whole = len(cuts) - 1
                keys.append(begun.column("key").slice(0, whole))
                places.append(starts[:whole])
                found += np.split(ids[: cuts[-1]], cuts[:-1])[1:] if whole else []
                key, start, held = begun.column("key").slice(whole), int(starts[-1]), [ids[cuts[-1] :]]
            if k == blocks - 1 and key is not None:
                keys.append(key)
                places.append([start])
                found.append(np.concatenate(held))
            if found:
                lengths = np.fromiter(map(len, found), np.int64, len(found))
                offsets = np.zeros(len(found) + 1, np.int64)
                np.cumsum(lengths * 4, out=offsets[1:])
                data = np.concatenate(found).astype("<u4", copy=False)
                packed = pa.Array.from_buffers(pa.large_binary(), len(found), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(keys), pa.array(before + np.concatenate(places), pa.int64()), pa.array(lengths), packed.cast(pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    kind = dict(index.dtypes)["first_doc"]
    dealt = index.select("file", "before", "shard").repartitionByRange(max(1, index.count()), "shard")
    return dealt.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")
