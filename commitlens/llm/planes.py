"""Token-id files: fixed-size blocks of ids, shuffled into byte planes and compressed plane by plane."""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commitlens.llm.common import worker_tool
from commitlens.llm.encoder import encoder
from commitlens.llm.ragged import slices
from commitlens.session import shared_dir, written

# Fixed values of the format: first and last bytes of a file, ids in a block, bytes of an id.
MAGIC, BLOCK_IDS, PLANES = b"IDPLANE1", 65_536, 4
_LEVEL = 1
MANIFEST = "part int, path string, docs long, ids long, bytes long"


def open_store(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system and path of a folder given as a path or a URI."""
    if folder.startswith("file:"):
        folder = "/" + folder[len("file:") :].lstrip("/")
    return pa.fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


class PlaneWriter:
    """Writes one file: blocks of planes, then the index of blocks and documents, then its place.

    A block of n ids is an n by 4 matrix of bytes; its transpose has all lowest bytes first, then
    all second ones, and so on. Each such plane is a zstandard frame of its own, and the index
    holds the sizes of all frames, so a reader can go to any block, or any document's blocks.
    """

    def __init__(self, out):
        self._out, self._zip = out, zstandard.ZstdCompressor(level=_LEVEL)
        self._left, self._held = bytearray(), 0
        self._frames: list[list[int]] = []
        self._docs: list[int] = []
        self._null: list[int] = []
        self._lengths: list[int] = []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if doc_id is None:
            self._null.append(len(self._docs))
        self._docs.append(doc_id or 0)
        self._lengths.append(len(ids) // PLANES)
        self._left += ids
        whole = PLANES * BLOCK_IDS
        if len(self._left) >= whole:
            end = len(self._left) // whole * whole
            for at in range(0, end, whole):
                self._block(self._left[at : at + whole])
            del self._left[:end]

    def _block(self, raw: bytes | bytearray) -> None:
        planes = np.frombuffer(bytes(raw), np.uint8).reshape(-1, PLANES).T
        frames = [self._zip.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
        for frame in frames:
            self._out.write(frame)
        self._frames.append([len(f) for f in frames])

    def close(self) -> tuple[int, int, int]:
        """(documents, ids, bytes) written."""
        if self._left:
            self._block(self._left)
        total = sum(self._lengths)
        arrays = [np.array(x, "<i8") for x in (self._frames, self._docs, self._null, self._lengths)]
        packed = [self._zip.compress(a.tobytes()) for a in arrays]
        head = {"ids": total, "block": BLOCK_IDS, "blocks": len(self._frames), "parts": [len(p) for p in packed]}
        index = json.dumps(head).encode()
        tail = struct.pack("<I", len(index)) + index + b"".join(packed)
        self._out.write(tail + struct.pack("<Q", len(tail)) + MAGIC)
        return len(self._docs), total, len(MAGIC) * 2 + int(np.sum(self._frames, dtype=np.int64)) + len(tail) + 8


class PlaneReader:
    """Reads a file of ``PlaneWriter``: any run of ids by way of its blocks, or all documents."""

    def __init__(self, source, size: int):
        self._in, self._zip = source, zstandard.ZstdDecompressor()
        source.seek(size - 16)
        end = source.read(16)
        if end[8:] != MAGIC:
            raise ValueError("not a file of token-id planes")
        (length,) = struct.unpack("<Q", end[:8])
        source.seek(size - 16 - length)
        tail = source.read(length)
        (width,) = struct.unpack_from("<I", tail)
        head = json.loads(tail[4 : 4 + width])
        arrays, at = [], 4 + width
        for n in head["parts"]:
            arrays.append(np.frombuffer(self._zip.decompress(tail[at : at + n]), "<i8"))
            at += n
        self.ids, self._block_ids = head["ids"], head["block"]
        self._frames = arrays[0].reshape(-1, PLANES)
        self._starts = len(MAGIC) + np.concatenate([[0], np.cumsum(self._frames.sum(axis=1))])
        self.docs: list[int | None] = arrays[1].tolist()
        for i in arrays[2].tolist():
            self.docs[i] = None
        self.lengths = arrays[3]

    def block(self, number: int) -> np.ndarray:
        sizes = self._frames[number].tolist()
        self._in.seek(int(self._starts[number]))
        raw = self._in.read(sum(sizes))
        planes, at = [], 0
        for n in sizes:
            planes.append(np.frombuffer(self._zip.decompress(raw[at : at + n]), np.uint8))
            at += n
        return np.ascontiguousarray(np.stack(planes, axis=1)).view("<u4").ravel()

    def read(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from position ``start`` of the file, reading only their blocks."""
        if not count:
            return np.empty(0, "<u4")
        first, last = start // self._block_ids, (start + count - 1) // self._block_ids
        blocks = np.concatenate([self.block(b) for b in range(first, last + 1)])
        return blocks[start - first * self._block_ids :][:count]

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, start in the file, ids) in file order, a block at a time."""
        left, number, start = b"", 0, 0
        for doc, length in zip(self.docs, self.lengths.tolist(), strict=True):
            need, parts = PLANES * length, [left]
            have = len(left)
            while have < need:
                raw = self.block(number).tobytes()
                parts.append(raw)
                have += len(raw)
                number += 1
            joined = b"".join(parts) if len(parts) > 1 else left
            yield doc, start, joined[:need]
            left = joined[need:]
            start += length


def write_ids(
    docs: DataFrame, vocabulary: str, end_id: int, folder: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encode every text, add ``end_id``, write the ids to files in ascending id order.

    Rows are range-partitioned and sorted by id (then text, so that repeated ids have an order;
    null ids first), and each task streams its rows into one file below ``folder``, a block in
    memory at a time. Returns the manifest: part, path, docs, ids, bytes, in order of parts. A
    file's name is its own attempt's, and only files of successful tasks are in the manifest, so
    lost tasks leave no trace in it. A null text counts as empty and has the end id alone; an
    empty table gives no documents. Other columns are not read.
    """
    root = f"{folder.rstrip('/')}/ids-{uuid.uuid4().hex}"
    store, path = open_store(root)
    store.create_dir(path, recursive=True)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, writer = worker_tool(("planes", vocabulary), lambda: encoder(vocabulary)), None
        files, base = open_store(root)
        name = f"{base}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.ids"
        stream = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if stream is None:
                stream = files.open_output_stream(name)
                writer = PlaneWriter(stream)
            for part in slices(batch, 1):
                ids, texts = (c.to_pylist() for c in part.columns)
                for doc, raw in zip(ids, words.texts(texts), strict=True):
                    writer.add(doc, raw + end)
        if stream is not None:
            done = writer.close()
            stream.close()
            row = [TaskContext.get().partitionId(), f"{root}/{name.rsplit('/', 1)[-1]}", *done]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["part", "path", "docs", "ids", "bytes"]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("binary").alias("text"))
    ordered = picked.repartitionByRange("id").sortWithinPartitions("id", "text")
    return written(ordered.mapInArrow(run, MANIFEST), "manifest")


def read_ids(manifest: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, start, ids): every document of the files, with the number of ids in all documents before it.

    ``ids`` are little-endian unsigned 32-bit integers, the end id included. One task reads a file,
    a block at a time; only the manifest's few rows, one per file, are summed up in one place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, place = open_store(path)
                with files.open_input_file(place) as source:
                    rows, held = [], 0
                    for doc, start, ids in PlaneReader(source, size).documents():
                        rows.append((doc, base + start, ids))
                        held += len(ids)
                        if held >= 4 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("part", "path", "bytes", F.coalesce(before, F.lit(0)).alias("base"))
    dealt = files.repartition(max(1, manifest.count()), "part").select("path", "bytes", "base")
    return dealt.mapInArrow(run, "id long, start long, ids binary").withColumnRenamed("id", id_column)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, start, ids = zip(*rows, strict=True)
    arrays = [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["id", "start", "ids"])


def ids_round_trip(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files that ``write_ids`` wrote, read back."""
    back = read_ids(write_ids(docs, vocabulary, end_id, shared_dir(docs.sparkSession)))
    return back.select(
        "doc_id",
        "start",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
