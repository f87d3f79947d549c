"""Token ids in binary files of bit or byte planes.

A file holds chunks of at most ``block`` ids.  A chunk is transposed: the lowest byte (or
bit) of all its ids, then the next, and so on; each plane is compressed by itself, so planes
that are all zero cost a few bytes.  Behind the chunks stand two indexes (compressed): per
chunk its place, ids and plane lengths; per document its id and first id; then a fixed tail.

All numbers are little-endian 64-bit unless said otherwise:

    "IDPLANE1"                                      8 bytes
    chunk:    plane, plane, ...                     zstandard frames
    chunks:   n x (place, ids, length of each plane)
    docs:     n x (doc_id, doc_id is null, first id in the file, ids)
    tail:     place of chunks, bytes of chunks, bytes of docs, ids, docs, planes, "IDPLANE1"

Files are named by attempt, and the manifest that Spark returns lists those of the
attempts that counted; what a lost or repeated task left behind is never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.bpe import PIECE_BYTES, encoder
from postloom.llm.shared import fresh_folder, numbered, python_batches, staged
from postloom.llm.words import pieces

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
# Ids a task reads back, on average; never less than a file.
READ_IDS = 1 << 21
_TAIL = 7 * 8
_MANIFEST = "part int, path string, n_ids bigint, n_docs bigint"
_DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, path string"


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """32 bit planes or 4 byte planes of 32-bit ids."""
    as_bytes = ids.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [plane.tobytes() for plane in as_bytes.T]
    bits = np.unpackbits(as_bytes, axis=1, bitorder="little")
    return [np.packbits(plane, bitorder="little").tobytes() for plane in bits.T]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        as_bytes = np.stack([np.frombuffer(p, dtype=np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        as_bytes = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(as_bytes).reshape(-1).view("<u4")


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """Hadoop writes local paths with one slash; Arrow wants three."""
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file:///" + path[len("file:/") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


class FileWriter:
    """Writes one file; holds one block and the two indexes."""

    def __init__(self, path: str, kind: str = "byte", block: int = BLOCK, level: int = 3):
        store, where = _opened(path)
        store.create_dir(where.rsplit("/", 1)[0], recursive=True)
        self.out = store.open_output_stream(where)
        self.kind, self.block, self.squeeze = kind, block, zstandard.ZstdCompressor(level=level).compress
        self.out.write(MAGIC)
        self.place, self.waiting, self.held, self.total = len(MAGIC), [], 0, 0
        self.chunks: list[list[int]] = []
        self.docs: list[np.ndarray] = []

    def add(self, ids: np.ndarray, doc_ids: np.ndarray, null: np.ndarray, counts: np.ndarray) -> None:
        first = self.total + np.cumsum(counts) - counts
        self.docs.append(np.stack([doc_ids, null, first, counts], axis=1).astype("<i8"))
        self.total += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // self.block * self.block
            for at in range(0, whole, self.block):
                self._chunk(ids[at : at + self.block])
            self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def _chunk(self, ids: np.ndarray) -> None:
        planes = [self.squeeze(p) for p in to_planes(ids, self.kind)]
        for plane in planes:
            self.out.write(plane)
        self.chunks.append([self.place, len(ids), *map(len, planes)])
        self.place += sum(map(len, planes))

    def close(self) -> int:
        """Number of documents written."""
        if self.held:
            self._chunk(np.concatenate(self.waiting))
        planes = 4 if self.kind == "byte" else 32
        docs = np.concatenate(self.docs) if self.docs else np.zeros((0, 4), "<i8")
        chunks = self.squeeze(np.array(self.chunks, dtype="<i8").reshape(-1, 2 + planes).tobytes())
        index = self.squeeze(docs.tobytes())
        tail = np.array([self.place, len(chunks), len(index), self.total, len(docs), planes], dtype="<i8").tobytes()
        self.out.write(chunks + index + tail + MAGIC)
        self.out.close()
        return len(docs)


class FileReader:
    """Reads the indexes of a file at once, and chunks as they are asked for."""

    def __init__(self, path: str):
        store, where = _opened(path)
        self.file = store.open_input_file(where)
        size = self.file.size()
        tail = self._at(size - _TAIL, _TAIL)
        if tail[-8:] != MAGIC:
            raise ValueError(f"not a token file: {path}")
        place, chunk_bytes, doc_bytes, self.n_ids, n_docs, planes = np.frombuffer(tail[:-8], dtype="<i8").tolist()
        spread = zstandard.ZstdDecompressor().decompress
        self.chunks = np.frombuffer(spread(self._at(place, chunk_bytes)), dtype="<i8").reshape(-1, 2 + planes)
        self.docs = np.frombuffer(spread(self._at(place + chunk_bytes, doc_bytes)), dtype="<i8").reshape(n_docs, 4)
        self.first = np.concatenate([[0], np.cumsum(self.chunks[:, 1])])

    def _at(self, place: int, n: int) -> bytes:
        self.file.seek(place)
        return self.file.read(n)

    def chunk(self, i: int) -> np.ndarray:
        place, n, *lengths = self.chunks[i].tolist()
        raw, at, planes = self._at(place, sum(lengths)), 0, []
        for length in lengths:
            planes.append(zstandard.ZstdDecompressor().decompress(raw[at : at + length]))
            at += length
        return from_planes(planes, n)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids [begin, end) of the file; only the chunks that hold them are read."""
        if begin >= end:
            return np.zeros(0, dtype="<u4")
        a, b = np.searchsorted(self.first, [begin, end - 1], side="right") - 1
        parts = np.concatenate([self.chunk(i) for i in range(a, b + 1)])
        return parts[begin - self.first[a] : end - self.first[a]]

    def checksums(self) -> list[int]:
        """CRC-32 of each document's ids as 32-bit little-endian numbers, chunk by chunk."""
        out = [0] * len(self.docs)
        begin, end = self.docs[:, 2], self.docs[:, 2] + self.docs[:, 3]
        for i in range(len(self.chunks)):
            low, high, ids = self.first[i], self.first[i + 1], self.chunk(i)
            a, b = np.searchsorted(end, low, side="right"), np.searchsorted(begin, high)
            for d in range(a, b):
                out[d] = zlib.crc32(ids[max(begin[d] - low, 0) : end[d] - low], out[d])
        return out


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end: int, kind: str = "byte", block: int = BLOCK) -> DataFrame:
    """Writes the ids of all texts, in ascending doc_id order over the files; returns the manifest.

    Null ids come first; rows of equal id are told apart by a row number, so a repeated id is
    dealt over several tasks.  Null text is empty: its end id alone.  File sizes follow Spark's
    advisory partition size.  An empty table gives no file, or empty ones.  The manifest, a row
    per file, is gathered by a shuffle: Hadoop's writer costs a folder, two files and, on local
    disks, a process forked off the executor for each, which many tasks of one row would all pay.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path, out = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.ids", None
        encode = encoder(tokenizer, end).encode
        for batch in batches:
            for some in pieces(batch, limit=PIECE_BYTES):
                out = out or FileWriter(path, kind, block)
                ids, counts = encode(some.column("text"))
                doc_ids = some.column("doc_id")
                out.add(ids, doc_ids.fill_null(0).to_numpy(), doc_ids.is_null().to_numpy(zero_copy_only=False), counts)
        if out:
            n = out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([path]), pa.array([out.total], pa.int64()), pa.array([n], pa.int64())],
                names=["part", "path", "n_ids", "n_docs"],
            )

    python_batches(docs.sparkSession)
    rows = numbered(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    in_order = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "uid").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "uid")
    return staged(in_order.mapInArrow(write, _MANIFEST).repartition(1), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start (ids before it in all files), n_tokens, ids_crc32, path."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                file = FileReader(path)
                doc_ids = pa.array(file.docs[:, 0], pa.int64(), mask=file.docs[:, 1].astype(bool))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(file.docs[:, 2] + base), pa.array(file.docs[:, 3].copy()), pa.array(file.checksums(), pa.int64()), pa.array([path] * len(doc_ids), pa.string())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "path"],
                )

    # Tasks by the ids in the files: the rows are tiny, so adaptive coalescing must not gather them.
    n, ids = manifest.agg(F.count("*"), F.coalesce(F.sum("n_ids"), F.lit(0))).first()
    return files.select("path", "base").repartition(max(1, min(n, -(-ids // READ_IDS)))).mapInArrow(read, _DOCS)


def token_file_round_trip(docs: DataFrame, tokenizer: str, end: int, kind: str = "byte") -> DataFrame:
    """Writes the files to a new shared folder and reads them back."""
    folder = fresh_folder(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer, end, kind))
