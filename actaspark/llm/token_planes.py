"""Token ids in plane-shuffled files.

A file holds the ids of consecutive documents. Its ids are cut into blocks of a fixed number; a block is
transposed into planes (byte planes: all lowest bytes, then all second bytes, ...; bit planes: all lowest
bits, ...), each plane is compressed with zstandard, and an index at the end has each block's place, length
and checksum, so any range of ids is read from its own blocks only. The document table (id, number of
tokens) stands beside it.

    "ATPLANE1" | planes of block 0 | planes of block 1 | ... | documents | index | length of both | "ATPLANE1"

Files are written under a name of their own by each task attempt and listed in a manifest table, which only
has the attempts that succeeded: a repeated or speculative task leaves an unlisted file, never a wrong one.

Defined results: null or empty text is its end id alone; a very long text spans blocks, never files; rows are ordered by doc_id (null first) and, within
a repeated doc_id, by text; an empty table gives no files and no rows; further columns are ignored, whatever
their names."""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import OrderedRanges, batch_bytes, shared_dir, slices, stored
from .tokens import BATCH_BYTES, encoder, shared_spec

MAGIC = b"ATPLANE1"


def shuffle_planes(ids: np.ndarray, planes: str = "byte") -> list[bytes]:
    """Unsigned 32-bit ids as 4 byte planes or 32 bit planes, lowest first."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [p.tobytes() for p in rows.T]
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(p, bitorder="little").tobytes() for p in bits.T]


def join_planes(parts: list[bytes], n: int, planes: str = "byte") -> np.ndarray:
    """The inverse of ``shuffle_planes``."""
    if planes == "byte":
        rows = np.stack([np.frombuffer(p, np.uint8) for p in parts], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in parts], axis=1)
        rows = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(rows).view("<u4").reshape(-1)


class PlaneWriter:
    """Writes one file; memory holds one block."""

    def __init__(self, out, block: int = 65_536, planes: str = "byte", level: int = 3):
        self.out, self.block, self.planes, self.zip = out, block, planes, zstandard.ZstdCompressor(level=level)
        self.at, self.index, self.held, self.n_held, self.docs, self.counts = len(MAGIC), [], [], 0, [], []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes | memoryview) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.held.append(ids)
        self.n_held += len(ids) // 4
        while self.n_held >= self.block:
            data = b"".join(self.held)
            self._put(data[: 4 * self.block])
            self.held, self.n_held = [data[4 * self.block :]], self.n_held - self.block

    def _put(self, data: bytes) -> None:
        parts = [self.zip.compress(p) for p in shuffle_planes(np.frombuffer(data, "<u4"), self.planes)]
        self.index.append([self.at, len(data) // 4, zlib.crc32(data), [len(p) for p in parts]])
        self.out.write(b"".join(parts))
        self.at += sum(map(len, parts))

    def close(self) -> None:
        if self.n_held:
            self._put(b"".join(self.held))
        ids = np.array([0 if d is None else d for d in self.docs], "<i8")
        nulls = np.array([d is None for d in self.docs], np.uint8)
        table = self.zip.compress(ids.tobytes() + np.array(self.counts, "<i8").tobytes() + nulls.tobytes())
        index = self.zip.compress(json.dumps({"block": self.block, "planes": self.planes, "n_docs": len(self.docs), "index": self.index}).encode())
        self.out.write(table + index + struct.pack("<QQ", len(table), len(index)) + MAGIC)


class PlaneReader:
    """Reads one file by its index; memory holds one block."""

    def __init__(self, src):
        self.src, self.unzip = src, zstandard.ZstdDecompressor()
        end = src.size()
        tail = self._at(end - 24, 24)
        if tail[16:] != MAGIC or self._at(0, 8) != MAGIC:
            raise ValueError("not a plane file")
        n_table, n_index = struct.unpack("<QQ", tail[:16])
        head = json.loads(self.unzip.decompress(self._at(end - 24 - n_index, n_index)))
        self.block, self.planes, self.index, n = head["block"], head["planes"], head["index"], head["n_docs"]
        table = self.unzip.decompress(self._at(end - 24 - n_index - n_table, n_table)) if n else b""
        self.docs, self.counts = np.frombuffer(table, "<i8", n), np.frombuffer(table, "<i8", n, 8 * n)
        self.nulls = np.frombuffer(table, np.uint8, n, 16 * n).astype(bool)

    def _at(self, offset: int, n: int) -> bytes:
        self.src.seek(offset)
        return self.src.read(n)

    def read_block(self, k: int) -> np.ndarray:
        at, n, crc, sizes = self.index[k]
        data, parts = self._at(at, sum(sizes)), []
        for size in sizes:
            parts.append(self.unzip.decompress(data[:size]))
            data = data[size:]
        ids = join_planes(parts, n, self.planes)
        if zlib.crc32(ids) != crc:
            raise ValueError(f"block {k} is damaged")
        return ids

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of this file, from the blocks that hold them."""
        first = start // self.block
        parts = [self.read_block(k) for k in range(first, -(-stop // self.block))] or [np.empty(0, "<u4")]
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """(doc_id, number of ids, their crc32), block by block."""
        ids, k, at = np.empty(0, "<u4"), 0, 0
        for doc, n, null in zip(self.docs.tolist(), self.counts.tolist(), self.nulls.tolist()):
            crc, left = 0, n
            while left:
                if at == len(ids):
                    ids, k, at = self.read_block(k), k + 1, 0
                part = ids[at : at + left]
                crc, at, left = zlib.crc32(part, crc), at + len(part), left - len(part)
            yield None if null else doc, n, crc


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _writer(spec, end_id: int, folder: str, block: int, planes: str, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(spec).encode
        files, root = open_fs(folder)
        files.create_dir(root, recursive=True)

        def rows():
            for batch in slices(batches, "text", BATCH_BYTES):
                bounds, data = encode(batch.column("text"), end_id)
                ids, bounds = memoryview(data), (4 * bounds).tolist()
                parts, docs = (batch.column(c).to_pylist() for c in ("part", "doc_id"))
                yield from zip(parts, docs, (ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])))

        for part, own in groupby(rows(), key=lambda r: r[0]):
            name = f"part-{part:06d}-{uuid.uuid4().hex}.planes"
            with files.open_output_stream(f"{root}/{name}") as out:
                writer = PlaneWriter(out, block, planes, level)
                for _, doc, ids in own:
                    writer.add(doc, ids)
                writer.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_docs": [len(writer.docs)], "n_tokens": [sum(writer.counts)], "n_blocks": [len(writer.index)]})

    return write


def write_planes(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2, block: int = 65_536, planes: str = "byte", level: int = 3, target_bytes: int = 64 << 20) -> DataFrame:
    """Encode all documents into plane files in ascending doc_id order; returns the manifest, stored in
    ``folder``: part, file, n_docs, n_tokens, n_blocks, start (ids in earlier files).

    One shuffle, of (id, text), into ranges of ids; the manifest has a row for each file."""
    spark = docs.sparkSession
    batch_bytes(spark, BATCH_BYTES)
    spec = shared_spec(spark, tokenizer_path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranges = OrderedRanges(rows, "doc_id", target_bytes, least_bytes=2 * BATCH_BYTES)
    dealt = ranges.deal(rows.withColumn("part", ranges.number().cast("long"))).sortWithinPartitions("part", F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    manifest = dealt.mapInArrow(_writer(spec, end_id, f"{folder}/ids", block, planes, level), "part long, file string, n_docs long, n_tokens long, n_blocks long")
    manifest = stored(manifest, "manifest", f"{folder}/written")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return stored(manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "manifest", f"{folder}/manifest")


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_fs(f"{folder}/ids")
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with files.open_input_file(f"{root}/{name}") as src:
                    reader = PlaneReader(src)
                    ids, counts, crcs = zip(*reader.documents())
                counts = np.array(counts, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(start + np.cumsum(counts) - counts), pa.array(counts), pa.array(crcs, pa.int64()), pa.array([name] * len(ids))], names=["doc_id", "start", "n_tokens", "ids_crc32", "file"])

    return read


def read_planes(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32, file."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    n = max(1, manifest.count())
    return manifest.repartition(n).mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long, file string")


def plane_digests(docs: DataFrame, tokenizer_path: str, end_id: int = 2, **options) -> DataFrame:
    """Write the files into the shared folder, then read them back."""
    folder = shared_dir(docs.sparkSession, "planes")
    write_planes(docs, tokenizer_path, folder, end_id, **options)
    return read_planes(docs.sparkSession, folder)
