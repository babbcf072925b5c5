"""Packing by power-of-two decomposition.

Each document's tokens (with an end id) are cut into pieces of ``max_len`` and then of the binary digits of
the rest, longest first. A piece is a sequence of its own, and pieces of one length form a bucket, so no
sequence crosses documents and none needs padding.

Defined results: null or empty text is its end id alone; a very long text is many full pieces; repeated rows,
ties and null ids are packed like any other row; an empty table gives no rows; further columns are ignored,
whatever their names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batch_bytes, slices
from .tokens import BATCH_BYTES, encoder, shared_spec

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)


def binary_lengths(n: int, max_len: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: full ones, then the powers of two that make up the rest."""
    full, rest = divmod(n, max_len)
    return [max_len] * full + [1 << b for b in range(max_len.bit_length() - 2, -1, -1) if rest >> b & 1]


def _cutter(spec, end_id: int, max_len: int, batch_size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, known = encoder(spec).encode, {}
        for batch in slices(batches, "text", batch_size):
            bounds, data = encode(batch.column("text"), end_id)
            totals = np.diff(bounds)
            for n in np.unique(totals).tolist():
                if n not in known:
                    known[n] = (own := np.array(binary_lengths(n, max_len), np.int64), np.cumsum(own) - own)
            pieces = [known[n] for n in totals.tolist()]
            if len(known) > 100_000:
                known.clear()
            length, starts = np.concatenate([p[0] for p in pieces]), np.concatenate([p[1] for p in pieces])
            counts = np.array([len(p[0]) for p in pieces])
            offsets = np.zeros(len(length) + 1, np.int64)
            np.cumsum(length * 4, out=offsets[1:])
            if len(data) < 1 << 31:
                ids = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets.astype(np.int32)), data])
            else:
                ids = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(offsets), data]).to_pylist()
                ids = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(counts)), counts))),
                    pa.array(starts),
                    pa.array(length),
                    ids,
                    pa.array(np.repeat(totals, counts)),
                    pa.array(np.log2(length).astype(np.int32)),
                ],
                names=PIECES.names,
            )

    return cut


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, max_len: int = 2048, batch_size: int = BATCH_BYTES) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    bucket (log2 of the length), sequence_id, offset.

    ``batch_size`` is the bytes of text that a worker encodes at once: more take more memory and less time.
    A scan without a shuffle: sequences never hold two documents, so nothing has to meet."""
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    batch_bytes(docs.sparkSession, batch_size)
    spec = shared_spec(docs.sparkSession, tokenizer_path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = rows.mapInArrow(_cutter(spec, end_id, max_len, batch_size), PIECES)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The packed sequences as files, one folder for each length."""
    pieces.write.partitionBy("bucket").parquet(path)
