"""Buckets of lines that may be linked, and of no others: ``line_dedup`` with ``exact``.

An edit breaks at most three runs of three words, so linked lines share all but ``keys_needed - 1`` of their distinct runs.
Of a line's runs, in an order that is the same for all lines, not only the ``keys_needed`` are dealt that hold one
shared run of every linked line, but ``_further`` more, of which each is shared too. Runs are counted as shared if
they stand in another line of a length that allows a link; a line with too few of them has no link and leaves, and
of those that stay only the needed keys make buckets. Buckets of the same lines are one.

Keys are dealt as arrays of fixed records, a row for each batch and task, and sorted there: a key costs twelve bytes
and no row. The 31 bits of a key within its task, and 48 bits of a line's hash, may only bring further candidates
(lines that the 48 bits don't tell apart are told apart by ``line_dedup``)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, release, slices, stored, text_of

#: Bits of a node.
NODE = 48
#: Text bytes whose keys are sorted by one task.
PART_BYTES = 12 << 20
#: Lengths of linked lines are at most LENGTHS steps of a factor of STEP apart.
STEP, LENGTHS = 1.06, 4
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SCHEMA = "part int, blob binary"
SETS = "key long, other long, nodes array<long>"


def _further(n: np.ndarray) -> np.ndarray:
    return np.maximum(n - 10, 0) // 7


def keys_dealt(n: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """Runs that are dealt of a line of ``n`` words of which ``needed`` hold a shared one."""
    return needed + _further(n)


def least_shared(n: np.ndarray, needed: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """How many of the dealt keys of a line of ``n`` words and ``runs`` distinct runs a linked line shares: all but the
    broken runs if all are dealt, else one and the further ones of the shorter line."""
    return np.clip(np.minimum(runs - (needed - 1), 1 + _further(-(-n * 4 // 5))), 1, 255)


def length_code(n: np.ndarray) -> np.ndarray:
    return np.clip(np.log(np.maximum(n, 5) / 5) / math.log(STEP), 0, 255).astype(np.uint8)


def dealt(part: np.ndarray, records: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each part with its records, of which each is a row of ``records``."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    part = part[order]
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    data = np.ascontiguousarray(records[order]).view(np.uint8).reshape(len(part), -1)
    ends = (np.append(first, len(part)) * data.shape[1]).astype(np.int32)
    blobs = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    yield pa.RecordBatch.from_arrays([pa.array(part[first].astype(np.int32)), blobs], names=["part", "blob"])


def _records(batches: Iterator[pa.RecordBatch], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, record) of all that a task receives."""
    parts, blobs = [], []
    for batch in slices(batches, "blob"):
        own = batch.column("blob").to_pylist()
        parts.append(np.repeat(batch.column("part").to_numpy(), [len(b) // width for b in own]))
        blobs.append(np.frombuffer(b"".join(own), np.uint8).reshape(-1, width))
    if not parts:
        return np.empty(0, np.int32), np.empty((0, width), np.uint8)
    return np.concatenate(parts), np.concatenate(blobs)


def packed(nodes: np.ndarray, keys: np.ndarray, base: np.ndarray, codes: np.ndarray, least: np.ndarray) -> np.ndarray:
    out = np.empty((len(nodes), 12), np.uint8)
    out[:, :6] = nodes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    out[:, 6:10] = ((keys & np.uint64(0x7FFFFFFF)) | (base.astype(np.uint64) << np.uint64(31))).astype("<u4").view(np.uint8).reshape(-1, 4)
    out[:, 10], out[:, 11] = codes, least
    return out


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)


def _same(x: np.ndarray) -> np.ndarray:
    """Whether a row equals the one before."""
    return np.append(False, x[1:] == x[:-1]) if len(x) else np.empty(0, bool)


def _beside(fits: np.ndarray) -> np.ndarray:
    """Rows that fit the one before or are fitted by the one after."""
    return fits | np.append(fits[1:], False)


def _alike(keys: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether the row before, in order of keys and lengths, has the same key and a length that allows a link."""
    return _same(keys) & (np.diff(codes.astype(np.int16), prepend=np.int16(0)) <= LENGTHS)


def _shared_in(parts: int):
    """Records of keys that stand in two lines, dealt by line: (node and length, key and whether it makes buckets, least)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, raw = _records(batches, 12)
        key = np.ascontiguousarray(raw[:, 6:10]).view("<u4")[:, 0]
        order = np.argsort((part.astype(np.uint64) << np.uint64(39)) | ((key & np.uint32(0x7FFFFFFF)).astype(np.uint64) << np.uint64(8)) | raw[:, 10])
        part, raw, key = part[order], raw[order], key[order]
        whole = (part.astype(np.uint64) << np.uint64(31)) | (key & np.uint32(0x7FFFFFFF))
        some = _beside(_alike(whole, raw[:, 10]))
        raw, key, whole = raw[some], key[some], whole[some]
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :6] = raw[:, :6]
        node, code, least = wide.view("<u8")[:, 0], raw[:, 10], raw[:, 11]
        # an equal line brings a key again
        line = (node << np.uint64(8)) | least
        order = np.lexsort((line, code, whole))
        line, code, key, whole = line[order], code[order], key[order], whole[order]
        fresh = ~(_same(whole) & _same(line))
        line, code, key, whole = line[fresh], code[fresh], key[fresh], whole[fresh]
        some = _beside(_alike(whole, code))
        line, key, whole = line[some], key[some], whole[some]
        yield from dealt(((line >> np.uint64(8)) % np.uint64(parts)).astype(np.int32), np.stack([line, (whole << np.uint64(1)) | (key >> np.uint32(31))], axis=1))

    return find


def _enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of lines that share as many keys as a linked line would, dealt by key."""
    _, raw = _records(batches, 16)
    raw = raw.view("<u8")
    raw = raw[np.argsort(raw[:, 0])]
    first = np.flatnonzero(~_same(raw[:, 0]))
    counts = np.diff(np.append(first, len(raw)))
    stay = np.repeat(counts >= (raw[first, 0] & np.uint64(255)), counts) & ((raw[:, 1] & np.uint64(1)) == 1)
    node, key = raw[stay, 0] >> np.uint64(8), raw[stay, 1] >> np.uint64(1)
    yield from dealt((key >> np.uint64(31)).astype(np.int32), np.stack([node, key], axis=1))


def sets(key: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The distinct sets of two nodes or more that have a key in common."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    some = _beside(_same(key))
    key, node = key[some], node[some]
    if not len(key):
        return
    first = np.flatnonzero(~_same(key))
    with np.errstate(over="ignore"):
        mixed = (node + np.uint64(1)) * _MIX
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX
        one = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), first)
        two = np.add.reduceat((mixed ^ (mixed >> np.uint64(31))) * _MIX, first)
    chosen = np.sort(np.unique(np.stack([one, two], axis=1), axis=0, return_index=True)[1])
    members = pa.ListArray.from_arrays(pa.array(np.append(first, len(key)).astype(np.int32)), pa.array(node.view(np.int64))).take(pa.array(chosen))
    table = pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)[chosen]), pa.array(two.view(np.int64)[chosen]), members], names=["key", "other", "nodes"])
    for at in range(0, table.num_rows, 10_000):
        yield table.slice(at, 10_000)


def _buckets_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _, raw = _records(batches, 16)
    raw = raw.view("<u8")
    yield from sets(raw[:, 1], raw[:, 0])


def spread_sets(found: DataFrame) -> DataFrame:
    """(key, node), stored, of sets, each once."""
    return stored(found.dropDuplicates(["key", "other"]).select("key", F.explode("nodes").alias("node")), "line-buckets")


def buckets(docs: DataFrame, dealer) -> DataFrame:
    """(key, node), stored: lines that may be linked, by what they share. ``dealer`` makes, for a number of parts, the function
    from texts to records."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    parts = max(1, math.ceil(size / PART_BYTES))
    dealt = docs.select("text").mapInArrow(dealer(parts), _SCHEMA).repartitionById(parts, F.col("part"))
    shared = stored(dealt.mapInArrow(_shared_in(parts), _SCHEMA), "line-shared")
    del dealt
    release(spark)
    enough = shared.repartitionById(parts, F.col("part")).mapInArrow(_enough, _SCHEMA)
    found = spread_sets(enough.repartitionById(parts, F.col("part")).mapInArrow(_buckets_in, SETS))
    forget(shared)
    return found

