"""Document fingerprints: threshold-scaled sketches.

A text's shingles are its runs of ``width`` UTF-8 bytes. Each gets a 32-bit hash, and the sketch keeps every
hash below a fixed fraction of the range. Sketches of parts merge by union, and as the threshold is the same
for every document, the share of the smaller sketch that is in the larger one estimates containment even
between very unequal documents. A text with fewer than ``least`` hashes below the threshold keeps its
``least`` smallest ones (all, if it has no more) and notes up to where it is complete; two sketches are
compared up to the lower of their limits.

Defined results: null text is empty; an empty text has an empty sketch, like only another empty one (1.0,
otherwise 0.0); a text shorter than a shingle is one shingle; rows with one doc_id are ordered by text, null
ids first; the next document of a single row is itself; a very long text is read whole; repeated rows give a row
each, with equal fingerprints; further columns are left out, whatever their names; an empty table gives no rows."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import OrderedRanges, slices

WIDTH, FRACTION, LEAST = 16, 32, 32
_FULL = (1 << 32) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def shingle_hashes(data: bytes, width: int = WIDTH) -> np.ndarray:
    """32-bit hashes of all runs of ``width`` (a power of two) bytes."""
    if not data:
        return np.empty(0, np.uint32)
    h = np.frombuffer(data.ljust(width, b"\0"), np.uint8).astype(np.uint64) + np.uint64(1)
    base, step = _BASE, 1
    with np.errstate(over="ignore"):
        while step < width:  # a run of 2n is a run of n, shifted, and the next run of n
            h = h[:-step] * base + h[step:]
            base, step = base * base, step * 2
        h ^= h >> np.uint64(32)
        h *= _MIX
    return (h >> np.uint64(32)).astype(np.uint32)


def sketch(data: bytes, fraction: int = FRACTION, least: int = LEAST) -> np.ndarray:
    """Its limit (the sketch is complete up to it), then the hashes in order."""
    h, limit = shingle_hashes(data), _FULL // fraction
    own = np.unique(h[h <= limit])
    if len(own) < least:
        every = np.unique(h)
        own = every[:least]
        limit = _FULL if len(every) <= least else max(limit, int(own[-1]))
    return np.concatenate([np.array([limit], np.uint32), own])


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of two parts together (shingles across their border aside)."""
    limit = min(a[0], b[0])
    both = np.union1d(a[1:], b[1:])
    return np.concatenate([np.array([limit], np.uint32), both[both <= limit]])


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the smaller text's shingles that the larger one has."""
    limit = min(a[0], b[0])
    x, y = a[1 : 1 + np.searchsorted(a[1:], limit, "right")], b[1 : 1 + np.searchsorted(b[1:], limit, "right")]
    small = min(len(x), len(y))
    if not small:
        return float(np.array_equal(a, b))
    return len(np.intersect1d(x, y, assume_unique=True)) / small


def to_text(s: np.ndarray) -> str:
    return base64.b64encode(s.astype("<u4").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), "<u4")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the start of ``following``."""
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(first_text: str):
    def rows(batches: Iterator[pa.RecordBatch]):
        """(part, ahead, doc_id, text), with the text that follows in the part's order."""
        held = None
        for batch in slices(batches, "text"):
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "ahead", "doc_id", "text"))):
                if held and not held[1]:
                    yield held, row[3] or "" if row[0] == held[0] else first_text
                held = row
        if held and not held[1]:
            yield held, first_text

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, known = [], (None, None)
        for (_, _, doc, text), following in rows(batches):
            text = text or ""
            own = known[1] if known[0] == text else sketch(text.encode())
            after, changed = sketch(following.encode()), edited(text, following)
            other = sketch(data := changed.encode())
            known = (following, after)
            out.append((doc, len(text), hashlib.sha256(data).hexdigest(), to_text(own), to_text(other), containment(own, other), containment(own, after)))
            if len(out) == 2000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return compare


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [f.split()[0] for f in OUT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        prints = [to_text(sketch((t or "").encode())) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every document; no shuffle."""
    return _plain(docs).mapInArrow(_fingerprints, "doc_id long, fingerprint string")


def edited_fingerprints(docs: DataFrame, target_bytes: int = 64 << 20) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The next document in id order comes from one shuffle into ranges of ids: the first document of a range
    also goes to the range before it, so no window runs over the whole table."""
    rows = _plain(docs)
    ranges = OrderedRanges(rows, "doc_id", target_bytes).snap(rows)
    first = rows.orderBy(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text")).select("text").first()
    numbered = rows.withColumn("number", ranges.number())
    previous = _shifted(ranges).number()
    places = F.array(F.struct(F.col("number").alias("part"), F.lit(0).alias("ahead")))
    both = F.array(F.struct(F.col("number").alias("part"), F.lit(0).alias("ahead")), F.struct((F.col("number") - 1).alias("part"), F.lit(1).alias("ahead")))
    is_first = (F.col("number") > 0) & (previous < F.col("number"))
    dealt = numbered.withColumn("place", F.explode(F.when(is_first, both).otherwise(places))).select("place.part", "place.ahead", "doc_id", "text")
    ordered = ranges.deal(dealt).sortWithinPartitions("part", "ahead", F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    return ordered.mapInArrow(_compare((first["text"] if first else None) or ""), OUT)


def _shifted(ranges: OrderedRanges) -> OrderedRanges:
    """The same ranges, moved up by one id: a row is in a lower one of these exactly if it is the first of its range."""
    moved = object.__new__(OrderedRanges)
    moved.key, moved.count, moved.bounds = ranges.key, ranges.count, [b + 1 for b in ranges.bounds]
    return moved
