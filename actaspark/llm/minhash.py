"""Near-duplicates by b-bit MinHash.

A document's set is its distinct word shingles. Minima under ``bands * rows`` hash functions are taken of
every set; each band of ``rows`` minima is a bucket key, and of every minimum only ``BITS`` low bits are kept,
packed into bit planes; an odd sketch (parities of hash classes) bounds how much two sets differ. Documents that share a bucket are candidates; counting equal bits and taking out
chance agreement estimates their similarity, estimates well below the threshold are dropped, and the others
are confirmed on the full sets. Links make groups; a group is named by its least doc_id.

With 40 bands of 6, two sets at the threshold of 0.8 share no bucket with a probability of 6e-6, and the
estimate of such a pair falls below the cut (0.66, four and a half standard errors) with one of 4e-6. Equal sets are one
node from the start, so copies cost nothing however many there are; within a bucket, nodes are compared with
pivots and not all with all (``graph.linked_groups``).

Defined results: null text, empty text and text without words have an empty set and are linked with nothing
(component_id is their own id); rows that repeat a doc_id with one text are one document, and with different
texts each text is grouped by itself; a null doc_id is linked as any other but names no group; of a group the
document with the least doc_id is kept (nulls last; of one id with several texts, one by hash); ``one_of_each``
keeps one of equal texts without an id; very long texts are shingled whole; groups are made of doc_id and text alone, whatever
other columns are called, and ``one_of_each`` returns all of them; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_bytes, may_differ, odd_sketches, slices, stored
from .graph import linked_groups

BANDS, ROWS, BITS, ODD = 40, 6, 2, 1024
#: Ids of documents whose sets are read again; as many are broadcast (some MB), more are joined by a shuffle.
MAX_BROADCAST_IDS = 400_000
_P = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, width: int) -> np.ndarray:
    """64-bit hashes of the distinct runs of ``width`` words, in order; the whole text if it has fewer."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and split at ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    w = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
    n = len(w) - width + 1
    h = w[:n].copy()
    with np.errstate(over="ignore"):
        for i in range(1, width):
            h *= _P
            h += w[i : i + n]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return np.unique(h)


def node_of(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set: its node, and what tells apart sets with one node."""
    wide = xxhash.xxh3_128_digest(own.tobytes())
    return int.from_bytes(wide[:8], "little", signed=True), int.from_bytes(wide[8:], "little", signed=True)


class MinHasher:
    """``count`` minima of many sets at once."""

    def __init__(self, count: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 32, count, np.uint64) | np.uint64(1)).astype(np.uint32)
        self.b = rng.integers(0, 1 << 32, count, np.uint64).astype(np.uint32)

    def minima(self, sets: list[np.ndarray], chunk: int = 1 << 16) -> np.ndarray:
        """(sets, count); every set must have an element."""
        out = np.empty((len(sets), len(self.a)), np.uint32)
        sizes = np.array([len(s) for s in sets])
        first = 0
        while first < len(sets):
            last = max(first + 1, first + int(np.searchsorted(np.cumsum(sizes[first:]), chunk, "right")))
            x = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
            starts = np.cumsum(sizes[first:last]) - sizes[first:last]
            v = np.empty_like(x)
            for k in range(len(self.a)):
                np.multiply(x, self.a[k], out=v)
                np.add(v, self.b[k], out=v)
                out[first:last, k] = np.minimum.reduceat(v, starts)
            first = last
        return out


def band_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(sets, bands) 64-bit keys; the band's number is part of its key."""
    m = minima.reshape(len(minima), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), m.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = (key ^ m[:, :, r]) * _P
            key ^= key >> np.uint64(31)
    return key.view(np.int64)


def bit_planes(minima: np.ndarray, bits: int = BITS) -> np.ndarray:
    """(sets, bits * words) 64-bit words: one plane for each kept bit of all minima."""
    with np.errstate(over="ignore"):
        low = (minima * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
    words = -(-minima.shape[1] // 64)
    padded = np.zeros((len(minima), words * 64), np.uint32)
    padded[:, : minima.shape[1]] = low
    planes = [np.packbits((padded >> np.uint32(b)) & np.uint32(1), axis=1, bitorder="little").view("<i8") for b in range(bits)]
    return np.concatenate(planes, axis=1)


def estimate(a: Column, b: Column, count: int, bits: int = BITS) -> Column:
    """Similarity from two packed signatures: the share of equal minima, less what is equal by chance."""
    words = -(-count // 64)
    differ = F.lit(0)
    for w in range(words):
        unlike = F.lit(0).cast("long")
        for p in range(bits):
            unlike = unlike.bitwiseOR(a[p * words + w].bitwiseXOR(b[p * words + w]))
        differ = differ + F.bit_count(unlike)
    chance = 2.0**-bits
    return ((count - differ) / F.lit(float(count)) - chance) / (1 - chance)


def _signer(width: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(bands * rows)
        for batch in slices(batches, "text", 4 << 20):
            sets = [shingles(t, width) for t in batch.column("text").to_pylist()]
            some = [s for s in sets if len(s)]
            full = np.array([len(s) > 0 for s in sets])
            nodes, checks = zip(*(node_of(s) if len(s) else (None, None) for s in sets))
            minima = hasher.minima(some) if some else np.empty((0, bands * rows), np.uint32)
            keys, planes = band_keys(minima, bands, rows), bit_planes(minima)

            def listed(values: np.ndarray) -> pa.Array:
                offsets = np.zeros(len(sets) + 1, np.int32)
                np.cumsum(full * values.shape[1], out=offsets[1:])
                return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))

            odd = odd_sketches(np.concatenate(some), np.array([len(s) for s in some]), ODD) if some else np.empty((0, ODD // 64), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(nodes, pa.int64()), pa.array(checks, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), listed(keys), listed(planes), listed(odd)],
                names=["doc_id", "row", "node", "check", "n_shingles", "bands", "signature", "odd"],
            )

    return sign


def signatures(docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, row (hash of the text), node and check (hashes of the whole set; null if empty), n_shingles, bands, signature, odd (sketch). A scan; no shuffle."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("row"))
    return plain.mapInArrow(_signer(width, bands, rows), "doc_id long, row long, node long, check long, n_shingles long, bands array<long>, signature array<long>, odd array<long>")


def _set_reader(width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            sets = [shingles(t, width) for t in batch.column("text").to_pylist()]
            nodes, checks = zip(*(node_of(s) if len(s) else (None, None) for s in sets))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(checks, pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "check", "shingles"])

    return read


def _repeated(docs: DataFrame) -> bool:
    """Whether a doc_id stands in more than one row."""
    return not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, cut: float = 0.14) -> DataFrame:
    """Per document: doc_id, row (hash of its text), n_shingles, component_id, kept, node (equal for equal sets).

    Links: 100 * intersection >= ``percent`` * union of the full sets."""
    batch_bytes(docs.sparkSession)
    signed = stored(signatures(docs, width, bands, rows), "signatures")
    clashes = signed.groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).filter("lo <> hi")
    clashes = stored(clashes.select(F.col("node").alias("clash")), "clashes")
    clash = not clashes.isEmpty()

    def apart(rows: DataFrame) -> DataFrame:
        """Different sets have different nodes, should 64 bits not tell them apart."""
        if not clash:
            return rows
        known = F.col("clash").isNotNull()
        return rows.join(clashes, F.col("node") == F.col("clash"), "left").withColumn("node", F.when(known, F.xxhash64("node", "check")).otherwise(F.col("node"))).drop("clash")

    signed = apart(signed)
    some = signed.filter("node is not null")
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    first = some.groupBy("node").agg(F.min(own).alias("first")).select("node", "first", F.col("first.doc_id").alias("doc_id"))
    at = first.select(F.col("node").alias("at"), F.col("first").alias("at_first"))
    nodes = some.join(at, (F.col("node") == F.col("at")) & (own == F.col("at_first")), "left_semi")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = nodes.select("node", F.explode("bands").alias("key")).repartition(n, "key")
    shared = members.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("key")
    buckets = stored(members.join(shared.hint("shuffle_hash"), "key", "left_semi").select("key", "node").distinct(), "buckets")

    candidates = buckets.select("node").distinct()
    known = stored(nodes.join(candidates, "node", "left_semi").select("node", "doc_id", "n_shingles", "signature", "odd").dropDuplicates(["node"]), "candidates")
    wanted = known.select(F.col("doc_id").alias("wanted_id")).distinct()
    wanted = F.broadcast(wanted) if known.count() <= MAX_BROADCAST_IDS else wanted
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    # a repeated doc_id brings its text more than once, or a text whose set isn't wanted
    read = texts.mapInArrow(_set_reader(width), "node long, check long, shingles array<long>").filter("node is not null")
    read = apart(read).drop("check")
    sets = stored(read.join(known.select("node"), "node", "left_semi").dropDuplicates(["node"]) if _repeated(docs) else read, "sets")

    def likely(x: str, y: str) -> Column:
        na, nb = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
        near = estimate(F.col(f"{x}.signature"), F.col(f"{y}.signature"), bands * rows) >= percent / 100 - cut
        return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & near

    def sure(x: str, y: str) -> Column:
        both = F.col(f"{x}.n_shingles") + F.col(f"{y}.n_shingles")
        return likely(x, y) & may_differ(F.col(f"{x}.odd"), F.col(f"{y}.odd"), F.floor(both * (100 - percent) / (100 + percent)), ODD)

    def confirm(pairs: DataFrame) -> DataFrame:
        x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xa"))
        y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("xb"))
        common = F.size(F.array_intersect("xa", "xb"))
        return pairs.join(x, "a").join(y, "b").filter(100 * common >= percent * (F.size("xa") + F.size("xb") - common)).select("a", "b")

    groups = linked_groups(buckets, known.select("node", "n_shingles", "signature"), likely, confirm, sharper=(known.select("node", "n_shingles", "signature", "odd"), sure))
    named = first.join(groups, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "first")
    least = named.groupBy("root").agg(F.min("first").alias("keeper"))
    by_node = named.join(least, "root").select("node", "keeper")
    out = signed.select("doc_id", "row", "n_shingles", "node").join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("keeper.doc_id"))
    kept = F.col("node").isNull() | (own == F.col("keeper"))
    return out.select("doc_id", "row", "n_shingles", component.alias("component_id"), "node", kept.alias("kept"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is kept; all columns stay as they are."""
    groups = stored(near_groups(docs, **options).select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row"), "kept", "node"), "groups")
    gone = groups.filter(~F.col("kept")).select("gone_id", "gone_row").distinct()
    gone = F.broadcast(gone) if gone.count() <= MAX_BROADCAST_IDS else gone
    row = F.xxhash64(docs["text"].cast("string"))
    left = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(F.col("gone_id")) & (row == F.col("gone_row")), "left_anti")
    # equal texts without an id are told apart by nothing; all but one of them go
    twice = groups.filter("gone_id is null and node is not null and kept").groupBy("gone_row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gone_row")
    if twice.isEmpty():
        return left
    copies = left.filter("doc_id is null").withColumn("gone_row", F.xxhash64(F.col("text").cast("string")))
    one = copies.join(twice, "gone_row", "left_semi").dropDuplicates(["gone_row"]).select(*(f"`{c}`" for c in docs.columns))
    rest = left.join(twice, left["doc_id"].isNull() & (F.xxhash64(left["text"].cast("string")) == twice["gone_row"]), "left_anti")
    return rest.unionByName(one)
