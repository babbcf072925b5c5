"""What the operators of this subpackage share: intermediate tables, batch slicing, ordered ranges."""

from __future__ import annotations

import ctypes
import gc
import math
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space separates words; everything else belongs to one.
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes that a Python worker turns at once.
SLICE_BYTES = 8 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share (``spark.checkpoint.dir``).

    Only where that setting is absent in local mode, as in tests, a temporary folder is made."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='actaspark-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends here,
    and a lost executor costs no recomputation of what stands above."""
    spark = df.sparkSession
    path = path or shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def forget(df: DataFrame) -> None:
    """Delete the files behind a table made by ``stored``."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
        drop_path(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Let the context's cleaner delete the shuffle files of plans that nothing refers to any more; it works on
    what garbage collection finds, which a driver with little to do runs too seldom for a loop of small jobs."""
    gc.collect()
    spark._jvm.System.gc()


def batch_bytes(spark: SparkSession, n: int = 4 << 20) -> None:
    """Bound the Arrow batches between the JVM and Python by bytes: whole texts differ too much for a number of rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", n)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``limit`` bytes in each; a longer single row stands alone.

    At the end the worker, which stays for other tasks, gives freed memory back."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        first = total = 0
        for row, size in enumerate(sizes.tolist()):
            if total and total + size > limit:
                yield batch.slice(first, row - first)
                first, total = row, 0
            total += size
        yield batch.slice(first)
    batch = None
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def odd_sketches(hashes: np.ndarray, sizes: np.ndarray, bits: int) -> np.ndarray:
    """(sets, bits / 64) 64-bit words of sets that stand one after the other: of each of ``bits`` classes of
    hashes, whether the set has an odd number of elements.

    Two sets (or bags) differ in at least as many elements as their sketches differ in bits."""
    out, ends = np.empty((len(sizes), bits // 64), np.int64), np.cumsum(sizes)
    for first in range(0, len(sizes), 1000):
        own = sizes[first : first + 1000]
        part = hashes[ends[first] - sizes[first] : ends[first + len(own) - 1]]
        at = np.repeat(np.arange(len(own)), own) * bits + (part % np.uint64(bits)).astype(np.int64)
        odd = (np.bincount(at, minlength=len(own) * bits) & 1).astype(np.uint8).reshape(len(own), bits)
        out[first : first + 1000] = np.packbits(odd, axis=1, bitorder="little").view("<i8")
    return out


def may_differ(a: Column, b: Column, most: Column, bits: int, deviations: float = 5) -> Column:
    """Whether two sets may differ in at most ``most`` elements: their odd sketches then differ in no more bits, and
    in no more than are expected of so many elements and five standard deviations (or as many as are asked for)."""
    differ = sum((F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(bits // 64)), F.lit(0))
    share = (1 - F.pow(F.lit(1 - 2 / bits), most)) / 2
    return differ <= F.when(most <= bits // 4, most).otherwise(F.least(most, bits * share + deviations * F.sqrt(bits * share * (1 - share))))


def text_of(column: str = "text") -> Column:
    """Null counts as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id falls into fold 1 (never held out)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)), F.lit(1)).cast("int")


def partitions_for(spark: SparkSession, n_bytes: int, target: int) -> int:
    """As many partitions as ``n_bytes`` need at ``target`` bytes each, and no fewer than the session deals."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / target))


class OrderedRanges:
    """Ranges of an integer id that hold about equally many rows, found without a global sort.

    ``bounds`` are the smallest ids of ranges 1, 2, ... (range 0 also takes nulls); there are as many
    as there are partitions, and they are all that the driver receives."""

    def __init__(self, df: DataFrame, key: str, target_bytes: int, text: str = "text", least_bytes: int = 1):
        spark = df.sparkSession
        n_rows, n_bytes = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text_of(text))), F.lit(0))).first()
        few = math.ceil(n_bytes / least_bytes)  # ranges of at least so many bytes, unless target_bytes asks for more ranges
        self.key, self.count = key, max(1, min(n_rows, partitions_for(spark, n_bytes, target_bytes), max(few, math.ceil(n_bytes / target_bytes))))
        cuts = [i / self.count for i in range(1, self.count)]
        found = df.agg(F.percentile_approx(key, cuts, max(10_000, 20 * self.count))).first()[0] if cuts else None
        self.bounds = sorted({int(x) for x in found or []})

    def number(self) -> Column:
        """The range of a row: two short searches, so the cost is the square root of the number of ranges."""
        step = max(1, math.isqrt(len(self.bounds)))
        if not self.bounds:
            return F.lit(0)
        groups = [self.bounds[i : i + step] for i in range(0, len(self.bounds), step)]
        key = F.col(self.key).cast("long")

        def below(values: Column) -> Column:
            return F.size(F.filter(values, lambda b: b <= key))

        heads = F.array(*[F.lit(g[0]) for g in groups])
        fine = F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups])
        group = below(heads)
        return F.when(key.isNull() | (group == 0), F.lit(0)).otherwise((group - 1) * step + below(F.try_element_at(fine, group)))

    def snap(self, df: DataFrame) -> OrderedRanges:
        """Move every bound to the smallest id that its range really has (quantiles of large ids are rounded)."""
        found = df.filter(F.col(self.key).isNotNull()).groupBy(self.number().alias("n")).agg(F.min(self.key).alias("first")).filter("n > 0").collect()
        self.bounds = sorted(r["first"] for r in found)
        return self

    def deal(self, df: DataFrame, column: str = "part") -> DataFrame:
        """One partition for each range, sorted by range and id; ``df`` has the range in ``column``."""
        return df.repartitionById(len(self.bounds) + 1, F.col(column).cast("int"))
