"""A table that takes merges: buckets of a key are rewritten beside the old ones, and a manifest says which of them count.

A merge reads the live buckets that its batch touches, folds old and new rows, writes those buckets to a folder of its
own and commits by creating the next manifest, which happens at once or not at all. Readers follow the newest manifest,
so they see the table before or after a merge, never half of one, and a reader that has begun keeps its files until
``vacuum``. A writer that loses the race for a manifest starts again from the newer one.

Every batch has a writer's name and a number; the manifest remembers the highest number of each writer, so a replayed batch
changes nothing, in whatever order the writers' batches come. A manifest is as long as the table has buckets and writers.
Renames must not replace files (HDFS's don't); a store without such a rename needs one writer at a time."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actaspark.operators.merge import insert_if_absent, patch, sticky_fold, upsert_last

from .files import Files

#: Old rows of the touched buckets and the batch to what they become together.
Fold = Callable[[DataFrame, DataFrame], DataFrame]
BUCKET = "_bucket"


class TableStore:
    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str], buckets: int = 16):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = spark.createDataFrame([], schema).schema
        self.files = Files(spark, path)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in self.key]), F.lit(self.buckets)).cast("int")

    def manifest(self) -> dict:
        """The newest: version, folders of each bucket, last batch of each writer."""
        versions = [int(n.removesuffix(".json")) for n in self.files.names("manifests") if n[0] != "."]
        return json.loads(self.files.read(f"manifests/{max(versions)}.json")) if versions else {"version": 0, "buckets": {}, "writers": {}}

    def _of(self, manifest: dict, wanted: set[int] | None = None) -> DataFrame:
        folders = [f"{self.path}/{f}/{BUCKET}={b}" for b, own in manifest["buckets"].items() if wanted is None or int(b) in wanted for f in own]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        return self._of(self.manifest())

    def _write(self, rows: DataFrame) -> tuple[str, list[int]]:
        """A folder with a sub-folder for each bucket, and the buckets that have rows."""
        folder = f"data/{uuid.uuid4().hex}"
        rows.select(*self.schema.names).withColumn(BUCKET, self._bucket()).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        return folder, [int(n.partition("=")[2]) for n in self.files.names(folder) if n.startswith(f"{BUCKET}=")]

    def merge(self, batch: DataFrame, fold: Fold | None, writer: str, number: int) -> bool:
        """Fold a batch in; False if it was there already. Without ``fold`` its rows are appended: nothing is rewritten."""
        while True:
            old = self.manifest()
            if number <= old["writers"].get(writer, -1):
                return False
            live = {int(b): own for b, own in old["buckets"].items()}
            if fold is None:
                folder, written = self._write(batch)
                live |= {b: [*live.get(b, []), folder] for b in written}
            else:
                touched = {r[0] for r in batch.select(self._bucket()).distinct().collect()}
                folder, written = self._write(fold(self._of(old, touched), batch.select(*self.schema.names)))
                live = {b: own for b, own in live.items() if b not in touched} | {b: [folder] for b in written}
            new = {"version": old["version"] + 1, "buckets": live, "writers": old["writers"] | {writer: number}}
            if self.files.create(f"manifests/{new['version']}.json", json.dumps(new)):
                return True
            self.files.delete(folder)

    def vacuum(self, keep: int = 2) -> None:
        """Drop what only manifests before the last ``keep`` use, and folders of merges that never ended; no merge may run."""
        versions = sorted((int(n.removesuffix(".json")) for n in self.files.names("manifests") if n[0] != "."), reverse=True)
        used = {f for v in versions[:keep] for own in json.loads(self.files.read(f"manifests/{v}.json"))["buckets"].values() for f in own}
        for v in versions[keep:]:
            self.files.delete(f"manifests/{v}.json")
        for name in self.files.names("data"):
            if f"data/{name}" not in used:
                self.files.delete(f"data/{name}")


def _both(old: DataFrame, new: DataFrame, seq: str, then: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Folds that a stored row can stand in for all it was made of: it comes before the batch's rows."""
    rows = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    return then(rows.withColumn("_seq", F.struct("_age", seq)))


def sticky(key: str, seq: str, **columns: str) -> Fold:
    """M2: see ``merge.sticky_fold``; ``columns`` names name, address, source, confidence and payload."""

    def fold(old: DataFrame, new: DataFrame) -> DataFrame:
        folded = _both(old, new, seq, lambda rows: sticky_fold(rows, key, "_seq", **columns).join(rows.groupBy(key).agg(F.max(seq).alias(seq)), key))
        return folded.select(*new.columns)

    return fold


def upsert(key: str, seq: str, overwrite: tuple[str, ...]) -> Fold:
    """M1: the first row of a key, with the ``overwrite`` columns of the last."""

    def fold(old: DataFrame, new: DataFrame) -> DataFrame:
        rows = _both(old, new, seq, lambda rows: upsert_last(rows.withColumn("_last", F.col(seq)).drop("_age", seq), key, "_seq", (*overwrite, "_last")))
        return rows.withColumnRenamed("_last", seq).select(*new.columns)

    return fold


def absent(key: list[str]) -> Fold:
    """M3: rows whose key isn't there yet."""
    return lambda old, new: old.unionByName(insert_if_absent(old, new, key))


def updated(key: str, columns: list[str]) -> Fold:
    """K8: non-empty values of ``columns`` for keys that are there, as nested ones read from JSON texts; other keys are left out."""
    return lambda old, new: patch(old, new.groupBy(key).agg(*[F.last(c, ignorenulls=True).alias(c) for c in columns]), key, columns)
