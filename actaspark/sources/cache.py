"""What is read from files again and again, kept as Parquet: a lookup is made anew for files that changed, and for them alone.

The index holds path, length and time of change of every source file as it was read, and under which slot its rows are.
A refresh compares it with the folder, reads files that are new or differ, and publishes a new index; rows of files that
changed or went away are no longer in it. A refresh that finds nothing writes nothing."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Files

STATE = ["path", "length", "changed"]


def listed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, length, changed) of the files below a folder; their contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_modification_time").alias("changed"))


def newest(files: DataFrame, kind: str = r"([^/]*?)[-_.]?\d*\.\w+$") -> DataFrame:
    """(kind, path): of the files of each kind the one that changed last; of equal times the last by path."""
    rows = files.select(F.regexp_extract("path", kind, 1).alias("kind"), "path", "changed")
    return rows.groupBy("kind").agg(F.max_by("path", F.struct("changed", "path")).alias("path"))


class LookupCache:
    """``read`` takes paths and gives a file-backed table; ``parse`` makes the lookup of it and keeps ``_source``."""

    def __init__(self, spark: SparkSession, path: str, read: Callable[[list[str]], DataFrame], parse: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.read_files, self.parse = spark, path.rstrip("/"), read, parse
        self.files = Files(spark, path)

    def _newest(self) -> tuple[int, dict | None]:
        versions = [int(n.removesuffix(".json")) for n in self.files.names("versions") if n[0] != "."]
        return (max(versions), json.loads(self.files.read(f"versions/{max(versions)}.json"))) if versions else (0, None)

    def refresh(self, folder: str, pattern: str = "*") -> list[str]:
        """The paths that were read, in order."""
        now = listed(self.spark, folder, pattern)
        version, known = self._newest()
        if known:
            old = self.spark.read.parquet(f"{self.path}/{known['index']}")
            stale = [r["path"] for r in now.join(old, STATE, "left_anti").select("path").collect()]
            kept = old.join(now, STATE, "left_semi")
            if not stale and kept.count() == old.count():
                return []
        else:
            stale, kept = [r["path"] for r in now.select("path").collect()], None
        slot, index = f"rows/{uuid.uuid4().hex}", f"index/{uuid.uuid4().hex}"
        if stale:
            rows = self.parse(self.read_files(sorted(stale)).withColumn("_source", F.col("_metadata.file_path")))
            rows.write.parquet(f"{self.path}/{slot}")
        fresh = now.filter(F.col("path").isin(stale)).withColumn("slot", F.lit(slot))
        (kept.unionByName(fresh) if kept is not None else fresh).write.parquet(f"{self.path}/{index}")
        slots = sorted({*(known["slots"] if known else []), *([slot] if stale else [])})
        if not self.files.create(f"versions/{version + 1}.json", json.dumps({"index": index, "slots": slots})):
            return self.refresh(folder, pattern)
        return sorted(stale)

    def table(self) -> DataFrame:
        """The lookup as of the last refresh."""
        _, known = self._newest()
        if not known or not known["slots"]:
            raise ValueError("the cache has never been filled")
        index = self.spark.read.parquet(f"{self.path}/{known['index']}").select(F.col("path").alias("_source"), "slot")
        parts = [self.spark.read.parquet(f"{self.path}/{slot}").withColumn("slot", F.lit(slot)) for slot in known["slots"]]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows.join(index, ["_source", "slot"], "left_semi").drop("slot")
