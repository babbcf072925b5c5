"""Secret scans through an incremental blob ledger.

Every version of a file is addressed by the sha256 of its content (its blob). The ledger is a table of
(blob, rule version, findings); a scan looks only at blobs that the ledger doesn't have for the rule version
in use, writes what it finds, and joins the findings back to every path and version that has the blob.
Rules carry a version, so a changed rule set scans every blob anew and leaves older findings as they are.

Only hashes are grouped and joined. A text is moved once, to the place of its path and version (not of its
blob: a third of all rows may share one), and scanned if that row stands for its blob. Findings, which few blobs
have, are joined back by blob and a salt of path and version, so a blob of many paths is dealt over several tasks.

Defined results: null text is empty and has no findings; null paths are joined null-safely; repeated rows
appear as often as they are given; a very long text is scanned whole; findings at one place are in the order of
their rules; columns of ``files`` other than path, version and text are left out, whatever their names; an empty
table gives no rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, slices, text_of

FINDINGS = "array<struct<kind:string,start:int,end:int>>"
#: Parts that the paths of one blob are dealt into; blobs with findings are repeated as often.
SALTS = 16
BASE_KINDS = ("assign", "access", "hex")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_HEX_HINT = re.compile(r"[0-9a-f]{8}")
_PEM = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z0-9 ]*PRIVATE KEY-----)?")
_GRANT = re.compile(r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})")
_CLAIMS = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")


def find_assign(text: str) -> Iterator[tuple[int, int]]:
    """A name of a secret with a value of at least 8 characters; a shorter value ends the match all the same."""
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        yield from (m.span() for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8)


def find_access(text: str) -> Iterator[tuple[int, int]]:
    if "AKIA" in text:
        yield from (m.span() for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16)


def find_hex(text: str) -> Iterator[tuple[int, int]]:
    """Runs of 32 or more; every fourth character of one makes a run of at least eight."""
    if _HEX_HINT.search(text[::4]):
        yield from (m.span() for m in _HEX.finditer(text))


def find_private_key(text: str) -> Iterator[tuple[int, int]]:
    if "-----BEGIN" in text:
        yield from (m.span() for m in _PEM.finditer(text))


def find_grant(text: str) -> Iterator[tuple[int, int]]:
    if "gh" in text and "_" in text or "xox" in text or "sk_live_" in text:
        yield from (m.span() for m in _GRANT.finditer(text))


def find_claims(text: str) -> Iterator[tuple[int, int]]:
    if "eyJ" in text:
        yield from (m.span() for m in _CLAIMS.finditer(text))


Finder = Callable[[str], Iterator[tuple[int, int]]]


@dataclass(frozen=True)
class Rules:
    """Named finders in the order that breaks ties of place; ``version`` names their meaning."""

    version: str = "1"
    finders: tuple[tuple[str, Finder], ...] = field(
        default=(("assign", find_assign), ("access", find_access), ("hex", find_hex), ("private_key", find_private_key), ("grant", find_grant), ("claims", find_claims))
    )

    def find(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) by start, then by kind; code points, end exclusive."""
        found = [(a, k, kind, b) for k, (kind, finder) in enumerate(self.finders) for a, b in finder(text)]
        return [(kind, a, b) for a, _, kind, b in sorted(found)]


def _scanner(rules: Rules):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in slices(batches, "text"):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in rules.find(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(found, kinds)], names=["blob", "findings"])

    return scan


class BlobLedger:
    """The ledger below ``path``, a folder of Parquet tables that grows with each scan."""

    def __init__(self, spark: SparkSession, path: str, rules: Rules = Rules()):
        self.spark, self.path, self.rules = spark, path, rules

    def table(self) -> DataFrame:
        """(blob, rule_version, findings) of all scans so far."""
        schema = f"blob binary, rule_version string, findings {FINDINGS}"
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def _known(self) -> DataFrame:
        return self.table().filter(F.col("rule_version") == self.rules.version)

    def unseen(self, versions: DataFrame) -> DataFrame:
        """Of each blob that was never scanned with these rules, the least (path, version) that has it."""
        first = versions.groupBy("blob").agg(F.min(F.struct("path", "version")).alias("at"))
        return first.join(self._known().select("blob"), "blob", "left_anti").select("blob", "at.path", "at.version")

    def scan(self, files: DataFrame) -> None:
        """Scan what is new in ``files`` (path, version, text) and add it to the ledger."""
        addressed = files.select("path", "version", blob_of("text").alias("blob"), text_of("text").alias("text"))
        wanted = self.unseen(addressed.drop("text")).hint("shuffle_hash")
        a, w = addressed.alias("a"), wanted.alias("w")
        same = F.col("a.path").eqNullSafe(F.col("w.path")) & F.col("a.version").eqNullSafe(F.col("w.version")) & (F.col("a.blob") == F.col("w.blob"))
        todo = a.join(w, same, "left_semi").select("a.blob", "a.text")
        found = todo.mapInArrow(_scanner(self.rules), f"blob binary, findings {FINDINGS}")
        found.select("blob", F.lit(self.rules.version).alias("rule_version"), "findings").write.mode("append").parquet(self.path)

    def findings(self, files: DataFrame) -> DataFrame:
        """``files`` (path, version, text) without their texts, with blob and findings; all blobs must have been scanned.

        A repeated row may have been scanned twice, so the ledger's rows of a blob count once."""
        known = self._known().filter(F.size("findings") > 0).dropDuplicates(["blob"])
        known = known.select("blob", "findings", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        salt = F.pmod(F.xxhash64("path", "version"), F.lit(SALTS)).cast("int")
        rows = files.select("path", "version", blob_of("text").alias("blob"), salt.alias("salt"))
        return rows.join(known, ["blob", "salt"], "left").select("path", "version", "blob", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings"))


def blob_of(column: str) -> Column:
    return F.unhex(F.sha2(text_of(column).cast("binary"), 256))


def spans_text(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def secret_digests(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """Documents as files of one version: doc_id, number of findings by base kind, base_sha256, spans, blob."""
    spark = docs.sparkSession
    files = docs.select(F.col("doc_id").cast("long").alias("path"), F.lit(0).alias("version"), F.col("text").cast("string").alias("text"))
    ledger = BlobLedger(spark, ledger_path or shared_dir(spark, "ledger"))
    ledger.scan(files)
    found = ledger.findings(files)
    f = F.col("findings")
    base = F.filter(f, lambda x: x["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter(f, lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        F.col("path").alias("doc_id"),
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(f).alias("spans"),
        F.lower(F.hex("blob")).alias("blob"),
    )
