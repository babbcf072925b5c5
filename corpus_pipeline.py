"""From raw documents to training sequences: language, repeated lines, near-duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and hands the
table that it reads back to the next stage. All but the last return the columns of ``documents``.

Defined results for an empty table: no rows. Null texts have no language and leave at the first stage, and so do
empty ones. Repeated rows and ties: one stays (lines by first occurrence, documents by least doc_id); null ids are kept
apart by their texts. Very long texts are read whole in every stage. Further columns pass through, whatever their
names, up to the last stage, which has its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actaspark.llm import langid, line_dedup, minhash, mixing, packing
from actaspark.llm.common import fold, stored
from actaspark.llm.queries import tokenizer_file
from actaspark.plans.shipping import ship


#: Text bytes that a worker packs at once; executors still hold what earlier stages needed.
PACK_BATCH = 4 << 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    ship(spark)
    model = langid.learn(docs.filter(fold() != 0).select("text", "lang"))
    return langid.known_language(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of repeated or nearly repeated lines the first stays."""
    ship(spark)
    left = line_dedup.without_repeats(docs, exact=True)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    ship(spark)
    return minhash.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ship(spark)
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length."""
    ship(spark)
    return packing.pack(docs, tokenizer_file(), batch_size=PACK_BATCH)


STAGES = [
    ("language id", language_id),
    ("line dedup", line_dedup_stage),
    ("minhash near-dedup", minhash_dedup),
    ("source mix", source_mix),
    ("packing", packing_stage),
]

#: Models, hashes and token ids can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
