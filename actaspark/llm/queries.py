"""The driver's queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The toxicity model is fitted on a sample of about so many labelled rows; they are small enough to broadcast.
MAX_LABELLED = 40_000


def op1_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds 1 to 3 are counted, fold 4 calibrates, fold 0 is held out; a document of one text and several
    labels counts with each. Beyond MAX_LABELLED labelled rows a sample by hash is learned from; every text
    is scored."""
    from .common import fold
    from .toxicity import learn, score

    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("int").alias("label")).filter("label is not null")
    labels = labels.filter((fold() != 0) & F.col("label").isin(0, 1))
    share = min(1.0, MAX_LABELLED / max(1, labels.count()))
    labels = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(share * 1_000_003) + 1)
    seen = docs.filter(fold() != 0).join(F.broadcast(labels), "doc_id")
    model = learn(seen, fold() == 4)
    scored = score(docs.withColumn("held_out", fold() == 0), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"))


def op2_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import fold
    from .langid import label, learn

    docs = table(spark, sf_dir, "documents")
    model = learn(docs.filter(fold() != 0).select("text", "lang"))
    labelled = label(docs.select("doc_id", (fold() == 0).alias("held_out"), "text"), model, ["doc_id", "held_out"])
    return labelled.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op3_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_ledger import secret_digests

    return secret_digests(table(spark, sf_dir, "documents"))


def op4_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_planes import plane_digests

    return plane_digests(table(spark, sf_dir, "documents"), tokenizer_file()).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_groups

    return near_groups(table(spark, sf_dir, "documents"), width=4).select("doc_id", "n_shingles", "component_id", "kept")


def op8_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op5_simhash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import line_groups

    return line_groups(table(spark, sf_dir, "documents"), exact=True)


def op6_png_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import text_picture_features

    found = text_picture_features(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.lower(F.hex("cosine_hash")).alias("feature"))


def op9_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "epochs")


def op10_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sketches import edited_fingerprints

    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .extraction import extract, learn

    pages = table(spark, sf_dir, "pages")
    return extract(pages, learn(pages))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import trie

    return trie(table(spark, sf_dir, "conversations"))


def op13_subspace_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whitened

    return whitened(table(spark, sf_dir, "embeddings"))


QUERIES = (
    op1_toxic_segments,
    op2_crf_language,
    op3_blob_ledger,
    op4_token_planes,
    op5_simhash_lines,
    op6_png_media,
    op7_bbit_minhash,
    op8_power_of_two_packing,
    op9_weighted_mix,
    op10_scaled_sketch,
    op11_crf_main_text,
    op12_prefix_trie,
    op13_subspace_whitening,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {}
