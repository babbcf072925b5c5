"""Ranked search over stored postings: exact words, corrected words, the beginning of the last word, and how near they stand.

``build`` writes two tables. ``postings`` has a row for each (word, document, attribute) with the places of the word, coded as
differences; it is partitioned by the word's first character and sorted by word, so a query reads a few row groups of a few
folders. Documents are dealt out by id before their words are exploded, so words are grouped where they are and only texts
are shuffled; in the stored table a frequent word is spread over ranges of ids. ``vocabulary`` has each
distinct word with the strings that come from deleting up to two of its first seven characters. Two words within two edits share
such a string, whatever their length, so corrections are looked up by equality and the edit distance is only taken of
those candidates.

The rank of a document: query words found (more first), edits (fewer first), nearness, rank of the best attribute, id.
Nearness is the least number of further words in a stretch of one attribute that holds all query words that the document
has; it is null, and last, where no attribute has them all."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .search import inverted, typos_allowed

HEAD = 7
#: So many corrected words are named in the filter of the postings; if there are more, they are joined.
NAMED = 1000


def folder_of(word: Column) -> Column:
    """The partition of a word: its first letter or digit if it is an ASCII one."""
    first = F.left(word, F.lit(1))
    return F.when(first.rlike("^[a-z0-9]$"), first).otherwise(F.lit("_"))


def _without(c: Column, k: Column) -> Column:
    return F.concat(F.left(c, k - 1), F.substr(c, k + 1))


def deletions(word: Column) -> Column:
    """The word's head and all that is left of it after one and two deletions."""
    head = F.left(word, F.lit(HEAD))

    def once(c: Column) -> Column:
        return F.when(F.length(c) > 0, F.transform(F.sequence(F.lit(1), F.length(c)), lambda k: _without(c, k))).otherwise(F.array().cast("array<string>"))

    one = F.array_distinct(once(head))
    return F.array_distinct(F.concat(F.array(head), one, F.flatten(F.transform(one, once))))


def plain_deletions(word: str) -> set[str]:
    head = word[:HEAD]
    return {"".join(c for k, c in enumerate(head) if k not in gone) for n in (0, 1, 2) for gone in combinations(range(len(head)), n)}


def build(df: DataFrame, key: str, attributes: tuple[str, ...], path: str, partitions: int | None = None) -> None:
    """Write the postings and the vocabulary of ``attributes`` (in order of rank) below ``path``."""
    spark = df.sparkSession
    rows = df.select(key, *attributes).repartition(*([partitions] if partitions else []), key)
    words = inverted(rows, key, attributes)
    placed = words.groupBy(F.col(key).alias("id"), "rank", "word").agg(F.array_sort(F.collect_list("pos")).alias("p"))
    gaps = F.transform("p", lambda x, i: x - F.when(i > 0, F.get("p", i - 1)).otherwise(0))
    coded = placed.select("word", "id", "rank", gaps.alias("gaps"), folder_of(F.col("word")).alias("folder"))
    coded.repartitionByRange("folder", "word", "id").sortWithinPartitions("folder", "word", "id").write.partitionBy("folder").parquet(f"{path}/postings")
    distinct = spark.read.parquet(f"{path}/postings").select("word").distinct()
    cuts = distinct.select("word", F.explode(deletions(F.col("word"))).alias("cut")).withColumn("folder", folder_of(F.col("cut")))
    cuts.repartitionByRange("folder", "cut", "word").sortWithinPartitions("folder", "cut").write.partitionBy("folder").parquet(f"{path}/vocabulary")


def _folders(words: Iterable[str]) -> list[str]:
    """``folder_of`` on the driver."""
    return sorted({w[0] if w and w[0].isascii() and (w[0].isdigit() or w[0].islower()) else "_" for w in words})


def corrections(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame | None:
    """(q, word, d): other vocabulary words within the edits that each query word allows; None if none allows any."""
    long = [w for w in wanted if typos_allowed(w)]
    if not long:
        return None
    cuts = sorted(set().union(*map(plain_deletions, long)))
    candidates = spark.read.parquet(f"{path}/vocabulary").filter(F.col("folder").isin(_folders(cuts)) & F.col("cut").isin(cuts)).select("word").distinct()
    asked = F.array(*[F.struct(F.lit(w).alias("q"), F.lit(typos_allowed(w)).alias("most")) for w in long])
    pairs = candidates.select("word", F.explode(asked).alias("a")).select("word", "a.q", "a.most")
    near = pairs.filter(F.abs(F.length("word") - F.length("q")) <= F.col("most")).withColumn("d", F.levenshtein("word", "q"))
    return near.filter((F.col("d") > 0) & (F.col("d") <= F.col("most"))).select("q", "word", "d")


def matched(spark: SparkSession, path: str, wanted: list[str], typos: bool = True, prefix: bool = True) -> DataFrame:
    """(q, word, d, id, rank, gaps): postings of the query words; one word may serve several of them."""
    postings = spark.read.parquet(f"{path}/postings")
    columns = ["q", "word", "d", "id", "rank", "gaps"]
    parts, uses = [], {w: [(w, 0)] for w in wanted}
    other = corrections(spark, path, wanted) if typos else None
    if other is not None:
        listed = other.limit(NAMED + 1).collect()
        if len(listed) > NAMED:
            parts.append(postings.join(other.withColumn("folder", folder_of(F.col("word"))), ["folder", "word"]).select(*columns))
        else:
            for r in listed:
                uses.setdefault(r["word"], []).append((r["q"], r["d"]))
    served = F.create_map(*[x for w, own in uses.items() for x in (F.lit(w), F.array(*[F.struct(F.lit(q).alias("q"), F.lit(d).alias("d")) for q, d in own]))])
    named = postings.filter(F.col("folder").isin(_folders(uses)) & F.col("word").isin(list(uses)))
    parts.append(named.withColumn("u", F.explode(F.element_at(served, F.col("word")))).select("u.q", "word", "u.d", "id", "rank", "gaps"))
    if prefix:
        last = wanted[-1]
        begun = postings.filter(F.col("folder").isin(_folders([last])) & F.col("word").startswith(last) & (F.col("word") != last))
        parts.append(begun.withColumns({"q": F.lit(last), "d": F.lit(0)}).select(*columns))
    return reduce(DataFrame.unionByName, parts)


def nearness(hits: DataFrame, found: DataFrame, wanted: list[str]) -> DataFrame:
    """(id, proximity) of the documents of ``found`` (id, n_words) from their ``hits``: one pass over places in order, which
    knows the last place of every query word."""
    steps = hits.join(found.select("id", "n_words"), "id").select("id", "rank", "q", "word", "d", "n_words", F.posexplode("gaps").alias("k", "gap"))
    placed = steps.withColumn("pos", F.sum("gap").over(Window.partitionBy("id", "rank", "q", "word", "d").orderBy("k")))
    past = Window.partitionBy("id", "rank").orderBy("pos").rangeBetween(Window.unboundedPreceding, 0)
    lasts = F.array(*[F.max(F.when(F.col("q") == w, F.col("pos"))).over(past) for w in wanted])
    seen = placed.select("id", "n_words", "pos", F.filter(lasts, lambda x: x.isNotNull()).alias("lasts")).filter(F.size("lasts") == F.col("n_words"))
    return seen.groupBy("id").agg(F.min(F.greatest(F.col("pos") - F.array_min("lasts") + 1 - F.col("n_words"), F.lit(0))).alias("proximity"))


def search(spark: SparkSession, path: str, query: str, limit: int = 20, typos: bool = True, prefix: bool = True) -> DataFrame:
    """(id, n_words, n_typos, proximity, best_rank) of the best ``limit`` documents; a leading ``=`` is dropped."""
    wanted = list(dict.fromkeys(w for w in query.lstrip("=").lower().split() if w)) or [""]
    hits = matched(spark, path, wanted, typos, prefix and wanted != [""])
    best = hits.groupBy("id", "q").agg(F.min("d").alias("d"), F.min("rank").alias("rank"))
    per = best.groupBy("id").agg(F.count(F.lit(1)).alias("n_words"), F.sum("d").alias("n_typos"), F.min("rank").alias("best_rank"))
    # places are only decoded of documents that words and edits leave among the first
    worst = per.orderBy(F.desc("n_words"), "n_typos").limit(limit).agg(F.min(F.struct("n_words", (-F.col("n_typos")).alias("t"))).alias("c")).first()["c"]
    if worst is not None:
        per = per.filter((F.col("n_words") > worst["n_words"]) | ((F.col("n_words") == worst["n_words"]) & (F.col("n_typos") <= -worst["t"])))
    ranked = per.join(nearness(hits, per, wanted), "id", "left").select("id", "n_words", "n_typos", F.col("proximity").cast("long").alias("proximity"), "best_rank")
    return ranked.orderBy(F.desc("n_words"), "n_typos", F.asc_nulls_last("proximity"), "best_rank", "id").limit(limit)
