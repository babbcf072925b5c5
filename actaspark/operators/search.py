"""Search over an inverted table, with a rank that is ours and documented.

Matches of a text query are ordered by the number of its words found, then by the sum of corrected letters,
then by the rank of the attribute that has them, then by id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaspark.functions import text


@dataclass(frozen=True)
class SearchSchema:
    """Searchable attributes in order of rank, filterable ones, displayed ones."""

    searchable: tuple[str, ...] = ("title", "text", "keyword", "extra_keyword", "TVA", "denoms_flat", "adresses_all_flat", "admins_flat")
    filterable: tuple[str, ...] = ("keyword", "extra_keyword", "TVA", "date_doc", "adresses_all_flat", "admins_detectes")
    displayed: tuple[str, ...] = ("id", "date_doc", "title", "keyword", "extra_keyword", "TVA", "text", "url")


def inverted(df: DataFrame, key: str, attributes: tuple[str, ...]) -> DataFrame:
    """(key, rank, word, pos) of all words of the attributes."""
    out = None
    for rank, a in enumerate(attributes):
        value = F.array_join(a, " ") if dict(df.dtypes)[a].startswith("array") else F.col(a)
        rows = df.select(key, F.lit(rank).alias("rank"), F.posexplode(text.words_of(value)).alias("pos", "word"))
        out = rows if out is None else out.unionByName(rows)
    return out


def typos_allowed(word: str) -> int:
    return 2 if len(word) >= 9 else 1 if len(word) >= 5 else 0


def search(index: DataFrame, key: str, query: str, limit: int = 20, typos: bool = False) -> DataFrame:
    """(key, n_words, n_typos, best_rank) of the best matches; ``=`` in front is dropped, as the interface's
    strict mode has no effect. Each query word is a filter on the word column, so nothing is joined."""
    wanted = list(dict.fromkeys(w for w in query.lstrip("=").lower().split() if w))
    hit, distance = F.lit(None).cast("string"), F.lit(0)
    for w in wanted:
        d = F.levenshtein("word", F.lit(w)) if typos and typos_allowed(w) else None
        good = (F.col("word") == w) if d is None else (F.abs(F.length("word") - len(w)) <= typos_allowed(w)) & (d <= typos_allowed(w))
        distance = F.when(hit.isNull() & good, F.lit(0) if d is None else d).otherwise(distance)
        hit = F.coalesce(hit, F.when(good, F.lit(w)))
    found = index.select(key, "rank", hit.alias("hit"), distance.alias("d")).filter("hit is not null")
    best = found.groupBy(key, "hit").agg(F.min("d").alias("d"), F.min("rank").alias("rank"))
    per = best.groupBy(key).agg(F.count(F.lit(1)).alias("n_words"), F.sum("d").alias("n_typos"), F.min("rank").alias("best_rank"))
    return per.orderBy(F.desc("n_words"), "n_typos", "best_rank", key).limit(limit)


def filters(clauses: list, kinds: dict[str, str]) -> Column:
    """A list is a conjunction, a list within it a disjunction, of ``attribute operator value`` texts with
    =, !=, >=, <=, > or <; on arrays = means containment."""

    def one(clause: str) -> Column:
        name, op, value = clause.split(" ", 2)
        value = value.strip('"')
        c = F.col(name)
        if kinds[name].startswith("array"):
            return F.array_contains(c, value) if op == "=" else ~F.array_contains(c, value)
        v = F.lit(value).cast(kinds[name])
        return {"=": c == v, "!=": c != v, ">=": c >= v, "<=": c <= v, ">": c > v, "<": c < v}[op]

    out = F.lit(True)
    for clause in clauses:
        part = F.lit(False)
        for c in [clause] if isinstance(clause, str) else clause:
            part = part | one(c)
        out = out & part
    return out


def contains_loosely(c: Column, query: str) -> Column:
    """Whether the query is in the text, whatever accents, case and spacing."""
    return F.contains(text.loose(c), text.loose(F.lit(query)))


def contains_undotted(c: Column, query: str) -> Column:
    return F.contains(text.without_dots(c), F.lit(query.replace(".", "").replace(" ", "")))


def facets(df: DataFrame, array: str, top: int = 30) -> DataFrame:
    """The most frequent elements of an array column; ties by name."""
    counts = df.select(F.explode(array).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "value").limit(top)


def autocomplete(df: DataFrame, column: str, prefix: str, limit: int = 7) -> DataFrame:
    """Distinct normalised names that start with the prefix; the least spelling of each is shown."""
    norm = text.loose(F.col(column))
    names = df.filter(norm.startswith(prefix.lower())).groupBy(norm.alias("name")).agg(F.min(column).alias("label"))
    return names.select("name", F.split("label", "-")[0].alias("label")).orderBy("name").limit(limit)


def top_then_filter(df: DataFrame, order: list[Column], limit: int, condition: Column, limit_first: bool = False) -> DataFrame:
    """The first ``limit`` rows that meet the condition. ``limit_first`` is the compatibility mode, in which
    matches beyond the first ``limit`` rows are lost."""
    if limit_first:
        return df.orderBy(*order).limit(limit).filter(condition)
    return df.filter(condition).orderBy(*order).limit(limit)
