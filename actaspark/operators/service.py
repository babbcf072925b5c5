"""What a front end asks of the decisions: guarded inputs, records as it shows them, and counts of what a run added."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .search import SearchSchema, contains_loosely, filters

#: Fixed value: how a VAT number is typed.
VAT_TYPED = r"^\d{4}\.\d{3}\.\d{3}$"


def checked(kind: str, query: str) -> str:
    """The query as it is sent: a VAT number in its written form, three characters at least for suggestions, ``=`` in front of
    a search in everything. What the form refuses is an error."""
    said = query.strip()
    if kind == "vat" and not re.match(VAT_TYPED, said, re.ASCII):
        raise ValueError("a number is typed as 0123.456.789")
    if kind == "suggest" and len(said) < 3:
        raise ValueError("three characters at least")
    if not said:
        raise ValueError("nothing to look for")
    return f"={said.lstrip('=')}" if kind == "global" else said


def keyword_ok(keyword: Column, most_chars: int = 100, most_words: int = 5) -> Column:
    """Whether a profile may keep a keyword: no more than so many characters and words; none is fine."""
    said = F.trim(F.coalesce(keyword, F.lit("")))
    words = F.when(said == "", 0).otherwise(F.size(F.split(said, r"(?U)\s+")))
    return (F.length(said) <= most_chars) & (words <= most_words)


def filterable(clauses: list, schema: SearchSchema, kinds: dict[str, str]) -> Column:
    """``search.filters``, for attributes that the schema lets filter."""
    for clause in clauses:
        for one in [clause] if isinstance(clause, str) else clause:
            if one.split(" ", 1)[0] not in schema.filterable:
                raise ValueError(f"{one.split(' ', 1)[0]} doesn't filter; {', '.join(schema.filterable)} do")
    return filters(clauses, kinds)


def displayed(df: DataFrame, schema: SearchSchema) -> DataFrame:
    """Only what the schema displays, in its order; what a table lacks is left out."""
    return df.select(*[c for c in schema.displayed if c in df.columns])


def api_record(df: DataFrame) -> DataFrame:
    """Records of the interface of (text, url, title, date_doc, extra_keyword, TVA): missing texts are empty, ``bce`` is the first number."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return df.select(
        blank("text"),
        blank("url"),
        blank("title"),
        F.coalesce(F.col("date_doc").cast("string"), F.lit("")).alias("date_document"),
        F.coalesce("extra_keyword", F.array().cast("array<string>")).alias("extra_keyword"),
        F.try_element_at("TVA", F.lit(1)).alias("bce"),
        F.col("TVA").alias("num_tva"),
        F.lit(None).cast("long").alias("societe_id"),
    )


def added(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """One row (n_before, n_created, n_total) of a run that took a table from ``before`` to ``after``, in keys; null is one."""
    both = before.select(key, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(after.select(key, F.lit(0).alias("b"), F.lit(1).alias("a")))
    each = both.groupBy(key).agg(F.max("b").alias("b"), F.max("a").alias("a"))
    return each.agg(F.count_if(F.col("b") == 1).alias("n_before"), F.count_if((F.col("b") == 0) & (F.col("a") == 1)).alias("n_created"), F.count_if(F.col("a") == 1).alias("n_total"))


def without_date(df: DataFrame, date: str = "date_doc") -> DataFrame:
    """Rows whose date is missing or blank."""
    return df.filter(F.trim(F.coalesce(F.col(date).cast("string"), F.lit(""))) == "")


def street_fallback(found: DataFrame, documents: DataFrame, street: str, tags: list[str] | None = None) -> DataFrame:
    """(id) of ``found``, and of documents (id, tags, text) that name the street and have one of ``tags`` but aren't found yet."""
    rows = documents.filter(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags]))) if tags else documents
    more = rows.filter(contains_loosely(F.col("text"), street)).select("id").distinct()
    return found.select("id").distinct().unionByName(more.join(found, "id", "left_anti"))
