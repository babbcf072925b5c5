"""Joins of documents with the registry: array lookups, name and address sets, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaspark.functions import ids, text


def array_lookup(df: DataFrame, key: str, array: str, dim: DataFrame, dim_key: str, value: Column, out: str) -> DataFrame:
    """(key, out): for each element of ``array``, in its order, ``value`` of the row of ``dim`` (null without).

    The array is exploded with positions, joined by hash (Spark broadcasts ``dim`` if it is small enough), and
    collected again; other columns stay out of the shuffle."""
    items = df.select(key, F.posexplode(array).alias("_pos", "_item"))
    found = items.join(dim.select(F.col(dim_key).alias("_item"), value.alias("_value")), "_item", "left")
    packed = F.array_sort(F.collect_list(F.struct("_pos", "_value")))
    return found.groupBy(key).agg(F.transform(packed, lambda x: x["_value"]).alias(out))


def sorted_sets(df: DataFrame, key: str, **values: Column) -> DataFrame:
    """Per key, the sorted distinct values of each expression."""
    return df.groupBy(key).agg(*[F.array_sort(F.collect_set(v)).alias(n) for n, v in values.items()])


def missing(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` that ``other`` doesn't know."""
    return df.join(other, on, "left_anti")


def link_audit(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """One row: how many rows of ``df`` are linked to ``other`` and how many are not."""
    known = other.select(key).distinct().withColumn("_known", F.lit(1))
    return df.join(known, key, "left").agg(F.count("_known").alias("linked"), F.count_if(F.col("_known").isNull()).alias("missing"))


def company_dimension(enterprise: DataFrame, denominations: DataFrame, addresses: DataFrame, establishments: DataFrame) -> DataFrame:
    """Per enterprise: bce, type, names, and addresses of the seat and of its establishments.

    Public entities keep out; names lose a trailing number in brackets; an establishment's address comes
    over two equi joins."""
    types = enterprise.select(ids.format_number(F.col("EnterpriseNumber")).alias("bce"), F.when(F.col("TypeOfEnterprise") == "1", "physique").otherwise("morale").alias("type"))
    names = denominations.select(ids.format_number(F.col("EntityNumber")).alias("bce"), text.denomination(F.col("Denomination")).alias("name")).filter("bce is not null").groupBy("bce").agg(F.array_sort(F.collect_set("name")).alias("names"))
    line = text.registry_address()
    seats = addresses.select(F.col("EntityNumber").alias("entity"), line.alias("address")).filter("address <> ''")
    own = seats.join(establishments.select(F.col("EstablishmentNumber").alias("entity")), "entity", "left_anti").select(ids.format_number(F.col("entity")).alias("bce"), "address", F.lit("siege").alias("source"))
    branches = establishments.join(seats, establishments["EstablishmentNumber"] == seats["entity"]).select(ids.format_number(F.col("EnterpriseNumber")).alias("bce"), "address", F.lit("etablissement").alias("source"))
    found = own.unionByName(branches).filter("bce is not null").groupBy("bce").agg(F.array_sort(F.collect_set(F.struct("address", "source"))).alias("addresses"))
    every = types.join(names, "bce", "full").join(found, "bce", "full")
    return every.filter(~ids.is_public_entity(F.col("bce"))).select("bce", F.coalesce("type", F.lit("inconnu")).alias("type"), "names", "addresses")


def enrich(decisions: DataFrame, companies: DataFrame) -> DataFrame:
    """Decisions (id, TVA, tags, ...) with ``denoms_by_bce`` and ``adresses_by_bce`` in the order of TVA.

    Decisions tagged as a cancelled duplicate get nulls, and so do those without a number."""
    wanted = decisions.filter(~F.array_contains(F.coalesce("tags", F.array().cast("array<string>")), "annulation_doublon"))
    items = wanted.select("id", F.posexplode("TVA").alias("pos", "raw")).withColumn("bce", ids.format_number(F.col("raw")))
    found = items.join(companies, "bce", "left")
    names = F.struct("pos", "bce", F.coalesce("type", F.lit("inconnu")).alias("type"), F.col("names").alias("noms"))
    places = F.struct("pos", "bce", F.col("addresses").alias("adresses"))
    grouped = found.groupBy("id").agg(
        F.array_sort(F.collect_list(F.when(F.size("names") > 0, names))).alias("denoms_by_bce"),
        F.array_sort(F.collect_list(F.when(F.size("addresses") > 0, places))).alias("adresses_by_bce"),
    )
    return decisions.join(grouped, "id", "left")


def near_names(df: DataFrame, key: str, column: str, keyword: str, names: DataFrame, reach: int = 300) -> DataFrame:
    """(key, name): names of ``names`` (name, lower case) that stand within ``reach`` characters of the keyword.

    The windows around the keyword are exploded, their words joined with each name's first word, and only what
    meets is searched for the whole name: never every document with every name."""
    low = F.lower(column)
    pieces = F.split(low, keyword)
    starts = F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), lambda i: F.length(F.array_join(F.slice(pieces, 1, i), keyword)))
    cut = lambda s: F.substring(low, F.greatest(s - reach, F.lit(0)) + 1, F.least(s, F.lit(reach)) + len(keyword) + reach)
    windows = df.filter(F.contains(low, F.lit(keyword))).select(key, F.explode(F.transform(starts, cut)).alias("window"))
    words = windows.select(key, "window", F.explode(F.array_distinct(F.regexp_extract_all("window", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))).alias("first_word"))
    wanted = names.select("name", F.split("name", " ")[0].alias("first_word"))
    return words.join(wanted, "first_word").filter(F.contains("window", F.col("name"))).select(key, "name").distinct()
