"""Administrators of listed names: the dictionary look-up near key words, lawyers by pattern where it finds nobody, and the merge with
administrators found by pattern.

Windows of text around key words are numbered; only (document, window, word) meets the first words of the names' spellings, and
a window's text is looked at again for what met. No document is compared with every name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaspark.functions import unicode

from .entities import _LAWYER, PARTICLES, ROLE_RANK

#: Words near which a listed name is an administrator; the appeal court's texts go without the last.
KEYWORDS = ("avocate", "avocat", "Maître", "bureaux", "cabinet", "curateur", "liquidateur")
_WORD = r"[^\s,;:()\[\]{}]+"


def canonical(c: Column) -> Column:
    """Lower case, without accents, points and apostrophes."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(unicode.without_marks(c, compatible=True)), "['.]", ""), r"\s+", " "))


def spellings(name: Column) -> Column:
    """The canonical name, without particles, and with its first word last."""
    words = F.split(name, " ")
    bare = F.array_join(F.filter(words, lambda w: ~w.isin(*sorted(PARTICLES))), " ")
    turned = F.concat_ws(" ", F.array_join(F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), " "), words[0])
    return F.filter(F.array_distinct(F.array(name, bare, F.when(F.size(words) > 1, turned).otherwise(name))), lambda s: s != "")


def windows(c: Column, keyword: str, reach: int = 300) -> Column:
    """The text from ``reach`` characters before the start of each keyword to ``reach`` after it: the parts after a keyword by a look
    ahead, those before it by the same in the text turned round."""
    quoted = lambda w: "".join(f"\\{x}" if not (x.isalnum() or x.isspace()) else x for x in w)
    ahead = F.regexp_extract_all(c, F.lit(f"(?s)(?=({quoted(keyword)}.{{0,{max(0, reach - len(keyword))}}}))"), F.lit(1))
    behind = F.regexp_extract_all(F.reverse(c), F.lit(f"(?s)(?=({quoted(keyword[::-1])}.{{0,{reach}}}))"), F.lit(1))
    return F.zip_with(F.reverse(behind), ahead, lambda b, a: F.concat(F.reverse(b), F.substr(a, F.lit(len(keyword) + 1))))


def listed_near(df: DataFrame, key: str, text: str, names: DataFrame, keywords: tuple[str, ...] = KEYWORDS, reach: int = 300) -> DataFrame:
    """(key, nom): names of ``names`` (nom) one of whose spellings stands within ``reach`` characters of a keyword."""
    low = {w: w.lower().translate(str.maketrans("éèêîïâàôûùç", "eeeiiaaouuc")) for w in keywords}
    texts = df.select(key, canonical(F.col(text)).alias("_t"))
    numbered = texts.select(key, F.posexplode(F.flatten(F.array(*[windows(F.col("_t"), w, reach) for w in dict.fromkeys(low.values())]))).alias("_n", "_w"))
    words = numbered.select(key, "_n", F.explode(F.array_distinct(F.regexp_extract_all("_w", F.lit(_WORD), F.lit(0)))).alias("_first"))
    spelt = names.select("nom").distinct().select("nom", F.explode(spellings(canonical(F.col("nom")))).alias("_spelt"))
    spelt = spelt.withColumn("_first", F.regexp_extract("_spelt", _WORD, 0))
    met = words.join(spelt, "_first").select(key, "_n", "nom", "_spelt")
    return met.join(numbered, [key, "_n"]).filter(F.contains("_w", F.col("_spelt"))).select(key, "nom").distinct()


def lawyers(text: Column) -> Column:
    """Names of lawyers, chambers and provisional administrators by pattern, sorted."""
    spaced = F.trim(F.regexp_replace(F.regexp_replace(text, "[‐-―]", "-"), r"(?U)\s+", " "))
    found = F.flatten(F.array(*[F.regexp_extract_all(spaced, F.lit(rx.pattern), F.lit(1)) for rx in _LAWYER]))
    clean = F.transform(found, lambda n: F.btrim(F.regexp_replace(n, r"(?i)^(?:par\s+)?ma[îi]tre\s+", ""), F.lit(" ,.;:()[]{}—–-")))
    return F.coalesce(F.array_sort(F.array_distinct(clean)), F.array().cast("array<string>"))


def mandataries(df: DataFrame, key: str, text: str, names: DataFrame, keywords: tuple[str, ...] = KEYWORDS) -> DataFrame:
    """``df`` with ``mandataries``, an array of (nom, role): listed names, of unknown role; else lawyers by pattern."""
    found = listed_near(df.select(key, text).dropDuplicates([key]), key, text, names, keywords).groupBy(key).agg(F.array_sort(F.collect_set("nom")).alias("_listed"))
    named = lambda c, role: F.transform(c, lambda n: F.struct(n.alias("nom"), F.lit(role).alias("role")))
    return df.join(found, key, "left").withColumn("mandataries", F.coalesce(named(F.col("_listed"), "inconnu"), named(lawyers(F.col(text)), "regex-fallback"))).drop("_listed")


def _rank(role: Column) -> Column:
    out = F.lit(0)
    for name, rank in ROLE_RANK.items():
        out = F.when(role == name, rank).otherwise(out)
    return out


_BETWEEN = "\u0001"
_ENTRY = "array<struct<name:string,entity:string,role:string,raw:string,own:boolean,rank:int>>"


def merged(listed: Column, found: Column) -> Column:
    """One entry (entity, role, raw, origin, confidence) for each name of the array columns ``listed`` (nom, role) and ``found`` (role, entity,
    raw), by a fold over a document's few entries. A name that is a spelling of an earlier one is the same; a strictly higher role
    replaces name and role, the first of equals stays; confidence is 25 for each step of the role, and 75 more if the entry is
    the listed one."""
    entry = lambda entity, role, raw, own: F.struct(entity.alias("entity"), role.alias("role"), raw.alias("raw"), F.lit(own).alias("own"))
    items = F.concat(
        F.transform(listed, lambda m: entry(m["nom"], m["role"], m["nom"], True)),
        F.transform(found, lambda m: entry(m["entity"], F.regexp_replace(m["role"], r"\(s\)", ""), m["raw"], False)),
    )
    names = F.split(canonical(F.array_join(F.transform(items, lambda i: i["entity"]), _BETWEEN)), _BETWEEN)

    def known(i: Column, name: Column) -> Column:
        name = F.trim(name)
        same = F.when(i["own"], F.array(name)).otherwise(spellings(name))
        return F.struct(name.alias("name"), i["entity"].alias("entity"), i["role"].alias("role"), i["raw"].alias("raw"), i["own"].alias("own"), _rank(i["role"]).alias("rank"), same.alias("same"))

    def as_entry(x: Column, name: Column) -> Column:
        return F.struct(name.alias("name"), *[x[c].alias(c) for c in ("entity", "role", "raw", "own", "rank")])

    def step(kept: Column, x: Column) -> Column:
        at = F.get(F.filter(F.transform(kept, lambda k, i: F.when(F.array_contains(x["same"], k["name"]), i)), lambda i: i.isNotNull()), F.lit(0))
        higher = F.transform(kept, lambda k, i: F.when((i == at) & (x["rank"] > k["rank"]), as_entry(x, k["name"])).otherwise(k))
        return F.when(at.isNull(), F.concat(kept, F.array(as_entry(x, x["name"])))).otherwise(higher)

    folded = F.aggregate(F.zip_with(items, names, known), F.array().cast(_ENTRY), step)
    shown = lambda e: F.struct(e["entity"].alias("entity"), e["role"].alias("role"), e["raw"].alias("raw"), F.when(e["own"], "csv").otherwise("regex").alias("origin"), (e["rank"] * 25 + F.when(e["own"], 75).otherwise(0)).alias("confidence"))
    return F.transform(F.when(F.size(items) > 0, folded).otherwise(F.array().cast(_ENTRY)), shown)
