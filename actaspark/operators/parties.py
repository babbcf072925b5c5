"""Companies, administrators and persons as expressions over the pattern tables of ``entities``: matches are arrays, and what belongs
together is put together by a fold over a text's few matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from actaspark.functions import text as texts

from . import entities
from .addresses import _all, _java, let, spaced


def _latin_key(c: Column) -> Column:
    """``entities.canonical`` for the Latin letters that names of the patterns are made of."""
    return F.trim(F.regexp_replace(F.lower(texts.unaccent(F.regexp_replace(c, "['.]", ""))), r"(?U)\s+", " "))


def _folded(items: Column, kind: str, same: Callable[[Column, Column], Column], fresh: Callable[[Column], Column], joined: Callable[[Column, Column], Column]) -> Column:
    """Items into entries, in order: an item that is the ``same`` as an entry is ``joined`` to it, any other is a ``fresh`` one."""

    def step(kept: Column, x: Column) -> Column:
        there = F.exists(kept, lambda k: same(k, x))
        return F.when(there, F.transform(kept, lambda k: F.when(same(k, x), joined(k, x)).otherwise(k))).otherwise(F.concat(kept, F.array(fresh(x))))

    return F.aggregate(items, F.array().cast(f"array<{kind}>"), step)


def company_names(text: Column, most: int | None = 8000) -> Column:
    """Company names after a trigger, legal form last, each once; without any, the first name with a form in the first 300
    characters. ``most`` characters are read; None reads whole texts."""

    def form_last(name: Column) -> Column:
        def turned(form: Column) -> Column:
            rest = F.btrim(F.substr(name, F.length(form) + 1), F.lit(" -"))
            return F.when((form != "") & (rest != ""), F.concat(rest, F.lit(" "), form)).otherwise(name)

        return let(F.regexp_extract(name, rf"^(?:{entities._FORM})(?=[\s\-])", 0), turned)

    def of(t: Column) -> Column:
        found = F.flatten(F.array(*[_all(t, rx) for rx in entities._COMPANY]))
        head = F.substring(t, 1, 300)
        first = [F.when(head.rlike(_java(rx)), F.regexp_extract(head, _java(rx), 1)) for rx in entities._FALLBACK]
        back = F.filter(F.array(F.coalesce(*first)), lambda n: n.isNotNull())
        return F.when(F.size(found) > 0, found).otherwise(back)

    t = spaced(F.translate(text, "’", "'"))
    names = F.transform(let(F.substring(t, 1, most) if most else t, of), lambda n: form_last(F.btrim(n, F.lit(' .;,-()"'))))
    return F.array_distinct(F.filter(names, lambda n: F.length(n) > 1))


def _person_name(raw: Column) -> Column:
    """``entities.person_name``: two to four words before any street, titles and roles left out, or null."""
    before = F.split(raw, _java(entities._ADDRESS_CUT), 2)[0]
    words = F.transform(F.split(F.trim(before), r"(?U)\s+"), lambda w: F.regexp_replace(F.btrim(w, F.lit(" .,-:;")), r"\(s\)$", ""))
    titles = sorted(entities._TITLE_KEYS)
    named = F.slice(F.filter(words, lambda w: (w != "") & ~_latin_key(w).isin(*titles)), 1, 4)

    def good(name: Column) -> Column:
        bad = F.exists(name, lambda w: _latin_key(w).isin(*sorted(entities.INSTITUTION_WORDS)))
        proper = F.transform(name, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2)))))
        return F.when((F.size(name) >= 2) & ~bad, F.array_join(proper, " "))

    return let(named, good)


def administrators(text: Column) -> Column:
    """(role, entity, raw) of liquidators and curators: patterns in order, one entry for each name with its most specific role."""

    def matches(t: Column) -> Column:
        entry = lambda role, name, raw: F.struct(F.lit(role).alias("role"), name.alias("name"), raw.alias("raw"))
        of = lambda role: lambda name, raw: entry(role, name, raw)
        many = F.zip_with(_all(t, entities._MULTI, 0), _all(t, entities._MULTI, 1), lambda raw, body: F.transform(_all(body, entities._NUMBERED), lambda n: entry("liquidateur", n, raw)))
        by_rule = [F.zip_with(_all(t, rx, 1), _all(t, rx, 0), of(role)) for role, rx in entities.ADMIN_PATTERNS]
        listed = F.when(t.rlike(_java(entities._ARTICLE)), F.transform(_all(t, entities._PERSON), lambda n: entry("liquidateur", n, n)))
        every = F.concat(F.flatten(many), *by_rule, F.coalesce(listed, F.array().cast("array<struct<role:string,name:string,raw:string>>")))
        return F.filter(F.transform(every, known), lambda x: x["entity"].isNotNull())

    def known(x: Column) -> Column:
        return let(_person_name(x["name"]), lambda e: F.struct(x["role"].alias("role"), e.alias("entity"), F.trim(x["raw"]).alias("raw"), _latin_key(e).alias("key"), rank(x["role"]).alias("rank")))

    def rank(role: Column) -> Column:
        out = F.lit(0)
        for name, value in entities.CLEAN_RANK.items():
            out = F.when(role == name, value).otherwise(out)
        return out

    kept = _folded(let(spaced(text), matches), "struct<role:string,entity:string,raw:string,key:string,rank:int>", lambda k, x: k["key"] == x["key"], lambda x: x, lambda k, x: F.when(x["rank"] > k["rank"], x).otherwise(k))
    return F.transform(kept, lambda k: F.struct(k["role"].alias("role"), k["entity"].alias("entity"), k["raw"].alias("raw")))


def persons(text: Column) -> Column:
    """(label, canonical, aliases) of natural persons: surname first, at most six words and 80 characters, one entry for each name
    whatever its order and accents."""
    not_names = sorted(n for n in entities.NOT_NAMES)

    def matches(t: Column) -> Column:
        def of(label: str, first_first: bool) -> Callable[[Column, Column], Column]:
            def one(p: Column, n: Column) -> Column:
                first, last = F.trim(F.regexp_replace(p, r"(?U)[\s,]+", " ")), F.trim(n)
                name = F.concat(last, F.lit(" "), first)
                raw = F.concat(first, F.lit(" "), last) if first_first else name
                return F.struct(F.lit(label).alias("label"), name.alias("canonical"), raw.alias("raw"), F.array_sort(F.array_distinct(F.split(_latin_key(name), " "))).alias("key"))

            return one

        java = {label: rx.pattern.replace("(?P<", "(?<") for label, rx, _ in entities.PERSON_PATTERNS}
        groups = lambda rx, label: (_all(t, java[label], rx.groupindex[g]) for g in ("p", "n"))
        return F.concat(*[F.zip_with(*groups(rx, label), of(label, first_first)) for label, rx, first_first in entities.PERSON_PATTERNS])

    listed = F.array(*[F.lit(n) for n in not_names])
    good = F.filter(let(spaced(text), matches), lambda x: (F.length(x["canonical"]) <= 80) & (F.size(F.split(x["canonical"], " ")) <= 6) & ~F.arrays_overlap(F.transform(x["key"], lambda w: F.upper(w)), listed))

    def aliased(label: Column, name: Column, aliases: Column, key: Column, raw: Column) -> Column:
        more = F.when((raw != name) & ~F.array_contains(aliases, raw), F.concat(aliases, F.array(raw))).otherwise(aliases)
        return F.struct(label.alias("label"), name.alias("canonical"), more.alias("aliases"), key.alias("key"))

    none = F.array().cast("array<string>")
    kept = _folded(
        good,
        "struct<label:string,canonical:string,aliases:array<string>,key:array<string>>",
        lambda k, x: k["key"] == x["key"],
        lambda x: aliased(x["label"], x["canonical"], none, x["key"], x["raw"]),
        lambda k, x: aliased(k["label"], k["canonical"], k["aliases"], k["key"], x["raw"]),
    )
    return F.transform(kept, lambda k: F.struct(k["label"].alias("label"), k["canonical"].alias("canonical"), k["aliases"].alias("aliases")))
