"""Addresses and struck-off names as expressions over the patterns of ``entities``: no text leaves the JVM.

Texts are used with single blanks; a look ahead captures what follows a mark without taking it, so marks within reach of each
other all count."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import entities


def _java(rx: re.Pattern | str) -> str:
    """The pattern for Spark: case-blind groups and classes know all letters there too."""
    source = rx if isinstance(rx, str) else rx.pattern
    flags = "(?iU)" if not isinstance(rx, str) and rx.flags & re.IGNORECASE else "(?U)"
    return flags + source.replace("(?i:", "(?iu:")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is evaluated once."""
    return F.transform(F.array(value), lambda x: then(x))[0]


def spaced(text: Column) -> Column:
    t = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), "​﻿", ""), "[‐-―]", "-")
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def _all(text: Column, rx, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(_java(rx)), F.lit(group))


def _first(text: Column, rx) -> Column:
    found = F.regexp_extract(text, _java(rx), 0)
    return F.when(found != "", found)


def struck_off_names(text: Column) -> Column:
    """Names in capitals right after an enterprise number, each once."""
    capital = r"[^\p{Ll}\s]*\p{Lu}[^\p{Ll}\s]*"
    rx = rf"N[°º]?\s*ent\.?\s*\d{{4}}\.\d{{3}}\.\d{{3}}(?=\s*((?:{capital}(?:\s+|$))*))"
    names = F.transform(_all(F.coalesce(text, F.lit("")), rx), lambda n: F.btrim(F.regexp_replace(n, r"(?U)\s+", " "), F.lit(" .,:;")))
    return F.array_distinct(F.filter(names, lambda n: n != ""))


def home_addresses(text: Column) -> Column:
    """Addresses of persons, of 3 to 15 words, sorted; one that is part of another is left out."""

    def found(t: Column) -> Column:
        living = F.filter(F.split(t, r"(?<=[a-z0-9])[.;]\s+"), lambda s: s.rlike(_java(entities._LIVES)))
        strict = F.flatten(F.array(*[_all(t, rx) for rx in entities.HOME_PATTERNS]))
        loose = F.flatten(F.transform(living, lambda s: F.flatten(F.array(*[_all(s, rx) for rx in entities.LOOSE_HOME_PATTERNS]))))
        every = F.transform(F.concat(strict, loose), lambda a: F.btrim(F.regexp_replace(a, r"(?iU)^à\s+(?=\d{4})", ""), F.lit(" ,.;")))
        return F.array_sort(F.array_distinct(F.filter(every, lambda a: F.size(F.split(a, " ")).between(3, 15))))

    def whole(good: Column) -> Column:
        return F.filter(good, lambda a: ~F.exists(good, lambda b: (a != b) & F.contains(b, a)))

    return let(let(spaced(text), found), whole)


def company_address(text: Column, streets: Column | None = None) -> Column:
    """The first company address: after a trigger and with the postcode first; or street first, if the text has a word of the
    array ``streets`` (any, without one); or, among known streets only, without a street word."""
    institutions = [a.upper() for a in sorted(entities.INSTITUTION_ADDRESSES)]

    def of(t: Column) -> Column:
        after = _all(t, f"(?:{entities._SEAT.pattern})(?=(.{{0,280}}))")
        seats = F.transform(after, lambda w: F.btrim(F.regexp_extract(w, _java(entities._POSTCODE_FIRST), 0), F.lit(" ,.;")))
        seat = F.get(F.filter(seats, lambda a: (a != "") & ~a.isin(*institutions)), F.lit(0))
        street = F.trim(_first(t, entities._STREET_FIRST))
        if streets is None:
            return F.coalesce(seat, street)
        known = F.coalesce(F.arrays_overlap(F.split(t, " "), streets), F.lit(False))
        bare = F.trim(_first(t, entities._NO_PREFIX))
        return F.coalesce(seat, F.when(known | (F.size(streets) == 0), street), F.when(known, bare))

    return let(F.upper(spaced(text)), of)
