"""Names of persons as Column expressions, and their nearness to addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import squash, unaccent

# Particles that a name may be looked up without.
PARTICLES = ("de", "du", "la", "le", "van", "von", "der")


def canonical(c: Column) -> Column:
    """Lower case, without accents, full stops and apostrophes."""
    return squash(F.translate(unaccent(F.lower(c)), ".'’", ""))


def turn_at_comma(c: Column) -> Column:
    """``Dupont, Jean`` as ``Jean Dupont``."""
    return F.when(c.rlike(r"^[^,]+,[^,]+$"), F.trim(F.regexp_replace(c, r"^\s*([^,]+?)\s*,\s*([^,]+?)\s*$", "$2 $1"))).otherwise(c)


def without_initials(c: Column) -> Column:
    """Without single letters that stand for a first name."""
    return squash(F.regexp_replace(c, r"(?U)(?<![\p{L}'\-])\p{L}\.?(?![\p{L}'\-.])", " "))


def without_title(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?iU)^(?:par\s+)?(?:ma[îi]tre|me|monsieur|madame|mme|mr|m\.)\s+", ""))


def spellings(c: Column) -> Column:
    """The canonical name, turned round, and without particles; each once."""
    words = F.split(canonical(c), " ")
    first = F.slice(words, 1, 1)
    turned = F.concat(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), first)
    bare = F.filter(words, lambda w: ~w.isin(*PARTICLES))
    return F.filter(F.array_distinct(F.transform(F.array(words, turned, bare), lambda a: F.array_join(a, " "))), lambda s: s != "")


def full_names(names: Column) -> Column:
    """Those of an array that have two words or more and no digit."""
    return F.filter(F.transform(names, squash), lambda n: (F.size(F.split(n, " ")) >= 2) & ~n.rlike(r"\d"))


def absorb_shorter(names: Column) -> Column:
    """Names in order, without those that are part of a later, longer one."""
    later = lambda n, i: F.exists(F.slice(names, i + 2, F.greatest(F.size(names) - i - 1, F.lit(0))), lambda m: F.contains(canonical(m), canonical(n)) & (canonical(m) != canonical(n)))
    return F.filter(names, lambda n, i: ~later(n, i))


def near_score(text: Column, at: Column, tokens: Column, reach: int = 220) -> Column:
    """struct(score, first): how often the tokens stand in the window around place ``at`` (0-based), and
    where the first of them does."""
    window = canonical(F.substring(text, F.greatest(at - reach, F.lit(0)) + 1, F.lit(2 * reach)))
    hits = F.transform(F.array_distinct(tokens), lambda t: F.size(F.split(window, F.concat(F.lit(r"\Q"), canonical(t), F.lit(r"\E")))) - 1)
    places = F.filter(F.transform(F.array_distinct(tokens), lambda t: F.call_function("locate", canonical(t), window) - 1), lambda p: p >= 0)
    return F.struct(F.aggregate(hits, F.lit(0), lambda a, x: a + x).alias("score"), F.array_min(places).alias("first"))


def address_fits(text: Column, address: Column, name: Column) -> Column:
    """Whether a word of the name stands near the address in the text; null where the address isn't in it."""
    at = F.call_function("locate", address, text) - 1
    return F.when(at >= 0, near_score(text, at, F.split(name, " "))["score"] > 0)
