"""The date of a judgment: an ordered cascade of phrases, each looked for in its own part of the text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from actaspark.functions import dates

_DAY = r"(\d{1,2}(?:er)?\s+\w+\s+\d{4})"
_COURT = r"\bcour\s+d\s*['’]?\s*appel(?:\s+de\s+[A-ZÉÈÂÊÎÔÛÇÀ-ÿ'\-]+)?"
_PUBLIC = r"arr[êe]t\s+rendu\s+à\s+l\s*['’]\s*audience\s+publique(?:\s+extraordinaire)?\s+du\s+"

# Seats of courts.
CITIES = ("Bruxelles", "Charleroi", "Mons", "Namur", "Liège", "Huy", "Tournai", "Neufchâteau", "Marche-en-Famenne", "Arlon", "Dinant", "Eupen", "Nivelles", "Verviers")

# Phrase, first and last character of the part that is looked at (negative: from the end).
HEADED = (
    (_COURT + r"[^.\n]{0,100}?\bpar\s+arr[êe]t\s+du\s+" + _DAY, 400),
    (_COURT + r"[^.\n]{0,100}?\barr[êe]t\s+du\s+" + _DAY, None),
    (_COURT + r"[^.\n]{0,120}?" + _PUBLIC + _DAY, 400),
    (r"\b" + _PUBLIC + _DAY, 400),
    (r"cour\s+d['’]appel\s+(?:de\s+[A-ZÉÈÊËÀÂÇÎÏÔÙÛÜA-Za-zà-ÿ'\-]+\s+)?.{0,50}?extrait\s+de\s+l['’]arr[êe]t\s+du\s+" + _DAY, 600),
    (r"extrait\s+de\s+l['’]arr[êe]t\s+du\s+" + _DAY, 600),
    (r"de\s+l['’]arr[êe]t(?:\s+(?:contradictoire|par\s+d[ée]faut))?\s+rendu\s+le\s+" + _DAY, 600),
    (r"division(?:\s+de)?\s+[A-ZÉÈÊËÀÂÇÎÏÔÙÛÜA-Za-zà-ÿ'\-]+.{0,60}?\b(?:le|du)\s+" + _DAY, None),
    (r"date\s+du\s+jugement\s*[:\-–]?\s*(.{0,30})", None),
    (r"par\s+ordonnance\s+prononc[ée]e?.{0,200}?en\s+date\s+du\s+" + _DAY, 500),
    (r"par\s+jugement\s+du\s+(\d{1,2}(?:er)?\s+\w+\s+\d{4}|\d{1,2}/\d{1,2}/\d{4})", 400),
    (r"(?:" + "|".join(CITIES) + r")\b[^a-zA-Z0-9]{1,5}le\s+" + _DAY + r"\.", -300),
    (JUDGED := r"par\s+jugement\s+du\s+(\d{1,2}[./-]\d{1,2}[./-]\d{4}|\d{1,2}(?:er)?\s+\w+\s+\d{4})", None),
    (FIRST := r"\ble\s+" + _DAY, 300),
    (r"par\s+jugement\s+rendu(?:\s+contradictoirement|\s+par\s+d[ée]faut|\s+en\s+dernier\s+ressort)?\s+le\s+" + _DAY, 800),
    (r"par\s+d[ée]cision\s+prononc[ée]e?\s+le\s+(\d{1,2}(?:er)?[\s/-]\w+[\s/-]\d{4})", None),
    (r"par\s+jugement\s+(?:rendu\s+)?(?:le|du)\s+" + _DAY, None),
    (r"par\s+ordonnance\s+(?:rendue|prononcée)\s+le\s+" + _DAY, None),
    (r"par\s+d[ée]cision\s+du\s+(\d{1,2}\s+\w+\s+\d{4})", None),
    (r"jugement\s+rendu\s+le\s+(\d{1,2}\s+\w+\s+\d{4})", None),
    (r"par\s+(?:son\s+)?ordonnance\s+du\s+" + _DAY, None),
)
#: Phrases of which only the first in the text counts, and only if the court is named in so many characters before it.
NAMED_BEFORE = {JUDGED: ("tribunal de première instance", 100), FIRST: ("tribunal de première instance", 150)}
#: Phrases that aren't of a judgment if a birth is told in so many characters before them.
NOT_AFTER_BIRTH = {FIRST: 30}
SURE, LIKELY = 0.9, 0.6


def clean(text: Column) -> Column:
    t = F.regexp_replace(F.translate(text, "\u00a0\u202f\u2009\u2007\u2002\u2003\u200b", "      "), r"\s+", " ")
    return F.regexp_replace(F.trim(t), r"\b1er\s+er\b", "1er")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is evaluated once, however often it is used."""
    return F.transform(F.array(value), lambda x: then(x))[0]


def _before(text: Column, place: Column, reach: int) -> Column:
    first = F.greatest(place - reach, F.lit(1))
    return F.substr(text, first, place - first)


def _hit(own: Column, phrase: str, rx: str) -> Column:
    if phrase not in NAMED_BEFORE:
        return own.rlike(rx)
    court, reach = NAMED_BEFORE[phrase]

    def named(place: Column) -> Column:
        good = (place > 0) & F.contains(F.lower(_before(own, place, reach)), F.lit(court))
        return good & ~_before(own, place, NOT_AFTER_BIRTH[phrase]).rlike(r"(?iU)\bn[ée]e?\b") if phrase in NOT_AFTER_BIRTH else good

    return let(F.regexp_instr(own, F.lit(rx)), named)


def _written(t: Column) -> Column:
    """What the first phrase of the cascade that matches has in the place of its date."""
    found = []
    for phrase, part in HEADED:
        own = t if part is None else F.substring(t, 1, part) if part > 0 else F.right(t, F.lit(-part))
        rx = "(?iUd)" + phrase
        found.append(F.when(_hit(own, phrase, rx), F.regexp_extract(own, rx, 1)))
    return F.coalesce(*found)


def _result(date: Column, confidence: float) -> Column:
    return F.when(date.isNotNull(), F.struct(date.alias("date"), F.lit("regex").alias("source"), F.lit(confidence).alias("confidence")))


def judgment_date(text: Column) -> Column:
    """struct(date, source, confidence), or null. The first phrase that matches decides; its text stands for
    the date where it can't be read as one. Without any, the first French date of the first 500 characters
    that is no date of birth, with less confidence."""
    plain = lambda c: F.regexp_replace(c, r"(?<=\d)er\b", "")
    read = lambda raw: F.coalesce(let(plain(raw), dates.french_date).cast("string"), let(raw, dates.to_date).cast("string"), raw)

    def of(t: Column) -> Column:
        head = F.regexp_replace(F.substring(t, 1, 500), rf"(?iU)\bn[ée]e?\s+le\s+\d{{1,2}}(?:er)?\s+(?:{dates.MONTH_RX})\s+\d{{4}}", " ")
        sure = let(_written(t), lambda raw: _result(read(raw), SURE))
        return F.coalesce(sure, let(let(plain(head), dates.french_date).cast("string"), lambda day: _result(day, LIKELY)))

    return let(clean(text), of)
