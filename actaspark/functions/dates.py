"""French dates as Column expressions. Nothing here reads the clock: ``as_of`` is always given."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names without accents, number words of durations.
MONTHS = ("janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre")
NUMBER_WORDS = ("un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf", "dix", "onze", "douze", "treize", "quatorze", "quinze")
MONTH_RX = "janvier|f[ée]vrier|mars|avril|mai|juin|juillet|ao[uû]t|septembre|octobre|novembre|d[ée]cembre"
FRENCH_DATE = rf"(?iU)\b(\d{{1,2}})(?:\s*er)?\s+({MONTH_RX})\s+(\d{{4}})\b"
_ISO = r"^\d{4}-\d{2}-\d{2}$"


def plain(c: Column) -> Column:
    """Lower case without the accents that month names have."""
    return F.translate(F.lower(c), "éèêûôà", "eeeuoa")


def month_number(name: Column) -> Column:
    return F.element_at(F.create_map(*[x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(i))]), plain(name))


# Fixed value: a spelling that is read though two letters are wrong.
_SEEN = {"octber": 10}


def _deletions(word: str) -> set[str]:
    return {word[:k] + word[k + 1 :] for k in range(len(word))}


def _month_tables() -> tuple[dict[str, int], dict[str, int]]:
    """Beginnings of at least three letters that fit one month, and whole names; and the strings that names become by a deletion,
    which words with one wrong, missing, added or moved letter share. Names of up to four letters only bear an added
    letter, and ``mai`` bears none: too many other words are as near. What fits two months is left out."""
    short: dict[str, set[int]] = {}
    near: dict[str, set[int]] = {}
    for i, name in enumerate(MONTHS, 1):
        for n in range(3, len(name)):
            short.setdefault(name[:n], set()).add(i)
        for part in ({name} | _deletions(name)) if len(name) > 4 else {name} if len(name) == 4 else ():
            near.setdefault(part, set()).add(i)
    one = lambda table: {k: min(v) for k, v in table.items() if len(v) == 1}
    return one(short) | {name: i for i, name in enumerate(MONTHS, 1)} | _SEEN, one(near)


_WRITTEN, _NEAR = _month_tables()


def misspelt_month(word: Column) -> Column:
    """The month of a name as scans have it: shortened, with other accents, a zero for an o, or one letter wrong, missing,
    added or moved; null of other words."""
    from actaspark.functions.text import unaccent

    w = F.translate(unaccent(F.lower(F.trim(word))), "0.", "o")
    table = lambda values: F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda k: F.concat(F.left(w, k - 1), F.substr(w, k + 1)))
    months = F.array_distinct(F.filter(F.transform(F.concat(F.array(w), cut), lambda x: F.element_at(table(_NEAR), x)), lambda m: m.isNotNull()))
    only = F.get(months, F.lit(0))
    name = month_name(only)
    letters = lambda c: F.array_sort(F.split(c, ""))
    one = (F.levenshtein(w, name) <= 1) | ((F.length(w) == F.length(name)) & (letters(w) == letters(name)))
    return F.coalesce(F.element_at(table(_WRITTEN), w), F.when((F.size(months) == 1) & one, only))


def scanned_date(c: Column) -> Column:
    """The first French date of a text whose month can be read, misspelt or not; null if it isn't in the calendar."""
    found = F.regexp_extract_all(c, F.lit(r"(?iU)\b\d{1,2}(?:\s*er)?\s+[\p{L}0]{3,12}\.?\s+\d{4}\b"), F.lit(0))

    def parts(said: Column) -> Column:
        words = F.split(F.regexp_replace(said, r"(?iU)^(\d{1,2})\s*er\b", "$1"), r"\s+")
        return F.struct(misspelt_month(words[1]).alias("m"), words[0].alias("d"), words[2].alias("y"))

    first = F.try_element_at(F.filter(F.transform(found, parts), lambda p: p["m"].isNotNull()), F.lit(1))
    return F.try_to_date(F.concat_ws("-", first["y"], F.lpad(first["m"].cast("string"), 2, "0"), F.lpad(first["d"], 2, "0")), "yyyy-MM-dd")


def doc_date(c: Column) -> Column:
    """struct(date, raw): an ISO day as a date; anything else as it is, blank as null."""
    day = F.when(c.rlike(_ISO), F.try_to_date(c, "yyyy-MM-dd"))
    return F.struct(day.alias("date"), F.when(day.isNull() & (c != ""), c).alias("raw"))


def date_list(c: Column) -> Column:
    """The texts of a list that aren't blank; of null none."""
    return F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda d: F.trim(d) != "")


def is_valid_date(c: Column) -> Column:
    """ISO form and a day of the calendar."""
    return F.coalesce(c.rlike(_ISO) & F.try_to_date(c, "yyyy-MM-dd").isNotNull(), F.lit(False))


def french_date(c: Column) -> Column:
    """The first French date of a text, or null."""
    day, month, year = (F.regexp_extract(c, FRENCH_DATE, i) for i in (1, 2, 3))
    text = F.concat_ws("-", year, F.lpad(month_number(month).cast("string"), 2, "0"), F.lpad(day, 2, "0"))
    return F.when(c.rlike(FRENCH_DATE), F.try_to_date(text, "yyyy-MM-dd"))


def to_date(c: Column, compat: bool = False) -> Column:
    """ISO, day first with / - or ., or a French date. ``compat`` leaves February and December unread,
    as a table without accents does; two-digit years are of 1969 to 2068."""
    t = F.trim(c)
    iso = F.when(t.rlike(_ISO), F.try_to_date(t, "yyyy-MM-dd"))
    parts = [F.regexp_extract(t, r"^(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{4}|\d{2})$", i) for i in (1, 2, 3)]
    short = F.try_to_number(parts[2], F.lit("9999")).cast("int")
    year = F.when(F.length(parts[2]) == 2, short + F.when(short >= 69, 1900).otherwise(2000)).otherwise(short)
    numeric = F.try_to_date(F.concat_ws("-", year.cast("string"), F.lpad(parts[1], 2, "0"), F.lpad(parts[0], 2, "0")), "yyyy-MM-dd")
    words = french_date(t)
    if compat:
        words = F.when(~F.lower(t).rlike("f[ée]vrier|d[ée]cembre|août"), words)
    return F.coalesce(iso, F.when(t.rlike(r"^\d{1,2}[/.\-]\d{1,2}[/.\-](\d{4}|\d{2})$"), numeric), words)


def number_of(c: Column) -> Column:
    """1 to 15 and 20, as digits or French words."""
    words = F.create_map(*[x for i, w in enumerate(NUMBER_WORDS, 1) for x in (F.lit(w), F.lit(i))], F.lit("une"), F.lit(1), F.lit("vingt"), F.lit(20))
    t = F.lower(F.trim(c))
    return F.coalesce(F.when(t.rlike(r"^\d{1,4}$"), t.cast("int")), F.element_at(words, t))


def month_name(n: Column) -> Column:
    return F.get(F.array(*[F.lit(m) for m in MONTHS]), n - 1)


def first_of_month_text(c: Column) -> Column:
    """``1er er`` and ``1er`` become ``1``."""
    return F.regexp_replace(F.regexp_replace(c, r"\b1\s*er\s+er\b", "1er"), r"\b1\s*er\b", "1")


def without_dates(c: Column) -> Column:
    """A text without dates, years and runs of seven or more digits."""
    for rx in (rf"(?iU)\b\d{{1,2}}(?:er)?\s+(?:{MONTH_RX})\s+\d{{4}}\b", r"\b\d{1,2}[/.\-]\d{1,2}[/.\-]\d{2,4}\b", r"\b\d{4}-\d{2}-\d{2}\b", r"\b(?:19|20)\d{2}\b", r"\d{7,}"):
        c = F.regexp_replace(c, rx, " ")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def _spoken(n: int) -> str:
    """1 to 99 in French words."""
    units = (*NUMBER_WORDS, "seize", "dix-sept", "dix-huit", "dix-neuf")
    if n < 20:
        return units[n - 1]
    tens = {2: "vingt", 3: "trente", 4: "quarante", 5: "cinquante", 6: "soixante"}
    ten, unit = divmod(n, 10)
    if ten in (7, 9):
        return f"{'soixante' if ten == 7 else 'quatre-vingt'}-{units[unit + 9]}"
    word = "quatre-vingt" if ten == 8 else tens[ten]
    return word if not unit else f"{word} et un" if unit == 1 and ten < 8 else f"{word}-{units[unit - 1]}"


_DAYS = {"premier": 1} | {_spoken(n): n for n in range(1, 32)}
_YEARS = {f"deux mille {_spoken(n)}": 2000 + n for n in range(1, 100)} | {"deux mille": 2000}


def spoken_date(c: Column) -> Column:
    """The first date written in words (``douze mars deux mille vingt-quatre``), or null. Longer number words
    are tried first, so a year is never taken for a day."""
    t = F.regexp_replace(F.regexp_replace(F.lower(c), r"\bdeux mil\b", "deux mille"), r"\s+", " ")
    words = lambda table: "|".join(sorted(table, key=len, reverse=True))
    rx = rf"(?U)\b({words(_DAYS)})\s+({MONTH_RX})\s+({words(_YEARS)})\b"
    table = lambda values: F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    day, month, year = (F.regexp_extract(t, rx, i) for i in (1, 2, 3))
    text = F.concat_ws("-", F.element_at(table(_YEARS), year).cast("string"), F.lpad(month_number(month).cast("string"), 2, "0"), F.lpad(F.element_at(table(_DAYS), day).cast("string"), 2, "0"))
    return F.when(t.rlike(rx), F.try_to_date(text, "yyyy-MM-dd"))
