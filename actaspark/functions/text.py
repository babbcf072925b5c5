"""Normalisation, hashing, URLs and addresses as Column expressions; the HTML walk as an Arrow function."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"

# Classes of company publications in the order that decides, and the phrases of each.
RUBRICS = {
    "CONSTITUTION": ["constitution", "nouvelle personne morale", "ouverture succursale"],
    "FIN": ["cessation", "annulation", "dissolution", "reorganisation", "réorganisation", "clôture", "fin"],
    "RADIATION": ["radiation"],
    "SIEGE": ["siège social", "siege social", "transfert siège"],
    "DEMISSION-NOMINATION": ["demission", "nomination"],
}
#: Characters that separate words in the search index; full stops and apostrophes don't.
SEPARATORS = r"""[\s_\-+,;:!?"()\[\]{}<>/\\|@#$%^&*=~`«»“”…–—]+"""


def squash(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def unaccent(c: Column) -> Column:
    """Letters of Western European languages without their accents; ligatures stay."""
    return F.translate(c, _ACCENTED, _PLAIN)


def loose(c: Column) -> Column:
    """For comparisons that ignore accents, case and spacing."""
    return squash(unaccent(F.lower(c)))


def without_dots(c: Column) -> Column:
    return F.translate(c, ". ", "")


def hash_text(c: Column) -> Column:
    """What counts of a text for its identity: no markup, no link block, no gazette address, lower-case words."""
    c = F.regexp_replace(c, r"(?is)<(script|style|font|span|mark)\b.*?</\1>", " ")
    c = F.regexp_replace(c, r"(?s)Liens\s*:.*?(?:Haut de la page|Copier le lien).*$", " ")
    c = F.regexp_replace(c, r"https?://\S*ejustice\S*", " ")
    c = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_\s]", " ")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def content_hash(date: Column, text: Column) -> Column:
    return F.sha2(F.concat(date, F.lit("::"), hash_text(text)), 256)


def is_erratum(text: Column) -> Column:
    head = F.lower(F.substring(text, 1, 400))
    return F.coalesce(head.rlike(r"(?U)\berrat(um|a)\b|ordonnance rectificative"), F.lit(False))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"<[^\n]*?>", "")


def plain_html(html: Column) -> Column:
    """Text of a page by expressions alone: no scripts and styles, tags as spaces, spaces squashed."""
    c = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<[^>]*>", " "), r"\s+", " "))


class _Walker(HTMLParser):
    """Texts of a page in order; a space stands between neighbouring texts, for <br>, and nowhere else."""

    def __init__(self, repeat_sup: bool):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden, self.before, self.repeat, self.sup = [], 0, "", repeat_sup, False

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        if tag == "br":
            self.out.append(" ")
            self.before = "br"
        else:
            self.sup = tag == "sup"
            self.before = tag

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data):
        text = data.strip()
        if not text or self.hidden:
            return
        if self.sup:
            self.out += [text, " ", text] if self.repeat else [text]
            self.sup = False
            self.before = "sup"
            return
        if self.before in ("font", "sup", "text"):
            self.out.append(" ")
        self.out.append(text)
        self.before = "text"


def page_text(html: str | None, repeat_sup: bool = False) -> str | None:
    """The page's text; ``repeat_sup`` gives raised text twice, as the compatibility mode wants."""
    if html is None:
        return None
    w = _Walker(repeat_sup)
    w.feed(html)
    w.close()
    text = "".join(w.out).replace("\xa0", " ").replace("​", "").replace("﻿", "")
    return re.sub(r"\s+", " ", text).strip()


@F.pandas_udf(StringType())
def html_text(html: pd.Series) -> pd.Series:
    return html.map(page_text)


@F.pandas_udf(StringType())
def html_text_compat(html: pd.Series) -> pd.Series:
    return html.map(lambda h: page_text(h, True))


def article_html(html: Column) -> Column:
    """The inside of a publication page's article element, or null without one: scripts hold no element, and the first
    end of the element counts."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")
    rx = r"""(?is)<main\b[^>]*\bclass\s*=\s*["'][^"']*\barticle-text\b[^"']*["'][^>]*>(.*?)(?:</main\s*>|$)"""
    return F.when(bare.rlike(rx), F.regexp_extract(bare, rx, 1))


def clean_url(url: Column, drop: tuple[str, ...] = ("exp",)) -> Column:
    """Without the query parameters named, without blank ones, and without a fragment."""
    base = F.regexp_extract(url, r"^([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    gone = F.array(*[F.lit(d) for d in drop])
    kept = F.filter(F.split(query, "&"), lambda p: (F.instr(p, "=") > 0) & (F.length(F.regexp_extract(p, r"=(.*)$", 1)) > 0) & ~F.array_contains(gone, F.split(p, "=")[0]))
    joined = F.array_join(kept, "&")
    return F.when(joined == "", base).otherwise(F.concat(base, F.lit("?"), joined))


def rubric(title: Column) -> Column:
    """Class of a company publication: the first class that has a phrase in it, else INCONNUE."""
    t = F.lower(title)
    out = F.when(t.isNull(), F.lit(None).cast("string"))
    for name, phrases in RUBRICS.items():
        out = out.when(t.rlike("|".join(phrases)), F.lit(name))
    return out.otherwise(F.lit("INCONNUE"))


def _blank_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", F.trim(c))


def registry_address(lang: str = "FR", prefix: str = "") -> Column:
    """``street number bte box, zip municipality, country, extra`` of a registry row; FR and NL stand in for
    each other, blanks are skipped."""
    other = "NL" if lang == "FR" else "FR"
    col = lambda n: _blank_null(F.col(prefix + n))
    pick = lambda n: F.coalesce(col(n + lang), col(n + other))
    box = F.concat(F.lit(" bte " if lang == "FR" else " bus "), col("Box"))
    line = F.concat(F.concat_ws(" ", pick("Street"), col("HouseNumber")), F.coalesce(box, F.lit("")))
    town = F.concat_ws(" ", col("Zipcode"), pick("Municipality"))
    return F.concat_ws(", ", F.when(line != "", line), F.when(town != "", town), pick("Country"), col("ExtraAddressInfo"))


def denomination(c: Column) -> Column:
    return F.regexp_replace(c, r"\s*\(\d+\)\s*$", "")


def trim_address(c: Column) -> Column:
    """Without the ``à`` before a postcode, and cut where the sentence goes on after the house number."""
    c = F.regexp_replace(c, r"(?iU)^\s*[àa]\s+(?=\d{4}\b)", "")
    return F.trim(F.regexp_replace(c, r"(?iU)\s+(?:signifié|inscrit|né|née|ayant|pour extrait|le \d).*$", ""))


def postcode(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(?<!\d)([1-9]\d{3})(?!\d)", 1), F.lit(""))


def house_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(F.regexp_replace(c, r"(?<!\d)[1-9]\d{3}(?!\d)", " "), r"(?<!\d)(\d{1,4}[A-Za-z]?(?:/\d+)?)", 1), F.lit(""))


def has_postcode_and_number(c: Column) -> Column:
    return postcode(c).isNotNull() & house_number(c).isNotNull()


def once_doubled(c: Column) -> Column:
    """A word that directly repeats the one before stands once."""
    return F.regexp_replace(c, r"(?iU)\b(\w+)(?:\s+\1\b)+", "$1")


def without_bar(c: Column) -> Column:
    """A text without brackets that begin with Av, up to the next closing one on the line."""
    return F.regexp_replace(c, r"(?iUd)\(Av\.?.*?\)", "")


def estate_once(c: Column) -> Column:
    """``Succession en déshérence`` stands once where it directly repeats itself."""
    return F.regexp_replace(c, r"(?iU)(Succession en déshérence)\s+\1", "$1")


def once_each(c: Column, begin: str = "Déclaration d'acceptation") -> Column:
    """Paragraphs, each from a ``begin`` to the next, once; in order of first places, with blanks between."""
    parts = F.transform(F.split(c, f"(?={re.escape(begin)})"), lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", ""))
    return F.array_join(F.array_distinct(F.filter(parts, lambda p: p != "")), " ")


def first_index(text: Column, part: Column, start: Column) -> Column:
    """0-based place of ``part`` at or after ``start``, or null."""
    at = F.call_function("locate", part, text, start + 1)
    return F.when(at > 0, at - 1)


def words_of(c: Column) -> Column:
    """Index words: lower case, split at the separators."""
    return F.filter(F.split(F.lower(c), SEPARATORS), lambda w: w != "")


def highlight(c: Column, word: str) -> Column:
    """``word`` marked where it stands as a whole word."""
    return F.regexp_replace(c, rf"(?iU)(?<![\p{{L}}\d])({re.escape(word)})(?![\p{{L}}\d])", "<em>$1</em>")
