"""Result lists and publication pages. Fetching is not the engine's business: pages arrive as tables."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actaspark.functions import text

# Which items of a list belong to which stream.
SUBTITLES = {"registry": "banque-carrefour des entreprises", "constitutional": "cour constitutionnelle", "council": "conseil d'etat"}
TITLES = {"first_instance": "tribunal de première instance", "enterprise": "tribunal de l'entreprise", "appeal": "cour d'appel"}


class _Items(HTMLParser):
    """Links of a result list with their title and the subtitle before them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items, self.subtitle, self.link, self.words, self.place = [], "", None, [], None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "a" and "numac_search=" in (a.get("href") or ""):
            self.link, self.words = a["href"], []
        elif "subtitle" in (a.get("class") or ""):
            self.place, self.words = "subtitle", []

    def handle_data(self, data):
        self.words.append(data)

    def handle_endtag(self, tag):
        said = re.sub(r"\s+", " ", "".join(self.words)).strip()
        if tag == "a" and self.link:
            numac, day = re.search(r"numac_search=(\d+)", self.link), re.search(r"pd_search=(\d{4}-\d{2}-\d{2})", self.link)
            self.items.append({"url": self.link, "numac": numac and numac[1], "date_doc": day and day[1], "title": said, "subtitle": self.subtitle})
            self.link = None
        elif self.place:
            self.subtitle, self.place = said, None


_ITEMS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("url", "numac", "date_doc", "title", "subtitle")]))


@F.pandas_udf(_ITEMS)
def list_items(html: pd.Series) -> pd.Series:
    def items(page):
        parser = _Items()
        parser.feed(page or "")
        return parser.items

    return html.map(items)


def publication_links(lists: DataFrame, keyword: Column) -> DataFrame:
    """PUBLICATION_LINK rows of result lists (html)."""
    rows = lists.select(keyword.alias("keyword"), F.explode(list_items("html")).alias("i"))
    return rows.select("i.url", "i.numac", "i.date_doc", F.lit("FR").alias("lang"), "keyword", "i.title", "i.subtitle")


def page_count(html: Column) -> Column:
    """Pages of a result: the number in the last pagination link, else 1."""
    found = F.regexp_extract_all(html, F.lit(r"[?&;]page=(\d+)"), F.lit(1))
    return F.coalesce(F.try_element_at(found, F.lit(-1)).try_cast("int"), F.lit(1))


def routed(links: DataFrame) -> DataFrame:
    """Links with the ``stream`` they belong to; the others are gone."""
    title, subtitle = F.lower("title"), text.loose(F.col("subtitle"))
    stream = F.when(subtitle == SUBTITLES["registry"], "registry").when(subtitle == SUBTITLES["constitutional"], "constitutional")
    stream = stream.when((subtitle == SUBTITLES["council"]) & title.startswith("avis prescrit"), "council")
    for name, start in TITLES.items():
        stream = stream.when(F.translate(title, "’", "'").startswith(start), name)
    return links.withColumn("stream", stream).filter("stream is not null")


def until_empty(pages: DataFrame, key: str, number: str, items: str, most: int = 7) -> DataFrame:
    """Pages of each key up to the first empty one, ``most`` at the most."""
    empty = pages.filter(F.size(items) == 0).groupBy(key).agg(F.min(number).alias("_stop"))
    return pages.join(empty, key, "left").filter((F.col(number) < F.coalesce("_stop", F.lit(most + 1))) & (F.col(number) <= most)).drop("_stop")


def annex_events(pages: DataFrame) -> DataFrame:
    """ANNEX_EVENT rows of (societe, html): one for each article, dates left null where none stands."""
    rows = pages.select("societe", F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<article\b.*?</article>"), F.lit(0))).alias("a"))
    title = text.squash(text.plain_html(F.regexp_extract("a", r"(?is)<font\b[^>]*>(.*?)</font>", 1)))
    day = F.try_to_date(F.regexp_extract("a", r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")
    return rows.select("societe", text.rubric(title).alias("rubrique"), F.nullif(F.regexp_extract("a", r"""href=["']([^"']+)""", 1), F.lit("")).alias("url"), day.alias("date_publication"))
