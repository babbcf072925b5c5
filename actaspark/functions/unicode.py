"""Letters of all scripts: normal forms, letters without marks, and comparisons by collation.

Spark has no function for normal forms, so texts with other than ASCII characters pass an Arrow function; the others
don't change and are never sent to it (it gets nulls in their place)."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Equal but for case and marks, in any script.
LOOSE = "UNICODE_CI_AI"
_OTHER = r"[^\x00-\x7F]"


def _elsewhere(c: Column, change: Callable[[str], str]) -> Column:
    @F.pandas_udf("string")
    def apply(texts: pd.Series) -> pd.Series:
        return texts.map(change, na_action="ignore")

    return F.coalesce(apply(F.when(c.rlike(_OTHER), c)), c)


def normal(c: Column, form: str = "NFC") -> Column:
    """The text in normal form NFC, NFD, NFKC or NFKD."""
    return _elsewhere(c, lambda t: unicodedata.normalize(form, t))


def without_marks(c: Column, compatible: bool = False) -> Column:
    """Every letter without its marks, composed; letters that are no sum of a letter and a mark (ł, ø, ß) stay. With
    ``compatible`` other forms of a character (ﬁ, ①) become the plain one."""
    form = "NFKD" if compatible else "NFD"

    def bare(t: str) -> str:
        return unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize(form, t) if unicodedata.category(x)[0] != "M"))

    return _elsewhere(c, bare)


def same(a: Column, b: Column) -> Column:
    """Whether two texts are equal but for case and marks."""
    return F.collate(a, LOOSE) == F.collate(b, LOOSE)


def contains(c: Column, part: str) -> Column:
    """Whether the part is in the text but for case and marks."""
    return F.contains(F.collate(c, LOOSE), F.collate(F.lit(part), LOOSE))
