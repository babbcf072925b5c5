"""Enterprise and person numbers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two institutions' own numbers, printed under every publication, are not parties to it.
INSTITUTION_NUMBERS = ("0308357159", "0206731645")


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def enterprise_number(c: Column) -> Column:
    """Ten digits (nine get a leading zero), or null."""
    d = digits(c)
    d = F.when(F.length(d) == 9, F.concat(F.lit("0"), d)).otherwise(d)
    return F.when(F.length(d) == 10, d)


def format_number(c: Column, pad: bool = True) -> Column:
    """dddd.ddd.ddd, or null."""
    d = enterprise_number(c) if pad else F.when(F.length(digits(c)) == 10, digits(c))
    return F.regexp_replace(d, "^(....)(...)(...)$", "$1.$2.$3")


def is_valid_number(c: Column) -> Column:
    """Ten digits, the last two being 97 less the first eight modulo 97."""
    d = digits(c)
    good = F.right(d, F.lit(2)).cast("int") == 97 - F.pmod(F.left(d, F.lit(8)).cast("long"), F.lit(97))
    return F.coalesce(F.when(F.length(d) == 10, good), F.lit(False))


def extract_numbers(text: Column, left_out: tuple[str, ...] = INSTITUTION_NUMBERS) -> Column:
    """All 4-3-3 numbers of a text, then all 5-5 ones, as digits; each once; those ``left_out`` are not."""
    first = F.regexp_extract_all(text, F.lit(r"(?d)(?<![0-9])([0-9]{4}[\s.\-]?[0-9]{3}[\s.\-]?[0-9]{3})(?![0-9])"), F.lit(1))
    second = F.regexp_extract_all(text, F.lit(r"(?<![0-9])([0-9]{5}[\s.\-]?[0-9]{5})(?![0-9])"), F.lit(1))
    found = F.transform(F.concat(first, second), digits)
    found = F.array_distinct(found)
    return F.filter(found, lambda n: ~n.isin(*left_out)) if left_out else found


def is_public_entity(c: Column) -> Column:
    return F.coalesce(enterprise_number(c).startswith("0200"), F.lit(False))


def is_valid_person_number(c: Column) -> Column:
    """Eleven digits; 97 less the first nine modulo 97, for births from 2000 on with a leading 2."""
    d = digits(c)
    nine, check = F.left(d, F.lit(9)).cast("long"), F.right(d, F.lit(2)).cast("int")
    good = (check == 97 - F.pmod(nine, F.lit(97))) | (check == 97 - F.pmod(nine + 2_000_000_000, F.lit(97)))
    return F.coalesce(F.when(F.length(d) == 11, good), F.lit(False))


def decode_person_number(c: Column) -> Column:
    """struct(birth date, sex): the century by the checksum, the sex by the serial's parity."""
    d = digits(c)
    nine, check = F.left(d, F.lit(9)).cast("long"), F.right(d, F.lit(2)).cast("int")
    century = F.when(check == 97 - F.pmod(nine, F.lit(97)), F.lit("19")).when(check == 97 - F.pmod(nine + 2_000_000_000, F.lit(97)), F.lit("20"))
    day = F.try_to_date(F.concat(century, F.substring(d, 1, 6)), "yyyyMMdd")
    sex = F.when(F.substring(d, 7, 3).cast("int") % 2 == 1, F.lit("M")).otherwise(F.lit("F"))
    return F.when((F.length(d) == 11) & century.isNotNull(), F.struct(day.alias("birth"), sex.alias("sex")))


def person_numbers(text: Column) -> Column:
    """Valid person numbers of a text as yy.mm.dd-xxx.cc, each once."""
    found = F.regexp_extract_all(text, F.lit(r"(?<![0-9])([0-9]{2}[.\s/\-]?[0-9]{2}[.\s/\-]?[0-9]{2}[.\s/\-]?[0-9]{3}[.\s/\-]?[0-9]{2})(?![0-9])"), F.lit(1))
    plain = F.filter(F.transform(found, digits), is_valid_person_number)
    return F.array_distinct(F.transform(plain, lambda d: F.regexp_replace(d, "^(..)(..)(..)(...)(..)$", "$1.$2.$3-$4.$5")))


def strip_one_zero(c: Column) -> Column:
    return F.regexp_replace(c, "^0", "")


def strip_zeros(c: Column) -> Column:
    return F.regexp_replace(c, "^0+", "")
