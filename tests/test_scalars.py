import datetime
import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from actaspark.functions import dates, ids, text


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("value,want", [("BE0123456749", True), ("BE0123456700", False), ("3999998797", True), ("0123456", False), (None, False)])
def test_number_check(spark, value, want):
    assert one(spark, value, ids.is_valid_number) is want


@pytest.mark.parametrize("value,want", [("BE 0123.456.749", "0123.456.749"), ("123456749", "0123.456.749"), ("12345", None)])
def test_number_format(spark, value, want):
    assert one(spark, value, ids.format_number) == want


def test_unpadded_format(spark):
    assert one(spark, "123456749", lambda c: ids.format_number(c, pad=False)) is None


def test_extract_numbers(spark):
    assert one(spark, "a 0123.456.749 b 0123 456 749 c 40000-00183 d 0308.357.159", ids.extract_numbers) == ["0123456749", "4000000183"]


def test_person_numbers(spark):
    assert one(spark, "85.01.01-123.87", ids.is_valid_person_number) is True
    assert one(spark, "85.01.01-123.88", ids.is_valid_person_number) is False
    got = one(spark, "85010112387", ids.decode_person_number)
    assert (got["birth"], got["sex"]) == (datetime.date(1985, 1, 1), "M")
    got = one(spark, "05020312431", ids.decode_person_number)
    assert (got["birth"], got["sex"]) == (datetime.date(2005, 2, 3), "F")
    assert one(spark, "RN 85.01.01-123.87 et 85010112387", ids.person_numbers) == ["85.01.01-123.87"]


@given(st.integers(0, 99_999_999))
def test_check_digits(n):
    number = f"{n:08d}{97 - n % 97:02d}"
    assert int(number[-2:]) == 97 - int(number[:8]) % 97


@pytest.mark.parametrize("value,want", [("20 octobre 2025", "2025-10-20"), ("05/03/2024", "2024-03-05"), ("2024-05-06", "2024-05-06"), ("2 février 2024", "2024-02-02"), ("31/02/2024", None), ("1er mars 2024", "2024-03-01"), ("3.4.69", "1969-04-03"), ("3.4.68", "2068-04-03"), (None, None)])
def test_dates(spark, value, want):
    got = one(spark, value, dates.to_date)
    assert (got and got.isoformat()) == want


def test_dates_compat_and_gate(spark):
    assert one(spark, "2 février 2024", lambda c: dates.to_date(c, compat=True)) is None
    assert one(spark, "2024-13-40", dates.is_valid_date) is False
    assert one(spark, "2024-02-29", dates.is_valid_date) is True
    assert one(spark, "1er er mars", dates.first_of_month_text) == "1 mars"
    assert one(spark, "quinze", dates.number_of) == 15 and one(spark, "7", dates.number_of) == 7
    assert one(spark, 8, dates.month_name, "int") == "aout"
    assert one(spark, "le 3 mars 2024 n° 1234567 en 1999", dates.without_dates) == "le n° en"


def test_hash(spark):
    row = spark.createDataFrame([("2024-03-01", "Exemple, de TEXTE neutre!")], "d string, t string")
    got = row.select(text.content_hash(F.col("d"), F.col("t"))).first()[0]
    assert got == "f629176134183d12d4b521016348ad717e8f8f80c1b2bad834ce4b8512188cb1" == hashlib.sha256(b"2024-03-01::exemple de texte neutre").hexdigest()


def test_url(spark):
    assert one(spark, "https://h/p?language=fr&exp=cour+d&page=3&view_numac=", text.clean_url) == "https://h/p?language=fr&page=3"


def test_addresses(spark):
    assert one(spark, "à 4032 Liège", text.trim_address) == "4032 Liège"
    assert one(spark, "1000 Bruxelles, Rue de la Loi 12 Signifié le 03/01/2024", text.trim_address) == "1000 Bruxelles, Rue de la Loi 12"
    assert one(spark, "5100 Namur", text.has_postcode_and_number) is False
    assert one(spark, "4537 Verlaine, Grand-Route 245/0011", text.has_postcode_and_number) is True
    row = {"StreetFR": "Rue Exemple", "HouseNumber": "12", "Box": "3", "Zipcode": "1000", "MunicipalityFR": "Bruxelles", "StreetNL": "", "MunicipalityNL": None, "CountryFR": None, "CountryNL": None, "ExtraAddressInfo": " "}
    schema = ", ".join(f"{k} string" for k in row)
    assert spark.createDataFrame([tuple(row.values())], schema).select(text.registry_address()).first()[0] == "Rue Exemple 12 bte 3, 1000 Bruxelles"


def test_words(spark):
    assert one(spark, "Jean Jean Dupont", text.once_doubled) == "Jean Dupont"
    assert one(spark, "Démission - nomination", text.rubric) == "DEMISSION-NOMINATION"
    assert one(spark, "Définition des pouvoirs", text.rubric) == "FIN"
    assert one(spark, "autre", text.rubric) == "INCONNUE"
    assert one(spark, "Erratum : le texte", text.is_erratum) is True
    assert one(spark, "x" * 400 + " erratum", text.is_erratum) is False
    assert one(spark, "EXEMPLE (015)", text.denomination) == "EXEMPLE"
    assert one(spark, "Clôture  ÉTÉ", text.loose) == "cloture ete"
    row = spark.createDataFrame([("abc 123 def 456",)], "t string")
    got = row.select(text.first_index(F.col("t"), F.lit("456"), F.lit(5)), text.first_index(F.col("t"), F.lit("123"), F.lit(10))).first()
    assert tuple(got) == (12, None)


def test_page_text():
    assert text.page_text("<main>le 1<sup>er</sup> mars</main>", True) == "le 1er er mars"
    assert text.page_text("<main>le 1<sup>er</sup> mars<br>fin<script>x</script></main>") == "le 1er mars fin"
    assert text.page_text("<p>a</p><p>b</p>") == "ab"
    assert text.page_text(None) is None


@pytest.mark.parametrize("value,want", [("le douze mars deux mille vingt-quatre", "2024-03-12"), ("Premier février deux mil dix-sept", "2017-02-01"), ("trente et un août deux mille", "2000-08-31"), ("trente février deux mille un", None), ("rien", None)])
def test_spoken_dates(spark, value, want):
    got = one(spark, value, dates.spoken_date)
    assert (got and got.isoformat()) == want
