"""Expressions for addresses and struck-off names against the plain functions over single texts."""

import random

import pytest
from pyspark.sql import functions as F

from actaspark.operators import addresses, entities

PARTS = [
    "domiciliée à 1000 Bruxelles, Rue de la Loi 12.", "demeurant à Liège, Avenue Rogier 3 bte 4", "ayant eu son dernier domicile à rue Haute 1A, 4537 Verlaine", "Le nommé DUPONT réside",
    "4537 Verlaine, Grand-Route 245/0011;", "dont le siège social est établi à 1400 Nivelles, rue de l'Industrie 22,", "ÉTABLIE À 1000 BRUXELLES, PLACE POELAERT 1", "avocat à 5000 Namur, avenue des Tilleuls 4 BTE 12.",
    "chaussée de Mons 7, 6000 Charleroi", "N° ent. 0123.456.749 EXEMPLE UN SPRL En date du", "N ent 0999.111.222 ÉLAN", "N° ent. 0999.111.222 X. N° ent. 0123.456.749 DEUX", "N° ent. 0123.456.749", "et. ", "; ", "  \n ", "HAUTE 5 4000",
    "Kerkstraat 5, 9000 Gent", "domicilié à Steenweg 3, 1000 Brussel", "x",
]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(PARTS, k=rng.randint(0, 6)))) for i in range(400)] + [(900 + i, p) for i, p in enumerate(PARTS)] + [(999, None)]
    return rows, spark.createDataFrame(rows, "id int, t string").repartition(2)


def test_names(texts):
    rows, df = texts
    got = {r["id"]: r["a"] for r in df.select("id", addresses.struck_off_names(F.col("t")).alias("a")).collect()}
    assert got == {i: entities.struck_off_names(t) for i, t in rows} and any(got.values())


def test_homes(texts):
    rows, df = texts
    got = {r["id"]: r["a"] for r in df.select("id", addresses.home_addresses(F.col("t")).alias("a")).collect()}
    for i, t in rows:
        assert got[i] == entities.home_addresses(t), t


@pytest.mark.parametrize("streets", [None, [], ["HAUTE", "TILLEULS"]])
def test_seats(texts, streets):
    rows, df = texts
    known = None if streets is None else F.array(*[F.lit(s) for s in streets]).cast("array<string>")
    got = {r["id"]: r["a"] for r in df.select("id", addresses.company_address(F.col("t"), known).alias("a")).collect()}
    for i, t in rows:
        assert got[i] == entities.company_address(t, frozenset(streets or ())), t
