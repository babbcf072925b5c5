"""Expressions for companies, administrators and persons against the plain functions over single texts."""

import random

import pytest
from pyspark.sql import functions as F

from actaspark.operators import entities, parties

PARTS = [
    "Liquidateur(s) désigné(s) : 1. Monsieur Jean EXEMPLE - rue du Test 5; 2. Madame Anne DUPONT - x", "Maître Anne Dupont, curateur", "Curateur : Maître Jean DE SMET, rue Haute 1", "curatrice: Me Alice Exemple, avocate",
    "article 2:79", "Monsieur Paul Tribunal", "M. Luc Noël", "liquidateur : J.-P. MARTIN", "déchargé Maître Anne Dupont de sa mission de curateur", "Madame Zoé ÉLAN, née le 3 mai, est désignée comme liquidatrice",
    "le nommé DUPONT, Jean, né à Liège", "Monsieur Jean DUPONT", "succession vacante de Jeanne MARTIN", "interdiction est faite à Luc LEROY", "en cause de : DUPONT Jean", "l'absence de Marie-Anne D'HONDT", "condamne MARTIN, Paul", "PETIT Jean, RN 85",
    "faillite de : SRL EXEMPLE UN, dont", "en cause de : ASBL EXEMPLE, dont", "dans l’affaire : Les Amis du Parc, x", "en l'espèce de la EXEMPLE DEUX SA,", "dissolution judiciaire de SPRL L'ÉTOILE DU NORD;", "faillite de la société X inscrite sous", "SA DUMONT ET FILS", "TRIBUNAL DE LIEGE", "et", "; ", ". ", "\n",
]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(10)
    rows = [(i, " ".join(rng.choices(PARTS, k=rng.randint(0, 6)))) for i in range(400)] + [(900 + i, p) for i, p in enumerate(PARTS)] + [(999, None)]
    return rows, spark.createDataFrame(rows, "id int, t string").repartition(2)


def test_companies(texts):
    rows, df = texts
    got = {r["id"]: r["a"] for r in df.select("id", parties.company_names(F.col("t")).alias("a")).collect()}
    for i, t in rows:
        assert got[i] == entities.company_names(t), t


def test_long_texts_can_be_read_whole(spark):
    df = spark.createDataFrame([("x " * 5000 + "faillite de : SRL EXEMPLE UN, dont",)], "t string")
    assert tuple(df.select(parties.company_names(F.col("t")), parties.company_names(F.col("t"), None)).first()) == ([], ["EXEMPLE UN SRL"])


def test_administrators(texts):
    rows, df = texts
    got = {r["id"]: [a.asDict() for a in r["a"]] for r in df.select("id", parties.administrators(F.col("t")).alias("a")).collect()}
    for i, t in rows:
        assert got[i] == entities.administrators(t), t


def test_persons(texts):
    rows, df = texts
    got = {r["id"]: [p.asDict() for p in r["a"]] for r in df.select("id", parties.persons(F.col("t")).alias("a")).collect()}
    for i, t in rows:
        assert got[i] == entities.persons(t), t
