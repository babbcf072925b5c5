"""Administrators by dictionary as Spark joins, against the plain functions over single texts."""

import random

from pyspark.sql import functions as F

from actaspark.operators import entities, mandataries
from actaspark.plans import pipeline

NAMES = ["EXEMPLE Alice", "de Smet Jean", "Élan Noé", "Vide", "O'Neil P.J."]


def texts():
    rng = random.Random(4)
    parts = ["le curateur", "Maître", "Alice Exemple", "EXEMPLE ALICE", "Smet Jean", "jean de smet", "noé  élan", "ONeil PJ", "x " * 160, "Anne Dupont, avocate", "liquidateur", "dans l'affaire", "cabinet-"]
    return [(f"t{i}", " ".join(rng.choices(parts, k=rng.randint(0, 9)))) for i in range(150)] + [("null", None), ("copy", "Maître Alice Exemple")]


def test_windows(spark):
    for said in ("", "curateur", "xx curateur yy", "aaa curateur bb curateur c" + "z" * 500 + "curateur", "curateurcurateur"):
        for keyword, reach in (("curateur", 300), ("curateur", 5), ("a", 2)):
            row = spark.createDataFrame([(said,)], "t string").select(mandataries.windows(F.col("t"), keyword, reach).alias("w")).first()
            at = [k for k in range(len(said)) if said.startswith(keyword, k)]
            assert row["w"] == [said[max(0, k - reach) : max(k + reach, k + len(keyword))] for k in at]


def test_look_up_against_single_texts(spark):
    rows = texts()
    df = spark.createDataFrame(rows, "id string, text string")
    names = spark.createDataFrame([(n,) for n in NAMES * 2], "nom string")
    found = mandataries.mandataries(df, "id", "text", names)
    got = {r["id"]: sorted((m["nom"], m["role"]) for m in r["mandataries"]) for r in found.collect()}
    want = {i: sorted((m["nom"], m["role"]) for m in entities.mandataries(t, NAMES, list(mandataries.KEYWORDS))) for i, t in rows}
    assert got == want and sum(bool(v) for v in want.values()) > 40
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_merge_against_single_lists(spark):
    rng = random.Random(5)
    roles = ["curateur", "liquidateur", "liquidateur(s)", "inconnu", "regex-fallback"]
    rows = []
    for i in range(80):
        listed = rng.sample(NAMES, rng.randint(0, 3))
        found = [(rng.choice(roles), rng.choice(["Exemple Alice", "Alice Exemple", "Jean De Smet", "Noé Élan", "Anne Dupont", "ANNE DUPONT"]), f"raw{k}") for k in range(rng.randint(0, 4))]
        rows.append((f"d{i}", [(n, "inconnu") for n in listed], found))
    df = spark.createDataFrame(rows, "id string, listed array<struct<nom:string,role:string>>, found array<struct<role:string,entity:string,raw:string>>")
    got = {r["id"]: [a.asDict() for a in r["administrators"]] for r in df.select("id", mandataries.merged(F.col("listed"), F.col("found")).alias("administrators")).collect()}
    for i, listed, found in rows:
        want = entities.merge_administrators([n for n, _ in listed], [{"role": r, "entity": e, "raw": w} for r, e, w in found])
        assert got[i] == want, i


def test_silver_with_names(spark):
    said = "Par jugement du 12 mars 2024, la société 0123.456.749 : curateur Maître Jean DE SMET, cabinet Alice Exemple."
    rows = spark.createDataFrame([("2024-03-13", said, "enterprise"), ("2024-03-13", said, "enterprise"), ("2024-03-13", said.replace("mars", "mai"), "registry")], "date_doc string, text string, stream string")
    names = spark.createDataFrame([("EXEMPLE Alice",), ("DE SMET Jean",)], "nom string")
    got = pipeline.silver(rows, names=names).collect()
    assert len(got) == 3
    for r in got:
        if r["stream"] == "registry":
            assert r["administrators"] == [] and r["date_jugement"]["date"] == "2024-05-12"
        else:
            assert sorted((a["entity"], a["role"], a["confidence"]) for a in r["administrators"]) == [("EXEMPLE Alice", "inconnu", 100), ("Jean De Smet", "curateur", 50)]
