"""Joins on time against plain loops, mergeable sketches, letters of all scripts, misspelt months, scan cleaners."""

import random
import unicodedata
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from actaspark.functions import dates, text, unicode
from actaspark.operators import daily_sketches, time_joins

T0 = datetime(2024, 1, 1)


def moments(rng, n, most):
    return [None if rng.random() < 0.05 else T0 + timedelta(minutes=rng.randrange(most)) for _ in range(n)]


@pytest.mark.parametrize("width", [60.0, 7_000.0, 1e9])
def test_as_of(spark, width):
    rng = random.Random(5)
    left = [(i, rng.choice(["a", "a", "a", "b", None]), t) for i, t in enumerate(moments(rng, 200, 500))]
    right = [(rng.choice(["a", "a", "b", None]), t, i, None if i % 9 == 0 else f"r{i}") for i, t in enumerate(moments(rng, 150, 500))]
    found = time_joins.as_of(spark.createDataFrame(left, "id int, k string, t timestamp"), spark.createDataFrame(right, "k string, at timestamp, n int, name string"), ["k"], "t", "at", ["n", "name"], width)
    want = {}
    for i, k, t in left:
        best = max(((at, n, name or "") for key, at, n, name in right if k is not None and key == k and None not in (t, at) and at <= t), default=None)
        want[i] = (best[1], best[2] or None) if best else (None, None)
    rows = found.collect()
    assert found.columns == ["id", "k", "t", "n", "name"] and len(rows) == len(left)
    assert {r["id"]: (r["n"], r["name"]) for r in rows} == want


@pytest.mark.parametrize("by", [None, ["k"]])
def test_within(spark, by):
    rng = random.Random(6)
    points = [(i, rng.choice(["a", "b", None]), t) for i, t in enumerate(moments(rng, 120, 3000))]
    spans = [(i, rng.choice(["a", "b", None]), t, None if t is None else t + timedelta(seconds=rng.choice([-5, 0, 0, 59, 60, 61, 4000, 90_000, 10**7]))) for i, t in enumerate(moments(rng, 120, 3000))]
    columns = "k string, " if by else "k2 string, "
    found = time_joins.within(spark.createDataFrame(points, "p int, k string, t timestamp"), "t", spark.createDataFrame(spans, f"i int, {columns}a timestamp, b timestamp"), "a", "b", by)
    want = sorted((p, i) for p, k, t in points for i, own, a, b in spans if None not in (t, a, b) and a <= t <= b and (by is None or k is not None and k == own))
    assert sorted((r["p"], r["i"]) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_intervals(spark):
    none = spark.createDataFrame([], "i int, a timestamp, b timestamp")
    assert time_joins.within(spark.createDataFrame([(1, T0)], "p int, t timestamp"), "t", none, "a", "b").collect() == []


def test_days_merge_to_the_whole(spark):
    rng = random.Random(7)
    rows = spark.createDataFrame([(T0 + timedelta(hours=rng.randrange(240)), rng.choice("ab"), rng.randrange(20_000), rng.gauss(0, 1)) for _ in range(40_000)], "t timestamp, g string, user long, v double")
    exact = {r["g"]: r for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user").alias("users")).collect()}
    days = daily_sketches.by_day(rows, "t", ["g"], "user", "v").cache()
    assert days.count() == 20
    again = days.select("day", "g", "n", "items", "values")  # what a store gives back
    for r in daily_sketches.merged(again, ["g"]).select("g", "n", daily_sketches.distinct_of(F.col("items")).alias("users"), *[daily_sketches.quantile_of(F.col("values"), q).alias(f"q{i}") for i, q in enumerate((0.1, 0.5, 0.9))]).collect():
        assert r["n"] == exact[r["g"]]["n"] and abs(r["users"] - exact[r["g"]]["users"]) <= daily_sketches.DISTINCT_ERROR * exact[r["g"]]["users"]
        for i, q in enumerate((0.1, 0.5, 0.9)):
            share = rows.filter((F.col("g") == r["g"]) & (F.col("v") <= r[f"q{i}"])).count() / r["n"]
            assert abs(share - q) <= daily_sketches.RANK_ERROR
    assert daily_sketches.merged(again, ["g"], F.col("day") > F.lit("2030-01-01").cast("date")).count() == 0


def test_letters(spark):
    said = ["Łódź", "Ζάκυνθος", "é é ẹ̃", "ﬁn ①", "plain", "", None, "Ἀθῆναι", "ångström Å", "한글"]
    df = spark.createDataFrame([(s,) for s in said], "s string")
    got = df.select(*[unicode.normal(F.col("s"), form).alias(form) for form in ("NFC", "NFD", "NFKC", "NFKD")], unicode.without_marks(F.col("s")).alias("bare")).collect()
    for s, r in zip(said, got, strict=True):
        assert all(r[form] == (None if s is None else unicodedata.normalize(form, s)) for form in ("NFC", "NFD", "NFKC", "NFKD"))
    assert [r["bare"] for r in got] == ["Łodz", "Ζακυνθος", "e e e", "ﬁn ①", "plain", "", None, "Αθηναι", "angstrom A", "한글"]
    assert df.filter(unicode.contains(F.col("s"), "ΚΥΝΘ")).collect()[0]["s"] == "Ζάκυνθος"
    assert df.filter(unicode.same(F.col("s"), F.lit("αθηναι"))).count() == 1


@pytest.mark.parametrize(
    "month, words",
    list(
        enumerate(
            [
                "janvier janv jan janiver",
                "février fevrier fév fev fevr fevrer fevrie feurier feverier fevier",
                "mars mar marsr",
                "avril avr avri",
                "mai",
                "juin juiin",
                "juillet juil juill juiller",
                "août aout aoüt aoút a0ut aou aouts",
                "septembre sept setpembre septemre septemb",
                "octobre oct ocotbre octobr octber",
                "novembre nov novemre novenbre",
                "décembre decembre dec decebre decemre decrmbre",
            ],
            1,
        )
    ),
)
def test_misspelt_months(spark, month, words):
    df = spark.createDataFrame([(w,) for w in words.split()], "w string")
    assert {r["w"]: r["m"] for r in df.select("w", dates.misspelt_month(F.col("w")).alias("m")).collect()} == dict.fromkeys(words.split(), month)


def test_other_words_are_no_months(spark):
    words = "mais mas main moi mois tout sout mat jui ju a marche avis fin juge octet dix membre cour jour sa été   euros octobres-x septante novice décharge".split(" ") + ["", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r["w"] for r in df.select("w", dates.misspelt_month(F.col("w")).alias("m")).filter("m is not null").collect()] == []


@pytest.mark.parametrize(
    "said, want",
    [("le 1er janiver 2024", "2024-01-01"), ("3 maisons 2020 puis 4 setpembre 2021", "2021-09-04"), ("31 fevrier 2024", None), ("12 A0UT. 2023", "2023-08-12"), ("", None), (None, None), ("1 er mars 1999", "1999-03-01")],
)
def test_scanned_dates(spark, said, want):
    row = spark.createDataFrame([(said,)], "s string").select(dates.scanned_date(F.col("s")).cast("string").alias("d")).first()
    assert row["d"] == want


def test_small_rules(spark):
    row = spark.createDataFrame([("2024-02-30", "2024-02-29", "", ["a", " ", None, "b"])], "bad string, good string, blank string, l array<string>")
    got = row.select(dates.doc_date(F.col("bad")).alias("a"), dates.doc_date(F.col("good")).alias("b"), dates.doc_date(F.col("blank")).alias("c"), dates.date_list(F.col("l")).alias("l"), dates.date_list(F.lit(None).cast("array<string>")).alias("n")).first()
    assert (got["a"]["date"], got["a"]["raw"]) == (None, "2024-02-30") and str(got["b"]["date"]) == "2024-02-29" and tuple(got["c"]) == (None, None) and (got["l"], got["n"]) == (["a", "b"], [])
    said = spark.createDataFrame([("A (av. de X) B (AVOCAT Y) C (Z) succession en Déshérence  Succession en déshérence",)], "s string")
    assert said.select(text.estate_once(text.without_bar(F.col("s"))).alias("s")).first()["s"] == "A  B  C (Z) succession en Déshérence"
    parts = spark.createDataFrame([("x  Déclaration d'acceptation 1 \n Déclaration d'acceptation 1 Déclaration d'acceptation 2",), ("",), ("one",)], "s string")
    assert [r["s"] for r in parts.select(text.once_each(F.col("s")).alias("s")).collect()] == ["x Déclaration d'acceptation 1 Déclaration d'acceptation 2", "", "one"]
