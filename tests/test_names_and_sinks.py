import datetime

from pyspark.sql import functions as F

from actaspark.functions import names
from actaspark.plans.pipeline import provenance_log
from actaspark.sources import sinks


def test_names(spark):
    row = spark.createDataFrame([("Dupont, Jean", "Van den BERG J. Élise", ["Jean Dupont", "x", "Jean Dupont Martin", "A 1"])], "a string, b string, l array<string>")
    r = row.select(
        names.turn_at_comma(F.col("a")).alias("turned"),
        names.without_initials(F.col("b")).alias("plain"),
        names.spellings(F.lit("Jean de Exemple")).alias("s"),
        names.full_names(F.col("l")).alias("full"),
        names.absorb_shorter(F.col("l")).alias("long"),
        names.without_title(F.lit("par Maître Anne Exemple")).alias("bare"),
    ).first()
    assert r["turned"] == "Jean Dupont" and r["plain"] == "Van den BERG Élise"
    assert r["s"] == ["jean de exemple", "de exemple jean", "jean exemple"]
    assert r["full"] == ["Jean Dupont", "Jean Dupont Martin"] and r["long"] == ["x", "Jean Dupont Martin", "A 1"]
    assert r["bare"] == "Anne Exemple"


def test_address_fits(spark):
    text = "La SRL EXEMPLE, dont le siège est Rue de la Loi 12, 1000 Bruxelles"
    row = spark.range(1).select(
        names.address_fits(F.lit(text), F.lit("Rue de la Loi 12"), F.lit("EXEMPLE SRL")).alias("yes"),
        names.address_fits(F.lit(text), F.lit("Rue de la Loi 12"), F.lit("AUTRE")).alias("no"),
        names.address_fits(F.lit(text), F.lit("Rue X"), F.lit("EXEMPLE")).alias("unknown"),
    )
    assert tuple(row.first()) == (True, False, None)


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([("x", datetime.date(2024, 1, 5), ["b", "a"], "t"), ("y", datetime.date(2024, 2, 5), None, "u")], "id string, date_doc date, TVA array<string>, text string")
    sinks.write_decisions(d, str(tmp_path / "d"))
    assert {p.name for p in (tmp_path / "d").iterdir() if p.is_dir()} == {"month=2024-01", "month=2024-02"}
    sinks.write_lookup(d, "TVA", str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "l")).filter("value = 'a'").first()["id"] == "x"
    sinks.write_csv(d, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 3
    sinks.write_json(d, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    listed, more = spark.createDataFrame([("B",), ("A",)], "nom string"), spark.createDataFrame([("A",), ("C",)], "nom string")
    assert [r["nom"] for r in sinks.add_names(listed, more).collect()] == ["A", "B", "C"]
    assert [r["nom"] for r in sinks.remove_names(listed, more).collect()] == ["B"]


def test_provenance(spark):
    rows = [("d", "generic", "a long generic item", True, 1, 1), ("d", "specific", "short", False, 5, 2), ("d", "specific", "longer one", False, 9, 3), ("e", "generic", "x", True, 0, 1)]
    got = provenance_log(spark.createDataFrame(rows, "doc_id string, tag string, item string, generic boolean, start int, seq int")).collect()
    assert {r["doc_id"]: r["item"] for r in got} == {"d": "longer one", "e": "x"}
