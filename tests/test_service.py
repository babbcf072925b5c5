"""Guards, records, counts, and operators that had no test of their own."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from actaspark.functions import text
from actaspark.operators import entities, service, watch
from actaspark.operators.search import SearchSchema
from actaspark.plans import pipeline
from actaspark.sources import pages, registry, sinks


def test_checked_inputs():
    assert service.checked("vat", " 0123.456.789 ") == "0123.456.789" and service.checked("global", "=faillite") == "=faillite" and service.checked("suggest", "rue") == "rue"
    for kind, said in (("vat", "123456789"), ("vat", "0123.456.7890"), ("suggest", "ru "), ("global", " "), ("keyword", "")):
        with pytest.raises(ValueError):
            service.checked(kind, said)


def test_schema_is_kept_to(spark):
    df = spark.createDataFrame([("1", ["a"], "x"), ("2", ["b"], "y")], "id string, keyword array<string>, lang string")
    assert service.displayed(df, SearchSchema()).columns == ["id", "keyword"]
    assert [r["id"] for r in df.filter(service.filterable(["keyword = a"], SearchSchema(), dict(df.dtypes))).collect()] == ["1"]
    with pytest.raises(ValueError, match="lang doesn't filter"):
        service.filterable([["keyword = a", "lang = x"]], SearchSchema(), dict(df.dtypes))


def test_keywords_and_dates(spark):
    df = spark.createDataFrame([(None,), (" ",), ("a b c d e",), ("a b c d e f",), ("x" * 100,), ("x" * 101,)], "k string")
    assert [r[0] for r in df.select(service.keyword_ok(F.col("k"))).collect()] == [True, True, True, False, True, False]
    assert [r["i"] for r in service.without_date(spark.createDataFrame([(1, None), (2, " "), (3, "2024-01-01")], "i int, date_doc string")).collect()] == [1, 2]


def test_fallback_and_counts(spark):
    docs = spark.createDataFrame([(1, ["a"], "Rue  Élan"), (2, None, "rue elan"), (3, ["a"], "x"), (4, ["b"], "rue élan 3"), (None, ["a"], "rue elan")], "id long, tags array<string>, text string")
    found = spark.createDataFrame([(3,), (3,), (1,)], "id long")
    assert sorted(r["id"] or 0 for r in service.street_fallback(found, docs, "RUE élan", ["a", "b"]).collect()) == [0, 1, 3, 4]
    assert sorted(r["id"] or 0 for r in service.street_fallback(found.limit(0), docs, "rue elan").collect()) == [0, 1, 2, 4]
    assert tuple(service.added(found.distinct(), docs.select("id"), "id").first()) == (2, 3, 5)


def test_registry_filters(spark):
    rows = spark.createDataFrame([("0123.456.749", "001", "1"), ("0123456749", " 001", "2"), (None, "001", "1"), ("0400.000.183", None, "1")], "EntityNumber string, TypeOfDenomination string, Language string")
    assert registry.chosen(rows, TypeOfDenomination=["001"], Language=None).count() == 3 and registry.chosen(rows, TypeOfDenomination=["001"], Language=["2"]).count() == 1
    assert registry.chosen(rows, TypeOfDenomination=[]).count() == 4
    assert sorted(r["bce"] for r in registry.enterprise_numbers(rows, rows.limit(1)).collect()) == ["0123456749", "0400000183"]


def test_article_selection(spark):
    said = {
        '<p>a</p><main class="page__inner page__inner--content article-text"><p>b</p></main><p>c</p>': "<p>b</p>",
        "<main class='x article-text y' id=1>never closed": "never closed",
        '<!-- <main class="article-text">no</main> --><main class="article">d</main>': None,
        "": None,
    }
    df = spark.createDataFrame([(k,) for k in said], "html string")
    assert [r[0] for r in df.select(text.article_html(F.col("html"))).collect()] == list(said.values())
    links = spark.createDataFrame([(f"u{i}", "2024-01-01") for i in range(5)], "url string, date_doc string")
    stored = spark.createDataFrame([(f"u{i}", html) for i, html in enumerate(said)], "url string, html string")
    good, dead = pipeline.bronze(links, stored, article_only=True)
    assert {r["url"]: r["text"] for r in good.collect()} == {"u0": "b", "u1": "never closed"}
    assert {r["url"]: r["reason"] for r in dead.collect()} == {"u2": "text", "u3": "text", "u4": "page"}


def test_pages_up_to_an_empty_one(spark):
    rows = spark.createDataFrame([("a", n, ["x"] if n != 3 else []) for n in range(1, 6)] + [("b", n, ["x"]) for n in range(1, 10)], "vat string, n int, items array<string>")
    got = pages.until_empty(rows, "vat", "n", "items").collect()
    assert sorted((r["vat"], r["n"]) for r in got) == [("a", 1), ("a", 2)] + [("b", n) for n in range(1, 8)]


def test_second_source_where_the_first_has_nothing(spark):
    a = spark.createDataFrame([("1", ["x"]), ("2", []), ("3", None)], "bce string, names array<string>")
    b = spark.createDataFrame([("1", ["y"]), ("2", ["z"]), ("4", [])], "bce string, names array<string>")
    got = {r["bce"]: (r["names"], r["unresolved"]) for r in registry.prefer(a, b, "bce", "names").collect()}
    assert got == {"1": (["x"], False), "2": (["z"], False), "3": (None, True), "4": (None, True)}


def test_notices_and_recurrence(spark):
    watches = spark.createDataFrame([(1, "u", "daily", None), (2, "u", "weekly", "monday"), (3, "v", "weekly", None)], "watch_id int, user string, recurrence string, recurrence_weekday string")
    events = spark.createDataFrame([(1,), (2,), (2,)], "watch_id int")
    assert [tuple(r) for r in sinks.notifications(events, watches).collect()] == [("u", 3, [1, 2])]
    kept = watch.set_recurrence(watches, F.when(F.col("watch_id") == 3, "monthly").otherwise(F.col("recurrence")), F.lit("friday")).collect()
    assert [(r["recurrence"], r["recurrence_weekday"]) for r in kept] == [("daily", None), ("weekly", "friday"), ("monthly", None)]
    assert watch.within_quota(watches, "user", "watch_id", F.lit(False)).count() == 2 and date(2024, 1, 1)


def test_dense_street_ids(spark):
    said = [f"Rue {chr(65 + k % 26)}{k}" for k in range(300)]
    names = spark.createDataFrame([(n, i) for i, n in enumerate(said)] + [("RUE a0", 999), ("", 1000), (None, 1001)], "n string, seq int")
    got = registry.street_index(names, "n", "seq").collect()
    assert [(r["id"], r["name"]) for r in sorted(got, key=lambda r: r["name"])] == list(enumerate(sorted(n.lower() for n in said), 1))
    assert {r["label"] for r in got} == set(said)
    many = registry.numbered(names.select("seq"), "seq", partitions=5).collect()
    assert [(r["id"], r["seq"]) for r in sorted(many)] == list(enumerate([*range(300), 999, 1000, 1001], 1))
    assert registry.numbered(names.select("seq").limit(0), "seq").count() == 0


def test_addresses_in_known_streets(spark, monkeypatch):
    streets = spark.createDataFrame([("Industrie",), ("Rue Haute",)], "name string")
    df = spark.createDataFrame([("siège : rue Haute 12, 1000 Bruxelles",), ("siège : rue Basse 12, 1000 Bruxelles",), (None,)], "t string")
    known = entities.company_address_among(streets)
    assert [r[0] for r in df.select(known("t")).collect()] == ["RUE HAUTE 12, 1000", None, None]
    monkeypatch.setattr(entities, "MOST_STREETS", 1)
    with pytest.raises(ValueError, match="more than 1"):
        entities.company_address_among(streets)
