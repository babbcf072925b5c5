"""Watches against a plain loop over all pairs."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from actaspark.operators import watch

WATCHES = "watch_id int, date_from date, tags array<string>, street string, keyword string"
DOCUMENTS = "id long, date_doc date, tags array<string>, haystack string"


def plain(watches, documents, unknown=False):
    out = set()
    for w, start, tags, street, keyword in watches:
        for i, day, own, said in documents:
            if start is not None and (day is None or day < start):
                continue
            if tags is not None and not (unknown and not tags) and not set(tags) & set(own or []):
                continue
            if all(x is None or (said is not None and x.lower() in said) for x in (street, keyword)):
                out.add((w, i))
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    days = [None, date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)]
    said = ["Rue", "haute", "loi", "é", "avenue loi", "ha"]
    documents = [(i, rng.choice(days), rng.choice([None, [], ["a"], ["a", "b"], ["c"]]), rng.choice([None, "", *(" ".join(rng.choices(said, k=4)).lower() for _ in range(6))])) for i in range(80)]
    watches = [(k, rng.choice(days), rng.choice([None, None, [], ["a"], ["b", "c"], ["a", "b"]]), rng.choice([None, *said]), rng.choice([None, None, *said])) for k in range(120)]
    return watches, documents


@pytest.mark.parametrize("unknown", [False, True])
@pytest.mark.parametrize("few", [0, 32])
def test_matches(spark, tables, monkeypatch, unknown, few):
    monkeypatch.setattr(watch, "FEW_TERMS", few)  # the automaton, and the expression
    watches, documents = tables
    found = watch.matches(spark.createDataFrame(watches, WATCHES), spark.createDataFrame(documents, DOCUMENTS), unknown)
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain(watches, documents, unknown)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_bounds_are_checked(spark, tables, monkeypatch):
    monkeypatch.setattr(watch, "MOST_FREE", 1)
    with pytest.raises(ValueError, match="more than 1 watches"):
        watch.matches(spark.createDataFrame([(1, None, None, None, None), (2, None, None, None, None)], WATCHES), spark.createDataFrame(tables[1], DOCUMENTS))


def test_scans_and_lists(spark):
    watches = spark.createDataFrame([(1, "u", date(2024, 1, 1), None), (2, "u", date(2024, 1, 5), date(2024, 1, 2)), (3, "v", None, None)], "watch_id int, user string, created date, last_scan date")
    scanned = spark.createDataFrame([(1,), (1,)], "watch_id int")
    assert {r["watch_id"]: r["last_scan"] for r in watch.set_last_scan(watches, scanned, F.lit("2024-02-01").cast("date")).collect()} == {1: date(2024, 2, 1), 2: date(2024, 1, 2), 3: None}
    events = spark.createDataFrame([(1, date(2024, 1, 1), "a"), (1, date(2024, 1, 3), "b")], "watch_id int, date_publication date, type string")
    listed = watch.watches_of(watches, events, "u").collect()
    assert [(r["watch_id"], [e["type"] for e in r["events"]]) for r in listed] == [(2, []), (1, ["b", "a"])]
    forms = spark.createDataFrame([("VAT", " ", None, None, ["1"]), ("VAT", "x", None, None, None), ("KEYWORD", " ", [], None, None), ("KEYWORD", None, ["t"], "", None)], "kind string, keyword string, tags array<string>, street string, companies array<string>")
    assert [r["ok"] for r in forms.select(watch.is_complete(*[F.col(c) for c in forms.columns]).alias("ok")).collect()] == [True, False, False, True]
