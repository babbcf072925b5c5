"""The table function of rule packs against the packs as expressions."""

import pytest
from pyspark.errors import AnalysisException

from actaspark.operators import rule_hits, rules
from actaspark.operators.packs import appeal, enterprise, first_instance, strike_off

from .test_rules import test_packs as cases

PACKS = {"enterprise": enterprise.PACK, "first": first_instance.PACK, "appeal": appeal.PACK, "strike": strike_off.PACK}
TEXTS = [c for mark in cases.pytestmark for _, c, _ in mark.args[1]]


@pytest.fixture(scope="module")
def texts(spark):
    more = [f"{a} {b}" for a, b in zip(TEXTS[:-1], TEXTS[1:]) if a and b]
    df = spark.createDataFrame(list(enumerate([*TEXTS, *more, ""])), "id long, text string").repartition(3).cache()
    df.createOrReplaceTempView("texts")
    rule_hits.register(spark, PACKS)
    return df


@pytest.mark.parametrize("name", sorted(PACKS))
def test_tags_agree_with_expressions(spark, texts, name):
    want = {(r["id"], t) for r in rules.with_tags(texts, PACKS[name]).collect() for t in r["tags"]}
    lateral = spark.sql(f"SELECT t.id, h.tag, h.place FROM texts t, LATERAL rule_hits(t.text, '{name}') h").collect()
    table = spark.sql(f"SELECT id, tag, place FROM rule_hits(TABLE(texts), '{name}')").collect()
    assert want and {(r["id"], r["tag"]) for r in lateral} == want and sorted(lateral) == sorted(table)
    own = {r["id"]: r["text"] for r in texts.collect()}
    assert all(r["place"] is None or 0 <= r["place"] < len(own[r["id"]]) for r in lateral)


def test_places_are_first_matches():
    pack = rules.Pack(
        {"b": rules.Pattern("b+"), "x": rules.Pattern("X", head=4), "n": rules.Pattern(r"(\w+) mois", needs="mois")},
        (rules.Rule("either", "b or x"), rules.Rule("none", "not b and not before('either')"), rules.Rule("n_{n}", "n", number=(("n", 1),)), rules.Rule("after", "b and before('either')", guard="not n")),
    )
    hits = lambda text: list(rule_hits.Matcher(pack).hits(text))
    assert hits("é aBb xb") == [("either", 3), ("after", 3)]
    assert hits("..x....b") == [("either", 2), ("after", 7)]
    assert hits("....x deux mois") == [("none", None), ("n_2", 6)]
    assert hits("b 007 mois") == [("either", 0), ("n_7", 2)] and hits("") == [("none", None)] and hits(None) == []


def test_wrong_arguments(spark, texts):
    with pytest.raises(AnalysisException, match="pack must be one of"):
        spark.sql("SELECT * FROM rule_hits(TABLE(texts), 'none')")
    with pytest.raises(AnalysisException, match="column named text"):
        spark.sql("SELECT * FROM rule_hits(TABLE(SELECT id FROM texts), 'appeal')")
