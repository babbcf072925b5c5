import re

import pytest
from pyspark.sql import functions as F

from actaspark.operators import entities, rules, watch
from actaspark.operators.judgment_date import judgment_date
from actaspark.operators.packs import appeal, enterprise, first_instance, strike_off

T = "_tribunal_de_l_entreprise"


def tags(spark, pack, text):
    return rules.with_tags(spark.createDataFrame([(text,)], "text string"), pack).first()["tags"]


@pytest.mark.parametrize(
    "pack,text,want",
    [
        (enterprise.PACK, "ouverture de la faillite de : SRL EXEMPLE UN", ["ouverture_faillite" + T]),
        (enterprise.PACK, "OUVERTURE DE LA FAILLITE et désignation d'un curateur", ["designation" + T, "ouverture_faillite" + T]),
        (enterprise.PACK, "clôture de la faillite pour insuffisance d'actif", ["cloture_insuffisance_actif" + T, "cloture_faillite" + T]),
        (enterprise.PACK, "CLÔTURE de la dissolution judiciaire", ["cloture_dissolution" + T] * 2 + ["dissolution_judiciaire" + T]),
        (enterprise.PACK, "Le tribunal rapporte la dissolution et prononce la clôture de la liquidation", ["rapporte_dissolution" + T]),
        (enterprise.PACK, "la faillite a été déclarée", ["ouverture_faillite" + T]),
        (enterprise.PACK, "réorganisation judiciaire de la SRL X", ["reorganisation" + T]),
        (enterprise.PACK, "ouverture de la réorganisation judiciaire de la SRL X", ["ouverture_reorganisation" + T]),
        (enterprise.PACK, "refuse l'effacement", ["effacement_refusé" + T]),
        (enterprise.PACK, "refus : l'effacement n'est pas dû", ["effacement_refusé" + T]),
        (enterprise.PACK, "x" * 401 + " mis à néant le jugement", []),
        (enterprise.PACK, "a mis à néant le jugement", ["annulation_jugement" + T]),
        (enterprise.PACK, None, []),
        (first_instance.PACK, "Toute personne intéressée est priée de se manifester dans les trois mois", ["délai de contact 3"]),
        (first_instance.PACK, "siégeant en degré d'appel, réforme l'ordonnance et réforme le jugement", ["appel", "reforme_ordonnance", "reforme_jugement"]),
        (first_instance.PACK, "levée de la mesure de protection", ["levee_mesure"]),
        (appeal.PACK, "un sursis de six mois est accordé à la SRL EXEMPLE", ["sursis", "sursis_accordé_6_mois"]),
        (appeal.PACK, "interdit à la personne visée, de diriger une société, pour une durée de cinq ans", ["interdiction", "interdiction_5_ans"]),
        (appeal.PACK, "succession réputée vacante", ["succession", "succession_vacante"]),
        (appeal.PACK, "déclare la faillie non excusable", ["non_excusable"]),
        (appeal.PACK, "est excusable", ["excusable"]),
        (appeal.PACK, "a rapporté la faillite de la SRL EXEMPLE", ["rapporte_faillite"] * 2),
        (strike_off.PACK, "Liste des entités enregistrées : retrait de la radiation d'office pour non-dépôt des comptes annuels", ["retrait_radiation_non_depot_comptes"]),
        (strike_off.PACK, "Pour cause de doublons l'inscription a été annulée", ["annulation_doublon"]),
        (strike_off.PACK, "x" * 1500 + " pour cause de doublon a été annulée", []),
    ],
)
def test_packs(spark, pack, text, want):
    assert tags(spark, pack, text) == want


def test_every_tag_is_there():
    count = lambda pack: len({r.tag for r in pack.rules})
    assert (count(enterprise.PACK), count(first_instance.PACK), count(appeal.PACK), count(strike_off.PACK)) == (43, 18, 39, 15)


def test_needs_are_implied(spark):
    """A pattern's cheap word must be in every text that the pattern matches, so it is looked for in the pattern."""
    for pack in (enterprise.PACK, first_instance.PACK, appeal.PACK, strike_off.PACK):
        for name, p in pack.patterns.items():
            if p.needs:
                loose = re.sub(r"\\s[+*]|\[[^\]]*\]|\\.|[?()]", "", p.regex.lower())
                assert p.needs in loose or all(c in p.regex.lower() for c in p.needs), name


def test_patterns_agree_with_python(spark):
    """Java and Python see the same patterns the same way on a French corpus."""
    corpus = ["Le tribunal de l'entreprise prononce l'OUVERTURE de la faillite", "clôture de la liquidation judiciaire", "Désigné en qualité d'administrateur provisoire", "a été désignée\u00a0en qualité de liquidateur", "article 488 du Code civil", "réforme et met à néant la décision du 3 mars 2024, du juge de paix", "est remplacé par le juge commissaire", "liste des entités enregistrées dont l'adresse du siège a été radiée", "est présumé absent", "l'absence de Monsieur Dupont", ""]
    df = spark.createDataFrame([(c,) for c in corpus], "t string")
    for pack in (enterprise.PACK, first_instance.PACK, appeal.PACK, strike_off.PACK):
        names = list(pack.patterns)
        got = df.select("t", *[F.col("t").rlike(pack.patterns[n].flags + pack.patterns[n].regex).alias(n) for n in names]).collect()
        for row in got:
            for n in names:
                p = pack.patterns[n]
                flags = (re.I if "i" in p.flags else 0) | (re.S if "s" in p.flags else 0)
                assert row[n] == bool(re.search(p.regex, row["t"], flags)), (n, row["t"])


@pytest.mark.parametrize(
    "text,want",
    [
        ("Par jugement du 12 mars 2024, le tribunal " + "x " * 300, ("2024-03-12", 0.9)),
        ("Cour d'appel de Liège par arrêt du 1er avril 2024", ("2024-04-01", 0.9)),
        ("L'affaire du 3 avril 2024 est " + "x " * 300, ("2024-04-03", 0.6)),
        ("né le 3 avril 1980, entendu", None),
        ("Date du jugement : 05/03/2024", ("2024-03-05", 0.9)),
        ("court", None),
        (None, None),
    ],
)
def test_judgment_date(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(judgment_date(F.col("t")).alias("r")).first()["r"]
    assert (got and (got["date"], got["confidence"])) == want


def test_entities():
    assert [(a["role"], a["entity"]) for a in entities.administrators("Liquidateur(s) désigné(s) : 1. Monsieur Jean EXEMPLE - rue du Test 5; Maître Anne Dupont, curateur")] == [("curateur", "Anne Dupont"), ("liquidateur", "Jean Exemple")]
    assert entities.company_names("en cause de : ASBL EXEMPLE, dont") == ["EXEMPLE ASBL"]
    assert entities.struck_off_names("N° ent. 0123.456.749 EXEMPLE UN SPRL En date du") == ["EXEMPLE UN SPRL"]
    people = entities.persons("le nommé DUPONT, Jean, né à Liège; Monsieur Jean DUPONT")
    assert [(p["canonical"], p["aliases"]) for p in people] == [("DUPONT Jean", ["Jean DUPONT"])]
    assert entities.home_addresses("domiciliée à 1000 Bruxelles, Rue de la Loi 12.") == ["1000 Bruxelles, Rue de la Loi 12"]
    assert entities.company_address("établie à 1400 Nivelles, rue de l'Industrie 22") == "1400 NIVELLES, RUE DE L'INDUSTRIE 22"
    assert entities.mandataries("le curateur Alice Exemple", ["EXEMPLE Alice"], ["curateur"])[0]["nom"] == "EXEMPLE Alice"
    assert entities.mandataries("Maître Alice Exemple, avocate", [], ["curateur"]) == [{"nom": "Alice Exemple", "role": "regex-fallback", "raw": "Alice Exemple"}]
    assert entities.merge_administrators(["EXEMPLE Alice"], [{"role": "curateur", "entity": "Exemple Alice", "raw": "x"}]) == [{"entity": "Exemple Alice", "role": "curateur", "raw": "x", "origin": "regex", "confidence": 50}]
    assert entities.spellings("Van den Berg, Jean".replace(",", "")) >= {"van den berg jean", "den berg jean van"}
    for f in (entities.administrators, entities.company_names, entities.persons, entities.home_addresses, entities.struck_off_names):
        assert f(None) == [] and f("") == []


def test_taxonomy():
    assert {k: len(v) for k, v in watch.decision_types().items()} == {"ouverture": 3, "cloture": 4, "faillite": 4, "liquidation": 1, "dissolution": 4, "effacement": 5, "radiation": 9, "condamnation": 1}
    assert dict(watch.tag_suggestions("non_excusable")) == {"non_excusable": "procedures_collectives"}


def test_earlier_packs_count(spark):
    row = spark.createDataFrame([("la faillite de X est déclarée",)], "text string")
    opened = "ouverture_faillite_tribunal_de_l_entreprise"
    alone = rules.with_tags(row, enterprise.PACK).first()["tags"]
    closed = rules.with_tags(row, enterprise.PACK, earlier=F.array(F.lit("cloture_liquidation"))).first()["tags"]
    assert opened in alone and opened not in closed


@pytest.mark.parametrize(
    "text,want",
    [
        ("x" * 450 + " tribunal de première instance de Mons, par jugement du 3 mai 2024, dit", ("2024-05-03", 0.9)),
        ("x" * 450 + " par jugement du 3 mai 2024 ... tribunal de première instance, par jugement du 4 mai 2024", ("2024-05-03", 0.9)),
        ("x" * 700 + ". Liège, le 5 juin 2024.", ("2024-06-05", 0.9)),
        ("x" * 700 + ". Quelque part, le 5 juin 2024.", None),
        ("publié le 2 janvier 2020, tribunal de première instance de Mons, le 3 mai 2024", ("2020-01-02", 0.6)),
        ("tribunal de première instance de Mons, en la cause de Jean, né à Mons, qui y demeure, a rendu le 3 mai 2024", ("2024-05-03", 0.9)),
        ("tribunal de première instance : Jean, né à Mons, le 3 mai 1980", ("1980-05-03", 0.6)),
        ("tribunal de première instance" + " x" * 80 + " le 3 mai 2024", ("2024-05-03", 0.6)),
    ],
)
def test_judgment_date_places(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(judgment_date(F.col("t")).alias("r")).first()["r"]
    assert (got and (got["date"], got["confidence"])) == want


def test_names_with_particles():
    assert entities.person_name("Maître Jean DE SMET, rue Haute 1") == "Jean De Smet"
    assert entities.person_name("Tribunal de Première Instance") is None and entities.person_name("Me Dupont") is None
    assert [a["entity"] for a in entities.administrators("Curateur : Maître Jean DE SMET, avocat")] == ["Jean De Smet"]
