"""Courts of first instance."""

from actaspark.operators.rules import Pack, Pattern, Rule

from . import common as c

# Fixed values.
PATTERNS = {
    "appeal": Pattern(r"(?:statuant|siégeant)\s+en\s+degr[ée]?\s+d[’']?appel|requête\s+d[’']?appel", needs="appel"),
    "reformed_and_annulled": Pattern(c.REFORMED_AND_ANNULLED, needs="néant"),
    "reformed_order": Pattern(c.REFORMED_ORDER, needs="ordonnance"),
    "reformed_judgment": Pattern(r"r[ée]forme\s+(?:le|ce)\s+jugement", needs="jugement"),
    "lifted": Pattern(c.LIFTED, needs="mesure"),
    "annulled": Pattern(c.ANNULLED, needs="néant"),
    "discharged": Pattern(c.DISCHARGED, needs="mission"),
    "civil_code": Pattern(c.CIVIL_CODE, needs="civ"),
    "observation_lifted": Pattern(c.OBSERVATION_LIFTED, needs="observation"),
    "liquidation_closed": Pattern(c.LIQUIDATION_CLOSED, needs="liquidation"),
    "lifted_with_roll": Pattern(c.LIFTED_WITH_ROLL, needs="(rg"),
    "sentenced": Pattern(c.SENTENCED),
    "appointed": Pattern(c.APPOINTED, flags=c.ALL, needs="désign"),
    "judicial_dissolution": Pattern(c.JUDICIAL_DISSOLUTION, needs="dissolution"),
    "request_refused": Pattern(r"dit\s+non\s+fond[ée]e\s+la\s+demande\s+visant\s+à\s+mettre\s+fin", needs="visant"),
    "peace_reformed": Pattern(r"r[ée]forme\s+(?:la\s+)?d[ée]cision\s+(?:rendue\s+par\s+)?(?:(?:la|le|du|de\s+la)\s+(?:justice|juge)\s+de\s+paix)", needs="paix"),
    "administrator_named": Pattern(r"a\s+été\s+nomm[ée]?\s+en\s+qualité\s+d['’]administrateur\s+provisoire", needs="provisoire"),
    "assembly_annulled": Pattern(r"(?:prononc[ée]e?|d[ée]cid[ée]e?)\s+l[’']?annulation\s+de\s+la\s+d[ée]cision\s+de\s+l[’']?assembl[ée]e\s+g[ée]n[ée]rale", needs="annulation"),
    "contact": Pattern(r"toute\s+personne\s+(?:concernée|intéressée).*?est\s+prié[e]?[e]?\s+de.*?dans\s+les?\s+(\d+|un|une|deux|trois|quatre|cinq|six|sept|huit|neuf|dix|onze|douze)\s+mois", flags=c.ALL, needs="toute"),
}
RULES = (
    Rule("appel", "appeal"),
    Rule("reforme_mise_a_neant", "reformed_and_annulled"),
    Rule("reforme_ordonnance", "reformed_order"),
    Rule("reforme_jugement", "reformed_judgment"),
    Rule("levee_mesure", "lifted"),
    Rule("mise_a_neant", "annulled"),
    Rule("fin de mission", "discharged"),
    Rule("fin_mesure", "civil_code"),
    Rule("levee_mesure_observation", "observation_lifted"),
    Rule("cloture_liquidation", "liquidation_closed"),
    Rule("levee_mesure", "lifted_with_roll"),
    Rule("condamnation", "sentenced"),
    Rule("désignation", "appointed"),
    Rule("dissolution_judiciaire", "judicial_dissolution"),
    Rule("rejet_demande", "request_refused"),
    Rule("reforme_decision_jp", "peace_reformed"),
    Rule("nommination_administrateur", "administrator_named"),
    Rule("annulation_decision_AG", "assembly_annulled"),
    Rule("délai de contact {n}", "contact", number=(("contact", 1),)),
)
PACK = Pack(PATTERNS, RULES)
