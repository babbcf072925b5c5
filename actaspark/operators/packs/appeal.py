"""Courts of appeal."""

from actaspark.operators.rules import Pack, Pattern, Rule

from . import common as c

_YEARS = rf"\s*,?\s*.{{0,300}}?(?:pour\s+une?\s+durée\s+de\s+|pendant\s+)({c.NUMBER})\s+(?:ans?|années?)"

# Fixed values.
PATTERNS = {
    "succession": Pattern(r"\bsuccession[s]?", needs="succession"),
    "vacant": Pattern(r"\bsuccession[s]?[^.\n]{0,40}?(?:(?:réputée[s]?(?:[^.\n]{0,10})?vacante[s]?)|vacante[s]?)", needs="vacante"),
    "heirless": Pattern(r"\bsuccession[s]?[^.\n]{0,40}?en\s+désh[ée]rence", needs="succession"),
    "presumed_absent": Pattern(r"\bprésum[ée]?\b.{0,15}?(?:absent(?:e|es|s)?|d[’']?absence)\b", needs="présum"),
    "presumption": Pattern(r"\bprésomption\s+d[’']?absence\b", needs="présomption"),
    "reformed_and_annulled": Pattern(c.REFORMED_AND_ANNULLED, needs="néant"),
    "bankruptcy_withdrawn": Pattern(r"\b(?:a\s+)?rapport[ée]?\s+la\s+faillite\b", flags=c.ALL, needs="faillite"),
    "bankruptcy_withdrawn_of": Pattern(r"\brapport[ée]?\s+la\s+faillite\s+de\s+[^.;:\n]{2,160}", flags=c.ALL, needs="faillite"),
    "reformed_order": Pattern(c.REFORMED_ORDER, needs="ordonnance"),
    "lifted": Pattern(c.LIFTED, needs="mesure"),
    "annulled": Pattern(c.ANNULLED, needs="néant"),
    "discharged": Pattern(c.DISCHARGED, needs="mission"),
    "civil_code": Pattern(c.CIVIL_CODE, needs="civ"),
    "observation_lifted": Pattern(c.OBSERVATION_LIFTED, needs="observation"),
    "liquidation_closed": Pattern(c.LIQUIDATION_CLOSED, needs="liquidation"),
    "debt_wiped": Pattern(r"\boctroie\b.*?\ble\s+b[ée]n[ée]fice\s+de\s+l[’']?effacement", flags=c.ALL, needs="octroie"),
    "wiping_refused": Pattern(r"(?:n['’]?\s*y\s+a\s+pas\s+lieu\s+d['’]accorder\s+le\s+b[ée]n[ée]fice\s+de\s+l[’']?effacement|refuse\s+d['’]accorder\s+le\s+b[ée]n[ée]fice\s+de\s+l[’']?effacement)", flags=c.ALL, needs="effacement"),
    "reorganisation_closed": Pattern(r"(?:met\s+fin\s+à\s+la\s+procédure\s+de\s+r[ée]organisation\s+judiciaire|cl[ôo]ture\s+la\s+procédure\s+de\s+r[ée]organisation\s+judiciaire)", needs="organisation"),
    "opposition_void": Pattern(r"^(?=.*\bdit\s+l[’']?(?:opposition|appel)\b[\s\S]{0,200}?\bnon[-\s]+avenue?\b)(?=.*\bordonne\s+la\s+publication\b[\s\S]{0,200}?(?:aux?\s+annexes\s+du\s+)?moniteur\s+belge\b)", flags=c.ALL, needs="avenu"),
    "lifted_with_roll": Pattern(c.LIFTED_WITH_ROLL, needs="(rg"),
    "capable": Pattern(r"\b(?:dit\s+pour\s+droit\s+que\s+)?(?:le\s+tribunal\s+)?(?:statuant\s+)?(?:monsieur|madame)\b[^.\n]{0,100}?\best\s+capable\b", needs="capable"),
    "sentenced": Pattern(c.SENTENCED),
    "no_home": Pattern(r"\bsans\s+(?:résidence|domicile)\s+ni\s+(?:résidence|domicile)(?:\s+connu[e]?s?)?", needs="sans"),
    "appointed": Pattern(c.APPOINTED, flags=c.ALL, needs="désign"),
    "judicial_dissolution": Pattern(c.JUDICIAL_DISSOLUTION, needs="dissolution"),
    "represented": Pattern(rf"sous\s+un\s+régime\s+de\s+représentation\s+par\s+ordonnance{c.DATE_OPTIONAL}", needs="représentation"),
    "absence_of": Pattern(r"\b(?:d[ée]clar(?:e|er|é(?:e|s)?|ait|aient|era(?:ient)?|ent)\s+(?:[^.\n]{0,60})?)?(?:l|d)[’']?\s*absence\s+de\s+(?:(?:Monsieur|Madame|M\.|Mme)\b|[A-ZÉÈÀÂÎÔÙ][a-zà-öø-ÿ'\-]+)(?:\s+[A-ZÉÈÀÂÎÔÙ][a-zà-öø-ÿ'\-]+){0,3}", flags="(?Ud)", needs="absence"),
    "dissolution_retracted": Pattern(r"la\s+dissolution(?:\s+judiciaire)?\s+de[\s\S]*?a\s+été\s+r[ée]tract[ée]e?\b", needs="dissolution"),
    "plan_after_reform": Pattern(r"\br[ée]form(?:ant|e)\s+le\s+(?:jugement|ordonnance|d[ée]cision)\b.{0,400}?\b(?:et\s+)?homologu(?:e|ant|é|ée)\s+(?:l[’']?)?le\s+plan\s+de\s+r[ée]organisation(?:\s+judiciaire)?(?:\s*\(PRJ\))?", flags=c.ALL, needs="homologu"),
    "business_forbidden": Pattern(r"interdisant\s+à\s+(.{1,300}?)\s+d[’']?exploiter\s+une\s+entreprise", flags=c.ALL, needs="interdisant"),
    "judgment_annulled": Pattern(r"la\s+cour\s+d\s*[’']?\s*appel\s+(?:de\s+\w+)?\s+a\s+mis\s+à\s+n[ée]ant\s+le\s+jugement", needs="jugement"),
    "revocation_withdrawn": Pattern(r"\brapporte\s+la\s+r[ée]vocation\s+du\s+plan\s+de\s+r[ée]organisation(?:\s+judiciaire)?", needs="rapporte"),
    "stay": Pattern(r"\b(?:un|le)?\s*sursis\s+de\s+(\d{1,2}|un|une|deux|trois|quatre|cinq|six|sept|huit|neuf|dix|onze|douze)\s+mois\s+est\s+accord[ée]?\s+à\s+[^.;:\n]{3,160}", flags=c.ALL, needs="sursis"),
    "not_excusable": Pattern(r"(?:d[ée]clare\b[\s\S]{0,600}?\b(?:non[-\s]?excusable|inexcusable)\b|\best\s+(?:non[-\s]?excusable|inexcusable)\b)", needs="excusable"),
    "excusable": Pattern(r"(?:d[ée]clare\b[\s\S]{0,600}?\bexcusable\b|\best\s+excusable\b)", needs="excusable"),
    "any_not_excusable": Pattern(r"\b(?:non[\s-]?|in)excusable\b", needs="excusable"),
    "transfer_agreed": Pattern(r"\bconclusion\s+de\s+la\s+convention\s+de\s+transfert\b", needs="convention"),
    "forbidden": Pattern(r"\b(?:il\s+est\s+)?interdit\s+à\s+[^,;:\n]{2,200}" + _YEARS, flags=c.ALL, needs="interdit"),
    "forbidding_decided": Pattern(rf"\b(?:prononce|confirme|maintient|r[ée]forme\s+et\s+prononce)\s+l[’']?interdiction.*?(?:(?:\bà\s+l[’']?égard\s+de\b|\bde\b|\bà\b)\s+)?[^,;:\n]{{2,200}}\s*,?\s*.{{0,300}}?(?:pour\s+une\s+durée\s+de\s+|pendant\s+)({c.NUMBER})\s+ans?", flags=c.ALL, needs="interdiction"),
    "forbidding": Pattern(r"\binterdisant\s+à\s+[^,;:\n]{2,200}" + _YEARS, flags=c.ALL, needs="interdisant"),
    "forbidden_to_direct": Pattern(r"d[’']exercer\s+une\s+fonction\s+conf[ée]rant\s+le\s+pouvoir\s+d[’']engager\s+une\s+personne\s+morale", needs="pouvoir"),
    "stay_prolonged": Pattern(rf"\b(?:proroge|prolonge)\s+le\s+sursis\s+jusqu[’']?au\s+{c.DATE}", needs="sursis"),
}
_BAN = (("forbidden", 1), ("forbidding_decided", 1))
RULES = (
    Rule("succession", "succession"),
    Rule("succession_vacante", "vacant"),
    Rule("succession_deshérence", "heirless"),
    Rule("presume_absent", "presumed_absent"),
    Rule("presomption_absence", "presumption"),
    Rule("reforme_mise_a_neant", "reformed_and_annulled"),
    Rule("rapporte_faillite", "bankruptcy_withdrawn"),
    Rule("rapporte_faillite", "bankruptcy_withdrawn_of"),
    Rule("reforme_ordonnance", "reformed_order"),
    Rule("levee_mesure", "lifted"),
    Rule("mise_a_neant", "annulled"),
    Rule("fin de mission", "discharged"),
    Rule("fin_mesure", "civil_code"),
    Rule("levee_mesure_observation", "observation_lifted"),
    Rule("cloture_liquidation", "liquidation_closed"),
    Rule("effacement_dette", "debt_wiped"),
    Rule("refus_effacement_dette", "wiping_refused"),
    Rule("cloture_reorganisation_judiciaire", "reorganisation_closed"),
    Rule("opposition_appel_non_avenue", "opposition_void"),
    Rule("levee_mesure", "lifted_with_roll and not lifted"),
    Rule("est capable", "capable"),
    Rule("condamnation", "sentenced"),
    Rule("sans_domicile_connu", "no_home"),
    Rule("désignation", "appointed"),
    Rule("dissolution_judiciaire", "judicial_dissolution"),
    Rule("regime_representation", "represented"),
    Rule("absent", "absence_of"),
    Rule("rétractation dissolution", "dissolution_retracted"),
    Rule("homologation_plan_apres_reforme", "plan_after_reform"),
    Rule("interdiction_exploiter", "business_forbidden"),
    Rule("mise_neant_jugement", "judgment_annulled"),
    Rule("rapporte_revocation_plan_reorganisation", "revocation_withdrawn"),
    Rule("sursis", "stay"),
    Rule("non_excusable", "not_excusable"),
    Rule("excusable", "excusable and not any_not_excusable"),
    Rule("convention_transfert", "transfer_agreed"),
    Rule("sursis_accordé_{n}_mois", "stay", number=(("stay", 1),)),
    Rule("interdiction", "forbidden or forbidding_decided or forbidding"),
    Rule("interdiction_{n}_ans", "forbidden or forbidding_decided or forbidding", number=(*_BAN, ("forbidding", 1))),
    Rule("interdiction_diriger_personne_morale", "(forbidden or forbidding_decided or forbidding) and forbidden_to_direct"),
    Rule("prolongation_sursis", "stay_prolonged"),
)
#: Tags are given once, but for a withdrawn bankruptcy, which may stand twice.
PACK = Pack(PATTERNS, RULES, distinct=False)
