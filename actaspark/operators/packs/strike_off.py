"""Registry strike-offs: the first of six decisive patterns ends the search."""

from actaspark.operators.rules import Pack, Pattern, Rule

from . import common as c

_LIST = r"liste\s+des\s+entit[ée]s?\s+enregistr[ée]es?"
_LISTED = r"liste\s+des\s+entit[ée]s\s+enregistr[ée]es"
_HEAD = 450

# Fixed values.
PATTERNS = {
    "accounts_withdrawn": Pattern(_LIST + r".{0,200}?retrait\s+de\s+la\s+radiation\s+d['’]?\s*office.{0,200}?pour\s+(le\s+)?non[-\s]?d[ée]p[oô]t.{0,80}?comptes\s+annuels", flags=c.ALL, needs="radiation"),
    "address_stopped": Pattern(_LIST + r".{0,120}?(arr[êe]t|arret|annulation|retrait)\s+de\s+la\s+radiation\s+d['’]?\s*office\s+(de|de\s+l['’]?)?\s*(adresse|si[èe]ge|succursale)", head=_HEAD, needs="radiation"),
    "owners_annulled": Pattern(_LIST + r".{0,500}?(?:à\s+l['’]\s*|au\s+)?(annulation|arr[êe]t|retrait)\s+(?:de\s+la\s+)?radiation.{0,300}?(?:d['’]?\s*)?office.{0,200}?(ubo|formalit[ée]s?\s+ubo)", flags=c.ALL, needs="ubo"),
    "office_withdrawn": Pattern(_LIST + r".{0,300}?(?:au\s+)?(annulation|arr[êe]t|retrait)\s+(?:de\s+la\s+)?radiation.{0,200}?(?:d['’]?\s*)?office", needs="radiation"),
    "address_listed": Pattern(_LIST + r".{0,100}?(adresse\s+du\s+(si[èe]ge|siege|siège)|succursale).{0,80}?radi[ée]e?", head=_HEAD, needs="radi"),
    "owners_struck": Pattern(_LIST + r".{0,150}?((ayant\s+fait\s+l['’]?objet|faisant\s+l['’]?objet)|pour\s+lesquelles\s+il\s+a\s+été\s+proc[ée]d[ée]).{0,120}?radiation\s+d['’]?office.{0,100}?(ubo|formalit[ée]s?\s+ubo)", head=_HEAD, flags=c.ALL, needs="ubo"),
    "duplicate_annulled": Pattern(r"pour\s+cause\s+de\s+dou+blons?.{0,100}?a\s+été\s+an+ul+ée", needs="blon"),
    "duplicate_replaced": Pattern(_LISTED + r".{0,100}?remplacement\s+du\s+num[ée]ro\s+d['’]entreprise.{0,80}?pour\s+cause\s+de\s+dou+blons?.{0,80}?a\s+été\s+an+ul+é", needs="blon"),
    "number_replaced": Pattern(r"remplac[ée]?\s+.{0,60}?num(é|e)ro\s+d['’]entreprise", needs="remplac"),
    "office_done": Pattern(r"la\s+radiation\s+d['’]?office\s+des\s+entit[ée]s?\s+suivantes.{0,80}?a\s+été\s+effectu[ée]e", needs="radiation"),
    "address_struck": Pattern(r"entit[ée]s?\s+enregistr[ée]es?.{0,100}?adresse\s+du\s+si[èe]ge.{0,60}?a\s+été\s+radi[ée]e", needs="adresse"),
    "seat_annulled": Pattern(_LISTED + r".{0,120}?(annulation|arr[êe]t)\s+de\s+la\s+radiation\s+d['’]office.{0,60}?l['’]adresse\s+du\s+si[eè]ge", needs="radiation"),
    "branch_annulled": Pattern(_LISTED + r".{0,120}?(annulation|arr[êe]t|retrait)\s+de\s+la\s+radiation\s+d['’]office.{0,60}?l['’]adresse\s+de\s+la\s+succursale", needs="succursale"),
    "owners_withdrawn": Pattern(r"(annulation|arr[êe]t|retrait)\s+de\s+la\s+radiation.{0,80}?office.{0,80}?non[- ]?respect.{0,80}?formalit[ée]s?.{0,80}?ubo", needs="ubo"),
    "accounts_withdrawn_later": Pattern(r"(annulation|arr[êe]t|retrait)\s+de\s+la\s+radiation.{0,80}?office.{0,80}?pour.{0,40}?non[-\s]?d[ée]p[oô]t.{0,80}?comptes\s+annuels", needs="comptes"),
    "date_corrected": Pattern(_LISTED + r".{0,120}?correction\s+de\s+la\s+date.{0,80}?prise\s+d['’]?effet.{0,80}?r?adiation.{0,80}?office.{0,80}?adresse\s+(du\s+si[eè]ge|de\s+la\s+succursale)", needs="correction"),
}
_OPEN = "not (accounts_withdrawn or address_stopped or owners_annulled or office_withdrawn or address_listed or owners_struck)"
RULES = (
    Rule("retrait_radiation_non_depot_comptes", "accounts_withdrawn", chain="decisive"),
    Rule("arret_ou_annulation_radiation_adresse_siege", "address_stopped", chain="decisive"),
    Rule("annulation_ou_retrait_radiation_ubo", "owners_annulled", chain="decisive"),
    Rule("retrait_ou_annulation_radiation_office", "office_withdrawn", chain="decisive"),
    Rule("liste_radiations_adresse_siege", "address_listed", chain="decisive"),
    Rule("radiation_office_ubo", "owners_struck", chain="decisive"),
    Rule("annulation_doublon", "duplicate_annulled", guard=_OPEN),
    Rule("annulation_remplacement_numero_doublon", "duplicate_replaced", guard=_OPEN),
    Rule("remplacement_numero_bce", "number_replaced", guard=_OPEN),
    Rule("radiation_office_effectuee", "office_done", guard=_OPEN),
    Rule("radiation_adresse_siege", "address_struck", guard=_OPEN),
    Rule("annulation_ou_arret_radiation_adresse_siege", "seat_annulled", guard=_OPEN),
    Rule("annulation_ou_arret_radiation_succursale_siege", "branch_annulled", guard=_OPEN),
    Rule("retrait_radiation_ubo", "owners_withdrawn", guard=_OPEN),
    Rule("retrait_radiation_non_depot_comptes", "accounts_withdrawn_later", guard=_OPEN),
    Rule("correction_date_radiation_adresse_siege_ou_succursale", "date_corrected", guard=_OPEN),
)
#: Texts are cut, as the patterns look at the head of a list.
PACK = Pack(PATTERNS, RULES, distinct=False, cut=1500)
