"""Enterprise courts. Where a withdrawn dissolution is found, most other tags are not looked for."""

from actaspark.operators.rules import Pack, Pattern, Rule

_T = "_tribunal_de_l_entreprise"
_AUTHORITY = r"transfert\s+sous\s+l?['’]?\s*autorit[ée]\s+(?:judiciaire|de\s+justice)"

# Fixed values.
PATTERNS = {
    "annulled": Pattern(r"\bmis\s+à\s+néant\s+le\s+jugement", head=400),
    "assembly_annulled": Pattern(r"(?:prononc[ée]e?|d[ée]cid[ée]e?)\s+l[’']?annulation\s+de\s+la\s+d[ée]cision\s+de\s+l[’']?assembl[ée]e\s+g[ée]n[ée]rale", needs="annulation"),
    "liquidator_replaced": Pattern(r"a\s+été\s+d[ée]sign[ée]?\s*,?\s*en\s+remplacement\s+de\s+[^,]+,\s*en\s+qualit[ée]\s+de\s+liquidateur", needs="liquidateur"),
    "liquidator_appointed": Pattern(r"\ba\s+(?:été\s+)?d[ée]sign[ée]?(?:\s*,?\s*en\s+remplacement\s+de\s+\w+)?.{0,80}?\ben\s+qualit[ée]\s+de\s+liquidateur\b", needs="liquidateur"),
    "liquidator_named": Pattern(r"\b(?:nomm[ée]?|désign[ée]?)\b.{0,50}?\bliquidateur\b", needs="liquidateur"),
    "withdrawn": Pattern(r"\brapporte\s+(la\s+)?faillite(s)?(\s+\w+)?", needs="rapporte"),
    "withdrawn_later": Pattern(r"\best\s+rapportée(s)?(\s+.*)?", flags="(?Ud)", needs="rapportée"),
    "withdrawal_ordered": Pattern(r"\bordonne\s+de\s+rapporter\s+la\s+faillite(s)?\b", needs="rapporter"),
    "dissolution_withdrawn": Pattern(r"\brapport[ée]?\s+la\s+dissolution\b", needs="dissolution"),
    "designation": Pattern(r"\b[dD]ésignation\b", needs="désignation"),
    "closing": Pattern(r"\b[cC](l[oô]|olo)ture\b", needs="ture"),
    "assets_lacking": Pattern(r"\binsuffisance\s+d[’'\s]?actif\b", needs="insuffisance"),
    "dissolution_closed": Pattern(r"\bcl[oô]ture\s+de\s+la\s+dissolution\s+judiciaire\b", needs="dissolution"),
    "dissolution": Pattern(r"\bdissolution\b", needs="dissolution"),
    "bankruptcy": Pattern(r"faillite", needs="faillite"),
    "liquidation": Pattern(r"\bliquidations?\b", needs="liquidation"),
    "judicial_dissolution": Pattern(r"\bdissolution\s+judiciaire\b", needs="dissolution"),
    "dissolution_opened": Pattern(r"\bouverture\s+de\s+la\s+dissolution\s+judiciaire\b", needs="dissolution"),
    "liquidation_opened": Pattern(r"\bouverture\s+de\s+la\s+procédure\s+de\s+liquidation\s+judiciaire(?:\s+immédiate)?\b", needs="liquidation"),
    "mandatary": Pattern(r"en\s+application\s+de\s+l['’]?\s*(?:article|art\.?)\s*XX[\.\s]?(2\d{1,2}|3\d{1,2})(?:\s*(?:du\s*(?:CDE|code\s+de\s+droit\s+[ée]conomique))?)", needs="xx"),
    "liquidation_of": Pattern(r"\bliquidation(?:s)?\s*de\b", needs="liquidation"),
    "terms": Pattern(r"(délais?\s+modérés?.{0,80}article\s+5[.\s\-]?201)", needs="modéré"),
    "bankruptcy_opened": Pattern(r"\bouverture\s+de\s+la\s+faillite\b", needs="faillite"),
    "transfer_opened": Pattern(r"\bouverture\s+du\s+transfert\s+sous\s+autorit[ée]\s+judiciaire(?:\s+\w+)?", needs="transfert"),
    "transfer_opened_loose": Pattern(r"ouverture\s+du\s+transfert\s+sous\s+autorit(?:é|e)\s+judiciaire", needs="transfert"),
    "transfer_decided": Pattern(r"\ba\s+d[ée]cid[ée]?\s+de\s+d[ée]clarer\s+ouverte\s+la\s+proc[ée]dure\s+de\s+" + _AUTHORITY + r"\b", needs="transfert"),
    "transfer_declared": Pattern(r"d[ée]clar[ée]?\s+ouverte\s+la\s+proc[ée]dure\s+de\s+" + _AUTHORITY, needs="transfert"),
    "transfer_procedure": Pattern(r"\bproc[ée]dure\s+de\s+" + _AUTHORITY + r"\b", needs="transfert"),
    "transfer": Pattern(r"\b" + _AUTHORITY + r"\b", needs="transfert"),
    "ban": Pattern(r"\b(interdit[ée]?|interdiction).{0,150}?\b(exploiter|exercer|diriger|gérer|administrer).{0,100}?\b(entreprise|fonction|personne\s+morale|société)\b", needs="interdi"),
    "ban_named": Pattern(r"(?:fait\s+)?interdiction\s+(?:à\s+(?:Monsieur|Madame|Mr|Mme)?\s*)?([A-Z][a-zéèêàâïüë\-']+(?:\s+[A-Z][A-ZÉÈÊÀÂ\-']+)+)", needs="interdiction"),
    "wiping": Pattern(r"\b(?:\(?[eE]\)?[\s:\.-]*)?effacement\b", needs="effacement"),
    "refusal": Pattern(r"\brefus[ée]?\b", needs="refus"),
    "no_wiping": Pattern(r"\bsans\s+effacement\s+de\s+la\s+faillite\s+de\b[.:]?\s*", needs="effacement"),
    "partial_wiping": Pattern(r"(?:\b[lL]['’]?\s*)?[eé]ffacement\s+partiel\b", needs="partiel"),
    "wiping_of": Pattern(r"\beffacement\s+de\s+la\s+faillite\s+de\b[.:]?\s*", needs="effacement"),
    "wiping_granted_to": Pattern(r"\boctroie\s+l['’]effacement\s+à\b[.:]?\s*", needs="effacement"),
    "wiping_granted": Pattern(r"(l['’]?\s*)?effacement\s+(est\s+)?accordé", needs="effacement"),
    "judge_replaced": Pattern(r"est\s+remplac[ée]?\s+par\s+le\s+juge\s+commissaire", needs="commissaire"),
    "judges_replaced": Pattern(r"est\s+remplac[ée]?\s+par\s+(le|les)\s+juges?\s+commissaires?", needs="commissaire"),
    "administrator_replaced": Pattern(r"(curateur|liquidateur|administrateur).*?remplac[ée]?(?:\s+à\s+sa\s+demande)?\s+par", needs="remplac"),
    "mandate_prolonged": Pattern(r"\bprolong\w*\s+le\s+mandat\b.{0,120}?\badministrateur\s+provisoire\b", needs="prolong"),
    "administrator_appointed": Pattern(r"d[ée]sign[ée]?\s+(?:[^,]{0,100})?\ben\s+qualit[ée]\s+d['’]?\s*administrateur(?:s)?\s+provisoire(?:s)?(?:\s+des?\s+\w+)?", needs="provisoire"),
    "administrator_discharged": Pattern(r"\bd[ée]charge\s+(?:de\s+l['’]?\s*)?administrateur(?:s)?\s+provisoire(?:s)?\b", needs="provisoire"),
    "bankruptcy_declared": Pattern(r"(faillite|faillite\s+de\s*:?.{0,80}?(déclar[ée]e?|prononc[ée]e?))|\bfaillite\b.{0,80}?(déclar[ée]e?|prononc[ée]e?)", needs="faillite"),
    "cessation_moved": Pattern(r"report[\s\w,.'’():\-]{0,80}?cessation\s+des\s+paiements", needs="cessation"),
    "reorganisation_opened": Pattern(r"\bouverture\s+de\s+la\s+réorganisation\s+judiciaire\b", needs="réorganisation"),
    "reorganisation_extended": Pattern(r"\bprorogation\s+du\s+sursis\s+de\s+la\s+réorganisation\s+judiciaire\b", needs="réorganisation"),
    "new_plan": Pattern(r"\bautorisation\s+de\s+d[ée]p[oô]t\s+d['’]un\s+nouveau\s+plan\s+de\s+la\s+réorganisation\s+judiciaire\b", needs="réorganisation"),
    "plan_approved": Pattern(r"\bhomologation\s+du\s+plan\s+de\b", needs="homologation"),
    "settlement_approved": Pattern(r"\bhomologation\s+de\s+l[’']accord\s+amiable\s+de\b", needs="homologation"),
    "plan_revoked": Pattern(r"révocation\s+du\s+plan\s+de\s+réorganisation\s+judiciaire", needs="révocation"),
    "plan_refused": Pattern(r"(?:refus[ée]?\s+(?:d['’]homologation|l['’]homologation)\s+du\s+plan).{0,200}?(?:cl[oô]tur[ée]?\s+(?:la\s+)?proc[ée]dure\s+de\s+r[ée]organisation\s+judiciaire)", needs="homologation"),
    "reorganisation_of": Pattern(r"\bréorganisation\s+judiciaire\s+de\b", needs="réorganisation"),
    "collective_agreement": Pattern(r"réorganisation\s+judiciaire\s+par\s+accord\s+collectif", needs="collectif"),
    "administrator": Pattern(r"administrateur\s+provisoire\s+d[ée]sign[ée]?", needs="provisoire"),
    "ordinary_administrator": Pattern(r"\b(?:a\s+)?d[ée]sign[ée]?\s+en\s+qualit[ée]\s+d['’]?administrateur(?:s)?\s+provisoire(?:s)?\s+de\s+droit\s+commun\b", needs="provisoire"),
    "assembly_suspended": Pattern(r"\b(?:ordonne\s+de\s+)?suspend(?:re)?\s+les\s+effets?\s+à\s+l?['’]?égard\s+des\s+tiers\s+de\s+la\s+publication(?:\s+aux?\s+annexes?\s+du\s+moniteur\s+belge)?[\s\S]*?proc[èe]s[-\s]?verbaux\s+des?\s+assembl[ée]es?\s+g[ée]n[ée]rales?", needs="suspend"),
    "excusable": Pattern(r"\ble\s+failli\s+est\s+déclaré\s+excusable\b[\.]?\s*", needs="excusable"),
}
_ELSE = "not dissolution_withdrawn"


def _rule(tag: str, when: str, chain: str | None = None) -> Rule:
    return Rule(tag, when, chain, _ELSE)


RULES = (
    Rule("annulation_jugement" + _T, "annulled"),
    Rule("annulation_decision_ag" + _T, "assembly_annulled"),
    Rule("designation_liquidateur_remplacement" + _T, "liquidator_replaced", "liquidator"),
    Rule("designation_liquidateur" + _T, "liquidator_appointed or liquidator_named", "liquidator"),
    Rule("rapporte_faillite" + _T, "withdrawn or withdrawn_later or withdrawal_ordered"),
    Rule("rapporte_dissolution" + _T, "dissolution_withdrawn"),
    _rule("designation" + _T, "designation"),
    _rule("cloture_insuffisance_actif" + _T, "closing and assets_lacking"),
    _rule("cloture_dissolution" + _T, "closing and dissolution_closed"),
    _rule("cloture_dissolution" + _T, "closing and dissolution"),
    _rule("cloture_faillite" + _T, "closing and bankruptcy", "closed"),
    _rule("cloture_liquidation" + _T, "closing and liquidation", "closed"),
    _rule("dissolution_judiciaire" + _T, "judicial_dissolution"),
    _rule("ouverture_dissolution_judiciaire" + _T, "dissolution_opened"),
    _rule("ouverture_liquidation_judiciaire" + _T, "liquidation_opened"),
    _rule("designation_mandataire" + _T, "mandatary"),
    _rule("liquidation" + _T, "liquidation_of"),
    _rule("delai_modere" + _T, "terms"),
    _rule("ouverture_faillite" + _T, "bankruptcy_opened", "opened"),
    _rule("ouverture_transfert_autorite_judiciaire" + _T, "transfer_opened or transfer_opened_loose or transfer_decided or transfer_declared", "opened"),
    _rule("transfert_autorite_judiciaire" + _T, "transfer_procedure or transfer", "opened"),
    _rule("interdiction_gestion" + _T, "ban or ban_named"),
    _rule("effacement_refusé" + _T, "wiping and refusal", "wiped"),
    _rule("sans_effacement" + _T, "no_wiping", "wiped"),
    _rule("effacement_partiel" + _T, "partial_wiping", "wiped"),
    _rule("effacement" + _T, "wiping_of or wiping_granted_to or wiping_granted", "wiped"),
    _rule("remplacement_juge_commissaire" + _T, "judge_replaced or judges_replaced", "replaced"),
    _rule("remplacement_administrateur" + _T, "administrator_replaced", "replaced"),
    _rule("prolongation_administrateur" + _T, "mandate_prolonged", "administrator"),
    _rule("designation_administrateur_provisoire" + _T, "administrator_appointed", "administrator"),
    _rule("decharge_administrateur_provisoire" + _T, "administrator_discharged", "administrator"),
    _rule("ouverture_faillite" + _T, "bankruptcy_declared and not before('cloture', 'ouverture')", "administrator"),
    _rule("report_cessation_paiement" + _T, "cessation_moved"),
    _rule("ouverture_reorganisation" + _T, "reorganisation_opened"),
    _rule("prorogation_reorganisation" + _T, "reorganisation_extended"),
    _rule("nouveau_plan_reorganisation" + _T, "new_plan"),
    _rule("homologation_plan" + _T, "plan_approved", "plan"),
    _rule("homologation_accord_amiable" + _T, "settlement_approved", "plan"),
    _rule("revocation_plan_reorganisation_judicaire" + _T, "plan_revoked", "plan"),
    _rule("refus_hologation_revocation_plan_reorganisation_judicaire" + _T, "plan_refused"),
    _rule("reorganisation" + _T, "reorganisation_of and not (reorganisation_opened or reorganisation_extended or new_plan or plan_approved or settlement_approved or plan_revoked)"),
    _rule("reorganisation_judiciaire_par_accord_collectif" + _T, "collective_agreement"),
    _rule("designation_administrateur_provisoire" + _T, "administrator"),
    _rule("designation_administrateur_provisoire_droit_commun" + _T, "ordinary_administrator"),
    _rule("suspension_effets_ag", "assembly_suspended"),
    _rule("excusable" + _T, "excusable"),
)
#: Repeated tags stay, as they do in the source of the rules; ``array_distinct`` gives the other view.
PACK = Pack(PATTERNS, RULES, distinct=False)
