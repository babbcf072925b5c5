"""Patterns that several packs use."""

# Fixed values.
DATE = r"(?:\d{1,2}(?:er)?\s+\w+\s+\d{4}|\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{2,4})"
DATE_OPTIONAL = rf"(?:\s+du\s+{DATE})?"
NUMBER = r"(?:\d{1,2}|un|une|deux|trois|quatre|cinq|six|sept|huit|neuf|dix|onze|douze|quinze|vingt)"
LIFTED = r"lev[ée]e\s+de\s+la\s+mesure(?:\s+de\s+protection)?"
LIFTED_WITH_ROLL = rf"lev[ée]e\s+de\s+la\s+mesure(?:\s+de\s+protection)?[^.,:\n]{{0,80}}{DATE_OPTIONAL}[^.\n]{{0,50}}\(RG"
REFORMED_AND_ANNULLED = rf"réforme\s+et\s+met\s+à\s+néant\s+la\s+d[ée]cision{DATE_OPTIONAL}(?:,\s+du\s+juge\s+de\s+paix)?"
ANNULLED = rf"\bmet\s+à\s+néant\s+la\s+d[ée]cision{DATE_OPTIONAL}"
REFORMED_ORDER = r"r[ée]forme\s+l[’']?ordonnance"
DISCHARGED = r"\bd[ée]charg(?:é(?:e|es|s)?|er)?\s+(?:[^.\n]{0,120})?\bde\s+(?:sa|la)\s+mission\s+(?:d['’]|de\s+)(?:curateur|liquidateur|administrateur(?:\s+[a-zà-öø-ÿ'’\-]{1,20}){0,6})"
CIVIL_CODE = r"art(?:\.|icl[ée])?s?\s+\d{1,4}(?:/\d{1,3})?(?:-\d+)?\s*(?:d['’]?(?:u|la)?)?\s+(?:code\s+civil|c\.\s*civ(?:il)?)"
SENTENCED = r"\b(?:condamn[ée]?(?:es)?|emprisonnement|réclusion|peine\s+privative\s+de\s+liberté)\b"
APPOINTED = r"[,:\s]*\bdésign(?:é|ée|ation)\b(.*?)(?:en\s+qualité\s+de\s+)?\b(?:administrateur|administratrice|curateur|liquidateur)\b"
JUDICIAL_DISSOLUTION = r"\bdissolution\s+judiciaire\b"
OBSERVATION_LIFTED = r"\bl[èe]ve\s+la\s+mesure\s+d[’']?observation\b"
LIQUIDATION_CLOSED = r"\bcl[ôo]ture\s+de\s+(?:la\s+)?liquidation(?:\s+judiciaire)?\b"
#: Dots also cross line ends.
ALL = "(?iUds)"
