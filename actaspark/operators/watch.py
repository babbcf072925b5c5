"""Stored watches: which are due, what they match, and what is new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .merge import insert_if_absent

# The groups of decision tags that searches offer.
KEYWORD_GROUPS = {
    "procedures_collectives": [
        "rapporte_faillite", "rapporte_faillite_tribunal_de_l_entreprise", "rapporte_dissolution_tribunal_de_l_entreprise", "dissolution_judiciaire",
        "dissolution_judiciaire_tribunal_de_l_entreprise", "cloture_liquidation", "cloture_liquidation_tribunal_de_l_entreprise",
        "cloture_faillite_tribunal_de_l_entreprise", "cloture_reorganisation_judiciaire", "ouverture_liquidation_judiciaire_tribunal_de_l_entreprise",
        "ouverture_faillite_tribunal_de_l_entreprise", "liquidation_tribunal_de_l_entreprise", "effacement_dette", "effacement_partiel_tribunal_de_l_entreprise",
        "effacement_tribunal_de_l_entreprise", "sans_effacement_tribunal_de_l_entreprise", "refus_effacement_dette", "delai_modere_tribunal_de_l_entreprise", "non_excusable",
    ],
    "administration_mandataires": [
        "designation_liquidateur_remplacement_tribunal_de_l_entreprise", "designation_liquidateur_tribunal_de_l_entreprise",
        "remplacement_juge_commissaire_tribunal_de_l_entreprise", "remplacement_administrateur_tribunal_de_l_entreprise",
        "designation_mandataire_tribunal_de_l_entreprise", "prolongation_administrateur_tribunal_de_l_entreprise",
        "designation_administrateur_provisoire_tribunal_de_l_entreprise", "designation_administrateur_provisoire_droit_commun_tribunal_de_l_entreprise",
        "decharge_administrateur_provisoire_tribunal_de_l_entreprise", "report_cessation_paiement_tribunal_de_l_entreprise", "fin_de_mission", "désignation",
    ],
    "decisions_judiciaires": [
        "reforme_mise_a_neant", "reforme_ordonnance", "reforme_jugement", "reforme_decision_jp", "mise_a_neant", "mise_neant_jugement",
        "homologation_plan_apres_reforme", "retractation_dissolution", "annulation_decision_AG", "annulation_decision_ag_tribunal_de_l_entreprise",
        "levee_mesure", "levee_mesure_observation", "fin_mesure", "sursis", "rejet_demande", "condamnation", "non_excusable",
    ],
    "radiations_bce_ubo": [
        "retrait_radiation_non_depot_comptes", "retrait_ou_annulation_radiation_office", "annulation_ou_retrait_radiation_ubo", "radiation_office_ubo",
        "radiation_adresse_siege", "liste_radiations_adresse_siege", "annulation_ou_arret_radiation_adresse_siege",
        "annulation_ou_arret_radiation_succursale_siege", "annulation_doublon", "annulation_remplacement_numero_doublon", "remplacement_numero_bce",
        "correction_date_radiation_adresse_siege_ou_succursale", "ouverture_transfert_autorite_judiciaire_tribunal_de_l_entreprise",
        "transfert_autorite_judiciaire_tribunal_de_l_entreprise",
    ],
}


def decision_types() -> dict[str, list[str]]:
    """The eight kinds of decision that a watch can name, and their tags."""
    tags = [t for group in KEYWORD_GROUPS.values() for t in group]
    prefix = lambda p: [t for t in tags if t.startswith(p)]
    part = lambda p: [t for t in tags if p in t]
    return {
        "ouverture": prefix("ouverture_"),
        "cloture": prefix("cloture_"),
        "faillite": part("faillite"),
        "liquidation": [t for t in part("liquidation") if not t.startswith(("ouverture_", "cloture_"))],
        "dissolution": part("dissolution"),
        "effacement": part("effacement"),
        "radiation": part("radiation"),
        "condamnation": [t for t in tags if t == "condamnation"],
    }


def tag_suggestions(query: str) -> list[tuple[str, str]]:
    """(tag, group) of the tags that contain the query; a tag in two groups belongs to the first."""
    out: dict[str, str] = {}
    for group, tags in KEYWORD_GROUPS.items():
        for t in tags:
            if query.lower() in t.lower():
                out.setdefault(t, group)
    return list(out.items())


def is_due(recurrence: Column, last_scan: Column, as_of: Column) -> Column:
    """daily: not scanned on that day; weekly and monthly: 7 and 30 days ago or never; others: never."""
    age = F.datediff(as_of, last_scan)
    due = F.when(recurrence == "daily", age.isNull() | (F.to_date(last_scan) != F.to_date(as_of)))
    due = due.when(recurrence == "weekly", age.isNull() | (age >= 7)).when(recurrence == "monthly", age.isNull() | (age >= 30))
    return due.otherwise(F.lit(False))


#: So many terms are looked for by one expression; more by an automaton.
FEW_TERMS, MOST_TERMS, MOST_FREE = 32, 1_000_000, 10_000


def terms_in(documents: DataFrame, terms: list[str]) -> DataFrame:
    """(id, date_doc, term) of the terms that each haystack has: one scan of the texts, whatever the number of watches."""
    if len(terms) <= FEW_TERMS:
        listed = F.array(*[F.lit(x) for x in terms]).cast("array<string>")
        return documents.select("id", "date_doc", F.explode(F.filter(listed, lambda x: F.contains("haystack", x))).alias("term"))
    schema = T.StructType([documents.schema["id"], documents.schema["date_doc"], T.StructField("term", T.StringType())])

    def scan(batches):
        import ahocorasick
        import pyarrow as pa

        found = ahocorasick.Automaton()
        for x in terms:
            found.add_word(x, x)
        found.make_automaton()
        for batch in batches:
            rows, said = [], []
            for row, text in enumerate(batch.column("haystack").to_pylist()):
                own = sorted({x for _, x in found.iter(text)}) if text else []
                rows += [row] * len(own)
                said += own
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("date_doc").take(at), pa.array(said, pa.string())], names=["id", "date_doc", "term"])

    return documents.select("id", "date_doc", "haystack").mapInArrow(scan, schema)


def _bounded(rows: DataFrame, most: int, what: str) -> list:
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} {what}")
    return found


def matches(watches: DataFrame, documents: DataFrame, unknown_type_matches: bool = False) -> DataFrame:
    """(watch_id, id): watches (watch_id, date_from, tags, street, keyword; nulls don't filter) against
    decisions (id, date_doc, tags, haystack).

    Watches with tags meet decisions by tag, and only texts of what meets are read again for street and keyword. Streets and
    keywords of the others are found by one scan for all of them, and met by term. Watches that filter by date alone
    match nearly everything; they must be few (``MOST_FREE``), as must distinct terms (``MOST_TERMS``), or an error says so.
    A watch whose tags are an empty list is of an unknown type: it matches nothing, or with ``unknown_type_matches`` as
    if it named none."""
    if unknown_type_matches:
        watches = watches.withColumn("tags", F.when(F.size("tags") > 0, F.col("tags")))
    late = F.col("date_from").isNull() | (F.col("date_doc") >= F.col("date_from"))
    w = watches.select("watch_id", "date_from", "tags", F.lower("street").alias("street"), F.lower("keyword").alias("keyword"))
    tagged = w.filter("tags is not null").select("watch_id", "date_from", "street", "keyword", F.explode("tags").alias("tag"))
    met = documents.select("id", "date_doc", F.explode("tags").alias("tag")).join(tagged, "tag").filter(late).select("watch_id", "id", "street", "keyword").distinct()
    plain = met.filter("street is null and keyword is null").select("watch_id", "id")
    worded = met.filter("street is not null or keyword is not null").join(documents.select("id", "haystack"), "id")
    has = lambda c: F.col(c).isNull() | F.contains("haystack", F.col(c))
    out = plain.unionByName(worded.filter(has("street") & has("keyword")).select("watch_id", "id"))
    free = w.filter("tags is null")
    terms = [r["term"] for r in _bounded(free.select(F.explode(F.array("street", "keyword")).alias("term")).filter("term is not null").distinct(), MOST_TERMS, "terms of watches without tags")]
    if terms:
        asked = free.select("watch_id", "date_from", F.array_distinct(F.array_compact(F.array("street", "keyword"))).alias("terms"))
        asked = asked.filter(F.size("terms") > 0).select("watch_id", "date_from", F.size("terms").alias("n"), F.explode("terms").alias("term"))
        met = terms_in(documents, sorted(terms)).join(asked, "term").filter(late)
        out = out.unionByName(met.groupBy("watch_id", "id", "n").agg(F.count(F.lit(1)).alias("k")).filter("k = n").select("watch_id", "id"))
    always = _bounded(free.filter("street is null and keyword is null").select("watch_id", "date_from"), MOST_FREE, "watches that only filter by date")
    if always:
        listed = F.array(*[F.struct(F.lit(r["watch_id"]).cast(watches.schema["watch_id"].dataType).alias("watch_id"), F.lit(r["date_from"]).cast(watches.schema["date_from"].dataType).alias("date_from")) for r in always])
        out = out.unionByName(documents.select("id", "date_doc", F.explode(listed).alias("w")).select("w.*", "id", "date_doc").filter(late).select("watch_id", "id"))
    return out


def new_events(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Events that aren't stored yet, by (watch, company, type, date, source); a null company equals a null one."""
    admissible = found.filter(F.coalesce("source", F.lit("")) != "").filter(F.coalesce("numero_tva", F.lit("")) != "INCONNU")
    return insert_if_absent(existing, admissible, ["watch_id", "numero_tva", "type", "date_publication", "source"])


def dashboard(events: DataFrame, watch: str, company: str, kind: str) -> DataFrame:
    """Counts of both kinds of event per (watch, company), with a total row for each watch."""
    counts = [F.count_if(F.col(kind) == k).alias(f"n_{k.lower()}") for k in ("ANNEXE", "DECISION")]
    return events.rollup(watch, company).agg(*counts, F.grouping(company).alias("is_total")).filter(F.col(watch).isNotNull())


def within_quota(watches: DataFrame, user: str, order: str, premium: Column, basic: int = 1, most: int = 10) -> DataFrame:
    """The first watches of each user, as many as the user may have."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(user).orderBy(order))
    return watches.withColumn("_rank", rank).filter(F.col("_rank") <= F.when(premium, most).otherwise(basic)).drop("_rank")


def set_last_scan(watches: DataFrame, scanned: DataFrame, as_of: Column) -> DataFrame:
    """The watches with the time of a scan for those (watch_id) that were scanned."""
    done = scanned.select("watch_id").distinct().withColumn("_done", F.lit(True))
    return watches.join(done, "watch_id", "left").withColumn("last_scan", F.when(F.col("_done"), as_of).otherwise(F.col("last_scan"))).drop("_done")


def watches_of(watches: DataFrame, events: DataFrame, user: str) -> DataFrame:
    """A user's watches, newest first, each with its events in a list, newest first; none is an empty list."""
    event = F.struct("date_publication", *[c for c in events.columns if c not in ("watch_id", "date_publication")])
    lists = events.groupBy("watch_id").agg(F.sort_array(F.collect_list(event), asc=False).alias("events"))
    own = watches.filter(F.col("user") == user).join(lists, "watch_id", "left")
    return own.withColumn("events", F.coalesce("events", F.array())).orderBy(F.desc("created"), "watch_id")


def is_complete(kind: Column, keyword: Column, tags: Column, street: Column, companies: Column) -> Column:
    """Whether a watch's form names what it looks for: companies, or at least one of keyword, tags and street."""
    said = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    return F.when(kind == "VAT", some(companies)).otherwise(said(keyword) | some(tags) | said(street))


def set_recurrence(watches: DataFrame, recurrence: Column, weekday: Column) -> DataFrame:
    """A weekday is kept for weekly watches only."""
    return watches.withColumns({"recurrence": recurrence, "recurrence_weekday": F.when(recurrence == "weekly", weekday)})
