"""From fetched pages to decisions: bronze (pages), silver (extracts), gold (decisions), and quality tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaspark.functions import dates, ids, text
from actaspark.operators import enrich, mandataries, merge, parties, quality, rules
from actaspark.operators.judgment_date import judgment_date
from actaspark.operators.packs import appeal, enterprise, first_instance, strike_off

# Fixed value: estates of the dead are not followed.
ESTATES = r"(?iU)\bsuccessions?\s*(?:de|vacantes?|en\s+d[ée]sh[ée]rences?)\b"
#: The packs of each stream, in order; rules of one may look at the tags of those before it.
PACKS = {
    "first_instance": (first_instance.PACK, enterprise.PACK),
    "enterprise": (enterprise.PACK,),
    "appeal": (enterprise.PACK, appeal.PACK, first_instance.PACK),
    "registry": (strike_off.PACK,),
}
#: Each pack is evaluated once, after the packs whose tags its rules look at.
EVALUATED = (first_instance.PACK, enterprise.PACK, appeal.PACK, strike_off.PACK)
COURTS = ("first_instance", "enterprise", "appeal")


def bronze(links: DataFrame, pages: DataFrame, article_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """Links of a valid date with their pages, and the dead letters: no page, no text or a bad date. With
    ``article_only`` the text is that of the page's article element, and a page without one has none."""
    joined = links.join(pages, "url", "left")
    if article_only:
        joined = joined.withColumn("html", F.when(F.col("html").isNotNull(), F.coalesce(text.article_html(F.col("html")), F.lit(""))))
    rows = joined.withColumn("text", text.html_text("html")).drop("html")
    good = dates.is_valid_date(F.col("date_doc")) & (F.coalesce("text", F.lit("")) != "")
    reason = F.when(~dates.is_valid_date(F.col("date_doc")), "date").when(F.col("text").isNull(), "page").otherwise("text")
    return rows.filter(good), rows.filter(~good).select("url", reason.alias("reason"))


def _joined(stream: Column, tags: list[Column], before: int | None = None) -> Column:
    """The tags of a row's packs in its stream's order, or of those that stand there before pack ``before``."""
    out = F.array().cast("array<string>")
    for name, own in PACKS.items():
        places = [EVALUATED.index(p) for p in own]
        if before is not None:
            places = places[: places.index(before)] if before in places else []
        if places := [k for k in places if k < len(tags)]:
            out = F.when(stream == name, F.concat(*[tags[k] for k in places])).otherwise(out)
    return out


def silver(rows: DataFrame, contact_gate: bool = False, names: DataFrame | None = None) -> DataFrame:
    """Numbers, hash, tags, date of judgment and administrators of bronze rows with their stream.

    The gates (a court or registry text needs a number; estates are left out of two courts) come before the
    costly extraction, and each stream only runs its own packs. With ``contact_gate`` texts of the first
    instance that give a term of contact get no enterprise tags. With a dictionary ``names`` (nom) there are ``administrators`` too:
    listed names near key words merged with those found by pattern."""
    rows = rows.withColumn("TVA", F.transform(ids.extract_numbers(F.col("text")), lambda n: ids.format_number(n)))
    needs = F.col("stream").isin(*PACKS)
    estate = F.col("stream").isin("first_instance", "appeal") & F.col("text").rlike(ESTATES)
    rows = rows.filter((~needs | (F.size("TVA") > 0)) & ~estate)
    rows = rows.withColumn("id", text.content_hash(F.col("date_doc"), F.col("text")))
    done: list[Column] = []
    for k, pack in enumerate(EVALUATED):
        wanted = F.col("stream").isin(*[s for s, own in PACKS.items() if pack in own])
        if contact_gate and pack is enterprise.PACK:
            wanted = wanted & ~((F.col("stream") == "first_instance") & F.exists(done[0], lambda t: F.startswith(t, F.lit("délai de contact"))))
        rows = rows.withColumn("_own", F.when(wanted, F.col("text")))
        rows = rules.with_tags(rows, pack, "_own", f"_tags{k}", _joined(F.col("stream"), done, k))
        done.append(F.col(f"_tags{k}"))
    tags = _joined(F.col("stream"), done)
    court = F.col("stream").isin(*COURTS)
    rows = rows.withColumns({"extra_keyword": tags, "date_jugement": F.when(F.col("stream").isin(*PACKS), judgment_date(F.col("text"))), "administrateur": parties.administrators(F.when(court, F.col("text")))})
    rows = rows.drop("_own", *[f"_tags{k}" for k in range(len(EVALUATED))])
    return rows if names is None else with_administrators(rows, names)


def with_administrators(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Silver rows of the courts with ``administrators``; the others, and texts without any, have an empty list.

    Only ids and texts of the courts go through the look-up, each text once."""
    found = []
    for streams, words in ((("first_instance", "enterprise"), mandataries.KEYWORDS), (("appeal",), mandataries.KEYWORDS[:-1])):
        own = rows.filter(F.col("stream").isin(*streams)).select("id", "text").dropDuplicates(["id"])
        found.append(mandataries.mandataries(own, "id", "text", names, words).select("id", F.lit(len(found)).alias("_kind"), "mandataries"))
    kind = F.when(F.col("stream").isin("first_instance", "enterprise"), 0).when(F.col("stream") == "appeal", 1)
    joined = rows.withColumn("_kind", kind).join(found[0].unionByName(found[1]), ["id", "_kind"], "left")
    none = F.array().cast("array<struct<nom:string,role:string>>")
    by_rule = F.coalesce("administrateur", F.array().cast("array<struct<role:string,entity:string,raw:string>>"))
    return joined.withColumn("administrators", mandataries.merged(F.coalesce("mandataries", none), by_rule)).select(*rows.columns, "administrators")


def gold(extracts: DataFrame, companies: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """Decisions: one row per id, enriched from the registry. The text stays out of the enrichment's shuffles."""
    own = merge.keep_one(extracts.withColumn("date_doc", F.col("date_doc").cast("date")), "id", "date_doc", seq)
    found = enrich.enrich(own.select("id", "TVA", F.array_distinct("extra_keyword").alias("tags")), companies).drop("TVA", "tags")
    return own.join(found, "id", "left").withColumn("extra_keyword_flatten", F.array_join("extra_keyword", ", "))


def quality_tables(extracts: DataFrame, decisions: DataFrame) -> dict[str, DataFrame]:
    return {
        "dq_missing_fields": quality.missing_fields(decisions.select("id", "date_doc", "text", "url", "keyword", "TVA", "title"), ["date_doc", "text", "url", "keyword", "TVA", "title"]).filter(F.size("missing") > 0).select("id", "missing"),
        "dq_invalid_id": quality.invalid_numbers(decisions, "id", "TVA"),
        "dq_missing_registry": quality.unresolved(decisions),
        "dq_duplicates": extracts.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"),
    }


def flat_export(decisions: DataFrame) -> DataFrame:
    """One row for each decision and number, nested columns as JSON; decisions without a number have none."""
    kinds = dict(decisions.dtypes)
    nested = [c for c in decisions.columns if kinds[c].startswith(("array", "struct", "map")) and c != "TVA"]
    rows = decisions.withColumns({c: F.to_json(c) for c in nested})
    return rows.select(F.explode_outer("TVA").alias("tva"), *[c for c in rows.columns if c != "TVA"])


def provenance_log(hits: DataFrame) -> DataFrame:
    """Of (doc_id, tag, item, generic, start, seq) one line for each document: specific before generic, then
    the longest, then the first."""
    best = F.min_by(F.struct("tag", "item", "start"), F.struct(F.col("generic").cast("int"), -F.length("item"), F.col("seq")))
    return hits.groupBy("doc_id").agg(best.alias("b")).select("doc_id", "b.*")
