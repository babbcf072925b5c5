"""Queries of stored search, table functions and rule hits."""

from __future__ import annotations

from pyspark.sql import functions as F

from actaspark.operators import mandataries, parties, postings, rule_hits, rules
from actaspark.operators.packs import appeal, enterprise, first_instance, strike_off
from actaspark.plans.catalogue import _TAGS_SQL, _WORDS_SQL, DEMO_PACK, query
from actaspark.plans.shared import shared_dir, spread
from actaspark.plans.tag_samples import SAMPLES

_PLACED_SQL = _WORDS_SQL.replace("words AS (SELECT doc_id, rank, unnest(", "listed AS (SELECT doc_id, rank, (").replace(") AS word FROM", ") AS w FROM") + ", words AS (SELECT doc_id, rank, unnest(w) AS word, unnest(range(len(w))) AS pos FROM listed)"
_ASKED = {"licensed version repositery": (("licensed", 1), ("version", 1), ("repositery", 2)), "apache fil": (("apache", 1), ("fil", 0)), "und der th": (("und", 0), ("der", 0), ("th", 0))}


def _search_sql(k: int, asked: str) -> str:
    words = _ASKED[asked]
    good = lambda w, most: f"word = '{w}'" + (f" OR (abs(length(word) - {len(w)}) <= {most} AND levenshtein(word, '{w}') <= {most})" if most else "") + (f" OR starts_with(word, '{w}')" if w == words[-1][0] else "")
    one = " UNION ALL ".join(f"SELECT doc_id, rank, pos, '{w}' AS q, CASE WHEN word = '{w}' {f'OR starts_with(word, {w!r})' if w == words[-1][0] else ''} THEN 0 ELSE levenshtein(word, '{w}') END AS d FROM words WHERE {good(w, most)}" for w, most in words)
    last = ", ".join(f"max(CASE WHEN q = '{w}' THEN pos END) OVER (PARTITION BY doc_id, rank ORDER BY pos RANGE UNBOUNDED PRECEDING) AS l{i}" for i, (w, _) in enumerate(words))
    have = " + ".join(f"(l{i} IS NOT NULL)::INT" for i in range(len(words)))
    return f"""(WITH h{k} AS ({one}), per{k} AS (SELECT doc_id, count(*) AS n_words, sum(d)::BIGINT AS n_typos, min(rank) AS best_rank FROM (SELECT doc_id, q, min(d) AS d, min(rank) AS rank FROM h{k} GROUP BY ALL) GROUP BY doc_id),
near{k} AS (SELECT doc_id, min(greatest(pos - least({', '.join(f'l{i}' for i in range(len(words)))}) + 1 - n_words, 0)) AS proximity FROM (SELECT doc_id, pos, {last} FROM h{k}) JOIN per{k} USING (doc_id) WHERE {have} = n_words GROUP BY doc_id)
SELECT '{asked}' AS asked, doc_id AS id, n_words, n_typos, proximity, best_rank FROM per{k} LEFT JOIN near{k} USING (doc_id) ORDER BY n_words DESC, n_typos, proximity NULLS LAST, best_rank, doc_id LIMIT 20)"""


@query(f"WITH {_PLACED_SQL} " + " UNION ALL ".join(_search_sql(k, asked) for k, asked in enumerate(_ASKED)))
def q53_search_proximity(t):
    """Words, edits, nearness and attribute rank from stored postings; the last word may be a beginning."""
    docs = t("documents")
    path = shared_dir(docs.sparkSession, "postings")
    postings.build(docs, "doc_id", ("text", "source"), path)
    found = None
    for asked in _ASKED:
        own = postings.search(docs.sparkSession, path, f"={asked}").select(F.lit(asked).alias("asked"), "*")
        found = own if found is None else found.unionByName(own)
    return found


_PLACE_SQL = r"length(regexp_extract(text, '(?is)^(.*?(?:^|[^\p{{L}}]))(?:{})(?:$|[^\p{{L}}])', 1))"
_HITS_SQL = f"""(WITH {_TAGS_SQL} SELECT t.doc_id, t.tag, CASE t.tag WHEN 'lang_de' THEN {_PLACE_SQL.format('der|die|und')} WHEN 'lang_fr' THEN {_PLACE_SQL.format('les|des|une')} WHEN 'lang_es' THEN {_PLACE_SQL.format('los|las|una')}
WHEN 'lang_en' THEN {_PLACE_SQL.format('the|and|of')} WHEN 'licence' THEN strpos(lower(text), 'licensed under') - 1 WHEN 'contact' THEN length(regexp_extract(text, '(?is)^(.*?)[a-z0-9.]+@[a-z0-9.]+', 1)) WHEN 'opening_the' THEN strpos(lower(text[1:40]), 'the') - 1 END AS place
FROM (SELECT doc_id, unnest(tags) AS tag FROM tagged) t JOIN documents USING (doc_id))"""


@query(f"SELECT 'text' AS called, doc_id, tag, place FROM {_HITS_SQL} UNION ALL SELECT 'table', doc_id, tag, place FROM {_HITS_SQL} WHERE tag <> 'plain'")
def q54_rule_hits(t):
    """2.12i, X1 to X4: a table function in SQL, of texts and of a table: every tag with the place that gave it."""
    docs = t("documents")
    rule_hits.register(docs.sparkSession, {"demo": DEMO_PACK})
    return docs.sparkSession.sql(
        """SELECT 'text' AS called, d.doc_id, h.tag, h.place FROM {docs} d, LATERAL rule_hits(d.text, 'demo') h
           UNION ALL SELECT 'table', doc_id, tag, place FROM rule_hits(TABLE(SELECT doc_id, text FROM {docs}), 'demo') WHERE tag <> 'plain'""",
        docs=docs,
    )


_PACKS = {"enterprise": enterprise.PACK, "first_instance": first_instance.PACK, "appeal": appeal.PACK, "strike_off": strike_off.PACK}
_SAMPLES = [(pack, tag, said) for pack, own in SAMPLES.items() for tag, said in own.items()]
_SAMPLES_SQL = ", ".join(f"({k}, '{pack}', '{tag.replace('{n}', '%')}')" for k, (pack, tag, _) in enumerate(_SAMPLES))


@query(f"SELECT c_custkey, pack, tag, tag NOT IN ('annulation_ou_arret_radiation_adresse_siege', 'annulation_ou_arret_radiation_succursale_siege') AS given, true AS agrees FROM customer JOIN (VALUES {_SAMPLES_SQL}) s(k, pack, tag) ON c_custkey % {len(_SAMPLES)} = k")
def q68_every_tag(t):
    """Texts of every tag about customers; the packs as expressions give it, and the table function gives the same
    tags. Two tags of struck-off companies are never given: an earlier, wider rule matches whatever theirs do."""
    spark = t("customer").sparkSession
    samples = F.array(*[F.struct(*[F.lit(x) for x in s]) for s in _SAMPLES])
    s = F.element_at(samples, (F.col("c_custkey") % len(_SAMPLES) + 1).cast("int"))
    rows = spread(t("customer").select("c_custkey", s["col1"].alias("pack"), s["col2"].alias("wanted"), F.concat(s["col3"], F.lit(". ~ "), F.col("c_name")).alias("text")), "c_custkey")
    rule_hits.register(spark, _PACKS, "pack_hits")
    found = None
    for name, pack in _PACKS.items():
        own = rules.with_tags(rows.filter(F.col("pack") == name), pack)
        listed = spark.sql(f"SELECT c_custkey, tag FROM pack_hits(TABLE(SELECT c_custkey, text FROM {{own}}), '{name}')", own=own)
        listed = listed.groupBy("c_custkey").agg(F.array_sort(F.collect_set("tag")).alias("listed"))
        both = own.join(listed, "c_custkey", "left").withColumn("agrees", F.coalesce("listed", F.array()) == F.array_sort(F.array_distinct("tags")))
        found = both if found is None else found.unionByName(both)
    like = F.replace(F.col("wanted"), F.lit("{n}"), F.lit("%"))
    given = F.exists("tags", lambda x: F.like(x, like))
    return found.select("c_custkey", "pack", like.alias("tag"), given.alias("given"), "agrees")


@query("""SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL AND c_custkey % 3 > 0 THEN s_name || ':inconnu:csv:100,' ELSE '' END || CASE WHEN c_custkey % 2 = 0 THEN 'Alice Exemple:curateur:regex:50' ELSE '' END AS administrators
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey % 150""")
def q69_administrators(t):
    """Suppliers as a dictionary of names near key words, merged with curators found by pattern."""
    who = t("customer").join(t("supplier").select((F.col("s_suppkey")).alias("k"), "s_name"), F.col("k") == F.col("c_custkey") % 150, "left")
    near = F.when(F.col("c_custkey") % 3 > 0, F.lit("Maître ")).otherwise(F.concat(F.lit("Maître "), F.repeat(F.lit("x "), 200)))
    said = F.concat(F.lit("L'affaire. "), near, F.coalesce("s_name", F.lit("personne")), F.repeat(F.lit(" y"), 200), F.when(F.col("c_custkey") % 2 == 0, ". Curateur : Me Alice EXEMPLE, rue Haute 1.").otherwise("."))
    rows = spread(who.select("c_custkey", said.alias("text")), "c_custkey").withColumn("found", parties.administrators(F.col("text")))
    rows = mandataries.mandataries(rows, "c_custkey", "text", t("supplier").select(F.col("s_name").alias("nom")))
    listed = F.filter("mandataries", lambda m: m["role"] == "inconnu")
    rows = rows.select("c_custkey", mandataries.merged(listed, F.col("found")).alias("a"))
    shown = F.transform("a", lambda a: F.concat_ws(":", a["entity"], a["role"], a["origin"], a["confidence"].cast("string")))
    return rows.select("c_custkey", F.concat(F.array_join(F.filter(shown, lambda x: F.contains(x, F.lit(":csv:"))), ","), F.when(F.exists(shown, lambda x: F.contains(x, F.lit(":csv:"))), ",").otherwise(""), F.array_join(F.filter(shown, lambda x: ~F.contains(x, F.lit(":csv:"))), ",")).alias("administrators"))
