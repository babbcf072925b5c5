"""Queries of what a front end asks, of registry filters and of article selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from actaspark.functions import text
from actaspark.operators import service
from actaspark.operators.search import SearchSchema
from actaspark.plans.catalogue import query
from actaspark.sources import registry


@query("""SELECT o_orderkey::VARCHAR AS url, CASE WHEN o_custkey % 5 = 0 THEN '' ELSE o_orderpriority END AS title, CASE WHEN o_custkey % 3 = 0 THEN '' ELSE o_orderdate::DATE::VARCHAR END AS date_document,
CASE WHEN o_custkey % 2 = 0 THEN NULL ELSE o_custkey::VARCHAR END AS bce, o_custkey % 5 > 0 AS has_title FROM orders WHERE o_custkey % 2 = 0 OR o_orderstatus = 'F'""")
def q70_api_records(t):
    """Decisions as records, by a filter on attributes that filter, of attributes that are displayed."""
    rows = t("orders").select(
        F.col("o_orderkey").cast("string").alias("url"),
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderpriority")).alias("title"),
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_orderdate").cast("date")).alias("date_doc"),
        F.when(F.col("o_custkey") % 2 != 0, F.array(F.col("o_custkey").cast("string"), F.lit("x"))).alias("TVA"),
        F.array(F.col("o_orderstatus")).alias("keyword"),
        F.lit(None).cast("string").alias("text"),
        F.array(F.when(F.col("o_custkey") % 2 == 0, "even").otherwise("odd")).alias("extra_keyword"),
        F.lit("hidden").alias("lang"),
    )
    schema = SearchSchema()
    some = service.displayed(rows.filter(service.filterable([["extra_keyword = even", "keyword = F"]], schema, dict(rows.dtypes))), schema)
    return service.api_record(some).select("url", "title", "date_document", "bce", (F.col("title") != "").alias("has_title"))


@query("""SELECT o_orderpriority || ' ' || o_clerk AS keyword, length(o_orderpriority || ' ' || o_clerk) <= 100 AND len(string_split(o_orderpriority || ' ' || o_clerk, ' ')) <= 5 AS ok, count(*) AS n
FROM (SELECT o_orderpriority, repeat('w ', (o_custkey % 5)::INT) || repeat('x', (o_orderkey % 110)::INT) || 'y' AS o_clerk FROM orders) GROUP BY ALL""")
def q71_keyword_limits(t):
    """P20: profile keywords by length and words."""
    said = F.concat(F.col("o_orderpriority"), F.lit(" "), F.repeat(F.lit("w "), (F.col("o_custkey") % 5).cast("int")), F.repeat(F.lit("x"), (F.col("o_orderkey") % 110).cast("int")), F.lit("y"))
    rows = t("orders").select(said.alias("keyword"))
    return rows.groupBy("keyword", service.keyword_ok(F.col("keyword")).alias("ok")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH d AS (SELECT * FROM supplier WHERE s_nationkey % 3 IN (0, 1)) SELECT (SELECT count(DISTINCT s_nationkey) FROM supplier WHERE s_suppkey % 2 = 0 AND s_nationkey % 3 IN (0, 1)) AS n_before,
(SELECT count(DISTINCT s_nationkey) FROM d) - (SELECT count(DISTINCT s_nationkey) FROM supplier WHERE s_suppkey % 2 = 0 AND s_nationkey % 3 IN (0, 1)) AS n_created, (SELECT count(DISTINCT s_nationkey) FROM d) AS n_total""")
def q72_registry_counts(t):
    """Numbers of the registry rows of allowed types and languages, before and after more rows came."""
    kinds = F.array(F.lit("001"), F.lit(" 002 "), F.lit("003"))
    rows = t("supplier").select(F.col("s_nationkey").cast("string").alias("EntityNumber"), F.get(kinds, F.col("s_nationkey") % 3).alias("TypeOfDenomination"), F.lit("1").alias("Language"), "s_suppkey")
    few = registry.chosen(rows, TypeOfDenomination=["001", "002"], Language=["1"])
    return service.added(registry.enterprise_numbers(few.filter("s_suppkey % 2 = 0")), registry.enterprise_numbers(few), "bce")


@query(r"""WITH d AS (SELECT doc_id AS id, CASE WHEN lang IN ('fr', 'es') THEN lang END AS tag, trim(regexp_replace(strip_accents(lower(text)), '\s+', ' ', 'g')) AS t FROM documents)
SELECT id FROM d WHERE tag = 'fr' AND contains(t, 'que de') UNION SELECT id FROM d WHERE tag IN ('fr', 'es') AND contains(t, 'de la')""")
def q73_street_fallback(t):
    """Matches of one query and, of the same tags, those that only a second one finds."""
    docs = t("documents").select(F.col("doc_id").alias("id"), F.when(F.col("lang").isin("fr", "es"), F.array("lang")).alias("tags"), "text")
    first = service.street_fallback(docs.select("id").limit(0), docs, "QUE de", ["fr"])
    return service.street_fallback(first, docs, "De  lá", ["fr", "es"])


@query(r"""SELECT page_id, page_id % 4 <> 3 AS has_article, CASE WHEN page_id % 4 = 3 THEN NULL ELSE sha256(regexp_extract(html, '(?s)<article>(.*?)</article>', 1)) END AS inside FROM pages""")
def q74_article_selection(t):
    """The article of publication pages, whose element is named by a class among others; pages without one have none."""
    inside = F.regexp_extract("html", r"(?s)<article>(.*?)</article>", 1)
    tag = F.when(F.col("page_id") % 4 == 0, '<main class="page__inner page__inner--content article-text">').when(F.col("page_id") % 4 == 1, "<MAIN id=x class='article-text'>").when(F.col("page_id") % 4 == 2, '<main\nclass = "a article-text">').otherwise('<main class="article-texts">')
    page = F.concat(F.lit("<script>'<main class=\"article-text\">'</script><nav>x</nav>"), tag, inside, F.when(F.col("page_id") % 3 == 0, "</main ><footer>y</footer>").otherwise("</main>"))
    found = text.article_html(page)
    return t("pages").select("page_id", found.isNotNull().alias("has_article"), F.sha2(found, 256).alias("inside"))


@query("SELECT row_number() OVER (ORDER BY lower(p_name)) AS id, lower(p_name) AS name, arg_min(p_name, p_partkey) AS label FROM part GROUP BY lower(p_name)")
def q75_street_index(t):
    """Distinct names with dense ids in their order; the first spelling is shown."""
    return registry.street_index(t("part"), "p_name", "p_partkey")
