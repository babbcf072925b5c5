"""Queries of stored files, tables that take merges, caches and JSON of unknown shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from actaspark.functions import variants
from actaspark.plans import catalogue
from actaspark.plans.catalogue import query
from actaspark.plans.shared import shared_dir
from actaspark.sources import cache, page_files, registry, table_store

_LISTS_SQL = """(WITH n AS (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS list, page_id, html FROM pages),
m AS (SELECT list, row_number() OVER (PARTITION BY list ORDER BY page_id) AS page, CASE WHEN page_id % 11 = 0 THEN '' ELSE html END AS html, page_id FROM n),
s AS (SELECT list, coalesce(min(page) FILTER (WHERE html = ''), 1000000) AS stop, count(*) AS n FROM m GROUP BY list)
SELECT list, page, length(html) + CASE WHEN page = 1 THEN length('<a href="?page=' || n || '">') ELSE 0 END AS n_chars FROM m JOIN s USING (list) WHERE page < stop)"""


def _page_store(t) -> tuple[SparkSession, str]:
    pages = t("pages").select(F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("list"), "page_id", "html")
    place = F.row_number().over(Window.partitionBy("list").orderBy("page_id"))
    number = F.count(F.lit(1)).over(Window.partitionBy("list"))
    link = F.when(F.col("page") == 1, F.concat(F.lit('<a href="?page='), F.col("n").cast("string"), F.lit('">'))).otherwise("")
    rows = pages.select("list", place.alias("page"), number.alias("n"), "page_id", "html")
    path = shared_dir(pages.sparkSession, "lists")
    page_files.write_pages(rows.select("list", "page", F.when(F.col("page_id") % 11 != 0, F.concat("html", link)).otherwise("").alias("html")), path)
    page_files.register(pages.sparkSession)
    return pages.sparkSession, path


@query(f"SELECT 'batch' AS mode, * FROM {_LISTS_SQL} UNION ALL SELECT 'stream', * FROM {_LISTS_SQL} UNION ALL SELECT 'pages 2 to 3', * FROM {_LISTS_SQL} WHERE page IN (2, 3)")
def q55_page_files(t):
    """Lists of stored pages through a data source, up to the first empty page; whole, by number, as a stream."""
    spark, path = _page_store(t)
    stored = spark.read.format("page_files").option("per_task", 8).load(path)
    stream = spark.readStream.format("page_files").option("per_task", 8).load(path)
    out = shared_dir(spark, "listed")
    stream.writeStream.format("parquet").option("checkpointLocation", f"{out}-state").trigger(once=True).start(out).awaitTermination()
    shown = lambda df, mode: df.select(F.lit(mode).alias("mode"), "list", "page", F.length("html").alias("n_chars"))
    some = spark.read.format("page_files").options(from_page=2, to_page=3).load(path)
    return shown(stored, "batch").unionByName(shown(spark.read.schema(stored.schema).parquet(out), "stream")).unionByName(shown(some, "pages 2 to 3"))


_EVENT_ROWS = "user_id long, seq int, nom string, adresse string, source string, confidence double, payload string"


def _events(t) -> DataFrame:
    """Rows of the sticky merge, as in ``q21_upsert_fold``."""
    m = F.col("event_id")
    return t("events").select(
        "user_id",
        F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("seq"),
        F.when(m % 4 == 0, "Société inconnue").otherwise(F.concat(F.lit("N"), (m % 7).cast("string"))).alias("nom"),
        F.when(m % 5 == 0, F.lit(None).cast("string")).when(m % 5 == 1, "").otherwise(F.concat(F.lit("A"), (m % 9).cast("string"))).alias("adresse"),
        F.when(F.col("event_type") == "purchase", "ejustice").when(F.col("event_type") == "view", "fallback").otherwise("bce").alias("source"),
        F.col("value").alias("confidence"),
        F.col("props").alias("payload"),
    )


@query(catalogue.SQL["q21_upsert_fold"])
def q56_table_merges(t):
    """K7, M2, M6: two writers' batches, some of them twice and in turns, merged into a stored table; what one fold gives."""
    rows = _events(t)
    store = table_store.TableStore(rows.sparkSession, shared_dir(rows.sparkSession, "companies"), _EVENT_ROWS, ["user_id"], 4)
    fold = table_store.sticky("user_id", "seq", name="nom", address="adresse", source="source", confidence="confidence", payload="payload")
    for writer, number in ((0, 0), (1, 0), (0, 0), (1, 1), (0, 1), (1, 0), (0, 1)):
        own = rows.filter((F.col("user_id") % 2 == writer) & ((F.col("seq") <= 30) if number == 0 else (F.col("seq") > 30)))
        store.merge(own, fold, f"w{writer}", number)
    return store.read().drop("seq")


@query("SELECT source, CASE WHEN source IN ('src1', 'src3') THEN count(*) * 2 ELSE count(*) END AS n, CASE WHEN source IN ('src1', 'src3') THEN sum(n_chars) * 2 ELSE sum(n_chars) END::BIGINT AS total, source IN ('src1', 'src3') AS read_again FROM documents WHERE source <> 'src5' GROUP BY source")
def q57_lookup_cache(t):
    """A lookup over one file for each source; two files grow and one goes, and only the two are read again."""
    docs = t("documents").select("source", "n_chars")
    spark, path = docs.sparkSession, shared_dir(docs.sparkSession, "sources")
    from actaspark.sources.files import Files

    docs.repartition("source").write.partitionBy("source").json(path)
    kept = cache.LookupCache(spark, f"{path}-cache", lambda paths: spark.read.schema("n_chars long").json(paths), lambda df: df.groupBy("_source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("total")))
    kept.refresh(path, "*.json")
    docs.filter("source in ('src1', 'src3')").repartition("source").write.mode("append").partitionBy("source").json(path)
    Files(spark, path).delete("source=src5")
    again = kept.refresh(path, "*.json")
    named = kept.table().withColumn("source", F.regexp_extract("_source", "source=([^/]*)/", 1)).withColumn("again", F.col("_source").isin(again))
    return named.groupBy("source").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.bool_or("again").alias("read_again"))


@query("""SELECT sha256('d' || (c_custkey % 50) || '-' || kind) AS doc_id, string_agg(DISTINCT lpad((c_custkey * 7)::VARCHAR, 10, '0'), ',' ORDER BY lpad((c_custkey * 7)::VARCHAR, 10, '0')) AS bces
FROM customer, (VALUES ('missing'), ('failed')) k(kind) WHERE c_custkey % 2 = 1 GROUP BY ALL""")
def q58_newest_queue(t):
    """Of two kinds of log the newest file is the work queue."""
    c = t("customer")
    spark, path = c.sparkSession, shared_dir(c.sparkSession, "logs")
    from actaspark.sources.files import Files

    files = Files(spark, path)
    for turn in (0, 1):  # the later files hold odd customers
        for kind in ("missing", "failed"):
            doc = F.sha2(F.concat(F.lit("d"), (F.col("c_custkey") % 50).cast("string"), F.lit(f"-{kind}")), 256)
            line = F.concat(F.lit("DOC="), doc, F.lit(" | BCE: "), F.lpad((F.col("c_custkey") * 7).cast("string"), 10, "0"))
            folder = f"{path}/{turn}-{kind}"
            c.filter(F.col("c_custkey") % 2 == turn).select(line.alias("value")).coalesce(1).write.text(folder)
            (part,) = [n for n in files.names(f"{turn}-{kind}") if n.startswith("part-")]
            files.rename(f"{turn}-{kind}/{part}", f"queue/{kind}-{turn}.log")
    return registry.newest_queue(spark, f"{path}/queue").select("doc_id", F.array_join(F.array_distinct("bces"), ",").alias("bces"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'Société Élan ' ELSE 'Société Noël ' END || s_name AS denomination, CASE WHEN s_suppkey % 2 = 0 THEN 'UTF-8' ELSE 'ISO-8859-1' END AS encoding FROM supplier")
def q59_mixed_encodings(t):
    """Registry files of two encodings in one folder, each read in its own."""
    s = t("supplier")
    spark, path = s.sparkSession, shared_dir(s.sparkSession, "registry")
    for odd, name, charset in ((0, "Société Élan ", "UTF-8"), (1, "Société Noël ", "ISO-8859-1")):
        rows = s.filter(F.col("s_suppkey") % 2 == odd).select("s_suppkey", F.concat(F.lit(name), "s_name").alias("denomination"))
        rows.write.mode("append").option("encoding", charset).option("header", True).csv(path)
    return registry.csv_any(spark, [path], "s_suppkey long, denomination string").withColumnRenamed("_encoding", "encoding")


@query("""SELECT event_type, CASE event_id % 5 WHEN 0 THEN 'OBJECT' WHEN 1 THEN 'OBJECT' WHEN 2 THEN 'ARRAY' WHEN 3 THEN 'ARRAY' END AS kind, count(*) AS n,
sum(CASE event_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 2 ELSE 0 END)::BIGINT AS n_elements,
sum(CASE event_id % 5 WHEN 0 THEN k WHEN 1 THEN k WHEN 2 THEN k + event_id WHEN 3 THEN k + event_id END)::BIGINT AS total
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY ALL""")
def q60_variant_unwrap(t):
    """JSON texts, encoded once or twice, wrapped lists and broken ones, read by their types."""
    m, props = F.col("event_id") % 5, F.col("props")
    second = F.concat(F.lit('{"k": '), F.col("event_id").cast("string"), F.lit("}"))
    pair = F.concat(F.lit('{"array": ['), props, F.lit(", "), second, F.lit("]}"))
    twice = lambda c: F.concat(F.lit('"'), F.regexp_replace(c, '"', r'\\"'), F.lit('"'))
    said = F.when(m == 0, props).when(m == 1, twice(props)).when(m == 2, pair).when(m == 3, twice(pair)).otherwise(F.concat(F.lit("["), props))
    rows = t("events").select("event_type", variants.unwrapped(said).alias("v"))
    each = rows.select("event_type", variants.kind(F.col("v")).alias("kind"), variants.elements(F.col("v")).alias("e"))
    number = F.aggregate(F.transform("e", lambda v: F.try_variant_get(v, "$.k", "long")), F.lit(None).cast("long"), lambda a, b: F.coalesce(a + b, a, b))
    return each.groupBy("event_type", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("e")).alias("n_elements"), F.sum(number).alias("total"))
