"""Queries of dates as scans have them, letters of all scripts, mergeable sketches and joins on time."""

from __future__ import annotations

from pyspark.sql import functions as F

from actaspark.functions import dates, text, unicode
from actaspark.operators import daily_sketches, time_joins
from actaspark.plans.catalogue import query
from actaspark.plans.shared import shared_dir

#: Spellings of the months, and words that are none.
_SPELT = "janiver fevr. marsr avri mai juiin juiller a0ut setpembre ocotbre novenbre decrmbre feurier aoüt JUILL. Décembr".split()
_NO_MONTH = "maison tout mas jui abricot".split()


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % {len(_SPELT) + len(_NO_MONTH)} < {len(_SPELT)} THEN make_date(year(o_orderdate), [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 2, 8, 7, 12, 1][(o_orderkey % {len(_SPELT) + len(_NO_MONTH)} + 1)::INT], (o_orderkey % 28 + 1)::INT) ELSE make_date(1999, 3, 1) END AS day FROM orders""")
def q61_misspelt_months(t):
    """dates whose month is misspelt; words that are no month are passed over for the next date."""
    words = F.array(*[F.lit(w) for w in _SPELT + _NO_MONTH])
    k = F.col("o_orderkey")
    word = F.element_at(words, (k % (len(_SPELT) + len(_NO_MONTH)) + 1).cast("int"))
    said = F.concat_ws(" ", F.lit("Acte du"), (k % 28 + 1).cast("string"), word, F.year("o_orderdate").cast("string"), F.lit("ou 1er  mars 1999, 2 avril 2001"))
    return t("orders").select("o_orderkey", dates.scanned_date(said).alias("day"))


@query("SELECT doc_id, sha256(strip_accents(text || chr(10) || 'Łódź Ζάκυνθος Žižek ệ e' || chr(769) || ' n' || chr(771) || ' ' || coalesce(source, ''))) AS bare FROM documents")
def q62_without_marks(t):
    """letters without marks in Polish, Greek and decomposed texts."""
    added = F.concat(F.col("text"), F.lit("\nŁódź Ζάκυνθος Žižek ệ é ñ "), F.coalesce("source", F.lit("")))
    return t("documents").select("doc_id", F.sha2(unicode.without_marks(added), 256).alias("bare"))


@query("SELECT p_partkey, translate(p_name, 'aeiou', 'áèîöŭ') AS said, strip_accents(translate(p_name, 'aeiou', 'áèîöŭ')) = p_name AS is_name FROM part WHERE contains(strip_accents(lower(p_name)), 'ring')")
def q63_loose_contains(t):
    """Containment and equality but for case and marks, by collation."""
    said = F.translate("p_name", "aeiou", "áèîöŭ")
    return t("part").filter(unicode.contains(said, "RÏNG")).select("p_partkey", said.alias("said"), unicode.same(said, F.upper("p_name")).alias("is_name"))


@query("SELECT event_type, count(*)::BIGINT AS n, count(DISTINCT user_id) AS n_users, true AS users_near, true AS median_near FROM events WHERE ts >= TIMESTAMP '2024-01-06' GROUP BY event_type")
def q64_daily_sketches(t):
    """2.12f: sketches stored by day, merged to a period, within their stated errors of exact counts."""
    e = t("events")
    path = shared_dir(e.sparkSession, "days")
    daily_sketches.by_day(e, "ts", ["event_type"], "user_id", "value").write.partitionBy("day").parquet(path)
    period = daily_sketches.merged(e.sparkSession.read.parquet(path), ["event_type"], F.col("day") >= F.lit("2024-01-06").cast("date"))
    guess = period.select("event_type", "n", daily_sketches.distinct_of(F.col("items")).alias("users"), daily_sketches.quantile_of(F.col("values"), 0.5).alias("median"))
    own = e.filter("ts >= timestamp_ntz'2024-01-06'").join(guess.select("event_type", "median"), "event_type")
    exact = own.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"), F.avg((F.col("value") <= F.col("median")).cast("int")).alias("rank"))
    near = F.abs(F.col("users") - F.col("n_users")) <= F.ceil(daily_sketches.DISTINCT_ERROR * F.col("n_users"))
    return exact.join(guess, "event_type").select("event_type", "n", "n_users", near.alias("users_near"), (F.abs(F.col("rank") - 0.5) <= daily_sketches.RANK_ERROR).alias("median_near"))


_TIMES_SQL = "placed AS (SELECT o_custkey AS user_id, TIMESTAMP '2024-01-01' + to_minutes((o_orderkey * 7919 % 43200)::BIGINT) AS placed_at, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL)"


def _placed(t):
    at = F.timestamp_add("MINUTE", (F.col("o_orderkey") * 7919 % 43200).cast("int"), F.lit("2024-01-01").cast("timestamp"))
    return t("orders").groupBy(F.col("o_custkey").alias("user_id"), at.alias("placed_at")).agg(F.max("o_orderkey").alias("o_orderkey"))


@query(f"WITH {_TIMES_SQL} SELECT e.event_id, p.o_orderkey, p.placed_at FROM events e ASOF LEFT JOIN placed p ON e.user_id = p.user_id AND e.ts >= p.placed_at")
def q65_as_of(t):
    """2.12e: events with the last order that their user had placed."""
    found = time_joins.as_of(t("events").select("event_id", "user_id", "ts"), _placed(t), ["user_id"], "ts", "placed_at", ["o_orderkey", "placed_at"])
    return found.select("event_id", "o_orderkey", F.col("placed_at").cast("timestamp_ntz").alias("placed_at"))


@query(f"WITH {_TIMES_SQL} SELECT e.event_id, p.o_orderkey FROM events e JOIN placed p ON e.user_id = p.user_id AND e.ts BETWEEN p.placed_at AND p.placed_at + to_minutes((p.o_orderkey % 5000)::BIGINT)")
def q66_within(t):
    """2.12e: events within the times that their user's orders are open, minutes to days long."""
    orders = _placed(t).withColumn("until", F.timestamp_add("MINUTE", (F.col("o_orderkey") % 5000).cast("int"), "placed_at"))
    return time_joins.within(t("events").select("event_id", "user_id", "ts"), "ts", orders, "placed_at", "until", ["user_id"]).select("event_id", "o_orderkey")


@query("""SELECT s_suppkey, 'Acte. Déclaration d''acceptation de ' || s_name || ' Succession en déshérence Déclaration d''acceptation de B' AS said FROM supplier""")
def q67_scan_cleaners(t):
    """Repeated paragraphs and phrases, and brackets of the bar, as scans have them."""
    one = F.concat(F.lit("Déclaration d'acceptation de "), F.col("s_name"), F.lit(" Succession en déshérence "))
    said = F.concat(F.lit("Acte.\n"), one, F.lit("succession en déshérence \n"), F.lit("Déclaration d'acceptation de B (Av. Nom 3)"), F.lit("\t"), one, F.lit("Déclaration d'acceptation de B "))
    return t("supplier").select("s_suppkey", text.once_each(text.estate_once(text.without_bar(said))).alias("said"))
