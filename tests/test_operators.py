import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from actaspark.operators import company, enrich, merge, quality, search, watch
from actaspark.plans import pipeline, schemas
from actaspark.sources import pages, registry
from actaspark.streaming import watch_stream

STRONG, UNKNOWN = "ejustice", "Société inconnue"


def fold(rows):
    """The merge, row by row."""
    state = None
    for nom, adresse, source, confidence, payload in rows:
        if state is None:
            state = [nom, adresse, source, confidence, payload]
            continue
        if source == STRONG or state[0] == UNKNOWN:
            state[0] = nom
        if source == STRONG or not state[1]:
            state[1] = adresse
        if source == STRONG:
            state[2] = source
        state[3], state[4] = max(state[3], confidence), payload
    return tuple(state)


ROW = st.tuples(st.sampled_from([UNKNOWN, "A", "B"]), st.sampled_from([None, "", "x", "y"]), st.sampled_from([STRONG, "bce", "fallback"]), st.sampled_from([0.5, 0.8, 1.0]), st.sampled_from(["p", "q"]))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(ROW, min_size=1, max_size=6), min_size=1, max_size=40))
def test_sticky_fold(spark, groups):
    rows = [(k, i, *r) for k, own in enumerate(groups) for i, r in enumerate(own)]
    df = spark.createDataFrame(rows, "bce int, seq int, nom string, adresse string, source string, confidence double, json string")
    got = {r["bce"]: tuple(r)[1:] for r in merge.sticky_fold(df, "bce", "seq", "nom", "adresse", "source", "confidence", "json").collect()}
    assert got == {k: fold(own) for k, own in enumerate(groups)}


def test_keep_one_and_upserts(spark):
    df = spark.createDataFrame([("a", "2024-01-02", 1, "x"), ("a", "2024-01-02", 3, "z"), ("a", "2024-01-02", 2, "y"), ("b", "2024-01-03", 1, "new"), ("b", "2024-01-01", 2, "old")], "id string, d string, seq int, v string")
    assert {r["id"]: r["v"] for r in merge.keep_one(df, "id", "d", "seq").collect()} == {"a": "z", "b": "old"}
    old = spark.createDataFrame([(1, None, "t"), (2, "x", "t")], "w int, k string, t string")
    new = spark.createDataFrame([(1, None, "t"), (1, "x", "t"), (1, "x", "t")], "w int, k string, t string")
    assert [tuple(r) for r in merge.insert_if_absent(old, new, ["w", "k", "t"]).collect()] == [(1, "x", "t")]
    base = spark.createDataFrame([("a", "old", ["x"]), ("b", "old", None)], "id string, v string, l array<string>")
    news = spark.createDataFrame([("a", " ", []), ("b", "new", ["y"])], "id string, v string, l array<string>")
    assert {r["id"]: (r["v"], r["l"]) for r in merge.patch(base, news, "id", ["v", "l"]).collect()} == {"a": ("old", ["x"]), "b": ("new", ["y"])}
    watches, events = merge.delete_cascade(spark.createDataFrame([(1,)], "watch_id int"), "watch_id", spark.createDataFrame([(1,), (2,)], "watch_id int"), spark.createDataFrame([(1, "e"), (3, "f")], "watch_id int, e string"))
    assert [r[0] for r in watches.collect()] == [2] and [r[0] for r in events.collect()] == [3]


def companies(spark):
    make = spark.createDataFrame
    ent = make([("0123.456.749", "2"), ("0200.065.765", "2"), ("0400000183", "1")], schemas.ENTERPRISE)
    den = make([("0123.456.749", "001", "1", "EXEMPLE DEUX (015)"), ("0123.456.749", "001", "1", "EXEMPLE UN"), ("0200.065.765", "001", "1", "VILLE")], schemas.DENOMINATION)
    blank = (None,) * 3
    adr = make([("0123.456.749", "REGO", None, None, "1000", None, "Bruxelles", None, "Rue A", "1", None, None), ("2.000.000.001", "BAET", None, None, "4000", None, "Liège", None, "Rue B", "2", "3", None)], schemas.ADDRESS)
    est = make([("0123.456.749", "2.000.000.001"), ("0123.456.749", "2.000.000.002")], schemas.ESTABLISHMENT)
    del blank
    return enrich.company_dimension(ent, den, adr, est)


def test_enrichment(spark):
    c = companies(spark)
    by = {r["bce"]: r for r in c.collect()}
    assert set(by) == {"0123.456.749", "0400.000.183"}
    assert by["0123.456.749"]["names"] == ["EXEMPLE DEUX", "EXEMPLE UN"] and by["0400.000.183"]["type"] == "physique"
    assert [(a["address"], a["source"]) for a in by["0123.456.749"]["addresses"]] == [("Rue A 1, 1000 Bruxelles", "siege"), ("Rue B 2 bte 3, 4000 Liège", "etablissement")]
    d = spark.createDataFrame([("x", ["0999.999.999", "0123.456.749"], []), ("y", ["0123.456.749"], ["annulation_doublon"]), ("z", None, None)], "id string, TVA array<string>, tags array<string>")
    got = {r["id"]: r for r in enrich.enrich(d, c).collect()}
    assert [n["bce"] for n in got["x"]["denoms_by_bce"]] == ["0123.456.749"] and got["y"]["denoms_by_bce"] is None and got["z"]["denoms_by_bce"] is None
    left = quality.unresolved(enrich.enrich(d, c)).collect()
    assert {(r["id"], r["bce"]) for r in left} == {("x", "0999.999.999"), ("y", "0123.456.749")}


def test_company_sheet(spark):
    make = spark.createDataFrame
    got = company.sheet_view(make([("a",), ("b",)], "bce string"), "bce", make([("a", 1)], "bce string, id int"), make([(1, "t")], "id int, title string"), "id", make([("a", 9)], "bce string, adm int"), make([(9, "N")], "adm int, nom string"), "adm", ["nom"])
    rows = {r["bce"]: r for r in got.collect()}
    assert rows["b"]["administrateurs"] is None and rows["b"]["title"] is None and [x["nom"] for x in rows["a"]["administrateurs"]] == ["N"]


def test_watch_scan_is_idempotent(spark):
    found = spark.createDataFrame([(1, None, "DECISION", datetime.date(2024, 1, 1), "u"), (1, "0123.456.749", "DECISION", datetime.date(2024, 1, 1), "u"), (1, "INCONNU", "ANNEXE", None, "u"), (1, "x", "ANNEXE", None, "")], "watch_id int, numero_tva string, type string, date_publication date, source string")
    first = watch.new_events(found.limit(0), found)
    assert first.count() == 2
    assert watch.new_events(first, found).count() == 0


def test_due(spark):
    as_of = datetime.datetime(2024, 1, 31, 12)
    ages = [None, 0, 1, 6, 7, 29, 30]
    rows = [(k, a, None if a is None else as_of - datetime.timedelta(days=a)) for k in ("none", "daily", "weekly", "monthly") for a in ages]
    df = spark.createDataFrame(rows, "k string, a int, last timestamp").select("k", "a", watch.is_due(F.col("k"), F.col("last"), F.lit(as_of)).alias("due"))
    due = {k: [r["a"] for r in df.collect() if r["k"] == k and r["due"]] for k in ("none", "daily", "weekly", "monthly")}
    assert due == {"none": [], "daily": [None, 1, 6, 7, 29, 30], "weekly": [None, 7, 29, 30], "monthly": [None, 30]}


def test_limit_first_loses_matches(spark):
    df = spark.range(250)
    order, hit = [F.col("id")], F.col("id") == 200
    assert search.top_then_filter(df, order, 200, hit).count() == 1
    assert search.top_then_filter(df, order, 200, hit, limit_first=True).count() == 0


def test_filters(spark):
    df = spark.createDataFrame([(1, ["a"], datetime.date(2024, 1, 1)), (2, ["b"], datetime.date(2024, 2, 1)), (3, ["c"], datetime.date(2024, 3, 1))], "id int, tags array<string>, d date")
    kinds = dict(df.dtypes)
    got = df.filter(search.filters([['tags = "a"', "tags = b"], "d >= 2024-01-15"], kinds)).collect()
    assert [r["id"] for r in got] == [2]


def test_sources(spark, tmp_path):
    html = '<div class="list-item--subtitle">Cour d\'appel</div><a href="/x?numac_search=2024000001&amp;pd_search=2024-03-01">Cour d\'appel de Liège</a><a href="?page=2">2</a><a href="?page=7">7</a>'
    lists = spark.createDataFrame([(html,)], "html string")
    links = pages.publication_links(lists, F.lit("cour d'appel"))
    row = pages.routed(links).first()
    assert (row["numac"], row["date_doc"], row["stream"], row["subtitle"]) == ("2024000001", "2024-03-01", "appeal", "Cour d'appel")
    assert lists.select(pages.page_count(F.col("html"))).first()[0] == 7
    annex = spark.createDataFrame([("0123", '<article><font>DEMISSION</font> 2024-01-05 <a href="u1">x</a></article><article><font>x</font></article>')], "societe string, html string")
    got = pages.annex_events(annex).collect()
    assert [(r["rubrique"], r["url"], r["date_publication"]) for r in got] == [("DEMISSION-NOMINATION", "u1", datetime.date(2024, 1, 5)), ("INCONNUE", None, None)]
    (tmp_path / "log.txt").write_text(f"DOC={'a' * 64} | BCE : 0123.456.749\nnothing\nDOC={'a' * 64} TVA 0400.000.183\n")
    assert registry.work_queue(spark, str(tmp_path / "log.txt")).first()["bces"] == ["0123.456.749", "0400.000.183"]
    (tmp_path / "enterprise.csv").write_text('EnterpriseNumber,TypeOfEnterprise\n"0123.456.749","2"\n')
    assert registry.csv(spark, str(tmp_path / "enterprise.csv"), schemas.ENTERPRISE).first()["TypeOfEnterprise"] == "2"
    names = spark.createDataFrame([(1, "Rue É"), (2, "rue e"), (3, "Rue B")], "seq int, n string")
    assert {r["name"]: r["label"] for r in registry.streets(names, "n", "seq").collect()} == {"rue e": "Rue É", "rue b": "Rue B"}


def test_decision_pipeline(spark):
    links = spark.createDataFrame(
        [
            ("u1", "1", "2024-03-01", "FR", "k", "Tribunal de l'entreprise", "s", "enterprise", 1),
            ("u2", "2", "2024-03-01", "FR", "k", "Tribunal de l'entreprise", "s", "enterprise", 2),
            ("u3", "3", "2024-02-31", "FR", "k", "t", "s", "enterprise", 3),
            ("u4", "4", "2024-03-02", "FR", "k", "Tribunal de première instance", "s", "first_instance", 4),
            ("u5", "5", "2024-03-02", "FR", "k", "t", "s", "appeal", 5),
        ],
        schemas.PUBLICATION_LINK + ", stream string, ingest_seq int",
    )
    body = "<main>Par jugement du 28 février 2024, ouverture de la faillite de SRL EXEMPLE UN, BCE 0123.456.749. Curateur : Maître Alice EXEMPLE.</main>"
    html = spark.createDataFrame([("u1", body), ("u2", body), ("u4", "<main>Succession vacante de M. X 0123.456.749</main>"), ("u5", "<main>sans numéro</main>")], schemas.PUBLICATION_PAGE)
    good, dead = pipeline.bronze(links, html)
    assert [(r["url"], r["reason"]) for r in dead.collect()] == [("u3", "date")]
    extracts = pipeline.silver(good)
    decisions = pipeline.gold(extracts, companies(spark))
    rows = decisions.collect()
    assert len(rows) == 1 and rows[0]["url"] == "u2" and rows[0]["TVA"] == ["0123.456.749"]
    assert rows[0]["date_jugement"]["date"] == "2024-02-28" and rows[0]["administrateur"][0]["entity"] == "Alice Exemple"
    assert "ouverture_faillite_tribunal_de_l_entreprise" in rows[0]["extra_keyword"] and rows[0]["denoms_by_bce"][0]["noms"] == ["EXEMPLE DEUX", "EXEMPLE UN"]
    dq = pipeline.quality_tables(extracts, decisions)
    assert dq["dq_duplicates"].first()["n"] == 2 and dq["dq_missing_registry"].count() == 0 and dq["dq_invalid_id"].count() == 0
    assert pipeline.flat_export(decisions).first()["tva"] == "0123.456.749"


def test_packs_of_a_stream(spark):
    text = "0123.456.749. Ouverture de la faillite de SRL EXEMPLE UN. Un sursis de six mois est accordé à la SRL EXEMPLE. Toute personne intéressée est priée de se manifester dans les trois mois."
    rows = spark.createDataFrame([(s, text, "2024-03-01") for s in ("appeal", "first_instance", "enterprise", "registry")] + [("appeal", "0123.456.749 succession de M. X", "2024-03-01")], "stream string, text string, date_doc string")
    tags = {r["stream"]: r["extra_keyword"] for r in pipeline.silver(rows).collect()}
    opened = "ouverture_faillite_tribunal_de_l_entreprise"
    assert opened in tags["appeal"] and "sursis" in tags["appeal"] and "délai de contact 3" in tags["appeal"]
    assert tags["appeal"].index(opened) < tags["appeal"].index("sursis") < tags["appeal"].index("délai de contact 3")
    assert tags["first_instance"].index("délai de contact 3") < tags["first_instance"].index(opened) and "sursis" not in tags["first_instance"]
    assert opened in tags["enterprise"] and "délai de contact 3" not in tags["enterprise"] and opened not in tags["registry"]
    gated = {r["stream"]: r["extra_keyword"] for r in pipeline.silver(rows, contact_gate=True).collect()}
    assert opened not in gated["first_instance"] and opened in gated["appeal"]
    assert pipeline.silver(rows).count() == 4


def test_stream_appends_once(spark, tmp_path):
    rows = spark.createDataFrame([(f"u{i % 4}", datetime.date(2024, 1, 1), datetime.datetime(2024, 1, 1, i), ["a", "b"]) for i in range(8)], "url string, date_doc date, time timestamp, TVA array<string>")
    for i in range(3):  # the same file three times
        rows.write.mode("append").parquet(str(tmp_path / "in"))
    watched = spark.createDataFrame([(1, "a"), (2, "a")], schemas.WATCH_COMPANY)
    stream = watch_stream.replay(spark, str(tmp_path / "in"), rows.schema)
    for k in range(2):  # and the whole stream twice
        watch_stream.start_watch(stream, watched, str(tmp_path / "out"), str(tmp_path / f"state{k}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 8


def test_resolve_company(spark):
    schema = "TVA array<string>, text string, denoms_by_bce array<struct<bce:string,noms:array<string>>>, adresses_by_bce array<struct<adresses:array<struct<address:string>>>>, adresses_by_ejustice array<struct<bce:string,nom:string,adresse:string>>, denom_fallback_bce array<struct<bce:string,noms:array<string>>>"
    rows = [
        (["0123456749"], "", [("x", ["A"])], [([("R 1",)],)], [("0400000183", "B", "S 2")], None),
        (None, "n° 0400.000.183", [("x", ["A"])], [([("R 1",)],)], None, None),
        (None, "rien", None, None, None, None),
    ]
    got = [tuple(r["c"]) for r in spark.createDataFrame(rows, schema).select(merge.resolve_company().alias("c")).collect()]
    assert got == [("0123.456.749", "A", "S 2", "ejustice", 1.0), ("0400.000.183", "A", "R 1", "bce", 0.8), (None, UNKNOWN, None, "fallback", 0.5)]


def test_company_sheet_builds_a_list_once_for_all_with_the_same_links(spark):
    make = spark.createDataFrame
    companies = make([(k,) for k in range(8)], "bce int")
    none, links = make([], "bce int, id int"), make([(k, a) for k in range(7) for a in ((9, 8), (8, 9), (9,), (9, 9), (7,))[k % 5]], "bce int, adm int")
    args = (companies, "bce", none, make([], "id int, title string"), "id", links, make([(9, "N"), (9, "M"), (8, "O")], "adm int, nom string"), "adm", ["nom"])
    want = {0: "MNO", 1: "MNO", 2: "MN", 3: "MMNN", 4: None, 5: "MNO", 6: "MNO", 7: None}
    assert {r["bce"]: r["administrateurs"] and "".join(x["nom"] for x in r["administrateurs"]) for r in company.sheet_view(*args).collect()} == want
    told = company.sheet_view(*args, lambda people: F.concat(F.array_join(people["nom"], ""), F.uuid())).collect()
    marks = {r["bce"]: r["administrateurs"] for r in told if r["administrateurs"]}
    assert {k: m[:-36] for k, m in marks.items()} == {k: w for k, w in want.items() if w} and len(set(marks.values())) == 3
