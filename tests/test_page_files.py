"""The data source of stored result lists: batch, pushed conditions, stop at the first gap, and a growing stream."""

import pytest

from actaspark.sources import page_files


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "lists")
    rows = [("a", n, f"<p>a{n}</p>" + ('<a href="?x=1&page=2">2</a><a href="?x=1&page=4">4</a>' if n == 1 else "")) for n in (1, 2, 3, 4, 5)]
    rows += [("b", 1, "b1 é page=9"), ("c", 1, 'c1 <a href="?page=5">'), ("c", 2, "c2"), ("c", 3, ""), ("c", 4, "c4"), ("d", 2, "no first page")]
    page_files.write_pages(spark.createDataFrame(rows, "list string, page int, html string"), path)
    page_files.register(spark)
    return path


def found(df):
    return sorted((r["list"], r["page"]) for r in df.collect())


def test_batch(spark, store):
    df = spark.read.format("page_files").load(store)
    assert found(df) == [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 1), ("c", 1), ("c", 2)]
    assert df.filter("list = 'b'").first()["html"] == "b1 é page=9"
    assert df.rdd.getNumPartitions() == 7 and spark.read.format("page_files").option("per_task", 3).load(store).rdd.getNumPartitions() == 4
    assert found(spark.read.format("page_files").option("pages", 2).load(store)) == [("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 2)]
    assert found(spark.read.format("page_files").load(f"file://{store}/none")) == []


def test_options_choose_files(spark, store):
    df = spark.read.format("page_files").options(lists="a, c", from_page=2, to_page=3).load(store)
    assert found(df) == [("a", 2), ("a", 3), ("c", 2)] and df.rdd.getNumPartitions() == 3


def test_conditions_choose_files(spark, store):
    whole = spark.read.format("page_files").load(store)
    assert found(whole.filter("page = 2").union(whole)) == sorted([*found(whole), ("a", 2), ("c", 2)])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        conditions(spark, store)
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def conditions(spark, store):
    df = spark.read.format("page_files_pushed").load(store)
    assert df.filter("list = 'a' and page = 3").rdd.getNumPartitions() == 1
    df = spark.read.format("page_files_pushed").load(store)
    assert found(df.filter("list in ('a', 'c') and page >= 2 and page < 4")) == [("a", 2), ("a", 3), ("c", 2)]
    df = spark.read.format("page_files_pushed").load(store)
    assert found(df.filter("list = 'a' and page = 3 and html like '%a3%'")) == [("a", 3)]
    reader = page_files.PushedReader({"path": store})
    left = list(reader.pushFilters([page_files.EqualTo(("list",), "a"), page_files.GreaterThan(("page",), 2), page_files.EqualTo(("html",), "x")]))
    assert left == [page_files.EqualTo(("html",), "x")] and [p.pages for p in reader.partitions()] == [(3,), (4,)]


def test_stream_takes_what_came(spark, store, tmp_path):
    def run():
        stream = spark.readStream.format("page_files").load(store)
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(once=True).start(str(tmp_path / "out")).awaitTermination()
        return found(spark.read.parquet(str(tmp_path / "out")))

    first = run()
    assert first == found(spark.read.format("page_files").load(store))
    page_files.Store(store).write("c", 3, b"c3")
    page_files.Store(store).write("e", 1, b"e1")
    assert run() == sorted([*first, ("c", 3), ("c", 4), ("e", 1)])
    assert run() == sorted([*first, ("c", 3), ("c", 4), ("e", 1)])
