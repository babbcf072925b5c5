"""Tables that take merges, caches of files, newest files, encodings and JSON of unknown shape."""

import os
import random

import pytest
from pyspark.sql import functions as F

from actaspark.functions import variants
from actaspark.operators import merge
from actaspark.sources import cache, registry, table_store
from actaspark.sources.files import Files

ROWS = "k long, seq long, name string, address string, source string, confidence double, payload string"
FOLDS = {
    "sticky": (table_store.sticky("k", "seq", name="name", address="address", source="source", confidence="confidence", payload="payload"), lambda df: merge.sticky_fold(df, "k", "seq", "name", "address", "source", "confidence", "payload")),
    "upsert": (table_store.upsert("k", "seq", ("address", "payload")), lambda df: merge.upsert_last(df, "k", "seq", ("address", "payload"))),
}


def rows(seed, n=240):
    rng = random.Random(seed)
    return [(rng.randrange(25), i, rng.choice(["Société inconnue", "A", "B"]), rng.choice([None, "", "x", "y"]), rng.choice(["ejustice", "bce", "fallback"]), rng.random(), f"p{i}") for i in range(n)]


@pytest.mark.parametrize("name", sorted(FOLDS))
def test_batches_in_turns_and_twice_give_one_fold(spark, tmp_path, name):
    fold, closed = FOLDS[name]
    df = spark.createDataFrame(rows(4), ROWS)
    store = table_store.TableStore(spark, f"file://{tmp_path}/t", ROWS, ["k"], 3)
    done = []
    for writer, number in ((0, 0), (1, 0), (1, 0), (0, 1), (0, 0), (1, 1), (0, 2), (1, 2), (0, 2)):
        batch = df.filter((F.col("k") % 2 == writer) & (F.col("seq") >= 80 * number) & (F.col("seq") < 80 * number + 80))
        done.append(store.merge(batch, fold, str(writer), number))
    assert done == [True, True, False, True, False, True, True, True, False]
    assert store.manifest()["version"] == 6 and store.manifest()["writers"] == {"0": 2, "1": 2}
    want = closed(df)
    assert sorted(store.read().select(*want.columns).collect()) == sorted(want.collect())


def test_readers_never_see_half_a_merge(spark, tmp_path):
    store = table_store.TableStore(spark, f"file://{tmp_path}/t", "k long, v string", ["k"], 4)
    add = table_store.absent(["k"])
    batch = lambda *v: spark.createDataFrame(v, "k long, v string")
    assert store.read().collect() == []
    store.merge(batch(*[(i, "a") for i in range(20)], (None, "n")), add, "w", 0)
    before = store.read()

    def broken(old, new):
        return new.withColumn("v", F.raise_error(F.lit("lost")))

    with pytest.raises(Exception, match="lost"):
        store.merge(batch((99, "x")), broken, "w", 1)
    assert store.read().count() == 21
    seen = []

    def slow(old, new):  # another writer commits while this one folds
        if not seen:
            seen.append(store.merge(batch((50, "other")), add, "other", 0))
        return add(old, new)

    assert store.merge(batch((50, "late"), (51, "b"), (None, "again"), (3, "again")), slow, "w", 2)
    found = {r["k"]: r["v"] for r in store.read().collect()}
    assert found[50] == "other" and found[51] == "b" and found[None] == "n" and found[3] == "a" and len(found) == 23
    assert before.count() == 21  # a reader keeps its files
    store.vacuum(1)
    assert store.read().count() == 23 and len(store.files.names("manifests")) == 1
    assert {f for own in store.manifest()["buckets"].values() for f in own} == {f"data/{n}" for n in store.files.names("data")}


def test_appends_and_updates(spark, tmp_path):
    store = table_store.TableStore(spark, f"file://{tmp_path}/t", "url string, title string, tags string, n long", ["url"], 2)
    batch = lambda *v: spark.createDataFrame(v, "url string, title string, tags string, n long")
    store.merge(batch(("a", "A", None, 1), ("a", "A", None, 1), ("b", None, "x", 2)), None, "w", 0)
    store.merge(batch(("a", "A", None, 1)), None, "w", 0)
    store.merge(batch(("c", "C", None, 3)), None, "w", 1)
    assert store.read().count() == 4
    new = variants.json_safe(spark.createDataFrame([("b", "B", ["é", "y"], None), ("a", "", [], 7), ("z", "Z", ["z"], 9)], "url string, title string, tags array<string>, n long"))
    store.merge(new, table_store.updated("url", ["title", "tags", "n"]), "u", 0)
    assert sorted((r["url"], r["title"], r["tags"], r["n"]) for r in store.read().collect()) == [("a", "A", "[]", 7), ("a", "A", "[]", 7), ("b", "B", '["é","y"]', 2), ("c", "C", None, 3)]


def test_cache_reads_changed_files_alone(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name, text in (("a.txt", "1\n2\n"), ("b.txt", "3\n"), ("c.txt", "4\n"), ("skip.log", "9\n")):
        (source / name).write_text(text)
    read = []

    def files(paths):
        read.append([p.rsplit("/", 1)[1] for p in paths])
        return spark.read.text(paths)

    kept = cache.LookupCache(spark, f"file://{tmp_path}/cache", files, lambda df: df.select("_source", F.col("value").cast("long").alias("v")))
    with pytest.raises(ValueError, match="never"):
        kept.table()
    now = lambda: sorted(r["v"] for r in kept.table().collect())
    kept.refresh(f"file://{source}", "*.txt")
    assert now() == [1, 2, 3, 4] and kept.refresh(f"file://{source}", "*.txt") == []
    (source / "b.txt").write_text("30\n31\n")
    (source / "d.txt").write_text("5\n")
    (source / "c.txt").unlink()
    assert [p.rsplit("/", 1)[1] for p in kept.refresh(f"file://{source}", "*.txt")] == ["b.txt", "d.txt"]
    assert now() == [1, 2, 5, 30, 31]
    os.utime(source / "a.txt", (1, 1))  # same length, another time
    kept.refresh(f"file://{source}", "*.txt")
    (source / "d.txt").unlink()
    assert kept.refresh(f"file://{source}", "*.txt") == [] and now() == [1, 2, 30, 31]
    assert read == [["a.txt", "b.txt", "c.txt"], ["b.txt", "d.txt"], ["a.txt"]]


def test_newest_file_of_a_kind(spark, tmp_path):
    for k, name in enumerate(("missing_1.log", "missing_2.log", "failed-3.log", "other.txt")):
        (tmp_path / name).write_text(f"DOC={'a' * 64} BCE: 0123456749 {k}\nno document\n" if k != 1 else f"DOC={'b' * 64} TVA 0123.456.749\n")
        os.utime(tmp_path / name, (1000 - k, 1000 - k))
    got = {r["kind"]: r["path"].rsplit("/", 1)[1] for r in cache.newest(cache.listed(spark, f"file://{tmp_path}", "*.log")).collect()}
    assert got == {"missing": "missing_1.log", "failed": "failed-3.log"}
    os.utime(tmp_path / "missing_2.log", (2000, 2000))
    assert [tuple(r) for r in registry.newest_queue(spark, f"file://{tmp_path}").collect()] == [("a" * 64, ["0123456749"]), ("b" * 64, ["0123.456.749"])]
    (tmp_path / "none").mkdir()
    assert registry.newest_queue(spark, f"file://{tmp_path}/none").collect() == []


def test_folder_of_mixed_encodings(spark, tmp_path):
    text = "id,name\n1,Société Élan\n2,plain\n"
    for name, data in (("u.csv", text.encode()), ("bom.csv", "﻿".encode() + text.encode()), ("l.csv", text.encode("latin-1")), ("ascii.csv", b"id,name\n3,x\n"), ("empty.csv", b"")):
        (tmp_path / name).write_bytes(data)
    of = {p.rsplit("/", 1)[1]: e for p, e in registry.encodings(spark, [f"file://{tmp_path}"]).items()}
    assert of == {"u.csv": "UTF-8", "bom.csv": "UTF-8", "l.csv": "ISO-8859-1", "ascii.csv": "UTF-8"}
    got = registry.csv_any(spark, [f"file://{tmp_path}"], "id long, name string").collect()
    assert sorted((r["id"], r["name"]) for r in got) == sorted([(1, "Société Élan"), (2, "plain")] * 3 + [(3, "x")])


@pytest.mark.parametrize(
    "said, kind, values",
    [
        ('{"k": 1}', "OBJECT", ['{"k":1}']),
        ('"{\\"k\\": 1}"', "OBJECT", ['{"k":1}']),
        ('{"array": [1, "a", null]}', "ARRAY", ["1", '"a"', "null"]),
        ('"{\\"array\\": [2]}"', "ARRAY", ["2"]),
        ('{"array": 3}', "OBJECT", ['{"array":3}']),
        ("[]", "ARRAY", []),
        ('"text"', "STRING", ['"text"']),
        ("3.5", "DECIMAL", ["3.5"]),
        ("null", "VOID", []),
        ("{broken", None, []),
        (None, None, []),
    ],
)
def test_json_of_unknown_shape(spark, said, kind, values):
    df = spark.createDataFrame([(said,)], "c string").select(variants.unwrapped(F.col("c")).alias("v"))
    row = df.select(variants.kind(F.col("v")).alias("kind"), F.transform(variants.elements(F.col("v")), lambda v: F.to_json(v)).alias("e")).first()
    assert (row["kind"], row["e"]) == (kind, values)


def test_files(spark, tmp_path):
    files = Files(spark, f"file://{tmp_path}")
    assert files.create("m/1.json", "é") and not files.create("m/1.json", "other") and files.read("m/1.json") == "é"
    assert files.names("m") == ["1.json"] and files.names("none") == []
    files.rename("m/1.json", "n/2.json")
    with pytest.raises(FileNotFoundError):
        files.rename("m/1.json", "n/3.json")
