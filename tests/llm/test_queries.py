"""Every registered query of the subpackage, and the pipeline, over a small folder of tables."""

import hashlib
import re
import zlib
from array import array
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from actaspark.llm import packing, queries
from actaspark.plans.shipping import shipped

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tables(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = docs.dropDuplicates(["doc_id"])
    rows.write.parquet(f"{path}/documents.parquet")
    labels = rows.select("doc_id", F.when(F.col("doc_id") % 9 != 8, (F.col("doc_id") % 3 == 0).cast("int")).alias("toxic"))
    labels.unionByName(labels.limit(3)).write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def texts(spark, tables):
    rows = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text", "source").collect()
    return {r["doc_id"]: r["text"] or "" for r in sorted(rows, key=lambda r: r["doc_id"])}


def result(spark, tables, name):
    rows = shipped(queries.queries()[name])(spark, tables).collect()
    return rows, {r["doc_id"]: r for r in rows}


@pytest.mark.parametrize("name", ["op1_toxic_segments", "op2_crf_language"])
def test_models(spark, tables, texts, name):
    rows, by = result(spark, tables, name)
    assert len(rows) == len(texts) and set(by) == set(texts)
    for i, r in by.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        if name.startswith("op1"):
            assert r["predicted"] == int(r["score"] >= 0.5)
        else:
            assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in texts[i]))
            assert r["lang_pred"] in {"en", "fr", "de", "und"}


def test_secrets(spark, tables, texts):
    rows, by = result(spark, tables, "op3_blob_ledger")
    assert len(rows) == len(texts)
    for i, t in texts.items():
        found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 8]
        found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        said = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))
        n = Counter(f[2] for f in found)
        assert (by[i]["n_assign"], by[i]["n_access"], by[i]["n_hex"]) == (n["assign"], n["access"], n["hex"])
        assert by[i]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_token_ids(spark, tables, texts):
    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    plain = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    _, planes = result(spark, tables, "op4_token_planes")
    start = 0
    for i, ids in plain.items():
        own = array("I", [*ids, 2])
        assert (planes[i]["start"], planes[i]["n_tokens"], planes[i]["ids_crc32"]) == (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)
    pieces, _ = result(spark, tables, "op8_power_of_two_packing")
    assert len({p["sequence_id"] for p in pieces}) == len(pieces)
    for i, ids in plain.items():
        own, at = array("I", [*ids, 1]), 0
        for p in sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"]):
            assert (p["start"], p["offset"], p["doc_tokens"]) == (at, 0, len(own)) and p["length"] in {1 << b for b in range(12)}
            assert p["ids_crc32"] == zlib.crc32(own[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(own)


def test_lines(spark, tables):
    rows, _ = result(spark, tables, "op5_simhash_lines")
    assert rows


def test_media(spark, tables, texts):
    rows, by = result(spark, tables, "op6_png_media")
    assert len(rows) == len(texts)
    for i, t in texts.items():
        data = t.encode()
        payload = data.ljust(max(1, -(-len(data) // 192)) * 192)
        got = by[i]
        assert (got["n_bytes"], got["payload_bytes"], got["payload_sha256"], got["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))


def test_near_documents(spark, tables, texts):
    rows, by = result(spark, tables, "op7_bbit_minhash")
    sets = {}
    for i, t in texts.items():
        words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t))
        sets[i] = {tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))} if words else set()
    group = {i: i for i in texts}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    assert len(rows) == len(texts)
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in by.items()} == {i: (len(sets[i]), group[i], group[i] == i) for i in texts}


def test_mix(spark, tables, texts):
    rows, by = result(spark, tables, "op9_weighted_mix")
    assert {i: r["size"] for i, r in by.items()} == {i: len(WORD.findall(t)) for i, t in texts.items()}
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, result(spark, tables, "op9_weighted_mix")[0]), key=str)


def test_sketches(spark, tables, texts):
    """Likeness by plain sets of single shingles' hashes."""
    from actaspark.llm.sketches import shingle_hashes

    def plain(text):
        data = text.encode()
        every = {int(shingle_hashes(data[k : k + 16])[0]) for k in range(max(1, len(data) - 15))} if data else set()
        limit = 0xFFFFFFFF // 32
        if len([h for h in every if h <= limit]) < 32:
            limit = 0xFFFFFFFF if len(every) <= 32 else max(limit, sorted(every)[31])
        return limit, {h for h in every if h <= limit}

    def alike(a, b):
        limit = min(a[0], b[0])
        x, y = ({h for h in s[1] if h <= limit} for s in (a, b))
        return len(x & y) / min(len(x), len(y)) if x and y else float(a == b)

    _, by = result(spark, tables, "op10_scaled_sketch")
    ids = list(texts)
    for i, after in zip(ids, ids[1:] + ids[:1]):
        if len(texts[i]) > 20_000 or len(texts[after]) > 20_000:
            continue
        t, half = texts[i], len(texts[i]) // 2
        edited = t[: len(t) - half] + texts[after][:half]
        assert by[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and by[i]["n_chars"] == len(t)
        assert by[i]["near_edited"] == pytest.approx(alike(plain(t), plain(edited)))
        assert by[i]["near_next"] == pytest.approx(alike(plain(t), plain(texts[after])))


def test_pipeline_run(spark, tables, texts):
    got = corpus_pipeline.run(spark, tables)
    rows = got.collect()
    assert {r["doc_id"] for r in rows} <= {i for i, t in texts.items() if any(c.isalpha() for c in t)}
    assert rows and len({r["sequence_id"] for r in rows}) == len(rows)


def test_buckets_as_files(spark, tables, tmp_path):
    pieces = packing.pack(spark.read.parquet(f"{tables}/documents.parquet"), queries.tokenizer_file())
    packing.write_buckets(pieces, f"{tmp_path}/buckets")
    back = spark.read.parquet(f"{tmp_path}/buckets")
    assert back.filter("length <> shiftleft(1L, bucket)").count() == 0
    key = ("doc_id", "start", "length", "bucket", "ids")
    assert sorted(back.select(*key).collect(), key=str) == sorted(pieces.select(*key).collect(), key=str)
