import hashlib
import io
import random
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from actaspark.llm import media, mixing, secret_ledger, sketches
from actaspark.llm.common import OrderedRanges, shared_dir


def by_id(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["doc_id"]].append(r)
    return out


def test_ordered_ranges(spark):
    big = 1 << 60
    df = spark.createDataFrame([(i * i * 7919 - 500, "x" * 50) for i in range(400)] + [(None, "y"), (big + 1, "z"), (big + 3, "z")], "doc_id long, text string")
    r = OrderedRanges(df, "doc_id", 500).snap(df)
    assert len(r.bounds) > 10
    got = df.select("doc_id", r.number().alias("n")).collect()
    for row in got:
        assert row["n"] == (0 if row["doc_id"] is None else sum(b <= row["doc_id"] for b in r.bounds))
    ids = {row["doc_id"] for row in got}
    assert set(r.bounds) <= ids


def brute_secrets(text):
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        found += [(m.start(), 0, "assign", m.end())] * (len(m[2]) >= 8)
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def test_secrets_against_brute_force():
    rng, rules = random.Random(1), secret_ledger.Rules()
    parts = ["password", "PassWd", "token", "API_KEY", "apikey", "secret", "ſecret", ":", "=", " ", '"', "'", "abc", "abcdefgh", "AKIA", "ABCDEF012345", "deadbeef" * 4, "0a1b2c3d" * 3, "é", "\n", "x"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        base = [f for f in rules.find(text) if f[0] in secret_ledger.BASE_KINDS]
        assert ",".join(f"{k}:{a}:{b}" for k, a, b in base) == brute_secrets(text), text


def test_more_secret_kinds():
    rules = secret_ledger.Rules()
    text = "-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY----- ghp_" + "z1" * 20 + " eyJhbGciOiJI.eyJzdWIiOiIx.abcdefghij"
    assert [f[0] for f in rules.find(text)] == ["private_key", "grant", "claims"]


def test_secret_digests(odd_docs, no_docs):
    got = by_id(secret_ledger.secret_digests(odd_docs))
    for r in odd_docs.collect():
        base = brute_secrets(r["text"] or "")
        for g in got[r["doc_id"]]:
            assert g["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and g["spans"] == base
            assert g["n_assign"] + g["n_access"] + g["n_hex"] == len(base.split(",")) * bool(base)
    assert sum(map(len, got.values())) == odd_docs.count()
    assert secret_ledger.secret_digests(no_docs).count() == 0


def test_ledger_is_incremental(spark):
    path = shared_dir(spark, "ledger-test")
    key = "token=abcdefgh1234"
    first = spark.createDataFrame([("a", 1, key), ("b", 1, key), ("c", 1, "nothing"), ("c", 2, None)], "path string, version int, text string")
    ledger = secret_ledger.BlobLedger(spark, path)
    ledger.scan(first)
    assert ledger.table().count() == 3
    more = first.unionByName(spark.createDataFrame([("d", 1, key), ("a", 2, "new " + key)], "path string, version int, text string"))
    ledger.scan(more)
    assert ledger.table().count() == 4
    ledger.scan(more)
    assert ledger.table().count() == 4
    hits = {(r["path"], r["version"]) for r in ledger.findings(more).filter(F.size("findings") > 0).collect()}
    assert hits == {("a", 1), ("b", 1), ("d", 1), ("a", 2)}
    newer = secret_ledger.BlobLedger(spark, path, secret_ledger.Rules(version="2"))
    newer.scan(more)
    assert newer.table().count() == 8


def test_png_filters_and_checks():
    rng = np.random.default_rng(1)
    for shape in [(1, 1), (5, 7), (4, 6, 3), (3, 5, 4), (2, 9, 2)]:
        pixels = rng.integers(0, 256, shape, np.uint8)
        for f in (0, 1, 2):
            got = media.decode_png(media.encode_png(pixels, 6, f))
            assert (got.reshape(shape) == pixels).all()
    # all five filters, written the plain way
    pixels = rng.integers(0, 256, (10, 12), np.uint8)
    lines, step = bytearray(), 3
    for y in range(10):
        kind = (0, 3, 4, 4, 2, 1, 3, 2, 4, 1)[y]
        lines.append(kind)
        for x in range(12):
            a = int(pixels[y, x - step]) if x >= step else 0
            b = int(pixels[y - 1, x]) if y else 0
            c = int(pixels[y - 1, x - step]) if y and x >= step else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            lines.append((int(pixels[y, x]) - (0, a, b, (a + b) // 2, paeth)[kind]) & 255)
    z = zlib.compress(bytes(lines))
    data = media.SIGNATURE + media._chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 10, 8, 2, 0, 0, 0)) + media._chunk(b"tEXt", b"a\0b") + media._chunk(b"IDAT", z[:9]) + media._chunk(b"IDAT", z[9:]) + media._chunk(b"IEND", b"")
    assert (media.decode_png(data).reshape(10, 12) == pixels).all()
    for bad in (data[:-3], data[:60] + bytes([data[60] ^ 1]) + data[61:], b"no", data[:-12]):
        with pytest.raises(ValueError):
            media.decode_png(bad)


def test_encoder_filters_and_damaged_pictures(spark):
    slope = np.add.outer(np.arange(9), 3 * np.arange(40)).astype(np.uint8)
    good = media.encode_png(slope)
    body = dict(media.chunks(good))[b"IDAT"]
    assert zlib.decompress(body)[0] in (1, 2) and (media.decode_png(good)[:, :, 0] == slope).all()
    assert zlib.decompress(dict(media.chunks(media.encode_png(np.zeros((2, 3), np.uint8))))[b"IDAT"])[0] == 0
    head = lambda *h: media.SIGNATURE + media._chunk(b"IHDR", struct.pack(">IIBBBBB", *h)) + media._chunk(b"IDAT", body) + media._chunk(b"IEND", b"")
    bad = [good[:-3], b"", b"no", head(40, 9, 8, 3, 0, 0, 0), head(40, 9, 16, 0, 0, 0, 0), head(40, 9, 8, 0, 0, 0, 1), head(1 << 30, 1 << 30, 8, 0, 0, 0, 0), head(0, 9, 8, 0, 0, 0, 0), head(41, 9, 8, 0, 0, 0, 0), good.replace(body, body[:5])]
    bad.append(media.SIGNATURE + media._chunk(b"IHDR", b"short") + media._chunk(b"IEND", b""))
    bad.append(media.SIGNATURE + media._chunk(b"IHDR", struct.pack(">IIBBBBB", 40, 9, 8, 0, 0, 0, 0)) + media._chunk(b"IDAT", b"not deflated") + media._chunk(b"IEND", b""))
    rows = [(0, bytearray(good), "kept"), (1, None, None), *((k + 2, bytearray(b), "x") for k, b in enumerate(bad))]
    got = {r["n"]: r for r in media.picture_features(spark.createDataFrame(rows, "n long, media binary, width string")).collect()}
    assert got[0]["problem"] is None and (got[0]["width"], got[0]["height"]) == (40, 9)
    assert all(v is None for k, v in got[1].asDict().items() if k != "n")
    for k in range(len(bad)):
        r = got[k + 2]
        assert r["problem"] and r["cosine_hash"] is None and r["payload_sha256"] is None and r["media_bytes"] == len(bad[k])


def test_paths_of_one_blob_keep_their_findings(spark, tmp_path):
    """A blob of many paths is dealt by salt; every path gets the findings all the same."""
    secret, plain = "token = abcdefgh12345678", "nothing here"
    rows = [(i if i else None, i % 2, secret if i % 3 else plain) for i in range(200)] + [(7, 1, secret)] * 2
    files = spark.createDataFrame(rows, "path long, version int, text string")
    ledger = secret_ledger.BlobLedger(spark, f"file://{tmp_path}/salted")
    ledger.scan(files)
    got = sorted(((r["path"] or 0, r["version"], len(r["findings"])) for r in ledger.findings(files).collect()))
    assert got == sorted((p or 0, v, int(t == secret)) for p, v, t in rows)


def test_cosine_hash():
    smooth = np.kron(np.random.default_rng(3).integers(20, 230, (8, 12)), np.ones((8, 8))).astype(np.uint8)
    noisy = np.clip(smooth.astype(int) + np.random.default_rng(1).integers(-2, 3, smooth.shape), 0, 255).astype(np.uint8)
    count = lambda a, b: sum(bin(x ^ y).count("1") for x, y in zip(a, b))
    other = np.random.default_rng(2).integers(0, 256, smooth.shape).astype(np.uint8)
    assert count(media.cosine_hash(smooth), media.cosine_hash(noisy)) < count(media.cosine_hash(smooth), media.cosine_hash(other))
    assert media.cosine_hash(np.zeros((3, 192), np.uint8)) == media.cosine_hash(np.zeros((3, 192), np.uint8))


def test_text_pictures(odd_docs, no_docs):
    got = by_id(media.text_picture_features(odd_docs))
    for r in odd_docs.collect():
        data = (r["text"] or "").encode()
        payload = data.ljust(max(1, -(-len(data) // 192)) * 192)
        for g in got[r["doc_id"]]:
            assert (g["n_bytes"], g["payload_bytes"], g["payload_sha256"], g["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
            assert len(g["cosine_hash"]) == 8
    assert len({(g["media_sha256"], bytes(g["cosine_hash"])) for g in got[79]}) == 1
    assert media.text_picture_features(no_docs).count() == 0


def test_sketches():
    rng = np.random.default_rng(3)
    a, b = rng.bytes(40_000), rng.bytes(4_000)
    x, y, both = sketches.sketch(a), sketches.sketch(b), sketches.sketch(a + b)
    assert sketches.containment(y, both) > 0.95 and sketches.containment(x, y) < 0.05
    joined = sketches.merge(x, y)
    assert np.isin(joined[1:], both[1:]).all() and len(both) - len(joined) < 10
    assert (sketches.from_text(sketches.to_text(x)) == x).all()
    assert sketches.containment(sketches.sketch(b""), sketches.sketch(b"")) == 1.0
    assert sketches.containment(sketches.sketch(b""), x) == 0.0
    # every hash below the limit, by brute force
    h = [int(v) for v in sketches.shingle_hashes(b)]
    assert len(h) == len(b) - 15 and x[0] == ((1 << 32) - 1) // 32
    assert set(y[1:].tolist()) >= {v for v in h if v <= ((1 << 32) - 1) // 32}
    one = sketches.shingle_hashes(b[100:116])
    assert one.tolist() == [h[100]]


def test_edited_fingerprints(spark, odd_docs, no_docs):
    got = sketches.edited_fingerprints(odd_docs, target_bytes=20_000).collect()
    rows = sorted(odd_docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    want = []
    for r, after in zip(rows, rows[1:] + rows[:1]):
        t, nxt = r["text"] or "", after["text"] or ""
        ed = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        want.append((r["doc_id"], len(t), hashlib.sha256(ed.encode()).hexdigest(), sketches.to_text(sketches.sketch(t.encode()))))
    key = lambda x: (x[0] is not None, x[0] or 0, x[2])
    assert sorted([(g["doc_id"], g["n_chars"], g["edited_sha256"], g["fingerprint"]) for g in got], key=key) == sorted(want, key=key)
    assert all(0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1 for g in got)
    single = spark.createDataFrame([(5, "alone in the table")], "doc_id long, text string")
    assert sketches.edited_fingerprints(single).first()["near_next"] == 1.0
    assert sketches.edited_fingerprints(no_docs).count() == 0


def brute_targets(sizes, weights=(1, 2, 3)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, capped = float(sum(sizes.values())), set()
    while True:
        free = total - sum(3.0 * sizes[s] for s in capped)
        ww = sum(w[s] for s in order if s not in capped)
        t = {s: 3.0 * sizes[s] if s in capped else (free * w[s] / ww if ww else 0.0) for s in order}
        over = {s for s in order if t[s] > 3.0 * sizes[s] + 1e-9}
        if not over:
            return t
        capped |= over


def test_mix(spark, odd_docs, no_docs):
    got = mixing.mix(odd_docs).collect()
    again = mixing.mix(odd_docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == odd_docs.count()
    sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for g in got:
        sizes[g["source"]] += g["size"]
        taken[g["source"]] += g["taken"]
        assert g["taken"] <= 3 * g["size"] and g["taken"] in {g["size"] * g["epochs"], g["size"] * (g["epochs"] + 1)}
        most[g["source"]] = max(most[g["source"]], g["size"])
    want = brute_targets(sizes)
    words = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in odd_docs.collect()}
    for g in got:
        assert g["size"] == words[g["doc_id"]] and g["source_size"] == sizes[g["source"]]
        assert abs(g["target"] - want[g["source"]]) < 1e-6
    for s, t in want.items():
        assert abs(taken[s] - t) <= most[s], s
    assert mixing.mix(no_docs).count() == 0


def test_mix_takes_by_key(spark):
    """One pass takes the least keys that fit, as a full sort would; later passes fill the gap in order."""
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 50)), "ab"[i % 2 if i % 7 else 0]) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    keys, plan, n = mixing.mix_plan(df, passes=1)
    got = {r["doc_id"]: r["mix_copies"] for r in mixing.taken(keys, plan, n).collect()}
    for p in plan.collect():
        own = sorted((r for r in keys.collect() if r["source"] == p["source"]), key=lambda r: (r["mix_key"], r["mix_tie"]))
        rest, used = p["target"] - p["epochs"] * p["source_size"], 0
        fits = [r for r in own if r["mix_size"] <= rest]
        for r in fits:
            inside = used + r["mix_size"] / 2 <= rest
            assert got[r["doc_id"]] == p["epochs"] + inside
            used += r["mix_size"]


def test_mixed_documents(odd_docs):
    out = mixing.mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns
    copies = defaultdict(int)
    for r in mixing.mix(odd_docs).collect():
        copies[r["doc_id"]] += r["copies"]
    assert {k: len(v) for k, v in by_id(out).items()} == {k: v for k, v in copies.items() if v}
