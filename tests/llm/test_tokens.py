import random
import zlib
from array import array

import numpy as np
import pytest
from tokenizers import Tokenizer

from actaspark.llm import packing, token_planes
from actaspark.llm.queries import tokenizer_file
from actaspark.llm.tokens import TextEncoder


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_file())


def ids_of(tokenizer, text, end):
    return array("I", [*tokenizer.encode(text or "", add_special_tokens=False).ids, end])


def test_units_give_the_tokenizers_ids(tokenizer, rows):
    spec = open(tokenizer_file(), encoding="utf-8").read()
    encoder, rng = TextEncoder(spec, limit=50), random.Random(1)
    letters = " \n\t\r\x0b\x1c\x85\xa0 　\x00abcAB'sdt.,;12é日ßªº́😀_-"
    texts = [r[1] for r in rows if r[1] is not None] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["<|endoftext|> a", "a  <|endoftext|>b", "we'll they're it's", " lead", "trail ", "a\n\n b", "x." * 40]
    for text in texts:
        assert encoder.ids(text) == array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes(), repr(text)


def test_packing(spark, odd_docs, no_docs, tokenizer):
    pieces = packing.pack(odd_docs, tokenizer_file(), 1, 256).collect()
    whole = {}
    for p in pieces:
        assert p["length"] & (p["length"] - 1) == 0 and p["length"] <= 256 and p["offset"] == 0 and 1 << p["bucket"] == p["length"]
        whole.setdefault(p["doc_id"], []).append(p)
    assert len({p["sequence_id"] for p in pieces}) == len(pieces)
    for r in odd_docs.dropDuplicates(["doc_id"]).collect():
        own, ids = sorted(whole[r["doc_id"]], key=lambda p: p["start"]), ids_of(tokenizer, r["text"], 1)
        if r["doc_id"] == 79:  # given twice
            own = own[::2]
        assert b"".join(bytes(p["ids"]) for p in own) == ids.tobytes()
        assert all(p["doc_tokens"] == len(ids) for p in own)
        assert [p["length"] for p in own] == packing.binary_lengths(len(ids), 256)
    assert packing.pack(no_docs, tokenizer_file()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd_docs, tokenizer_file(), 1, 1000)


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_planes_round_trip(tmp_path, planes):
    rng = np.random.default_rng(1)
    docs = [(i, rng.integers(0, 1 << 32, n, np.uint64).astype("<u4")) for i, n in enumerate([0, 1, 999, 1000, 1001, 5000, 0])]
    path = tmp_path / "x.planes"
    with open(path, "wb") as out:
        w = token_planes.PlaneWriter(out, 1000, planes)
        for i, ids in docs:
            w.add(i if i else None, ids.tobytes())
        w.close()
    files, where = token_planes.open_fs(f"file://{path}")
    with files.open_input_file(where) as src:
        r = token_planes.PlaneReader(src)
        assert list(r.documents()) == [(i if i else None, len(x), zlib.crc32(x)) for i, x in docs]
        everything = np.concatenate([x for _, x in docs])
        for a, b in [(0, 0), (0, 8001), (990, 1010), (2000, 3000), (7999, 8001)]:
            assert (r.read(a, b) == everything[a:b]).all()
    data = bytearray(path.read_bytes())
    data[20] ^= 255
    path.write_bytes(data)
    with files.open_input_file(where) as src, pytest.raises(Exception):
        token_planes.PlaneReader(src).read_block(0)


def test_plane_files(spark, odd_docs, no_docs, tokenizer):
    got = token_planes.plane_digests(odd_docs, tokenizer_file(), block=500, target_bytes=20_000).orderBy("start").collect()
    rows = sorted(odd_docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    start = 0
    for g, r in zip(got, rows, strict=True):
        ids = ids_of(tokenizer, r["text"], 2)
        assert (g["doc_id"], g["start"], g["n_tokens"], g["ids_crc32"]) == (r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len({g["file"] for g in got}) > 1
    assert token_planes.plane_digests(no_docs, tokenizer_file()).count() == 0
