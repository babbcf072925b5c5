"""Results of models and hashes against sums and transforms written out."""

import math
import random
from itertools import product

import numpy as np
import pytest

from actaspark.llm.langid import BUCKETS, Model, label, words
from actaspark.llm.media import cosine_hash, text_picture_features


def test_predicted_languages_against_all_labellings(spark):
    rng = np.random.default_rng(2)
    names = ("aa", "bb", "cc")
    model = Model(names, rng.normal(size=(BUCKETS, 3)).astype(np.float32), rng.normal(size=(3, 3)), rng.normal(size=3))
    draw = random.Random(2)
    texts = [" ".join(draw.choices(["die", "the", "les", "haus", "été", "house's", "x", "日本"], k=draw.randint(1, 5))) for _ in range(25)] + [None, "", "12 34", "the"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in label(rows, model, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        own = words(text)
        if not own:
            assert found[i]["lang_pred"] == "und" and found[i]["score"] == 0
            continue
        scores = np.array([model.emissions([w])[0] for w in own], np.float64)
        total, each = 0.0, np.zeros((len(own), 3))
        for y in product(range(3), repeat=len(own)):
            weight = math.exp(model.start[y[0]] + sum(scores[k, y[k]] for k in range(len(own))) + sum(model.transition[y[k - 1], y[k]] for k in range(1, len(own))))
            total += weight
            for k, label_k in enumerate(y):
                each[k, label_k] += weight
        mean = each.sum(axis=0) / total / len(own)
        assert found[i]["lang_pred"] == names[int(mean.argmax())]
        assert found[i]["score"] == pytest.approx(mean.max(), rel=1e-4)


def plain_hash(picture):
    """Means of 32 by 32 areas, the cosine transform as its definition has it, and bits above the median."""
    height, width = len(picture), len(picture[0])
    span = lambda n, k: range(k * n // 32, max((k + 1) * n // 32, k * n // 32 + 1))
    small = [[sum(picture[y][x] for y in span(height, i) for x in span(width, j)) / len(span(height, i)) / len(span(width, j)) for j in range(32)] for i in range(32)]
    scale = lambda k: math.sqrt((1 if k == 0 else 2) / 32)
    low = [
        round(scale(u) * scale(v) * sum(small[y][x] * math.cos(math.pi * u * (2 * y + 1) / 64) * math.cos(math.pi * v * (2 * x + 1) / 64) for y in range(32) for x in range(32)), 6)
        for u in range(8)
        for v in range(8)
    ]
    rest = sorted(low[1:])
    median = rest[31]
    bits = "".join("1" if c > median else "0" for c in low)
    return int(bits, 2).to_bytes(8, "big")


@pytest.mark.parametrize("shape", [(32, 32), (64, 96), (40, 192), (33, 50), (1, 192), (7, 192)])
def test_cosine_hash_against_the_definition(shape):
    rng = np.random.default_rng(sum(shape))
    smooth = rng.integers(0, 200, shape) + np.linspace(0, 55, shape[1])[None, :].astype(int)
    assert cosine_hash(smooth.astype(np.uint8)) == plain_hash(smooth.astype(np.uint8).tolist())


def test_features_of_texts_are_hashes_of_their_pictures(spark):
    texts = ["short", "word " * 300, "é" * 1000]
    found = text_picture_features(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in found:
        data = texts[r["doc_id"]].encode()
        payload = np.frombuffer(data + b" " * (r["payload_bytes"] - len(data)), np.uint8)
        assert bytes(r["cosine_hash"]) == plain_hash(payload.reshape(-1, 192).tolist())
