import itertools
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from actaspark.llm import langid, toxicity
from actaspark.llm.common import fold

from .conftest import prose


def brute_segments(scores):
    """Maximal segments by their definition: positive, no better within, and none that holds them has the same."""
    total = np.concatenate([[0], np.cumsum(scores)])

    def maximal_in(lo, hi):
        best, at = 0, None
        for a in range(lo, hi):
            for b in range(a + 1, hi + 1):
                if total[b] - total[a] > best + 1e-12:
                    best, at = total[b] - total[a], (a, b)
        if at is None:
            return []
        return maximal_in(lo, at[0]) + [(*at, best)] + maximal_in(at[1], hi)

    return maximal_in(0, len(scores))


def test_segments_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        scores = [float(rng.choice([-3, -2, -1, 1, 2, 4]) + rng.random() / 7) for _ in range(rng.randint(0, 14))]
        got, want = toxicity.maximal_segments(scores), brute_segments(scores)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_compressed_runs_give_the_same_segments():
    rng = random.Random(4)
    scorer = toxicity.Scorer({"bad": 2.0, "vile*": 1.5}, -0.4)
    for _ in range(100):
        words = [rng.choice(["bad", "vilest", "good", "fine"]) for _ in range(rng.randint(0, 30))]
        n, got = scorer.segments(" ".join(words))
        values = [{"bad": 2.0, "vilest": 1.5}.get(w, -0.4) for w in words]
        assert n == len(words) and [g[:2] for g in got] == [s[:2] for s in toxicity.maximal_segments(values)]


def labelled(spark):
    rng, rows = random.Random(5), []
    for i in range(600):
        words, toxic = prose(rng, ("en", "fr")[i % 2], rng.randint(20, 200)).split(" "), i % 6 == 0
        if toxic:
            for _ in range(max(2, len(words) // 25)):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "trashy", "scummer", "scumling"]))
        rows.append((i, " ".join(words), int(toxic), "extra"))
    return spark.createDataFrame([*rows, (600, None, 1, None), (601, "", 0, None), (602, "odd label", None, None)], "doc_id long, text string, label int, passages string")


def test_toxicity_held_out(spark, no_docs):
    rows = labelled(spark)
    model = toxicity.learn(rows.filter(fold() != 0), fold() == 4)
    assert {"idiot", "scum*"} <= set(model.scores)
    scored = toxicity.score(rows.filter(fold() == 0), model).filter("label is not null and doc_id < 600")
    good = scored.filter((F.col("score") >= 0.5) == (F.col("label") == 1)).count()
    assert good / scored.count() > 0.97
    edge = toxicity.score(rows.filter("doc_id >= 600"), model).collect()
    assert all(0 <= r["score"] < 0.5 and r["passages"] == [] for r in edge)
    assert toxicity.score(no_docs, model).count() == 0
    empty = toxicity.learn(rows.limit(0), F.lit(False))
    assert all(r["score"] < 0.5 for r in toxicity.score(rows, empty).collect())


def test_learned_scores_against_brute_force(spark):
    """Log odds, significance and the extreme-value constant from plain counts."""
    rows = labelled(spark)
    model = toxicity.learn(rows.filter(fold() != 0), fold() == 4)
    part = {0: [], 1: []}, {0: [], 1: []}
    for r in rows.withColumn("fold", fold()).filter("fold <> 0 and label is not null").collect():
        part[r["fold"] == 4][r["label"]].append(toxicity.words(r["text"] or ""))
    count = {y: Counter(f for t in part[0][y] for w in t for f in [w, *(w[:n] + "*" for n in (4, 5, 6, 7) if len(w) >= n)]) for y in (0, 1)}
    n1, n0 = (sum(len(t) for t in part[0][y]) for y in (1, 0))
    want = {}
    for f, a in count[1].items():
        b = count[0][f]
        rate = (a + b) / (n1 + n0)
        odds = ((a + 2 * rate) / (n1 + 2)) / ((b + 2 * rate) / (n0 + 2))
        s = math.log(0.3 * min(odds, 2000.0) + 0.7)
        g = a * math.log(a / (rate * n1)) + (b * math.log(b / (rate * n0)) if b else 0.0)
        if a >= 3 and odds > 1 and math.sqrt(max(2 * g, 0.0)) >= 4.5 and s > 1:
            want[f] = s
    assert set(model.scores) == set(want)
    assert all(abs(model.scores[f] - s) < 1e-6 for f, s in want.items())
    hits, mass = 0, 0.0
    for t in part[1][0]:
        values = [max([want[f] for f in toxicity.features(w) if f in want], default=math.log(0.7)) for w in t]
        best = max((s for *_, s in brute_best(values)), default=0.0)
        hits, mass = hits + (best > 0), mass + len(t) * math.exp(-best)
    assert abs(model.log_k - math.log((hits + 0.5) / (mass + 1.0))) < 1e-6


def brute_best(values):
    """The best run of ``values``, if it is positive."""
    best = now = 0.0
    for v in values:
        now = max(0.0, now + v)
        best = max(best, now)
    return [(0, 0, best)] if best > 0 else []


def brute_marginals(e, t, s):
    n, m = e.shape
    p, total = np.zeros((n, m)), 0.0
    for path in itertools.product(range(m), repeat=n):
        w = math.exp(s[path[0]] + sum(e[i, k] for i, k in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))
        total += w
        for i, k in enumerate(path):
            p[i, k] += w
    return p / total


def sequential_marginals(e, t, s):
    n, m = e.shape
    a, b = np.zeros((n, m)), np.zeros((n, m))
    a[0] = s + e[0]
    for i in range(1, n):
        a[i] = np.logaddexp.reduce(a[i - 1][:, None] + t, axis=0) + e[i]
    for i in range(n - 2, -1, -1):
        b[i] = np.logaddexp.reduce(t + (e[i + 1] + b[i + 1])[None, :], axis=1)
    g = a + b
    return np.exp(g - np.logaddexp.reduce(g, axis=1, keepdims=True))


def test_forward_backward():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 4, 64, 65, 3, 128, 500, 63])
    e, t, s = rng.normal(size=(lengths.sum(), 3)) * 3, rng.normal(size=(3, 3)), rng.normal(size=3)
    got = langid.marginals(e, lengths, t, s)
    ends = np.cumsum(lengths)
    for a, b in zip(ends - lengths, ends):
        assert np.allclose(got[a:b], sequential_marginals(e[a:b], t, s), atol=1e-9)
        if b - a <= 4:
            assert np.allclose(got[a:b], brute_marginals(e[a:b], t, s))


def test_gradient():
    """The expected counts are the slope of the log normaliser."""
    rng = np.random.default_rng(2)
    lengths = np.array([5, 64])
    e, t, s = rng.normal(size=(69, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    p, moved, begins, norm = langid.marginals(e, lengths, t, s, pairs=True)
    at = lambda **k: langid.marginals(k.get("e", e), lengths, k.get("t", t), k.get("s", s), pairs=True)[3]
    d = 1e-5
    for i, k in [(0, 0), (40, 1)]:
        up = e.copy()
        up[i, k] += d
        assert abs((at(e=up) - norm) / d - p[i, k]) < 1e-3
    up = t.copy()
    up[0, 1] += d
    assert abs((at(t=up) - norm) / d - moved[0, 1]) < 1e-3
    up = s.copy()
    up[1] += d
    assert abs((at(s=up) - norm) / d - begins[1]) < 1e-3


def test_language(spark, odd_docs, no_docs):
    rng = random.Random(7)
    train = spark.createDataFrame([(prose(rng, ("en", "fr", "de")[i % 3], 60), ("en", "fr", "de")[i % 3]) for i in range(150)] + [(None, "en"), ("...", "fr")], "text string, lang string")
    model = langid.learn(train, sequences=600, epochs=4)
    assert model.languages == ("de", "en", "fr")
    out = langid.label(odd_docs, model).collect()
    assert len(out) == odd_docs.count()
    by = {r["doc_id"]: r for r in out}
    assert sum(r["lang_pred"] == r["lang"] for r in out if r["doc_id"] is not None and r["doc_id"] < 60) >= 57
    for i in (75, 76, 77, 80):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["spans"]) == ("und", 0.0, [])
    mixed = prose(rng, "en", 40) + " " + prose(rng, "de", 40)
    spans = langid.label(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()["spans"]
    assert [s["lang"] for s in sorted(spans, key=lambda s: s["start"] - s["end"])[:2]] in (["en", "de"], ["de", "en"])
    kept = langid.known_language(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert {75, 76, 77, 80}.isdisjoint(r["doc_id"] for r in kept.collect()) and kept.count() >= odd_docs.count() - 7
    assert langid.label(no_docs, model).count() == 0
    assert langid.learn(train.limit(0)) is None
    assert {r["lang_pred"] for r in langid.label(odd_docs, None).collect()} == {"und"}


def test_numerals_are_no_letters():
    assert langid.words("\u00bd \u00b2 \u2460 \u2461 12_3") == [] and langid.words("a\u00bdb c\u00b2") == ["a", "b", "c"]
    assert langid.words("\u00c9t\u00e9 na\u00efve") == ["\u00e9t\u00e9", "na\u00efve"]


def test_long_texts_are_learned(spark):
    """A language whose texts are all long is learned too, from windows; copies of a text count once."""
    long = "le chat dort sur la chaise " * 3000
    rows = [(long + f"fin{i}", "fr") for i in range(5)] + [("the dog sleeps under the table", "en")] * 50 + [(f"a dog number {i} sleeps", "en") for i in range(5)]
    model = langid.learn(spark.createDataFrame(rows, "text string, lang string"), per_language=20)
    assert model.languages == ("en", "fr")
    docs = spark.createDataFrame([(1, "le chat dort"), (2, "the dog sleeps"), (3, "12 \u00bd")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in langid.label(docs, model).collect()} == {1: "fr", 2: "en", 3: "und"}


def test_models_of_many_languages_are_bounded():
    for m in (1, 2, 8, 32, 33, 100, 300, 10_000):
        size = langid.buckets_for(m)
        assert size & (size - 1) == 0 and size <= langid.BUCKETS and (size * m <= langid.CELLS or size == 1 << 10)
    assert langid.buckets_for(32) == langid.BUCKETS
    rng = random.Random(3)
    owner, bucket = langid.word_features(["abc", "déf"], 1 << 12)
    assert set(owner.tolist()) == {0, 1} and bucket.max() < 1 << 12
    vocabularies = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(30)] for _ in range(12)]
    texts = [[rng.choice(vocabularies[k % 12]) for _ in range(70)] for k in range(240)]
    model = langid.fit(texts, np.arange(240) % 12, tuple(f"l{k:02d}" for k in range(12)), sequences=600, epochs=2)
    held = langid.Labeller(model)
    lengths, p = held.marginals([" ".join(rng.choice(v) for _ in range(20)) for v in vocabularies])
    assert p.reshape(12, 20, 12).sum(axis=1).argmax(axis=1).tolist() == list(range(12))
