"""Toxicity by maximum-scoring segments.

Learning. Of labelled documents, the counts of every word, and of its first 4 to 7 letters, in toxic and in
clean texts give log odds under Dirichlet priors (a word's prior is its share in all texts; see
``segment_score``). Only features that toxic texts have significantly more often are kept.

Scoring. Every word scores the log odds that it comes from a toxic passage, and words without a kept feature
score slightly below zero. A linear scan finds all maximal segments (Ruzzo and Tompa). For such scores the
best segment of clean text follows an extreme-value law: a segment of score S in n words has the corrected
score S - log(K n), and only segments above 0 are significant. The evidence of a document is the sum over
these (or the best one, if none is); a logistic curve, fitted to the evidence of a part of the labelled
documents that had no part in the counts, turns it into a probability.

Defined results: null or empty text, and text without letters, has the evidence of no segment and so a low
score; a very long text is scored whole; the score depends on the text alone, so repeated rows and equal texts score alike;
columns named ``score`` and ``passages`` are replaced, others stay; labels other than 0 and 1 are left out; without labelled documents of both kinds every score is the
share of toxic ones (0 without any); an empty table gives no rows."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

_WORDS = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7)
#: Distinct words that a worker counts before it passes them on.
_HELD = 200_000
#: Evidence of a text without any segment.
NOTHING = -4.0


def words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def features(word: str) -> list[str]:
    """The word, then its longer to shorter first letters (marked with a final star)."""
    return [word, *(word[:n] + "*" for n in reversed(PREFIXES) if len(word) >= n)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        totals: dict[str, list[int]] = {"": [0, 0]}
        for label in (0, 1):
            for word, n in seen[label].items():
                totals[""][label] += n
                for f in features(word):
                    totals.setdefault(f, [0, 0])[label] += n
            seen[label].clear()
        clean, toxic = zip(*totals.values())
        return pa.RecordBatch.from_arrays([pa.array(list(totals)), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())], names=["feature", "clean", "toxic"])

    for batch in slices(batches, "text"):
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            seen[label].update(words(text or ""))
        if len(seen[0]) + len(seen[1]) > _HELD:
            yield flush()
    yield flush()


def count_features(labelled: DataFrame) -> DataFrame:
    """(feature, clean, toxic) word counts of (text, label); the empty feature has the totals.
    Workers add up before the shuffle."""
    counts = labelled.select("text", F.col("label").cast("int").alias("label")).mapInArrow(_count, "feature string, clean long, toxic long")
    return counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def segment_score(toxic: Column, clean: Column, n_toxic: float, n_clean: float, prior: float, share: float) -> tuple[Column, Column]:
    """(score, significance) of a feature.

    Both rates are smoothed by a Dirichlet prior of ``prior`` pseudo-counts that follow the feature's rate
    in all texts. A toxic passage is taken to have toxic words (distributed as the excess of the toxic over the
    clean rate) with probability ``share`` and ordinary ones otherwise. Significance is the signed root of
    twice the log likelihood ratio against equal rates."""
    rate = (toxic + clean) / (n_toxic + n_clean)
    p1 = (toxic + prior * rate) / (n_toxic + prior)
    p0 = (clean + prior * rate) / (n_clean + prior)
    expected1, expected0 = rate * n_toxic, rate * n_clean
    g = toxic * F.log(F.greatest(toxic, F.lit(1e-9)) / expected1) + clean * F.log(F.greatest(clean, F.lit(1e-9)) / expected0)
    return F.log(F.lit(share) * F.least(p1 / p0, F.lit(2000.0)) + (1 - share)), F.signum(p1 - p0) * F.sqrt(F.greatest(2 * g, F.lit(0.0)))


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in linear time (Ruzzo and Tompa)."""
    kept: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum through
    total = 0.0
    link: list[int] = []  # for each kept one, the last earlier one with a smaller sum before
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        start, left = i, before
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j = link[j]
            if j < 0 or kept[j][3] >= total:
                kept.append((start, i + 1, left, total))
                link.append(j)
                break
            start, left = kept[j][0], kept[j][2]
            del kept[j:], link[j:]
    return [(a, b, r - l) for a, b, l, r in kept]


@dataclass(frozen=True)
class Model:
    """``scores``: features that raise suspicion. ``miss``: the score of any other word. ``log_k``: of the
    extreme-value law. ``curve``: intercept and slope of the probability."""

    scores: dict[str, float]
    miss: float
    log_k: float
    curve: tuple[float, float]


class Scorer:
    """Scores texts; remembers the words it has met, two generations of them at most."""

    def __init__(self, scores: dict[str, float], miss: float, limit: int = 200_000):
        self.scores, self.miss, self.limit, self.known = scores, miss, limit, {}

    def word(self, word: str) -> float:
        got = [self.scores[f] for f in features(word) if f in self.scores]
        if len(self.known) >= self.limit:
            self.known.clear()
        s = self.known[word] = max(got) if got else self.miss
        return s

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and the segments in words. Words between suspicious ones are summed as one."""
        tokens = words(text)
        get, word = self.known.get, self.word
        values = [s if (s := get(t)) is not None else word(t) for t in tokens]
        hits = [i for i, s in enumerate(values) if s > 0]
        if not hits:
            return len(tokens), []
        places, runs, last = [], [], -1
        for i in hits:
            runs += [(i - last - 1) * self.miss, values[i]]
            places += [(last + 1, i), (i, i + 1)]
            last = i
        return len(tokens), [(places[a][0], places[b - 1][1], s) for a, b, s in maximal_segments(runs)]


def best_and_length(scorer: Scorer, text: str) -> tuple[float, int]:
    n, found = scorer.segments(text)
    return max((s for *_, s in found), default=0.0), n


def evidence(n: int, found: list[tuple[int, int, float]], log_k: float) -> float:
    """Sum of the significant corrected scores, or the best corrected score; ``NOTHING`` without a segment."""
    fee = log_k + math.log(max(n, 1))
    corrected = [s - fee for *_, s in found]
    above = [c for c in corrected if c > 0]
    return sum(above) if above else max([NOTHING, *corrected])


def _bin(x: float) -> int:
    return min(255, max(0, round((min(max(x, -24.0), 104.0) + 24.0) * 2)))


def _middle(b: np.ndarray) -> np.ndarray:
    return b / 2 - 24.0


def _measure(scores, miss: float):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, sums = Scorer(scores.value, miss), [0, 0.0]  # texts with a segment; words, weighed by exp(-best)
        for batch in slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                best, n = best_and_length(scorer, text or "")
                sums[0] += best > 0
                sums[1] += n * math.exp(-best)
        yield pa.RecordBatch.from_pydict({"n": [sums[0]], "mass": [sums[1]]})

    return measure


def _evidences(scores, miss: float, log_k: float):
    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, counts = Scorer(scores.value, miss), Counter()
        for batch in slices(batches, "text"):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                counts[_bin(evidence(*scorer.segments(text or ""), log_k)), label] += 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())], names=["bin", "label", "n"])

    return bins


def logistic(bins: np.ndarray, toxic: np.ndarray, clean: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Intercept and slope by Newton's method with halved steps; a weak pull keeps separable data finite."""
    x, n = np.stack([np.ones(len(bins)), _middle(bins) / 10]), toxic + clean

    def loss(v: np.ndarray) -> float:
        z = v @ x
        return float((n * np.logaddexp(0, z) - toxic * z).sum() + ridge / 2 * (v @ v))

    v = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(v @ x, -40, 40)))
        grad = x @ (n * p - toxic) + ridge * v
        step = np.linalg.solve((x * (n * p * (1 - p))) @ x.T + ridge * np.eye(2), grad)
        size = 1.0
        while size > 1e-6 and loss(v - size * step) > loss(v):
            size /= 2
        v = v - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(v[0]), float(max(v[1] / 10, 0.0))


def learn(labelled: DataFrame, part: Column, share: float = 0.3, prior: float = 2.0, significance: float = 4.5, least: float = 1.0, max_features: int = 100_000) -> Model:
    """From (text, label): counts come from rows where ``part`` is false, calibration from the others.
    Features score at least ``least``; ``max_features`` bounds the model, and the most significant stay."""
    rows = labelled.filter(F.col("label").isin(0, 1)).select("text", "label", part.alias("held"))
    counting, fitting = rows.filter(~F.col("held")), rows.filter("held")
    counts = count_features(counting.select("text", "label")).filter("toxic > 0 or feature = ''")
    # totals first, as scores need them; the counts are kept for the second look
    from .common import forget, stored

    counts = stored(counts, "tox-counts")
    total = counts.filter("feature = ''").agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.coalesce(F.sum("clean"), F.lit(0)).alias("c")).first()
    n1, n0 = float(total["t"]), float(total["c"])
    scores: dict[str, float] = {}
    if n1 and n0:
        s, z = segment_score(F.col("toxic"), F.col("clean"), n1, n0, prior, share)
        found = counts.filter("feature <> '' and toxic >= 3").select("feature", s.alias("s"), z.alias("z")).filter((F.col("z") >= significance) & (F.col("s") > least))
        scores = {r["feature"]: r["s"] for r in found.orderBy(F.desc("z"), "feature").limit(max_features).collect()}
    forget(counts)
    miss = math.log(1 - share)
    spread = labelled.sparkSession.sparkContext.broadcast(scores)
    law = fitting.filter("label = 0").select("text").mapInArrow(_measure(spread, miss), "n long, mass double").agg(F.sum("n"), F.sum("mass")).first()
    # most likely K if texts without a segment only tell that their best score is not above 0
    log_k = math.log(((law[0] or 0) + 0.5) / ((law[1] or 0.0) + 1.0))
    counted = fitting.select("text", F.col("label").cast("int").alias("label")).mapInArrow(_evidences(spread, miss, log_k), "bin int, label int, n long").groupBy("bin", "label").agg(F.sum("n").alias("n")).collect()
    by = {(r["bin"], r["label"]): r["n"] for r in counted}
    bins = np.array(sorted({b for b, _ in by}), float)
    toxic, clean = (np.array([by.get((int(b), y), 0) for b in bins], float) for y in (1, 0))
    if toxic.sum() and clean.sum():
        curve = logistic(bins, toxic, clean)
        for _ in range(3):  # a few labels are wrong: those that the curve flatly contradicts don't bend it
            p = 1 / (1 + np.exp(-np.clip(curve[0] + curve[1] * _middle(bins), -40, 40)))
            curve = logistic(bins, toxic * (p > 0.03), clean * (p < 0.97))
    else:
        rate = (toxic.sum() + 1e-6) / (toxic.sum() + clean.sum() + 2e-6) if toxic.sum() else 0.0
        curve = (math.log(rate / (1 - rate)) if 0 < rate < 1 else -40.0, 0.0)
    return Model(scores, miss, log_k, curve)


def _scorer(model, keep: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        scorer, (a, b) = Scorer(m.scores, m.miss), m.curve
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in slices(batches, "text"):
            scores, passages = [], []
            for text in batch.column("text").to_pylist():
                n, found = scorer.segments(text or "")
                x = a + b * evidence(n, found, m.log_k)
                scores.append(1 / (1 + math.exp(-min(max(x, -40.0), 40.0))))
                fee = m.log_k + math.log(max(n, 1))
                passages.append([{"start": i, "end": j, "score": s - fee} for i, j, s in found if s > fee])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(scores, pa.float64()), pa.array(passages, kind)], names=[*keep, "score", "passages"])

    return score


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the text, with score and passages (word places and corrected scores of every
    significant segment). A scan; no shuffle."""
    spread = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("text", "score", "passages")]
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "score double, passages array<struct<start:int,end:int,score:double>>"])
    return docs.select(*keep, "text").mapInArrow(_scorer(spread, keep), schema)
