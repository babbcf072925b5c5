"""Language identification by a linear-chain conditional random field over words.

Every word of a text is labelled with a language, so code-switched text gets spans. Emission features are a
word's character n-grams with its borders (those at a border are its affixes) and the word itself (a hashed
lexicon); transition weights between the languages of neighbouring words are learned with them. Training
maximises the likelihood of word sequences that are drawn from labelled documents and spliced from several
of them, so that switches occur; labelling computes exact marginals by forward-backward. A document's
language is the one with the most expected words.

The sequential recurrences run over all documents of a batch together: texts are cut into blocks of words,
each block's transfer matrix is computed, blocks are chained, and then all blocks are swept at once. This is
exact and takes long documents in their stride.

The model is fitted on the driver, on a window of words of each document of a bounded sample (``learn``): at most
``per_language`` distinct texts of each label and ``WINDOW`` words of each. The fit draws PER_LABEL sequences of
BLOCK words for each label. Windows, sequences and weights are bounded in all (``MAX_WINDOWS``, ``MAX_SEQUENCES``,
``CELLS``), so beyond 20 labels each has fewer windows, beyond 32 fewer buckets and beyond 40 fewer sequences.

Defined results: null text, or text without a letter, is ``und`` with score 0 and no spans; without labelled
documents everything is ``und``; with one language all words have it; ties go to the first language by code
point; very long texts and very long words are labelled whole; repeated rows get equal labels, and repeated texts
count once in the sample; columns named as the added ones are replaced, others stay whatever their names; an
empty table gives no rows."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_bytes, slices, stored

_WORDS = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 18
ORDERS = (1, 2, 3, 4, 5)
BLOCK = 64
#: Words of a document that the fit may see, and windows of all labels together.
WINDOW, MAX_WINDOWS = 128, 30_000
#: Spliced sequences of BLOCK words that the fit draws: for each label, and in all.
PER_LABEL, MAX_SEQUENCES = 1000, 40_000
#: Weights of a model (buckets times labels) at most: 64 MB for each of two arrays on the driver, 32 MB to broadcast.
CELLS = 1 << 23
#: Labels whose counts (a few bytes each) are broadcast; more are joined by a shuffle.
MAX_BROADCAST_LANGUAGES = 10_000


def words(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    if not text:
        return []
    found = _WORDS.findall(text.lower())
    if text.isascii() or all(map(str.isalpha, found)):
        return found
    # numerals that aren't digits, such as fractions, count as word characters there
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


def word_features(tokens: list[str], size: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket of ``size``, a power of two) of every feature of ``tokens``: bordered character n-grams, and the word."""
    chars = np.frombuffer(("\n" + "\n".join(tokens) + "\n").encode("utf-32-le"), np.uint32).astype(np.uint64)
    border = chars == 10
    upto = np.cumsum(border)
    owners, buckets = [], []
    h = np.zeros(len(chars), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, max(ORDERS) + 1):
            if n > len(chars):
                break
            h = (h[: len(chars) - n + 1] if n > 1 else h) * np.uint64(0x100000001B3) + chars[n - 1 :] + np.uint64(1)
            if n not in ORDERS:
                continue
            if n == 1:
                good = ~border
            else:  # a border inside spoils an n-gram, one at its ends doesn't
                good = upto[n - 2 : len(chars) - 1] - upto[: len(chars) - n + 1] == 0
                good &= ~(border[: len(chars) - n + 1] & border[n - 1 :])
            x = (h[good] ^ np.uint64(n * 0x9E3779B9)) * np.uint64(0x9E3779B97F4A7C15)
            owners.append(upto[: len(chars) - n + 1][good] - 1)
            buckets.append((x >> np.uint64(46)).astype(np.int64) & (size - 1))
    owners.append(np.arange(len(tokens)))
    buckets.append(np.array([zlib.crc32(w.encode(), 7) & (size - 1) for w in tokens], np.int64))
    return np.concatenate(owners).astype(np.int64), np.concatenate(buckets)


@dataclass(frozen=True)
class Model:
    """``emission``: (buckets, languages); ``transition``: log weights, from row to column; ``start``: log weights."""

    languages: tuple[str, ...]
    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray

    def emissions(self, tokens: list[str]) -> np.ndarray:
        owner, bucket = word_features(tokens, len(self.emission))
        out = np.empty((len(tokens), len(self.languages)), np.float32)
        for k in range(out.shape[1]):
            out[:, k] = np.bincount(owner, self.emission[bucket, k], len(tokens))
        return out


def marginals(emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Marginals of every word of sequences that stand one after the other, by exact forward-backward.

    ``emission``: (words, languages) log weights; ``lengths``: words of each sequence, all positive. With
    ``pairs`` also the expected transitions and starts, and the log likelihood's normaliser; that is for
    training sequences, of one block at most."""
    n, m = emission.shape
    peak = emission.max(axis=1)
    psi = np.exp(emission - peak[:, None]).astype(np.float64)
    trans, first = np.exp(transition), np.exp(start)
    n_blocks = -(-lengths // BLOCK)
    seq_of = np.repeat(np.arange(len(lengths)), n_blocks)
    first_block = np.cumsum(n_blocks) - n_blocks
    place = np.arange(len(seq_of)) - first_block[seq_of]
    begin = (np.cumsum(lengths) - lengths)[seq_of] + place * BLOCK
    size = np.minimum(BLOCK, lengths[seq_of] - place * BLOCK)
    order = np.argsort(-size, kind="stable")
    at = begin[order]
    active = np.searchsorted(-size[order], -np.arange(1, BLOCK + 1), "right")  # blocks with more than t words
    nb = len(order)
    if pairs and lengths.max() > BLOCK:
        raise ValueError("training sequences are of one block at most")
    log_norm = 0.0
    entry = np.empty((nb, m))
    leave = np.empty((nb, m))
    rank = np.empty(nb, np.int64)
    rank[order] = np.arange(nb)
    if n_blocks.max() > 1:
        move = np.zeros((nb, m, m))
        move[:, np.arange(m), np.arange(m)] = psi[at]
        for t in range(1, BLOCK):
            if not (k := active[t]):
                break
            step = (move[:k].reshape(-1, m) @ trans).reshape(k, m, m) * psi[at[:k] + t][:, None, :]
            move[:k] = step / step.max(axis=(1, 2), keepdims=True)
        ahead, back = np.tile(first, (len(lengths), 1)), np.ones((len(lengths), m))
        for k in range(n_blocks.max()):
            own = np.flatnonzero(n_blocks > k)
            b = rank[first_block[own] + k]
            entry[b] = ahead[own]
            u = np.einsum("ni,nij->nj", ahead[own], move[b]) @ trans
            ahead[own] = u / u.max(axis=1, keepdims=True)
        for k in range(n_blocks.max() - 1, -1, -1):
            own = np.flatnonzero(n_blocks > k)
            b = rank[first_block[own] + k]
            leave[b] = back[own]
            w = np.einsum("nij,nj->ni", move[b], back[own]) @ trans.T
            back[own] = w / w.max(axis=1, keepdims=True)
    else:
        entry[:], leave[:] = first, 1.0
    alpha = np.empty((n, m))
    a = entry * psi[at]
    for t in range(BLOCK):
        if not (k := active[t]):
            break
        if t:
            a = (alpha[at[:k] + t - 1] @ trans) * psi[at[:k] + t]
        scale = a.sum(axis=1, keepdims=True)
        if pairs:
            log_norm += float(np.log(scale).sum())
        alpha[at[:k] + t] = a / scale
    out = np.empty((n, m), np.float64)
    moved = np.zeros((m, m))
    b = leave.copy()
    for t in range(BLOCK - 1, -1, -1):
        k = active[t]
        if not k:
            continue
        nxt = active[t + 1] if t + 1 < BLOCK else 0
        if nxt:
            pb = psi[at[:nxt] + t + 1] * b[:nxt]
            if pairs:
                joint = alpha[at[:nxt] + t][:, :, None] * trans[None] * pb[:, None, :]
                moved += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            w = pb @ trans.T
            b[:nxt] = w / w.max(axis=1, keepdims=True)
        g = alpha[at[:k] + t] * b[:k]
        out[at[:k] + t] = g / g.sum(axis=1, keepdims=True)
    if pairs:
        begins = out[np.cumsum(lengths) - lengths].sum(axis=0)
        return out, moved, begins, log_norm + float(peak.sum())
    return out


def spliced(texts: list[list[str]], labels: np.ndarray, n: int, length: int, rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """``n`` sequences of ``length`` words, each of stretches from documents of random languages."""
    kinds = [np.flatnonzero(labels == k) for k in range(labels.max() + 1)]
    tokens, gold = [], []
    for _ in range(n):
        left = length
        while left:
            own = rng.choice(kinds[rng.integers(len(kinds))])
            size = min(left, int(rng.integers(4, length + 1)))
            doc = texts[own]
            begin = int(rng.integers(max(1, len(doc) - size + 1)))
            part = doc[begin : begin + size]
            tokens += part
            gold += [labels[own]] * len(part)
            left -= len(part)
    return tokens, np.array(gold)


def buckets_for(languages: int) -> int:
    """Feature buckets, a power of two: BUCKETS, or fewer if the model had more than CELLS weights."""
    return max(1 << 10, min(BUCKETS, 1 << (max(1, CELLS // max(1, languages)).bit_length() - 1)))


def fit(texts: list[list[str]], labels: np.ndarray, languages: tuple[str, ...], sequences: int | None = None, length: int = BLOCK, epochs: int = 5, batch: int = 250, rate: float = 0.15, seed: int = 5) -> Model:
    """Stochastic gradient ascent (Adagrad) on the likelihood of spliced sequences, by default PER_LABEL for
    each language and MAX_SEQUENCES in all, with a small L2 pull."""
    m = len(languages)
    sequences, buckets_used = sequences or min(PER_LABEL * m, MAX_SEQUENCES), buckets_for(m)
    emission, transition, start = np.zeros((buckets_used, m)), np.zeros((m, m)), np.zeros(m)
    if m > 1:
        rng = np.random.default_rng(seed)
        g_e, g_t, g_s = np.full((buckets_used, m), 1e-6), np.full((m, m), 1e-6), np.full(m, 1e-6)
        tokens, gold = spliced(texts, labels, sequences, length, rng)
        vocabulary = {w: i for i, w in enumerate(dict.fromkeys(tokens))}
        names, owners, buckets = list(vocabulary), [], []
        for begin in range(0, len(names), 10_000):
            owner, bucket = word_features(names[begin : begin + 10_000], buckets_used)
            order = np.argsort(owner, kind="stable")
            owners.append((owner[order] + begin).astype(np.int32))
            buckets.append(bucket[order].astype(np.int32))
        owner, bucket = np.concatenate(owners), np.concatenate(buckets)
        first = np.searchsorted(owner, np.arange(len(vocabulary) + 1))
        ids = np.array([vocabulary[w] for w in tokens])
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(sequences), max(1, sequences // batch)):
                rows = (part[:, None] * length + np.arange(length)).reshape(-1)
                own, back = np.unique(ids[rows], return_inverse=True)
                counts = first[own + 1] - first[own]
                f = bucket[np.repeat(first[own] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
                who = np.repeat(np.arange(len(own)), counts)
                e = np.stack([np.bincount(who, emission[f, k], len(own)) for k in range(m)], axis=1)
                p, moved, begins, _ = marginals(e[back], np.full(len(part), length), transition, start, pairs=True)
                y = gold[rows]
                diff = -p
                diff[np.arange(len(y)), y] += 1
                by_word = np.stack([np.bincount(back, diff[:, k], len(own)) for k in range(m)], axis=1)
                touched, where = np.unique(f, return_inverse=True)
                grad = np.stack([np.bincount(where, by_word[who, k], len(touched)) for k in range(m)], axis=1) / len(part) - 1e-4 * emission[touched]
                pairs = y.reshape(-1, length)
                seen = np.bincount(pairs[:, :-1].reshape(-1) * m + pairs[:, 1:].reshape(-1), minlength=m * m).reshape(m, m)
                grad_t, grad_s = (seen - moved) / len(part) - 1e-3 * transition, (np.bincount(pairs[:, 0], minlength=m) - begins) / len(part) - 1e-3 * start
                g_e[touched] += grad**2
                emission[touched] += rate * grad / np.sqrt(g_e[touched])
                g_t += grad_t**2
                g_s += grad_s**2
                transition += rate * grad_t / np.sqrt(g_t)
                start += rate * grad_s / np.sqrt(g_s)
    return Model(languages, emission.astype(np.float32), transition, start)


def _windows(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            parts = []
            for text, draw in zip(batch.column("text").to_pylist(), batch.column("draw").to_pylist()):
                own = words(text)
                begin = draw % max(1, len(own) - size + 1)
                parts.append("\n".join(own[begin : begin + size]))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("draw"), pa.array(parts, pa.string())], names=["lang", "draw", "words"])

    return cut


def learn(labelled: DataFrame, per_language: int = 1500, window: int = WINDOW, windows: int = MAX_WINDOWS, **options) -> Model | None:
    """Fit on a bounded sample of (text, lang): about ``per_language`` distinct texts of each language, chosen by a
    hash of the text, and of each a window of at most ``window`` words, at a place that the hash gives, and about
    ``windows`` of all languages together. Every labelled text may be drawn, however long. None without any.

    The driver receives the windows, and a count for each language."""
    batch_bytes(labelled.sparkSession)
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang", F.xxhash64("text").alias("draw"))
    counts = stored(rows.groupBy(F.col("lang").alias("own")).agg(F.approx_count_distinct("draw").alias("n")), "languages")
    n_languages = counts.count()
    counts = F.broadcast(counts) if n_languages <= MAX_BROADCAST_LANGUAGES else counts
    each = min(per_language, windows / max(1, n_languages))
    below = F.least(F.lit(1_000_003.0), F.ceil(F.lit(each * 1_000_003.0) / F.col("n")))
    drawn = rows.join(counts, F.col("lang") == F.col("own")).filter(F.pmod("draw", F.lit(1_000_003)) < below).select("text", "lang", "draw")
    parts = drawn.mapInArrow(_windows(window), "lang string, draw long, words string").filter("words <> ''")
    sample = sorted((r["lang"], r["draw"], r["words"]) for r in parts.dropDuplicates(["lang", "draw"]).collect())
    if not sample:
        return None
    languages = tuple(sorted({lang for lang, _, _ in sample}))
    own = {lang: k for k, lang in enumerate(languages)}
    return fit([w.split("\n") for _, _, w in sample], np.array([own[lang] for lang, _, _ in sample]), languages, **options)


class Labeller:
    """Labels batches of texts; remembers the emissions of the words it has met, up to ``limit`` characters of them."""

    def __init__(self, model: Model, limit: int = 1_500_000):
        self.model, self.limit, self.rows, self.held = model, limit, {}, 0
        self.table = np.empty((0, len(model.languages)), np.float32)

    def _ids(self, tokens: list[str]) -> np.ndarray:
        get = self.rows.get
        ids = [get(w, -1) for w in tokens]
        if min(ids) < 0:
            new = list(dict.fromkeys(w for w, i in zip(tokens, ids) if i < 0))
            size = sum(map(len, new))
            if self.held + size > self.limit and self.rows:
                self.rows, self.held = {}, 0
                self.table = self.table[:0].copy()
                return self._ids(tokens)
            self.held += size
            self.rows.update(zip(new, range(len(self.table), len(self.table) + len(new))))
            self.table = np.concatenate([self.table, self.model.emissions(new)])
            ids = [self.rows[w] for w in tokens]
        return np.array(ids)

    def marginals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(words of each text, marginals of all words)."""
        split = [words(t) for t in texts]
        lengths = np.array([len(w) for w in split], np.int64)
        tokens = [w for ws in split for w in ws]
        if not tokens:
            return lengths, np.empty((0, len(self.model.languages)))
        m = self.model
        return lengths, marginals(self.table_rows(tokens), lengths[lengths > 0], m.transition, m.start)

    def table_rows(self, tokens: list[str]) -> np.ndarray:
        ids = self._ids(tokens)
        return self.table[ids]


SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("score", pa.float64())])


def _labels(model, keep: list[str]):
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        own, names = Labeller(m), pa.array(list(m.languages))
        for batch in slices(batches, "text", 2 << 20):
            lengths, p = own.marginals(batch.column("text").to_pylist())
            some = lengths > 0
            ends = np.cumsum(lengths)
            total = np.zeros((len(lengths), len(m.languages)))
            if len(p):
                total[some] = np.add.reduceat(p, (ends - lengths)[some])
            best = total.argmax(axis=1)
            share = total[np.arange(len(total)), best] / np.maximum(lengths, 1)
            lang = [m.languages[k] if s else "und" for k, s in zip(best.tolist(), some.tolist())]
            # spans: runs of one most probable language within a text
            top = p.argmax(axis=1) if len(p) else np.empty(0, np.int64)
            doc = np.repeat(np.arange(len(lengths)), lengths)
            cut = np.flatnonzero((np.diff(top, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
            stop = np.append(cut[1:], len(top))
            shift = (ends - lengths)[doc[cut]] if len(cut) else np.empty(0, np.int64)
            sums = np.add.reduceat(p[np.arange(len(top)), top], cut) / (stop - cut) if len(cut) else np.empty(0)
            offsets = np.zeros(len(lengths) + 1, np.int32)
            np.cumsum(np.bincount(doc[cut], minlength=len(lengths)), out=offsets[1:])
            values = pa.StructArray.from_arrays([pa.array((cut - shift).astype(np.int32)), pa.array((stop - shift).astype(np.int32)), names.take(pa.array(top[cut])), pa.array(sums)], fields=list(SPAN))
            spans = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(np.minimum(share, 1.0)), spans], names=[*keep, "lang_pred", "score", "spans"])

    return label


def label(docs: DataFrame, model: Model | None, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``keep`` columns of ``docs`` with lang_pred, score and spans (word places, language, mean marginal) of
    ``text``. A scan; no shuffle."""
    added = ("lang_pred", "score", "spans")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added and c != "text"]
    if model is None:
        none = F.array().cast("array<struct<start:int,end:int,lang:string,score:double>>")
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), none.alias("spans"))
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string,score:double>>"])
    spread = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(*keep, F.col(text).cast("string").alias("text")).mapInArrow(_labels(spread, keep), schema)


def _known_only(model, least: float):
    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Labeller(model.value)
        for batch in slices(batches, "text", 2 << 20):
            lengths, p = own.marginals(batch.column("text").to_pylist())
            best = np.zeros(len(lengths))
            some = lengths > 0
            if len(p):
                best[some] = np.add.reduceat(p.max(axis=1), (np.cumsum(lengths) - lengths)[some]) / lengths[some]
            yield batch.filter(pa.array(some & (best >= least)))

    return known


def known_language(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text is in known languages, one or several: at least one letter, and a mean
    marginal of the words' labels of at least ``least``. All columns stay as they are."""
    if model is None:
        return docs.limit(0)
    spread = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_known_only(spread, least), docs.schema)
