"""Fuzzy line deduplication.

A line is normalised to its lower-case words (ASCII signs and white space part them; each character of a script
without blanks, such as Chinese or Thai, is a word). Each distinct line gets a SimHash of its words. Equal
lines are one group, however short; a line of signs only is compared as it stands. ``line_groups`` links two lines of at least ``MIN_WORDS`` words if their word edit
similarity (1 - edits / longer line) is at least 0.8. Its bucket keys are pigeonhole blocks of words: an edit
breaks at most three runs of three words, so of a line's runs, in any order that is the same for all lines, the first
3 * edits + 1 hold one of any linked line. With ``exact``, as the query and the pipeline call it, all of these are taken and
SimHash is no test, so keys lose no link (parities of long lines are still a test, of eight standard deviations; words that a line
repeats are numbered before, and lines of LONG words or more are also compared by numbers of words by class); ``shared_runs``
deals them and leaves out lines that share too few, and each bucket is cut into groups that parities allow. Otherwise ``KEYS`` and (words / ``PER_KEY``) squared of them are, which is all that lines below 15 words and beyond
1,500 need; README has the measured recall between. The order prefers runs of long words, which are rare, so
buckets stay small, but not so much that an edit of the longest words takes all keys away. Within a bucket lines are tested by parities of their words, which bound their difference, and by
SimHash: similarity 0.8 flips about 13 of 64 bits (deviation 3.2), ``NEAR`` = 27 are let through. The words decide. Of every connected group (equal lines included) the
first occurrence, by document and line, is kept.

``line_classes`` is the strict form: lines below ``MIN_WORDS`` words stay apart, and links also need SimHashes
within ``RADIUS`` = 3 of 128 bits, so four blocks of 32 bits are its keys.

Texts are read once for hashes, SimHashes and keys; equal lines are one node from the start, however often they
stand, and only nodes are dealt by their keys; only lines that have a neighbour by SimHash in a bucket are read
again to be verified.

Defined results: blank lines are always kept and are classes of their own; null text is one empty
line; very long lines are compared whole, as any other; a document is a doc_id (null or not) with a text, so rows that
repeat both are one document, whose lines stay or go together, and other texts of the same id are documents of their
own; ties go to the lower doc_id, then text hash, then line; a null doc_id comes first; an empty table gives no rows;
further columns are kept by ``without_repeats`` and ignored by the others, whatever their names."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared_runs
from .common import batch_bytes, forget, may_differ, odd_sketches, release, slices, stored, text_of
from .graph import linked_groups
from .shared_runs import NODE

MIN_WORDS, RADIUS, SIMILARITY = 5, 3, 0.8
#: Bits of 64 in which SimHashes of similar lines may differ.
NEAR = 27
#: Keys of a line: KEYS and the square of its words over PER_KEY, as long lines repeat runs, or as many as are needed if that is less.
KEYS, PER_KEY = 8, 50
#: Bits of the parities of a line's words: those that are compared first, in one number with the words' count, and all.
ODD_FIRST, ODD = 48, 512
#: Words of a line from which parities fill up, so that the numbers of its words in COUNTS classes stand behind them, four in a number.
LONG, COUNTS = 256, 64
#: Lines that are read again are found by a bitmap of at most 2 to this power bits (16 MB), which is broadcast.
PLACE_BITS = 27
#: Words of the longest line whose edits are counted by bits, each word at most as many bits.
BITS = 20_000
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: ASCII letters and digits, line ends and everything beyond ASCII stay; the rest becomes blanks.
_KEPT = bytes(b if b >= 128 or b == 10 or chr(b).isalnum() else 32 for b in range(256))
#: Han, kana, Bopomofo, Yi, Thai, Lao, Burmese, Khmer, Tibetan: what is written without blanks between words.
_UNSPACED = re.compile("([\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua4cf\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff])")


def _lowered(text: str | None) -> str:
    return (text or "").lower()


def line_words(text: str | None) -> list[list[bytes]]:
    """The words of every line."""
    text = _lowered(text)
    if not text.isascii():
        text = _UNSPACED.sub(r" \1 ", text)
    return [line.split() for line in text.encode().translate(_KEPT).split(b"\n")]


def _signs(text: str | None) -> list[bytes]:
    """Every line as it stands, without blanks around it."""
    return [line.strip() for line in _lowered(text).encode().split(b"\n")]


def line_node(words: list[bytes]) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(b" ".join(words))).astype(np.int64))


def simhash(words: np.ndarray, starts: np.ndarray, parts: int = 2) -> np.ndarray:
    """(lines, parts) 64-bit halves of the SimHash of consecutive stretches of word hashes: each bit is the
    majority of its words' bits. Four bits are counted at once, in 16-bit lanes of a 64-bit sum."""
    out = np.empty((len(starts), parts), np.int64)
    sizes = np.diff(starts, append=len(words))
    with np.errstate(over="ignore"):
        halves = [words, (words ^ (words >> np.uint64(31))) * _MIX]
    for k, half in enumerate(halves[:parts]):
        bits = np.zeros(len(starts), np.uint64)
        for b in range(16):
            lanes = (half >> np.uint64(b)) & np.uint64(0x0001000100010001)
            counts = np.add.reduceat(lanes, starts).view(np.uint16).reshape(-1, 4)
            for lane, most in enumerate((counts.astype(np.int64) * 2 > sizes[:, None]).T):
                bits |= most.astype(np.uint64) << np.uint64(16 * lane + b)
        for line in np.flatnonzero(sizes >= 1 << 16):  # a lane would run over
            own = np.ascontiguousarray(half[starts[line] : starts[line] + sizes[line]])
            total = np.zeros(64, np.int64)
            for part in np.array_split(own, len(own) // 65_536 + 1):
                total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            bits[line] = np.packbits(total * 2 > sizes[line], bitorder="little").view("<u8")[0]
        out[:, k] = bits.view(np.int64)
    return out


def keys_needed(n: np.ndarray) -> np.ndarray:
    """Runs of three words, in hash order, among which a line of ``n`` words must share one with a linked line of
    ``m`` >= n words: every edit breaks at most three, an insertion two. The most runs break without an insertion
    or with the fewest insertions that allow one more edit."""
    return np.maximum(3 * (n // 5), n - 2 * -(-n // 5)) + 1


def _keys_taken(n: np.ndarray, exact: bool) -> np.ndarray:
    return keys_needed(n) if exact else np.minimum(keys_needed(n), KEYS + (n // PER_KEY) ** 2)


def _ordered_runs(words: np.ndarray, letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(line, run, place in order), by line, of the distinct runs of consecutive stretches of at least five word hashes, and
    (line, key) of both ends of those of five; ``letters`` has the words' lengths.

    Runs are ordered by exponential keys, weighted by the square of a run's letters."""
    line = np.repeat(np.arange(len(sizes)), sizes)
    left = (starts + sizes)[line] - np.arange(len(words))
    with np.errstate(over="ignore"):
        mixed = lambda x: (x ^ (x >> np.uint64(29))) * _MIX
        two = mixed(words[:-1] * np.uint64(3) + mixed(words[1:]))
        runs = mixed(mixed(two[:-1]) + words[2:])
        runs ^= runs >> np.uint64(32)
        # five words with the middle one replaced share no run of three, but both ends
        five = np.flatnonzero(sizes == MIN_WORDS)
        ends = np.concatenate([two[starts[five]] ^ np.uint64(1), two[starts[five] + 3] ^ np.uint64(2)])
    inner = np.flatnonzero(left[:-2] >= 3)
    owner, runs = line[inner], runs[inner]
    weight = (letters[:-2] + letters[1:-1] + letters[2:])[inner].astype(np.float64) ** 2
    score = -np.log(((runs >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
    # positive floats sort as their bits do; ties of what is left of them fall apart by line, then anyhow
    order = np.argsort((owner.astype(np.uint64) << np.uint64(42)) | (score.view(np.uint64) >> np.uint64(22)))
    owner, runs = owner[order], runs[order]
    fresh = np.append(True, (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1]))
    owner, runs = owner[fresh], runs[fresh]
    first = np.searchsorted(owner, np.arange(len(sizes)))
    return owner, runs, np.arange(len(owner)) - first[owner], np.concatenate([five, five]), ends


def block_keys(words: np.ndarray, letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(line, key), by line, for consecutive stretches of at least five word hashes; ``letters`` has the words' lengths."""
    owner, runs, place, five, ends = _ordered_runs(words, letters, starts, sizes)
    few = place < _keys_taken(sizes, exact)[owner]
    owner, keys = np.concatenate([owner[few], five]), np.concatenate([runs[few], ends]).view(np.int64)
    order = np.argsort(owner, kind="stable")
    return owner[order], keys[order]


def _hashes(words: list[list[bytes]]) -> np.ndarray:
    return np.frombuffer(b"".join([xxhash.xxh3_64_digest(x) for w in words for x in w]), ">u8").astype(np.uint64)


def _stirred(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _MIX
        x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def _word_hashes(data: bytes, first: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Hashes of the words of ``data``, all of them eight bytes at a time; long ones one by one."""
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    out = _stirred((eight[first] & mask[np.minimum(letters, 8)]) ^ (letters.astype(np.uint64) << np.uint64(56)))
    longer = np.flatnonzero(letters > 8)
    for at in range(8, 64, 8):
        if not len(longer):
            break
        out[longer] = _stirred(out[longer] ^ _stirred(eight[first[longer] + at] & mask[np.minimum(letters[longer] - at, 8)]) + np.uint64(at))
        longer = longer[letters[longer] > at + 8]
    for i in longer:
        out[i] = xxhash.xxh3_64_intdigest(data[first[i] : first[i] + letters[i]])
    return out


def _laid_out(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """``line_words`` of all texts at once: lines of each text, words of each line, place and length of each word, and the bytes
    that these places are in."""
    plain = [_lowered(t) for t in texts]
    plain = [(t if t.isascii() else _UNSPACED.sub(r" \1 ", t)).encode().translate(_KEPT) for t in plain]
    data = b"\n".join([*plain, b"\0" * 8])
    raw = np.frombuffer(data, np.uint8)[:-8]
    between = (raw == 32) | (raw == 10)
    after = np.append(True, between[:-1])
    first, ends = np.flatnonzero(after & ~between), np.flatnonzero(between & ~after)
    line = np.searchsorted(np.flatnonzero(raw == 10), first)
    counts = np.array([t.count(b"\n") + 1 for t in plain], np.int64)
    return counts, np.bincount(line, minlength=counts.sum()), first, ends - first, data


def _names(texts: list[str | None], counts: np.ndarray, sizes: np.ndarray, first: np.ndarray, letters: np.ndarray, data: bytes) -> list[bytes]:
    """The words of every line with a blank between; of a line of signs only these, behind a line end."""
    raw = np.frombuffer(data, np.uint8)[:-8]
    kept = (raw != 32) & (raw != 10)
    line = np.repeat(np.arange(len(sizes)), sizes)
    kept[(first + letters)[:-1][line[1:] == line[:-1]]] = True
    joined = raw[kept].tobytes()
    ends = np.cumsum(np.bincount(line, letters, len(sizes)).astype(np.int64) + np.maximum(sizes - 1, 0))
    names = [joined[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
    at = np.cumsum(counts) - counts
    for k in np.flatnonzero(np.add.reduceat(sizes == 0, at)) if len(at) else ():
        for i, signs in enumerate(_signs(texts[k]), at[k]):
            names[i] = names[i] or (signs and b"\n" + signs)
    return names


def _short_node(name: bytes) -> tuple[int, int]:
    """Of a line, NODE bits of a hash, and another hash."""
    return xxhash.xxh3_64_intdigest(name) & ((1 << NODE) - 1), int(np.uint64(xxhash.xxh3_64_intdigest(name, 1)).astype(np.int64))


def _line_namer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``hashed_lines`` without keys: of every line its place, ``_short_node`` and other hash."""
    for batch in slices(batches, "text", 2 << 20):
        texts = batch.column("text").to_pylist()
        counts, *laid = _laid_out(texts)
        names = _names(texts, counts, *laid)
        blank = np.array([not n for n in names])
        nodes = np.array([xxhash.xxh3_64_intdigest(n) for n in names], np.uint64) & np.uint64((1 << NODE) - 1)
        other = np.array([xxhash.xxh3_64_intdigest(n, 1) for n in names], np.uint64)
        of = pa.array(np.repeat(np.arange(len(texts)), counts))
        line_no = np.arange(len(names)) - np.repeat(np.cumsum(counts) - counts, counts)
        columns = [*(batch.column(c).take(of) for c in ("doc_id", "row")), pa.array(line_no.astype(np.int32)), pa.array(nodes.view(np.int64), mask=blank), pa.array(other.view(np.int64), mask=blank)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "line_no", "node", "low"])


def _run_dealer(parts: int):
    """Records of the runs of every line of at least MIN_WORDS words, for ``shared_runs``."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            texts = batch.column("text").to_pylist()
            counts, sizes, first, letters, data = _laid_out(texts)
            some = sizes >= MIN_WORDS
            if not some.any():
                continue
            names = _names(texts, counts, sizes, first, letters, data)
            inside = np.repeat(some, sizes)
            own, first, letters = sizes[some], first[inside], letters[inside]
            line, runs, place, five, ends = _ordered_runs(_word_hashes(data, first, letters), letters, np.cumsum(own) - own, own)
            needed = keys_needed(own)
            least = shared_runs.least_shared(own, needed, np.bincount(line, minlength=len(own))).astype(np.uint8)
            few = place < shared_runs.keys_dealt(own, needed)[line]
            base = np.append((place < needed[line])[few], np.ones(len(five), bool))
            line, keys = np.append(line[few], five), np.append(runs[few], ends)
            nodes = np.array([xxhash.xxh3_64_intdigest(names[i]) for i in np.flatnonzero(some)], np.uint64)
            records = shared_runs.packed(nodes[line], keys, base, shared_runs.length_code(own)[line], least[line])
            yield from shared_runs.dealt(shared_runs.part_of(keys, parts), records)

    return deal


def numbered(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of consecutive stretches of words, of which a word's second, third, ... place in a stretch has one of its own: bags
    become sets that differ in as many elements. Parities see nothing of a word that one line has 28 times and another not at all."""
    line = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((hashes, line))
    words, line = hashes[order], line[order]
    at = np.arange(len(words))
    again = np.append(False, (words[1:] == words[:-1]) & (line[1:] == line[:-1]))[: len(words)]
    number = (at - np.maximum.accumulate(np.where(again, 0, at))).astype(np.uint64)
    out = np.empty_like(hashes)
    with np.errstate(over="ignore"):
        out[order] = np.where(again, _stirred(words + number * _MIX), words)
    return out


def _bag_lists(hashes: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Of every line the ODD parities of its bag of words and, from LONG words, their numbers by class. Two bags differ in at
    least as many words as these numbers do in all; parities of several hundred differences are as good as random."""
    odd, long = odd_sketches(numbered(hashes, sizes), sizes, ODD), sizes >= LONG
    own = np.flatnonzero(np.repeat(long, sizes))
    row = np.repeat(np.arange(long.sum()), sizes[long])
    counts = np.bincount(row * COUNTS + (_stirred(hashes[own]) % np.uint64(COUNTS)).astype(np.int64), minlength=long.sum() * COUNTS)
    counts = np.minimum(counts, 0xFFFF).astype("<u2").view("<i8").reshape(-1, COUNTS // 4)
    ends = np.cumsum(np.where(long, odd.shape[1] + counts.shape[1], odd.shape[1]))
    starts, out = np.append(0, ends[:-1]), np.empty(ends[-1], np.int64)
    out[starts[:, None] + np.arange(odd.shape[1])] = odd
    out[starts[long][:, None] + odd.shape[1] + np.arange(counts.shape[1])] = counts
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(out))


def _bags(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``_bag_lists`` put together: parities, numbers by class of long lines, and of every line its row in them (-1: none)."""
    flat, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
    starts, long = np.cumsum(sizes) - sizes, sizes > ODD // 64
    counts = flat[starts[long][:, None] + ODD // 64 + np.arange(COUNTS // 4)]
    odd = flat[starts[:, None] + np.arange(ODD // 64)].view(np.uint64)
    return odd, np.ascontiguousarray(counts).view("<u2").astype(np.int32), np.where(long, np.cumsum(long) - 1, -1)


def _marks(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of every line the parities of ODD_FIRST classes of words, above 16 bits of the number of its words."""
    out = np.empty(len(sizes), np.int64)
    classes = (hashes % np.uint64(ODD_FIRST)).astype(np.int64) + (64 - ODD_FIRST)
    at = np.repeat(np.arange(len(sizes)), sizes) * 64 + classes
    odd = (np.bincount(at, minlength=64 * len(sizes)) & 1).astype(np.uint8).reshape(len(sizes), 64)
    out[:] = np.packbits(odd, axis=1, bitorder="little").view("<i8")[:, 0]
    return out | np.minimum(sizes, 0xFFFF)


def _line_hasher(parts: int):
    """Hashes of every line, and the first ``parts`` halves of a 128-bit SimHash."""

    def hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            yield _hash_lines(batch, parts)

    return hash_lines


def _hash_lines(batch: pa.RecordBatch, parts: int) -> pa.RecordBatch:
    lines = [line_words(t) for t in batch.column("text").to_pylist()]
    every = [w for own in lines for w in own]
    counts = np.array([len(own) for own in lines])
    names = [b" ".join(w) for w in every]
    if not all(names):
        signs = [x for t in batch.column("text").to_pylist() for x in _signs(t)]
        names = [n or (x and b"\n" + x) for n, x in zip(names, signs)]
    part = np.array([len(n) > 0 for n in names])
    long = [w or [n] for w, n in zip(every, names) if n]
    nodes, marks = np.zeros(len(every), np.int64), np.zeros((len(every), 2), np.int64)
    first_marks = np.zeros(len(every), np.int64)
    n_keys, keys = np.zeros(len(every) + 1, np.int32), np.empty(0, np.int64)
    if long:
        nodes[part] = np.array([xxhash.xxh3_64_intdigest(n) for n in names if n], np.uint64).view(np.int64)
        sizes = np.array([len(w) for w in long])
        starts, hashes = np.cumsum(sizes) - sizes, _hashes(long)
        marks[part, :parts] = simhash(hashes, starts, parts)
        some = sizes >= MIN_WORDS
        if some.any():
            inside = np.repeat(some, sizes)
            letters = np.array([len(x) for w in long for x in w], np.int32)[inside]
            own = sizes[some]
            line, keys = block_keys(hashes[inside], letters, np.cumsum(own) - own, own)
            at = np.flatnonzero(part)[some]
            n_keys[1:][at] = np.bincount(line, minlength=len(own))
            first_marks[at] = _marks(hashes[inside], own)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(c).take(pa.array(np.repeat(np.arange(len(lines)), counts))) for c in ("doc_id", "row")),
            pa.array((np.arange(len(every)) - first).astype(np.int32)),
            pa.array(nodes, mask=~part),
            pa.array(marks[:, 0], mask=~part),
            pa.array(marks[:, 1], mask=~part),
            pa.array(np.array([len(w) for w in every], np.int32)),
            pa.ListArray.from_arrays(pa.array(np.cumsum(n_keys, dtype=np.int32)), pa.array(keys)),
            pa.array(first_marks),
        ],
        names=["doc_id", "row", "line_no", "node", "low", "high", "n_words", "keys", "mark"],
    )


def hashed_lines(docs: DataFrame, parts: int = 2) -> DataFrame:
    """Every line: doc_id, row (hash of the text), line_no, node (hash of its words; null if it is blank), low and high (SimHash), n_words, keys, mark."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("row"))
    return plain.mapInArrow(_line_hasher(parts), "doc_id long, row long, line_no int, node long, low long, high long, n_words int, keys array<long>, mark long")


def within(a: list[str], b: list[str], most: int) -> bool:
    """Whether at most ``most`` words must be inserted, removed or replaced to turn ``a`` into ``b``.

    As many edits are needed as the larger of the bags' two differences has words; beyond that, all rows of a column of
    the table of distances are turned at once, as the bits of a number (Myers, Hyyrö). Bits of very long lines would
    take too much memory: for them, the furthest place on each diagonal for 0, 1, 2, ... edits."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return False
    head = 0
    while head < n and head < m and a[head] == b[head]:
        head += 1
    while n > head and m > head and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    a, b = sorted((a[head:n], b[head:m]), key=len)
    n, m = len(a), len(b)
    if m <= most or not n:
        return m <= most
    left = Counter(b)
    left.subtract(a)
    if sum(x for x in left.values() if x > 0) > most:
        return False
    return _within_by_bits(a, b, most) if n <= BITS else _within_by_diagonals(a, b, most)


def _within_by_bits(a: list[str], b: list[str], most: int) -> bool:
    """``within`` of lines that aren't empty: bits of ``up`` and ``down`` tell which rows of a column of the table of
    distances are one more or less than the row before."""
    n, m, places = len(a), len(b), {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    every, last = (1 << n) - 1, 1 << (n - 1)
    up, down, distance = every, 0, n
    for j, word in enumerate(b):
        equal = places.get(word, 0)
        level = equal | down
        across = (((equal & up) + up) ^ up) | equal
        more, less = (down | ~(across | up)) & every, up & across
        if more & last:
            distance += 1
        elif less & last:
            distance -= 1
        if distance - (m - 1 - j) > most:
            return False
        more, less = more << 1 | 1, less << 1
        up, down = (less | ~(level | more)) & every, more & level & every
    return distance <= most


def _within_by_diagonals(a: list[str], b: list[str], most: int) -> bool:
    n, m = len(a), len(b)
    goal, far = m - n, {0: 0}
    for edits in range(most + 1):
        nxt: dict[int, int] = {}
        for d in range(-edits, edits + 1):
            i = far[0] if not edits else max(far.get(d, -2) + 1, far.get(d - 1, -2), far.get(d + 1, -2) + 1)
            i = min(i, n, m - d)
            if i < 0 or i + d < 0:
                continue
            while i < n and i + d < m and a[i] == b[i + d]:
                i += 1
            nxt[d] = i
        if nxt.get(goal, -1) >= n:
            return True
        far = nxt
    return False


def similar(a: str, b: str, similarity: float = SIMILARITY) -> bool:
    x, y = a.split(" "), b.split(" ")
    return within(x, y, int((1 - similarity) * max(len(x), len(y)) + 1e-9))


def _verifier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "x"):
        good = [similar(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))


def _place_bits(doc_id: pa.Array, line_no: np.ndarray, n_bits: int) -> np.ndarray:
    """(places, 2) bits that stand for places of lines in ``_places``."""
    ids = pc.fill_null(doc_id, 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        mixed = _stirred(_stirred(ids) + line_no.astype(np.uint64))
    return np.stack([mixed, mixed >> np.uint64(32)], axis=1) & np.uint64(n_bits - 1)


def _places(known: DataFrame) -> np.ndarray:
    """A bitmap in which both bits of every first occurrence are set, 16 bits an occurrence and PLACE_BITS at most: what else has
    them set costs a line that is read in vain. Texts need no shuffle for it."""
    n_bits = 1 << max(10, min(PLACE_BITS, (16 * known.count()).bit_length()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.unique(_place_bits(batch.column("at"), batch.column("line_no").to_numpy(), n_bits))
            if len(bits):
                first = np.flatnonzero(np.append(True, bits[1:] >> np.uint64(6) != bits[:-1] >> np.uint64(6)))
                own = np.bitwise_or.reduceat(np.uint64(1) << (bits & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array((bits[first] >> np.uint64(6)).view(np.int64)), pa.array(own.view(np.int64))], names=["word", "bits"])

    found = known.select(F.col("first.doc_id").alias("at"), "first.line_no").mapInArrow(words, "word long, bits long")
    found = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(n_bits >> 6, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _line_reader(parts: int, exact: bool, places: np.ndarray):
    """Lines of at least MIN_WORDS words whose place is in ``places``, with what they are compared by."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            texts = batch.column("text").to_pylist()
            counts = np.array([(t or "").count("\n") + 1 for t in texts])
            ends = np.cumsum(counts)
            line_no = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
            bits = _place_bits(batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(texts)), counts))), line_no, len(places) << 6)
            wanted = ((places[bits >> np.uint64(6)] >> (bits & np.uint64(63))) & np.uint64(1)).all(axis=1)
            lines = []
            for text, end, n in zip(texts, ends.tolist(), counts.tolist()):
                numbers = np.flatnonzero(wanted[end - n : end]).tolist()
                if numbers:
                    own = line_words(text)
                    lines += [own[i] for i in numbers if len(own[i]) >= MIN_WORDS]
            if lines:
                sizes = np.array([len(w) for w in lines])
                hashes = _hashes(lines)
                marks = np.zeros((len(lines), 2), np.int64)
                nodes = [line_node(w) for w in lines]
                if exact:
                    nodes, marks[:, 0] = zip(*(_short_node(b" ".join(w)) for w in lines))
                else:
                    marks[:, :parts] = simhash(hashes, np.cumsum(sizes) - sizes, parts)
                odd = _bag_lists(hashes, sizes)
                columns = [pa.array(nodes), pa.array(marks[:, 0]), pa.array(marks[:, 1]), pa.array(sizes), odd, pa.array([b" ".join(w).decode() for w in lines])]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "low", "high", "n_words", "odd", "line"])

    return read


def _differ(x: str, y: str, *halves: str) -> Column:
    """Bits in which two SimHashes differ."""
    return sum((F.bit_count(F.col(f"{x}.{h}").bitwiseXOR(F.col(f"{y}.{h}"))) for h in halves), F.lit(0))


def _shared(members: DataFrame) -> DataFrame:
    """Rows of ``members`` whose key stands with two nodes or more."""
    bucket = Window.partitionBy("key")
    rows = members.withColumns({"lo": F.min("node").over(bucket), "hi": F.max("node").over(bucket)})
    return stored(rows.filter("lo < hi").drop("lo", "hi"), "line-buckets")


def _near(marks: DataFrame, likely: Column) -> DataFrame:
    """Nodes of ``marks`` (key, node, f) that have a likely neighbour (x, y) in a bucket; the semi join stops at the
    first and makes no pairs."""
    x, y = (marks.select(F.col("key").alias(f"key_{s}"), F.col("node").alias(f"node_{s}"), F.col("f").alias(s)) for s in ("x", "y"))
    near = x.join(y, (F.col("key_x") == F.col("key_y")) & (F.col("node_x") != F.col("node_y")) & likely, "left_semi")
    return stored(near.select(F.col("node_x").alias("node")).distinct(), "line-near")


def _most_bits(n_words: int) -> np.ndarray:
    """For each number of words in which two bags may differ, up to the one given, the bits that ``may_differ`` allows."""
    most = np.arange(n_words + 1, dtype=np.float64)
    share = (1 - (1 - 2 / ODD) ** most) / 2
    return np.where(most <= ODD // 4, most, np.minimum(most, ODD * share + 8 * np.sqrt(ODD * share * (1 - share)) + 1e-6))


def _alike_sets(key: np.ndarray, n: np.ndarray, odd: np.ndarray, counts: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Of rows in order of keys and words, the first row of the group that those form which ``_bags_allow`` within a key: each is
    compared with the 1st, 2nd, 3rd, ... after it, as long as the lengths allow a link; ``counts`` and ``row`` as in ``_bags``."""
    top, bits = np.arange(len(key)), _most_bits(20_000)
    at = np.arange(len(key))
    for step in range(1, len(key)):
        at = at[at + step < len(key)]
        edits = ((1 - SIMILARITY) * n[at + step] + 1e-9).astype(np.int64)
        at = at[(key[at] == key[at + step]) & (n[at + step] - n[at] <= edits)]
        if not len(at):
            break
        open_ = at[top[at] != top[at + step]]
        for x in np.array_split(open_, len(open_) // 100_000 + 1):
            y = x + step
            most = 2 * ((1 - SIMILARITY) * n[y] + 1e-9).astype(np.int64) - (n[y] - n[x])
            good = np.bitwise_count(odd[x] ^ odd[y]).sum(axis=1, dtype=np.int64) <= bits[np.minimum(most, len(bits) - 1)]
            x, y, most = x[good], y[good], most[good]
            both = np.flatnonzero((row[x] >= 0) & (row[y] >= 0))
            apart = both[np.abs(counts[row[x[both]]] - counts[row[y[both]]]).sum(axis=1) > most[both]]
            x, y = np.delete(x, apart), np.delete(y, apart)
            while (top[x] != top[y]).any():
                np.minimum.at(top, np.maximum(top[x], top[y]), np.minimum(top[x], top[y]))
                while (top[top] != top).any():
                    top = top[top]
    return top


def _likely_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct groups of ``_alike_sets`` of rows that come in order of keys and words."""
    held, rows = [], 0

    def cut(last: bool) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        key = table.column("key").to_numpy()
        end = len(key) if last else int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        done = table.slice(0, end)
        held[:] = table.slice(end).to_batches()
        if end:
            top = _alike_sets(key[:end], done.column("n_words").to_numpy(), *_bags(done.column("odd").combine_chunks()))
            yield from shared_runs.sets(top.astype(np.uint64), done.column("node").to_numpy().view(np.uint64))

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 100_000:
                yield from cut(False)
                rows = 0
    if held:
        yield from cut(True)


def _nodes(lines: DataFrame) -> DataFrame:
    """The distinct lines: node, first (occurrence), low and high (and low_2, high_2, the same unless lines share a hash), keys and
    mark if lines have them, n (occurrences)."""
    found = lines.filter("node is not null").groupBy("node")
    first = F.min(F.struct("doc_id", "row", "line_no")).alias("first")
    if "keys" not in lines.columns:
        found = found.agg(first, F.min("low").alias("low"), F.max("low").alias("low_2"), F.count(F.lit(1)).alias("n"))
        return stored(found.withColumns({"high": F.lit(0).cast("long"), "high_2": F.lit(0).cast("long")}), "line-nodes")
    return stored(found.agg(first, F.min("low").alias("low"), F.max("low").alias("low_2"), F.min("high").alias("high"), F.max("high").alias("high_2"), F.first("keys").alias("keys"), F.first("mark").alias("mark"), F.count(F.lit(1)).alias("n")), "line-nodes")


def _bags_allow(n: Column, m: Column, within: Callable[[Column], Column]) -> Column:
    """Whether lines of ``n`` and ``m`` words may be similar. As many edits are needed as the larger of their bags'
    two differences has words, so the bags differ in at most twice that, less the difference of their sizes."""
    edits = F.floor((1 - SIMILARITY) * F.greatest(n, m) + 1e-9)
    return (F.abs(n - m) <= edits) & within(2 * edits - F.abs(n - m))


def line_classes(docs: DataFrame) -> DataFrame:
    """``line_groups`` of lines whose SimHashes differ in at most RADIUS bits."""
    return _classes(docs, strict=True).drop("row")


def line_groups(docs: DataFrame, exact: bool = False) -> DataFrame:
    """Per line: doc_id, line_no, class_doc_id and class_line_no (the kept occurrence of its group), kept.

    With ``exact`` every linked pair shares a key, at about 0.6 keys a word, and is tested by its words alone."""
    return _classes(docs, strict=False, exact=exact).drop("row")


def _classes(docs: DataFrame, strict: bool, exact: bool = False) -> DataFrame:
    batch_bytes(docs.sparkSession)
    parts = 2 if strict else 1
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if exact:
        buckets = shared_runs.buckets(plain, _run_dealer)
        release(docs.sparkSession)
        named = plain.withColumn("row", F.xxhash64("text")).mapInArrow(_line_namer, "doc_id long, row long, line_no int, node long, low long")
        lines = hashed = stored(named, "lines")
    else:
        lines = hashed_lines(docs, parts)
        if strict:
            lines = lines.withColumn("node", F.when(F.col("n_words") >= MIN_WORDS, F.col("node")))
        lines = hashed = stored(lines.drop("n_words"), "lines")
    nodes = _nodes(lines)
    clashes = stored(nodes.filter((F.col("low") != F.col("low_2")) | (F.col("high") != F.col("high_2"))).select(F.col("node").alias("clash")), "clashes")
    clash = not clashes.isEmpty()

    high = F.lit(0).cast("long") if exact else F.col("high")

    def apart(rows: DataFrame) -> DataFrame:
        """Lines that 64 bits don't tell apart have different SimHashes, and get nodes of their own."""
        if not clash:
            return rows
        own = F.when(F.col("clash").isNotNull(), F.xxhash64("node", "low", high)).otherwise(F.col("node"))
        return rows.join(clashes, F.col("node") == F.col("clash"), "left").withColumn("node", own).drop("clash")

    if clash and exact:
        owns = lines.join(clashes, F.col("node") == F.col("clash")).select("clash", F.xxhash64("node", "low", high).alias("own")).distinct()
        both = owns.select(F.col("clash").alias("key"), F.col("own").alias("node"))
        buckets = stored(buckets.join(owns, F.col("node") == F.col("clash"), "left").select("key", F.coalesce("own", "node").alias("node")).unionByName(both), "line-buckets")
    if clash:
        lines = apart(lines)
        nodes = _nodes(lines)

    def likely(x: str, y: str) -> Column:
        if exact:
            return F.lit(True)
        return _differ(x, y, "low", "high") <= RADIUS if strict else _differ(x, y, "low") <= NEAR

    def alike(x: str, y: str) -> Column:
        return likely(x, y) & _bags_allow(F.col(f"{x}.n_words"), F.col(f"{y}.n_words"), lambda most: may_differ(F.col(f"{x}.odd"), F.col(f"{y}.odd"), most, ODD, 8 if exact else 5))

    def marked(x: str, y: str) -> Column:
        count = lambda s: F.col(f"{s}.mark").bitwiseAND(F.lit(0xFFFF))
        differ = F.bit_count(F.shiftrightunsigned(F.col(f"{x}.mark").bitwiseXOR(F.col(f"{y}.mark")), 64 - ODD_FIRST))
        return (F.greatest(count(x), count(y)) == 0xFFFF) | _bags_allow(count(x), count(y), lambda most: differ <= most)

    # only lines that have a neighbour by SimHash are read again
    if strict:
        low = lambda half: F.col(half).bitwiseAND(F.lit(0xFFFFFFFF))
        high = lambda half: F.shiftrightunsigned(half, 32)
        values = [low("low"), high("low"), low("high"), high("high")]
        blocks = F.array(*[F.lit(k << 32) + v for k, v in enumerate(values)])
        buckets = _shared(nodes.select("node", F.explode(blocks).alias("key")))
        marks = stored(buckets.join(nodes.select("node", F.struct("low", "high").alias("f")), "node"), "line-marks")
        near = _near(marks, likely("x", "y"))
    elif exact:
        near = stored(buckets.select("node").distinct(), "line-near")
    else:
        buckets = _shared(nodes.select("node", "mark", F.explode("keys").alias("key")))
        near = _near(buckets.select("key", "node", F.struct("mark").alias("f")), marked("x", "y"))
    if not exact:
        every, buckets = buckets, stored(buckets.join(near, "node", "left_semi").select("key", "node").distinct(), "line-buckets")
        forget(every)
    known = stored(nodes.join(near, "node", "left_semi").drop("keys", "mark"), "line-candidates")
    # the keys, most of what is stored, have done their work
    wide, nodes = nodes, stored(nodes.select("node", "first", "n"), "line-nodes")
    forget(wide)
    lines = stored(lines.select("doc_id", "row", "line_no", "node"), "lines")
    forget(hashed)
    release(docs.sparkSession)
    read = plain.select("doc_id", "text").mapInArrow(_line_reader(parts, exact, _places(known)), "node long, low long, high long, n_words long, odd array<long>, line string")
    # a repeated doc_id may bring a line twice, or one that isn't wanted
    texts = stored(apart(read).join(known.select("node"), "node", "left_semi").dropDuplicates(["node"]), "line-texts")
    release(docs.sparkSession)

    def confirm(pairs: DataFrame) -> DataFrame:
        x, y = texts.select(F.col("node").alias("a"), F.col("line").alias("x")), texts.select(F.col("node").alias("b"), F.col("line").alias("y"))
        return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verifier, "a long, b long")

    # the parities of their words leave few that aren't similar
    features = texts.select("node", "n_words", "odd") if exact else texts.select("node", "low", "high", "n_words", "odd")
    if exact:
        members = buckets.join(features, "node").select("key", "node", "n_words", "odd").repartition("key").sortWithinPartitions("key", "n_words")
        every, buckets = buckets, shared_runs.spread_sets(members.mapInArrow(_likely_members, shared_runs.SETS))
        forget(every)
        features = features.join(buckets.select("node").distinct(), "node", "left_semi")
    else:
        marks = stored(buckets.join(features.select("node", F.struct("low", "high", "n_words", "odd").alias("f")), "node"), "line-marks")
        close = _near(marks, alike("x", "y"))
        buckets = stored(buckets.join(close, "node", "left_semi"), "line-buckets")
        forget(marks)
    release(docs.sparkSession)
    groups = linked_groups(buckets, features, alike, confirm, rounds=2)
    # most lines stand once and alone; only the others look for who stays
    linked = known.select("node", "first").join(groups, "node")
    keeper = linked.groupBy("root").agg(F.min("first").alias("keeper"))
    grouped = linked.join(keeper, "root").select(F.col("node").alias("own"), "keeper")
    by_node = nodes.select("node", "first", "n").join(grouped, F.col("node") == F.col("own"), "left").filter("n > 1 or keeper is not null")
    by_node = by_node.select("node", F.coalesce("keeper", "first").alias("keeper"))
    out = lines.select("doc_id", "row", "line_no", "node").join(by_node, "node", "left")
    own = F.struct("doc_id", "row", "line_no")
    out = out.withColumn("keeper", F.coalesce("keeper", own))
    return out.select("doc_id", "row", "line_no", F.col("keeper.doc_id").alias("class_doc_id"), F.col("keeper.line_no").alias("class_line_no"), F.col("keeper").eqNullSafe(own).alias("kept"))


def without_repeats(docs: DataFrame, exact: bool = False) -> DataFrame:
    """``docs`` with the lines that are not kept taken out of ``text``; a document that had words and has
    none left is gone."""
    gone = _classes(docs, strict=False, exact=exact).filter(~F.col("kept")).groupBy(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row")).agg(F.collect_set("line_no").alias("lines"))
    d, g = docs.alias("d"), gone.alias("g")
    rows = d.join(g, F.col("d.doc_id").cast("long").eqNullSafe(F.col("g.gone_id")) & (F.xxhash64(F.col("d.text").cast("string")) == F.col("g.gone_row")), "left")
    lines = F.split(text_of("d.text"), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("g.lines"))
    text = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    text = F.when(F.col("g.lines").isNull(), F.col("d.text")).otherwise(text)
    columns = [text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns]
    return rows.filter(F.col("g.lines").isNull() | (F.length(F.trim(text)) > 0)).select(*columns)
