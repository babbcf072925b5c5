"""Exact token ids at a cost that follows distinct words: pre-token units are encoded once and remembered.

A byte-level BPE splits a text into pre-tokens before merging, and no pre-token crosses the places where
this module cuts (before a space that precedes a word, and around white-space runs). So the ids of a text
are those of its units, one after the other; the tokenizers library makes the ids of every unit. Units are
cut and numbered over the bytes of a whole batch; those that it adds are encoded together: units of one or two
plain pre-tokens by the model alone, in strings with a mark between them, the others by the whole tokenizer."""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import CharDelimiterSplit

# White space as the tokenizer's pattern has it: fixed values.
_ASCII_BLANKS = b"\t\n\x0b\x0c\r "
_WIDE_BLANKS = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_IS_BLANK = np.isin(np.arange(256), list(_ASCII_BLANKS))
#: Lines of letters, with a space before them or not, are one pre-token, and a run of signs after them is a second
#: one. Letter classes are the same in every Unicode version up to here.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_SIGNS = r"!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"
_PLAIN = re.compile(f"^( ?[{_LETTERS}]+)([{_SIGNS}]*)$", re.M)
#: Units of one string for the model; a unit is remembered up to a length if a batch has it often enough.
_CHUNK, _LONG, _OFTEN = 100, 64, 3
#: New units that are encoded at once; the library needs some hundred bytes for each.
_BLOCK = 20_000
#: Text bytes that are best encoded at once: few words are new in a large batch.
BATCH_BYTES = 12 << 20


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TextEncoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit integers. ``spec`` is the tokenizer's JSON;
    without a plain byte-level pre-tokenizer and normalizer it encodes text by text, as it does texts with a
    special token or with white space beyond ASCII.

    Two generations of at most ``limit`` units are remembered."""

    def __init__(self, spec: str, limit: int = 80_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer, self.limit = Tokenizer.from_str(spec), limit
        pre, model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        letters = _byte_letters()
        mark = letters[0]  # the letter of byte 0, which no word has
        self.mark = getattr(model, "token_to_id", lambda _: None)(mark)
        self.by_unit = type(pre).__name__ == "ByteLevel" and pre.use_regex and not pre.add_prefix_space and self.tokenizer.normalizer is None
        self.by_unit = self.by_unit and self.mark is not None and not (model.continuing_subword_prefix or model.end_of_word_suffix or model.dropout)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join([*special, *_WIDE_BLANKS]).encode())
        self.bare = Tokenizer(model)
        self.bare.pre_tokenizer = CharDelimiterSplit(" ")
        self.table = letters | {10: f" {mark} "}
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of single pre-tokens: the model's merges alone."""
        chunks = ["\n".join([*words[i : i + _CHUNK], ""]).encode().decode("latin-1").translate(self.table) for i in range(0, len(words), _CHUNK)]
        ids = [np.array(e.ids, "<u4") for e in self.bare.encode_batch_fast(chunks, add_special_tokens=False)]
        if not ids:
            return []
        every = np.concatenate(ids)
        stops = 4 * np.flatnonzero(every == self.mark)
        data, starts = every.tobytes(), [0, *(stops[:-1] + 4).tolist()]
        return [data[a:b] for a, b in zip(starts, stops.tolist(), strict=True)]

    def _made(self, units: list[str]) -> dict[str, bytes]:
        """Ids of units that aren't known yet."""
        plain = _PLAIN.findall("\n".join(units)) if self.by_unit else []
        words, pairs = [w for w, signs in plain if not signs], [p for p in plain if p[1]]
        parts = set(chain.from_iterable(pairs)).difference(words)
        have = {p: self.known[p] for p in parts if p in self.known}
        need = [*words, *parts.difference(have)]
        made = dict(zip(need, self._words(need), strict=True))
        have.update(made)
        made.update([(word + signs, have[word] + have[signs]) for word, signs in pairs])
        rest = [u for u in units if u not in made]
        made.update(zip(rest, self._whole(rest), strict=True))
        return made

    def _cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Places of ``data`` where a unit begins."""
        n, step = len(data), 1 << 20
        cut = np.zeros(n, bool)
        if self.by_unit:
            blank = np.append(_IS_BLANK[data], True)
            ends = starts[1:] - 1  # no word follows the last character of a text
            for a in range(1, n, step):
                b = min(n, a + step)
                before, now, word_next = blank[a - 1 : b - 1], blank[a:b], ~blank[a + 1 : b + 1]
                word_next[ends[(ends >= a) & (ends < b)] - a] = False
                # a white-space run begins; its last character stands apart; a word follows what isn't a space
                cut[a:b] = now & (~before | word_next) | ~now & before & (data[a - 1 : b - 1] != 32)
            raw = data.tobytes()
            for place in {int(np.searchsorted(starts, m.start(), "right")) - 1 for m in self.odd.finditer(raw)}:
                cut[starts[place] : starts[place + 1]] = False
        cut[starts[:-1][starts[:-1] < starts[1:]]] = True
        return np.flatnonzero(cut).astype(np.int32)

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, pa.Buffer]:
        """(bounds, data): the ids of text i are those from bounds[i] to bounds[i + 1]; null counts as empty.
        ``end`` is put after each text."""
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
        starts = offsets - offsets[0]
        at = self._cuts(data, starts)
        units = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(np.append(at, np.int32(len(data)))), pa.py_buffer(data)]).dictionary_encode()
        names = units.dictionary.to_pylist()
        got = list(map(self.known.get, names))
        gaps = [i for i, ids in enumerate(got) if ids is None]
        again = [i for i in gaps if names[i] in self.old]
        for i in again:
            got[i] = self.old[names[i]]
        new = [i for i in gaps if got[i] is None]
        for first in range(0, len(new), _BLOCK):
            block = new[first : first + _BLOCK]
            made = self._made([names[i] for i in block])
            for i in block:
                got[i] = made[names[i]]
        numbers = units.indices.to_numpy()
        often = np.bincount(numbers, minlength=len(names)) >= _OFTEN
        self.known.update([(names[i], got[i]) for i in gaps if often[i] and len(names[i]) <= _LONG])
        if len(self.known) > self.limit:
            self.old, self.known = self.known, {}
        stops = np.searchsorted(at, starts)  # units before each text
        if end is not None:
            numbers = np.insert(numbers, stops[1:], len(got))
            got.append(int(end).to_bytes(4, "little"))
            stops = stops + np.arange(len(stops))
        taken = pa.array(got, pa.large_binary()).take(pa.array(numbers))
        _, places, ids = taken.buffers()
        bounds = np.frombuffer(places, np.int64)[taken.offset : taken.offset + len(taken) + 1][stops] // 4 if len(taken) else np.zeros(len(starts), np.int64)
        return bounds, ids if ids is not None else pa.py_buffer(b"")

    def ids(self, text: str | None) -> bytes:
        return self.encode(pa.array([text], pa.string()))[1].to_pybytes()


def shared_spec(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer's file (a few MB, fixed) for the executors, which need not have it."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


_encoders: dict[int, TextEncoder] = {}


def encoder(spec: Broadcast) -> TextEncoder:
    """One encoder for each Python worker; it outlives a task, with two generations of frequent units (some 20 MB each)."""
    key = hash(spec.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = TextEncoder(spec.value)
    return _encoders[key]
