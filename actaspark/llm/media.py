"""Media columns: PNG pictures as binary values, decoded chunk by chunk, and cosine-transform hashes of them.

Reading a PNG: the signature, chunks with their checksums, the zlib stream of all IDAT chunks, then the five
row filters undone with numpy. Its hash: the picture averaged to 32 x 32 grey samples, the lowest 8 x 8
frequencies of their cosine transform, and one bit for each that lies above their median.

Writing one: the filter that leaves the least sum of absolute differences over the picture, of none, left and up.

Defined results: null text is the empty payload (one row of blanks); equal payloads give equal pictures and
hashes; a very long text is one tall picture; null pictures give nulls, and so do damaged ones and those of a kind
that isn't read (palette, other depths than 8 bits, interlace), with the reason in ``problem``; repeated rows give a
row each; a frequency that equals the median gives a 0; columns of the names of FEATURES are replaced, others stay; an empty table gives no rows."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

# Fixed values of the PNG format.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def _filtered(rows: np.ndarray, step: int, row_filter: int) -> np.ndarray:
    if row_filter == 1:
        shifted = np.zeros_like(rows)
        shifted[:, step:] = rows[:, :-step]
        return rows - shifted
    if row_filter == 2:
        return np.diff(rows, axis=0, prepend=np.zeros((1, rows.shape[1]), np.uint8))
    return rows


def _weight(rows: np.ndarray) -> int:
    """Sum of the absolute values of bytes read as signed ones."""
    return int(np.minimum(rows, -rows).sum(dtype=np.int64))


def encode_png(pixels: np.ndarray, level: int = 6, row_filter: int | None = None) -> bytes:
    """8-bit samples (height, width) or (height, width, channels) as a PNG; ``row_filter`` 0 (none), 1 (left), 2 (up)
    or None for the one with the smallest differences."""
    height, width = pixels.shape[:2]
    channels = 1 if pixels.ndim == 2 else pixels.shape[2]
    colour = {n: c for c, n in CHANNELS.items()}[channels]
    rows = np.ascontiguousarray(pixels, np.uint8).reshape(height, width * channels)
    if row_filter is None:
        row_filter, rows = min(((k, _filtered(rows, channels, k)) for k in (0, 1, 2)), key=lambda f: (_weight(f[1]), f[0]))
    else:
        rows = _filtered(rows, channels, row_filter)
    lines = np.empty((height, rows.shape[1] + 1), np.uint8)
    lines[:, 0], lines[:, 1:] = row_filter, rows
    head = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(kind, content) of every chunk; a wrong checksum raises ValueError."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at = 8
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("cut off within a chunk")
        (size,), kind = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        body, end = data[at + 8 : at + 8 + size], at + 8 + size
        if end + 4 > len(data) or zlib.crc32(kind + body) != struct.unpack_from(">I", data, end)[0]:
            raise ValueError(f"checksum of {kind!r}")
        yield kind, body
        at = end + 4


def _average_row(row: np.ndarray, up: np.ndarray, step: int) -> np.ndarray:
    out, half = row.astype(np.int64).reshape(-1, step), up.astype(np.int64).reshape(-1, step)
    left = np.zeros(step, np.int64)
    for i in range(len(out)):
        left = out[i] = (out[i] + (left + half[i]) // 2) & 255
    return out.reshape(-1).astype(np.uint8)


def _paeth_row(row: np.ndarray, up: np.ndarray, step: int) -> np.ndarray:
    out, above = row.astype(np.int64).reshape(-1, step), up.astype(np.int64).reshape(-1, step)
    left = corner = np.zeros(step, np.int64)
    for i in range(len(out)):
        b = above[i]
        guess = left + b - corner
        da, db, dc = abs(guess - left), abs(guess - b), abs(guess - corner)
        left = out[i] = (out[i] + np.where((da <= db) & (da <= dc), left, np.where(db <= dc, b, corner))) & 255
        corner = b
    return out.reshape(-1).astype(np.uint8)


def unfilter(lines: np.ndarray, step: int) -> np.ndarray:
    """Undo the row filters of (height, 1 + bytes); runs of one filter are undone together where it allows."""
    kinds, rows = lines[:, 0], lines[:, 1:].copy()
    if len(kinds) and kinds.max() > 4:
        raise ValueError("unknown row filter")
    zero = np.zeros(rows.shape[1], np.uint8)
    cuts = np.flatnonzero(np.diff(kinds, prepend=255)).tolist() + [len(kinds)]
    for first, stop in zip(cuts[:-1], cuts[1:]):
        kind, part = kinds[first], rows[first:stop]
        above = rows[first - 1] if first else zero
        if kind == 1:
            part[:] = np.cumsum(part.reshape(len(part), -1, step), axis=1, dtype=np.uint8).reshape(part.shape)
        elif kind == 2:
            part[0] += above
            np.cumsum(part, axis=0, dtype=np.uint8, out=part)
        elif kind:
            undo = _average_row if kind == 3 else _paeth_row
            for k in range(len(part)):
                part[k] = undo(part[k], part[k - 1] if k else above, step)
    return rows


def decode_png(data: bytes) -> np.ndarray:
    """Samples (height, width, channels) of an 8-bit PNG without interlace."""
    parts, head = [], None
    for kind, body in chunks(data):
        if kind == b"IHDR" and len(body) == 13:
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            parts.append(body)
        elif kind == b"IEND":
            break
    else:
        raise ValueError("no end chunk")
    if head is None or head[2] != 8 or head[3] not in CHANNELS or any(head[4:]):
        raise ValueError("only 8-bit pictures without palette and interlace are read")
    width, height, step = head[0], head[1], CHANNELS[head[3]]
    packed, size = b"".join(parts), height * (1 + width * step)
    if not width or not height or size > 1100 * len(packed):  # deflate never shrinks to less than a 1032nd
        raise ValueError("wrong number of samples")
    try:
        raw = zlib.decompressobj().decompress(packed, size + 1)
    except zlib.error as error:
        raise ValueError("damaged samples") from error
    if len(raw) != size:
        raise ValueError("wrong number of samples")
    return unfilter(np.frombuffer(raw, np.uint8).reshape(height, -1), step).reshape(height, width, step)


def _cosines(n: int, low: int) -> np.ndarray:
    k, x = np.arange(low)[:, None], np.arange(n)[None, :]
    return np.cos(np.pi * k * (2 * x + 1) / (2 * n)) * np.where(k == 0, np.sqrt(1 / n), np.sqrt(2 / n))


_SIDE, _LOW = 32, 8
_C = _cosines(_SIDE, _LOW)


def _cuts(n: int) -> tuple[np.ndarray, np.ndarray]:
    first = np.arange(_SIDE) * n // _SIDE
    return first, np.maximum(1, np.diff(first, append=n)).astype(float)


def cosine_hash(pixels: np.ndarray) -> bytes:
    """64 bits: which of the low frequencies lie above their median (the mean sample has no part in it)."""
    grey = pixels if pixels.ndim == 2 else pixels[:, :, 0] if pixels.shape[2] < 3 else pixels[:, :, :3].mean(axis=2)
    (r, nr), (c, nc) = _cuts(grey.shape[0]), _cuts(grey.shape[1])
    small = np.add.reduceat(np.add.reduceat(grey, r, axis=0, dtype=np.float64), c, axis=1) / nr[:, None] / nc[None, :]
    low = np.round(_C @ small @ _C.T, 6).reshape(-1)
    return np.packbits(low > np.median(low[1:])).tobytes()


def payload_of(text: str | None, width: int) -> tuple[int, bytes]:
    """Bytes of the text, and these with blanks up to a positive multiple of ``width``."""
    data = (text or "").encode()
    return len(data), data.ljust(max(1, -(-len(data) // width)) * width)


def _encoder(width: int, level: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, media = [], []
            for text in batch.column("text").to_pylist():
                n, payload = payload_of(text, width)
                sizes.append(n)
                media.append(encode_png(np.frombuffer(payload, np.uint8).reshape(-1, width), level))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return encode


def text_pictures(docs: DataFrame, width: int = 192, level: int = 6) -> DataFrame:
    """Every text as a grey picture of ``width`` samples a row: doc_id, n_bytes, media (PNG bytes)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encoder(width, level), "doc_id long, n_bytes long, media binary")


def _row(media: bytes | None) -> tuple:
    """Values of FEATURES."""
    if media is None:
        return (None,) * len(FEATURES)
    stored_form = (len(media), hashlib.sha256(media).hexdigest())
    try:
        pixels = decode_png(media)
    except ValueError as problem:
        return (None,) * 5 + (*stored_form, None, str(problem))
    data = pixels.tobytes()
    return (pixels.shape[1], pixels.shape[0], len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), *stored_form, cosine_hash(pixels), None)


def _features(column: str, keep: list[str]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column, 4 << 20):
            out: dict[str, list] = {k: [] for k in FEATURES}
            for media in batch.column(column).to_pylist():
                for k, v in zip(FEATURES, _row(media)):
                    out[k].append(v)
            arrays = [batch.column(c) for c in keep] + [pa.array(out[k], t) for k, t in zip(FEATURES, FEATURE_TYPES)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *FEATURES])

    return read


FEATURES = ("width", "height", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "cosine_hash", "problem")
FEATURE_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string())


def picture_features(pictures: DataFrame, column: str = "media") -> DataFrame:
    """``pictures`` without ``column``, with what its decoded samples give (FEATURES)."""
    keep = [c for c in pictures.columns if c != column and c not in FEATURES]
    kinds = dict(pictures.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "width long, height long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, cosine_hash binary, problem string"])
    return pictures.select(*keep, column).mapInArrow(_features(column, keep), schema)


def text_picture_features(docs: DataFrame, width: int = 192, level: int = 6) -> DataFrame:
    """Store the pictures as a table in the shared folder, read its bytes back, and compute the features."""
    return picture_features(stored(text_pictures(docs, width, level), "pictures"))
