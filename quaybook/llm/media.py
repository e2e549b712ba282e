"""Media columns: lossless PNG images in binary columns, and cosine-transform hashes.

The PNG code here writes and reads what these columns hold: 8-bit grey images, one
IDAT stream in zlib chunks. Every chunk's CRC-32 is tested on reading, zlib tests its
own Adler-32, and rows are unfiltered with numpy for all five filter types.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quaybook.llm.common import blocks, texts, tidily

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples in a row; payloads are padded to a multiple of it.
WIDTH = 64
#: Bytes of the zlib stream in one IDAT chunk.
CHUNK = 1 << 16
LEVEL = 4
NONE, SUB, UP, AVERAGE, PAETH = range(5)

#: The 8 lowest rows of the 32-point cosine transform, in 1/4096: integers, so that equal images hash alike everywhere.
_COSINES = np.rint(4096 * np.cos(np.pi * (2 * np.arange(32) + 1) * np.arange(8)[:, None] / 64)).astype(np.int64)


def pad(data: bytes, unit: int = WIDTH) -> bytes:
    """data with zero bytes up to a positive multiple of `unit`."""
    return data + b"\0" * (max(unit, -(-len(data) // unit) * unit) - len(data))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def filter_rows(image: np.ndarray) -> np.ndarray:
    """Rows with a leading filter byte: of None, Sub and Up the one with the least sum of absolute differences."""
    sub, up = image.copy(), image.copy()
    sub[:, 1:] -= image[:, :-1]
    up[1:] -= image[:-1]
    tried = np.stack([image, sub, up])
    best = np.abs(tried.view(np.int8).astype(np.int16)).sum(axis=2).argmin(axis=0)
    rows = np.empty((len(image), image.shape[1] + 1), np.uint8)
    rows[:, 0] = best
    rows[:, 1:] = tried[best, np.arange(len(image))]
    return rows


def encode_png(payload: bytes, width: int = WIDTH, level: int = LEVEL) -> bytes:
    """An 8-bit grey PNG whose samples are the payload, a multiple of `width` bytes."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, width)
    stream = zlib.compress(filter_rows(image).tobytes(), level)
    head = struct.pack(">IIBBBBB", width, len(image), 8, 0, 0, 0, 0)
    data = b"".join(_chunk(b"IDAT", stream[i : i + CHUNK]) for i in range(0, len(stream), CHUNK))
    return SIGNATURE + _chunk(b"IHDR", head) + data + _chunk(b"IEND", b"")


def _unfilter_row(kind: int, row: np.ndarray, above: np.ndarray) -> np.ndarray:
    """One Average or Paeth row: each sample needs the one before it."""
    out, left, corner = np.empty_like(row), 0, 0
    for i, (x, b) in enumerate(zip(row.tolist(), above.tolist(), strict=True)):
        if kind == AVERAGE:
            guess = (left + b) // 2
        else:
            p = left + b - corner
            guess = min((abs(p - left), 0, left), (abs(p - b), 1, b), (abs(p - corner), 2, corner))[2]
        out[i] = left = (x + guess) & 255
        corner = b
    return out


def unfilter(rows: np.ndarray) -> np.ndarray:
    """The image of rows with leading filter bytes; runs of one filter type go at once."""
    kinds, image = rows[:, 0], rows[:, 1:].copy()
    if kinds.max(initial=0) > PAETH:
        raise ValueError("PNG: unknown filter type")
    edges = np.flatnonzero(np.diff(kinds)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(kinds)], strict=True):
        if kinds[a] == SUB:
            image[a:b] = np.cumsum(image[a:b], axis=1, dtype=np.uint8)
        elif kinds[a] == UP:
            start = a - 1 if a else 0
            image[start:b] = np.cumsum(image[start:b], axis=0, dtype=np.uint8)
        elif kinds[a] in (AVERAGE, PAETH):
            for i in range(a, b):
                image[i] = _unfilter_row(int(kinds[a]), image[i], image[i - 1] if i else np.zeros_like(image[i]))
    return image


def decode_png(data: bytes) -> np.ndarray:
    """The samples of an 8-bit grey PNG; ValueError where a chunk, checksum or size is wrong."""
    if data[:8] != SIGNATURE:
        raise ValueError("PNG: bad signature")
    at, shape, parts, ended = 8, None, [], False
    while at < len(data) and not ended:
        if at + 12 > len(data):
            raise ValueError("PNG: cut short")
        n, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + n]
        if len(data) < at + 12 + n or struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise ValueError(f"PNG: checksum of {kind!r}")
        if kind == b"IHDR":
            width, height, *rest = struct.unpack(">IIBBBBB", body)
            if rest != [8, 0, 0, 0, 0]:
                raise ValueError("PNG: only 8-bit grey, not interlaced")
            shape = (height, width)
        elif kind == b"IDAT":
            parts.append(body)
        ended = kind == b"IEND"
        at += 12 + n
    if shape is None or not ended:
        raise ValueError("PNG: cut short")
    try:
        raw = zlib.decompress(b"".join(parts))
    except zlib.error as e:
        raise ValueError(f"PNG: {e}") from e
    if len(raw) != shape[0] * (shape[1] + 1):
        raise ValueError("PNG: size")
    return unfilter(np.frombuffer(raw, np.uint8).reshape(shape[0], shape[1] + 1))


def _shrink(image: np.ndarray, axis: int, n: int = 32) -> np.ndarray:
    """Means of n equal stretches of an axis; a short axis repeats its samples."""
    size = image.shape[axis]
    at = np.arange(n) * size // n
    if size < n:
        return np.take(image, at, axis)
    counts = np.diff(np.append(at, size))
    sums = np.add.reduceat(image, at, axis)
    return sums // (counts[:, None] if axis == 0 else counts)


def cosine_hash(image: np.ndarray) -> bytes:
    """8 bytes: which of the 64 lowest cosine frequencies of the image are above their median."""
    small = _shrink(_shrink(image.astype(np.int64), 0), 1)
    low = (_COSINES @ small @ _COSINES.T).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes()


def with_png(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, media): each row's text as a PNG.

    A null or empty text is one row of 64 zero samples. Every row counts, repeated
    ones and those with null keys too. Other columns are not read.
    """
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, n_bytes long, media binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            raw, starts = texts(batch.column(text))
            data, at = raw.tobytes(), starts.tolist()
            media = [encode_png(pad(data[a:b])) for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(np.diff(starts)), pa.array(media, pa.binary())], [key, "n_bytes", "media"])

    return docs.select(key, text).mapInArrow(tidily(encode), schema)


def read_media(media: DataFrame, key: str = "doc_id") -> DataFrame:
    """What is read back of (key, n_bytes, media): digests of the payload and the media, and features.

    phash is the binary cosine hash, feature the same in hex. A null medium, or one
    that fails a checksum, has a null payload and says so in `error`.
    """
    schema = f"{key} {media.schema[key].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, phash binary, feature string, error string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "media"):
            rows = []
            for stored in batch.column("media"):
                data = stored.as_py()
                if data is None:
                    rows.append((None,) * 7 + ("no media",))
                    continue
                own = len(data), hashlib.sha256(data).hexdigest()
                try:
                    image = decode_png(data)
                except ValueError as e:
                    rows.append((None, None, None, *own, None, None, str(e)))
                    continue
                payload, mark = image.tobytes(), cosine_hash(image)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *own, mark, mark.hex(), None))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("n_bytes"), *columns], [x.split()[0] for x in schema.split(", ")])

    return media.select(key, "n_bytes", "media").mapInArrow(tidily(read), schema)
