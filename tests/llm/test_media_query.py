"""op2's whole result, digest by digest, against a plain PNG reader and cosine sums written out."""

import hashlib
import math
import struct
import zlib
from statistics import median

import numpy as np

from quaybook.llm import media, queries

SF = "/root/testdata/sf0.001"


def plain_read(data):
    """Samples of an 8-bit grey PNG, chunk by chunk and sample by sample."""
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    at, stream, width = 8, b"", 0
    while at < len(data):
        (n,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + n]
        assert struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + body)
        if kind == b"IHDR":
            width, height, depth, colour, *rest = struct.unpack(">IIBBBBB", body)
            assert (depth, colour, rest) == (8, 0, [0, 0, 0])
        elif kind == b"IDAT":
            stream += body
        at += 12 + n
    assert kind == b"IEND"
    raw, above, out = zlib.decompress(stream), [0] * width, []
    assert len(raw) == height * (width + 1)
    for y in range(height):
        kind, *line = raw[y * (width + 1) : (y + 1) * (width + 1)]
        row = []
        for i, x in enumerate(line):
            a, b, c = row[i - 1] if i else 0, above[i], above[i - 1] if i else 0
            p = a + b - c
            guess = (0, a, b, (a + b) // 2, a if abs(p - a) <= min(abs(p - b), abs(p - c)) else b if abs(p - b) <= abs(p - c) else c)[kind]
            row.append((x + guess) & 255)
        above = row
        out.append(row)
    return out


def plain_hash(rows):
    """The 64 lowest cosine coefficients of a 32 by 32 picture of means, against their median."""
    def cuts(n):
        at = [i * n // 32 for i in range(32)]
        return [(a, a + 1) for a in at] if n < 32 else list(zip(at, [*at[1:], n], strict=True))

    tall = [[sum(rows[y][x] for y in range(a, b)) // (b - a) for x in range(len(rows[0]))] for a, b in cuts(len(rows))]
    small = [[sum(row[a:b]) // (b - a) for a, b in cuts(len(row))] for row in tall]
    waves = [[math.cos(math.pi * k * (2 * i + 1) / 64) for i in range(32)] for k in range(8)]
    half = [[sum(w * row[x] for w, row in zip(wave, small, strict=True)) for x in range(32)] for wave in waves]
    low = [sum(w * v for w, v in zip(wave, row, strict=True)) for row in half for wave in waves]
    middle = median(low[1:])
    return low, [x > middle for x in low], middle


def test_query(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    stored = {r.doc_id: r.media for r in media.with_png(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    got = queries.op2_png_media(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    checked = 0
    for r in got:
        body, data = texts[r.doc_id], bytes(stored[r.doc_id])
        payload = body + bytes(-len(body) % 64 or 64 * (not body))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(body), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-64:])
        assert (r.media_bytes, r.media_sha256) == (len(data), hashlib.sha256(data).hexdigest())
        if len(payload) < 20_000 and checked < 60:  # sample by sample takes long
            checked += 1
            rows = plain_read(data)
            assert bytes(x for row in rows for x in row) == payload
            low, bits, middle = plain_hash(rows)
            own = np.unpackbits(np.frombuffer(bytes.fromhex(r.feature), np.uint8)).astype(bool)
            scale = max(1.0, max(map(abs, low)))
            for mine, theirs, value in zip(bits, own, low, strict=True):  # sums in another order differ in the last place
                assert mine == theirs or abs(value - middle) < 1e-9 * scale
    assert checked == 60
