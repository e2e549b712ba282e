"""WARC archives in seekable Zstandard bundles.

A bundle is a complete .warc.zst file: records stand in independent frames, several to
a frame, and a skippable frame with the sizes of all frames closes it (the public
seekable format). An index maps each record id to its bundle, its frame, where that
frame begins, and where the record lies in the frame, so that one record is read by
decompressing one frame. Bundles are binary values in a table: Spark's writer commits
them, so a lost executor leaves no half archive, and any store that Spark reads will do.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaybook.llm.common import blocks, tidily

#: Bytes of records in a frame, and in a bundle, before the next one begins.
FRAME_BYTES = 256_000
BUNDLE_BYTES = 8_000_000
LEVEL = 3
#: A fixed date keeps archives the same on every run.
DATE = "2024-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b812-9dad-11d1-80b4-00c04fd430c8")

# Fixed values of the seekable format: magic numbers of the skippable frame and of its footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_TABLE_ENTRY = struct.Struct("<II")
_FOOTER = struct.Struct("<IBI")

INDEX = "bundle string, page_id {key}, record_id string, frame int, frame_at long, frame_bytes long, at long, length long"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}')}>"


def write_record(page_id: object, url: str | None, payload: bytes, payload_digest: str, refers_to: object = None) -> bytes:
    """A response, or a revisit of the record of page `refers_to`, which has the same payload.

    Both have the HTTP head with the payload's length; a revisit leaves the payload out.
    """
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block += payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', lambda m: f'%{ord(m.group()):02X}', url or 'about:blank')}", f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Refers-To-Page-ID: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """(WARC fields, HTTP fields, payload) of each record; ValueError where data is no sequence of records."""
    at = 0
    while at < len(data):
        gap = data.find(b"\r\n\r\n", at)
        if gap < 0 or not data.startswith(b"WARC/1.", at):
            raise ValueError("WARC: no record here")
        fields = _fields(data[at:gap])
        end = gap + 4 + int(fields["Content-Length"])
        block = data[gap + 4 : end]
        if len(block) != int(fields["Content-Length"]) or data[end : end + 4] != b"\r\n\r\n":
            raise ValueError("WARC: record cut short")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield fields, _fields(http), payload
        at = end + 4


class Bundle:
    """Frames of records, as they are written."""

    def __init__(self) -> None:
        self.name = ""
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.filled = self.total = self.written = 0
        self.rows: list[tuple] = []

    def add(self, page_id: object, record: bytes, frame_bytes: int = FRAME_BYTES) -> None:
        if self.filled and self.filled + len(record) > frame_bytes:
            self.close_frame()
        self.rows.append((page_id, record_id(page_id), len(self.frames), self.written, self.filled, len(record)))
        self.open.append(record)
        self.filled += len(record)
        self.total += len(record)

    def close_frame(self) -> None:
        if self.open:
            data = zstandard.ZstdCompressor(LEVEL, write_checksum=True).compress(b"".join(self.open))
            self.frames.append(data)
            self.sizes.append((len(data), self.filled))
            self.written += len(data)
            self.open, self.filled = [], 0

    def close(self) -> bytes:
        """The whole file: frames, then the seek table in a skippable frame."""
        self.close_frame()
        table = b"".join(_TABLE_ENTRY.pack(*s) for s in self.sizes) + _FOOTER.pack(len(self.sizes), 0, SEEKABLE)
        data = b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table)) + table
        self.name = f"{hashlib.sha1(data).hexdigest()}.warc.zst"
        return data


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed bytes, bytes) of each frame, from the footer."""
    n, flags, magic = _FOOTER.unpack_from(bundle, len(bundle) - _FOOTER.size)
    start = len(bundle) - _FOOTER.size - n * _TABLE_ENTRY.size
    if magic != SEEKABLE or flags & 0x80 or start < 8 or struct.unpack_from("<II", bundle, start - 8) != (SKIPPABLE, n * _TABLE_ENTRY.size + _FOOTER.size):
        raise ValueError("no seek table")
    out, at = [], 0
    for i in range(n):
        size, plain = _TABLE_ENTRY.unpack_from(bundle, start + i * _TABLE_ENTRY.size)
        out.append((at, size, plain))
        at += size
    if at != start - 8:
        raise ValueError("seek table doesn't fit the frames")
    return out


def read_frame(bundle: bytes, frame: int) -> bytes:
    at, size, plain = seek_table(bundle)[frame]
    data = zstandard.ZstdDecompressor().decompress(bundle[at : at + size])
    if len(data) != plain:
        raise ValueError("frame size")
    return data


def payload_digest(html: Column) -> Column:
    """20 bytes; null counts as empty."""
    return F.unhex(F.sha1(F.coalesce(html, F.lit("")).cast("binary")))


def with_responses(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to): the smallest page_id with the same payload, null for that page itself.

    Payloads under `min_bytes` refer to nothing. Of rows without a page_id the payload's
    smallest id is the response, too; where no row of a payload has one, all are
    responses. Rows that repeat the response's page_id are responses as well. Only digests
    are grouped, and counted before the shuffle; payloads that occur once join nothing.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), payload_digest(F.col("html")).alias("_digest"))
    groups = keyed.where(F.octet_length("html") >= min_bytes).groupBy(F.col("_digest").alias("_of")).agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
    groups = groups.where("_n > 1").select("_of", "_first")
    joined = keyed.join(groups, F.col("_digest") == F.col("_of"), "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("_first") != F.col("page_id")), F.col("_first"))
    return joined.select("page_id", "url", "html", refers.alias("refers_to"))


def write_bundles(pages: DataFrame, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """(bundle, data, entries) from (page_id, url, html, refers_to): the files and their indexes.

    Each task fills bundles with its rows in turn and holds one of them at a time.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    entry = f"array<struct<page_id:{kind},record_id:string,frame:int,frame_at:bigint,at:bigint,length:bigint>>"
    names = ["page_id", "record_id", "frame", "frame_at", "at", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = Bundle()

        def done() -> pa.RecordBatch:
            data = bundle.close()
            entries = [dict(zip(names, row, strict=True)) for row in bundle.rows]
            struct_type = pa.struct([("page_id", id_type), ("record_id", pa.string()), ("frame", pa.int32()), ("frame_at", pa.int64()), ("at", pa.int64()), ("length", pa.int64())])
            return pa.RecordBatch.from_arrays([pa.array([bundle.name]), pa.array([data], pa.binary()), pa.array([entries], pa.list_(struct_type))], ["bundle", "data", "entries"])

        for batch in blocks(batches, "html"):
            id_type = batch.column("page_id").type
            for page_id, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                payload = (html or "").encode()
                bundle.add(page_id, write_record(page_id, url, payload, digest(payload), refers_to), frame_bytes)
                if bundle.total >= bundle_bytes:
                    yield done()
                    bundle = Bundle()
        if bundle.rows:
            yield done()

    return pages.select("page_id", "url", "html", "refers_to").mapInArrow(tidily(run), f"bundle string, data binary, entries {entry}")


def index(bundles: DataFrame) -> DataFrame:
    """A row for each record: bundle, page_id, record_id, frame, frame_at (where it begins), at and length in the frame."""
    return bundles.select("bundle", F.explode("entries").alias("e")).select("bundle", "e.*")


def read_bundles(bundles: DataFrame, key_type: str = "bigint") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, record_id), from the archives' own bytes.

    Each record is sought by its index entry: its frame through the footer's seek table,
    then its place in that frame. A response whose payload doesn't have the digest that
    its head tells, or an index entry that leads elsewhere, ends the job.
    """
    schema = f"page_id {key_type}, payload_bytes long, payload_digest string, record_type string, refers_to {key_type}, url string, record_id string"

    def number(text: str) -> int | str | None:
        return None if text == "" else int(text) if key_type in ("bigint", "int") else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "data"):
            for data, entries in zip(batch.column("data"), batch.column("entries"), strict=True):
                bundle, rows, frame, plain = data.as_py(), [], -1, b""
                for e in entries.as_py():
                    if e["frame"] != frame:
                        frame, plain = e["frame"], read_frame(bundle, e["frame"])
                    (fields, http, payload), *more = read_records(plain[e["at"] : e["at"] + e["length"]])
                    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    full = fields["WARC-Type"] == "response"
                    if more or fields["WARC-Record-ID"] != e["record_id"] or (full and (digest(payload) != told or len(payload) != int(http["Content-Length"]))):
                        raise ValueError(f"WARC: record {e['record_id']} of a bundle is damaged")
                    rows.append((number(fields["WARC-Page-ID"]), int(http["Content-Length"]), told, fields["WARC-Type"], number(fields.get("WARC-Refers-To-Page-ID", "")), fields["WARC-Target-URI"], fields["WARC-Record-ID"]))
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=arrow)

    names = [x.split()[0] for x in schema.split(", ")]
    own = pa.int64() if key_type == "bigint" else pa.int32() if key_type == "int" else pa.string()
    arrow = pa.schema([("page_id", own), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", own), ("url", pa.string()), ("record_id", pa.string())])
    return bundles.select("data", "entries").mapInArrow(tidily(run), schema)


def export(bundles: DataFrame, folder: str) -> None:
    """Write the bundles as .warc.zst files to a folder that all machines mount; names come from the content, so a repeated task does no harm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("bundle").to_pylist(), batch.column("data"), strict=True):
                part = Path(folder, f".{name}.{uuid.uuid4().hex}")
                part.write_bytes(data.as_py())
                part.replace(Path(folder, name))
            yield batch.select(["bundle"])

    bundles.select("bundle", "data").mapInArrow(tidily(run), "bundle string").write.format("noop").mode("overwrite").save()
