"""WARC archives in Zstandard, one frame per record, with a shared dictionary.

An archive (``.warc.zst`` layout) starts with a skippable frame (magic
0x184D2A5D) that holds the dictionary; each record is one frame compressed
with it. An empty skippable frame (magic 0x184D2A50), which any Zstandard reader
passes over, lies behind every frame. A task starts a new archive, with its own
dictionary frame, once one holds ``FILE_BYTES``, so no archive grows with the data.

Pages with equal payloads: the record with the largest page_id is a
``response``, the others are ``revisit`` records that refer to it and carry no
body; payloads under ``least`` bytes are never revisited. Digests are grouped
with map-side combining and only (digest, page) pairs that repeat are joined
back, so a payload shared by a third of the pages is an ordinary skewed join
that adaptive execution splits.

Nulls: a null html is an empty payload; a null page_id is written as such and
is the smallest; a null url becomes "urn:none". Exact repeats of the winning row
are responses too. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.llm import blobs

DICT_MAGIC = 0x184D2A5D
SEPARATOR = "P*M\x18\0\0\0\0"     # an empty skippable frame
DICT_ROWS = 400                   # rows the dictionary is trained on at most
DICT_BYTES = 32 << 10
LEVEL = 3
FILE_BYTES = 16 << 20             # bytes after which an archive is closed


REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Payload-Digest", "WARC-Payload-Length", "Content-Length")

# -- records ------------------------------------------------------------------


def digest32(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record; a revisit has no block. ``date``: when the archive was written (UTC, ISO 8601)."""
    block = b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {date}",
            f"WARC-Target-URI: {'urn:none' if url is None else _header_text(url)}",
            "Content-Type: text/html; charset=utf-8",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _header_text(s: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in s)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, lengths checked."""
    at = raw.find(b"\r\n\r\n")
    if at < 0 or not raw.startswith(b"WARC/1.1\r\n"):
        raise ValueError("not a WARC record")
    lines = [line.split(": ", 1) for line in raw[:at].decode().split("\r\n")[1:]]
    head = {x[0]: x[1] for x in lines if len(x) == 2}
    missing = [h for h in REQUIRED if h not in head]
    if missing or len(head) < len(lines):
        raise ValueError(f"record {head.get('WARC-Record-ID')}: header {', '.join(missing) or 'line'} missing or broken")
    block = raw[at + 4:-4]
    if raw[-4:] != b"\r\n\r\n" or len(block) != int(head["Content-Length"]):
        raise ValueError(f"record {head.get('WARC-Record-ID')}: wrong Content-Length")
    if head["WARC-Type"] == "response":
        if len(block) != int(head["WARC-Payload-Length"]) or f"sha1:{digest32(block)}" != head["WARC-Payload-Digest"]:
            raise ValueError(f"record {head['WARC-Record-ID']}: wrong payload digest or length")
    elif head["WARC-Type"] != "revisit" or block:
        raise ValueError(f"record {head['WARC-Record-ID']}: unknown type or a revisit with a block")
    return head, block


def frames(content: bytes) -> Iterator[bytes]:
    """Decompressed records of an archive; its leading skippable frame gives the dictionary."""
    if not content:
        return
    magic, size = struct.unpack_from("<II", content, 0)
    if magic != DICT_MAGIC:
        raise ValueError("archive without a leading dictionary frame")
    words = content[8:8 + size]
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words)) if words else \
        zstandard.ZstdDecompressor()
    at = 8 + size
    while at < len(content):
        magic, size = struct.unpack_from("<II", content, at)
        if 0x184D2A50 <= magic <= 0x184D2A5F:
            at += 8 + size
            continue
        one = reader.decompressobj()
        # a window of the file that grows until the frame ends: frames don't say how long they are
        out, step = [], 1 << 16
        while not one.eof:
            piece = content[at:at + step]
            if not piece:
                raise ValueError("archive ends inside a frame")
            out.append(one.decompress(piece))
            at += len(piece)
            step *= 2
        at -= len(one.unused_data)
        yield b"".join(out)


# -- Spark jobs ---------------------------------------------------------------


def train_dictionary(pages: DataFrame, rows: int = DICT_ROWS, size: int = DICT_BYTES) -> bytes:
    """A dictionary from a bounded sample (first 16 KB of ``rows`` rows in order of a hash of the id).

    Empty where the sample is too small; archives then have an empty dictionary frame.
    """
    ids = (pages.select("page_id").filter("page_id is not null").distinct()
           .orderBy(F.xxhash64("page_id"), "page_id").limit(rows))
    sample = pages.join(F.broadcast(ids), "page_id").select(
        F.substring(F.encode(F.coalesce("html", F.lit("")), "UTF-8"), 1, 16384).alias("b"))
    texts = sorted(bytes(r.b) for r in sample.collect())
    try:
        return zstandard.train_dictionary(size, [t for t in texts if t]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def decide(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, sha1 (hex), refers_to of every page; refers_to is set where the page is a revisit."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    winners = (rows.filter(F.octet_length("payload") >= least).groupBy("sha1")
               .agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
               .filter("n > 1 and winner is not null").select("sha1", "winner"))
    refers = F.when(F.col("page_id").eqNullSafe(F.col("winner")), F.lit(None)).otherwise(F.col("winner"))
    return rows.join(winners, "sha1", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write(pages: DataFrame, least: int = 0) -> str:
    """Archives of all pages; returns the folder."""
    words = train_dictionary(pages)
    lead = struct.pack("<II", DICT_MAGIC, len(words)) + words
    schema = pa.schema([("archive", pa.binary())])

    date = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def packed(batches):
        shared = {"dict_data": zstandard.ZstdCompressionDict(words)} if words else {}
        z = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **shared)
        held, size = [], 0

        def archive():
            return pa.RecordBatch.from_arrays([pa.array([SEPARATOR.encode().join([lead, *held])], pa.binary())], schema=schema)

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch.column(k) for k in range(4))):
                body = payload.as_py()
                refers = refers_to.as_py()
                held.append(z.compress(record(page_id.as_py(), url.as_py(), body, digest32(body), refers,
                                              refers is not None, date)))
                size += len(held[-1])
                if size >= FILE_BYTES:
                    yield archive()
                    held, size = [], 0
        if held:
            yield archive()

    archives = decide(pages, least).mapInArrow(packed, "archive binary")
    return blobs.write(archives, "archive", SEPARATOR, "warc", per_file=1)


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of the archives."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def number(urn):
        inner = urn[len("<urn:page:"):-1]
        return int(inner) if inner else None

    def parsed(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for raw in frames(content.as_py()):
                    h, _ = parse(raw)
                    rows.append((number(h["WARC-Record-ID"]), int(h["WARC-Payload-Length"]),
                                 h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"],
                                 number(h["WARC-Refers-To"]) if "WARC-Refers-To" in h else None))
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return blobs.read(spark, path).select("content").mapInArrow(
        parsed, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
