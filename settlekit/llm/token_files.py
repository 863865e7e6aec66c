"""Token-ID output: patched frame-of-reference (PFOR) files of whole documents.

File format. A file is a sequence of segments, each followed by the separator
``SEPARATOR``. A segment holds whole documents in ascending doc_id order:

    header   magic "PFOR1\0", part int64, first document's number in the part int64,
             documents uint32, ids uint64, ids per block uint32, blocks uint32, body bytes uint64
    index    doc_id int64 and is-null uint8 per document, ids uint32 per document,
             start of each block in the body uint64 (blocks + 1)
    body     per block: minimum uint32, width uint8, exceptions uint16,
             (id - minimum) mod 2**width packed at ``width`` bits, little-endian,
             exception positions uint16, exception (id - minimum) uint32

The width of a block is that of the ``PERCENTILE``-th smallest difference to
its minimum; larger differences are exceptions. All integers are little-endian.

Documents go to range parts by doc_id (bounds from the ids alone), so only
packed ids are shuffled, once. Nulls: a null text is empty (its document is
the end id alone), a null doc_id sorts first. Rows with one doc_id are ordered
by their ids. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from settlekit.llm import blobs, scan, tokens
from settlekit.session import stage_table

SEPARATOR = "\x1ePFOREND"
BLOCK = 256
PERCENTILE = 90
SEGMENT_IDS = 1 << 20     # ids after which a segment is closed
END_ID = 1

_HEAD = struct.Struct("<6sqqIQIIQ")
_BLOCK = np.dtype([("minimum", "<u4"), ("width", "u1"), ("exceptions", "<u2")])


# -- one segment --------------------------------------------------------------


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """uint32 rows, one block each, packed to ``width`` bits a value."""
    if width == 0:
        return np.zeros((len(rows), 0), np.uint8)
    if width in (8, 16, 32):
        return np.ascontiguousarray(rows.astype(f"<u{width // 8}")).view(np.uint8).reshape(len(rows), -1)
    raw = np.ascontiguousarray(rows.astype("<u4")).view(np.uint8).reshape(*rows.shape, 4)
    bits = np.unpackbits(raw, axis=2, count=width, bitorder="little")
    return np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, width: int, n: int) -> np.ndarray:
    if width == 0:
        return np.zeros((len(packed), n), np.uint32)
    bits = np.unpackbits(packed, axis=1, count=n * width, bitorder="little").reshape(len(packed), n, width)
    raw = np.packbits(bits, axis=2, bitorder="little")
    out = np.zeros((len(packed), n, 4), np.uint8)
    out[:, :, :raw.shape[2]] = raw
    return out.view("<u4")[:, :, 0]


def encode_segment(part: int, first: int, doc_id: list, counts: np.ndarray, ids: np.ndarray,
                   block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    n = len(ids)
    blocks = -(-n // block)
    grid = np.zeros((blocks, block), np.uint32)
    grid.reshape(-1)[:n] = ids
    if n % block:  # the last block is filled with its own first id
        grid.reshape(-1)[n:] = grid[-1, 0]
    low = grid.min(1) if blocks else np.zeros(0, np.uint32)
    diff = grid - low[:, None]
    at = max(0, min(block - 1, -(-percentile * block // 100) - 1))
    picked = np.partition(diff, at, axis=1)[:, at] if blocks else low
    width = np.ceil(np.log2(picked.astype(np.float64) + 1)).astype(np.int64)
    big = diff >> width[:, None].astype(np.uint64) > 0
    bodies: list = [None] * blocks
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        kept = diff[rows] & np.uint32((1 << int(w)) - 1)
        packed = _pack(kept, int(w))
        for r, p in zip(rows, packed):
            where = np.flatnonzero(big[r])
            head = struct.pack("<IBH", int(low[r]), int(w), len(where))
            bodies[r] = head + p.tobytes() + where.astype("<u2").tobytes() + diff[r, where].astype("<u4").tobytes()
    starts = np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype("<u8")
    null = np.array([d is None for d in doc_id], np.uint8)
    index = (np.array([0 if d is None else d for d in doc_id], "<i8").tobytes() + null.tobytes()
             + np.asarray(counts, "<u4").tobytes() + starts.tobytes())
    head = _HEAD.pack(b"PFOR1\0", part, first, len(doc_id), n, block, blocks, int(starts[-1]))
    return head + index + b"".join(bodies)


def decode_file(content: bytes):
    """(part, first, doc_ids, counts, ids) of each segment of a file."""
    mark, at = SEPARATOR.encode(), 0
    while at < len(content):
        magic, part, first, docs, n, block, blocks, size = _HEAD.unpack_from(content, at)
        if magic != b"PFOR1\0":
            raise ValueError("not a PFOR segment")
        at += _HEAD.size
        doc_id = np.frombuffer(content, "<i8", docs, at)
        null = np.frombuffer(content, "u1", docs, at + 8 * docs)
        counts = np.frombuffer(content, "<u4", docs, at + 9 * docs).astype(np.int64)
        starts = np.frombuffer(content, "<u8", blocks + 1, at + 13 * docs).astype(np.int64)
        at += 13 * docs + 8 * (blocks + 1)
        if counts.sum() != n or int(starts[-1]) != size:
            raise ValueError("PFOR segment with a broken index")
        body = np.frombuffer(content, np.uint8, size, at)
        at += size
        if content[at:at + len(mark)] != mark:
            raise ValueError("PFOR segment without its end")
        at += len(mark)
        out = np.zeros((blocks, block), np.uint32)
        if blocks:
            heads = body[starts[:-1, None] + np.arange(7)]
            info = np.ascontiguousarray(heads).view(_BLOCK).reshape(-1)
            for w in np.unique(info["width"]):
                rows = np.flatnonzero(info["width"] == w)
                size_w = block * int(w) // 8
                packed = body[(starts[rows] + 7)[:, None] + np.arange(size_w)]
                out[rows] = _unpack(packed, int(w), block)
            for r in np.flatnonzero(info["exceptions"]):
                e, lo = int(info["exceptions"][r]), int(starts[r]) + 7 + block * int(info["width"][r]) // 8
                where = np.frombuffer(body[lo:lo + 2 * e].tobytes(), "<u2")
                out[r, where] = np.frombuffer(body[lo + 2 * e:lo + 6 * e].tobytes(), "<u4")
            out += info["minimum"][:, None]
        ids = out.reshape(-1)[:n]
        yield part, first, [None if z else int(d) for d, z in zip(doc_id, null)], counts, ids


# -- Spark jobs ---------------------------------------------------------------


def range_bounds(keys: DataFrame, column: str, parts: int) -> list[int]:
    """parts - 1 approximate quantiles of a long column (fewer where they coincide)."""
    if parts < 2:
        return []
    row = keys.agg(F.percentile_approx(column, [k / parts for k in range(1, parts)], 20_000)).first()[0]
    return sorted(set(row or []))


def write(docs: DataFrame, vocabulary: str, end_id: int = END_ID, parts: int | None = None) -> str:
    """Encode every document and write the PFOR files; returns their folder."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bounds = np.array(range_bounds(docs.select("doc_id"), "doc_id", parts), np.int64)
    schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("ids", pa.binary())])

    def encoded(batches):
        enc = tokens.encoder(vocabulary)
        for batch in batches:
            for piece in scan.slices(batch):
                ids, n = enc.encode(scan.payloads(piece.column(1)))
                ends = np.cumsum(n)
                rows = [ids[a:b].tobytes() for a, b in zip(ends - n, ends)]
                doc_id = piece.column(0)
                part = np.searchsorted(bounds, doc_id.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), "right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), doc_id, pa.array(rows, pa.binary())], schema=schema)

    def segments(batches):
        part, first, doc_id, chunks, size = 0, 0, [], [], 0
        out = pa.schema([("segment", pa.binary())])

        def close():
            counts = np.array([len(c) for c in chunks], np.int64)
            blob = encode_segment(part, first, doc_id, counts, np.concatenate(chunks).astype(np.uint32))
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], schema=out)

        for batch in batches:
            for p, d, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if doc_id and (p != part or size >= SEGMENT_IDS):
                    yield close()
                    first = first + len(doc_id) if p == part else 0
                    doc_id, chunks, size = [], [], 0
                part = p
                doc_id.append(d)
                chunks.append(np.append(np.frombuffer(raw, np.uint16).astype(np.uint32), np.uint32(end_id)))
                size += len(chunks[-1])
        if doc_id:
            yield close()

    rows = (docs.mapInArrow(encoded, "part int, doc_id long, ids binary")
            .repartitionById(len(bounds) + 1, F.col("part"))
            .sortWithinPartitions(F.asc_nulls_first("doc_id"), "ids")
            .mapInArrow(segments, "segment binary"))
    return blobs.write(rows, "segment", SEPARATOR, "token-files")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """part, at (number in the part), doc_id, n_tokens, ids_crc32 and start in the part, decoded from the files."""
    schema = pa.schema([("part", pa.int64()), ("at", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def decoded(batches):
        for batch in batches:
            for content in batch.column(0):
                for part, first, doc_id, counts, ids in decode_file(content.as_py()):
                    ends = np.cumsum(counts)
                    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                    crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(crc), part), pa.int64()),
                         pa.array(first + np.arange(len(crc)), pa.int64()), pa.array(doc_id, pa.int64()),
                         pa.array(counts, pa.int64()), pa.array(crc, pa.int64())], schema=schema)

    return (blobs.read(spark, path).select("content")
            .mapInArrow(decoded, "part long, at long, doc_id long, n_tokens long, ids_crc32 long"))


def with_starts(rows: DataFrame) -> DataFrame:
    """Global ``start`` of each document: ids of all parts before plus those before it in its part."""
    rows = stage_table(rows, "token-index")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("start", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(totals, "part")
            .select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"))
