"""Packing along a space-filling curve.

A document's distinct word hashes are projected to ``DIMS`` numbers by random
signs (a hashed bag of words), each number becomes a coordinate of ``BITS``
bits, and the coordinates' place on a Hilbert curve is the sort key. Documents
are range-dealt by that key (a hash of the id breaks ties, so a large group of
copies still spreads over tasks) and each task lays its documents end to end in
curve order and cuts the stream into sequences of ``length`` tokens, so a
sequence holds neighbours on the curve.

Padding: full sequences have none. What is left at the end of a task's stream is
cut into sequences whose lengths are powers of two, which need none either.

Only packed ids are shuffled, once. A first pass over the texts finds the
range bounds from the keys alone.

Defined results: a null or empty text is the end id alone; a null doc_id is
packed like any other (its pieces carry null); rows that repeat a doc_id are
documents of their own; an empty table gives no pieces. Extra columns are
ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm import scan, tokens
from settlekit.llm.token_files import range_bounds
from settlekit.session import stage_table

LENGTH = 2048
END_ID = 1
DIMS = 4
BITS = 10
TIE_BITS = 63 - DIMS * BITS


def project(texts: list[bytes], dims: int = DIMS) -> np.ndarray:
    """One row per text: sums of random signs of its distinct words over the root of their number."""
    j = scan.join(texts, lower=True)
    start, end, doc = scan.bare_words(j)
    h = scan.span_hash(scan.prefix_hash(j.buf), start, end)
    h, doc, _ = scan.distinct(h, doc)
    n = np.bincount(doc, minlength=j.docs)
    out = np.zeros((j.docs, dims))
    for k in range(dims):
        sign = ((h >> np.uint64(7 * k + 3)) & np.uint64(1)).astype(np.float64) * 2 - 1
        out[:, k] = np.bincount(doc, sign, minlength=j.docs)
    return out / np.sqrt(np.maximum(n, 1))[:, None]


def coordinates(x: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Numbers of unit variance to 0 .. 2**bits - 1 (logistic approximation of the normal distribution)."""
    u = 1 / (1 + np.exp(-1.702 * x))
    return np.minimum((u * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates (Skilling's transform)."""
    x = points.T.astype(np.int64).copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for k in range(dims):
            high = (x[k] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[k]) & p)
            x[0] ^= np.where(high, p, swap)
            x[k] ^= swap
        q >>= 1
    for k in range(1, dims):
        x[k] ^= x[k - 1]
    turn = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= turn
    out = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for k in range(dims):
            out = (out << 1) | ((x[k] >> b) & 1)
    return out


def keys_of(texts: list[bytes], ties: np.ndarray) -> np.ndarray:
    """Curve place in the high bits, tie hash in the low ones."""
    place = hilbert_index(coordinates(project(texts)))
    return (place << TIE_BITS) | (ties & ((1 << TIE_BITS) - 1))


def _powers_of_two(n: int) -> list[int]:
    """Ends of the sequences that n tokens are cut into: descending powers of two."""
    ends, at = [], 0
    for b in range(n.bit_length() - 1, -1, -1):
        if n >> b & 1:
            at += 1 << b
            ends.append(at)
    return ends


class Packer:
    """Cuts a stream of documents into pieces; ``add`` and ``finish`` return finished ones.

    A piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).
    """

    def __init__(self, first_sequence: int, length: int = LENGTH):
        self.sequence = first_sequence
        self.length = length
        self.open: list[tuple] = []   # (doc_id, start, ids, doc_tokens) of the unfinished sequence
        self.filled = 0

    def _piece(self, doc_id, start, ids, total, offset):
        crc = zlib.crc32(ids.astype("<u4").tobytes())
        return doc_id, start, len(ids), crc, total, self.sequence, offset

    def add(self, doc_id, ids: np.ndarray) -> list[tuple]:
        out, at = [], 0
        while at < len(ids):
            take = min(self.length - self.filled, len(ids) - at)
            self.open.append((doc_id, at, ids[at:at + take], len(ids)))
            self.filled += take
            at += take
            if self.filled == self.length:
                out += self._close()
        return out

    def _close(self) -> list[tuple]:
        out, offset = [], 0
        for doc_id, start, ids, total in self.open:
            out.append(self._piece(doc_id, start, ids, total, offset))
            offset += len(ids)
        self.open, self.filled = [], 0
        self.sequence += 1
        return out

    def finish(self) -> list[tuple]:
        """The rest, in sequences of power-of-two lengths."""
        rest, out, at = self.open, [], 0
        self.open = []
        for end in _powers_of_two(self.filled):
            while at < end:
                doc_id, start, ids, total = rest[0]
                take = min(end - at, len(ids))
                self.open.append((doc_id, start, ids[:take], total))
                rest = rest[1:] if take == len(ids) else [(doc_id, start + take, ids[take:], total), *rest[1:]]
                at += take
            out += self._close()
        self.filled = 0
        return out


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False,
         parts: int | None = None) -> DataFrame:
    """The pieces of all documents (``with_ids`` adds their token ids)."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id").alias("tie"), "text")

    def encoded(batches):
        enc = tokens.encoder(vocabulary)
        schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for part in scan.slices(batch):
                texts = scan.payloads(part.column(2))
                key = keys_of(texts, part.column(1).to_numpy())
                ids, n = enc.encode(texts)
                ends = np.cumsum(n)
                rows = [ids[a:b].tobytes() for a, b in zip(ends - n, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), part.column(0), pa.array(rows, pa.binary())], schema=schema)

    # projected and encoded once: the bounds come from the key column of the staged rows
    staged = stage_table(docs.mapInArrow(encoded, "key long, doc_id long, ids binary"), "packing")
    bounds = range_bounds(staged, "key", parts)
    part = F.lit(0)
    if bounds:
        part = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("key")))

    def packed(batches):
        packer, part = None, None
        schema = PIECES.append(pa.field("ids", pa.binary())) if with_ids else PIECES

        def table(pieces):
            cols = list(zip(*pieces)) or [[]] * len(PIECES)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            out = []
            for p, doc_id, raw in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if p != part:
                    out += packer.finish() if packer else []
                    packer, part = make(p), p
                out += packer.add(doc_id, np.append(np.frombuffer(raw, np.uint16), np.uint16(end_id)))
            yield table(out)
        if packer:
            yield table(packer.finish())

    def make(part: int) -> Packer:
        return (IdPacker if with_ids else Packer)(part << 36, length)

    rows = (staged.select(part.alias("part"), "key", "doc_id", "ids")
            .repartitionById(len(bounds) + 1, F.col("part"))
            .sortWithinPartitions("part", "key", "doc_id", "ids"))
    return rows.mapInArrow(packed, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                   "sequence_id long, offset long" + ", ids binary" * with_ids)


class IdPacker(Packer):
    """Pieces that carry their ids (little-endian uint32)."""

    def _piece(self, doc_id, start, ids, total, offset):
        return (*super()._piece(doc_id, start, ids, total, offset), ids.astype("<u4").tobytes())
