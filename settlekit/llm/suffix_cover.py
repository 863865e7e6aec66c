"""Suffix-array dedup of byte strings with a sampled cover, one suffix bucket at a time.

Every byte covered by a ``length``-byte string that also starts in a document
with a smaller doc_id is removed; strings are judged on the input. A full
suffix array would shuffle a record per byte. Instead the suffixes are reached
through a cover sample with the property that difference covers are used for:
any two equal ``length``-byte strings hold a sample position at the same offset.
The sample is chosen by content (the position with the smallest rank among the
``GRAM``-byte strings inside the window), so it also aligns copies whatever
their position; a cover by position (i mod v) can't, and would keep every suffix
in the shuffle.

0. A text that a smaller document has as a whole loses all its bytes (where it
   has ``length`` of them); such copies, however many, take no further part.
1. The other documents are dealt to blocks of some ``BLOCK_BYTES``; each block sends the ranks
   (hashes) of its distinct sample grams to their bucket, with the number of different
   stretches around each, and the bucket answers unique, shared or hot (many stretches in all).
2. For shared samples only, the block sends the bytes of the suffixes that the
   sample stands for (at most 2 * length - GRAM bytes). Windows of hot samples are sent
   one by one, dealt by their own content, so no gram gathers in one bucket. Within a
   block equal stretches (and equal hot windows) are sent once, for their smallest
   document: a bucket gets a row for each block at most, however often a text repeats itself.
3. A bucket sorts its suffixes one offset to the sample at a time, so that ties
   meet, compares the bytes of equal ranks, and marks every window that a
   smaller document also has. Memory is that of one bucket.
4. The block removes the marked windows from its documents; a repeat inside one document
   (or inside rows of one doc_id) shares the fate of the row that was sent for it.

The documents are shuffled once (the three readers share the exchange); the
whole is one lazy plan, recomputed from lineage where executors are lost.

Defined results: a null or empty text has no bytes and nothing removed. A null
doc_id is larger than every other id. Rows that share a doc_id don't remove
each other's bytes and are answered one each. An empty table gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm import scan
from settlekit.llm.tokens import ragged
from settlekit.operators.joins import join_small_side
from settlekit.session import stage_table

LENGTH = 50
GRAM = 24
HOT_ROWS = 1 << 15        # a gram with more different stretches than this (summed over blocks) is hot: 3 MB of a bucket
SMALL_ROWS = 1_000_000    # ids of whole copies that may be broadcast: 8 MB
SLICE_BYTES = 1 << 19     # text scanned at once: a task's arrays take some 80 times as much
BLOCK_BYTES = 8 << 20     # text of a block at most, on average: a task holds one block, or one bucket
BLOCKS = 2                # blocks (and buckets) for each shuffle partition at least
LAST_ID = (1 << 63) - 1   # stands for a null doc_id

UNIQUE, SHARED, HOT = 0, 1, 2


def window_samples(buf: np.ndarray, starts: np.ndarray, length: int, gram: int,
                   c: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sample position of each window start, and the hash of the gram at every position; ``c``: the prefix hash."""
    reach = length - gram + 1            # gram positions inside a window
    n = len(buf) - gram + 1
    c = scan.prefix_hash(buf) if c is None else c
    at = np.arange(n)
    h = scan.span_hash(c, at, at + gram)
    # rank in the high bits, position in the low ones: the leftmost smallest wins
    low = np.uint64((1 << 26) - 1)
    v = (h & ~low) | at.astype(np.uint64)
    size = 1
    while size * 2 <= reach:
        v = np.minimum(v[:len(v) - size], v[size:])
        size *= 2
    if size < reach:
        v = np.minimum(v[:len(v) - (reach - size)], v[reach - size:])
    return (v[starts] & low).astype(np.int64), h


class Block:
    """A block's documents in order of (doc_id, text), scanned slice by slice."""

    def __init__(self, doc_ids: np.ndarray, texts: list[bytes], length: int, gram: int):
        order = sorted(range(len(texts)), key=lambda k: (doc_ids[k], texts[k]))
        self.order = order
        self.doc_ids = doc_ids[order]
        self.texts = [texts[k] for k in order]
        self.length, self.gram = length, gram
        self.whole = np.frombuffer(b"".join(self.texts), np.uint8)
        sizes = np.fromiter(map(len, self.texts), np.int64, len(texts))
        self.first = np.cumsum(sizes) - sizes    # first byte of each document in ``whole``

    def slices(self):
        """(first document, Joined) of runs of documents of about ``SLICE_BYTES``."""
        k = 0
        while k < len(self.texts):
            m, size = k, 0
            while m < len(self.texts) and (m == k or size + len(self.texts[m]) <= SLICE_BYTES):
                size += len(self.texts[m])
                m += 1
            yield k, scan.join(self.texts[k:m])
            k = m

    def samples(self):
        """Per slice: document, its sample positions, first and last window of each (in the document), gram and stretch hash."""
        for k, j in self.slices():
            n = np.maximum(j.last - j.first - self.length + 1, 0)
            starts = ragged(j.first, n)
            if not len(starts):
                continue
            c = scan.prefix_hash(j.buf)
            at, h = window_samples(j.buf, starts, self.length, self.gram, c)
            new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            last = np.concatenate([new[1:], [len(at)]]) - 1
            at, lo, hi = at[new], starts[new], starts[last]
            doc = np.searchsorted(j.last, at, "left")
            content = _placed(scan.span_hash(c, lo, hi + self.length), at - lo)
            first = j.first[doc]
            # mixed again: a sample has the smallest rank of its window, so ranks as they are would crowd the first buckets
            yield k + doc, at - first, lo - first, hi - first, scan.mix(h[at]), content

    def spans(self, rows: dict[str, np.ndarray], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of some rows' stretches, end to end, and their sizes."""
        size = rows["back"][at] - rows["front"][at] + self.length
        return self.whole[ragged(self.first[rows["doc"][at]] + rows["pos"][at] - rows["back"][at], size)], size


def _placed(h: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Hash of a stretch together with where its sample lies in it."""
    with np.errstate(over="ignore"):
        return scan.mix(h + back.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _five(h: np.ndarray) -> np.ndarray:
    """The low 40 bits of each hash as 5 bytes: with the bucket, enough to tell grams apart at any size."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])


def _distinct_grams(block: Block):
    """Sorted distinct gram hashes of a block, whether two of its documents hold each, and the different stretches of each."""
    grams, docs, all_grams, contents = [], [], [], []
    for doc, _, _, _, h, content in block.samples():
        u, d, _ = scan.distinct(h, doc)
        grams.append(u)
        docs.append(d)
        all_grams.append(h)
        contents.append(content)
    if not grams:
        return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.int64)
    u, n = np.unique(np.concatenate(grams), return_counts=True)
    _, first = np.unique(np.concatenate(contents), return_index=True)
    rows = np.bincount(np.searchsorted(u, np.concatenate(all_grams)[first]), minlength=len(u))
    return u, n > 1, rows


MOST = (1 << 16) - 1


def gram_list(grams: np.ndarray, rows: np.ndarray) -> bytes:
    """5-byte hashes of grams, then the number of stretches of each in 2 bytes."""
    return _five(grams).tobytes() + np.minimum(rows, MOST).astype("<u2").tobytes()


def answer_grams(blobs: list[bytes], hot_rows: int = HOT_ROWS) -> list[bytes]:
    """UNIQUE, SHARED or HOT for each gram of each block's list (see ``gram_list``)."""
    sizes = [len(b) // 7 for b in blobs]
    full = np.zeros((sum(sizes), 8), np.uint8)
    full[:, :5] = np.concatenate([np.frombuffer(b, np.uint8, 5 * n).reshape(-1, 5) for b, n in zip(blobs, sizes)])
    rows = np.concatenate([np.frombuffer(b, "<u2", n, 5 * n) for b, n in zip(blobs, sizes)])
    _, which, n = np.unique(full.view("<u8")[:, 0], return_inverse=True, return_counts=True)
    total = np.bincount(which, rows, len(n))
    code = np.where(n == 1, UNIQUE, np.where(total > hot_rows, HOT, SHARED)).astype(np.uint8)[which]
    ends = np.cumsum(sizes)
    return [code[e - n:e].tobytes() for n, e in zip(sizes, ends)]


_CONTEXT = struct.Struct("<IIQ")  # block, rows, span bytes
_OWN = struct.Struct("<III")      # marks, hot windows and stretches that repeat a row of their document


def _pick(rows: dict[str, np.ndarray], at: np.ndarray) -> dict[str, np.ndarray]:
    return {name: x[at] for name, x in rows.items()}


def _window_bits(rows: dict[str, np.ndarray]) -> np.ndarray:
    """A bit for each window of a stretch, by the offset of its sample."""
    one = np.int64(1)
    return (one << (rows["back"] + 1)) - (one << rows["front"])


def _fold(block: Block, rows: dict[str, np.ndarray]):
    """Rows of different content, windows that a smaller document of the block marks, and repeats: (row, its lead) each.

    Rows come in the order of their documents, so the first row of a content is the smallest document's.
    """
    _, first, which = np.unique(rows["content"], return_index=True, return_inverse=True)
    lead = first[which]
    later = np.flatnonzero(lead != np.arange(len(lead)))
    lead = lead[later]
    same = (rows["back"][later] == rows["back"][lead]) & (rows["front"][later] == rows["front"][lead])
    for cut in range(0, len(later), 1 << 13):    # in pieces: the index arrays are 8 times the bytes they address
        part = slice(cut, cut + (1 << 13))
        if same[part].all():
            a, size = block.spans(rows, later[part])
            b, _ = block.spans(rows, lead[part])
            same[part] = np.logical_and.reduceat(a == b, np.cumsum(size) - size)
    # two contents with one 64-bit hash: both are sent
    later, lead = later[same], lead[same]
    keep = np.ones(len(which), bool)
    keep[later] = False
    larger = block.doc_ids[rows["doc"][later]] > block.doc_ids[rows["doc"][lead]]
    marked, alike = later[larger], np.flatnonzero(~larger)
    marks = np.stack([rows["doc"][marked], rows["pos"][marked], _window_bits(_pick(rows, marked))], 1)
    again, lead = _pick(rows, later[alike]), _pick(rows, lead[alike])
    repeats = np.stack([again["doc"], again["pos"], _window_bits(again), lead["doc"], lead["pos"]], 1)
    return _pick(rows, np.flatnonzero(keep)), marks, repeats


def _windows(block: Block, rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The windows of some stretches, one by one."""
    n = rows["back"] - rows["front"] + 1
    which = np.repeat(np.arange(len(n)), n)
    out = _pick(rows, which)
    out["back"] = out["front"] = ragged(rows["front"], n)
    power, _ = scan.powers(block.length)
    content = np.zeros(len(which), np.uint64)
    for cut in range(0, len(which), 1 << 13):
        part = np.arange(cut, min(cut + (1 << 13), len(which)))
        text = block.spans(out, part)[0].reshape(len(part), block.length)
        with np.errstate(over="ignore"):
            for col in range(block.length):
                content[part] += scan._BYTE[text[:, col]] * power[col]
    out["content"] = _placed(scan.mix(content), out["back"])
    return out


def _suffixes(block: Block, codes: np.ndarray, grams: np.ndarray, inside: np.ndarray, counted: np.ndarray, buckets: int):
    """Rows to send, their buckets, and what the block knows itself (see ``_fold``).

    A row is (document number, sample, bytes from the sample back to the first
    window's start and to the last one's, gram, content).
    """
    code_of = np.maximum(codes, np.where(inside, np.where(counted > HOT_ROWS, HOT, SHARED), UNIQUE).astype(codes.dtype))
    cols: dict[str, list] = {c: [] for c in ("doc", "pos", "back", "front", "deal", "content", "hot")}
    for doc, at, lo, hi, h, content in block.samples():
        code = code_of[np.searchsorted(grams, h)]
        use = np.flatnonzero(code > UNIQUE)
        for name, x in (("doc", doc), ("pos", at), ("back", at - lo), ("front", at - hi), ("deal", h), ("content", content),
                        ("hot", code == HOT)):
            cols[name].append(x[use])
    none = np.zeros((0, 3), np.int64), np.zeros((0, 5), np.int64), np.zeros((0, 5), np.int64)
    if not cols["doc"]:
        return None, None, none
    rows, marks, repeats = _fold(block, {name: np.concatenate(x) for name, x in cols.items()})
    del cols
    hot = rows.pop("hot")
    alone, more, windows = _fold(block, _windows(block, _pick(rows, np.flatnonzero(hot))))
    cold = _pick(rows, np.flatnonzero(~hot))
    alone["deal"] = alone["content"]    # windows of hot samples are dealt by themselves
    sent = {name: np.concatenate([x, alone[name]]) for name, x in cold.items()}
    return sent, _bucket(sent["deal"], buckets), (np.concatenate([marks, more]), windows, repeats)


def own_blob(own: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
    """Marks, repeated windows and repeated stretches as bytes."""
    return _OWN.pack(*map(len, own)) + b"".join(x.astype("<u4").tobytes() for x in own)


def context_blobs(block_no: int, block: Block, rows: dict[str, np.ndarray] | None, bucket: np.ndarray) -> dict[int, bytes]:
    """Rows of each bucket as one blob."""
    if rows is None or not len(bucket):
        return {}
    by = np.argsort(bucket, kind="stable")
    out = {}
    for at in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
        body = block.spans(rows, at)[0].tobytes()
        out[int(bucket[at[0]])] = b"".join([
            _CONTEXT.pack(block_no, len(at), len(body)), block.doc_ids[rows["doc"][at]].astype("<i8").tobytes(),
            rows["doc"][at].astype("<u4").tobytes(), rows["pos"][at].astype("<u4").tobytes(),
            rows["back"][at].astype("u1").tobytes(), rows["front"][at].astype("u1").tobytes(), body])
    return out


def mark_bucket(blobs: list[bytes], length: int = LENGTH, gram: int = GRAM) -> dict[int, bytes]:
    """Windows of a bucket that a smaller document also has: {block: rows of (document, sample, bits by offset)}."""
    reach = length - gram
    parts: dict[str, list] = {c: [] for c in ("block", "id", "doc", "pos", "back", "front")}
    texts = []
    for b in blobs:
        block, n, _ = _CONTEXT.unpack_from(b)
        at = _CONTEXT.size
        parts["block"].append(np.full(n, block, np.int64))
        for name, kind in (("id", "<i8"), ("doc", "<u4"), ("pos", "<u4"), ("back", "u1"), ("front", "u1")):
            parts[name].append(np.frombuffer(b, kind, n, at))
            at += n * np.dtype(kind).itemsize
        texts.append(np.frombuffer(b, np.uint8, offset=at))
    p = {name: np.concatenate(x) for name, x in parts.items()}
    back, front = p["back"].astype(np.int64), p["front"].astype(np.int64)
    n = len(back)
    size = back - front + length
    grid = np.zeros((n, reach + length), np.uint8)   # the sample lies at column ``reach``
    text, start = np.concatenate(texts), np.cumsum(size) - size
    for cut in range(0, n, 1 << 14):    # in pieces: the index arrays are 8 times the bytes they address
        k = np.arange(cut, min(cut + (1 << 14), n))
        grid.reshape(-1)[ragged(k * grid.shape[1] + reach - back[k], size[k])] = text[start[k[0]]:start[k[-1]] + size[k[-1]]]
    del text, texts
    bits = np.zeros(n, np.uint64)
    power, inverse = scan.powers(grid.shape[1] + 1)
    # (sum over columns < s) and (sum over columns < s + length) of byte code * B**column
    low, high = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for col in range(length):
            high += scan._BYTE[grid[:, col]] * power[col]
        for s in range(reach + 1):
            offset = reach - s
            rows = np.flatnonzero((front <= offset) & (offset <= back))
            if len(rows) > 1:
                key = scan.mix((high[rows] - low[rows]) * inverse[s])
                by = np.lexsort((p["id"][rows], key))
                rows, key = rows[by], key[by]
                head = np.concatenate([[True], key[1:] != key[:-1]])
                first = np.flatnonzero(head)[np.cumsum(head) - 1]
                later = np.flatnonzero(p["id"][rows] > p["id"][rows[first]])
                for cut in range(0, len(later), 1 << 16):
                    part = later[cut:cut + (1 << 16)]
                    same = (grid[rows[part], s:s + length] == grid[rows[first[part]], s:s + length]).all(1)
                    if not same.all():
                        raise ArithmeticError("two strings with one 64-bit hash: choose another byte table seed")
                bits[rows[later]] |= np.uint64(1 << offset)
            if s < reach:
                low += scan._BYTE[grid[:, s]] * power[s]
                high += scan._BYTE[grid[:, s + length]] * power[s + length]
    hit = np.flatnonzero(bits)
    hit = hit[np.argsort(p["block"][hit], kind="stable")]
    out = {}
    for rows in np.split(hit, np.flatnonzero(np.diff(p["block"][hit])) + 1):
        if len(rows):
            out[int(p["block"][rows[0]])] = (p["doc"][rows].astype("<u4").tobytes() + p["pos"][rows].astype("<u4").tobytes()
                                             + bits[rows].astype("<u4").tobytes())
    return out


def _joined(key: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, all bits of each."""
    by = np.argsort(key, kind="stable")
    key, bits = key[by], bits[by]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[new], np.bitwise_or.reduceat(bits, new) if len(key) else bits


def _verdicts(own: bytes, blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document << 32 | sample, bits by offset) of all windows to remove: answered, known, and what repeats those."""
    n, m, r = _OWN.unpack_from(own)
    cells = np.frombuffer(own, "<u4", offset=_OWN.size).astype(np.int64)
    doc, pos, bits = (np.concatenate(x) for x in zip(
        cells[:3 * n].reshape(-1, 3).T, *(np.frombuffer(b, "<u4").astype(np.int64).reshape(3, -1) for b in blobs)))
    key, bits = _joined(doc << 32 | pos, bits)
    # windows first: a stretch that repeats another shares what is known of each of its windows
    for again in (cells[3 * n:3 * n + 5 * m].reshape(-1, 5).T, cells[3 * n + 5 * m:].reshape(-1, 5).T):
        lead = again[3] << 32 | again[4]
        place = np.searchsorted(key, lead)
        found = np.flatnonzero(place < len(key))
        found = found[key[place[found]] == lead[found]]
        more = again[2][found] & bits[place[found]]
        key, bits = _joined(np.concatenate([key, again[0][found] << 32 | again[1][found]]), np.concatenate([bits, more]))
    return key, bits


def removed_mask(block: Block, own: bytes, blobs: list[bytes]):
    """Per slice of the block: (first document, Joined, mask of removed bytes)."""
    key, bits = _verdicts(own, blobs)
    doc, pos = key >> 32, key & ((1 << 32) - 1)
    for k, j in block.slices():
        a, z = np.searchsorted(doc, [k, k + j.docs])
        at = j.first[doc[a:z] - k] + pos[a:z]
        start = np.concatenate([at[bits[a:z] >> o & 1 == 1] - o for o in range(block.length - block.gram + 1)])
        edge = np.bincount(start, minlength=len(j.buf) + 1).astype(np.int64)
        edge -= np.bincount(start + block.length, minlength=len(j.buf) + 1)
        yield k, j, np.cumsum(edge[:-1]) > 0


# -- Spark jobs ---------------------------------------------------------------


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_bytes: bool = False,
          parts: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row (and the kept bytes)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    parts = parts or _blocks(docs)
    single, copies = _split_copies(docs)
    # by the text too: rows without an id, or with the same one, spread as well
    block_of = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int")
    dealt = single.withColumn("block", block_of).repartition(parts, "block")

    def load(table: pa.Table) -> Block:
        ids = table.column("doc_id").combine_chunks()
        ids = ids.fill_null(LAST_ID).to_numpy(zero_copy_only=False)
        return Block(ids, [b"" if t is None else t for t in table.column("text").to_pylist()], length, gram)

    def lists(table: pa.Table) -> pa.Table:
        grams, _, counted = _distinct_grams(load(table))
        bucket = _bucket(grams, parts)    # ascending, as the grams are
        ends = np.searchsorted(bucket, np.arange(parts + 1))
        some = np.flatnonzero(np.diff(ends))
        return pa.table({"block": pa.array(np.full(len(some), table.column("block")[0].as_py()), pa.int32()),
                         "bucket": pa.array(some, pa.int32()),
                         "grams": pa.array([gram_list(grams[ends[b]:ends[b + 1]], counted[ends[b]:ends[b + 1]])
                                            for b in some], pa.binary())})

    def answers(table: pa.Table) -> pa.Table:
        codes = answer_grams(table.column("grams").to_pylist())
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "codes": pa.array(codes, pa.binary())})

    def scanned(block: Block, table: pa.Table):
        """The block's grams again, with the answers in their order."""
        grams, inside, counted = _distinct_grams(block)
        by = np.argsort(table.column("bucket").to_numpy(), kind="stable")
        codes = table.column("codes").to_pylist()
        code = np.frombuffer(b"".join(codes[r] for r in by), np.uint8)
        if len(code) != len(grams):
            raise ValueError("answers don't fit the block")
        return _suffixes(block, code, grams, inside, counted, parts)

    def contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        block = load(left)
        sent, bucket, own = scanned(block, right)
        blobs = context_blobs(left.column("block")[0].as_py(), block, sent, bucket)
        # what the block knows itself travels along as an answer in a bucket below 0
        return pa.table({"bucket": pa.array([-1 - left.column("block")[0].as_py(), *blobs], pa.int32()),
                         "rows": pa.array([own_blob(own), *blobs.values()], pa.binary())})

    def marks(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:
            out = {-1 - bucket: table.column("rows")[0].as_py()}
        else:
            out = mark_bucket(table.column("rows").to_pylist(), length, gram)
        return pa.table({"block": pa.array(list(out), pa.int32()),
                         "own": pa.array([bucket < 0] * len(out), pa.bool_()),
                         "rows": pa.array(list(out.values()), pa.binary())})

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        block = load(left)
        own, rows = right.column("own").to_pylist(), right.column("rows").to_pylist()
        known = next((r for o, r in zip(own, rows) if o), own_blob((np.zeros(0),) * 3))
        cols: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for _, j, gone in removed_mask(block, known, [r for o, r in zip(own, rows) if not o]):
            total = np.concatenate([[0], np.cumsum(gone)])
            rise = np.concatenate([[0], np.cumsum(gone & ~np.concatenate([[False], gone[:-1]]))])
            for a, z in zip(j.first.tolist(), j.last.tolist()):
                kept = j.buf[a:z][~gone[a:z]].tobytes()
                cols["n_bytes"].append(z - a)
                cols["n_removed"].append(int(total[z] - total[a]))
                cols["n_spans"].append(int(rise[z] - rise[a]))
                cols["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if with_bytes:
                    cols["kept"].append(kept)
        ids = left.column("doc_id").combine_chunks().take(pa.array(block.order, pa.int64()))
        out = {"doc_id": ids, **{c: pa.array(cols[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")},
               "kept_sha256": pa.array(cols["kept_sha256"], pa.string())}
        return pa.table(out | ({"kept": pa.array(cols["kept"], pa.binary())} if with_bytes else {}))

    def by_block(rows: DataFrame):
        return dealt.groupBy("block").cogroup(rows.groupBy("block"))

    sent = dealt.groupBy("block").applyInArrow(lists, "block int, bucket int, grams binary")
    got = sent.groupBy("bucket").applyInArrow(answers, "block int, bucket int, codes binary")
    rows = by_block(got).applyInArrow(contexts, "bucket int, rows binary")
    found = rows.groupBy("bucket").applyInArrow(marks, "block int, own boolean, rows binary")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    out = by_block(found).applyInArrow(cut, schema + ", kept binary" * with_bytes)
    return out.unionByName(_emptied(copies, length, with_bytes))


def _blocks(docs: DataFrame) -> int:
    """How many blocks hold the text in ``BLOCK_BYTES`` each; ``BLOCKS`` for each shuffle partition at least."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(BLOCKS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))


def _split_copies(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose text no smaller document has as a whole, and the others."""
    keys = docs.select("doc_id", F.sha2("text", 256).alias("sha")).filter("sha is not null")
    first = keys.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = keys.join(first, "sha").filter("first is not null and (doc_id is null or doc_id > first)")
    # rows that share an id but not the text are told apart by the digest
    found = stage_table(later.select(F.col("doc_id").alias("copy_id"), F.col("sha").alias("copy_sha")).distinct(),
                        "suffix-copies")
    on = F.col("doc_id").eqNullSafe(F.col("copy_id")) & (F.sha2("text", 256) == F.col("copy_sha"))
    marked = join_small_side(docs, found, on, "left", max_rows=SMALL_ROWS)
    one = marked.filter("copy_sha is null").select("doc_id", "text")
    return one, marked.filter("copy_sha is not null").select("doc_id", "text")


def _emptied(copies: DataFrame, length: int, with_bytes: bool) -> DataFrame:
    """Answers for whole copies: everything goes, or nothing of a text shorter than ``length``."""
    n = F.octet_length("text").cast("long")
    long = n >= length
    kept = F.when(long, F.lit(b"")).otherwise(F.col("text"))
    rows = copies.select("doc_id", n.alias("n_bytes"), F.when(long, n).otherwise(F.lit(0)).cast("long").alias("n_removed"),
                         long.cast("long").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"),
                         *([kept.alias("kept")] if with_bytes else []))
    return rows
