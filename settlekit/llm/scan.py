"""Vectorised scanning of text columns inside Arrow tasks.

A slice of documents is joined into one byte buffer (a newline behind each
document, so no word crosses documents) and words, lines and their 64-bit
hashes are found with numpy, without a Python loop over words. Slices are
bounded in bytes, so a task's memory does not depend on the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18    # the arrays made of a slice, some 25 times as much, stay near the cache

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i mod 2**64 for i < n (kept, grown by doubling)."""
    if len(_powers.get("p", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for key, base in (("p", _BASE), ("q", _BASE_INV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            with np.errstate(over="ignore"):
                _powers[key] = np.cumprod(a, dtype=np.uint64)
    return _powers["p"][:n], _powers["q"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64 (all bits depend on all bits)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut so that each slice has about ``limit`` text bytes (one row at least)."""
    n = batch.num_rows
    if n == 0:
        return
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    done = 0
    ends = np.cumsum(sizes)
    while done < n:
        base = ends[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(done, stop - done)
        done = stop


def payloads(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; a null is empty."""
    return [b"" if v is None else v for v in col.cast(pa.binary()).to_pylist()]


@dataclass
class Joined:
    """Documents laid end to end, each followed by a newline that is not its own."""

    buf: np.ndarray      # uint8
    first: np.ndarray    # first byte of each document
    last: np.ndarray     # one behind its last byte (where the extra newline lies)

    @property
    def docs(self) -> int:
        return len(self.first)


def join(texts: list[bytes], lower: bool = False) -> Joined:
    buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if lower:
        buf = _LOWER[buf]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    last = np.cumsum(sizes + 1) - 1
    return Joined(buf, last - sizes, last)


def runs(keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    if not len(keep):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.flatnonzero(keep[1:] != keep[:-1]) + 1
    start, end = edge, edge
    if keep[0]:
        edge = np.concatenate([[0], edge])
    if keep[-1]:
        edge = np.concatenate([edge, [len(keep)]])
    start, end = edge[0::2], edge[1::2]
    return start, end


def words(j: Joined) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each word: maximal runs of bytes other than space and 0x09-0x0D."""
    start, end = runs(~_SPACE[j.buf])
    return start, end, np.searchsorted(j.last, start, "left")


_INNER = np.ones(256, bool)  # bytes that are not stripped from the ends of a word: letters, digits, non-ASCII
_INNER[33:127] = False
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    _INNER[_lo:_hi] = True


def bare_words(j: Joined) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words without the ASCII punctuation around them; words of punctuation alone are left out."""
    start, end, doc = words(j)
    inner = _INNER[j.buf]
    inside = np.concatenate([[0], np.cumsum(inner)])
    where = np.flatnonzero(inner)
    some = inside[end] > inside[start]
    start, end, doc = start[some], end[some], doc[some]
    return where[inside[start]], where[inside[end] - 1] + 1, doc


def lines(j: Joined) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each newline-separated line; an empty document has one empty line."""
    end = np.flatnonzero(j.buf == 10)
    start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
    return start, end, np.searchsorted(j.last, end, "left")


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """C with C[e] - C[s] = sum of byte codes times B**position over [s, e)."""
    p, _ = powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[buf] * p[:-1], out=out[1:])
    return out


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes wherever they lie."""
    _, q = powers(len(c))
    with np.errstate(over="ignore"):
        return mix((c[end] - c[start]) * q[start] + (end - start).astype(np.uint64))


def shingles(h: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of a document and their document.

    A document with fewer than k words (but one at least) gives its whole
    word sequence as one shingle.
    """
    count = np.bincount(doc, minlength=n_docs)
    m = len(h)
    with np.errstate(over="ignore"):
        out = np.zeros(max(0, m - k + 1), np.uint64)
        for i in range(k):
            out = mix(out * _BASE + h[i:i + len(out)])
    whole = doc[:len(out)] == doc[k - 1:] if len(out) else np.zeros(0, bool)
    sh, owner = out[whole], doc[:len(out)][whole]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        first = np.cumsum(count) - count
        extra = np.empty(len(short), np.uint64)
        with np.errstate(over="ignore"):
            for r, d in enumerate(short):
                acc = np.zeros(1, np.uint64)
                for x in h[first[d]:first[d] + count[d]]:
                    acc = mix(acc * _BASE + x)
                extra[r] = mix(acc + np.uint64(count[d]))[0]
        sh, owner = np.concatenate([sh, extra]), np.concatenate([owner, short])
    return sh, owner


def distinct(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, hash) pairs in that order, and how often each occurs."""
    if not len(h):
        return h, doc, np.zeros(0, np.int64)
    by = np.argsort(h, kind="stable")
    by = by[np.argsort(doc[by], kind="stable")]
    h, doc = h[by], doc[by]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
    at = np.flatnonzero(new)
    return h[at], doc[at], np.diff(np.concatenate([at, [len(h)]]))
