"""Statistics of whole texts, one row per document, computed slice by slice.

Null and empty texts give zeros everywhere. Every value comes from the whole
text. ``NAMES`` gives the columns of the matrix.
"""

from __future__ import annotations

import numpy as np

from settlekit.llm import scan

NAMES = [
    "log_bytes", "log_words", "word_len", "words_per_line", "upper_share", "digit_share",
    "symbol_share", "bang_share", "stop_share", "bar_share", "punct_share", "high_share",
    "distinct_words", "dup_lines", "dup_line_bytes", "repeat_trigrams", "long_words", "longest_word",
    "top_word", "caps_words", "short_words",
]

_CLASS = np.zeros(256, np.uint8)  # byte class, 0 = letters and the rest
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>@^~=+_\\{}[]",
                             b"!", b".", b"|", b",;:?'\"()-/"), 1):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _k
_CLASS[128:] = 8


def _share(top, bottom):
    return np.divide(top, bottom, out=np.zeros(len(top)), where=bottom > 0)


def matrix(texts: list[bytes]) -> np.ndarray:
    """float32 matrix, one row per text."""
    j = scan.join(texts)
    n = j.docs
    if n == 0:
        return np.zeros((0, len(NAMES)), np.float32)
    size = (j.last - j.first).astype(np.float64)
    cls = _CLASS[j.buf]
    at = np.flatnonzero(cls)
    owner = np.searchsorted(j.last, at, "left")
    count = np.bincount(owner * 9 + cls[at], minlength=9 * n).reshape(n, 9).astype(np.float64)

    c = scan.prefix_hash(j.buf)
    start, end, doc = scan.words(j)
    wlen = (end - start).astype(np.float64)
    words = np.bincount(doc, minlength=n).astype(np.float64)
    chars = np.bincount(doc, wlen, minlength=n)
    h = scan.span_hash(c, start, end)
    _, ud, uc = scan.distinct(h, doc)
    distinct = np.bincount(ud, minlength=n).astype(np.float64)
    top = np.zeros(n)
    np.maximum.at(top, ud, uc)
    upper = np.concatenate([[0], np.cumsum(cls == 1)])
    caps = (upper[end] - upper[start] >= 2) & (upper[end] - upper[start] >= 0.5 * wlen)
    longest = np.zeros(n)
    np.maximum.at(longest, doc, wlen)
    th, td = scan.shingles(h, doc, n, 3)
    _, tdoc, tcount = scan.distinct(th, td)
    repeated = np.bincount(tdoc, np.where(tcount > 1, tcount, 0), minlength=n)

    ls, le, ld = scan.lines(j)
    full = le > ls
    ls, le, ld = ls[full], le[full], ld[full]
    lines = np.bincount(ld, minlength=n).astype(np.float64)
    lh = scan.span_hash(c, ls, le)
    by = np.argsort(lh, kind="stable")
    by = by[np.argsort(ld[by], kind="stable")]
    again = np.zeros(len(lh), bool)
    again[by[1:]] = (lh[by[1:]] == lh[by[:-1]]) & (ld[by[1:]] == ld[by[:-1]])
    dup_lines = np.bincount(ld[again], minlength=n)
    dup_bytes = np.bincount(ld[again], (le - ls)[again], minlength=n)

    def of(mask):
        return np.bincount(doc[mask], minlength=n)

    cols = [
        np.log1p(size), np.log1p(words), _share(chars, words), np.log1p(_share(words, lines)),
        _share(count[:, 1], size), _share(count[:, 2], size), _share(count[:, 3], size), _share(count[:, 4], size),
        _share(count[:, 5], size), _share(count[:, 6], size), _share(count[:, 7], size), _share(count[:, 8], size),
        _share(distinct, words), _share(dup_lines, lines), _share(dup_bytes, size),
        _share(repeated, np.maximum(words - 2, 0)), _share(of(wlen > 20), words), np.log1p(longest),
        _share(top, words), _share(of(caps), words), _share(of(wlen <= 3), words),
    ]
    return np.stack(cols, 1).astype(np.float32)
