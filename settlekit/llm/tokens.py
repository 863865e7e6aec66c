"""Token ids of whole texts by the tokenizers library, one lookup per distinct chunk.

A text is cut into chunks (a word with the white space before it). Both
vocabularies used here split text at white space before any merge, so the ids
of a text are the ids of its chunks laid end to end; each distinct chunk of a
slice is encoded once and kept in a bounded table. Texts for which that isn't
certain (white space other than the six ASCII kinds, where it matters, and
strings of special tokens, which the library takes for these tokens unless it is
told that they are plain text) are encoded whole by the same library.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import regex
from tokenizers import Tokenizer

from settlekit.llm import scan

KEPT_CHUNKS = 2_000_000   # chunks a worker keeps (some 30 bytes each); further ones are encoded per slice
KEPT_PARTS = 200_000      # pieces of chunks a worker keeps (some 200 bytes each)

# the split patterns of the two vocabulary files (fixed values)
_WORD_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_BYTE_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_PLAIN = re.compile("[\x20\x09-\x0d\x21-\x7e\xa1-\xff]*")    # characters whose case and form need no library
_CONTROL = re.compile("[\x00-\x08\x0e-\x1f\x7f]")
_ODD_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


class Encoder:
    """``encode(texts)`` gives the ids of all texts, end to end, and the number of each."""

    def __init__(self, path: str, kept: int = KEPT_CHUNKS, plain_specials: bool = False):
        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = plain_specials
        added = [] if plain_specials else [t.content.encode() for t in self.lib.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, added))) if added else None
        self.lib.no_truncation()
        self.lib.no_padding()
        self.model = self.lib.model
        self.words = self.lib.normalizer is not None  # lower-case words, white space dropped
        self.kept = kept
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint16)
        self.parts: dict[str, list[int]] = {}

    # -- one chunk -----------------------------------------------------------

    def _part(self, s: str) -> list[int]:
        got = self.parts.get(s)
        if got is None:
            if s.isascii():
                form = "\u0120" + s[1:] if s[0] == " " and s[1:].isalpha() else s if s.isalpha() else None
            else:
                form = None
            if form is None:
                form = s.encode().decode("latin-1").translate(_LETTERS)
            got = [t.id for t in self.model.tokenize(form)]
            if len(self.parts) < KEPT_PARTS:
                self.parts[s] = got
        return got

    def chunk(self, raw: bytes) -> list[int]:
        s = raw.decode()
        if not (s.isascii() or _PLAIN.fullmatch(s)) or "<|" in s or _CONTROL.search(s):
            return self.lib.encode(s, add_special_tokens=False).ids
        if self.words:
            s = s.lower()
        # a word, or a word and one mark, needs no pattern
        core = s[1:] if s[:1] == " " else s
        if core.isalpha():
            return self._part(s)
        if core[:-1].isalpha() and core[-1] in ".,:;!?":
            return self._part(s[:-1]) + self._part(s[-1])
        out: list[int] = []
        for p in (_WORD_SPLIT if self.words else _BYTE_SPLIT).findall(s):
            out += self._part(p)
        return out

    # -- slices of texts -----------------------------------------------------

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        whole = {}
        for k, t in enumerate(texts):
            # without lower-casing, white space is encoded too
            if (self.special is not None and self.special.search(t)) or (
                    not self.words and not t.isascii() and _ODD_SPACE.search(t.decode())):
                whole[k] = self.lib.encode(t.decode(), add_special_tokens=False).ids
        j = scan.join([b"" if k in whole else t for k, t in enumerate(texts)])
        start, end, doc = scan.words(j)
        if not self.words:
            start, end, doc = self._with_space(j, start, end, doc)
        h = scan.span_hash(scan.prefix_hash(j.buf), start, end)
        keys, first, which = np.unique(h, return_index=True, return_inverse=True)
        at, size, flat = self._lookup(keys, j.buf, start[first], end[first])
        n = size[which]
        per_doc = np.bincount(doc, n, minlength=j.docs).astype(np.int64)
        ids = flat[ragged(at[which], n)]
        if whole:
            cut = np.split(ids, np.cumsum(per_doc)[:-1])
            for k, w in whole.items():
                cut[k] = np.array(w, np.uint16)
                per_doc[k] = len(w)
            ids = np.concatenate(cut)
        return ids, per_doc

    @staticmethod
    def _with_space(j, start, end, doc):
        """Each word with the white space before it, and what white space a text ends with."""
        head = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
        before = np.concatenate([[0], end[:-1]]) if len(end) else end
        start = np.where(head, j.first[doc], before)
        tail = j.first.copy()
        np.maximum.at(tail, doc, end)
        left = np.flatnonzero(tail < j.last)
        order = np.argsort(np.concatenate([start, tail[left]]), kind="stable")
        return tuple(np.concatenate(x)[order] for x in ((start, tail[left]), (end, j.last[left]), (doc, left)))

    def _lookup(self, keys, buf, start, end):
        at = np.searchsorted(self.keys, keys)
        hit = np.zeros(len(keys), bool)
        if len(self.keys):
            at = np.minimum(at, len(self.keys) - 1)
            hit = self.keys[at] == keys
        pos, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        pos[hit], size[hit] = self.start[at[hit]], self.count[at[hit]]
        new = np.flatnonzero(~hit)
        if not len(new):
            return pos, size, self.flat
        raw = buf.tobytes()
        lists = [self.chunk(raw[a:b]) for a, b in zip(start[new].tolist(), end[new].tolist())]
        size[new] = np.fromiter(map(len, lists), np.int64, len(lists))
        fresh = np.fromiter(chain.from_iterable(lists), np.uint16, int(size[new].sum()))
        pos[new] = len(self.flat) + np.cumsum(size[new]) - size[new]
        flat = np.concatenate([self.flat, fresh])
        room = self.kept - len(self.keys)
        if room > 0:
            new = new[:room]
            where = np.searchsorted(self.keys, keys[new])
            self.keys = np.insert(self.keys, where, keys[new])
            self.start = np.insert(self.start, where, pos[new])
            self.count = np.insert(self.count, where, size[new])
            self.flat = flat[:len(self.flat) + int(size[new].sum())]
        return pos, size, flat


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices start[0], start[0]+1, ... (count[0] of them), start[1], ..."""
    total = int(count.sum())
    first = np.cumsum(count) - count
    return np.repeat(start - first, count) + np.arange(total)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder of a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
