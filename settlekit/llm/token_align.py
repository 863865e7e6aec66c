"""Alignment of two tokenizers' tokens over the same bytes, by diagonal run skipping.

Both token sequences of a text cover the bytes of a space and the text. Where
a token of A and one of B end at the same byte, a group ends. Mostly the two go
in step, so the end arrays are compared at the current index shift, in stretches
that double as long as they agree; an irregular group is resolved by stepping
the side that is behind until both end together, and the shift is updated.

A link is a pair of token occurrences whose bytes overlap; a pair of ids counts
the documents that hold it linked.

Cases: a text that is null or empty, or that either tokenizer doesn't give back
byte for byte, has no tokens: zeros and an empty ``groups_sha256``. Repeated rows
are documents of their own, also in the counts. Other columns are ignored; an
empty table gives no rows.

Scale: a text is tokenized and aligned once; what is kept of it are its distinct
id pairs. Pairs are counted per task before they are shuffled. The most frequent
``KNOWN_PAIRS`` pairs go to every task (12 bytes each); the others, which by then
are each in few documents, meet the documents in a join on the pair. No pair is
left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm import scan
from settlekit.llm.tokens import _LETTERS as LETTERS
from settlekit.llm.tokens import Encoder, ragged
from settlekit.session import stage_table

SLICE = 1 << 20            # text bytes aligned at once
KEPT = 1_000_000           # chunks a worker keeps (some 40 bytes each); further ones are encoded per slice
FIRST_STRETCH = 4
SPACE = "\u2581"           # how B's pieces write a space
KNOWN_PAIRS = 2_000_000
PAIRS_HELD = 1_500_000     # pairs a task counts before it hands them on


# -- the aligner --------------------------------------------------------------


def common_ends(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Stretches of the two end lists that close groups: (place in a, place in b, how many in step).

    Both lists rise and end with the same value. Every common end is in exactly
    one stretch; what lies between two stretches, on either side, belongs to the
    first group of the second one.
    """
    at_a, at_b, steps = [], [], []
    i = j = 0
    n, m = len(a), len(b)
    while i < n and j < m:
        # in step: stretches of doubling length at this shift, compared as a whole
        start, size = i, FIRST_STRETCH
        while True:
            size = min(size, n - i, m - j)
            if size <= 0:
                break
            if a[i:i + size] == b[j:j + size]:
                i, j = i + size, j + size
                size *= 2
                continue
            if size == 1:
                break
            # the last agreeing place of this stretch: probe its halves
            size //= 2
            while size:
                if a[i:i + size] == b[j:j + size]:
                    i, j = i + size, j + size
                size //= 2
            break
        if i > start:
            at_a.append(start)
            at_b.append(j - (i - start))
            steps.append(i - start)
        if i >= n or j >= m:
            break
        # out of step: the side that is behind moves until both end together
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        at_a.append(i)
        at_b.append(j)
        steps.append(1)
        i, j = i + 1, j + 1
    return at_a, at_b, steps


@dataclass
class Aligned:
    """Groups and links of the documents of a slice, laid end to end."""

    a_last: np.ndarray    # last A token of each group
    b_last: np.ndarray
    link_a: np.ndarray    # A token of each link
    link_b: np.ndarray


def align(a_end: np.ndarray, b_end: np.ndarray) -> Aligned:
    """Groups and links of two rising end arrays with the same last value."""
    at_a, at_b, steps = common_ends(a_end.tolist(), b_end.tolist())
    steps = np.array(steps, np.int64)
    a_last = ragged(np.array(at_a, np.int64), steps)
    b_last = ragged(np.array(at_b, np.int64), steps)
    # a group of p A tokens and q B tokens holds p + q - 1 links: one for each end inside it
    a_of, b_of = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
    simple = (a_of == 1) & (b_of == 1)
    odd = ~simple
    n = (a_of + b_of - 1)[odd]
    if not len(n):
        return Aligned(a_last, b_last, a_last, b_last)
    ia = ragged(a_last[odd] - a_of[odd] + 1, a_of[odd])
    ib = ragged(b_last[odd] - b_of[odd] + 1, b_of[odd])
    cuts = np.unique(np.concatenate([a_end[ia], b_end[ib]]))
    link_a = ia[np.searchsorted(a_end[ia], cuts, "left")]
    link_b = ib[np.searchsorted(b_end[ib], cuts, "left")]
    return Aligned(a_last, b_last, np.concatenate([a_last[simple], link_a]), np.concatenate([b_last[simple], link_b]))


# -- two tokenizers -----------------------------------------------------------


class TwoTokenizers:
    """Ids of both tokenizers, one lookup for each distinct chunk of a slice.

    A chunk is a word with the white space before it; no token of either
    vocabulary crosses from a word into white space. Texts for which that isn't
    sure are encoded whole.
    """

    def __init__(self, a_path: str, b_path: str, kept: int = KEPT):
        self.a = Encoder(a_path, plain_specials=True)
        letters = {c: b for b, c in LETTERS.items()}
        tokens = map(self.a.lib.id_to_token, range(self.a.lib.get_vocab_size()))
        self.a_bytes = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in tokens]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("vocabularies of at most 65,536 tokens are supported")
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.space = self.b.piece_to_id(SPACE)
        # white space inside a piece (behind its leading spaces): a chunk can't begin there
        inner = {c for i, p in enumerate(pieces) if not self.b.is_byte(i) for c in p.lstrip(SPACE)}
        if SPACE in inner:
            raise ValueError("pieces with a space behind another character are not supported")
        self.unsure = re.compile("[" + "".join(c for c in "\t\n\x0b\x0c\r" if c in inner)
                                 + "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
        self.kept = kept
        self.keys = np.zeros(0, np.uint64)
        self.info = np.zeros((5, 0), np.int32)   # start and number of A ids, of B ids, whether the bytes come back
        self.flat = [np.zeros(0, np.uint16), np.zeros(0, np.uint16)]

    def _checked(self, a: list[int], b: list[int], want: bytes):
        good = b"".join(map(self.a_bytes.__getitem__, a)) == want == b"".join(map(self.b_bytes.__getitem__, b))
        return (a, b) if good else None

    def whole(self, text: bytes) -> tuple[list[int], list[int]] | None:
        """Ids of a space and the text, or None if the bytes don't come back."""
        s = text.decode()
        return self._checked(self.a.lib.encode(" " + s, add_special_tokens=False).ids, self.b.encode(s), b" " + text)

    def chunk(self, raw: bytes) -> tuple[list[int], list[int]] | None:
        """Ids of a chunk; B puts a space before it, which stands for its own or is taken off."""
        if raw[:1] == b" ":
            b = self.b.encode(raw[1:].decode()) or [self.space]
        else:
            b = self.b.encode(raw.decode())[1:]
        return self._checked(self.a.chunk(raw), b, raw)

    def encode(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """(places, A ids, their number by text, B ids, their number) of the texts that come back, in groups."""
        apart = [k for k, t in enumerate(texts) if self.unsure.search(t.decode())]
        if apart:
            got = [(k, ids) for k in apart if (ids := self.whole(texts[k]))]
            if got:
                yield (np.array([k for k, _ in got]), *(
                    x for side in (0, 1) for x in (
                        np.fromiter(chain.from_iterable(ids[side] for _, ids in got), np.int64),
                        np.array([len(ids[side]) for _, ids in got], np.int64))))
        out = set(apart)
        places = np.array([k for k, t in enumerate(texts) if t and k not in out], np.int64)
        if not len(places):
            return
        j = scan.join([b" " + texts[k] for k in places])
        start, end, doc = Encoder._with_space(j, *scan.words(j))
        keys, first, which = np.unique(scan.span_hash(scan.prefix_hash(j.buf), start, end),
                                       return_index=True, return_inverse=True)
        info, flat = self._lookup(keys, j.buf, start[first], end[first])
        bad = np.zeros(j.docs, bool)
        bad[doc[info[4, which] == 0]] = True
        use = ~bad[doc]
        which, doc = which[use], doc[use]
        good = np.flatnonzero(~bad)
        if len(good):
            yield (places[good], *(x for side in (0, 1) for x in (
                flat[side][ragged(info[2 * side, which], info[2 * side + 1, which])].astype(np.int64),
                np.bincount(doc, info[2 * side + 1, which], minlength=j.docs).astype(np.int64)[good])))

    def _lookup(self, keys, buf, start, end):
        at = np.searchsorted(self.keys, keys)
        hit = np.zeros(len(keys), bool)
        if len(self.keys):
            at = np.minimum(at, len(self.keys) - 1)
            hit = self.keys[at] == keys
        info = np.zeros((5, len(keys)), np.int64)
        info[:, hit] = self.info[:, at[hit]]
        new = np.flatnonzero(~hit)
        if not len(new):
            return info, self.flat
        raw = buf.tobytes()
        found = [self.chunk(raw[a:b]) for a, b in zip(start[new].tolist(), end[new].tolist())]
        info[4, new] = [f is not None for f in found]
        flat = []
        for side in (0, 1):
            lists = [f[side] if f else () for f in found]
            n = np.fromiter(map(len, lists), np.int64, len(lists))
            info[2 * side, new] = len(self.flat[side]) + np.cumsum(n) - n
            info[2 * side + 1, new] = n
            flat.append(np.concatenate([self.flat[side], np.fromiter(chain.from_iterable(lists), np.uint16, int(n.sum()))]))
        keep = new[:max(0, self.kept - len(self.keys))]
        if len(keep):
            where = np.searchsorted(self.keys, keys[keep])
            self.keys = np.insert(self.keys, where, keys[keep])
            self.info = np.insert(self.info, where, info[:, keep], axis=1)
            self.flat = [f[:int((info[2 * s, keep[-1]] + info[2 * s + 1, keep[-1]]))] for s, f in enumerate(flat)]
        return info, flat


_pairs_of: dict[tuple[str, str], TwoTokenizers] = {}


def tokenizers(a_path: str, b_path: str) -> TwoTokenizers:
    """This worker's pair of tokenizers."""
    if (a_path, b_path) not in _pairs_of:
        _pairs_of[a_path, b_path] = TwoTokenizers(a_path, b_path)
    return _pairs_of[a_path, b_path]


# -- documents ----------------------------------------------------------------

_DIGITS = [np.frombuffer(b"".join(b"%d," % i for i in range(1 << 16)), np.uint8)]
_DIGITS.append(np.array([len(b"%d," % i) for i in range(1 << 16)], np.int64))
_DIGITS.append(np.cumsum(_DIGITS[1]) - _DIGITS[1])


def group_text(a_ids, b_ids, al: Aligned, a_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2,b3;`` over all documents, and the end of each document's part in them.

    ``a_first``: the first A token of each document.
    """
    a_of, b_of = np.diff(al.a_last, prepend=-1), np.diff(al.b_last, prepend=-1)
    # each group's A tokens, then its B tokens
    place = np.cumsum(a_of + b_of)
    a_at = ragged(place - b_of - a_of, a_of)
    b_at = ragged(place - b_of, b_of)
    ids = np.empty(len(a_ids) + len(b_ids), np.int64)
    ids[a_at], ids[b_at] = a_ids, b_ids
    flat, size, first = _DIGITS
    n = size[ids]
    out = flat[ragged(first[ids], n)]   # a copy: separators are set in it
    last = np.cumsum(n) - 1
    out[last[place - b_of - 1]] = ord("|")
    out[last[place - 1]] = ord(";")
    # a document ends before the group that holds the next one's first A token
    group = np.searchsorted(al.a_last, np.append(a_first[1:], len(a_ids)) - 1, "left")
    return out, last[place[group] - 1]


def _slice(texts: list[bytes], two: TwoTokenizers) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of each text."""
    none = np.zeros(0, "<u4").tobytes()
    out = [(0, 0, 0, 0, "", none, none)] * len(texts)
    for places, a_ids, a_n, b_ids, b_n in two.encode(texts):
        al = align(np.cumsum(two.a_len[a_ids]), np.cumsum(two.b_len[b_ids]))
        doc = np.repeat(np.arange(len(places)), a_n)
        groups = np.bincount(doc[al.a_last], minlength=len(places))
        owner = doc[al.link_a]
        links = np.bincount(owner, minlength=len(places))
        text, ends = group_text(a_ids, b_ids, al, np.cumsum(a_n) - a_n)
        code = np.sort((owner << 32) | (a_ids[al.link_a] << 16) | b_ids[al.link_b])
        new = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        times = np.diff(np.append(new, len(code))).astype("<u4")
        code = code[new]
        cut = np.searchsorted(code >> 32, np.arange(len(places) + 1))
        pairs = (code & 0xFFFFFFFF).astype("<u4")
        raw = text.tobytes()
        begin = 0
        for k, at in enumerate(places.tolist()):
            end = int(ends[k])
            sha = hashlib.sha256(raw[begin:end]).hexdigest()   # without the last separator
            begin = end + 1
            lo, hi = int(cut[k]), int(cut[k + 1])
            out[at] = (int(a_n[k]), int(b_n[k]), int(groups[k]), int(links[k]), sha,
                       pairs[lo:hi].tobytes(), times[lo:hi].tobytes())
    return out


_DOCS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                   ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                   ("pairs", pa.binary()), ("times", pa.binary())])
_DOCS_DDL = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
             " pairs binary, times binary")


def aligned(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Group and link counts of each document, with its distinct id pairs (A id * 65536 + B id, little-endian) and
    how often each is linked; ``row`` is its own for each row."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text"))

    def task(batches):
        two = tokenizers(a_path, b_path)
        for batch in batches:
            for part in scan.slices(batch, limit=SLICE):
                got = list(zip(*_slice(scan.payloads(part.column(2)), two)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(c, f.type) for c, f in zip(got, list(_DOCS)[2:]))],
                    schema=_DOCS)

    return rows.mapInArrow(task, _DOCS_DDL)


def _joined(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column end to end, and how many each row has."""
    raw = col.to_pylist()
    return np.frombuffer(b"".join(raw), "<u4"), np.array([len(r) // 4 for r in raw], np.int64)


def pair_counts(staged: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked; whether no other pair of its A id is in more."""
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def task(batches):
        held, size = [], 0

        def merged():
            pair, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return pair, np.bincount(at, np.concatenate([h[1] for h in held]), len(pair)).astype(np.int64)

        for batch in batches:
            pair, n = np.unique(_joined(batch.column(0))[0], return_counts=True)
            held.append((pair, n))
            size += len(pair)
            if size > PAIRS_HELD:
                held = [merged()]
                size = len(held[0][0])
                if 2 * size > PAIRS_HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in held[0]], schema=schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in merged()], schema=schema)

    counts = stage_table(staged.select("pairs").mapInArrow(task, "pair long, n long")
                         .groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    best = counts.groupBy(F.shiftright("pair", 16).alias("a")).agg(F.max("n").alias("top"))   # a row for each A id
    return (counts.withColumn("a", F.shiftright("pair", 16)).join(best, "a")
            .select("pair", "n", (F.col("n") == F.col("top")).alias("best")))


def _known_from(counts: DataFrame, most: int) -> int:
    """The least power of two such that at most ``most`` pairs are in that many documents (1: all are known)."""
    sizes = {r.b: r.n for r in counts.groupBy(F.length(F.bin("n")).alias("b")).agg(F.count("*").alias("n")).collect()}
    total, bits = 0, max(sizes, default=0) + 1   # at most 64 rows
    while bits > 1 and total + sizes.get(bits - 1, 0) <= most:
        bits -= 1
        total += sizes.get(bits, 0)
    return 1 << (bits - 1)


_SUMS = pa.schema([*list(_DOCS)[:7], pa.field("n_best", pa.int64()), pa.field("count_sum", pa.int64())])
_SUMS_DDL = _DOCS_DDL.split(", pairs")[0] + ", n_best long, count_sum long"


def report(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
           known_pairs: int = KNOWN_PAIRS) -> DataFrame:
    """Per document: tokens, groups, links, links on their A id's best pair, sum of the links' pair counts."""
    staged = stage_table(aligned(docs, a_path, b_path, doc_id, text), "aligned")
    counts = stage_table(pair_counts(staged), "pair-counts")
    least = _known_from(counts, known_pairs)
    top = counts.filter(F.col("n") >= least).toArrow()   # at most known_pairs rows
    pair, n, best = (top.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    sent = docs.sparkSession.sparkContext.broadcast(
        (pair[order].astype(np.uint32), n[order].astype(np.int64), best[order].astype(bool)))

    def look_up(codes):
        keys, n, best = sent.value
        if not len(keys):
            return np.zeros(len(codes), bool), np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
        at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
        hit = keys[at] == codes
        return hit, np.where(hit, n[at], 0), hit & best[at]

    def sums(batches):
        for batch in batches:
            codes, size = _joined(batch.column(7))
            times, _ = _joined(batch.column(8))
            _, n, best = look_up(codes)
            ends = np.concatenate([[0], np.cumsum(size)])
            per = [np.concatenate([[0], np.cumsum(times * v)]) for v in (best, n)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], *(pa.array((p[ends[1:]] - p[ends[:-1]]).astype(np.int64)) for p in per)],
                schema=_SUMS)

    done = staged.mapInArrow(sums, _SUMS_DDL)
    if least > 1:   # pairs in fewer documents: a join whose keys are all rare
        rare = pa.schema([("row", pa.int64()), ("pair", pa.int64()), ("times", pa.int64())])

        def others(batches):
            for batch in batches:
                codes, size = _joined(batch.column(1))
                times, _ = _joined(batch.column(2))
                left = ~look_up(codes)[0]
                row = np.repeat(batch.column(0).to_numpy(), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[left].astype(np.int64)) for c in (row, codes, times)], schema=rare)

        more = (staged.select("row", "pairs", "times").mapInArrow(others, "row long, pair long, times long")
                .join(counts.filter(F.col("n") < least), "pair").groupBy("row")
                .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                     F.sum(F.col("times") * F.col("n")).alias("more_sum")))
        done = done.join(more, "row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
