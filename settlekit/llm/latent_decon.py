"""Benchmark decontamination by latent semantic retrieval.

The benchmark is taken in blocks of ``BLOCK_WORDS`` words of items (2048 items at most),
all texts of an item_id. For each block the corpus is scanned once:

1. The places of the items' words in each document are staged; everything after
   works on these, no text is read again. Document frequencies come from them, too.
2. Passages are windows of words, half overlapping, as wide as the power of two that
   holds an item (32 at least), so items of different lengths have passages of their
   own width. All passages of all documents are rows of a TF-IDF matrix over the
   items' words (idf at most 1.5 times the median, so a paraphrase that replaces the
   rarest words stays near; words of more than a quarter of the documents weigh
   nothing where the item has other words).
3. A randomised SVD is fitted on the passages (``FIT_WINDOW`` words) of all documents and
   the items: tasks add up A'A (of more than ``GRAM_WORDS`` words: its product with a thin
   matrix), Spark sums their rows, the driver orthonormalises the products with a thin
   matrix (words of the block x rank numbers).
4. Every passage is projected; where its cosine to an item of its width reaches
   ``COSINE`` in the latent space it is a candidate. Only these are checked: the longest
   common subsequence of the item and the passage's span (half a window more on either
   side) must hold ``STRONG`` of the item's words, or ``ANSWER`` of the answer (the item's
   last sentence) must be there in order together with ``WEAK`` of the item's words, or
   with ``PARAPHRASE`` of its words and of their weight at a cosine of ``CLOSE``.

Words are ASCII-lower-cased and stripped of ASCII punctuation at their ends.
All matches above the thresholds are kept.

Defined results: null and empty texts match nothing, nor do items without
words; rows that repeat a doc_id or an item_id are one document or item in the
answer; a null doc_id can't be reported and is left out (``clean`` keeps the row);
empty tables give an empty result. Extra columns are ignored or kept as they are.
Very long documents are cut into overlapping stretches, which count as documents of
their own in the frequencies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm import scan, tokens
from settlekit.llm.folds import fresh
from settlekit.operators.joins import join_small_side
from settlekit.session import drop_tables, stage_table

BLOCK_ITEMS = 2048
BLOCK_WORDS = 60_000     # words of the items that are searched for together
STRETCH = 1 << 16        # words of a document in one row
NARROW = 32              # narrowest window
FIT_WINDOW, FIT_TASKS = 64, 6
DENSE = 32               # passages that are multiplied at once
GRAM_WORDS = 8_192       # words of a block whose products of pairs a task holds: 270 MB
FREQUENT = 128           # of them multiplied densely
RANK = 192
COSINE = 0.5
CLOSE = 0.5
STRONG = 0.75
WEAK = 0.6
PARAPHRASE = 0.4
ANSWER = 0.8
CHUNKS = 1 << 14         # half windows projected at once
ENTRIES = 4096           # of a sparse matrix, or rows of a thin one, that the driver works on at once
MATCHES = "doc_id long, item_id long, cosine double, lcs double, answer double"
SMALL_ROWS = 1_000_000   # (long) rows that may be broadcast: 8 MB


def words_of(text: str) -> list[bytes]:
    j = scan.join([text.encode()], lower=True)
    start, end, _ = scan.bare_words(j)
    raw = j.buf.tobytes()
    return [raw[a:b] for a, b in zip(start, end)]


def hashes(words: list[bytes]) -> np.ndarray:
    j = scan.join([b" ".join(words)])
    start, end, _ = scan.words(j)
    return scan.span_hash(scan.prefix_hash(j.buf), start, end)


@dataclass
class Item:
    item_id: int
    words: list[bytes]
    answer: list[bytes]


def items_of(rows: list[tuple]) -> list[Item]:
    out = []
    for item_id, text in rows:
        words = words_of(text or "")
        if words:
            parts = [w for w in map(words_of, (text or "").replace("\n", ". ").split(". ")) if w]
            out.append(Item(item_id, words, parts[-1] if parts else words))
    return out


def common(item: list[bytes], span: list[bytes]) -> int:
    """Length of the longest common subsequence (bit-parallel over the item's words)."""
    masks: dict[bytes, int] = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    v = full
    for w in span:
        u = v & masks.get(w, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


class Vocabulary:
    """Sorted word hashes with a small table that rejects most other words."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.kind = "<u2" if len(self.keys) < 1 << 16 else "<u4"   # how numbers of words are stored
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of h are in the vocabulary, their numbers)."""
        at = np.flatnonzero(self.maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
        if not len(self.keys):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        hit = self.keys[k] == h[at]
        return at[hit], k[hit]


def occurrences(docs: DataFrame, vocabulary: Vocabulary, widest: int) -> DataFrame:
    """doc_id, words (numbers, little-endian), places (number among the document's words): the vocabulary's words.

    A row for each stretch of a document that holds any; stretches overlap by two
    of the widest windows, so every span lies in one.
    """
    kind, length, more = vocabulary.kind, max(STRETCH, 4 * widest), 2 * widest
    schema = pa.schema([("doc_id", pa.int64()), ("words", pa.binary()), ("places", pa.binary())])

    def run(batches):
        for batch in batches:
            for part in scan.slices(batch):
                j = scan.join(scan.payloads(part.column(1)), lower=True)
                start, end, doc = scan.bare_words(j)
                at, word = vocabulary.find(scan.span_hash(scan.prefix_hash(j.buf), start, end))
                count = np.bincount(doc, minlength=j.docs)
                place = at - (np.cumsum(count) - count)[doc[at]]
                cut = np.searchsorted(doc[at], np.arange(j.docs + 1))
                rows, owner = [], []
                for d in np.flatnonzero(np.diff(cut)).tolist():
                    w, p = word[cut[d]:cut[d + 1]].astype(kind), place[cut[d]:cut[d + 1]]
                    for first in range(0, int(p[-1]) + 1, length):
                        lo, hi = np.searchsorted(p, (first, first + length + more)) if p[-1] >= length else (0, len(p))
                        if hi > lo:
                            rows.append((w[lo:hi].tobytes(), (p[lo:hi] - first).astype("<u4").tobytes()))
                            owner.append(d)
                ids = part.column(0).take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1))],
                                                 schema=schema)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    return src.mapInArrow(run, "doc_id long, words binary, places binary")


def _numbers(col: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column end to end, and how many each row has."""
    raw = col.to_pylist()
    size = np.dtype(kind).itemsize
    return (np.frombuffer(b"".join(raw), kind).astype(np.int64),
            np.fromiter((len(r) // size for r in raw), np.int64, len(raw)))


def frequencies(staged: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Rows (documents) that hold each word."""
    schema = pa.schema([("word", pa.int32()), ("n", pa.int64())])
    size, kind = len(vocabulary.keys), vocabulary.kind

    def run(batches):
        count = np.zeros(size, np.int64)
        for batch in batches:
            word, n = _numbers(batch.column(0), kind)
            pair = np.unique(np.repeat(np.arange(len(n)), n) * size + word)
            count += np.bincount(pair % max(size, 1), minlength=size)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some], pa.int64())], schema=schema)

    df = np.zeros(size, np.int64)
    for word, n in staged.select("words").mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n")).collect():
        df[word] = n      # at most a row for each word of the block
    return df


def weights_of(df: np.ndarray, total: int, numbers: list[np.ndarray]) -> np.ndarray:
    """Weight of each word: its idf, at most 1.5 times the median; 0 for words that don't occur, or that are in more than
    a quarter of the documents and that no item depends on."""
    idf = np.where(df > 0, np.log((total + 1) / (df + 0.5)).clip(0.01), 0.0)
    said = np.concatenate([np.zeros(0, np.int64), *numbers])
    known = idf[said][idf[said] > 0]
    if len(known):
        idf = np.minimum(idf, 1.5 * np.median(known))
    out = np.where(4 * df > total, 0.0, idf)
    for words in numbers:
        if (out[words] > 0).sum() < max(8, len(words) // 2):
            out[words] = idf[words]
    return out


def _passages(word: np.ndarray, place: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First occurrence and number of occurrences of each passage that the SVD is fitted on, of rows with n places each."""
    step = FIT_WINDOW // 2
    if not len(word):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    halves = place[np.cumsum(n) - 1] // step + 1
    ends = np.cumsum(halves)
    row = np.repeat(np.arange(len(n)), n)
    held = np.bincount((ends - halves)[row] + place // step, minlength=int(ends[-1]))
    first = np.cumsum(held) - held
    size = held.copy()
    size[:-1] += held[1:]
    size[ends - 1] = held[ends - 1]      # the last one of a row ends with it
    some = np.flatnonzero(size)
    return first[some], size[some]


def _fit_batches(batch: pa.RecordBatch, kind: str | None, most: int = 1024):
    """(row of each word, word, rows) of some passages at a time; without ``kind`` the rows are passages of int32 numbers."""
    if kind is None:
        word, size = _numbers(batch.column(0), "<i4")
        first = np.cumsum(size) - size
    else:
        word, n = _numbers(batch.column(0), kind)
        first, size = _passages(word, _numbers(batch.column(1), "<u4")[0], n)
    for at in range(0, len(size), most):
        f, k = first[at:at + most], size[at:at + most]
        yield np.repeat(np.arange(len(k)), k), word[tokens.ragged(f, k)], len(k)


def passage_count(staged: DataFrame) -> int:
    """Passages that the SVD is fitted on."""
    schema = pa.schema([("n", pa.int64())])

    def run(batches):
        n = 0
        for batch in batches:
            place, size = _numbers(batch.column(0), "<u4")
            n += len(_passages(place, place, size)[0])
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], schema=schema)

    return staged.select("places").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def _weights(words: list[bytes], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF rows as (row, column, value) triples."""
    rows = np.repeat(np.arange(len(words)), [len(w) // 4 for w in words])
    return _unit_rows(rows, np.frombuffer(b"".join(words), "<i4").astype(np.int64), len(words), idf)


def _unit_rows(rows: np.ndarray, cols: np.ndarray, n: int, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pair, tf = np.unique(rows * len(idf) + cols, return_counts=True)
    rows, cols = pair // len(idf), pair % len(idf)
    value = (1 + np.log(tf)) * idf[cols]
    norm = np.sqrt(np.bincount(rows, value * value, minlength=n))
    return rows, cols, value / np.maximum(norm, 1e-12)[rows]


def _rows_times(triples, n: int, m: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """A @ m for the sparse rows, some entries at a time; added to ``out`` where it is given."""
    out = np.zeros((n, m.shape[1]), np.float64) if out is None else out
    for at in range(0, len(triples[0]), ENTRIES):
        rows, cols, value = (x[at:at + ENTRIES] for x in triples)
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        out[rows[first]] += np.add.reduceat(value[:, None] * m[cols], first)
    return out


def _transposed(triples) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, cols, value = triples
    by = np.argsort(cols, kind="stable")
    return cols[by], rows[by], value[by]


def orthonormal(m: np.ndarray) -> np.ndarray:
    """Orthonormal columns of the same span in place of ``m``: QR of some rows at a time, then of their R."""
    upper, held = [], 0
    for at in range(0, len(m), ENTRIES):
        q, r = np.linalg.qr(m[at:at + ENTRIES])
        m[at:at + ENTRIES, :q.shape[1]] = q
        upper.append(r)
    last = np.linalg.qr(np.concatenate(upper))[0] if len(m) else m
    for k, r in enumerate(upper):
        own = m[k * ENTRIES:(k + 1) * ENTRIES]
        own[:] = own[:, :len(r)] @ last[held:held + len(r)]
        held += len(r)
    return m


def gram_times(rows: DataFrame, idf: np.ndarray, m: np.ndarray, kind: str | None = None) -> np.ndarray:
    """A'A @ m over all rows: partial products per task (in float32, added up in float64), summed word by word.

    The rows are passages (``words``), or with ``kind`` staged occurrences, cut into passages in the tasks.
    """
    schema = pa.schema([("word", pa.int32()), ("v", pa.binary())])
    thin, shape = np.ascontiguousarray(m, np.float32), m.shape

    def partial(batches):
        acc, number = np.zeros(shape), np.zeros(len(idf), np.int64)
        for batch in batches:
            for row, word, n in _fit_batches(batch, kind):
                row, col, value = _unit_rows(row, word, n, idf)
                cut = np.searchsorted(row, np.arange(0, n + DENSE, DENSE))
                for k, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])):   # a few passages are dense in their own words
                    own = np.unique(col[lo:hi])
                    number[own] = np.arange(len(own))
                    a = np.zeros((DENSE, len(own)), np.float32)
                    a[row[lo:hi] - k * DENSE, number[col[lo:hi]]] = value[lo:hi]
                    acc[own] += a.T @ (a @ thin[own])
        some = np.flatnonzero(acc.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()),
                                          pa.array([acc[k].tobytes() for k in some], pa.binary())], schema=schema)

    read = rows.select("words") if kind is None else few_tasks(rows.select("words", "places"))
    return _sum_words(read.mapInArrow(partial, "word int, v binary"), m)


def _sum_words(parts: DataFrame, like: np.ndarray) -> np.ndarray:
    """A row of numbers for each word, added up from the tasks' rows (word, v)."""
    def summed(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(v) for v in table.column("v").to_pylist()], axis=0)
        return pa.table({"word": table.column("word").slice(0, 1), "v": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(like.shape)
    for word, v in (parts.groupBy("word").applyInArrow(summed, "word int, v binary")
                    .coalesce(FIT_TASKS).toLocalIterator()):
        out[word] = np.frombuffer(bytes(v))
    return out


def gram(staged: DataFrame, idf: np.ndarray, kind: str) -> DataFrame:
    """word, v: row ``word`` of A'A over all passages of the occurrences, up to its diagonal (float64).

    Words are numbered by rising weight. Tasks add up the half below the diagonal: the most frequent
    words by a dense product, pairs with a rarer word one by one.
    """
    size = len(idf)
    order = _by_weight(idf)
    rank = np.argsort(order)
    weight, top = idf[order], min(FREQUENT, size)
    base = np.arange(size) * (np.arange(size) + 1) // 2
    schema = pa.schema([("word", pa.int32()), ("cols", pa.binary()), ("v", pa.binary())])

    def partial(batches):
        below, dense = np.zeros(size * (size + 1) // 2), np.zeros((top, top))
        for batch in batches:
            for row, word, n in _fit_batches(batch, kind):
                some = idf[word] > 0
                row, col, value = _unit_rows(row[some], rank[word[some]], n, weight)
                often = col < top
                a = np.zeros((n, top), np.float32)
                a[row[often], col[often]] = value[often]
                dense += a.T @ a
                # words ascend within a passage: a rarer word meets itself and those before it
                held = np.bincount(row, minlength=n)
                rare = np.flatnonzero(~often)
                first = (np.cumsum(held) - held)[row[rare]]
                met = rare - first + 1
                other = tokens.ragged(first, met)
                np.add.at(below, np.repeat(base[col[rare]], met) + col[other], np.repeat(value[rare], met) * value[other])
        for k in range(top):
            below[base[k]:base[k] + k + 1] += dense[k, :k + 1]
        words, cols, v = [], [], []
        for k in range(size):
            own = below[base[k]:base[k] + k + 1]
            at = np.flatnonzero(own)
            if len(at):
                words.append(k)
                cols.append(at.astype("<u2").tobytes())
                v.append(own[at].astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.int32()), pa.array(cols, pa.binary()), pa.array(v, pa.binary())],
                                         schema=schema)

    def summed(table: pa.Table) -> pa.Table:
        word = table.column("word")[0].as_py()
        out = np.zeros(word + 1)
        for cols, v in zip(table.column("cols").to_pylist(), table.column("v").to_pylist()):
            out[np.frombuffer(cols, "<u2")] += np.frombuffer(v, "<f4")
        return pa.table({"word": table.column("word").slice(0, 1), "v": pa.array([out.tobytes()], pa.binary())})

    parts = few_tasks(staged.select("words", "places")).mapInArrow(partial, "word int, cols binary, v binary")
    return stage_table(parts.groupBy("word").applyInArrow(summed, "word int, v binary").coalesce(FIT_TASKS), "decon-gram")


def _by_weight(idf: np.ndarray) -> np.ndarray:
    """Words by rising weight, those without weight at the end."""
    return np.argsort(np.where(idf > 0, idf, np.inf), kind="stable")


def products(table: DataFrame, idf: np.ndarray, m: np.ndarray, most: int = 256) -> np.ndarray:
    """A'A @ m from the rows of ``gram``."""
    order = _by_weight(idf)
    own = m[order]
    schema = pa.schema([("word", pa.int32()), ("v", pa.binary())])

    def partial(batches):
        acc = np.zeros(own.shape)
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                words, rows = (batch.column(k).slice(at, most).to_pylist() for k in (0, 1))
                a = np.zeros((len(words), len(own)))
                for k, v in enumerate(rows):
                    a[k, :words[k] + 1] = np.frombuffer(v)
                acc[words] += a @ own
                a[np.arange(len(words)), words] = 0.0
                acc += a.T @ own[words]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(acc)), pa.int32()),
                                          pa.array([v.tobytes() for v in acc], pa.binary())], schema=schema)

    out = np.empty(m.shape)
    out[order] = _sum_words(table.select("word", "v").mapInArrow(partial, "word int, v binary"), m)
    return out


def few_tasks(rows: DataFrame) -> DataFrame:
    """In fewer, longer tasks: each one returns a product of the block's words."""
    return rows.coalesce(max(2 * rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions() // 16))


def latent_basis(rows: DataFrame, item_words: list[bytes], idf: np.ndarray, rank: int = RANK, power: int = 1,
                 seed: int = 5, kind: str | None = None) -> np.ndarray:
    """Orthonormal columns that span the leading right singular vectors of A (randomised range finder).

    A: the items and ``rows``, as ``gram_times`` takes them. Staged occurrences are read once for A'A where
    it has at most ``GRAM_WORDS`` words, else for each product.
    """
    table = gram(rows, idf, kind) if kind is not None and len(idf) <= GRAM_WORDS else None
    weight = max(1, rows.count() if kind is None else passage_count(rows))
    v, n = len(idf), len(item_words)
    own = _weights(item_words, idf)
    word, item, value = _transposed(own)
    back = word, item, weight * value

    def times(m):
        fitted = gram_times(rows, idf, m, kind) if table is None else products(table, idf, m)
        return _rows_times(back, v, _rows_times(own, n, m), fitted)

    thin = min(v, rank + 8)
    q = orthonormal(np.random.default_rng(seed).standard_normal((v, thin)))
    for _ in range(power + 1):
        q = orthonormal(times(q))
    inner = q.T @ times(q)
    drop_tables(*([] if table is None else [table]))
    value, vector = np.linalg.eigh(inner)
    lead = np.argsort(-value)[:rank]
    return q @ vector[:, lead[value[lead] > 1e-12 * max(value.max(), 1e-30)]]


class Query:
    """An item as the check needs it: masks of its words and of its answer's words by number."""

    def __init__(self, item: Item, number: dict[bytes, int], weight: np.ndarray):
        self.item_id, self.size, self.answer_size = item.item_id, len(item.words), len(item.answer)
        self.words = self._masks(item.words, number)
        self.answer = self._masks(item.answer, number)
        self.count = {w: m.bit_count() for w, m in self.words.items()}
        self.weight = {w: float(weight[w]) * n for w, n in self.count.items()}
        self.total = sum(self.weight.values())

    @staticmethod
    def _masks(words: list[bytes], number: dict[bytes, int]) -> dict[int, int]:
        out: dict[int, int] = {}
        for k, w in enumerate(words):
            if w in number:
                out[number[w]] = out.get(number[w], 0) | 1 << k
        return out

    def check(self, span: list[int], said: set[int], cosine: float) -> tuple[float, float] | None:
        """Shares of the item and of its answer that the span (``said``: its words) holds in order, if they make a match."""
        held = self.count.keys() & said
        if sum(map(self.count.__getitem__, held)) < PARAPHRASE * self.size:
            return None                       # the subsequence is no longer than that
        share = _in_order(self.words, self.size, span) / self.size
        if share < PARAPHRASE:
            return None
        answer = _in_order(self.answer, self.answer_size, span) / self.answer_size
        close = cosine >= CLOSE and sum(map(self.weight.__getitem__, held)) >= PARAPHRASE * self.total
        least = PARAPHRASE if close else WEAK
        return (share, answer) if share >= STRONG or (answer >= ANSWER and share >= least) else None


def _in_order(masks: dict[int, int], size: int, span) -> int:
    """Length of the longest common subsequence (bit-parallel over the item's words)."""
    full = (1 << size) - 1
    v = full
    for w in span:
        m = masks.get(w)
        if m:
            u = v & m
            if u:
                v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def width_of(item: Item) -> int:
    return max(NARROW, 1 << (len(item.words) - 1).bit_length())


def _matches(staged: DataFrame, queries: list[Query], widths: list[int], item_words: list[bytes], weight: np.ndarray,
             basis: np.ndarray, kind: str) -> DataFrame:
    """The candidates of all passages, checked."""
    wanted = _rows_times(_weights(item_words, weight), len(queries), basis)
    wanted = (wanted / np.maximum(np.linalg.norm(wanted, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    classes = {x: np.flatnonzero(np.array(widths) == x) for x in sorted(set(widths))}
    chunk, most = min(classes) // 2, max(classes) // min(classes)
    projected = np.multiply(weight[:, None], basis, out=np.empty(basis.shape, np.float32), casting="same_kind")
    buffer = np.empty((1024, basis.shape[1]), np.float32)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()),
                        ("lcs", pa.float64()), ("answer", pa.float64())])

    def group(ids, word, place, n, out):
        """Some rows: half windows of the narrowest width are summed once, wider windows from these."""
        row = np.repeat(np.arange(len(n)), n)
        ends = np.cumsum(n)
        halves = -(-(place[ends - 1] // chunk + 1) // most) * most
        base = np.cumsum(halves) - halves
        # half windows by falling number of words with a weight: their k-th words are one gather for the first of them
        some = weight[word] > 0
        half = base[row[some]] + place[some] // chunk
        held = np.bincount(half, minlength=int(halves.sum()))
        by = np.argsort(-held, kind="stable")
        at = np.empty_like(by)
        at[by] = np.arange(len(by))
        nth = np.arange(len(half)) - (np.cumsum(held) - held)[half]
        slots = np.zeros((chunk, len(held)), np.int64)
        slots[nth, at[half]] = word[some]
        narrow = np.zeros((len(held), projected.shape[1]), np.float32)
        for lo in range(0, len(held), len(buffer)):
            own, hi = narrow[lo:lo + len(buffer)], lo + len(buffer)
            for k in range(int(held[by[lo]])):
                more = int((held[by[lo:hi]] > k).sum())
                own[:more] += np.take(projected, slots[k, lo:lo + more], 0, buffer[:more], "clip")
        narrow = narrow[at]
        for width, items in classes.items():
            m = width // 2 // chunk
            part = narrow if m == 1 else narrow.reshape(-1, m, narrow.shape[1]).sum(1)
            owner = np.repeat(np.arange(len(n)), halves // m)
            passage = part.copy()
            passage[:-1] += part[1:]
            end = np.cumsum(halves // m) - 1
            passage[end] = part[end]
            norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", passage, passage)), 1e-9)
            cosine = passage @ wanted[items].T      # times the norm
            hit, which = np.divmod(np.flatnonzero(cosine >= (COSINE * norm)[:, None]), len(items))
            last, span, said = -1, [], set()
            for p, k in zip(hit.tolist(), which.tolist()):
                r = owner[p]
                if p != last:
                    begin = (p - base[r] // m - 1) * (width // 2)
                    lo, hi = np.searchsorted(place[ends[r] - n[r]:ends[r]], (begin, begin + 2 * width)) + ends[r] - n[r]
                    span, last = word[lo:hi].tolist(), p
                    said = set(span)
                query, near = queries[items[k]], float(cosine[p, k] / norm[p])
                got = query.check(span, said, near)
                if got is not None:
                    out.append((ids[r], query.item_id, near, *got))

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            word, n = _numbers(batch.column(1), kind)
            place, _ = _numbers(batch.column(2), "<u4")
            ends = np.cumsum(n)
            size = np.cumsum(place[ends - 1] // chunk + 1 + most)
            out, done = [], 0
            while done < len(n):
                before = size[done - 1] if done else 0
                stop = max(done + 1, int(np.searchsorted(size, before + CHUNKS, "right")))
                lo, hi = ends[done] - n[done], ends[stop - 1]
                group(ids[done:stop], word[lo:hi], place[lo:hi], n[done:stop], out)
                done = stop
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return staged.mapInArrow(run, MATCHES)


def find(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, cosine, lcs, answer of every contaminated pair (the best passage's values)."""
    spark = docs.sparkSession
    bench = (benchmark.filter("item_id is not null and text is not null")
             .select(F.col("item_id").cast("long").alias("item_id"), "text").distinct())
    out = spark.createDataFrame([], MATCHES)
    last = None
    while True:  # blocks of items in order: the driver holds one block
        rows = bench if last is None else bench.filter(
            (F.col("item_id") > last[0]) | ((F.col("item_id") == last[0]) & (F.col("text") > last[1])))
        block = [tuple(r) for r in rows.orderBy("item_id", "text").limit(block_items).collect()]
        if not block:
            break
        last = block[-1]
        for items in by_words(items_of(block)):
            out = out.unionByName(stage_table(_find_block(docs, items), "decon"))
    return out.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs"),
                                                F.max("answer").alias("answer"))


def by_words(items: list[Item]) -> list[list[Item]]:
    """The items in blocks of ``BLOCK_WORDS`` words together, or of one item."""
    out: list[list[Item]] = []
    size = 0
    for i in items:
        if not out or size + len(i.words) > BLOCK_WORDS:
            out.append([])
            size = 0
        out[-1].append(i)
        size += len(i.words)
    return out


def _find_block(docs: DataFrame, items: list[Item]) -> DataFrame:
    empty = docs.sparkSession.createDataFrame([], MATCHES)
    hashed = [hashes(i.words) for i in items]
    vocabulary = Vocabulary(np.concatenate(hashed))
    widths = [width_of(i) for i in items]
    staged = stage_table(occurrences(docs, vocabulary, max(widths)), "decon-words")
    total = docs.filter("doc_id is not null").count()
    if not total:
        return empty
    numbers = [vocabulary.find(h)[1] for h in hashed]
    weight = weights_of(frequencies(staged, vocabulary), total, numbers)
    if not weight.any():
        return empty
    item_words = [n.astype("<i4").tobytes() for n in numbers]
    basis = latent_basis(staged, item_words, weight, kind=vocabulary.kind)
    number = {w: int(k) for i, n in zip(items, numbers) for w, k in zip(i.words, n)}
    return _matches(staged, [Query(i, number, weight) for i in items], widths, item_words, weight, basis, vocabulary.kind)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept."""
    (bad_id,) = fresh(docs, "_bad_id")
    bad = find(docs, benchmark).select(F.col("doc_id").alias(bad_id)).distinct()
    return join_small_side(docs, stage_table(bad, "decon-docs"), F.col("doc_id") == F.col(bad_id), "left_anti",
                           max_rows=SMALL_ROWS)
