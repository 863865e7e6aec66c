"""N-gram Jaccard join by parity sketches.

A document's set holds the distinct hashes of its k-word shingles. For a size
band, the set is XOR-hashed into a sketch of m segments: every shingle XORs its
64 bits into one segment, so one shingle more or less changes one segment and
the number of differing segments (a Hamming distance) never exceeds the
symmetric difference of two sets. Sets with Jaccard p/q or more differ in
D = (q - p) / (q + p) * (|A| + |B|) shingles at most; with m = D + 1 + w segments
at least w + 1 are equal, and documents that share a segment (its place, bits and
number of shingles) meet in a bucket: the pigeonhole join. Segments with no or
few shingles say little and are left out unless a sketch has more than w of
them; then all of its segments are emitted, so no link is lost. As linked sets
share T = w + 1 - (left out) keys at least, each set leaves out its T - 1 keys
with the largest buckets: of the keys that two linked sets share, the one with
the smallest bucket is still kept by both (prefix filtering). Passages that many
documents share make large buckets and go this way.

Bands are geometric. Sets of one band meet under the band's own label, sets of
adjacent bands under a label between them; the band ratio exceeds q/p, so
linked sets are never further apart.

Copies: documents with equal sets (count and 128-bit fingerprint) are one class
and never paired. Buckets never emit all pairs: in each star round the members of a
bucket are paired with its hub only (another one each round); pairs that may be
links are verified on the exact sets and components are joined. When a star round
finds no link, or after ``STAR_ROUNDS``, the pairs that share a bucket and still lie in
different components are tried too, so the components are those of all links. The
hubs have been tried by then; the other members meet in blocks of bounded size, where
a task compares sizes and sketches of many pairs at a time.
Whether two classes may be linked is seen from their sizes and their bit sketches
(``BITS`` bits, one toggled per shingle): a Hamming distance beyond the symmetric
difference that a link allows rules it out. Sketches of 2048 bits tell sets of a
thousand shingles apart to a few shingles, so what passes is mostly linked, and
near copies just below the similarity leave the join where they meet. Larger sets
fill such a sketch, so their pairs are compared once more on a sketch of at least
``WIDE`` bits a shingle before the sets themselves are brought together. Tables of a
finished round are dropped.

Defined results: null and empty texts, and texts without words, have an empty
set and link with nothing. A null doc_id gets n_shingles and a null component
and links nothing. Rows that repeat a doc_id count as one document (linked with
each other). An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from settlekit.llm import scan
from settlekit.llm.components import components
from settlekit.llm.folds import fresh
from settlekit.operators.joins import join_small_side
from settlekit.session import drop_tables, stage_table

STAR_ROUNDS = 4
WORDS = 32                 # 64-bit words of a bit sketch
QUICK_WORDS = 4            # of them compared first
BITS = 64 * WORDS
WIDE = 4                   # bits a shingle of a wide sketch, at least
BLOCK = 2048               # members of a bucket that meet in one block of the last round
TRIED = 1 << 17            # pairs of a block that are compared at a time
SPARE = 0.3                # spare segments for each one that the pigeonhole needs: more keys, smaller buckets
SMALL_ROWS = 1_000_000     # (long, long) rows that may be broadcast: 16 MB
SKETCH_ROWS = 100_000      # rows with a bit sketch that may be broadcast: 27 MB


@dataclass(frozen=True)
class Rule:
    """Words per shingle and the least Jaccard similarity p/q of a link."""

    k: int = 4
    p: int = 85
    q: int = 100

    def linked(self, both: int, a: int, b: int) -> bool:
        return self.q * both >= self.p * (a + b - both)


class Bands:
    """Sketch shapes: label 2b for band b, 2b + 1 between bands b and b + 1."""

    def __init__(self, rule: Rule, most: int = 1 << 40):
        ratio = max(1.5, rule.q / rule.p * 1.05)
        low = [1, 8]
        while low[-1] <= most:
            low.append(max(low[-1] + 1, math.ceil(low[-1] * ratio)))
        self.low = np.array(low, np.int64)
        self.rule = rule
        shape = []
        for b in range(len(low) - 1):
            top = low[b + 1] - 1
            for larger in (top, top * rule.q // rule.p):
                d = (rule.q - rule.p) * (top + larger) // (rule.q + rule.p)
                spare = 2 if d < 8 else 2 + math.ceil(SPARE * (d + 1))
                shape.append((d + 1 + spare if d else 0, spare, 0 if d < 8 else 1))
        # segments, spare segments, shingles up to which a segment is weak; d = 0 links equal sets alone
        self.segments, self.spare, self.weak = (np.array(x, np.int64) for x in zip(*shape))

    def labels(self, n: np.ndarray) -> list[np.ndarray]:
        """Up to three labels of each set size; -1 for none."""
        b = np.searchsorted(self.low, n, "right") - 1
        p, q = self.rule.p, self.rule.q
        up = n * q // p >= self.low[np.minimum(b + 1, len(self.low) - 1)]
        down = (b > 0) & (n * p <= (self.low[b] - 1) * q)
        out = [np.where(n > 0, 2 * b, -1), np.where((n > 0) & up, 2 * b + 1, -1), np.where(down, 2 * b - 1, -1)]
        return [np.where((x >= 0) & (self.segments[np.maximum(x, 0)] > 0), x, -1) for x in out]


def sets_of(texts: list[bytes], rule: Rule) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct shingle hashes and their document, ordered by document and hash."""
    j = scan.join(texts, lower=True)
    start, end, doc = scan.words(j)
    h = scan.span_hash(scan.prefix_hash(j.buf), start, end)
    h, doc = scan.shingles(h, doc, j.docs, rule.k)
    h, doc, _ = scan.distinct(h, doc)
    return h, doc, j.docs


def fingerprints(h: np.ndarray, doc: np.ndarray, n_docs: int):
    """Set size and two 64-bit fingerprints of each document's set."""
    n = np.bincount(doc, minlength=n_docs)
    one, two = np.zeros(n_docs, np.uint64), np.zeros(n_docs, np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        first = (np.cumsum(n) - n)[some]
        with np.errstate(over="ignore"):
            one[some] = np.add.reduceat(scan.mix(h), first)
            two[some] = np.bitwise_xor.reduceat(scan.mix(h * np.uint64(0xD6E8FEB86659FD93)), first)
    return n, one, two


def bit_sketches(h: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """int64 (documents, WORDS): each shingle toggles one bit, so two sketches differ in at most |A xor B| bits."""
    bit = (scan.mix(h ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(BITS)).astype(np.int64)
    odd = (np.bincount(doc * BITS + bit, minlength=n_docs * BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n_docs, BITS), axis=1, bitorder="little").view("<i8")


def wide_sketch(h: np.ndarray) -> bytes | None:
    """Like ``bit_sketches`` with at least ``WIDE`` bits a shingle, a power of two; None if that is no more than BITS.

    Halves combined by XOR are the sketch of half the bits, so sets of different sizes compare.
    """
    bits = BITS
    while bits < WIDE * len(h):
        bits *= 2
    if bits == BITS:
        return None
    bit = (scan.mix(h ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(bit, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def wide_apart(x: bytes, y: bytes) -> int:
    """Bits that two wide sketches differ in, after folding the longer one."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def block_pairs(node: np.ndarray, comp: np.ndarray, n: np.ndarray, bits: np.ndarray, side: np.ndarray | None,
                rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j) of a block's pairs of different components that sizes and bit sketches don't rule out.

    ``side`` tells the two parts of a block apart of which only the pairs across are asked for; None for all pairs.
    """
    by = np.argsort(n, kind="stable")  # a row's partners of linkable size are a range behind it
    n, comp, bits = n[by], comp[by], bits[by]
    side = None if side is None else side[by]
    many = np.searchsorted(n, n * rule.q // rule.p, "right") - np.arange(len(n)) - 1
    ends = np.cumsum(many)
    out, done = [np.zeros((2, 0), np.int64)], 0
    while done < len(n):
        base = ends[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(ends, base + TRIED, "right")))
        i = np.repeat(np.arange(done, stop), many[done:stop])
        j = np.arange(len(i)) - np.repeat(ends[done:stop] - many[done:stop] - base, many[done:stop]) + i + 1
        keep = comp[i] != comp[j]
        if side is not None:
            keep &= side[i] != side[j]
        i, j = i[keep], j[keep]
        apart = np.zeros(len(i), np.int64)
        for first, last in ((0, QUICK_WORDS), (QUICK_WORDS, 4 * QUICK_WORDS), (4 * QUICK_WORDS, WORDS)):
            for k in range(first, last):
                apart += np.bitwise_count(bits[i, k] ^ bits[j, k])
            keep = apart * (rule.q + rule.p) <= (n[i] + n[j]) * (rule.q - rule.p)
            i, j, apart = i[keep], j[keep], apart[keep]
        out.append(np.stack([by[i], by[j]]))
        done = stop
    i, j = np.concatenate(out, axis=1)
    return i, j


def sketch_keys(h: np.ndarray, doc: np.ndarray, n: np.ndarray, bands: Bands) -> tuple[np.ndarray, ...]:
    """(key, document, tag) of every segment that a document is joined on.

    The tag is label * 4096 + the least number of keys that the document shares
    with any one document it is linked with under that label: of the w + 1 equal
    segments, at most its own weak ones aren't emitted.
    """
    keys, owners, tags = [], [], []
    for label in bands.labels(n):
        m = np.where(label >= 0, bands.segments[np.maximum(label, 0)], 0)
        offset = np.cumsum(m) - m
        used = m[doc] > 0
        if not used.any():
            continue
        d = doc[used]
        with np.errstate(over="ignore"):
            salt = scan.mix(label.astype(np.uint64) + np.uint64(77))
            place = scan.mix(h[used] ^ salt[d]) >> np.uint64(32)
            slot = offset[d] + ((place * m[d].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            by = np.argsort(slot, kind="stable")
            slot = slot[by]
            first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
            bits = np.zeros(int(m.sum()), np.uint64)
            size = np.zeros(len(bits), np.int64)
            bits[slot[first]] = np.bitwise_xor.reduceat(scan.mix(h[used][by]), first)
            size[slot[first]] = np.diff(np.concatenate([first, [len(slot)]]))
            owner = np.repeat(np.arange(len(m)), m)
            lab = label[owner]
            weak = size <= bands.weak[lab]
            many = np.bincount(owner, weak, minlength=len(m)).astype(np.int64)
            spare = np.where(m > 0, bands.spare[np.maximum(label, 0)], 0)
            use = ~weak | (many > spare)[owner]
            need = np.where(many > spare, 1, np.minimum(spare + 1 - many, 4095))
            where = lab.astype(np.uint64) * np.uint64(1 << 32) + (np.arange(len(bits)) - offset[owner]).astype(np.uint64)
            key = scan.mix(bits ^ scan.mix(where) + size.astype(np.uint64))
        keys.append(key[use])
        owners.append(owner[use])
        tags.append((label * 4096 + need)[owner[use]])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(tags)


# -- Spark jobs ---------------------------------------------------------------


def _longs(*cols) -> list[pa.Array]:
    return [c if isinstance(c, pa.Array) else pa.array(np.ascontiguousarray(c).view(np.int64), pa.int64())
            for c in cols]


def set_table(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n, f1, f2: set size and fingerprint of every row."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n", "f1", "f2")])

    def run(batches):
        for batch in batches:
            for part in scan.slices(batch):
                h, doc, count = sets_of(scan.payloads(part.column(1)), rule)
                n, one, two = fingerprints(h, doc, count)
                yield pa.RecordBatch.from_arrays(_longs(part.column(0), n.astype(np.int64), one, two), schema=schema)

    return docs.mapInArrow(run, "doc_id long, n long, f1 long, f2 long")


def bucket_rows(docs: DataFrame, rule: Rule) -> DataFrame:
    """key, f1, tag: the segments that each document's set is joined on."""
    schema = pa.schema([("key", pa.int64()), ("f1", pa.int64()), ("tag", pa.int32())])

    def run(batches):
        bands = Bands(rule)
        for batch in batches:
            for part in scan.slices(batch):
                h, doc, count = sets_of(scan.payloads(part.column(1)), rule)
                n, one, _ = fingerprints(h, doc, count)
                copies = np.unique(one, return_index=True)[1]  # equal sets of a slice are one
                first = np.zeros(count, bool)
                first[copies] = True
                key, owner, tag = sketch_keys(h, doc, np.where(first, n, 0), bands)
                yield pa.RecordBatch.from_arrays([*_longs(key, one[owner]), pa.array(tag, pa.int32())], schema=schema)

    return docs.filter("doc_id is not null").mapInArrow(run, "key long, f1 long, tag int")


def set_rows(docs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """node, n, bit sketch s0 .., wide sketch (null for small sets) and hashes (sorted uint64) of the documents ``nodes``."""
    bits = [f"s{k}" for k in range(WORDS)]
    schema = pa.schema([*((c, pa.int64()) for c in ("node", "n", *bits)), ("wide", pa.binary()),
                        ("hashes", pa.binary())])

    def run(batches):
        for batch in batches:
            for part in scan.slices(batch):
                h, doc, count = sets_of(scan.payloads(part.column(1)), rule)
                ends = np.searchsorted(doc, np.arange(count + 1))
                wide = [wide_sketch(h[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                rows = [h[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                s = bit_sketches(h, doc, count)
                yield pa.RecordBatch.from_arrays([part.column(0), *_longs(np.diff(ends).astype(np.int64)), *_longs(*s.T),
                                                  pa.array(wide, pa.binary()), pa.array(rows, pa.binary())], schema=schema)

    wanted = join_small_side(docs, nodes.select(F.col("node").alias("doc_id")), "doc_id", max_rows=SMALL_ROWS)
    return wanted.select("doc_id", "text").mapInArrow(
        run, ", ".join(f"{c} long" for c in ("node", "n", *bits)) + ", wide binary, hashes binary")


def _sides(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """The pairs (a, b, ca, cb) with ``columns`` of both sides' sets: only the sets that a side needs are shuffled."""
    names = ["a", "b", "ca", "cb"]
    for side in ("a", "b"):
        needed = pairs.select(F.col(side).alias("node")).distinct()
        own = join_small_side(sets.select("node", *columns), needed, "node", max_rows=SMALL_ROWS)
        pairs = pairs.join(own.select(F.col("node").alias(side), *[F.col(c).alias(c + side) for c in columns]), side)
        names += [c + side for c in columns]
    return pairs.select(*names)


def _pair_filter(pairs: DataFrame, test) -> DataFrame:
    """The pairs (a, b, ca, cb) of the rows whose further values pass ``test``."""
    schema = pa.schema([(c, pa.int64()) for c in ("a", "b", "ca", "cb")])

    def run(batches):
        for batch in batches:
            keep = [test(*values) for values in zip(*batch.columns[4:])]
            yield pa.RecordBatch.from_arrays(batch.columns[:4], schema=schema).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(run, "a long, b long, ca long, cb long")


def nearer(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The rows of ``pairs`` (a, b, ca, cb) that the wide sketches don't rule out."""
    def test(na, x, nb, y):
        return not (x.is_valid and y.is_valid) or (wide_apart(x.as_buffer(), y.as_buffer()) * (rule.q + rule.p)
                                                   <= (na.as_py() + nb.as_py()) * (rule.q - rule.p))

    return _pair_filter(_sides(pairs, sets, "n", "wide"), test)


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The rows of ``pairs`` (a, b, ca, cb) whose exact sets are linked."""
    def test(x, y):
        u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
        both = 0
        if len(u) and len(v):
            at = np.minimum(np.searchsorted(v, u), len(v) - 1)
            both = int((v[at] == u).sum())
        return both > 0 and rule.linked(both, len(u), len(v))

    return _pair_filter(_sides(pairs, sets, "hashes"), test).distinct()


def bucket_pairs(members: DataFrame, sketches: DataFrame, turns: int, rule: Rule) -> DataFrame:
    """a, b, ca, cb of the pairs of ``members`` (key, node, component) that share a bucket, lie in different
    components and aren't ruled out, without those of the hubs of the star rounds 0 .. ``turns`` - 1.

    A bucket is dealt into parts of about ``BLOCK`` members by a hash of the node; a block holds one
    part or two, so a bucket of any size is many bounded blocks.
    """
    hubs = members.groupBy("key").agg(F.array_distinct(F.array(*[_hub(t)["hub"] for t in range(turns)])).alias("hubs"),
                                      F.count("*").alias("size"))
    left = (members.join(hubs.filter(F.col("size") > F.size("hubs") + 1), "key")
            .filter(~F.array_contains("hubs", F.col("node"))))
    parts = F.ceil((F.col("size") - F.size("hubs")) / BLOCK).cast("int")
    dealt = left.select("key", "node", "component", parts.alias("parts")).withColumn(
        "part", F.pmod(F.xxhash64("node"), "parts").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    bits = [f"s{k}" for k in range(WORDS)]
    rows = join_small_side(dealt, sketches, "node", max_rows=SKETCH_ROWS).select(
        "key", F.least("part", "other").cast("long").alias("lo"), F.greatest("part", "other").cast("long").alias("hi"),
        F.col("part").cast("long").alias("part"), "node", "component", "n", *bits)
    schema = pa.schema([(c, pa.int64()) for c in ("a", "b", "ca", "cb")])

    def run(batches):
        held = np.zeros((7 + WORDS, 0), np.int64)   # rows of a block whose end hasn't been seen
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
            cut = np.flatnonzero((held[:3, 1:] != held[:3, :-1]).any(axis=0)) + 1
            yield from blocks(held, cut)
            held = held[:, cut[-1]:] if len(cut) else held
        yield from blocks(held, np.array([held.shape[1]]))

    def blocks(held, ends):
        found = []
        for first, last in zip(np.concatenate([[0], ends[:-1]]), ends):
            if last - first < 2:
                continue
            _, lo, hi, part, node, comp, n = held[:7, first:last]
            i, j = block_pairs(node, comp, n, np.ascontiguousarray(held[7:, first:last].T).view(np.uint64),
                               part if lo[0] < hi[0] else None, rule)
            found.append(np.stack([node[i], node[j], comp[i], comp[j]]))
        if found:
            yield pa.RecordBatch.from_arrays(_longs(*np.concatenate(found, axis=1)), schema=schema)

    return (rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
            .mapInArrow(run, "a long, b long, ca long, cb long"))


def _hub(turn: int):
    """The member of a bucket that the others are paired with in a star round (hub, hub_component)."""
    return F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("order"), F.col("node").alias("hub"),
                          F.col("component").alias("hub_component")))


def met_rows(docs: DataFrame, rule: Rule) -> DataFrame:
    """key, f1 of the keys that sets are compared on after prefix filtering.

    Most keys are one set's alone: the keys of two sets or more are found first, by
    a minimum and a maximum that are combined on the map side (so a key of a third
    of all documents is a row a task), and the rows are then made once more and
    filtered, so they are never shuffled as a whole.
    """
    rows = bucket_rows(docs, rule)
    shared = stage_table(rows.groupBy("key").agg(F.min("f1").alias("least"), F.max("f1").alias("most"))
                         .filter("least <> most").select("key"), "parity-shared")
    met = stage_table(join_small_side(rows, shared, "key", "left_semi", max_rows=4 * SMALL_ROWS)
                      .select("key", "f1", "tag").distinct(), "parity-met")
    size = met.groupBy("key").agg(F.count("*").alias("size"))
    own = Window.partitionBy("f1", "tag")      # the keys of one set under one label: bounded by its sketch
    ranked = (met.join(size, "key").withColumn("n", F.count("*").over(own))
              .withColumn("place", F.row_number().over(own.orderBy("size", "key"))))
    out = stage_table(ranked.filter("place <= n - pmod(tag, 4096) + 1").select("key", "f1").distinct(), "parity-kept")
    drop_tables(shared, met, free=True)
    return out


def plausible(pairs: DataFrame, sketches: DataFrame, rule: Rule) -> DataFrame:
    """The ``pairs`` (a, b, ...) that sizes and bit sketches don't rule out."""
    bits = [f"s{k}" for k in range(WORDS)]
    for side in ("a", "b"):
        own = sketches.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), *[F.col(c).alias(f"{c}{side}") for c in bits])
        pairs = join_small_side(pairs, own, side, max_rows=SKETCH_ROWS)
    return pairs.filter(_may_link(rule))


def _may_link(rule: Rule):
    """Whether the sides a and b (sizes na, nb, sketches s0a .., s0b ..) may be linked; a part of the bits first."""
    def apart(first, last):
        return sum((F.bit_count(F.col(f"s{k}a").bitwiseXOR(F.col(f"s{k}b"))) for k in range(first, last)), F.lit(0))

    def within(bits):
        return bits * (rule.q + rule.p) <= (F.col("na") + F.col("nb")) * (rule.q - rule.p)

    return ((F.least("na", "nb") * rule.q >= F.greatest("na", "nb") * rule.p) & within(apart(0, QUICK_WORDS))
            & within(apart(0, WORDS)))


def link_components(docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame | None:
    """(node, component) over class ids; None where no two classes meet."""
    names = classes.select("f1", F.col("class_id").alias("node"))
    kept = met_rows(docs, rule)
    named = stage_table(kept.join(names, "f1").select("key", "node"), "parity-named")
    shared = named.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi")
    live = stage_table(named.join(shared.select("key"), "key"), "parity-live")
    drop_tables(kept, named)
    nodes = stage_table(live.select("node").distinct(), "parity-nodes")
    if nodes.isEmpty():
        return None
    # small tables are written by few tasks, in proportion to the classes that can have links
    many = nodes.count()
    few, some = 8 + many // 100_000, 8 + many // 5_000
    sets = stage_table(set_rows(docs, nodes, rule), "parity-sets")
    sketches = sets.select("node", "n", *[f"s{k}" for k in range(WORDS)])
    labels = nodes.select("node", F.col("node").alias("component"))
    tested, done = None, []

    def across():
        """Buckets' members with their component, of buckets with two components or more."""
        rows = join_small_side(live, labels, "node", max_rows=SMALL_ROWS)
        mixed = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
        return stage_table(rows.join(mixed.select("key"), "key").coalesce(some), "parity-across")

    def settle(pairs):
        """Verify the pairs (a, b, ca, cb), join their components; the number of links."""
        nonlocal tested, labels
        pairs = stage_table(pairs.coalesce(some), "parity-pairs")
        done.append(pairs)
        close = stage_table(nearer(pairs, sets, rule).coalesce(some), "parity-close")
        new = stage_table(verified(close, sets, rule).coalesce(some), "parity-links")
        tested = pairs.select("a", "b") if tested is None else tested.unionByName(pairs.select("a", "b"))
        found = new.count()
        if found:
            merged = components(new.select(F.col("ca").alias("a"), F.col("cb").alias("b")), parts=few)
            merged = merged.select(F.col("node").alias("component"), F.col("component").alias("to"))
            old = labels
            labels = stage_table(join_small_side(labels, merged, "component", "left", max_rows=SMALL_ROWS).select(
                "node", F.coalesce("to", "component").alias("component")).coalesce(few), "parity-labels")
            drop_tables(old)
        drop_tables(close, new)
        return found

    def ordered(pairs):
        """Each pair once, the smaller class first, without pairs of earlier rounds."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                             F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")).distinct()
        return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")

    for turn in range(STAR_ROUNDS):
        members = across()
        hubs = members.groupBy("key").agg(_hub(turn).alias("h")).select("key", "h.*")
        near = members.join(hubs, "key").filter("component <> hub_component").select(
            F.col("node").alias("a"), F.col("hub").alias("b"), F.col("component").alias("ca"),
            F.col("hub_component").alias("cb"))
        found = settle(plausible(ordered(near), sketches, rule).select("a", "b", "ca", "cb"))
        drop_tables(members, free=True)
        if not found:
            break
    members = across()
    settle(ordered(bucket_pairs(members, sketches, turn + 1, rule)))
    drop_tables(members, live, sets, *done)
    if hasattr(labels, "_staged_path"):   # else no link was found, and the labels are the nodes
        drop_tables(nodes)
    return labels


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stage_table(set_table(docs, rule), "parity-docs")
    same = ["n", "f1", "f2"]
    classes = stage_table(rows.filter("doc_id is not null and n > 0").groupBy(*same)
                          .agg(F.min("doc_id").alias("class_id")), "parity-classes")
    labels = link_components(docs, classes, rule)
    if labels is not None:
        # the labels and classes stay: the result reads them
        classes = join_small_side(classes, labels.withColumnRenamed("node", "class_id"), "class_id", "left",
                                  max_rows=SMALL_ROWS)
        classes = classes.select(*same, F.coalesce("component", "class_id").alias("class_id"))
    out = rows.join(classes, same, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_first(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, all columns kept.

    Rows with a null id stay; of rows that repeat an id one stays (the smallest text).
    """
    drop_id, again_id = fresh(docs, "_drop", "_again")
    found = stage_table(near_duplicates(docs, rule).filter("doc_id is not null"), "parity-found")
    drop = found.filter("component_id <> doc_id").select(F.col("doc_id").alias(drop_id)).distinct()
    left = join_small_side(docs, stage_table(drop, "parity-drop"), F.col("doc_id") == F.col(drop_id), "left_anti",
                           max_rows=SMALL_ROWS)
    again = stage_table(found.groupBy(F.col("doc_id").alias(again_id)).agg(F.count("*").alias("n"))
                        .filter("n > 1").select(again_id), "parity-again")
    if again.isEmpty():
        return left
    by = F.col("doc_id") == F.col(again_id)
    once = (join_small_side(left, again, by, "inner", max_rows=SMALL_ROWS).drop(again_id)
            .groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias("r"))
            .select("r.*"))
    return join_small_side(left, again, by, "left_anti", max_rows=SMALL_ROWS).unionByName(once)
