"""Brute-force versions of the operators and a table of awkward documents."""

import hashlib
import re
from collections import Counter

from pyspark.sql import types as T

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")

PASSAGE = ("the committee met on a cold morning to weigh the proposal and after some hours of careful talk it agreed "
           "to send the plan back with notes on cost scope timing and the people who would have to carry it out "
           "before the next season began in earnest across the whole of the northern district")
BASE = " ".join(f"alpha{k} beta{k * 7 % 13} gamma{k}" for k in range(60))

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    *[T.StructField(c, T.StringType()) for c in (
        "_lines", "_id", "_hash", "_key", "_drop", "_again", "_bad_id", "key", "part", "block", "score", "words",
        "n", "component", "node", "held_out", "ids")]])


def texts():
    out = [
        (1, BASE), (2, None), (3, ""), (4, BASE), (5, BASE.replace("alpha3 ", "other ")), (6, "  \n\t "),
        (7, "one"), (8, "one"), (9, "one two three"), (10, "漢字 テスト … é x ＡＢ"),
        (11, PASSAGE + "\n" + BASE), (12, "lead\n" + PASSAGE + "\ntail"), (13, "x " * 30000),
        (14, "\n".join(f"line number {k} of a document that is rather long {k * k}" for k in range(400))),
        (15, "A" * 70 + "B" * 70), (16, "A" * 200), (17, "B" * 60 + "A" * 60),
        (18, "<|endoftext|> special <|startoftext|>"), (19, "tab\there\r\nand\x0bthere\x0c  two  spaces  "),
        (20, "IDIOT idiot moron scum"), (1 << 40, BASE + " end"),
        (21, "\n".join(f"line number {k} of a document that is rather long {k * k}" for k in range(100, 180))),
        (22, " ".join(f"alpha{k} beta{k * 7 % 13} gamma{k}" for k in range(55))),
    ]
    return out


def table(spark, rows=None, repeated=False):
    rows = texts() if rows is None else rows
    if repeated:
        rows = rows + [(None, BASE), (None, None), (1, BASE), (9, "one two three"), (9, "four five six")]
    full = [(d, t, "en", "src0", None if t is None else len(t), *["clash"] * (len(SCHEMA) - 5)) for d, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, k):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(rows, k, p, q):
    sets = {d: shingle_set(t, k) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and q * both >= p * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def byte_dedup(rows, length=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            first[s] = min(first.get(s, d), d)
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def line_dedup(rows, min_run=100):
    """{doc_id: set of deleted line numbers}: every run of lines with a word of min_run characters that starts earlier."""
    seq = {d: [(i, x) for i, x in enumerate(t.split("\n")) if WORD.search(x)] for d, t in rows if t is not None}
    seen, gone = set(), {d: set() for d, _ in rows}
    for d in sorted(seq):
        s = seq[d]
        for a in range(len(s)):
            size = 0
            for z in range(a, len(s)):
                size += len(s[z][1])
                if size >= min_run:
                    run = tuple(x for _, x in s[a:z + 1])
                    if run in seen:
                        gone[d].update(i for i, _ in s[a:z + 1])
                    seen.add(run)
                if size - len(s[a][1]) >= min_run:   # a longer run is this one and one from the next line
                    break
    return gone


def quality_counts(text):
    w = words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
