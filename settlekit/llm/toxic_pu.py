"""Toxicity: non-negative positive-unlabelled learning on hashed words.

Confirmed toxic documents of the learning fold are the positives; a bounded
sample of that fold, whatever its labels, is the unlabelled set. A linear
model over the presence of hashed words is fitted with numpy on the driver by
minimising

    pi * R_p(+)  +  max(0, R_u(-) - pi * R_p(-))

with the logistic loss. The class prior pi is the share of toxic documents
among the labelled rows of the learning fold or, where that is larger, the
lower quartile over the marking words of (share of unlabelled documents with
the word) / (share of positives with it): words that only toxic documents have
give the share of toxic documents in the unlabelled sample itself. When the bracket of a mini-batch turns
negative, its gradient is ascended instead (the non-negative correction), so
the model can't drive the unlabelled risk below zero by memorising positives.

The raw score is then calibrated to log-odds of the label by a two-parameter
logistic fit on a bounded sample of the labelled rows of the learning fold.

Words are ASCII-lower-cased and stripped of leading and trailing ASCII
punctuation. Features are chosen by how much more often a word occurs in
positives than in unlabelled documents, measured in standard errors.

Defined results: null and empty texts have no features and get the bias
score; a null id counts as held out; repeated rows are scored each; an empty
table gives no rows; without positives every score is 0. Extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm import folds, scan

MAX_POSITIVE = 5_000       # confirmed toxic rows learned from at most
MAX_UNLABELLED = 15_000    # unlabelled rows learned from at most
MAX_CALIBRATION = 10_000   # labelled rows the score is calibrated on at most
FEATURES = 400
LEAST_Z = 6.0              # standard errors above chance that make a word a feature
LEAST_SHARE = 0.01         # of the positives must have it: passages of a few copied texts don't count
CUTOFF = 0.5


def word_set(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct (hash, document) of the stripped lower-case words."""
    j = scan.join(texts, lower=True)
    start, end, doc = scan.bare_words(j)
    h = scan.span_hash(scan.prefix_hash(j.buf), start, end)
    h, doc, _ = scan.distinct(h, doc)
    return h, doc, j.docs


@dataclass
class Model:
    keys: np.ndarray     # sorted uint64 word hashes
    weight: np.ndarray   # float64, one per key
    bias: float

    def raw(self, h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        out = np.full(n, self.bias)
        if len(self.keys) and len(h):
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = self.keys[at] == h
            out += np.bincount(doc[hit], self.weight[at[hit]], minlength=n)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        h, doc, n = word_set(texts)
        return 1 / (1 + np.exp(-np.clip(self.raw(h, doc, n), -60, 60)))


def choose(positive: list[np.ndarray], unlabelled: list[np.ndarray], most: int) -> np.ndarray:
    """Sorted hashes of the words that mark positives most (``LEAST_Z`` standard errors above chance)."""
    if not positive or not unlabelled:
        return np.zeros(0, np.uint64)
    hp, cp = np.unique(np.concatenate(positive), return_counts=True)
    hu, cu = np.unique(np.concatenate(unlabelled), return_counts=True)
    keys = np.union1d(hp, hu)
    p, u = np.zeros(len(keys)), np.zeros(len(keys))
    p[np.searchsorted(keys, hp)], u[np.searchsorted(keys, hu)] = cp, cu
    n, m = len(positive), len(unlabelled)
    both = (p + u) / (n + m)
    z = (p / n - u / m) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n + 1 / m))
    z[p < max(5, LEAST_SHARE * n)] = 0
    best = np.argsort(-z, kind="stable")[:most]
    return np.sort(keys[best[z[best] >= LEAST_Z]])


def prior_by_words(xp: np.ndarray, xu: np.ndarray, least: int = 20) -> float:
    """Lower quartile of the words' unlabelled-to-positive ratios (0 with no frequent word)."""
    often = xp.sum(0) >= least
    if not often.any() or not len(xu):
        return 0.0
    return float(np.quantile(xu[:, often].mean(0) / xp[:, often].mean(0), 0.25))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
        features: int = FEATURES, epochs: int = 150, batch: int = 1024, rate: float = 0.05,
        l2: float = 1e-5, seed: int = 11) -> Model:
    """nnPU by Adam; ``positive`` and ``unlabelled`` hold the word hashes of each document."""
    if not positive:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -60.0)
    keys = choose(positive, unlabelled, features)
    k = len(keys)

    def dense(rows):
        x = np.zeros((len(rows), k + 1), np.float32)
        x[:, k] = 1
        for r, h in enumerate(rows):
            x[r, np.flatnonzero(np.isin(keys, h, assume_unique=True))] = 1
        return x

    xp, xu = dense(positive), dense(unlabelled)
    prior = min(max(prior, prior_by_words(xp[:, :k], xu[:, :k])), 0.9)
    rng = np.random.default_rng(seed)
    w = np.zeros(k + 1)
    w[k] = np.log(max(prior, 1e-4) / max(1 - prior, 1e-4))
    m, v, step = np.zeros(k + 1), np.zeros(k + 1), 0
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for _ in range(epochs):
        order = rng.permutation(len(xu))
        for at in range(0, max(len(order), 1), batch):
            u = xu[order[at:at + batch]]
            p = xp[rng.integers(0, len(xp), min(batch, len(xp)))]
            zp, zu = p @ w, u @ w
            sp = sig(zp)
            grad_pos = prior * p.T @ (sp - 1) / len(p)                 # of pi R_p(+)
            grad_neg = -prior * p.T @ sp / len(p)                      # of -pi R_p(-)
            risk_neg = -prior * np.logaddexp(0, zp).mean()
            if len(u):
                grad_neg = grad_neg + u.T @ sig(zu) / len(u)           # of R_u(-)
                risk_neg += np.logaddexp(0, zu).mean()
            g = grad_pos + grad_neg if risk_neg >= 0 else -grad_neg
            g[:k] += l2 * w[:k]
            step += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(keys, w[:k], float(w[k]))


def calibrate(model: Model, rows: list[np.ndarray], y: np.ndarray, ridge: float = 0.05, steps: int = 60) -> Model:
    """Rescale and shift the raw score so that it is the log-odds of label 1 (two-parameter logistic fit)."""
    if not len(model.keys) or not rows or y.min() == y.max():
        return model
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    z = model.raw(np.concatenate(rows), doc, len(rows)) - model.bias
    x = np.stack([z, np.ones(len(z))], 1)
    a = np.array([1.0, model.bias])
    for _ in range(steps):  # damped Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ a, -60, 60)))
        g = x.T @ (y - p) - ridge * np.array([a[0] - 1, 0])
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([ridge, 1e-6])
        move = np.linalg.solve(h, g)
        a = a + move * min(1.0, 1.0 / max(np.abs(move).max(), 1e-12))
    return Model(model.keys, model.weight * max(a[0], 0.0), float(a[1]))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED, max_calibration: int = MAX_CALIBRATION) -> Model:
    """Bounded samples by hash of the id; only their word hashes reach the driver."""
    prior = labels.filter(~folds.held_out()).agg(F.avg(F.col(label).cast("double"))).first()[0]
    if not prior:
        return fit([], [], 0.0)
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    fold = docs.select("doc_id").filter(F.col("doc_id").isNotNull() & ~folds.held_out())
    use = lambda rows, name: rows.select("doc_id", *[
        (F.col("y") if name == c == "y" else F.lit(int(name == c) if c != "y" else -1)).alias(c)
        for c in ("positive", "unlabelled", "y")])
    picked = (use(folds.training_labels(labels.filter(F.col(label) == 1), label, max_positive), "positive")
              .unionByName(use(fold.distinct().orderBy(*by_hash).limit(max_unlabelled), "unlabelled"))
              .unionByName(use(folds.training_labels(labels, label, max_calibration), "y"))
              .groupBy("doc_id").agg(*[F.max(c).cast("int").alias(c) for c in ("positive", "unlabelled", "y")]))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(
        "text", "positive", "unlabelled", "y")
    schema = pa.schema([("positive", pa.int32()), ("unlabelled", pa.int32()), ("y", pa.int32()), ("h", pa.binary())])

    def hashed(batches):
        for batch in batches:
            for part in scan.slices(batch):
                h, doc, n = word_set(scan.payloads(part.column(0)))
                ends = np.searchsorted(doc, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), part.column(3),
                     pa.array([h[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())], schema=schema)

    got = rows.mapInArrow(hashed, "positive int, unlabelled int, y int, h binary").toPandas()
    got = got.sort_values(["h", "y"], kind="stable").drop_duplicates(["h", "positive", "unlabelled", "y"])  # arrival order of tasks must not matter
    h = np.array([np.frombuffer(x, np.uint64) for x in got["h"]] + [None], object)[:-1]
    model = fit(list(h[got["positive"].to_numpy() == 1]), list(h[got["unlabelled"].to_numpy() == 1]), float(prior))
    known = got["y"].to_numpy() >= 0
    return calibrate(model, list(h[known]), got["y"].to_numpy()[known].astype(float))


def score_documents(docs: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                        ("predicted", pa.int32())])

    def scored(batches):
        for batch in batches:
            for part in scan.slices(batch):
                s = model.score(scan.payloads(part.column(2)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(s, pa.float64()),
                     pa.array((s >= cutoff).astype(np.int32), pa.int32())], schema=schema)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), folds.held_out().alias("held_out"), "text")
    return src.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")
