"""Quality classifier: histogram gradient-boosted trees over document statistics.

Training rows (bounded by ``max_train``, from the learning fold only) are
turned into statistics by Spark tasks and fitted with numpy on the driver;
the fitted forest is a handful of flat arrays that travel with the task
closure and are traversed level by level for a whole slice at a time.

Defined results: a null or empty text has all-zero statistics and still gets
a score; a null id counts as held out; repeated rows are scored each; an empty
table gives no rows; without both classes in the training rows every score is
the share of good labels (0.5 with no labels at all). Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm import doc_stats, folds, scan

MAX_TRAIN = 20_000      # labelled rows the forest is fitted on at most
CUTOFF = 0.3            # predicted = 1 from this score on


@dataclass
class Forest:
    """Complete binary trees in heap order: node k has children 2k+1, 2k+2."""

    base: float
    depth: int
    feature: np.ndarray   # (trees, 2**depth - 1) int16
    cut: np.ndarray       # same shape, float32: go right where x > cut
    leaf: np.ndarray      # (trees, 2**depth) float32

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base, np.float64)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return 1.0 / (1.0 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.12,
        bins: int = 48, min_rows: int = 20, l2: float = 2.0) -> Forest:
    """Newton boosting of the logistic loss on quantile histograms."""
    inner = 2**depth - 1
    good = float(y.mean()) if len(y) else 0.5
    flat = np.zeros((0, inner), np.int16), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1), np.float32)
    if len(y) == 0 or good in (0.0, 1.0):
        p = min(max(good, 0.0), 1.0)
        base = np.inf if p == 1 else -np.inf if p == 0 else float(np.log(p / (1 - p)))
        return Forest(base, depth, *flat)
    n, f = x.shape
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])).astype(np.float32) for k in range(f)]
    binned = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], 1)
    width = bins + 1
    base = float(np.log(good / (1 - good)))
    raw = np.full(n, base)
    feature = np.zeros((trees, inner), np.int16)
    cut = np.full((trees, inner), np.inf, np.float32)
    leaf = np.zeros((trees, inner + 1), np.float32)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            k0, many = 2**level - 1, 2**level
            local = node - k0
            best = np.full(many, 1e-9)
            for k, c in enumerate(cuts):
                if not len(c):
                    continue
                key = local * width + binned[:, k]
                hist = [np.bincount(key, w, many * width).reshape(many, width).cumsum(1) for w in (g, h, None)]
                gl, hl, nl = (a[:, :len(c)] for a in hist)
                gt, ht, nt = (a[:, -1:] for a in hist)
                gain = gl**2 / (hl + l2) + (gt - gl)**2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[(nl < min_rows) | (nt - nl < min_rows)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(many), at]
                better = top > best
                best[better] = top[better]
                feature[t, k0:k0 + many][better] = k
                cut[t, k0:k0 + many][better] = c[at[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > cut[t, node])
        side = node - inner
        gs, hs = np.bincount(side, g, inner + 1), np.bincount(side, h, inner + 1)
        leaf[t] = rate * gs / (hs + l2)
        raw += leaf[t, side]
    return Forest(base, depth, feature, cut, leaf)


def _map_texts(make, schema: pa.Schema):
    """An Arrow mapper: ``make(slice, texts)`` gives the columns of the output."""
    def run(batches):
        for batch in batches:
            for part in scan.slices(batch):
                texts = scan.payloads(part.column(part.schema.get_field_index("text")))
                yield pa.RecordBatch.from_arrays(make(part, texts), schema=schema)
    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN) -> Forest:
    """Fit on at most ``max_train`` labelled rows of the learning fold."""
    picked = folds.training_labels(labels, label, max_train)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("y", "text")

    def packed(part, texts):
        x = doc_stats.matrix(texts).astype("<f4")
        return [part.column(0), pa.array([r.tobytes() for r in x], pa.binary())]

    got = rows.mapInArrow(_map_texts(packed, pa.schema([("y", pa.int32()), ("x", pa.binary())])),
                          "y int, x binary").toPandas()
    x = np.frombuffer(b"".join(got["x"]), "<f4").reshape(-1, len(doc_stats.NAMES)).astype(np.float32)
    by = np.lexsort((*x.T, got["y"].to_numpy()))  # arrival order of tasks must not matter
    return fit(x[by], got["y"].to_numpy().astype(np.float64)[by])


def score_documents(docs: DataFrame, forest: Forest, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                        ("predicted", pa.int32())])

    def scored(part, texts):
        s = forest.score(doc_stats.matrix(texts))
        return [part.column(0), part.column(1), pa.array(s, pa.float64()),
                pa.array((s >= cutoff).astype(np.int32), pa.int32())]

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), folds.held_out().alias("held_out"), "text")
    return src.mapInArrow(_map_texts(scored, schema), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, forest: Forest, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that the forest accepts, all columns kept."""
    def kept(batches):
        for batch in batches:
            for part in scan.slices(batch):
                texts = scan.payloads(part.column(part.schema.get_field_index("text")))
                yield part.filter(pa.array(forest.score(doc_stats.matrix(texts)) >= cutoff))

    return docs.mapInArrow(kept, docs.schema)
