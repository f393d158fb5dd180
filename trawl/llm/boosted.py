"""Quality rules: gradient-boosted trees over document statistics (operator 6).

Trees are grown on binned statistics of a bounded sample of labelled documents (``SAMPLE_ROWS``, a
parameter) with logistic loss; chosen features have a monotonic direction: a split that breaks it
is not made, and children inherit bounds from the middle of the split, so the score as a whole is
monotone. The trees are flattened into numpy node arrays, one array per field, and scored level by
level for all documents of a batch at once.

Defined results: a null or empty text has no words, so all counts are 0 and base_failed is true;
every input row gives one row; other columns are ignored; with no labelled row, or one class only,
the method keeps what the base keeps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trawl.llm.sample import labelled
from trawl.llm.stats import COUNTS, FEATURES, MONOTONE, document_stats

SAMPLE_ROWS = 20_000
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, score double, kept boolean")


@dataclass
class Forest:
    """Flattened trees: node ``i`` sends x to ``left[i]`` if x[feature[i]] <= threshold[i], else to
    ``right[i]``; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            go_left = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(go_left, self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(1))))


def train(x: np.ndarray, y: np.ndarray, monotone=MONOTONE, trees: int = 60, depth: int = 3, rate: float = 0.2,
          bins: int = 48, ridge: float = 1.0, least: int = 20) -> Forest:
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    raw = np.full(len(y), base)

    def node() -> int:
        for field, v in ((feature, 0), (threshold, 0.0), (left, 0), (right, 0), (value, 0.0)):
            field.append(v)
        left[-1] = right[-1] = len(left) - 1
        return len(left) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        weight = lambda g, h: -g / (h + ridge)
        root = node()
        roots.append(root)
        todo = [(root, np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            at, rows, level, lo, hi = todo.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            value[at] = rate * float(np.clip(weight(g, h), lo, hi))
            best = None
            if level < depth and len(rows) >= 2 * least:
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    b = binned[rows, f]
                    gl, hl, nl = (np.cumsum(np.bincount(b, v, len(e) + 1))[:-1] for v in (grad[rows], hess[rows], None))
                    wl, wr = np.clip(weight(gl, hl), lo, hi), np.clip(weight(g - gl, h - hl), lo, hi)
                    gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                    ok = (nl >= least) & (len(rows) - nl >= least) & (monotone[f] * (wr - wl) >= 0)
                    gain = np.where(ok, gain, 0)
                    k = int(gain.argmax())
                    if gain[k] > (best[0] if best else 1e-6):
                        best = (gain[k], f, k, wl[k], wr[k])
            if best is None:
                raw[rows] += value[at]
                continue
            _, f, k, wl, wr = best
            feature[at], threshold[at] = f, float(edges[f][k])
            goes = binned[rows, f] <= k
            mid = (wl + wr) / 2
            l_hi, r_lo = (mid, mid) if monotone[f] > 0 else (hi, lo)
            l_lo, r_hi = (mid, mid) if monotone[f] < 0 else (lo, hi)
            left[at], right[at] = node(), node()
            todo += [(left[at], rows[goes], level + 1, l_lo, l_hi), (right[at], rows[~goes], level + 1, r_lo, r_hi)]
    arrays = [np.array(a) for a in (feature, threshold, left, right, value, roots)]
    return Forest(*arrays, depth=depth, base=base)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Forest | None:
    """Forest from the statistics of at most ``rows`` labelled documents; None without two classes."""

    def task(batches):
        for b in batches:
            feats = document_stats(b.column(1))[1]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(list(feats), pa.list_(pa.float64())), b.column(2)], ["doc_id", "x", "y"])

    got = labelled(docs, labels, "quality", rows, None).mapInArrow(
        task, "doc_id long, x array<double>, y int").toPandas().sort_values("doc_id", kind="stable")
    if got["y"].nunique() < 2:
        return None
    return train(np.stack(got["x"].to_numpy()), got["y"].to_numpy(float))


def quality(docs: DataFrame, forest: Forest | None, keep_at: float = 0.3) -> DataFrame:
    """The counts, the base rules and the verdict (score >= ``keep_at``) of every document."""

    def task(batches):
        for b in batches:
            counts, feats = document_stats(b.column(1))
            failed = (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])
            score = forest.score(feats) if forest is not None else np.ones(len(feats))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(failed),
                 pa.array(score), pa.array(~failed & (score >= keep_at))],
                ["doc_id", *COUNTS, "base_failed", "score", "kept"])

    assert len(FEATURES) == len(MONOTONE)
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(task, SCHEMA)
