"""Quality classifier: hashed word n-gram logistic regression by FTRL-proximal (operator 9).

Features are hashes into ``2**BITS`` weights of word 1- and 2-grams and of 1- to 3-grams of word
shapes (case, symbols, length, same as the word before). A document's value of a feature is its
share of the document's n-grams. Training is two passes of follow-the-regularised-leader updates
over a bounded sample of labelled documents (``SAMPLE_ROWS``) in one task, which streams them in
id-hash order once per pass, every document alike; scoring is a sparse dot product per document, vectorised over a batch.

Defined results: a null or empty text has no features and scores the bias alone; every row gives
one row; other columns are ignored; without labelled rows every score is 0.5. Label columns, lang,
source and doc_id are never features.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.sample import fold, labelled
from trawl.llm.text import U64, blocks, hashed_words, mix

BITS = 20
SAMPLE_ROWS = 12_000
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

_KIND = np.zeros(256, np.int64)  # 1 upper, 2 digit, 3 symbol, 4 punctuation, 0 other
_KIND[65:91], _KIND[48:58] = 1, 2
_KIND[list(b"#*$%&|<>")] = 3
_KIND[list(b".,;:!?")] = 4


def _shapes(data, h, doc, starts, ends) -> np.ndarray:
    n = [np.concatenate(([0], np.cumsum(_KIND[data] == k))) for k in (1, 2, 3, 4)]
    up, digit, sym, punct = (np.minimum(c[ends] - c[starts], 7) for c in n)
    size = ends - starts
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    case = np.where(up == 0, 0, np.where(up >= np.minimum(size - sym - punct, 7), 2, 1))
    code = (((case * 2 + (digit > 0)) * 4 + np.minimum(sym, 3)) * 3 + np.minimum(punct, 2)) * 2 + same
    return mix((code * 8 + np.minimum(size // 3, 7)).astype(U64) + U64(0x51ED270B))


def features(data, off, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(weight index, document index) of every n-gram of a block."""
    h, doc, starts, ends = hashed_words(data, off)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    shape = _shapes(data, h, doc, starts, ends)
    keys, docs = [h, shape], [doc, doc]
    with np.errstate(over="ignore"):
        for base, size, salt in ((h, 2, 3), (shape, 2, 5), (shape, 3, 7)):
            n = len(h) - size + 1
            if n <= 0:
                continue
            k = base[:n] * U64(2 * salt + 1)
            for j in range(1, size):
                k = mix(k) + base[j:n + j]
            same = doc[:n] == doc[size - 1:]
            keys.append(mix(k + U64(salt))[same])
            docs.append(doc[:n][same])
    return (np.concatenate(keys) >> U64(64 - bits)).astype(np.int64), np.concatenate(docs)


class Ftrl:
    def __init__(self, bits: int = BITS, alpha: float = 3.0, beta: float = 0.01, l1: float = 1e-4, l2: float = 1e-3):
        self.bits, self.alpha, self.beta, self.l1, self.l2 = bits, alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)  # the last is the bias

    def weights(self, i=slice(None)) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, index: np.ndarray, y: int) -> None:
        i, x = np.unique(index, return_counts=True)
        i, x = np.append(i, 1 << self.bits), np.append(x / max(len(index), 1), 0.1)
        w = self.weights(i)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
        sigma = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / self.alpha
        self.z[i] += g - sigma * w
        self.n[i] += g * g


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, held_out: int = 0, passes: int = 2) -> np.ndarray:
    """Weights (float32, bias last) learnt from at most ``rows`` labelled documents outside fold
    ``held_out``, each learnt from once in each of ``passes`` passes."""
    def task(batches):
        model, seen = Ftrl(), 0
        for b in batches:
            y = b.column(1).to_pylist()
            for lo, hi, data, off in blocks(b.column(0)):
                index, doc = features(data, off)
                order = np.argsort(doc, kind="stable")
                cut = np.searchsorted(doc[order], np.arange(1, hi - lo))
                for k, f in enumerate(np.split(index[order].astype(np.int32), cut)):
                    model.learn(f, y[lo + k])
                seen += hi - lo
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype("<f4").tobytes()], pa.binary())], ["w"])

    s = labelled(docs, labels, "quality", rows, held_out)
    one = s.repartition(1).withColumn("pass", F.explode(F.array(*map(F.lit, range(passes))))) \
        .sortWithinPartitions("pass", F.xxhash64("doc_id"), "doc_id").select("text", "y")
    got = one.mapInArrow(task, "w binary").collect()
    return np.frombuffer(got[0].w, "<f4") if got else np.zeros((1 << BITS) + 1, np.float32)


def score_column(column, weights: np.ndarray) -> np.ndarray:
    out = []
    for lo, hi, data, off in blocks(column):
        index, doc = features(data, off)
        n = np.maximum(np.bincount(doc, minlength=hi - lo), 1)
        z = np.bincount(doc, weights[index], hi - lo) / n + 0.1 * weights[-1]
        out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
    return np.concatenate(out) if out else np.zeros(0)


def scored(docs: DataFrame, weights: np.ndarray, held_out: int = 0, keep_at: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= ``keep_at``) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2**BITS + 1 floats: a fixed size

    def task(batches):
        for b in batches:
            s = score_column(b.column(1), shared.value)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(s, pa.float64()), pa.array((s >= keep_at).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold() == held_out).alias("held_out")) \
        .mapInArrow(task, SCHEMA)


def accepted(docs: DataFrame, weights: np.ndarray, keep_at: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score of ``keep_at`` or more, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def task(batches):
        for b in batches:
            s = score_column(b.column(b.schema.get_field_index("text")), shared.value)
            yield b.filter(pa.array(s >= keep_at))

    return docs.mapInArrow(task, docs.schema)
