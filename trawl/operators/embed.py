"""Embeddings.

E1 token ids, padding and mask over whole texts (consecutive 512-token windows, every token
covered); E2 element-wise mean pooling as a partial aggregation on (key, dimension); E3/X4
pluggable model applied per Arrow batch; E4 TF-IDF with hashed dimensions.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TOKEN_RE = r"[\p{L}\p{N}]+"
WINDOW = 512
VOCAB = 30522
MAX_BROADCAST_TERMS = 5_000_000
#: Most frequent terms whose document frequency goes to every task (about 10 MB).
HOT_TERMS = 200_000


def tokens(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(t), F.lit(TOKEN_RE), 0)


def md5_bucket(term: Column, n: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long"), F.lit(n))


def token_ids(text, vocab: int = VOCAB) -> Column:
    """Hashed token ids in [1, vocab-1]; 0 is reserved for padding."""
    return F.transform(tokens(text), lambda t: md5_bucket(t, vocab - 1) + 1)


def pad_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                vocab: int = VOCAB) -> DataFrame:
    """E1 over the whole text: one row per consecutive ``window``-token slice, zero padded to
    exactly ``window`` ids, with the attention mask (1 where id != 0)."""
    from trawl.functions.urls import materialize

    base = materialize(docs.select(id_col, text_col), "_ids", token_ids(text_col, vocab)).drop(text_col)
    n_win = F.greatest(F.ceil(F.size("_ids") / F.lit(window)), F.lit(1)).cast("int")
    ex = base.select(id_col, "_ids", F.explode(F.sequence(F.lit(0), n_win - 1)).alias("window_idx"))
    sl = F.slice("_ids", F.col("window_idx") * window + 1, window)
    padded = F.slice(F.concat(sl, F.array_repeat(F.lit(0).cast("long"), window)), 1, window)
    return ex.select(id_col, "window_idx", padded.alias("input_ids"),
                     F.transform(padded, lambda x: (x != 0).cast("int")).alias("attention_mask"))


def mean_pool(df: DataFrame, key_cols, vec_col: str = "embedding") -> DataFrame:
    """Element-wise mean of the vectors of each key, one row per (key, dim).

    (key, dim) grouping is partially aggregated map-side, so a key holding a third of all
    vectors only adds one partial row per dim per input partition."""
    ex = df.select(*key_cols, F.posexplode(vec_col).alias("dim", "x"))
    return ex.groupBy(*key_cols, "dim").agg(F.avg(F.col("x").cast("double")).alias("mean_value"))


def mean_pool_vectors(df: DataFrame, key_cols, vec_col: str = "embedding") -> DataFrame:
    """Mean vector per key as ``vector ARRAY<DOUBLE>`` (the list per key is bounded by the dimension)."""
    m = mean_pool(df, key_cols, vec_col)
    return m.groupBy(*key_cols).agg(F.array_sort(F.collect_list(F.struct("dim", "mean_value"))).alias("_v")) \
        .select(*key_cols, F.transform("_v", lambda s: s["mean_value"]).alias("vector"))


def tfidf(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dims: int = 64,
          hot_terms: int = HOT_TERMS) -> DataFrame:
    """weight = tf * ln((N+1)/(df+1)), summed into ``dims`` md5-hashed dimensions.
    Returns (id_col, dim, weight).

    Texts are shuffled by id, not their terms: all counts of a document are made where it lies. The
    ``hot_terms`` most frequent terms find their document frequency there too (a bounded broadcast); the
    rows of the others alone travel to it by a shuffle."""
    ex = docs.select(id_col, text_col).repartition(F.col(id_col)).select(id_col, F.explode(tokens(text_col)).alias("term"))
    tf = ex.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n_docs = docs.count()  # one row per document
    hot = F.broadcast(dfreq.orderBy(F.col("df").desc(), "term").limit(hot_terms))
    near = tf.join(hot, "term")
    # the other terms are not bounded in number: joined by a shuffle, none of them frequent
    far = tf.join(hot.select("term"), "term", "left_anti").join(dfreq, "term")
    w = near.unionByName(far).withColumn(
        "w", F.col("tf") * F.log((F.lit(n_docs) + 1.0) / (F.col("df") + 1.0)))
    return w.groupBy(id_col, md5_bucket(F.col("term"), dims).alias("dim")).agg(F.sum("w").alias("weight"))


def hashing_model(dims: int = 64) -> Callable[[list[str]], np.ndarray]:
    """A small stand-in model for X4: L2-normalised hashed term counts."""
    import hashlib
    import re

    rx = re.compile(r"\w+", re.UNICODE)

    def model(texts):
        out = np.zeros((len(texts), dims))
        for i, t in enumerate(texts):
            for tok in rx.findall((t or "").lower()):
                out[i, int(hashlib.md5(tok.encode()).hexdigest()[:8], 16) % dims] += 1.0
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, n, out=np.zeros_like(out), where=n > 0)

    return model


def embed(blocks: DataFrame, model_fn: Callable[[list[str]], np.ndarray] | None = None,
          text_col: str = "text", out_col: str = "embedding", dims: int = 64) -> DataFrame:
    """Apply a user model to every Arrow batch of texts (``mapInPandas``)."""
    model_fn = model_fn or hashing_model(dims)
    schema = T.StructType(list(blocks.schema.fields) + [T.StructField(out_col, T.ArrayType(T.DoubleType()))])

    def fn(batches):
        for pdf in batches:
            vecs = model_fn(pdf[text_col].tolist()) if len(pdf) else np.zeros((0, dims))
            pdf[out_col] = list(np.asarray(vecs, dtype=np.float64))
            yield pdf

    return blocks.mapInPandas(fn, schema)


def vector_text(vec) -> Column:
    """Doubles joined by spaces."""
    v = F.col(vec) if isinstance(vec, str) else vec
    return F.array_join(F.transform(v, lambda x: x.cast("double").cast("string")), " ")
