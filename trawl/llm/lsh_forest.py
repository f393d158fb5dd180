"""Near-duplicate components by an LSH forest over MinHash signatures (operator 2).

A document's set is its distinct ``size``-word shingles. Equal sets are one class (its smallest id
stands for it), so copies are never compared. Each class has ``ORDERS * BASE`` MinHash values; every
order is a permutation of them, and the classes are range-partitioned and sorted by the permuted
signature. Neighbours in a sorted order share the longest prefixes: each class is a candidate of
the ``NEAR`` that follow it, as long as they share ``BASE - 1`` values or more. So a region of few similar sets is
compared at a small depth, a crowded one at the depth where the sorted order separates it, and no
region is ever gathered in one task (the rows at partition ends are joined up from a table of at
most 2 * NEAR rows per partition).

It goes in rounds. The first compares direct neighbours of a few orders, the next all orders with
each class labelled by its component so far: neighbours of one component cannot change it and are
passed over. The rows of an order carry four bits of each MinHash value, so that neighbours whose
signatures differ too much are dropped where they stand; the others are confirmed on the full sets.

The rounds compare all of a run (the classes that share the ``BASE - 1`` values of an order) that has
at most ``NEAR + 1`` classes. The last step takes the runs that are longer and still have more than one
label, and compares every two classes of different labels in them, without a bound: the run is cut
into blocks of about ``BLOCK`` classes, pairs of blocks are dealt out, and each is confirmed on the
full sets where it lies.

Defined results: no words: an empty set, linked with nothing; fewer than ``size`` words: the whole
sequence is the one shingle; rows with the same id are one node with the links of each; a row with
a null id keeps a null component and is kept; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.components import components
from trawl.llm.store import bounded, persist
from trawl.llm.text import U64, blocks, hashed_words, mix, stream, windows

ORDERS, BASE, DEPTH, NEAR = 24, 4, 12, 16
#: (orders, neighbours) of each round; a round compares only what the rounds before left apart.
ROUNDS = ((6, 2), (ORDERS, NEAR))
_VALUES = ORDERS * BASE
#: Classes of a block of a long run (a block has about so many).
BLOCK = 128


def _orders() -> np.ndarray:
    """Positions of the signature in each order: BASE of its own first, then a permutation."""
    out = []
    for t in range(ORDERS):
        own = np.arange(BASE * t, BASE * (t + 1))
        rest = np.argsort(stream(100 + t, _VALUES))
        out.append(np.concatenate((own, rest[~np.isin(rest, own)]))[:DEPTH])
    return np.array(out)


_A, _B = stream(11, _VALUES) | U64(1), stream(12, _VALUES)


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a block."""
    h, doc, _, _ = hashed_words(data, off)
    w, first = windows(h, doc, size)
    wdoc = doc[first]
    cut_w = np.searchsorted(wdoc, np.arange(len(off)))
    cut_h = np.searchsorted(doc, np.arange(len(off)))
    out = []
    for i in range(len(off) - 1):
        if cut_w[i + 1] > cut_w[i]:
            out.append(np.unique(w[cut_w[i]:cut_w[i + 1]]))
        elif cut_h[i + 1] > cut_h[i]:
            s = U64(len(h[cut_h[i]:cut_h[i + 1]]))
            with np.errstate(over="ignore"):
                for x in h[cut_h[i]:cut_h[i + 1]]:
                    s = mix(np.array([s + x]))[0]
            out.append(np.array([s], U64))
        else:
            out.append(np.zeros(0, U64))
    return out


def signature(s: np.ndarray) -> np.ndarray:
    """16 bits of the smallest value of each hash function over a non-empty set."""
    least = np.full(_VALUES, ~U64(0))
    with np.errstate(over="ignore"):
        for i in range(0, len(s), 256):
            least = np.minimum(least, (s[i:i + 256, None] * _A + _B).min(0))
    return (mix(least) >> U64(48)).astype("<u2")


def summaries(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, two 64-bit hashes of the set, signature (binary) per row."""

    def task(batches):
        for b in batches:
            for lo, hi, data, off in blocks(b.column(1)):
                sets = shingle_sets(data, off, size)
                with np.errstate(over="ignore"):
                    h1 = np.array([mix(s).sum(dtype=U64) for s in sets], U64)
                    h2 = np.array([np.bitwise_xor.reduce(mix(s * U64(0xC2B2AE3D27D4EB4F) + U64(1)))
                                   if len(s) else 0 for s in sets], U64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                     pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                    ["doc_id", "n_shingles", "h1", "h2", "sig"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        task, "doc_id long, n_shingles long, h1 long, h2 long, sig binary")


def least_alike(percent: int) -> int:
    """Equal places of two packed signatures (low four bits of each value) under which two sets are
    not compared: five standard deviations below what the threshold lets expect."""
    share = percent / 100 + (1 - percent / 100) / 16
    return int(np.floor(_VALUES * share - 5 * np.sqrt(_VALUES * share * (1 - share))))


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x ^ y
    return ((d & 15) == 0).sum(1) + ((d >> 4) == 0).sum(1)


def _in_orders(classes: DataFrame, orders: int) -> DataFrame:
    """(tree, key, id, label, low): every class in each of the first ``orders`` orders. The key is
    the signature in that order, big-endian so that bytes sort as values; low is the packed signature."""
    places = _orders()[:orders]

    def task(batches):
        for b in batches:
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u2").reshape(-1, _VALUES)
            low = (sig & 15).astype(np.uint8)
            low = np.ascontiguousarray(low[:, ::2] | low[:, 1::2] << 4)
            lows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(_VALUES // 2), len(low), [None, pa.py_buffer(low)])
            for t, positions in enumerate(places):
                key = np.ascontiguousarray(sig[:, positions].astype(">u2"))
                keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * DEPTH), len(key), [None, pa.py_buffer(key)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), t, np.int32)), keys.cast(pa.binary()), b.column(0), b.column(2),
                     lows.cast(pa.binary())], ["tree", "key", "id", "label", "low"])

    return classes.select("id", "sig", "label").mapInArrow(
        task, "tree int, key binary, id long, label long, low binary")


_PREFIX = 2 * (BASE - 1)


class _Run:
    """Consecutive rows of the sorted orders: tree, prefix, id, label, packed signature."""

    def __init__(self, *columns: np.ndarray):
        self.tree, self.prefix, self.id, self.label, self.low = self.columns = columns

    def __len__(self) -> int:
        return len(self.id)

    def __getitem__(self, rows: slice) -> _Run:
        return _Run(*(c[rows] for c in self.columns))

    def __add__(self, more: _Run) -> _Run:
        return _Run(*(np.concatenate(c) for c in zip(self.columns, more.columns, strict=True)))

    def pairs(self, k: int, least: int, new_from: int = 0, extra=None) -> tuple[np.ndarray, np.ndarray]:
        """(smaller id, larger id) of rows ``k`` apart that share tree and prefix, have different
        labels and signatures alike; the second row is at ``new_from`` or after."""
        x = slice(max(0, new_from - k), max(0, len(self) - k))
        y = slice(x.start + k, x.stop + k)
        ok = (self.tree[x] == self.tree[y]) & (self.prefix[x] == self.prefix[y]) & (self.label[x] != self.label[y])
        if extra is not None:
            ok &= extra[x] != extra[y]
        at = np.flatnonzero(ok) + x.start
        at = at[_agreeing(self.low[at], self.low[at + k]) >= least]
        a, b = self.id[at], self.id[at + k]
        return np.minimum(a, b), np.maximum(a, b)

    @staticmethod
    def empty() -> _Run:
        return _Run(np.zeros(0, np.int32), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64),
                    np.zeros((0, _VALUES // 2), np.uint8))


_NAMES = ["a", "b", "tree", "prefix", "label", "low", "pid", "pos"]
_NEIGHBOURS = "a long, b long, tree int, prefix long, label long, low binary, pid int, pos long"


def candidates(classes: DataFrame, percent: int, orders: int = ORDERS, near: int = NEAR) -> DataFrame:
    """(a, b), a < b: distinct classes of different labels that stand at most ``near`` apart in one of
    the first ``orders`` sorted orders, share its prefix and have signatures alike.

    classes: id, sig, label (the component known so far)."""
    spark, least = classes.sparkSession, least_alike(percent)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ranged = _in_orders(classes, orders).repartitionByRange(n, "tree", "key", "id") \
        .sortWithinPartitions("tree", "key", "id")

    def task(batches):
        from pyspark import TaskContext

        pid, at, held = TaskContext.get().partitionId(), 0, _Run.empty()

        def ends(run, start):
            n = len(run)
            return pa.RecordBatch.from_arrays(
                [pa.array(run.id), pa.nulls(n, pa.int64()), pa.array(run.tree), pa.array(run.prefix.view(np.int64)),
                 pa.array(run.label), pa.array([x.tobytes() for x in run.low], pa.binary()),
                 pa.array(np.full(n, pid, np.int32)), pa.array(np.arange(start, start + n))], _NAMES)

        for b in batches:
            n = len(b)
            if not n:
                continue
            key = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(n, 2 * DEPTH)
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :_PREFIX] = key[:, :_PREFIX]
            low = np.frombuffer(b"".join(b.column(4).to_pylist()), np.uint8).reshape(n, -1)
            now = _Run(b.column(0).to_numpy().astype(np.int32), wide.view(U64)[:, 0],
                       b.column(2).to_numpy(), b.column(3).to_numpy(), low)
            if at < near:
                yield ends(now[:near - at], at)
            old, held, at = len(held), held + now, at + n
            for k in range(1, near + 1):
                x, y = held.pairs(k, least, old)
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x), pa.array(y), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()),
                     pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int32()),
                     pa.nulls(m, pa.int64())], _NAMES)
            held = held[-near:]
        if len(held):
            yield ends(held, at - len(held))

    got = persist(ranged.mapInArrow(task, _NEIGHBOURS), "neighbours")
    # at most 2 * near rows per partition
    edge = got.where("pid is not null").select(*_NAMES).distinct().toPandas().sort_values(["pid", "pos"])
    rows = _Run(edge["tree"].to_numpy(np.int32), edge["prefix"].to_numpy(np.int64).view(U64),
                edge["a"].to_numpy(np.int64), edge["label"].to_numpy(np.int64),
                np.frombuffer(b"".join(map(bytes, edge["low"])), np.uint8).reshape(len(edge), -1)) \
        if len(edge) else _Run.empty()
    more = []
    for k in range(1, near + 1):
        x, y = rows.pairs(k, least, extra=edge["pid"].to_numpy())
        more += zip(x.tolist(), y.tolist(), strict=True)
    pairs = got.where("pid is null").select("a", "b").unionByName(spark.createDataFrame(more, "a long, b long"))
    return pairs.where("a < b").distinct()


def full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(id, set): sorted shingle hashes of the documents of ``ids``."""

    def task(batches):
        for b in batches:
            for lo, hi, data, off in blocks(b.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo),
                     pa.array([s.tobytes() for s in shingle_sets(data, off, size)], pa.binary())], ["id", "set"])

    rows = docs.selectExpr("cast(doc_id as long) id", "text").join(bounded(ids), "id")
    return rows.select("id", "text").mapInArrow(task, "id long, set binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) with 100 * intersection >= percent * union of the full sets."""

    def task(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), U64) for v in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(task, "a long, b long")


def _in_runs(classes: DataFrame) -> DataFrame:
    """(run, id, label): every class in its run of each order; a run is the order and the prefix."""
    first = _orders()[:, :BASE - 1]

    def task(batches):
        for b in batches:
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u2").reshape(-1, _VALUES).astype(np.int64)
            for t, p in enumerate(first):
                run = np.full(len(sig), t, np.int64)
                for k in p:
                    run = run << 16 | sig[:, k]
                yield pa.RecordBatch.from_arrays([pa.array(run), b.column(0), b.column(2)], ["run", "id", "label"])

    return classes.select("id", "sig", "label").mapInArrow(task, "run long, id long, label long")


def _common(x: list[np.ndarray], y: list[np.ndarray], width: int = 1 << 13) -> np.ndarray:
    """Sizes of the intersections of every set of ``x`` with every set of ``y``."""
    kx, ky = np.concatenate(x), np.concatenate(y)
    keys = np.intersect1d(kx, ky)
    out = np.zeros((len(x), len(y)))
    if not len(keys):
        return out
    sides = []
    for sets, k in ((x, kx), (y, ky)):
        at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == k)
        hit = hit[np.argsort(at[hit], kind="stable")]
        sides.append((len(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])[hit], at[hit]))
    for lo in range(0, len(keys), width):
        m = []
        for n, row, at in sides:
            part = slice(*np.searchsorted(at, (lo, lo + width)))
            m.append(np.zeros((n, min(width, len(keys) - lo)), np.float32))
            m[-1][row[part], at[part] - lo] = 1
        out += m[0] @ m[1].T
    return out


def _joins(x: np.ndarray, y: np.ndarray) -> list[int]:
    """Positions of the (x, y) that join what the ones before them leave apart."""
    over, out = {}, []

    def top(a):
        while over.setdefault(a, a) != a:
            over[a] = a = over[over[a]]
        return a

    for k, (a, b) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        a, b = top(a), top(b)
        if a != b:
            over[a] = b
            out.append(k)
    return out


def _linked(x, y, tree: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Confirmed links between the classes of two blocks (id, label, signature, set) of a run of order
    ``tree``, as far as they join labels; a pair that shares a run of an order before is left to it."""
    share = percent / 100
    least = int(np.floor(_VALUES * share - 5 * np.sqrt(_VALUES * share * (1 - share))))
    same = x[2][:, None] == y[2][None]
    ok = (x[1][:, None] != y[1][None]) & (same.sum(2) >= least)
    for p in _orders()[:tree, :BASE - 1]:
        ok &= ~same[:, :, p].all(2)
    i, j = np.nonzero(ok)
    if not len(i):
        return i, j
    (ri, i), (rj, j) = np.unique(i, return_inverse=True), np.unique(j, return_inverse=True)
    sx, sy = [x[3][r] for r in ri], [y[3][r] for r in rj]
    both = _common(sx, sy)[i, j]
    union = np.array([len(s) for s in sx])[i] + np.array([len(s) for s in sy])[j] - both
    at = np.flatnonzero(100 * both >= percent * union)
    i, j = ri[i[at]], rj[j[at]]
    keep = _joins(x[1][i], y[1][j])
    return x[0][i[keep]], y[0][j[keep]]


def crowded(classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame | None:
    """(a, b): links that join the labels of classes in runs of more than NEAR + 1 classes, every two of
    them compared; None where no such run has two labels. classes: id, sig, label."""
    runs = _in_runs(classes)
    wide = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    wide = persist(wide.where(F.col("n") > NEAR + 1).where("lo < hi").select("run"), "runs")
    if wide.isEmpty():
        return None
    rows = persist(runs.join(bounded(wide), "run"), "members")
    groups = persist(rows.groupBy("run", "label").agg(F.count(F.lit(1)).alias("c")), "groups")
    big = persist(groups.where(F.col("c") >= BLOCK), "big")
    rest = persist(groups.where(F.col("c") < BLOCK).groupBy("run").agg(F.sum("c").alias("small")), "small")
    # blocks of one label (``pure``), the rows of labels with few rows mixed
    salt = F.pmod(F.xxhash64("id"), F.ceil(F.coalesce("c", "small") / BLOCK))
    rows = rows.join(bounded(big), ["run", "label"], "left").join(bounded(rest), "run", "left") \
        .withColumn("pure", F.when(F.col("c").isNotNull(), F.col("label"))) \
        .select("run", "id", "label", "pure", F.xxhash64("run", "pure", salt).alias("block"))
    ids = persist(rows.select("id").distinct(), "ids")
    sets = persist(full_sets(docs, ids, size).dropDuplicates(["id"])
                   .join(classes.select("id", "sig"), "id"), "sets")
    blocks_ = persist(rows.join(sets, "id").groupBy("block", "run", "pure").agg(
        F.collect_list(F.struct("id", "label", "sig", "set")).alias("rows")), "blocks")
    x = blocks_.select("run", F.col("block").alias("x"), F.col("pure").alias("px"))
    y = blocks_.select("run", F.col("block").alias("y"), F.col("pure").alias("py"))
    pairs = persist(x.join(y, "run").where("x < y or (x = y and px is null)")
                    .where("px is null or py is null or px != py").select("run", "x", "y"), "block-pairs")
    both = pairs.join(blocks_.select(F.col("block").alias("x"), F.col("rows").alias("rx")), "x") \
        .join(blocks_.select(F.col("block").alias("y"), F.col("rows").alias("ry")), "y").select("run", "rx", "ry")

    def block(rows):
        sig = np.frombuffer(b"".join(rows.field(2).to_pylist()), "<u2").reshape(-1, _VALUES)
        return rows.field(0).to_numpy(), rows.field(1).to_numpy(), sig, \
            [np.frombuffer(s.as_buffer(), U64) for s in rows.field(3)]

    def task(batches):
        for b in batches:
            for run, rx, ry in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                a, c = _linked(block(rx.values), block(ry.values), run >> 16 * (BASE - 1), percent)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], ["a", "b"])

    return both.mapInArrow(task, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``docs``."""
    info = persist(summaries(docs, size), "summaries")
    found = info.where("n_shingles > 0 and doc_id is not null")
    keys = ["h1", "h2", "n_shingles"]
    of_set = persist(found.groupBy(*keys).agg(F.min("doc_id").alias("id")), "classes")
    classes = found.join(of_set, keys).where("id = doc_id").select("id", "sig").dropDuplicates(["id"])
    classes = persist(classes, "signatures")
    # a repeated id joins its classes
    links = of_set.join(found, keys).where("id != doc_id").groupBy("doc_id").agg(
        F.min("id").alias("a"), F.max("id").alias("b")).where("a != b").select("a", "b")
    labelled = classes.withColumn("label", F.col("id"))
    for orders, near in ROUNDS:
        pairs = persist(candidates(labelled, percent, orders, near), "candidates")
        ids = persist(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
        sets = persist(full_sets(docs, ids, size).dropDuplicates(["id"]), "sets")
        links = persist(links.unionByName(confirmed(pairs, sets, percent)), "links")
        comp = persist(components(links).withColumnRenamed("node", "id"), "components")
        labelled = classes.join(comp, "id", "left").select("id", "sig", F.coalesce("component", "id").alias("label"))
    more = crowded(persist(labelled, "labelled"), docs, size, percent)
    if more is not None:
        links = persist(links.unionByName(more), "links")
        comp = persist(components(links).withColumnRenamed("node", "id"), "components")
    out = info.join(of_set, keys, "left").join(comp, "id", "left")
    cid = F.coalesce("component", "id", "doc_id")
    return out.select("doc_id", "n_shingles", cid.alias("component_id"),
                      F.coalesce(F.col("doc_id") == cid, F.lit(True)).alias("kept"))
