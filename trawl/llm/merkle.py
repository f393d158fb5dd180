"""Merkle manifest of a table of documents with incremental witnesses (operator 11).

A row's leaf is the hash of its fields. The leaves of a language, in order of id, are cut at fixed
places of ``fan ** depth`` leaves (blocks) and appended one by one in a task per block: each level
holds the open run of fewer than ``fan`` subtrees, and a completed run becomes a subtree of the next
level. A node's witness is attached when its run completes: the hashes left and right of it there;
every later completion above it extends the witness by one more such step. The roots of the blocks
are the appends of the next round, again in blocks, until one root a language is left (its subroot);
the subroots, in order of language, are appended the same way and give the root.

Going up, a round keeps only the root of each block. Going down, each round hands a block the witness
of its root (one header row a block, dealt with the block's rows) and appends the block again, this
time extending the nodes' witnesses. So no witness of a leaf is ever written or shuffled, a task holds
one block, and a lost executor costs its blocks only. Positions are numbered without one task seeing
a language whole: rows are dealt by ranges of (language, id), and ranges get offsets from their
counts (one row per range and language).

Defined results: null fields count as ``-`` (a null language is a language of its own, ordered first;
a null id is ordered first and never tampered with); rows with the same id are leaves of their own, in
order of their leaf; equal rows are equal leaves that stand side by side; an empty text is ``0:``;
other columns are ignored; an empty table gives an empty result. A leaf alone in its language is the
subroot, a language alone in the table is the root; their empty witness hashes to the hash of nothing.
"""

from __future__ import annotations

import hashlib
import string
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.store import persist

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])
_WITNESS = "array<struct<left:string,right:string>>"


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """Hash of the fields: ``-`` for null, else byte length, colon, value."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


class Appender:
    """An append-only tree of ``levels`` levels over nodes given left to right. With ``keep`` each
    appended node's witness (a list of (left, right) texts) is extended as runs complete."""

    def __init__(self, levels: int, fan: int, keep: bool):
        self.levels, self.fan, self.keep = levels, fan, keep
        self.open: list[list[tuple[str, list[list]]]] = [[] for _ in range(levels + 1)]

    def append(self, node: str) -> list:
        """Appends a node and returns its witness, which later appends extend."""
        witness: list = []
        self.open[0].append((node, [witness] if self.keep else []))
        level = 0
        while level < self.levels and len(self.open[level]) == self.fan:
            self._close(level)
            level += 1
        return witness

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        whole = "".join([node for node, _ in run])
        at, below = 0, []
        for node, witnesses in run:
            step = (whole[:at], whole[at + len(node):])
            at += len(node)
            for w in witnesses:
                w.append(step)
            below += witnesses
        self.open[level + 1].append((_h(whole), below))

    def root(self) -> str:
        """Closes the runs still open and returns the one node left."""
        for level in range(self.levels):
            if self.open[level]:
                self._close(level)
        return self.open[self.levels][0][0]


def levels_of(n: Column, fan: int) -> Column:
    """Levels of a tree over ``n`` nodes: the smallest k with fan ** k >= n."""
    full = [fan ** k for k in range(0, 64) if fan ** k < 1 << 62]
    return reduce(lambda acc, f: acc + F.when(n > f, 1).otherwise(0), full, F.lit(0)).cast("int")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at`` (position inside their group ``g`` by ``order``, nulls first, from 0) and
    ``n`` (rows of the group)."""
    dealt = persist(rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
                    .withColumn("mid", F.monotonically_increasing_id()), "ordered")
    dealt = dealt.withColumn("part", F.shiftright("mid", 33))
    counts = dealt.groupBy(F.col("part").alias("of"), F.col("g").alias("group")).agg(
        F.min("mid").alias("low"), F.count("*").alias("here"))
    group = Window.partitionBy("group")
    before = group.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("low")
    offsets = counts.select("of", "group", base.alias("base"), F.sum("here").over(group).alias("n"))
    same = (F.col("part") == F.col("of")) & F.col("g").eqNullSafe(F.col("group"))
    return dealt.join(offsets, same).select(*rows.columns, (F.col("mid") + F.col("base")).alias("at"), "n")


def _rows(batches, names):
    for b in batches:
        yield from zip(*[b.column(n).to_pylist() for n in names], strict=True)


def _roots(depth: int, fan: int, chunk: int = 1024):
    """The root of each block from the block's nodes in order."""

    def task(batches):
        key, tree, out = None, None, []
        for g, block, n, levels, node in _rows(batches, ("g", "block", "n", "levels", "node")):
            if key is None or key[:2] != (g, block):
                if key is not None:
                    out.append((*key, tree.root()))
                key, tree = (g, block, n, levels), Appender(min(depth, levels), fan, False)
            tree.append(node)
            if len(out) == chunk:
                yield batch(out)
                out = []
        if key is not None:
            yield batch([*out, (*key, tree.root())])

    def batch(rows):
        g, at, n, levels, node = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(g, pa.string()), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(levels, pa.int32()),
             pa.array(node, pa.string())], ["g", "at", "n", "levels", "node"])
    return task


def _extended(depth: int, fan: int, chunk: int = 512):
    """A block's nodes with their witnesses. A block may begin with a header row (``at`` null) that
    holds the witness of its root."""

    def task(batches):
        key, tree, upper, rows = None, None, [], []
        for g, block, levels, at, node, doc, other, steps in _rows(batches, (
                "g", "block", "levels", "at", "node", "doc_id", "other", "witness")):
            if key != (g, block):
                yield from done(tree, upper, rows)
                key, tree, upper, rows = (g, block), None, [], []
            if at is None:
                upper = steps
                continue
            tree = tree or Appender(min(depth, levels), fan, True)
            rows.append((g, at, node, doc, other, tree.append(node)))
        yield from done(tree, upper, rows)

    def done(tree, upper, rows):
        if tree is not None:
            tree.root()
        for i in range(0, len(rows), chunk):
            g, at, node, doc, other, witness = zip(*rows[i:i + chunk], strict=True)
            steps = [[{"left": a, "right": b} for a, b in w] + upper for w in witness]
            yield pa.RecordBatch.from_arrays(
                [pa.array(g, pa.string()), pa.array(at, pa.int64()), pa.array(node, pa.string()), pa.array(doc, pa.int64()),
                 pa.array(other, pa.string()), pa.array(steps, pa.list_(_STEP))],
                ["g", "at", "node", "doc_id", "other", "witness"])
    return task


def grow(nodes: DataFrame, depth: int, fan: int) -> tuple[list[DataFrame], DataFrame]:
    """Appends the ``nodes`` (g, at, n, node, doc_id, other) of every group in rounds. Returns the
    nodes of each round, the lowest first, and one root per group (g, node)."""
    size = fan ** depth
    most = nodes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    here, rounds = nodes.withColumn("levels", levels_of(F.col("n"), fan)), []
    while most > 1 or not rounds:
        here = here.withColumn("block", F.floor(F.col("at") / size))
        rounds.append(here)
        roots = here.repartition("g", "block").sortWithinPartitions("g", "block", "at").mapInArrow(
            _roots(depth, fan), "g string, at long, n long, levels int, node string")
        here = persist(roots.select("g", "at", F.ceil(F.col("n") / size).cast("long").alias("n"), "node",
                                    F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("other"),
                                    F.greatest(F.col("levels") - depth, F.lit(0)).alias("levels")), "roots")
        most = -(-most // size)
    return rounds, here.select("g", "node")


def attach(rounds: list[DataFrame], top: DataFrame | None, depth: int, fan: int) -> DataFrame:
    """g, at, node, doc_id, other, witness of the lowest round's nodes. ``top`` (g, witness) is what
    the witness of each group's root continues with."""
    upper = top and top.withColumn("at", F.lit(0).cast("long"))
    for here in reversed(rounds):
        rows = here.select("g", "block", "levels", "at", "node", "doc_id", "other", F.lit(None).cast(_WITNESS).alias("witness"))
        if upper is not None:
            rows = rows.unionByName(upper.select("g", F.col("at").alias("block"), "witness"), allowMissingColumns=True)
        upper = rows.repartition("g", "block").sortWithinPartitions("g", "block", "at").mapInArrow(
            _extended(depth, fan), f"g string, at long, node string, doc_id long, other string, witness {_WITNESS}")
        if here is not rounds[0]:
            upper = persist(upper, "witness")
    return upper


def fold(start: Column, steps: Column) -> Column:
    """Root that a node and its witness give."""
    return F.aggregate(steps, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def manifest(docs: DataFrame, other: Column | None = None, depth: int = 4, fan: int = 8) -> DataFrame:
    """doc_id, lang, leaf, other, witness (steps of hashes left and right, from the leaf up to the root
    of all), subroot, root. ``other`` is a text computed on ``docs`` that is carried along."""
    fields = [F.col(c) for c in FIELDS]
    other = F.lit(None).cast("string") if other is None else other
    leaves = persist(docs.select(F.col("lang").alias("g"), F.col("doc_id").cast("long").alias("doc_id"),
                                 leaf(fields).alias("node"), other.alias("other")), "leaves")
    rounds, subroots = grow(persist(numbered(leaves, ["doc_id", "node"]), "placed"), depth, fan)
    langs = subroots.select(F.lit("").alias("g"), F.lit(None).cast("long").alias("doc_id"),
                            F.col("g").alias("other"), "node")
    above, roots = grow(persist(numbered(langs, ["other"]), "languages"), depth, fan)
    of_lang = persist(attach(above, None, depth, fan).select(
        F.col("other").alias("lang"), F.col("node").alias("subroot"), "witness"), "languages")
    root = roots.select("node").first()
    rows = attach(rounds, of_lang.select(F.col("lang").alias("g"), "witness"), depth, fan)
    # a language's own steps are those before the steps of its subroot
    depth_of_all = 0 if root is None else of_lang.select(F.size("witness")).first()[0]
    own = F.slice("witness", F.lit(1), F.size("witness") - depth_of_all)
    return rows.select("doc_id", F.col("g").alias("lang"), F.col("node").alias("leaf"), "other", "witness",
                       fold(F.col("node"), own).alias("subroot"), F.lit(root and root[0]).cast("string").alias("root"))


def tampered(fields: tuple[str, ...] = FIELDS) -> Column:
    """Leaf of a row with its text's A-Z in lower case, where 3 divides the id's crc32; null elsewhere."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    hit = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, leaf([lower if c == "text" else F.col(c) for c in fields]))


def audit(docs: DataFrame, depth: int = 4, fan: int = 8) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    rows = manifest(docs, tampered(), depth, fan)
    siblings = F.array_join(F.transform("witness", lambda s: F.concat(s["left"], s["right"])), "")
    got = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                      fold(F.coalesce("other", "leaf"), F.col("witness")).alias("folded_root"))
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(text: str) -> str:
    cast = [f"cast({c} AS varchar)" for c in FIELDS[:-1]] + [text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c})) || ':' || {c}, '-')" for c in cast) + ")"


#: ``audit`` with 8 children in DuckDB. The crc32 runs over a list that holds each character's code
#: and then -1 for each of its 8 shifts.
ORACLE_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, {_leaf_sql("text")} AS leaf, {_leaf_sql("translate(text, '" + string.ascii_uppercase + "', '"
                                                              + string.ascii_lowercase + "')")} AS lowered,
         list_reduce(list_concat([4294967295::BIGINT], flatten([[ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
                     for c in string_split(cast(doc_id AS varchar), '')])),
                     lambda a, c: CASE WHEN c >= 0 THEN xor(a, c) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS crc
  FROM documents),
leaves AS (
  SELECT *, CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN lowered ELSE leaf END AS now,
         row_number() OVER (ORDER BY doc_id, leaf) AS rid,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS n FROM docs),
up AS (
  SELECT lang, 0 AS lv, i, n, leaf AS node FROM leaves
  UNION ALL
  SELECT lang, lv + 1, i // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY i)) FROM up WHERE n > 1
  GROUP BY lang, lv, i // 8, n),
steps AS (
  SELECT lang, lv, i,
         coalesce(string_agg(node, '') OVER (PARTITION BY lang, lv, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(node, '') OVER (PARTITION BY lang, lv, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM up WHERE n > 1),
langs AS (
  SELECT lang, lv AS top, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
up2 AS (
  SELECT 0 AS lv, i, n, node FROM langs
  UNION ALL
  SELECT lv + 1, i // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY i)) FROM up2 WHERE n > 1 GROUP BY lv, i // 8, n),
steps2 AS (
  SELECT lv, i,
         coalesce(string_agg(node, '') OVER (PARTITION BY lv, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(node, '') OVER (PARTITION BY lv, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM up2 WHERE n > 1),
fold AS (
  SELECT rid, lang, 0 AS lv, i, now AS node, '' AS proof FROM leaves
  UNION ALL
  SELECT f.rid, f.lang, f.lv + 1, f.i // 8, sha256(s.l || f.node || s.r), f.proof || s.l || s.r
  FROM fold f JOIN steps s ON f.lang IS NOT DISTINCT FROM s.lang AND f.lv = s.lv AND f.i = s.i),
fold2 AS (
  SELECT f.rid, 0 AS lv, g.i, f.node, f.proof FROM fold f JOIN langs g ON f.lang IS NOT DISTINCT FROM g.lang AND f.lv = g.top
  UNION ALL
  SELECT f.rid, f.lv + 1, f.i // 8, sha256(s.l || f.node || s.r), f.proof || s.l || s.r
  FROM fold2 f JOIN steps2 s ON f.lv = s.lv AND f.i = s.i),
roots AS (SELECT lv, node FROM up2 WHERE n = 1)
SELECT d.doc_id, d.leaf, g.node AS subroot, t.node AS root, sha256(f.proof) AS proof_sha256, f.node AS folded_root,
       f.node = t.node AS verified
FROM leaves d JOIN langs g ON d.lang IS NOT DISTINCT FROM g.lang JOIN fold2 f ON d.rid = f.rid JOIN roots t ON f.lv = t.lv
"""
