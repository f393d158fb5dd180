"""Stages of the pipeline on small tables with nulls, repeated rows, no rows and clashing columns; the
identity of documents in the removal of passages."""

import random

import corpus_pipeline as c
import pytest
from pyspark.sql import functions as F

from trawl.llm import bwt_dedup

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, rid long, spans string, "
          "kept boolean, row string, gone long")
WORDS = [f"{a}{b}" for a in ("stone", "river", "cloud", "light", "paper", "green") for b in ("ly", "ed", "ing", "er", "s")]


def sentence(seed, n=60):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "s", True, "r", 3) for r in rows], SCHEMA).repartition(3)


def stage(name):
    return dict(c.STAGES)[name]


def test_near_duplicates_keep_one_row_of_each(spark):
    near = sentence(1) + " end"
    rows = [(5, sentence(1), "en", "s", 1), (5, sentence(1), "en", "s", 1), (7, near, "en", "s", 1),
            (8, sentence(2), "en", "s", 1), (8, sentence(3), None, None, None), (None, sentence(4), "en", "s", 1),
            (None, None, None, None, None), (9, None, "en", "s", 0), (10, "", "en", "s", 0)]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in stage("near_dedup")(spark, table(spark, rows), SF).collect())
    assert [g[:2] for g in got] == [(False, 5), (False, 8), (False, 9), (False, 10), (True, 0), (True, 0)]
    assert got[0][2] == sentence(1)


def test_language_is_written(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).when(
        F.col("doc_id") % 50 == 1, F.lit("xx")).otherwise(F.col("lang")))
    empty = table(spark, [(900, None, "en", "nowhere", 0), (901, "", None, "nowhere", 0)]).select(*c.COLUMNS)
    got = {r.doc_id: r.lang for r in stage("language_id")(spark, mixed.unionByName(empty), SF).collect()}
    true = {r.doc_id: r.lang for r in docs.collect()}
    assert not {900, 901} & set(got)  # rows without a language go
    assert len(got) >= 0.95 * len(true)
    assert sum(got[i] == true[i] for i in got) >= 0.98 * len(got)


@pytest.mark.parametrize("name", [n for n, _ in c.STAGES])
def test_edge_rows_and_no_rows(spark, name):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "x" * 200_000, "en", "s", 5), (4, sentence(5), "en", "s", 1),
            (4, sentence(5), "en", "s", 1), (None, sentence(6), "de", None, 2), (6, sentence(7) + "é" * 60, "fr", "t", 3)]
    rows += [(20 + i, sentence(40 + i), "en", "s", 1) for i in range(20)]
    docs = table(spark, rows)
    got = stage(name)(spark, docs, SF)
    if name == "packing":
        assert got.count() >= len(rows)
    else:
        assert got.columns == list(c.COLUMNS) and got.count() <= len(rows)
    assert stage(name)(spark, docs.limit(0), SF).count() == 0


def test_rows_without_an_id_are_told_apart(spark):
    """16,000 rows without an id: half share a passage, the others nothing."""
    n, rng = 8_000, random.Random(3)
    noise = lambda k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=k))
    shared = noise(120)
    rows = [(None, f"{shared}{noise(40)}") for _ in range(n)] + [(None, noise(150)) for _ in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = bwt_dedup.cleaned(docs, ["doc_id", "text"]).where(F.length("text") < 150)
    cut = got.collect()
    assert len(cut) == n - 1 and all(len(r.text) <= 40 for r in cut)


def test_repeated_ids_and_other_branches(spark, monkeypatch):
    """Shuffle joins and hot buckets give what the broadcasts and whole buckets give."""
    rng = random.Random(4)
    head = [sentence(900 + i, 30) for i in range(4)]
    texts = [f"{rng.choice(head)} {sentence(i, 8)} {rng.choice(head)} {sentence(i + 1, 3)}" for i in range(60)]
    docs = spark.createDataFrame([(i // 3, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, id long").repartition(4)
    want = sorted(map(tuple, bwt_dedup.dedup(docs).collect()))
    seen, expected = set(), 0
    hashes = dict(docs.select("text", F.xxhash64("text")).collect())
    for i, t in sorted(((i // 3, t) for i, t in enumerate(texts)), key=lambda x: (x[0], hashes[x[1]])):
        b, gone = t.encode(), set()
        for p in range(len(b) - 99):
            gone |= set(range(p, p + 100)) if b[p:p + 100] in seen else set()
            seen.add(b[p:p + 100])
        expected += len(gone)
    assert sum(r[2] for r in want) == expected > 0
    monkeypatch.setattr(bwt_dedup, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, bwt_dedup.dedup(docs).collect())) == want
    monkeypatch.setattr(bwt_dedup, "HOT", 2)
    assert sorted(map(tuple, bwt_dedup.dedup(docs).collect())) == want
    assert bwt_dedup.cleaned(table(spark, [(1, "a", "en", "s", 1)]), [x.split()[0] for x in SCHEMA.split(", ")]).count() == 1


@pytest.mark.parametrize("chunk", [500_000, 3])
def test_components_contract_in_tasks(spark, monkeypatch, chunk):
    """A path, a star, a ring and pairs, dealt over tasks, also with a few edges contracted at a time."""
    from trawl.llm import components as C

    monkeypatch.setattr(C, "CHUNK", chunk)
    edges = [(i, i + 1) for i in range(100, 200)] + [(500, i) for i in range(501, 560)] + [(600 + i, 600 + (i + 1) % 30) for i in range(30)]
    edges += [(-5, 9), (9, -5), (7, 7), (1000, 1001)]
    random.Random(2).shuffle(edges)
    got = {r.node: r.component for r in C.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    want = {i: 100 for i in range(100, 201)} | {i: 500 for i in range(500, 560)} | {i: 600 for i in range(600, 630)}
    assert got == want | {-5: -5, 9: -5, 1000: 1000, 1001: 1000}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0
